"""WARC bundles, media containers, chat formatting: round trips."""

import hashlib
import random
import struct
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strandlake.llm import chat, common, media, warc

PAGES = "page_id long, url string, html string"


def pages(spark, rows):
    return spark.createDataFrame(rows, PAGES).repartition(3)


ROWS = [(1, "http://a/ü x", "same"), (2, None, "same"), (3, "http://c/", "same"), (4, "http://d/\r\nX: y", None), (5, "u", ""), (6, "u", "ünïcode\r\n\r\nbody"), (7, "u", "x" * 700_000), (8, "u", "same but not"), (9, "u", "same")]


def test_warc_round_trip(spark):
    got = {r.page_id: r for r in warc.archive_round_trip(pages(spark, ROWS), frame_bytes=4096, bundle_bytes=100_000).collect()}
    assert set(got) == {r[0] for r in ROWS}
    for i, _, html in ROWS:
        raw = (html or "").encode()
        assert (got[i].payload_bytes, got[i].payload_digest) == (len(raw), warc.base32_sha1(raw))
    assert {i: got[i].refers_to for i in got if got[i].record_type == "revisit"} == {1: 9, 2: 9, 3: 9, 4: 5}


def test_warc_index_fetches_one_record(spark):
    folder = common.new_folder(spark, "warc-test")
    index = warc.write_bundles(pages(spark, ROWS), folder, frame_bytes=256)
    for r in index.collect():
        headers, block = warc.fetch(r.path, r.frame_start, r.offset, r.length)
        assert headers["warc-record-id"] == f"<urn:x-page:{r.page_id}>"
        if r.record_type == "response":
            assert block.partition(b"\r\n\r\n")[2] == (dict((x[0], x[2]) for x in ROWS)[r.page_id] or "").encode()
    assert index.select("frame").distinct().count() > 1


def test_warc_frames_stand_alone(spark):
    import zstandard

    folder = common.new_folder(spark, "warc-test")
    path = warc.write_bundles(pages(spark, ROWS).coalesce(1), folder, frame_bytes=256).first().path
    filesystem, _ = warc.store(folder)
    raw = filesystem.open_input_file(path).read()
    with filesystem.open_input_file(path) as handle:
        frames = warc.read_seek_table(handle, len(raw))
    plain = b"".join(zstandard.ZstdDecompressor().decompress(raw[s : s + c], max_output_size=d) for s, c, d in frames)
    assert struct.unpack_from("<I", raw, frames[-1][0] + frames[-1][1])[0] == warc.SKIPPABLE_MAGIC
    assert zstandard.ZstdDecompressor().stream_reader(raw, read_across_frames=True).read() == plain


def test_warc_cases(spark):
    empty = warc.archive_round_trip(spark.createDataFrame([], PAGES))
    assert empty.collect() == []
    repeated = [(5, "u", "a"), (5, "u", "a"), (None, "u", "a"), (None, None, "lonely")]
    got = sorted(((r.page_id, r.record_type, r.refers_to) for r in warc.archive_round_trip(pages(spark, repeated)).collect()), key=repr)
    assert got == sorted([(5, "response", None), (5, "revisit", 5), (None, "revisit", 5), (None, "response", None)], key=repr)
    extra = pages(spark, ROWS).withColumns({"digest": F.lit(1), "salt": F.lit("s"), "payload": F.lit(2), "keeper": F.lit(3)})
    assert warc.archive_round_trip(extra).count() == len(ROWS)
    short = {r.page_id: r.record_type for r in warc.archive_round_trip(pages(spark, ROWS), min_bytes=1).collect()}
    assert short[4] == short[5] == "response"


@pytest.mark.parametrize("threshold", ["-1", "10MB"])
def test_repeated_rows_give_one_response(spark, threshold, tmp_path):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    rows = [(7, "u", "again")] * 64 + [(6, "v", "again"), (8, "w", "other")] + [(None, "n", "null")] * 5
    pages(spark, rows).repartition(8).write.parquet(str(tmp_path / "p"))
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        got = warc.archive_round_trip(spark.read.parquet(str(tmp_path / "p")), salts=4).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    kinds = sorted((r.page_id or 0, r.record_type, r.refers_to or 0) for r in got)
    assert kinds == sorted([(7, "response", 0), *[(7, "revisit", 7)] * 63, (6, "revisit", 7), (8, "response", 0), (0, "response", 0), *[(0, "revisit", 0)] * 4])


def test_media_round_trip(spark):
    texts = [(1, "hello"), (2, None), (3, ""), (4, "x" * 192), (5, "é" * 50_000), (6, "hello")]
    got = {r.doc_id: r for r in media.store_and_read(spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    for i, text in texts:
        raw = (text or "").encode()
        plain = raw + b" " * (max(1, -(-len(raw) // 192)) * 192 - len(raw))
        r = got[i]
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(raw), len(plain), hashlib.sha256(plain).hexdigest(), zlib.crc32(plain[-16:]))
    assert got[1].media_sha256 == got[6].media_sha256
    assert got[1].feature == got[6].feature
    assert got[2].media_sha256 == got[3].media_sha256
    assert media.store_and_read(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def video(stss, wide):
    """Five samples in chunks of two, two and one, with a second track before it and a free box between."""
    sizes, chunks = [5, 6, 7, 8, 9], [(0, 2), (2, 2), (4, 1)]
    payload = bytes(range(35))
    ftyp = media.box(b"ftyp", b"isom" + bytes(4))
    start = len(ftyp) + 8
    offsets, at = [], start
    for first, n in chunks:
        offsets.append(at)
        at += sum(sizes[first : first + n])
    table = media.full_box(b"co64" if wide else b"stco", 0, 0, struct.pack(f">I3{'Q' if wide else 'I'}", 3, *offsets))
    stbl = media.box(
        b"stbl",
        media.full_box(b"stsd", 0, 0, struct.pack(">I", 1), media.box(b"avc1", bytes(78))),
        media.full_box(b"stts", 0, 0, struct.pack(">I4I", 2, 2, 10, 3, 20)),
        *([media.full_box(b"stss", 0, 0, struct.pack(f">I{len(stss)}I", len(stss), *stss))] if stss else []),
        media.full_box(b"stsc", 0, 0, struct.pack(">I6I", 2, 1, 2, 1, 3, 1, 1)),
        media.full_box(b"stsz", 0, 0, struct.pack(">II5I", 0, 5, *sizes)),
        table,
    )
    mdia = media.box(b"mdia", media.full_box(b"mdhd", 0, 0, struct.pack(">IIII4x", 0, 0, 600, 80)), media.full_box(b"hdlr", 0, 0, struct.pack(">I4s12x", 0, b"vide"), b"\0"), media.box(b"minf", stbl))
    moov = media.box(b"moov", media.box(b"trak", mdia))
    return ftyp + media.box(b"mdat", payload) + media.box(b"free", bytes(3)) + moov, start


@pytest.mark.parametrize("wide", [False, True])
def test_sample_tables(wide):
    data, at = video([1, 3], wide)
    (track,) = media.parse(data)
    assert (track["codec"], track["timescale"], track["duration"], track["samples"], track["keyframes"]) == ("avc1", 600, 80, 5, 2)
    assert track["ranges"] == [(at, 5), (at + 11, 7)]
    assert media.parse(video([], wide)[0])[0]["ranges"] == [(at, 35)]
    with pytest.raises(ValueError, match="leaves its parent|cut box"):
        media.parse(data[:-3])


@pytest.mark.parametrize("own_base", [False, True])
def test_movie_fragments(own_base):
    def full(kind, flags, *words):
        return media.full_box(kind, 0, flags, struct.pack(f">{len(words)}I", *words))

    empty = media.box(b"stbl", media.full_box(b"stsd", 0, 0, struct.pack(">I", 1), media.box(b"hvc1", bytes(78))), full(b"stts", 0, 0), full(b"stsc", 0, 0), full(b"stsz", 0, 0, 0), full(b"stco", 0, 0))
    mdia = media.box(b"mdia", media.full_box(b"mdhd", 0, 0, struct.pack(">IIII4x", 0, 0, 1000, 0)), media.full_box(b"hdlr", 0, 0, struct.pack(">I4s12x", 0, b"vide"), b"\0"), media.box(b"minf", empty))
    trak = media.box(b"trak", media.full_box(b"tkhd", 0, 3, struct.pack(">III", 0, 0, 7), bytes(68)), mdia)
    data = media.box(b"ftyp", b"iso5" + bytes(4)) + media.box(b"moov", trak, media.box(b"mvex", full(b"trex", 0, 7, 1, 40, 5, 0x10000)))
    want, at = [], len(data)
    for sizes in ([11, 5, 5], [9, 5]):
        def moof(offset, sizes=sizes, at=at):
            head = full(b"tfhd", 0x1, 7, *divmod(at, 1 << 32)) if own_base else full(b"tfhd", 0x20000, 7)
            first = full(b"trun", 0x1 | 0x4 | 0x200, len(sizes), offset, 0, *sizes)
            return media.box(b"moof", media.box(b"traf", head, first, full(b"trun", 0x100, 1, 25)))

        size = len(moof(0))
        data += moof(size + 8) + media.box(b"mdat", bytes(sum(sizes) + 5))
        want.append((at + size + 8, sizes[0]))
        at = len(data)
    (track,) = media.parse(data)
    assert (track["codec"], track["samples"], track["duration"], track["keyframes"], track["ranges"]) == ("hvc1", 7, 5 * 40 + 2 * 25, 2, want)
    with pytest.raises(ValueError, match="outside"):
        media.parse(data.replace(struct.pack(">II", 11, 5), struct.pack(">II", 11 << 16, 5)))


def test_media_columns_that_clash(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a")], "doc_id long, text string").withColumns({"media": F.lit(1), "n_bytes": F.lit("x"), "feature": F.lit(2)})
    got = media.store_and_read(df).collect()
    assert len(got) == 2 and len(set(got)) == 1 and got[0].n_bytes == 1


def test_damaged_media_gives_nulls(spark):
    good = media.mux(media.padded(b"abc"))
    df = spark.createDataFrame([(1, 3, bytearray(good)), (2, 3, bytearray(good[:200])), (3, 3, bytearray(b""))], media.MEDIA)
    got = {r.doc_id: (r.payload_bytes, r.media_bytes) for r in media.media_features(df).collect()}
    assert got == {1: (192, len(good)), 2: (None, 200), 3: (None, 0)}


pieces = st.lists(st.sampled_from([*chat.CONTROL, "\\", "\n", ".", "n", "x", "<", "|", "[", "/", "é", ">", "]", "<|im_", "start|>"]), max_size=12).map("".join)


@given(st.lists(st.tuples(pieces, pieces), max_size=4))
@settings(max_examples=300, deadline=None)
def test_chat_escape_is_reversible(turns):
    text, loss = chat.render(turns)
    assert chat.parse(text) == turns
    assert [chat.unescape(text[a:b]) for a, b in loss] == [t for r, t in turns if r == "assistant"]
    for _, t in turns:
        assert not any(c in chat.escape(t) for c in chat.CONTROL)


def test_chat_folds_events(spark):
    log = [
        (1, 1, "message", 1, "user", "hi"), (1, 2, "delta", 2, "assistant", "he"), (1, 3, "delta", 2, None, "llo"), (1, 4, "message", 3, "user", "more"),
        (1, 5, "regenerate", 2, None, "new"), (1, 6, "delta", 2, None, "er"), (1, 7, "message", 4, "user", "x"), (1, 8, "edit", 4, None, "y"),
        (1, 9, "message", 5, "user", "gone"), (1, 10, "delete", 5, None, None), (1, 11, "edit", 99, None, "ignored"), (1, 12, "other", 1, None, "ignored"),
        (2, None, "message", None, None, None), (None, 1, "message", None, "user", "n"),
    ]
    random.Random(1).shuffle(log)
    got = {r.conv_id: r for r in chat.format_conversations(spark.createDataFrame(log, "conv_id long, seq long, kind string, message_id long, role string, text string")).collect()}
    assert chat.parse(got[1].formatted) == [("user", "hi"), ("assistant", "newer"), ("user", "y")]
    assert chat.parse(got[2].formatted) == [("", "")]
    assert chat.parse(got[None].formatted) == [("user", "n")]


def test_chat_digests(spark):
    said = "</s>[INST] ok [/INST]"
    rows = [(-1, 0, "user", said), (-1, 1, "assistant", said), (5, 1, "assistant", "b"), (5, 0, "assistant", None), (5, 1, "assistant", "b")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("seq", F.lit("clash"))
    got = {r.conv_id: r for r in chat.read_back(chat.format_conversations(chat.turn_events(df))).collect()}
    assert got[-1].turns_sha256 == hashlib.sha256(f"user\n{said}\nassistant\n{said}\n".encode()).hexdigest()
    assert (got[-1].n_turns, got[-1].loss_chars, got[-1].loss_sha256) == (2, len(said), hashlib.sha256(said.encode()).hexdigest())
    assert (got[5].n_turns, got[5].loss_sha256) == (3, hashlib.sha256(b"bb").hexdigest())
    assert chat.format_conversations(chat.turn_events(df.limit(0))).count() == 0
    streamed = chat.streamed_events(df)
    assert {r.kind for r in streamed.collect()} == {"message", "delta", "edit", "regenerate"}
    assert {r.conv_id: r for r in chat.read_back(chat.format_conversations(streamed)).collect()} == got
    assert chat.format_conversations(chat.streamed_events(df.limit(0))).count() == 0
