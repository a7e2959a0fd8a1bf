"""ISO media containers in columns: nested boxes, sample tables, keyframe ranges.

``mux`` stores a byte payload as 8-bit PCM in an ISO base media file; ``parse`` walks the boxes of any
such file and decodes codec, duration and the byte ranges of its sync samples from the sample tables
alone: payload bytes are only touched where a caller asks for them.

Cases: null text = empty text, padded to one unit; equal texts give equal files; repeated rows are files of their own; a text and its file are held whole, a few
of them at a time by bytes; other columns don't matter; an empty table gives no row; files whose boxes are cut short, or whose tables point outside,
raise ValueError in ``parse`` and give nulls in ``media_features``. Of several tracks the feature names each, the payload is the first one's.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

UNIT = 192
RATE = 8000
CONTAINERS = (b"moov", b"trak", b"mdia", b"minf", b"stbl", b"dinf", b"edts", b"mvex", b"moof", b"traf", b"udta")
MEDIA = "doc_id long, n_bytes long, media binary"
FEATURES = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"


def box(kind: bytes, *parts: bytes) -> bytes:
    body = b"".join(parts)
    if len(body) + 8 < 1 << 32:
        return struct.pack(">I4s", len(body) + 8, kind) + body
    return struct.pack(">I4sQ", 1, kind, len(body) + 16) + body


def full_box(kind: bytes, version: int, flags: int, *parts: bytes) -> bytes:
    return box(kind, struct.pack(">I", version << 24 | flags), *parts)


def padded(payload: bytes, unit: int = UNIT) -> bytes:
    """The payload with bytes 32 behind it, up to a positive multiple of ``unit``."""
    size = max(unit, -(-len(payload) // unit) * unit)
    return payload.ljust(size, b" ")


MATRIX = struct.pack(">9I", 0x10000, 0, 0, 0, 0x10000, 0, 0, 0, 0x40000000)


def mux(payload: bytes, rate: int = RATE, chunk: int = 64 * UNIT) -> bytes:
    """An ISO base media file with one mono track of 8-bit PCM, the payload's bytes its samples."""
    n = len(payload)
    chunks = -(-n // chunk) if n else 0
    ftyp = box(b"ftyp", b"isom", struct.pack(">I", 0x200), b"isomiso6mp41")
    full, last = divmod(n, chunk)
    runs = ([(1, chunk)] if full else []) + ([(full + 1, last)] if last else [])

    def moov(base: int) -> bytes:
        entry = struct.pack(">6xH8xHHHHI", 1, 1, 8, 0, 0, rate << 16)
        pcm = box(b"ipcm", entry, full_box(b"pcmC", 0, 0, struct.pack(">BB", 1, 8)))
        stbl = box(
            b"stbl",
            full_box(b"stsd", 0, 0, struct.pack(">I", 1), pcm),
            full_box(b"stts", 0, 0, struct.pack(">III", 1, n, 1) if n else struct.pack(">I", 0)),
            full_box(b"stsc", 0, 0, struct.pack(">I", len(runs)), *(struct.pack(">III", first, per, 1) for first, per in runs)),
            full_box(b"stsz", 0, 0, struct.pack(">II", 1, n)),
            full_box(b"co64", 0, 0, struct.pack(">I", chunks), struct.pack(f">{chunks}Q", *range(base, base + chunks * chunk, chunk))),
        )
        minf = box(b"minf", full_box(b"smhd", 0, 0, bytes(4)), box(b"dinf", full_box(b"dref", 0, 0, struct.pack(">I", 1), full_box(b"url ", 0, 1))), stbl)
        mdia = box(b"mdia", full_box(b"mdhd", 1, 0, struct.pack(">QQIQHH", 0, 0, rate, n, 0x55C4, 0)), full_box(b"hdlr", 0, 0, struct.pack(">I4s12x", 0, b"soun"), b"payload\0"), minf)
        tkhd = full_box(b"tkhd", 1, 3, struct.pack(">QQIIQ8xHHHH", 0, 0, 1, 0, n, 0, 0, 0x100, 0), MATRIX, bytes(8))
        mvhd = full_box(b"mvhd", 1, 0, struct.pack(">QQIQIH10x", 0, 0, rate, n, 0x10000, 0x100), MATRIX, bytes(24), struct.pack(">I", 2))
        return box(b"moov", mvhd, box(b"trak", tkhd, mdia))

    size = len(moov(0))
    head = 8 if n + 8 < 1 << 32 else 16
    return ftyp + moov(len(ftyp) + size + head) + box(b"mdat", payload)


def boxes(data, start: int, end: int) -> Iterator[tuple[bytes, int, int]]:
    """(kind, body's start, body's end) of each box between two offsets; 64-bit and to-the-end sizes included."""
    while start < end:
        if end - start < 8:
            raise ValueError(f"cut box at {start}")
        size, kind = struct.unpack_from(">I4s", data, start)
        body = start + 8
        if size == 1:
            (size,) = struct.unpack_from(">Q", data, body)
            body += 8
        elif size == 0:
            size = end - start
        if kind == b"uuid":
            body += 16
        if start + size > end or start + size < body:
            raise ValueError(f"box {kind!r} at {start} leaves its parent")
        yield kind, body, start + size
        start += size


def walk(data, start: int, end: int, path: tuple[bytes, ...] = ()) -> Iterator[tuple[tuple[bytes, ...], int, int]]:
    """Every box below, parents first."""
    for kind, a, b in boxes(data, start, end):
        yield (*path, kind), a, b
        if kind in CONTAINERS:
            yield from walk(data, a, b, (*path, kind))


def _longs(data, at: int, count: int, form: str = "I") -> tuple[int, ...]:
    return struct.unpack_from(f">{count}{form}", data, at)


def sample_table(data, leaf: dict[bytes, tuple[int, int]]) -> dict:
    """Runs of samples from stts, stsc, stsz, stco or co64 and stss: (start, bytes, samples, all sync?)."""
    at = leaf[b"stsd"][0] + 4
    (entries,) = _longs(data, at, 1)
    codec = bytes(data[at + 8 : at + 12]).decode("latin-1").strip() if entries else ""
    duration = samples = 0
    at = leaf[b"stts"][0] + 4
    for i in range(_longs(data, at, 1)[0]):
        count, delta = _longs(data, at + 4 + 8 * i, 2)
        duration, samples = duration + count * delta, samples + count
    at = leaf[b"stsz"][0] + 4
    fixed, total = _longs(data, at, 2)
    sizes = None if fixed else _longs(data, at + 8, total)
    wide = b"co64" in leaf
    at = leaf[b"co64" if wide else b"stco"][0] + 4
    chunks = _longs(data, at + 4, _longs(data, at, 1)[0], "Q" if wide else "I")
    at = leaf[b"stsc"][0] + 4
    (n,) = _longs(data, at, 1)
    runs = [_longs(data, at + 4 + 12 * i, 3) for i in range(n)]
    sync = None
    if b"stss" in leaf:
        at = leaf[b"stss"][0] + 4
        sync = set(_longs(data, at + 4, _longs(data, at, 1)[0]))
    ranges: list[list[int]] = []
    keyframes, sample = 0, 1

    def put(start: int, size: int) -> None:
        if ranges and ranges[-1][1] == start:
            ranges[-1][1] = start + size
        else:
            ranges.append([start, start + size])

    for k, (first, per, _) in enumerate(runs):
        last = runs[k + 1][0] - 1 if k + 1 < len(runs) else len(chunks)
        for chunk in range(first, last + 1):
            start, count = chunks[chunk - 1], min(per, total - sample + 1)
            if sync is None and sizes is None:
                put(start, count * fixed)
                keyframes += count
                sample += count
                continue
            for _ in range(count):
                size = fixed or sizes[sample - 1]
                if sync is None or sample in sync:
                    put(start, size)
                    keyframes += 1
                start += size
                sample += 1
    if sample - 1 != total or samples != total:
        raise ValueError("sample tables disagree")
    return {"codec": codec, "samples": total, "duration": duration, "keyframes": keyframes, "ranges": [(a, b - a) for a, b in ranges]}


def track_runs(data, fragment: tuple[int, list[dict[bytes, list[tuple[int, int]]]]], defaults: dict[int, tuple[int, int, int]]) -> Iterator[tuple[int, int, int, int, bool]]:
    """(track, start, bytes, duration, sync?) of every sample of a movie fragment: (its start, the boxes of its track fragments)."""
    begin, parts = fragment
    end = begin
    for boxes_of in parts:
        at = boxes_of[b"tfhd"][0][0]
        flags, track = _longs(data, at, 2)
        at += 8
        lasts, size, kind = defaults.get(track, (0, 0, 0))
        base = begin if flags & 0x20000 or boxes_of is parts[0] else end
        if flags & 0x1:
            (base,) = _longs(data, at, 1, "Q")
            at += 8
        at += 4 if flags & 0x2 else 0
        told = []
        for bit in (0x8, 0x10, 0x20):
            told.append(_longs(data, at, 1)[0] if flags & bit else None)
            at += 4 if flags & bit else 0
        lasts, size, kind = (x if x is not None else y for x, y in zip(told, (lasts, size, kind), strict=True))
        end = base
        for at, _ in boxes_of.get(b"trun", ()):
            flags, count = _longs(data, at, 2)
            flags &= 0xFFFFFF
            at += 8
            if flags & 0x1:
                end = base + _longs(data, at, 1, "i")[0]
                at += 4
            first = _longs(data, at, 1)[0] if flags & 0x4 else None
            at += 4 if flags & 0x4 else 0
            fields = [bit for bit in (0x100, 0x200, 0x400, 0x800) if flags & bit]
            for i in range(count):
                own = dict(zip(fields, _longs(data, at, len(fields)), strict=True))
                at += 4 * len(fields)
                own_kind = own.get(0x400, first if not i and first is not None else kind)
                n = own.get(0x200, size)
                yield track, end, n, own.get(0x100, lasts), not own_kind & 0x10000
                end += n


def parse(data) -> list[dict]:
    """One dict for each track: codec, timescale, duration, samples, keyframes, ranges (start, bytes); samples of movie fragments included."""
    tracks: list[dict] = []
    leaf: dict[bytes, tuple[int, int]] = {}
    fragments: list[tuple[int, list[dict[bytes, list[tuple[int, int]]]]]] = []
    defaults: dict[int, tuple[int, int, int]] = {}
    for path, a, b in walk(data, 0, len(data)):
        if path[-1] == b"trak":
            leaf = {}
            tracks.append(leaf)
        elif path[:2] == (b"moov", b"trak"):
            leaf[path[-1]] = (a, b)
        elif path == (b"moov", b"mvex", b"trex"):
            track, _, lasts, size, kind = _longs(data, a + 4, 5)
            defaults[track] = lasts, size, kind
        elif path == (b"moof",):
            fragments.append((a - (8 if bytes(data[a - 4 : a]) == b"moof" else 16), []))
        elif path == (b"moof", b"traf"):
            fragments[-1][1].append({})
        elif path[:2] == (b"moof", b"traf") and fragments[-1][1]:
            fragments[-1][1][-1].setdefault(path[-1], []).append((a, b))
    out, by_id = [], {}
    for leaf in tracks:
        at = leaf[b"mdhd"][0]
        scale = _longs(data, at + (20 if data[at] else 12), 1)[0]
        kind = bytes(data[leaf[b"hdlr"][0] + 8 : leaf[b"hdlr"][0] + 12]).decode("latin-1")
        out.append({"kind": kind, "timescale": scale} | sample_table(data, leaf))
        if b"tkhd" in leaf:
            at = leaf[b"tkhd"][0]
            by_id[_longs(data, at + (20 if data[at] else 12), 1)[0]] = out[-1]
    for fragment in fragments:
        for track, start, size, lasts, sync in track_runs(data, fragment, defaults):
            if start < 0 or start + size > len(data):
                raise ValueError("a sample lies outside the file")
            if track not in by_id:
                raise ValueError(f"a fragment of the unknown track {track}")
            said = by_id[track]
            said["samples"] += 1
            said["duration"] += lasts
            if sync:
                said["keyframes"] += 1
                if said["ranges"] and sum(said["ranges"][-1]) == start:
                    said["ranges"][-1] = (said["ranges"][-1][0], said["ranges"][-1][1] + size)
                else:
                    said["ranges"].append((start, size))
    return out


def feature_text(track: dict) -> str:
    spans = " ".join(f"{a}+{n}" for a, n in track["ranges"])
    return f"{track['kind']}/{track['codec']} {track['samples']} samples {track['duration']}/{track['timescale']} s {track['keyframes']} sync: {spans}"


def encode_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", unit: int = UNIT) -> DataFrame:
    """MEDIA: every whole text as the samples of one ISO media file."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches, 1, 500):
            raw = [x or b"" for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(x) for x in raw], pa.int64()), pa.array([mux(padded(x, unit)) for x in raw], pa.binary())], names=["doc_id", "n_bytes", "media"])

    return docs.select(F.col(id_col).cast("long"), F.encode(F.col(text_col), "UTF-8")).mapInArrow(encode, MEDIA)


def media_features(media: DataFrame) -> DataFrame:
    """FEATURES of a media column, from the stored bytes alone; damaged files give nulls beside their size and hash."""

    def one(data: bytes) -> tuple:
        whole = (len(data), hashlib.sha256(data).hexdigest())
        try:
            tracks = parse(data)
            track = tracks[0]
        except (ValueError, LookupError, struct.error):
            return None, None, None, *whole, None
        payload = b"".join(data[a : a + n] for a, n in track["ranges"])
        return len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]), *whole, "; ".join(map(feature_text, tracks))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
        names = ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]
        for batch in common.slices(batches, 2, 500):
            rows = [one(x) for x in batch.column(2).to_pylist()]
            found = zip(*rows, strict=True) if rows else [[]] * len(kinds)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array(c, t) for c, t in zip(found, kinds, strict=True))], names=names)

    return media.select("doc_id", "n_bytes", "media").mapInArrow(read, FEATURES)


def store_and_read(docs: DataFrame, **options) -> DataFrame:
    """Media column written to the shared folder as a table, then read back for its features."""
    return media_features(common.staged(encode_texts(docs, **options), "media"))
