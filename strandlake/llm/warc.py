"""WARC archives in seekable Zstandard bundles.

Records are grouped into independent Zstandard frames; a skippable frame with the seek table ends
each bundle, and an index table maps every record to its frame and its offset inside that frame, so
one record costs one ranged read and one frame of decompression.

Cases: null payload = empty payload; null url = the record's own URN as target; null id = an id of
``null``, never preferred as the response of its group; repeated rows (same id, same payload) give one
response, the repeats are revisits of that id; an empty table gives no bundle and no row. A record is held whole by its task, and
its frame may hold no more than the seek table's 32-bit sizes say: a payload near 4 GB raises OverflowError.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common

# Fixed values of the seekable Zstandard format.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
FOOTER_BYTES = 9
ENTRY_BYTES = 8

REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
URN = "urn:x-page:"
FRAME_BYTES = 1 << 18
BUNDLE_BYTES = 1 << 30
SALTS = 64
INDEX = "page_id long, record_type string, path string, frame int, frame_start long, offset long, length long"
RECORDS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def store(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a URI or of an absolute local path."""
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    if "://" not in uri:
        return pafs.LocalFileSystem(), uri
    return pafs.FileSystem.from_uri(uri)


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def seek_table(entries: list[tuple[int, int]]) -> bytes:
    """The skippable frame that ends a bundle: (compressed, decompressed) bytes of each frame."""
    body = b"".join(struct.pack("<II", c, d) for c, d in entries) + struct.pack("<IBI", len(entries), 0, SEEKABLE_MAGIC)
    return struct.pack("<II", SKIPPABLE_MAGIC, len(body)) + body


def read_seek_table(handle, size: int) -> list[tuple[int, int, int]]:
    """(start, compressed, decompressed) of each frame, from the last bytes of a bundle."""
    handle.seek(size - FOOTER_BYTES)
    count, flags, magic = struct.unpack("<IBI", handle.read(FOOTER_BYTES))
    if magic != SEEKABLE_MAGIC:
        raise ValueError("no seek table at the bundle's end")
    each = ENTRY_BYTES + (4 if flags & 0x80 else 0)
    handle.seek(size - FOOTER_BYTES - count * each)
    raw, start, out = handle.read(count * each), 0, []
    for i in range(count):
        packed, plain = struct.unpack_from("<II", raw, i * each)
        out.append((start, packed, plain))
        start += packed
    return out


def urn(page_id: int | None) -> str:
    return f"{URN}{'null' if page_id is None else page_id}"


def from_urn(text: str) -> int | None:
    tail = text.strip("<>")[len(URN) :]
    return None if tail == "null" else int(tail)


def warc_record(kind: str, record_id: str, block: bytes, extra: list[tuple[str, str]], date: str) -> bytes:
    head = [("WARC-Type", kind), ("WARC-Record-ID", f"<{record_id}>"), ("WARC-Date", date), *extra, ("Content-Length", str(len(block)))]
    lines = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head) + "\r\n"
    return lines.encode() + block + b"\r\n\r\n"


def page_record(page_id, url, payload: bytes, digest: str, keeper, date: str) -> bytes:
    """The record of one page; ``keeper`` is the id it revisits, or ``...`` for a response."""
    target = quote(url, safe="!#$%&'()*+,/:;=?@[]~") if url else urn(page_id)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    extra = [("WARC-Target-URI", target), ("WARC-Payload-Digest", f"sha1:{digest}"), ("Content-Type", "application/http; msgtype=response")]
    if keeper is ...:
        return warc_record("response", urn(page_id), http + payload, extra, date)
    extra += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", f"<{urn(keeper)}>")]
    return warc_record("revisit", urn(page_id), http, extra, date)


class BundleWriter:
    """One bundle: frames of whole records, closed by the seek table. Holds one frame in memory."""

    def __init__(self, filesystem: pafs.FileSystem, path: str, frame_bytes: int = FRAME_BYTES, level: int = 3):
        self.path, self.frame_bytes = path, frame_bytes
        self.sink = filesystem.open_output_stream(path, compression=None)
        self.packer = zstandard.ZstdCompressor(level=level, write_checksum=True)
        self.entries: list[tuple[int, int]] = []
        self.start, self.held = 0, bytearray()

    def add(self, record: bytes) -> tuple[int, int, int]:
        """(frame, frame's start in the file, offset in the frame) of the record."""
        if self.held and len(self.held) + len(record) > self.frame_bytes:
            self.flush()
        place = (len(self.entries), self.start, len(self.held))
        self.held += record
        return place

    def flush(self) -> None:
        if len(self.held) >= 1 << 32:
            raise OverflowError("a frame of 4 GB or more doesn't fit the seek table")
        if self.held:
            packed = self.packer.compress(bytes(self.held))
            self.sink.write(packed)
            self.entries.append((len(packed), len(self.held)))
            self.start += len(packed)
            self.held = bytearray()

    def close(self) -> None:
        self.flush()
        self.sink.write(seek_table(self.entries))
        self.sink.close()


def parse_records(plain: bytes) -> Iterator[tuple[dict[str, str], memoryview, int, int]]:
    """(headers, block, offset, length) of each record in a decompressed frame."""
    at, view = 0, memoryview(plain)
    while at < len(plain):
        end = plain.index(b"\r\n\r\n", at)
        lines = plain[at:end].decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no record at offset {at}")
        headers = {k.lower(): v for k, _, v in (line.partition(": ") for line in lines[1:])}
        size = int(headers["content-length"])
        yield headers, view[end + 4 : end + 4 + size], at, end + 8 + size - at
        at = end + 8 + size


def page_of(headers: dict[str, str], block: memoryview) -> tuple:
    """The RECORDS row of a record, from what the archive holds: a response's payload is digested again."""
    page_id, kind = from_urn(headers["warc-record-id"]), headers["warc-type"]
    raw = bytes(block)
    head, _, payload = raw.partition(b"\r\n\r\n")
    stated = next(int(x.split(b":")[1]) for x in head.split(b"\r\n") if x.lower().startswith(b"content-length:"))
    digest = headers["warc-payload-digest"].removeprefix("sha1:")
    if kind == "response":
        if base32_sha1(payload) != digest or len(payload) != stated:
            raise ValueError(f"damaged payload of {headers['warc-record-id']}")
        return page_id, stated, digest, kind, None
    return page_id, stated, digest, kind, from_urn(headers["warc-refers-to"])


def ranked_repeats(base: DataFrame, salts: int) -> DataFrame:
    """``base`` with ``again``: False for one row of each (id, payload), True for its repeats.

    Ids that stand once, nearly all, aren't moved. The rows of the others are ranked by (digest, id, salt) first and the salts' first rows among
    themselves, so that no row group is unbounded however often a row is repeated.
    """
    repeated = common.staged(base.groupBy("page_id").count().filter("count > 1").select(F.col("page_id").alias("twice")), "repeated-ids", True)
    n = repeated.limit(common.BROADCAST_ROWS + 1).count()
    if not n:
        return base.withColumn("again", F.lit(False))
    ids = F.broadcast(repeated) if n <= common.BROADCAST_ROWS else repeated
    met = base["page_id"].eqNullSafe(F.col("twice"))
    marked = base.join(ids, met, "left_semi").withColumn("part", F.pmod(F.monotonically_increasing_id(), F.lit(salts)))
    first = F.row_number().over(Window.partitionBy("digest", "page_id", "part").orderBy("url"))
    marked = marked.withColumn("part", F.when(first == 1, -1).otherwise(F.col("part")))
    last = F.row_number().over(Window.partitionBy("digest", "page_id", "part").orderBy("url"))
    marked = marked.withColumn("again", (F.col("part") >= 0) | (last > 1)).drop("part")
    return base.join(ids, met, "left_anti").withColumn("again", F.lit(False)).unionByName(marked)


def with_keepers(pages: DataFrame, id_col: str, url_col: str, body_col: str, min_bytes: int, salts: int) -> DataFrame:
    """page_id, url, payload, digest, keeper, response: the largest id among equal payloads, and whether the row is their one response.

    Payloads below ``min_bytes`` are responses all. The groups meet in two steps, by (digest, salt) and then by digest, so that a payload which a third
    of all pages share is spread over ``salts`` keys; only ids and digests move for it.
    """
    payload = F.encode(F.coalesce(F.col(body_col), F.lit("")), "UTF-8")
    base = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"))
    base = base.withColumn("digest", F.unhex(F.sha1("payload"))).withColumn("salt", F.pmod(F.xxhash64("page_id"), F.lit(salts)).cast("int"))
    part = base.filter(F.octet_length("payload") >= min_bytes).groupBy("digest", "salt").agg(F.max("page_id").alias("top"))
    keeper = part.groupBy("digest").agg(F.max("top").alias("keeper"), F.lit(True).alias("grouped"))
    spread = part.select("digest", "salt").join(keeper, "digest")
    found = ranked_repeats(base, salts).join(spread, ["digest", "salt"], "left")
    response = F.col("grouped").isNull() | (F.col("page_id").eqNullSafe(F.col("keeper")) & ~F.col("again"))
    return found.select("page_id", "url", "payload", "digest", "keeper", response.alias("response"))


def write_bundles(
    pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", body_col: str = "html", min_bytes: int = 0,
    frame_bytes: int = FRAME_BYTES, bundle_bytes: int = BUNDLE_BYTES, date: str = "2024-01-01T00:00:00Z", salts: int = SALTS,
) -> DataFrame:
    """Writes ``pages`` as bundles into ``folder``; returns the index (INDEX), itself kept in the shared folder.

    A task that runs again writes files of other names; the index holds those of the attempt that counted.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filesystem, root = store(folder)
        filesystem.create_dir(root, recursive=True)
        schema = pa.schema([("page_id", pa.int64()), ("record_type", pa.string()), ("path", pa.string()), ("frame", pa.int32()), ("frame_start", pa.int64()), ("offset", pa.int64()), ("length", pa.int64())])
        writer, written = None, 0
        for batch in common.slices(batches, 2):
            rows = []
            for row in batch.to_pylist():
                page_id, first = row["page_id"], row["response"]
                record = page_record(page_id, row["url"], row["payload"], base64.b32encode(row["digest"]).decode(), ... if first else row["keeper"], date)
                if writer is None or written > bundle_bytes:
                    if writer:
                        writer.close()
                    writer, written = BundleWriter(filesystem, f"{root}/bundle-{uuid.uuid4().hex}.warc.zst", frame_bytes), 0
                    writer.add(warc_record("warcinfo", f"urn:uuid:{uuid.uuid4()}", b"format: WARC File Format 1.1\r\n", [("Content-Type", "application/warc-fields")], date))
                    writer.flush()
                frame, start, offset = writer.add(record)
                written += len(record)
                rows.append((page_id, "response" if first else "revisit", writer.path, frame, start, offset, len(record)))
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows, strict=True), schema, strict=True)] if rows else [pa.array([], t.type) for t in schema], schema=schema)
        if writer:
            writer.close()

    keyed = with_keepers(pages, id_col, url_col, body_col, min_bytes, salts)
    return common.staged(keyed.mapInArrow(write, INDEX), "warc-index")


def read_bundles(index: DataFrame, folder: str) -> DataFrame:
    """Every page record (RECORDS) that the index names, by its frame and its offset there; each frame is read and unpacked once, by one task."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filesystem, _ = store(folder)
        unpack = zstandard.ZstdDecompressor()
        schema = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())])
        path, handle, sizes, start, frame = None, None, {}, None, b""
        try:
            for batch in batches:
                rows = []
                for row in batch.to_pylist():
                    if row["path"] != path:
                        if handle:
                            handle.close()
                        path, start = row["path"], None
                        handle = filesystem.open_input_file(path)
                        sizes = {at: (packed, plain) for at, packed, plain in read_seek_table(handle, handle.size())}
                    if row["frame_start"] != start:
                        start = row["frame_start"]
                        packed, plain = sizes[start]
                        handle.seek(start)
                        frame = unpack.decompress(handle.read(packed), max_output_size=plain)
                    headers, block, _, _ = next(parse_records(frame[row["offset"] : row["offset"] + row["length"]]))
                    rows.append(page_of(headers, block))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
        finally:
            if handle:
                handle.close()

    places = index.select("path", "frame_start", "offset", "length").repartition("path", "frame_start").sortWithinPartitions("path", "frame_start", "offset")
    return places.mapInArrow(read, RECORDS)


def fetch(path: str, frame_start: int, offset: int, length: int, folder: str = "") -> tuple[dict[str, str], bytes]:
    """One record by its index row: a ranged read, one frame decompressed."""
    filesystem, _ = store(folder or path)
    with filesystem.open_input_file(path) as handle:
        size = filesystem.get_file_info(path).size
        packed, plain = next((c, d) for s, c, d in read_seek_table(handle, size) if s == frame_start)
        handle.seek(frame_start)
        frame = zstandard.ZstdDecompressor().decompress(handle.read(packed), max_output_size=plain)
    headers, block, _, _ = next(parse_records(frame[offset : offset + length]))
    return headers, bytes(block)


def archive_round_trip(pages: DataFrame, **options) -> DataFrame:
    """Writes ``pages`` as bundles into the shared folder and reads them back (RECORDS)."""
    folder = common.new_folder(pages.sparkSession, "warc")
    return read_bundles(write_bundles(pages, folder, **options), folder)
