"""Sequence files as reads (file_stem, read_index, qname, sequence, quality): FASTQ, FASTA, BAM.

Text formats are split by Spark's own line reader; BAM is a custom data source.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..functions.sequence import cigar_columns

READS = "file_stem string, read_index long, qname string, sequence string, quality string"
STEM = r"([^/]*?)(?:\.(?:fastq|fq|fasta|fa|bam))?(?:\.gz)?$"


def _stem(column):
    return F.regexp_extract(column, STEM, 1)


def read_fastq(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Four-line records; names end at the first space. Carriage returns are dropped.

    Lines are read and split by Spark's text source (gzip included). A line's number in its file is its place in its block plus the lines of the
    blocks before, a table with one row for each block; four lines then meet by (file, number / 4).
    """
    lines = spark.read.text(paths).select(F.regexp_replace("value", "\r$", "").alias("value"), F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"))
    blocks = lines.groupBy("path", "block").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = lines.join(blocks.select("path", "block", "first", before.alias("before")), ["path", "block"]).withColumn("line", F.col("at") - F.col("first") + F.col("before"))
    part = [F.max(F.when(F.col("line") % 4 == i, F.col("value"))) for i in (0, 1, 3)]
    records = placed.groupBy("path", F.floor(F.col("line") / 4).alias("read_index")).agg(*(p.alias(f"p{i}") for i, p in enumerate(part)))
    records = records.filter("not (p0 = '' and p1 is null)")
    head = F.when(F.col("p0").startswith("@"), F.substring_index(F.expr("substring(p0, 2)"), " ", 1)).otherwise(F.raise_error(F.concat(F.lit("a record doesn't start with @: "), F.col("path"))).cast("string"))
    return records.select(_stem(F.col("path")).alias("file_stem"), F.col("read_index").cast("long").alias("read_index"), head.alias("qname"), F.col("p1").alias("sequence"), F.col("p2").alias("quality"))


def _name(path: str) -> str:
    import re

    return re.search(STEM, path)[1]


def read_fasta(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Records of a header and any number of sequence lines; the name is the whole header. Plain files are split between tasks."""
    rows = spark.read.option("lineSep", "\n>").text(paths).select("value", "_metadata.file_path", "_metadata.file_block_start")
    rows = rows.withColumn("_at", F.monotonically_increasing_id())
    text = F.regexp_replace(F.regexp_replace("value", r"^>", ""), "\r", "")
    parts = F.split(text, "\n", 2)
    name, seq = F.get(parts, F.lit(0)), F.regexp_replace(F.coalesce(F.get(parts, F.lit(1)), F.lit("")), r"\s+", "")
    return rows.filter("trim(value) <> ''").select(_stem(F.col("file_path")).alias("file_stem"), F.col("_at").alias("read_index"), name.alias("qname"), seq.alias("sequence"), F.lit(None).cast("string").alias("quality"))


# Fixed values of the BAM format: bases by nibble.
BAM_BASES = "=ACMGRSVTWYHKDBN"


PIECE = 1 << 20


def bgzf_pieces(handle) -> Iterator[bytes]:
    """The plain bytes of concatenated gzip members, piece by piece as they are read."""
    raw, d = handle.read(PIECE), zlib.decompressobj(31)
    while raw:
        plain = d.decompress(raw)
        if plain:
            yield plain
        raw = d.unused_data if d.eof else b""
        if d.eof:
            d = zlib.decompressobj(31)
        raw = raw or handle.read(PIECE)


class _Plain:
    """Exact reads from pieces; holds what is read and not yet taken."""

    def __init__(self, pieces: Iterator[bytes]):
        self.pieces, self.held, self.at = pieces, b"", 0

    def take(self, n: int) -> bytes:
        """``n`` bytes, fewer only at the end."""
        while len(self.held) - self.at < n:
            more = next(self.pieces, None)
            if more is None:
                break
            self.held, self.at = self.held[self.at :] + more, 0
        got = self.held[self.at : self.at + n]
        self.at += len(got)
        return got

    def number(self) -> int:
        return struct.unpack("<i", self.take(4))[0]


# Fixed values of the BAM format: operations of a CIGAR, sizes of tag values.
BAM_OPS = "MIDNSHP=X"
BAM_SIZES = {"A": 1, "c": 1, "C": 1, "s": 2, "S": 2, "i": 4, "I": 4, "f": 4}
BAM_FORMS = {"c": "b", "C": "B", "s": "h", "S": "H", "i": "i", "I": "I", "f": "f"}


def bam_tags(data: bytes) -> dict[str, int | float | str]:
    """Numbers and texts among a record's tags; arrays are passed over."""
    out, at = {}, 0
    while at + 3 <= len(data):
        name, kind = data[at : at + 2].decode("latin-1"), chr(data[at + 2])
        at += 3
        if kind in "ZH":
            end = data.index(b"\0", at)
            out[name], at = data[at:end].decode("latin-1"), end + 1
        elif kind == "B":
            each, count = BAM_SIZES[chr(data[at])], struct.unpack_from("<i", data, at + 1)[0]
            at += 5 + each * count
        else:
            size = BAM_SIZES[kind]
            out[name] = chr(data[at]) if kind == "A" else struct.unpack_from("<" + BAM_FORMS[kind], data, at)[0]
            at += size
    return out


def bam_alignments(handle) -> Iterator[tuple]:
    """(name, sequence, quality, flag, reference, 1-based start, mapq, cigar, tags) of every record of a BAM file, whatever its flags."""
    plain = _Plain(bgzf_pieces(handle))
    if plain.take(4) != b"BAM\1":
        raise ValueError("no BAM file")
    plain.take(plain.number())
    refs = []
    for _ in range(plain.number()):
        refs.append(plain.take(plain.number()).rstrip(b"\0").decode())
        plain.take(4)
    while len(head := plain.take(4)) == 4:
        (size,) = struct.unpack("<i", head)
        data = plain.take(size)
        if len(data) < size:
            raise ValueError("the BAM file is cut short")
        ref, start, names, mapq, _, ops, flag, bases = struct.unpack_from("<iiBBHHHi", data)
        p = 32 + names
        name = data[32 : p - 1].decode()
        cigar = "".join(f"{x >> 4}{BAM_OPS[x & 15]}" for x in struct.unpack_from(f"<{ops}I", data, p))
        p += 4 * ops
        packed = data[p : p + (bases + 1) // 2]
        seq = "".join(BAM_BASES[b >> 4] + BAM_BASES[b & 15] for b in packed)[:bases]
        p += len(packed)
        q = data[p : p + bases]
        yield name, seq, None if q[:1] == b"\xff" else "".join(chr(x + 33) for x in q), flag, refs[ref] if ref >= 0 else None, start + 1, mapq, cigar, data[p + bases :]


def bam_records(handle) -> Iterator[tuple[str, str, str | None]]:
    """(name, sequence, quality) of every record."""
    return (record[:3] for record in bam_alignments(handle))


class BamSource(DataSource):
    """``spark.read.format("bam").load(path)``: one partition for each file."""

    @classmethod
    def name(cls) -> str:
        return "bam"

    def schema(self) -> str:
        return READS

    def reader(self, schema) -> BamReader:
        return BamReader(self.options)


class BamReader(DataSourceReader):
    def __init__(self, options):
        self.path = options.get("path", "")

    def partitions(self):
        from pyarrow import fs

        system, root = fs.FileSystem.from_uri(self.path) if "://" in self.path else (fs.LocalFileSystem(), self.path.removeprefix("file:"))
        info = system.get_file_info(root)
        if info.type == fs.FileType.Directory:
            return [InputPartition(f.path) for f in system.get_file_info(fs.FileSelector(root, recursive=True)) if f.path.endswith(".bam")]
        return [InputPartition(root)]

    def read(self, partition):
        from pyarrow import fs

        system = fs.FileSystem.from_uri(self.path)[0] if "://" in self.path else fs.LocalFileSystem()
        stem = _name(partition.value)
        with system.open_input_stream(partition.value, compression=None) as f:
            for i, record in enumerate(self.records(f)):
                yield stem, i, *record

    def records(self, handle) -> Iterator[tuple]:
        return bam_records(handle)


class AlignedBamSource(BamSource):
    """``spark.read.format("aligned_bam")``: alignments with their places and tags."""

    @classmethod
    def name(cls) -> str:
        return "aligned_bam"

    def schema(self) -> str:
        return "file_stem string, read_index long, qname string, query_sequence string, quality string, flag int, rname string, ref_start int, mapq int, cigar string, mismatches int, md string"

    def reader(self, schema) -> AlignedBamReader:
        return AlignedBamReader(self.options)


class AlignedBamReader(BamReader):
    def records(self, handle) -> Iterator[tuple]:
        for *most, data in bam_alignments(handle):
            tags = bam_tags(data)
            yield *most, tags.get("NM"), tags.get("MD")


def read_bam(spark: SparkSession, path: str) -> DataFrame:
    """Reads of BAM files, a task for each file; a task holds one piece and one record."""
    spark.dataSource.register(BamSource)
    return spark.read.format("bam").load(path)


def read_alignments(spark: SparkSession, path: str, refs: list[tuple[str, str, str, str]]) -> DataFrame:
    """Alignments that an external aligner left as BAM, in the columns of the built-in one (and MD); records without a place or a tag have nulls there."""
    spark.dataSource.register(AlignedBamSource)
    rows = spark.read.format("aligned_bam").load(path)
    named = spark.createDataFrame([r[:3] for r in refs], "rname string, ref_id string, ref_flank string")  # two rows for each locus
    placed = F.col("rname").isNotNull() & (F.col("cigar") != "")
    made = {k: F.when(placed, v) for k, v in cigar_columns(F.col("cigar"), F.col("ref_start")).items()}
    rows = rows.withColumn("strand", F.when(placed, F.when(F.col("flag").bitwiseAND(16) > 0, "-").otherwise("+"))).withColumns(made)
    rows = rows.withColumn("aligned_subsequence", F.substring("query_sequence", F.col("query_start"), F.col("alignment_length_on_query")))
    columns = "file_stem qname rname ref_id ref_flank strand ref_start ref_end alignment_length_on_ref query_start query_end alignment_length_on_query mapq mismatches insertions deletions query_sequence aligned_subsequence cigar md"
    return rows.withColumn("ref_start", F.when(placed, F.col("ref_start"))).join(F.broadcast(named), "rname", "left").select(*columns.split())


def read_sequences(spark: SparkSession, path: str, file_format: str) -> DataFrame:
    """Reads of files of one format of the catalog."""
    if file_format in ("fastq", "fastq.gz", "fq", "fq.gz"):
        return read_fastq(spark, path)
    if file_format in ("fasta", "fa"):
        return read_fasta(spark, path)
    if file_format == "bam":
        return read_bam(spark, path)
    raise ValueError(f"unsupported format: {file_format}")
