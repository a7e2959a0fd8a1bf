"""Outputs: count tables, FASTA, workbooks, stage tables with a manifest."""

from __future__ import annotations

import gzip
import io
import json
import os
import re
import zipfile
from collections.abc import Callable, Iterator
from urllib.parse import urlsplit
from xml.sax.saxutils import escape

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PROTEIN = "ACDEFGHIKLMNPQRSTVWYXBZJUO*"


def folder_name(key: str, value: str | None) -> str:
    """The folder of a key's rows, as Spark names it."""
    plain = re.sub(r"""[\x01-\x1f"#%'*/:=?\\\x7f{\[\]^]""", lambda m: f"%{ord(m[0]):02X}", value or "")
    return f"{key}={plain or '__HIVE_DEFAULT_PARTITION__'}"


class _Tsv:
    """Gzipped lines behind a header; the lines end in newlines and are copied as they lie in memory."""

    suffix = ".csv.gz"

    def __init__(self, path: str, names: list[str]):
        self.raw = open(path, "wb")
        self.out = gzip.GzipFile("", "wb", 6, self.raw, 0)
        self.out.write("\t".join(names).encode() + b"\n")

    def write(self, rows: pa.RecordBatch) -> None:
        lines = rows.column(0)
        _, offsets, data = lines.buffers()
        ends = np.frombuffer(offsets, np.int64 if pa.types.is_large_string(lines.type) else np.int32)
        self.out.write(memoryview(data)[ends[lines.offset] : ends[lines.offset + len(lines)]])

    def close(self) -> None:
        self.out.close()
        self.raw.close()


class _Parquet:
    suffix = ".snappy.parquet"

    def __init__(self, path: str, names: list[str]):
        self.path, self.out = path, None

    def write(self, rows: pa.RecordBatch) -> None:
        self.out = self.out or pq.ParquetWriter(self.path, rows.schema)
        self.out.write_batch(rows)

    def close(self) -> None:
        self.out.close()


def _write_keys(batches: Iterator[pa.RecordBatch], key: str, names: list[str], root: str, kind: type) -> Iterator[pa.RecordBatch]:
    """Files of rows sorted by their first column, the key; one is open at a time. A file has its name only when it is whole, and a task run again the same names."""
    files, now, out, part = 0, None, None, f"part-{TaskContext.get().partitionId():05d}{kind.suffix}"
    own = f".{TaskContext.get().taskAttemptId()}-{part}"

    def close() -> None:
        out.close()
        os.replace(f"{root}/{now}/{own}", f"{root}/{now}/{part}")

    for batch in batches:
        runs, at = pc.run_end_encode(batch.column(0)), 0
        rest = batch.select(range(1, batch.num_columns))
        for value, end in zip(runs.values.to_pylist(), runs.run_ends.to_pylist(), strict=True):
            folder = folder_name(key, value)
            if folder != now:
                if out:
                    close()
                os.makedirs(f"{root}/{folder}", exist_ok=True)
                now, out, files = folder, kind(f"{root}/{folder}/{own}", names), files + 1
            out.write(rest.slice(at, end - at))
            at = end
    if out:
        close()
    yield pa.RecordBatch.from_arrays([pa.array([files], pa.int64())], names=["files"])


def write_split(rows: DataFrame, key: str, path: str, kind: str = "parquet") -> None:
    """The rows split by a text column: a folder for each of its values, ``kind`` (parquet, or csv: gzipped TSV with a header) inside.

    Rows of a key come together first, so a key has one file, and more only where its share of the rows is so large that adaptive execution deals it to
    several tasks. Files of a folder on disk are written by Arrow: Spark's local file system starts a process for each new file. Other stores are
    written by Spark.
    """
    spark = rows.sparkSession
    system, p = _fs(spark, path)
    where = urlsplit(system.makeQualified(p).toUri().toString())
    names = [c for c in rows.columns if c != key]
    together = rows.select(key, *names).hint("rebalance", key)
    if where.scheme != "file":
        made = together.write.partitionBy(key).mode("overwrite")
        made.parquet(path) if kind == "parquet" else made.option("sep", "\t").option("header", True).option("compression", "gzip").csv(path)
        return
    system.delete(p, True)
    system.mkdirs(p)
    root, form = system.makeQualified(p).toUri().getPath(), _Parquet if kind == "parquet" else _Tsv
    if kind != "parquet":
        together = together.select(key, F.concat(F.to_csv(F.struct(*names), {"sep": "\t"}), F.lit("\n")).alias("line"))
    together.sortWithinPartitions(key).mapInArrow(lambda batches: _write_keys(batches, key, names, root, form), "files long").agg(F.sum("files")).collect()  # one row
    write_bytes(spark, f"{path}/_SUCCESS", b"")


def write_counts(rows: DataFrame, path: str) -> None:
    """Gzipped TSV of the counts of every read, a folder for each sample."""
    write_split(rows.select("file_stem", F.col("qname").alias("read_id"), "repeat_count_full", "repeat_count_match", "repeat_count_tracts"), "file_stem", path, "csv")


def fasta_lines(rows: DataFrame, name: str = "name", sequence: str = "sequence", kind: str = "dna") -> DataFrame:
    """FASTA text of each row; null and '' become ``-``, and so does every letter outside the alphabet."""
    if kind not in ("dna", "protein"):
        raise ValueError(f"unknown kind of sequence: {kind}")
    allowed = "ACGTN" if kind == "dna" else re.escape(PROTEIN)
    seq = F.regexp_replace(F.coalesce(F.nullif(F.col(sequence), F.lit("")), F.lit("-")), rf"[^{allowed}\-]", "-")
    return rows.select(F.concat(F.lit(">"), F.col(name), F.lit("\n"), seq).alias("value"))


def write_fasta(rows: DataFrame, path: str, name: str = "name", sequence: str = "sequence", kind: str = "dna") -> None:
    fasta_lines(rows, name, sequence, kind).write.mode("overwrite").text(path)


def consensus_names(rows: DataFrame, segment: str = "") -> DataFrame:
    """``rows`` (file_stem, cluster_number, read_count, mode, proportion) with the FASTA name of each cluster."""
    digits = F.greatest(F.length(rows.agg(F.max("cluster_number").alias("m")).select(F.col("m").cast("string")).scalar()), F.lit(2))
    tail = F.lit(f"_{segment}" if segment else "")
    return rows.withColumn("name", F.concat(F.col("file_stem"), F.lit("_cluster"), F.lpad(F.col("cluster_number").cast("string"), digits, F.lit("0")), F.lit("_n"), F.col("read_count").cast("string"), F.lit("_mode"), F.bround("mode", 0).cast("int").cast("string"), F.lit("_prop"), F.format_string("%.3f", F.col("proportion")), tail))


def sheet_names(names: list[str]) -> list[str]:
    """Names cut to 31 characters (``..`` at the end), made distinct by a number."""
    out: list[str] = []
    for name in names:
        short = name if len(name) <= 31 else name[:29] + ".."
        k = 1
        while short in out:
            k += 1
            short = f"{name[: 31 - len(str(k)) - 1]}_{k}"
        out.append(short)
    return out


def _cell(value) -> str:
    if value is None:
        return "<c/>"
    if isinstance(value, bool):
        return f'<c t="b"><v>{int(value)}</v></c>'
    if isinstance(value, (int, float)) and value == value and abs(value) != float("inf"):
        return f"<c><v>{value}</v></c>"
    clean = re.sub(r"[^\t\n\r\x20-퟿-�\U00010000-\U0010ffff]", "", str(value))
    return f'<c t="inlineStr"><is><t xml:space="preserve">{escape(clean)}</t></is></c>'


def workbook(tables: dict[str, DataFrame], rows: int = 1_048_575) -> bytes:
    """An XLSX workbook of summary tables, a sheet each. A sheet holds ``rows`` rows at most; a longer table raises."""
    names = sheet_names(list(tables))
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        kinds = "".join(f'<Override PartName="/xl/worksheets/sheet{i}.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/>' for i in range(1, len(names) + 1))
        z.writestr("[Content_Types].xml", f'<?xml version="1.0"?><Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/>{kinds}</Types>')
        rel = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
        z.writestr("_rels/.rels", f'<?xml version="1.0"?><Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="r1" Type="{rel}/officeDocument" Target="xl/workbook.xml"/></Relationships>')
        sheets = "".join(f'<sheet name="{escape(n, {chr(34): "&quot;"})}" sheetId="{i}" r:id="s{i}"/>' for i, n in enumerate(names, 1))
        z.writestr("xl/workbook.xml", f'<?xml version="1.0"?><workbook xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" xmlns:r="{rel}"><sheets>{sheets}</sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<?xml version="1.0"?><Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">' + "".join(f'<Relationship Id="s{i}" Type="{rel}/worksheet" Target="worksheets/sheet{i}.xml"/>' for i in range(1, len(names) + 1)) + "</Relationships>")
        for i, df in enumerate(tables.values(), 1):
            got = df.limit(rows + 1).collect()
            if len(got) > rows:
                raise ValueError("a workbook's sheet can't hold this table; write it as Parquet or CSV")
            lines = [list(df.columns), *map(list, got)]
            body = "".join("<row>" + "".join(map(_cell, line)) + "</row>" for line in lines)
            z.writestr(f"xl/worksheets/sheet{i}.xml", f'<?xml version="1.0" encoding="UTF-8"?><worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData>{body}</sheetData></worksheet>')
    return buf.getvalue()


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def write_bytes(spark: SparkSession, path: str, data: bytes) -> None:
    """One driver-side file through Spark's file system layer."""
    system, p = _fs(spark, path)
    out = system.create(p, True)
    out.write(bytearray(data))
    out.close()


def read_bytes(spark: SparkSession, path: str) -> bytes | None:
    system, p = _fs(spark, path)
    if not system.exists(p):
        return None
    return bytes(spark.read.format("binaryFile").load(path).select("content").first()[0])


def format_size(size: float) -> str:
    for unit in ("B", "KB", "MB", "GB"):
        if size < 1024:
            return f"{size:.1f} {unit}"
        size /= 1024
    return f"{size:.1f} TB"


#: What the manifest says of the main tables; others are described by their name.
DESCRIPTIONS = {
    "reads": "reads that quality control kept, trimmed where asked for",
    "alignments": "every alignment of a read to a flank",
    "split": "segments of each read around the repeat",
    "detected": "tract, segments and counts of each read, before any policy",
    "repeat_counts": "counts of each read that the policies kept",
    "assigned": "reads with their cluster",
    "clusters": "cluster of each read",
    "consensus": "consensus sequences of each cluster",
    "variants": "differences of each consensus from the reference",
    "length_freq": "reads of each sample, range and length",
    "distribution_summary": "distribution metrics of each sample and range",
    "instability_metrics": "instability against the sample's own and the controls' setpoint",
}


class StageStore:
    """Parquet tables of pipeline stages, each with the hash of the parameters that made it."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.kept: dict[str, set[str]] = {}

    def manifest(self, stage: str) -> dict | None:
        raw = read_bytes(self.spark, f"{self.root}/{stage}/manifest.json")
        try:
            return json.loads(raw) if raw else None
        except ValueError:
            return None

    def fresh(self, stage: str, digest: str) -> bool:
        """Whether the stage is there, whole and made with the same parameters."""
        return (self.manifest(stage) or {}).get("params") == digest

    def keeper(self, stage: str, digest: str, resume: bool = False) -> Callable[[str, DataFrame], DataFrame]:
        """A function (name, rows) that writes one table at once and gives it as read, so that what follows from it doesn't make it again.

        With ``resume`` a table that an unfinished run with the same parameters has left is taken as it is: a run that failed begins again behind its last
        whole table.
        """

        def keep(name: str, df: DataFrame) -> DataFrame:
            path = f"{self.root}/{stage}/{name}"
            mark = read_bytes(self.spark, f"{path}.json") if resume else None
            if not mark or json.loads(mark).get("params") != digest:
                df.write.mode("overwrite").parquet(path)
                write_bytes(self.spark, f"{path}.json", json.dumps({"params": digest}).encode())
            self.kept.setdefault(stage, set()).add(name)
            return self.spark.read.parquet(path)

        return keep

    def save(self, stage: str, tables: dict[str, DataFrame], digest: str) -> dict[str, DataFrame]:
        """Writes the tables that ``keeper`` hasn't, then the manifest that makes them valid; returns them as read."""
        entries = []
        for name, df in tables.items():
            path = f"{self.root}/{stage}/{name}"
            if name not in self.kept.get(stage, ()):
                df.write.mode("overwrite").parquet(path)
            system, p = _fs(self.spark, path)
            size = system.getContentSummary(p).getLength()
            entries.append({"object": name, "description": DESCRIPTIONS.get(name, name.replace("_", " ")), "class": "table", "columns": df.columns, "bytes": size, "size": format_size(size)})
        self.kept.pop(stage, None)
        write_bytes(self.spark, f"{self.root}/{stage}/manifest.json", json.dumps({"params": digest, "tables": entries}).encode())
        return self.load(stage)

    def load(self, stage: str) -> dict[str, DataFrame]:
        found = self.manifest(stage)
        if not found:
            raise FileNotFoundError(f"stage {stage} is missing or not whole")
        return {t["object"]: self.spark.read.parquet(f"{self.root}/{stage}/{t['object']}") for t in found["tables"]}
