"""Small input tables: adapters, settings, exclusions, references; XLSX sheets without any library."""

from __future__ import annotations

import io
import re
import xml.etree.ElementTree as ET
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

NS = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main"}
REQUIRED_SETTINGS = ("file_name", "analysis_ranges", "floor", "max_peaks")
OPTIONAL_SETTINGS = ("manual_control_repeat_length", "group", "group_control_sample", "time", "exclude")


def _column(ref: str) -> int:
    n = 0
    for c in re.match(r"[A-Z]+", ref)[0]:
        n = n * 26 + ord(c) - 64
    return n - 1


def xlsx_rows(raw: bytes, sheet: int = 1) -> list[list[str | None]]:
    """The cells of one sheet as text, empty cells null."""
    with zipfile.ZipFile(io.BytesIO(raw)) as z:
        shared: list[str] = []
        if "xl/sharedStrings.xml" in z.namelist():
            shared = ["".join(t.text or "" for t in si.iter(f"{{{NS['m']}}}t")) for si in ET.fromstring(z.read("xl/sharedStrings.xml")).findall("m:si", NS)]
        root = ET.fromstring(z.read(f"xl/worksheets/sheet{sheet}.xml"))
    out = []
    for row in root.iter(f"{{{NS['m']}}}row"):
        cells: dict[int, str | None] = {}
        for i, c in enumerate(row.findall("m:c", NS)):
            value, kind = c.find("m:v", NS), c.get("t")
            text = "".join(t.text or "" for t in c.iter(f"{{{NS['m']}}}t")) if kind == "inlineStr" else value.text if value is not None else None
            if kind == "s" and text is not None:
                text = shared[int(text)]
            if kind == "b" and text is not None:
                text = "TRUE" if text == "1" else "FALSE"
            cells[_column(c.get("r")) if c.get("r") else i] = text
        out.append([cells.get(i) for i in range(max(cells, default=-1) + 1)])
    return out


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A CSV, TSV, TXT or XLSX file (first sheet) with a header, all columns as text; NA and empty are null."""
    low = path.lower()
    if low.endswith(".xlsx"):
        raw = spark.read.format("binaryFile").load(path).select("content").first()[0]
        rows = xlsx_rows(bytes(raw))
        head = [str(h).strip() for h in rows[0]]
        body = [[(r[i] if i < len(r) else None) for i in range(len(head))] for r in rows[1:]]
        df = spark.createDataFrame(body, ", ".join(f"`{h}` string" for h in head))
    elif low.endswith((".csv", ".tsv", ".txt")):
        df = spark.read.option("header", True).option("sep", "," if low.endswith(".csv") else "\t").csv(path)
    elif low.endswith(".xls"):
        raise ValueError(f"old binary workbooks aren't read, save it as .xlsx or .csv: {path}")
    else:
        raise ValueError(f"unsupported table format: {path}")
    df = df.toDF(*(c.removeprefix("﻿").strip() for c in df.columns))
    return df.select(*(F.when(~F.trim(F.col(f"`{c}`")).isin("", "NA"), F.trim(F.col(f"`{c}`"))).alias(c) for c in df.columns))


def read_adapters(spark: SparkSession, path: str) -> dict[str, str]:
    """Adapter names and sequences in file order; a few dozen rows, so they travel as literals."""
    rows = read_table(spark, path).select("adapter_name", "adapter_sequence").collect()
    return {r[0]: r[1] for r in rows}


def read_settings(spark: SparkSession, path: str) -> DataFrame:
    """The settings table with file_stem; missing optional columns are null, a missing required one raises."""
    df = read_table(spark, path)
    missing = [c for c in REQUIRED_SETTINGS if c not in df.columns]
    if missing:
        raise ValueError(f"settings lack {', '.join(missing)}")
    extra = {c: F.lit(None).cast("string") for c in OPTIONAL_SETTINGS if c not in df.columns}
    df = df.withColumns(extra) if extra else df
    return df.withColumn("file_stem", F.regexp_replace("file_name", r"\.(fastq|fasta|fa|bam)(\.gz)?$", ""))


def read_exclusions(spark: SparkSession, path: str | None) -> DataFrame:
    """(file_stem, qname) of reads to leave out; none where no file is named or it lacks file_name or read_name."""
    none = spark.createDataFrame([], "file_stem string, qname string")
    if not path:
        return none
    df = read_table(spark, path)
    if not {"file_name", "read_name"} <= set(df.columns):
        return none
    return df.select(F.col("file_name").alias("file_stem"), F.col("read_name").alias("qname")).distinct()


def parse_reference(name: str, sequence: str) -> list[tuple[str, str, str, str]]:
    """(rname, ref_id, ref_flank, sequence) of the two flanks around the first run of five or more N."""
    m = re.search("[Nn]{5,}", sequence)
    if not m:
        raise ValueError("the reference needs a run of at least five N between its flanks")
    return [(f"{name}_left", name, "left", sequence[: m.start()]), (f"{name}_right", name, "right", sequence[m.end() :])]


def read_reference(spark: SparkSession, path: str) -> list[tuple[str, str, str, str]]:
    """The flanks of a one-record FASTA file."""
    from .sequences import read_fasta

    rows = read_fasta(spark, path).select("qname", "sequence").take(2)
    if len(rows) != 1:
        raise ValueError("the reference file needs one record")
    return parse_reference(rows[0][0], rows[0][1])
