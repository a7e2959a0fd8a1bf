"""Sample files: discovery and the catalog of stems, formats and mates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DEFAULT_PATTERNS = (r"\.fastq$", r"\.fastq.gz$", r"\.fasta$", r"\.fa$", r"\.bam$")


def discover(spark: SparkSession, folder: str, patterns: tuple[str, ...] = DEFAULT_PATTERNS, recursive: bool = True) -> DataFrame:
    """file_path and bytes of the files below a folder whose names match; contents aren't read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower()).load(folder)
    return files.select(F.col("path").alias("file_path"), F.col("length").alias("bytes")).filter(F.regexp_extract("file_path", r"([^/]*)$", 1).rlike("|".join(patterns)))


def catalog(files: DataFrame, r1: str = "_R1_", r2: str = "_R2_", select: str | None = "R1") -> DataFrame:
    """Name, format, mate and stems of every file, and whether it is to be read: unpaired, or the selected mate; all where ``select`` is None."""
    name = F.regexp_extract("file_path", r"([^/]*)$", 1)
    bare = F.regexp_replace("file_name", r"\.gz$", "")
    direction = F.when(F.col("file_name").rlike(r1), "R1").when(F.col("file_name").rlike(r2), "R2")
    out = files.withColumn("file_name", name).withColumns({
        "file_format": F.concat(F.regexp_extract(bare, r"\.([^.]*)$", 1), F.when(F.col("file_name").endswith(".gz"), ".gz").otherwise("")),
        "file_stem": F.regexp_replace(bare, r"\.[^.]*$", ""),
        "paired_read_direction": direction,
    })
    include = F.lit(True) if select is None else F.col("paired_read_direction").isNull() | (F.col("paired_read_direction") == select)
    return out.withColumns({
        "paired": F.col("paired_read_direction").isNotNull(),
        "include": include,
        "sample_stem": F.regexp_replace("file_stem", f"{r1}|{r2}", "_"),
    }).select("file_name", "file_format", "paired", "paired_read_direction", "include", "sample_stem", "file_stem", "file_path")
