"""The test tables seen as the engine's tables, in Spark and as SQL text.

``lineitem`` stands for counted reads (sample = supplier, count = quantity, read = order and line, whose keys repeat) and for alignments;
``supplier`` for sample settings; ``documents`` and ``events`` for sequences and qualities.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.brackets import expand_settings
from ..operators import ranges

RANGES, FLOORS, PEAKS = "[0-13][14-35][36-NA]", "[3][0.5][NA]", "[2][1][2]"


def scratch(spark: SparkSession, label: str) -> str:
    """A new folder name that every executor reaches: in ``spark.checkpoint.dir``, or in the temporary folder of a local master's one machine."""
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        own = tempfile.mkdtemp(prefix="strandlake-queries-")
        atexit.register(shutil.rmtree, own, ignore_errors=True)
        found = f"file://{own}"
    return f"{found.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles to so many digits, for comparison by value."""
    return df.select(*(F.round(c, digits).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes))


def counted_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "lineitem")
    return df.select(
        F.concat(F.lit("s"), F.col("l_suppkey").cast("string")).alias("file_stem"),
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("qname"),
        F.col("l_partkey").alias("read_index"),
        F.col("l_quantity").alias("repeat_count"),
        F.col("l_quantity").alias("repeat_count_full"),
        (F.col("l_quantity") - F.col("l_linenumber") % 3).cast("int").alias("repeat_count_match"),
        F.col("l_linenumber").alias("cluster_number"),
        (40 + F.col("l_linenumber") + F.when(F.col("l_partkey") % 17 == 0, 30).otherwise(0)).alias("flank_total"),
    )


READS_SQL = """
reads AS (
  SELECT 's' || l_suppkey AS file_stem, l_orderkey || '-' || l_linenumber AS qname, l_partkey AS read_index, l_quantity AS repeat_count,
         l_quantity AS repeat_count_full, CAST(l_quantity - l_linenumber % 3 AS INTEGER) AS repeat_count_match, l_linenumber AS cluster_number,
         40 + l_linenumber + CASE WHEN l_partkey % 17 = 0 THEN 30 ELSE 0 END AS flank_total
  FROM lineitem
)"""


def settings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The settings table of all suppliers (text, as a file would have it)."""
    key = F.col("s_suppkey")
    return table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("s"), key.cast("string")).alias("file_stem"),
        F.lit(RANGES).alias("analysis_ranges"), F.lit(FLOORS).alias("floor"), F.lit(PEAKS).alias("max_peaks"),
        F.concat(F.lit("n"), F.col("s_nationkey").cast("string")).alias("group"),
        F.when(key % 3 == 0, "TRUE").when(key % 3 == 1, "FALSE").alias("group_control_sample"),
        (key % 4).cast("double").alias("time"),
        F.when(key % 11 == 0, "1").alias("exclude"),
    )


META_SQL = """
meta AS (
  SELECT 's' || s_suppkey AS file_stem, 'n' || s_nationkey AS "group", CASE s_suppkey % 3 WHEN 0 THEN 'TRUE' WHEN 1 THEN 'FALSE' END AS group_control_sample,
         CAST(s_suppkey % 4 AS DOUBLE) AS time, CASE WHEN s_suppkey % 11 = 0 THEN '1' END AS exclude
  FROM supplier
)"""


def range_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(frequency table, bounded ranges) of the counted reads."""
    counts = ranges.sample_counts(counted_reads(spark, sf_dir))
    bounded = ranges.range_bounds(expand_settings(settings(spark, sf_dir)), counts)
    return ranges.length_freq(counts, bounded), bounded


FREQ_SQL = (
    READS_SQL
    + """,
counts AS (SELECT file_stem, CAST(repeat_count AS DOUBLE) AS length, count(*) AS freq FROM reads GROUP BY ALL),
ranges AS (
  SELECT 's' || s_suppkey AS file_stem, r.* FROM supplier CROSS JOIN
    (VALUES ('range1', 0.0, 13.0, 3.0, 2), ('range2', 14.0, 35.0, 0.5, 1), ('range3', 36.0, NULL, NULL, 2)) AS r(analysis_range_name, window_min, window_max, floor, max_peaks)
),
bounded AS (
  SELECT r.*, CAST(coalesce(window_min, mn) AS DOUBLE) AS range_min, CAST(coalesce(window_max, mx) AS DOUBLE) AS range_max FROM ranges r
  LEFT JOIN (SELECT file_stem, min(length) AS mn, max(length) AS mx FROM counts GROUP BY 1) USING (file_stem)
),
freq AS (
  SELECT b.file_stem, b.analysis_range_name, c.length, c.freq, CAST(b.floor AS DOUBLE) AS floor, b.max_peaks FROM counts c JOIN bounded b
  ON c.file_stem = b.file_stem AND c.length BETWEEN b.range_min AND b.range_max
),
tops AS (SELECT *, max(freq) OVER (PARTITION BY file_stem, analysis_range_name) AS top FROM freq),
floored AS (SELECT *, CASE WHEN floor < 1 THEN floor * top ELSE floor END AS threshold FROM tops
            WHERE floor IS NULL OR freq >= CASE WHEN floor < 1 THEN floor * top ELSE floor END)"""
)

SUMMARY_SQL = (
    FREQ_SQL
    + """,
totals AS (SELECT file_stem, analysis_range_name, CAST(sum(freq) AS BIGINT) AS n_total, max(length) AS only_length FROM freq GROUP BY 1, 2),
moded AS (
  SELECT *, first_value(length) OVER (PARTITION BY file_stem, analysis_range_name ORDER BY freq DESC, length) AS mode,
         row_number() OVER (PARTITION BY file_stem, analysis_range_name ORDER BY freq, length) AS i,
         CAST(sum(freq) OVER w AS DOUBLE) AS n, sum(length * freq) OVER w / sum(freq) OVER w AS mean
  FROM floored WINDOW w AS (PARTITION BY file_stem, analysis_range_name)
),
each AS (SELECT file_stem, analysis_range_name, unnest(list_transform(range(0, freq), lambda k: length)) AS x FROM floored),
quant AS (
  SELECT file_stem, analysis_range_name, quantile_cont(x, 0.05) AS q05, quantile_cont(x, 0.25) AS q25, quantile_cont(x, 0.5) AS q50,
         quantile_cont(x, 0.75) AS q75, quantile_cont(x, 0.95) AS q95 FROM each GROUP BY 1, 2
),
stats AS (
  SELECT file_stem, analysis_range_name, max(mode) AS modal_length, max(freq) AS modal_frequency, max(mean) AS mean_length, min(length) AS min_length,
         max(length) AS max_length, CAST(sum(freq) AS BIGINT) AS n_used, count(*) AS n_rows, avg(freq) AS mean_freq,
         sum((length - mean) ** 2 * freq) AS m2, sum((length - mean) ** 3 * freq) AS m3, sum((length - mean) ** 4 * freq) AS m4, sum((2 * i - 1) * freq) AS ranked,
         CAST(sum(CASE WHEN length < mode THEN freq ELSE 0 END) AS BIGINT) AS below, CAST(sum(CASE WHEN length > mode THEN freq ELSE 0 END) AS BIGINT) AS above,
         sum(-(freq / n) * ln(freq / n + 1e-10)) AS entropy
  FROM moded GROUP BY 1, 2
),
summary AS (
  SELECT b.file_stem, b.analysis_range_name, b.floor AS floor_set, coalesce(n_total, 0) AS n_reads_total, only_length, s.*, q.* FROM bounded b
  LEFT JOIN totals t ON t.file_stem = b.file_stem AND t.analysis_range_name = b.analysis_range_name
  LEFT JOIN (SELECT file_stem AS f1, analysis_range_name AS a1, * EXCLUDE (file_stem, analysis_range_name) FROM stats) s ON f1 = b.file_stem AND a1 = b.analysis_range_name
  LEFT JOIN (SELECT file_stem AS f2, analysis_range_name AS a2, * EXCLUDE (file_stem, analysis_range_name) FROM quant) q ON f2 = b.file_stem AND a2 = b.analysis_range_name
),
named AS (
  SELECT file_stem, analysis_range_name, CASE WHEN n_reads_total = 1 THEN only_length ELSE modal_length END AS modal_length,
         CASE WHEN n_reads_total = 1 THEN only_length ELSE mean_length END AS mean_length, CASE WHEN n_reads_total = 1 THEN only_length ELSE q50 END AS median_length FROM summary
)"""
)


def alignment_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    odd = F.col("l_linenumber") % 2 == 1
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("file_stem"), F.col("l_orderkey").cast("string").alias("qname"), F.when(odd, "L").otherwise("R").alias("rname"), F.lit("locus").alias("ref_id"),
        F.when(odd, "left").otherwise("right").alias("ref_flank"), F.when(F.col("l_linestatus") == "O", "+").otherwise("-").alias("strand"),
        F.round(F.col("l_tax") * 100).cast("int").alias("mapq"), F.col("l_quantity").cast("int").alias("alignment_length_on_ref"), F.col("l_partkey").cast("int").alias("ref_start"),
        F.col("l_suppkey").cast("int").alias("query_start"), (F.col("l_suppkey") + F.col("l_quantity") - 1).cast("int").alias("query_end"), F.round(F.col("l_discount") * 100).cast("int").alias("mismatches"),
        F.concat(F.col("l_linenumber").cast("string"), F.lit("S"), F.col("l_quantity").cast("int").cast("string"), F.lit("M2I"), F.col("l_linenumber").cast("string"), F.lit("M1D3H")).alias("cigar"),
    )


ALIGN_SQL = """
aln AS (
  SELECT l_returnflag AS file_stem, CAST(l_orderkey AS VARCHAR) AS qname, CASE WHEN l_linenumber % 2 = 1 THEN 'L' ELSE 'R' END AS rname, 'locus' AS ref_id,
         CASE WHEN l_linenumber % 2 = 1 THEN 'left' ELSE 'right' END AS ref_flank, CASE WHEN l_linestatus = 'O' THEN '+' ELSE '-' END AS strand,
         CAST(round(l_tax * 100) AS INTEGER) AS mapq, CAST(l_quantity AS INTEGER) AS alignment_length_on_ref, CAST(l_partkey AS INTEGER) AS ref_start,
         CAST(l_suppkey AS INTEGER) AS query_start, CAST(l_suppkey + l_quantity - 1 AS INTEGER) AS query_end, CAST(round(l_discount * 100) AS INTEGER) AS mismatches,
         l_linenumber || 'S' || CAST(l_quantity AS INTEGER) || 'M2I' || l_linenumber || 'M1D3H' AS cigar
  FROM lineitem
)"""

DUAL_SQL = (
    ALIGN_SQL
    + """,
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY file_stem, qname, ref_id, rname ORDER BY mapq DESC, alignment_length_on_ref DESC, ref_start, cigar) AS best,
         min(rname) OVER w <> max(rname) OVER w AS both_flanks FROM aln WINDOW w AS (PARTITION BY file_stem, qname, ref_id)
),
picked AS (SELECT * FROM ranked WHERE both_flanks AND best = 1),
dual AS (SELECT * EXCLUDE (best, both_flanks) FROM picked QUALIFY min(strand) OVER (PARTITION BY file_stem, qname, ref_id) = max(strand) OVER (PARTITION BY file_stem, qname, ref_id)),
flanked AS (
  SELECT *, count(*) OVER w AS n, first_value(ref_flank) OVER (PARTITION BY file_stem, qname, ref_id ORDER BY query_start, query_end) = 'left' AND
         first_value(ref_flank) OVER (PARTITION BY file_stem, qname, ref_id ORDER BY query_start DESC, query_end DESC) = 'right' AS ok FROM dual WINDOW w AS (PARTITION BY file_stem, qname, ref_id)
)"""
)


def segment_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two alignments for each order around a made-up sequence."""
    o = table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    seq = F.concat(F.repeat(F.lit("AC"), (5 + key % 7).cast("int")), F.repeat(F.lit("CAG"), (key % 40).cast("int")), F.repeat(F.lit("GGT"), (6 + key % 5).cast("int")))
    base = o.select(F.col("o_orderpriority").alias("file_stem"), key.cast("string").alias("qname"), F.lit("locus").alias("ref_id"), seq.alias("query_sequence"), key.alias("k"))
    end1, n = (10 + (F.col("k") % 7) * 2).cast("int"), F.length("query_sequence")
    start1, start2 = (1 + F.col("k") % 3).cast("int"), (n - (18 + (F.col("k") % 5) * 3) + 1).cast("int")
    left = base.select("file_stem", "qname", "ref_id", "query_sequence", F.lit("left").alias("ref_flank"), start1.alias("query_start"), end1.alias("query_end"))
    right = base.select("file_stem", "qname", "ref_id", "query_sequence", F.lit("right").alias("ref_flank"), start2.alias("query_start"), (n - F.col("k") % 2).cast("int").alias("query_end"))
    return left.unionByName(right)


SEGMENT_SQL = """
base AS (
  SELECT o_orderpriority AS file_stem, CAST(o_orderkey AS VARCHAR) AS qname, o_orderkey AS k,
         repeat('AC', 5 + o_orderkey % 7) || repeat('CAG', o_orderkey % 40) || repeat('GGT', 6 + o_orderkey % 5) AS seq FROM orders
),
placed AS (
  SELECT *, length(seq) AS n, 1 + k % 3 AS s1, 10 + k % 7 * 2 AS e1, length(seq) - (18 + k % 5 * 3) + 1 AS s2, length(seq) - k % 2 AS e2 FROM base
),
split AS (
  SELECT file_stem, qname, seq, n, k,
         CASE WHEN s1 > 1 THEN nullif(substr(seq, 1, s1 - 1), '') END AS pre, nullif(substr(seq, s1, e1 - s1 + 1), '') AS "left",
         CASE WHEN s2 > e1 THEN nullif(substr(seq, e1 + 1, s2 - e1 - 1), '') END AS mid, nullif(substr(seq, s2, e2 - s2 + 1), '') AS "right",
         CASE WHEN e2 < n THEN nullif(substr(seq, e2 + 1, n - e2), '') END AS post
  FROM placed
)"""
