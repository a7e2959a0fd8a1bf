"""One query for each operator of the inventory, on the test tables, with its SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import brackets, sequence
from ..operators import aligner, alignments, clusters, consensus, ranges, reads, repeats
from ..sources import catalog, sequences, sinks, tables
from . import exports, plotdata
from .bindings import (
    ALIGN_SQL,
    DUAL_SQL,
    FREQ_SQL,
    META_SQL,
    RANGES,
    READS_SQL,
    SEGMENT_SQL,
    SUMMARY_SQL,
    alignment_rows,
    counted_reads,
    range_tables,
    rounded,
    scratch,
    segment_rows,
    settings,
    table,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a query under its function's name; its doubles are rounded."""

    def put(f: Query) -> Query:
        QUERIES[f.__name__] = lambda spark, sf_dir: rounded(f(spark, sf_dir))
        if sql:
            SQL[f.__name__] = sql
        return f

    return put


def r(*names: str) -> str:
    return ", ".join(f"round({n.split(' AS ')[0]}, 6) AS {n.split(' AS ')[-1]}" for n in names)


# ---- range analysis -------------------------------------------------------------------------------------------------

_DIST = """SELECT file_stem, analysis_range_name,
  round(CASE WHEN one THEN only_length ELSE modal_length END, 6) AS modal_length, CASE WHEN one THEN 1 ELSE modal_frequency END AS modal_frequency,
  round(CASE WHEN one THEN only_length ELSE mean_length END, 6) AS mean_length, round(CASE WHEN NOT one THEN mean_length - modal_length END, 6) AS mean_to_modal_difference,
  round(CASE WHEN one THEN only_length ELSE q50 END, 6) AS median_length, round(CASE WHEN NOT one THEN min_length END, 6) AS min_length,
  round(CASE WHEN NOT one THEN max_length END, 6) AS max_length, round(CASE WHEN NOT one THEN max_length - min_length END, 6) AS range_length,
  round(CASE WHEN NOT one AND n_used > 1 THEN sqrt(m2 / (n_used - 1)) END, 6) AS sd, round(CASE WHEN NOT one AND n_used > 1 THEN sqrt(m2 / (n_used - 1)) / sqrt(n_used) END, 6) AS sem,
  round(CASE WHEN NOT one AND n_used > 1 AND mean_length <> 0 THEN sqrt(m2 / (n_used - 1)) / mean_length END, 6) AS coefficient_of_variation,
  round(CASE WHEN NOT one THEN q75 - q25 END, 6) AS interquartile_range, round(CASE WHEN NOT one THEN q05 END, 6) AS percentile_5th, round(CASE WHEN NOT one THEN q95 END, 6) AS percentile_95th,
  round(CASE WHEN NOT one THEN m3 / n_used / nullif((m2 / n_used) ** 1.5, 0) END, 6) AS skewness, round(CASE WHEN NOT one THEN m4 / n_used / nullif((m2 / n_used) ** 2, 0) END, 6) AS kurtosis,
  round(CASE WHEN NOT one THEN (ranked - n_rows * n_used) / CAST(n_rows * n_used AS DOUBLE) END, 6) AS gini_coefficient, CASE WHEN one THEN 1 ELSE n_used END AS n_reads_analysed,
  CASE WHEN NOT one THEN below END AS reads_below_modal, CASE WHEN NOT one THEN above END AS reads_above_modal,
  round(CASE WHEN NOT one THEN below / CAST(n_used AS DOUBLE) END, 6) AS contraction_proportion, round(CASE WHEN NOT one THEN above / CAST(n_used AS DOUBLE) END, 6) AS expansion_proportion,
  round(CASE WHEN NOT one THEN (above / CAST(n_used AS DOUBLE) - below / CAST(n_used AS DOUBLE)) / nullif(above / CAST(n_used AS DOUBLE) + below / CAST(n_used AS DOUBLE), 0) END, 6) AS tail_balance,
  round(CASE WHEN NOT one THEN below / CAST(modal_frequency AS DOUBLE) END, 6) AS contraction_to_modal_ratio, round(CASE WHEN NOT one THEN above / CAST(modal_frequency AS DOUBLE) END, 6) AS expansion_to_modal_ratio,
  round(CASE WHEN NOT one THEN (above - below) / nullif(CAST(above + below AS DOUBLE), 0) END, 6) AS tail_modal_balance,
  round(CASE WHEN NOT one AND n_rows > 1 THEN entropy / ln(n_rows) END, 6) AS entropy_normalised, round(CASE WHEN NOT one THEN modal_frequency / mean_freq END, 6) AS peak_sharpness,
  round(CAST(CASE WHEN n_reads_total > 1 AND n_used IS NULL AND floor_set < 1 THEN NULL ELSE floor_set END AS DOUBLE), 6) AS floor_threshold, n_reads_total,
  CASE WHEN n_reads_total = 0 THEN NULL WHEN one THEN 1 ELSE coalesce(n_used, 0) END AS n_reads_used
FROM (SELECT *, n_reads_total = 1 AS one FROM summary)"""


@query(f"WITH {SUMMARY_SQL} {_DIST}")
def a28_distribution_summary(spark, sf_dir):
    freq, bounded = range_tables(spark, sf_dir)
    return ranges.distribution_summary(freq, bounded)


@query(f"WITH {FREQ_SQL} SELECT file_stem, analysis_range_name, length, freq FROM freq")
def j5_range_join(spark, sf_dir):
    return range_tables(spark, sf_dir)[0].select("file_stem", "analysis_range_name", "length", "freq")


@query(f"WITH {FREQ_SQL} SELECT file_stem, analysis_range_name, length, freq, round(threshold, 6) AS floor_threshold FROM floored")
def p8_floor(spark, sf_dir):
    return ranges.floored(range_tables(spark, sf_dir)[0]).select("file_stem", "analysis_range_name", "length", "freq", "floor_threshold")


_PEAKS = f"""WITH {FREQ_SQL},
seen AS (
  SELECT *, lag(freq) OVER o AS before, lead(freq) OVER o AS after, count(*) OVER (PARTITION BY file_stem, analysis_range_name) AS n FROM floored
  WINDOW o AS (PARTITION BY file_stem, analysis_range_name ORDER BY length)
),
tips AS (SELECT *, coalesce(freq > before AND freq > after AND n >= 3, false) AS peak FROM seen),
rated AS (
  SELECT *, bool_or(peak) OVER (PARTITION BY file_stem, analysis_range_name) AS any_peak,
         row_number() OVER (PARTITION BY file_stem, analysis_range_name ORDER BY peak DESC, freq DESC, length) AS peak_rank FROM tips
),
best AS (SELECT * FROM rated WHERE (any_peak AND peak AND peak_rank <= max_peaks) OR (NOT any_peak AND peak_rank = 1)),
peaks AS (
  SELECT b.file_stem, b.analysis_range_name, p.length AS modal_length, p.freq AS modal_frequency, CAST(p.peak_rank AS INTEGER) AS peak_rank FROM bounded b
  LEFT JOIN best p ON p.file_stem = b.file_stem AND p.analysis_range_name = b.analysis_range_name
)"""


@query(f"{_PEAKS} SELECT * FROM peaks")
def a27_modal_peaks(spark, sf_dir):
    return ranges.modal_peaks(*range_tables(spark, sf_dir))


@query(
    f"""{_PEAKS} SELECT file_stem, analysis_range_name, max(CASE WHEN peak_rank = 1 THEN modal_length END) AS peak1_length, max(CASE WHEN peak_rank = 1 THEN modal_frequency END) AS peak1_frequency,
    max(CASE WHEN peak_rank = 2 THEN modal_length END) AS peak2_length, max(CASE WHEN peak_rank = 2 THEN modal_frequency END) AS peak2_frequency FROM peaks GROUP BY 1, 2"""
)
def u5_peaks_wide(spark, sf_dir):
    return ranges.peaks_wide(ranges.modal_peaks(*range_tables(spark, sf_dir)), 2)


@query(
    f"""WITH {FREQ_SQL}, seen AS (SELECT file_stem, analysis_range_name, min(length) AS observed_min, max(length) AS observed_max, CAST(sum(freq) AS BIGINT) AS n FROM freq GROUP BY 1, 2)
    SELECT b.file_stem, b.analysis_range_name, CAST(window_min AS DOUBLE) AS settings_min, CAST(window_max AS DOUBLE) AS settings_max, range_min, range_max, observed_min, observed_max, coalesce(n, 0) AS n_reads
    FROM bounded b LEFT JOIN seen s ON s.file_stem = b.file_stem AND s.analysis_range_name = b.analysis_range_name"""
)
def a32_range_boundaries(spark, sf_dir):
    freq, bounded = range_tables(spark, sf_dir)
    return ranges.range_boundaries(bounded, freq)


def _controls(spark, sf_dir, selection="flagged"):
    summary = a28_distribution_summary(spark, sf_dir)
    meta = settings(spark, sf_dir).select("file_stem", "group", "group_control_sample", "time", "exclude")
    return summary, meta, ranges.control_samples(summary, meta, "median_length", selection)


_PICKED = f"""WITH {SUMMARY_SQL}, {META_SQL},
eligible AS (SELECT n.*, "group", group_control_sample, time FROM named n JOIN meta USING (file_stem) WHERE exclude IS NULL AND median_length IS NOT NULL AND "group" IS NOT NULL)"""
_CONTROLS = f"""{_PICKED},
controls AS (
  SELECT "group", analysis_range_name, median(median_length) AS control_setpoint, stddev_samp(median_length) AS control_sd, stddev_samp(median_length) / sqrt(count(*)) AS control_sem, count(*) AS control_n,
         median(modal_length) AS control_modal_length, median(mean_length) AS control_mean_length, median(median_length) AS control_median_length
  FROM eligible WHERE group_control_sample = 'TRUE' GROUP BY 1, 2
)"""


@query(f"""{_PICKED} SELECT file_stem, analysis_range_name, "group", round(median_length, 6) AS median_length FROM eligible WHERE group_control_sample = 'TRUE'""")
def p10_control_samples(spark, sf_dir):
    return _controls(spark, sf_dir)[2].select("file_stem", "analysis_range_name", "group", "median_length")


@query(f"""{_PICKED} SELECT file_stem, analysis_range_name, "group", time FROM eligible QUALIFY time = min(time) OVER (PARTITION BY "group", analysis_range_name)""")
def w13_earliest_controls(spark, sf_dir):
    return _controls(spark, sf_dir, "earliest")[2].select("file_stem", "analysis_range_name", "group", "time")


@query(f"""{_CONTROLS} SELECT "group", analysis_range_name, {r("control_setpoint", "control_sd", "control_sem", "control_modal_length", "control_mean_length", "control_median_length")}, control_n FROM controls""")
def a30_control_setpoints(spark, sf_dir):
    return ranges.control_setpoints(_controls(spark, sf_dir)[2], "median_length", "median")


@query(
    f"""{_PICKED}, placed AS (SELECT *, row_number() OVER (PARTITION BY "group", analysis_range_name ORDER BY median_length, file_stem) AS i, count(*) OVER (PARTITION BY "group", analysis_range_name) AS n FROM eligible)
    SELECT "group", analysis_range_name, round(avg(CASE WHEN i > floor(n * 0.1) AND i <= n - floor(n * 0.1) THEN median_length END), 6) AS control_setpoint, round(stddev_samp(median_length), 6) AS control_sd,
    round(stddev_samp(median_length) / sqrt(count(*)), 6) AS control_sem, count(*) AS control_n FROM placed GROUP BY 1, 2"""
)
def a30_trimmed_mean(spark, sf_dir):
    return ranges.control_setpoints(_controls(spark, sf_dir, "all")[2], "median_length", "trimmed_mean").select("group", "analysis_range_name", "control_setpoint", "control_sd", "control_sem", "control_n")


@query(
    f"""{_CONTROLS},
own AS (SELECT n.*, c.control_setpoint, c.control_sd FROM named n LEFT JOIN meta m USING (file_stem) LEFT JOIN controls c ON c."group" = m."group" AND c.analysis_range_name = n.analysis_range_name WHERE median_length IS NOT NULL),
points AS (
  SELECT *, 'sample_relative' AS setpoint_type, median_length AS s FROM own
  UNION ALL SELECT *, 'control_relative', control_setpoint FROM own WHERE control_setpoint IS NOT NULL
),
lim AS (SELECT file_stem, analysis_range_name, CAST(sum(freq) AS BIGINT) AS n_reads_total, max(freq) AS top, max(floor) AS floor FROM freq GROUP BY 1, 2),
st AS (
  SELECT p.file_stem, p.analysis_range_name, p.setpoint_type, sum(freq * (length - s)) / sum(freq) AS instability_index,
    sum(CASE WHEN length > s THEN freq * (length - s) END) / nullif(sum(CASE WHEN length > s THEN freq END), 0) AS expansion_index,
    sum(CASE WHEN length < s THEN freq * (length - s) END) / nullif(sum(CASE WHEN length < s THEN freq END), 0) AS contraction_index,
    CAST(coalesce(sum(CASE WHEN length = round_even(s, 0) THEN freq END), 0) AS BIGINT) AS mid, CAST(coalesce(sum(CASE WHEN length < round_even(s, 0) THEN freq END), 0) AS BIGINT) AS low,
    CAST(coalesce(sum(CASE WHEN length > round_even(s, 0) THEN freq END), 0) AS BIGINT) AS high, CAST(sum(freq) AS BIGINT) AS used
  FROM points p JOIN floored f ON f.file_stem = p.file_stem AND f.analysis_range_name = p.analysis_range_name GROUP BY 1, 2, 3
)
SELECT p.file_stem, p.analysis_range_name, p.setpoint_type, round(s, 6) AS setpoint_repeat_length, {r("instability_index", "expansion_index", "contraction_index")},
  mid AS reads_at_setpoint, low AS reads_below_setpoint, high AS reads_above_setpoint, round(CASE WHEN mid > 0 THEN low / CAST(mid AS DOUBLE) END, 6) AS contraction_ratio,
  round(CASE WHEN mid > 0 THEN high / CAST(mid AS DOUBLE) END, 6) AS expansion_ratio, round(CASE WHEN mid > 0 THEN (low + high) / CAST(mid AS DOUBLE) END, 6) AS total_tail_ratio,
  round(CASE WHEN low > 0 THEN CASE WHEN mid > 0 THEN (high / CAST(mid AS DOUBLE)) / (low / CAST(mid AS DOUBLE)) END WHEN high > 0 THEN CAST('Infinity' AS DOUBLE) END, 6) AS expansion_vs_contraction_balance,
  round(CASE WHEN floor < 1 THEN floor * top ELSE floor END, 6) AS floor_threshold, n_reads_total, coalesce(used, 0) AS n_reads_used,
  round(CASE WHEN p.setpoint_type = 'control_relative' THEN control_sd END, 6) AS control_sd,
  round(CASE WHEN p.setpoint_type = 'control_relative' AND control_sd > 0 THEN (median_length - control_setpoint) / control_sd END, 6) AS z_score,
  round(modal_length - s, 6) AS modal_diff, round(median_length - s, 6) AS median_diff, round(mean_length - s, 6) AS mean_diff
FROM points p JOIN lim l ON l.file_stem = p.file_stem AND l.analysis_range_name = p.analysis_range_name
LEFT JOIN st ON st.file_stem = p.file_stem AND st.analysis_range_name = p.analysis_range_name AND st.setpoint_type = p.setpoint_type"""
)
def a29_instability(spark, sf_dir):
    summary, meta, picked = _controls(spark, sf_dir)
    points = ranges.setpoints(summary, meta, ranges.control_setpoints(picked))
    return ranges.instability(range_tables(spark, sf_dir)[0], points)


@query('WITH ' + META_SQL + ' SELECT "group", time, count(*) AS n FROM meta GROUP BY 1, 2')
def a33_experiment_map(spark, sf_dir):
    return plotdata.experiment_map(settings(spark, sf_dir))


@query(
    f"""WITH {SUMMARY_SQL} SELECT file_stem, analysis_range_name, metric, round(value, 6) AS value FROM (
    SELECT file_stem, analysis_range_name, 'mean_length' AS metric, mean_length AS value FROM named UNION ALL SELECT file_stem, analysis_range_name, 'median_length', median_length FROM named
    UNION ALL SELECT file_stem, analysis_range_name, 'modal_length', modal_length FROM named)"""
)
def u6_unpivot_metrics(spark, sf_dir):
    return plotdata.long_metrics(a28_distribution_summary(spark, sf_dir), ["modal_length", "mean_length", "median_length"])


@query(
    f"""WITH {SUMMARY_SQL} SELECT analysis_range_name, {r("regr_slope(mean_length, modal_length) AS slope", "regr_intercept(mean_length, modal_length) AS intercept", "regr_r2(mean_length, modal_length) AS r2")},
    CAST(regr_count(mean_length, modal_length) AS BIGINT) AS n FROM named GROUP BY 1"""
)
def a17_regression(spark, sf_dir):
    return plotdata.regression(a28_distribution_summary(spark, sf_dir), "modal_length", "mean_length", ("analysis_range_name",))


@query(f"WITH {FREQ_SQL} SELECT file_stem, analysis_range_name, length, freq, round(freq / sum(freq) OVER (PARTITION BY file_stem, analysis_range_name), 6) AS share FROM freq")
def a37_tagged_density(spark, sf_dir):
    return plotdata.tagged_density(range_tables(spark, sf_dir)[0]).select("file_stem", "analysis_range_name", "length", "freq", "share")


# ---- settings language ----------------------------------------------------------------------------------------------

_TEXTS = ["[0-35][36-NA]", "0-35", "[5-9]", "[NA-12][13-20][21-40][41-NA]"]


@query(
    """SELECT text, CAST(i AS INTEGER) AS i, CASE WHEN split_part(p, '-', 1) = 'NA' THEN NULL ELSE CAST(split_part(p, '-', 1) AS DOUBLE) END AS "min", CASE WHEN split_part(p, '-', 2) = 'NA' THEN NULL ELSE CAST(split_part(p, '-', 2) AS DOUBLE) END AS "max"
    FROM (SELECT text, unnest(parts) AS p, unnest(range(0, len(parts))) AS i FROM (SELECT text, CASE WHEN contains(text, '[') THEN regexp_extract_all(text, '\\[([^\\[\\]]+)\\]', 1) ELSE [text] END AS parts
    FROM (VALUES ('[0-35][36-NA]'), ('0-35'), ('[5-9]'), ('[NA-12][13-20][21-40][41-NA]')) AS t(text)))"""
)
def f12_parse_ranges(spark, sf_dir):
    df = spark.createDataFrame([(t,) for t in _TEXTS], "text string")
    return df.select("text", F.posexplode(brackets.parse_ranges(F.col("text"))).alias("i", "x")).select("text", "i", "x.min", "x.max")


@query("SELECT * FROM (VALUES ('[3][3]', 0, 3.0::DOUBLE), ('[3][3]', 1, 3.0), ('[0.05][NA]', 0, 0.05), ('[0.05][NA]', 1, NULL), ('1', 0, 1.0)) AS t(text, i, value)")
def f13_parse_values(spark, sf_dir):
    df = spark.createDataFrame([("[3][3]",), ("[0.05][NA]",), ("1",)], "text string")
    return df.select("text", F.posexplode(brackets.parse_values(F.col("text"))).alias("i", "value"))


@query("SELECT CAST(i AS INTEGER) AS i, CAST(n AS INTEGER) AS n, 'range' || lpad(CAST(i AS VARCHAR), CAST(length(CAST(n AS VARCHAR)) AS INTEGER), '0') AS name FROM (SELECT unnest(range(1, 13)) AS i, 12 AS n)")
def f14_range_names(spark, sf_dir):
    df = spark.range(1, 13).select(F.col("id").cast("int").alias("i"), F.lit(12).alias("n"))
    return df.select("i", "n", brackets.range_name(F.col("i"), F.col("n")).alias("name"))


@query(f"WITH {FREQ_SQL} SELECT file_stem, analysis_range_name, CAST(window_min AS DOUBLE) AS window_min, CAST(window_max AS DOUBLE) AS window_max, CAST(floor AS DOUBLE) AS floor, CAST(max_peaks AS INTEGER) AS max_peaks FROM ranges")
def u9_expand_settings(spark, sf_dir):
    return brackets.expand_settings(settings(spark, sf_dir))


@query(f"WITH {READS_SQL} SELECT DISTINCT file_stem FROM reads EXCEPT SELECT 's' || s_suppkey FROM supplier WHERE s_suppkey % 5 <> 0")
def u2_except(spark, sf_dir):
    listed = table(spark, sf_dir, "supplier").filter("s_suppkey % 5 <> 0").select(F.concat(F.lit("s"), F.col("s_suppkey").cast("string")).alias("file_stem"))
    return counted_reads(spark, sf_dir).select("file_stem").subtract(listed)


@query(f"WITH {READS_SQL} SELECT file_stem, count(*) AS n FROM reads WHERE file_stem IN (SELECT 's' || s_suppkey FROM supplier WHERE s_suppkey % 5 <> 0) GROUP BY 1")
def p9_settings_filter(spark, sf_dir):
    listed = settings(spark, sf_dir).filter("analysis_ranges is not null").join(table(spark, sf_dir, "supplier").filter("s_suppkey % 5 <> 0").select(F.concat(F.lit("s"), F.col("s_suppkey").cast("string")).alias("file_stem")), "file_stem", "left_semi")
    return counted_reads(spark, sf_dir).join(listed, "file_stem", "left_semi").groupBy("file_stem").agg(F.count("*").alias("n"))


# ---- reads ----------------------------------------------------------------------------------------------------------


def _sequenced(spark, sf_dir):
    return counted_reads(spark, sf_dir).withColumn("sequence", F.repeat(F.lit("A"), F.col("repeat_count").cast("int")))


@query(f"WITH {READS_SQL} SELECT file_stem, qname, CAST(repeat_count AS INTEGER) AS length, read_index FROM reads QUALIFY row_number() OVER (PARTITION BY file_stem, qname ORDER BY repeat_count DESC, read_index) = 1")
def w1_longest_duplicate(spark, sf_dir):
    return reads.longest_per_name(_sequenced(spark, sf_dir)).select("file_stem", "qname", F.length("sequence").alias("length"), "read_index")


_ORDER_NAMES = "SELECT l_returnflag || l_linestatus AS file_stem, CAST(l_orderkey AS VARCHAR) AS qname FROM lineitem"
_MULTI = f"names AS (SELECT file_stem, qname, count(*) AS occurrences FROM ({_ORDER_NAMES}) GROUP BY 1, 2), tally AS (SELECT file_stem, occurrences, count(*) AS n_readnames FROM names GROUP BY 1, 2), multi AS (SELECT *, n_readnames / sum(n_readnames) OVER (PARTITION BY file_stem) AS proportion FROM tally)"


def _order_names(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(F.concat("l_returnflag", "l_linestatus").alias("file_stem"), F.col("l_orderkey").cast("string").alias("qname"))


@query(f"WITH {_MULTI} SELECT file_stem, occurrences, n_readnames, {r('proportion')} FROM multi")
def a1_name_multiplicity(spark, sf_dir):
    return reads.name_multiplicity(_order_names(spark, sf_dir))


@query(
    f"""WITH {_MULTI}, rate AS (SELECT file_stem, coalesce(sum(CASE WHEN occurrences > 1 THEN proportion END), 0) AS duplication_rate FROM multi GROUP BY 1)
    SELECT file_stem, {r("duplication_rate")}, coalesce(abs(duplication_rate - avg(duplication_rate) OVER ()) > 2 * stddev_samp(duplication_rate) OVER (), false) AS outlier FROM rate"""
)
def a2_duplication_rate(spark, sf_dir):
    return reads.duplication_rate(reads.name_multiplicity(_order_names(spark, sf_dir)))


@query(
    f"""WITH {READS_SQL}, a AS (SELECT file_stem, count(*) AS n_before FROM reads GROUP BY 1), b AS (SELECT file_stem, count(*) AS n FROM reads WHERE repeat_count > 20 GROUP BY 1)
    SELECT file_stem, n_before, coalesce(n, 0) AS n_after, n_before - coalesce(n, 0) AS n_lost, round(coalesce(n, 0) / n_before, 6) AS retained FROM a LEFT JOIN b USING (file_stem)"""
)
def a3_compare_read_counts(spark, sf_dir):
    rows = counted_reads(spark, sf_dir)
    return reads.compare_read_counts(rows, rows.filter("repeat_count > 20"))


def _quality(spark, sf_dir):
    return table(spark, sf_dir, "events").select(F.col("event_type").alias("file_stem"), F.col("event_id").cast("string").alias("qname"), F.col("props").alias("sequence"), F.col("props").alias("quality"))


_PHRED = "q AS (SELECT event_type AS file_stem, CAST(event_id AS VARCHAR) AS read_name, CAST(length(props) AS INTEGER) AS length, CAST(list_sum(list_transform(string_split(props, ''), lambda c: ascii(c) - 33)) AS BIGINT) AS phred_sum FROM events)"


@query(f"WITH {_PHRED} SELECT file_stem, read_name, length, phred_sum, round(phred_sum / length, 6) AS read_phred FROM q")
def f9_phred(spark, sf_dir):
    return reads.read_quality(_quality(spark, sf_dir))


@query(
    f"""WITH {_PHRED}, p AS (SELECT *, phred_sum / length AS read_phred FROM q)
    SELECT file_stem, count(*) AS n_reads, {r(*(f"{f}({c}) AS {n}_{c}" for c in ("length", "read_phred") for n, f in (("mean", "avg"), ("median", "median"), ("sd", "stddev_samp"))))} FROM p GROUP BY 1"""
)
def a4_quality_summary(spark, sf_dir):
    return reads.quality_summary(reads.read_quality(_quality(spark, sf_dir)))


@query(f"WITH {READS_SQL} SELECT file_stem, count(*) AS n_reads, round(avg(repeat_count), 6) AS mean_length FROM reads GROUP BY 1")
def a7_final_summary(spark, sf_dir):
    return reads.final_summary(_sequenced(spark, sf_dir))


@query(f"WITH {READS_SQL} SELECT file_stem, qname FROM (SELECT DISTINCT file_stem, qname FROM reads) QUALIFY row_number() OVER (PARTITION BY file_stem ORDER BY md5(qname || ':123'), qname) <= 50")
def o4_downsample(spark, sf_dir):
    return reads.downsample(counted_reads(spark, sf_dir).dropDuplicates(["file_stem", "qname"]), 50).select("file_stem", "qname")


_ADAPTERS = {"a": "CAGCAG", "b": "GGTGGT"}
_TRIM_SQL = f"""WITH {SEGMENT_SQL}, pats AS (SELECT * FROM (VALUES ('a', 'CAGCAG'), ('b', 'GGTGGT'), ('a_rc', 'CTGCTG'), ('b_rc', 'ACCACC')) AS t(name, pat)),
hits AS (
  SELECT file_stem, name, qname AS read_name, CAST(length(seq) AS INTEGER) AS read_length,
    len(list_filter(range(5, 8), lambda k: levenshtein("left"(seq, k), pat) <= 1)) > 0 AS l, len(list_filter(range(5, 8), lambda k: levenshtein("right"(seq, k), pat) <= 1)) > 0 AS rt FROM base CROSS JOIN pats
),
spans AS (SELECT *, CASE WHEN l THEN least(6, read_length) + 1 ELSE 1 END AS s, CASE WHEN rt THEN greatest(read_length - 6, 0) ELSE read_length END AS e0 FROM hits),
loc AS (
  SELECT file_stem, name AS trim_pattern_name, read_name, read_length, CAST(s AS INTEGER) AS start, CAST(greatest(e0, s - 1) AS INTEGER) AS "end", CAST(greatest(e0, s - 1) - s + 1 AS INTEGER) AS width FROM spans
),
sided AS (
  SELECT *, read_length - width AS trim_length, width < read_length AS trim, CASE WHEN start = 1 AND "end" < read_length THEN 'left' WHEN start > 1 AND "end" = read_length THEN 'right'
    WHEN start = 1 AND "end" = read_length THEN 'both' ELSE 'internal' END AS side FROM loc
)"""


def _trimmable(spark, sf_dir):
    rows = segment_rows(spark, sf_dir).filter("ref_flank = 'left'")
    return rows.select("file_stem", "qname", F.col("query_sequence").alias("sequence"), F.col("query_sequence").alias("quality"))


def _locations(spark, sf_dir):
    return reads.trim_locations(_trimmable(spark, sf_dir), _ADAPTERS, 1, True)


@query(f"{_TRIM_SQL} SELECT * FROM sided")
def f11_trim_locations(spark, sf_dir):
    return _locations(spark, sf_dir)


def _trim_steps() -> str:
    """CTEs k0 to k4: each adapter and complement trimmed off the ends of what the one before has left."""
    out = ["k0 AS (SELECT file_stem, qname, seq FROM base)"]
    for i, pattern in enumerate(reads.with_complements(_ADAPTERS).values()):
        n = len(pattern)
        hit = lambda end: f"len(list_filter(range({n - 1}, {n + 2}), lambda k: levenshtein(\"{end}\"(seq, k), '{pattern}') <= 1)) > 0"  # noqa: E731, B023
        out.append(f"h{i} AS (SELECT file_stem, qname, seq, CASE WHEN {hit('left')} THEN least({n}, length(seq)) + 1 ELSE 1 END AS s, CASE WHEN {hit('right')} THEN greatest(length(seq) - {n}, 0) ELSE length(seq) END AS e FROM k{i})")
        out.append(f"k{i + 1} AS (SELECT file_stem, qname, substr(seq, s, greatest(e - s + 1, 0)) AS seq FROM h{i})")
    return ", ".join(out)


@query(f"WITH {SEGMENT_SQL}, {_trim_steps()} SELECT file_stem, qname, seq AS sequence, seq AS quality FROM k4")
def f10_trim_reads(spark, sf_dir):
    return reads.trim_reads(_trimmable(spark, sf_dir), _ADAPTERS, 1, True)


@query(
    f"""{_TRIM_SQL}, n AS (SELECT file_stem, read_name, bool_or(trim) AS hit FROM sided GROUP BY 1, 2), t AS (SELECT file_stem, count(*) AS n_reads FROM n GROUP BY 1),
    b AS (SELECT file_stem, trim_pattern_name, CAST(sum(CASE WHEN trim THEN 1 ELSE 0 END) AS BIGINT) AS n_trimmed FROM sided GROUP BY 1, 2 UNION ALL SELECT file_stem, 'untrimmed', CAST(sum(CASE WHEN hit THEN 0 ELSE 1 END) AS BIGINT) FROM n GROUP BY 1)
    SELECT file_stem, trim_pattern_name, n_trimmed, n_reads, round(n_trimmed / n_reads, 6) AS proportion FROM b JOIN t USING (file_stem)"""
)
def a5_trim_by_adapter(spark, sf_dir):
    return reads.trim_by_adapter(_locations(spark, sf_dir))


@query(
    f"""{_TRIM_SQL} SELECT trim_pattern_name, side, count(*) AS n, round(median(trim_length), 6) AS median_trim_length, round(avg(trim_length), 6) AS mean_trim_length, round(stddev_samp(trim_length), 6) AS sd_trim_length,
    min(trim_length) AS min_trim_length, max(trim_length) AS max_trim_length, round(count(*) / (SELECT count(DISTINCT read_name) FROM sided), 6) AS proportion FROM sided WHERE trim GROUP BY 1, 2"""
)
def a6_trim_by_side(spark, sf_dir):
    return reads.trim_by_side(_locations(spark, sf_dir))


@query("SELECT doc_id, reverse(translate(text, 'ACGTUNRYSWKMBDHVacgtunryswkmbdhv', 'TGCAANYRSWMKVHDBtgcaanyrswmkvhdb')) AS turned FROM documents")
def f7_reverse_complement(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", sequence.reverse_complement(F.col("text")).alias("turned"))


@query(
    f"""WITH {ALIGN_SQL}, x AS (SELECT DISTINCT cigar, ref_start,
      CAST(coalesce(list_sum(list_transform(regexp_extract_all(cigar, '(\\d+)[MDN=X]', 1), lambda v: CAST(v AS INTEGER))), 0) AS INTEGER) AS w,
      CAST(coalesce(list_sum(list_transform(regexp_extract_all(cigar, '(\\d+)[MI=X]', 1), lambda v: CAST(v AS INTEGER))), 0) AS INTEGER) AS q,
      CAST(coalesce(list_sum(list_transform(regexp_extract_all(cigar, '(\\d+)I', 1), lambda v: CAST(v AS INTEGER))), 0) AS INTEGER) AS insertions,
      CAST(coalesce(list_sum(list_transform(regexp_extract_all(cigar, '(\\d+)D', 1), lambda v: CAST(v AS INTEGER))), 0) AS INTEGER) AS deletions,
      coalesce(CAST(nullif(regexp_extract(cigar, '^(\\d+)S', 1), '') AS INTEGER), 0) AS clip FROM aln)
    SELECT cigar, ref_start, ref_start + w - 1 AS ref_end, w AS alignment_length_on_ref, clip + 1 AS query_start, clip + q AS query_end, q AS alignment_length_on_query, insertions, deletions FROM x"""
)
def f8_cigar(spark, sf_dir):
    rows = alignment_rows(spark, sf_dir).select("cigar", "ref_start").distinct()
    return rows.select("cigar", "ref_start", *(v.alias(k) for k, v in sequence.cigar_columns(F.col("cigar"), F.col("ref_start")).items()))


@query(
    """SELECT doc_id, round(round_even(length(text) / 2.0, 0), 6) AS repeat_count_full, CAST(len(regexp_extract_all(text, 'an')) AS INTEGER) AS repeat_count_match,
    CASE WHEN len(regexp_extract_all(text, 'an')) = 0 THEN '0' ELSE array_to_string(list_transform(regexp_extract_all(text, '((?:an)+)', 1), lambda x: length(x) // 2), ',') END AS repeat_count_tracts FROM documents WHERE text <> ''"""
)
def f1_count_repeats(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").filter("text <> ''")
    return docs.select("doc_id", *(v.alias(k) for k, v in sequence.count_repeats(F.col("text"), "an").items()))


@query(
    """WITH t AS (SELECT item_id, regexp_replace(text, '[^ -~]', '', 'g') AS t FROM benchmark)
    SELECT a.item_id AS a, b.item_id AS b, CAST(levenshtein(a.t, b.t) AS INTEGER) AS lev,
    CAST(CASE WHEN length(a.t) = length(b.t) THEN list_sum(list_transform(range(1, length(a.t) + 1), lambda i: CASE WHEN substr(a.t, i, 1) <> substr(b.t, i, 1) THEN 1 ELSE 0 END)) ELSE levenshtein(a.t, b.t) END AS INTEGER) AS ham
    FROM t a JOIN t b ON b.item_id = a.item_id + 1"""
)
def f21_edit_distance(spark, sf_dir):
    b = table(spark, sf_dir, "benchmark").select("item_id", F.regexp_replace("text", "[^ -~]", "").alias("t"))
    pairs = b.alias("x").join(b.alias("y"), F.col("y.item_id") == F.col("x.item_id") + 1)
    return pairs.select(F.col("x.item_id").alias("a"), F.col("y.item_id").alias("b"), sequence.edit_distance(F.col("x.t"), F.col("y.t")).alias("lev"), sequence.edit_distance(F.col("x.t"), F.col("y.t"), "hamming").alias("ham"))


@query("SELECT item_id, regexp_replace(replace(upper(replace(text, 'ß', 's')), '-', ''), '[^ACGT]', 'N', 'g') AS cleaned FROM benchmark")
def f22_clean_consensus(spark, sf_dir):
    return table(spark, sf_dir, "benchmark").select("item_id", sequence.clean_consensus(F.upper(F.replace(F.col("text"), F.lit("ß"), F.lit("s")))).alias("cleaned"))


@query("SELECT o_orderkey, CASE WHEN k <= 30 THEN 1 WHEN k <= 50 THEN 3 WHEN k <= 100 THEN 5 WHEN k <= 200 THEN 10 WHEN k <= 500 THEN 20 WHEN k <= 1000 THEN 50 WHEN k <= 5000 THEN 100 ELSE 500 END AS step FROM (SELECT o_orderkey, o_custkey AS k FROM orders)")
def f24_axis_step(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", sequence.axis_step(F.col("o_custkey")).alias("step"))


@query(
    """SELECT item_id, regexp_extract(made, '(?s)^(.*?)[Nn]{5,}(.*)$', 1) AS left_flank, regexp_extract(made, '(?s)^(.*?)[Nn]{5,}(.*)$', 2) AS right_flank
    FROM (SELECT item_id, upper(regexp_replace(text, '[Nnß]', 'A', 'g')) || 'NNNNNNN' || upper(reverse(regexp_replace(text, '[Nnß]', 'A', 'g'))) AS made FROM benchmark)"""
)
def s8_reference_flanks(spark, sf_dir):
    clean = F.regexp_replace("text", "[Nnß]", "A")
    made = F.concat(F.upper(clean), F.lit("N" * 7), F.upper(F.reverse(clean)))
    left, right = sequence.split_reference(F.col("made"))
    return table(spark, sf_dir, "benchmark").select("item_id", made.alias("made")).select("item_id", left.alias("left_flank"), right.alias("right_flank"))


@query(
    """SELECT file_name, CASE WHEN file_name LIKE '%.gz' THEN 'fastq.gz' ELSE 'fastq' END AS file_format, regexp_replace(file_name, '\\.fastq(\\.gz)?$', '') AS file_stem, d AS paired_read_direction, coalesce(d = 'R1', true) AS include
    FROM (SELECT *, CASE WHEN contains(file_name, '_R1_') THEN 'R1' WHEN contains(file_name, '_R2_') THEN 'R2' END AS d FROM (
      SELECT 'sample' || n_nationkey || CASE n_nationkey % 3 WHEN 0 THEN '_R1_001' WHEN 1 THEN '_R2_001' ELSE '' END || '.fastq' || CASE WHEN n_nationkey % 2 = 0 THEN '.gz' ELSE '' END AS file_name FROM nation))"""
)
def s2_file_catalog(spark, sf_dir):
    key = F.col("n_nationkey")
    name = F.concat(F.lit("file:/data/sample"), key.cast("string"), F.when(key % 3 == 0, "_R1_001").when(key % 3 == 1, "_R2_001").otherwise(""), F.lit(".fastq"), F.when(key % 2 == 0, ".gz").otherwise(""))
    return catalog.catalog(table(spark, sf_dir, "nation").select(name.alias("file_path"))).select("file_name", "file_format", "file_stem", "paired_read_direction", "include")


@query(
    """SELECT count(*) AS n_files FROM (SELECT 'sample' || n_nationkey || CASE n_nationkey % 3 WHEN 0 THEN '_R1_001' WHEN 1 THEN '_R2_001' ELSE '' END AS stem FROM nation) WHERE NOT contains(stem, '_R2_')"""
)
def p1_include_filter(spark, sf_dir):
    return s2_file_catalog(spark, sf_dir).filter("include").agg(F.count("*").alias("n_files"))


# ---- alignments -----------------------------------------------------------------------------------------------------

_DUAL_COLUMNS = ("file_stem", "qname", "rname", "strand", "mapq", "alignment_length_on_ref", "query_start", "query_end")


def _dual(spark, sf_dir):
    return alignments.dual_flank(alignment_rows(spark, sf_dir))


@query(f"WITH {DUAL_SQL} SELECT {', '.join(_DUAL_COLUMNS)} FROM dual")
def m2_dual_flank(spark, sf_dir):
    return _dual(spark, sf_dir).select(*_DUAL_COLUMNS)


@query(f"WITH {DUAL_SQL} SELECT {', '.join(_DUAL_COLUMNS)} FROM flanked WHERE n = 2 AND ok")
def m3_ordered_flanks(spark, sf_dir):
    return alignments.ordered_flanks(_dual(spark, sf_dir)).select(*_DUAL_COLUMNS)


@query(
    f"""WITH {DUAL_SQL}, rd AS (SELECT DISTINCT file_stem, qname, ref_id, ok FROM flanked WHERE n = 2)
    SELECT file_stem, CAST(count(*) FILTER (WHERE ok) AS BIGINT) AS correct_order, CAST(count(*) FILTER (WHERE NOT ok) AS BIGINT) AS incorrect_order, count(*) AS total, round(count(*) FILTER (WHERE ok) / count(*), 6) AS retention_rate FROM rd GROUP BY 1"""
)
def a11_order_summary(spark, sf_dir):
    return alignments.order_summary(_dual(spark, sf_dir))


@query(f"WITH {ALIGN_SQL} SELECT file_stem, count(*) AS n_alignments, count(DISTINCT qname) AS n_reads, {r('avg(mapq) AS mean_mapq', 'avg(mismatches) AS mean_mismatches')} FROM aln GROUP BY 1")
def a8_alignment_summary(spark, sf_dir):
    return alignments.alignment_summary(alignment_rows(spark, sf_dir))


@query(f"WITH {ALIGN_SQL} SELECT file_stem, qname, ref_id, count(DISTINCT rname) AS n_flanks FROM aln GROUP BY 1, 2, 3")
def a9_flanks_per_read(spark, sf_dir):
    return alignments.flanks_per_read(alignment_rows(spark, sf_dir))


@query(
    f"""WITH {DUAL_SQL}, a AS (SELECT file_stem, count(DISTINCT qname) AS n_before FROM aln GROUP BY 1), b AS (SELECT file_stem, count(DISTINCT qname) AS n FROM dual GROUP BY 1)
    SELECT file_stem, n_before, coalesce(n, 0) AS n_after, n_before - coalesce(n, 0) AS n_lost, round(coalesce(n, 0) / n_before, 6) AS retained FROM a LEFT JOIN b USING (file_stem)"""
)
def a10_filtering_summary(spark, sf_dir):
    rows = alignment_rows(spark, sf_dir)
    return reads.compare_read_counts(rows.select("file_stem", "qname").distinct(), alignments.dual_flank(rows).select("file_stem", "qname").distinct())


@query(f"WITH {ALIGN_SQL}, s AS (SELECT file_stem, strand, count(DISTINCT qname) AS n_reads FROM aln GROUP BY 1, 2) SELECT *, round(n_reads / sum(n_reads) OVER (PARTITION BY file_stem), 6) AS proportion FROM s")
def a12_strand_summary(spark, sf_dir):
    return alignments.strand_summary(alignment_rows(spark, sf_dir))


@query(f"WITH {ALIGN_SQL} SELECT file_stem, ref_flank, count(*) AS n, {r('avg(alignment_length_on_ref) AS mean_length', 'median(alignment_length_on_ref) AS median_length', 'avg(mapq) AS mean_mapq', 'avg(mismatches) AS mean_mismatches')} FROM aln GROUP BY 1, 2")
def a13_flank_quality(spark, sf_dir):
    return alignments.flank_quality(alignment_rows(spark, sf_dir))


@query(f"WITH {SEGMENT_SQL} SELECT file_stem, qname, pre, \"left\", mid, \"right\", post FROM split")
def f6_split_segments(spark, sf_dir):
    return alignments.split_segments(segment_rows(spark, sf_dir)).select("file_stem", "qname", "pre", "left", "mid", "right", "post")


@query(f"WITH {SEGMENT_SQL} SELECT file_stem, count(*) AS n_reads, {r(*(f'avg(length(split.{s})) AS mean_{s}' for s in ('pre', 'left', 'mid', 'right', 'post')), 'median(length(mid)) AS median_mid')} FROM split GROUP BY 1".replace("split.left", 'split."left"').replace("split.right", 'split."right"'))
def a14_segment_summary(spark, sf_dir):
    return alignments.segment_summary(alignments.split_segments(segment_rows(spark, sf_dir)))


@query(f"WITH {READS_SQL} SELECT file_stem, qname, count(*) AS n FROM reads a WHERE NOT EXISTS (SELECT 1 FROM reads b WHERE b.repeat_count > 45 AND b.file_stem = a.file_stem AND b.qname = a.qname) GROUP BY 1, 2")
def p3_exclusions(spark, sf_dir):
    rows = counted_reads(spark, sf_dir)
    return alignments.exclude_reads(rows, rows.filter("repeat_count > 45")).groupBy("file_stem", "qname").agg(F.count("*").alias("n"))


@query("SELECT n_name, r_name FROM nation LEFT JOIN region ON n_regionkey = r_regionkey")
def j3_reference_join(spark, sf_dir):
    regions = table(spark, sf_dir, "region").select(F.col("r_regionkey").cast("string").alias("rname"), F.lit("locus").alias("ref_id"), F.col("r_name").alias("ref_flank"))
    rows = table(spark, sf_dir, "nation").select("n_name", F.col("n_regionkey").cast("string").alias("rname"))
    return alignments.with_reference(rows, regions).select("n_name", F.col("ref_flank").alias("r_name"))


@query(f"WITH {ALIGN_SQL} SELECT count(*) AS n FROM aln a WHERE EXISTS (SELECT 1 FROM (SELECT file_stem, qname FROM aln GROUP BY 1, 2 HAVING count(DISTINCT rname) = 2) b WHERE b.file_stem = a.file_stem AND b.qname = a.qname)")
def j4_semi_join(spark, sf_dir):
    rows = alignment_rows(spark, sf_dir)
    both = alignments.flanks_per_read(rows).filter("n_flanks = 2")
    return rows.join(both, list(alignments.READ), "left_semi").agg(F.count("*").alias("n"))


# ---- repeats --------------------------------------------------------------------------------------------------------


def _detected(spark, sf_dir):
    return repeats.detect_repeats(alignments.split_segments(segment_rows(spark, sf_dir)))


def _tract_sql(source: str, key: str, motif: str, least: int, perfect: int, gap: int = 6, tract_gap: int = 18) -> str:
    """CTEs that end in ``tract`` (key, seq, s, e, n): every tract of ``source`` (key, seq) by exact motifs, as gaps and islands of their places."""
    size, block = len(motif), motif * perfect
    return f"""pieces AS (SELECT {key}, seq, unnest(string_split(seq, '{motif}')) AS piece, generate_subscripts(string_split(seq, '{motif}'), 1) AS i FROM {source}),
motifs AS (SELECT *, sum(length(piece) + {size}) OVER (PARTITION BY {key} ORDER BY i) - {size} + 1 AS p, i = max(i) OVER (PARTITION BY {key}) AS tail FROM pieces),
marked AS (SELECT *, CASE WHEN p - lag(p) OVER (PARTITION BY {key} ORDER BY p) - {size} <= {gap} THEN 0 ELSE 1 END AS new FROM motifs WHERE NOT tail),
numbered AS (SELECT *, sum(new) OVER (PARTITION BY {key} ORDER BY p) AS run FROM marked),
runs AS (SELECT {key}, run, any_value(seq) AS seq, min(p) AS a, max(p) + {size} AS b, count(*) AS n FROM numbered GROUP BY {key}, run HAVING count(*) >= {least}),
near AS (SELECT *, CASE WHEN a - lag(b) OVER (PARTITION BY {key} ORDER BY a) <= {tract_gap} THEN 0 ELSE 1 END AS new FROM runs),
joined AS (SELECT *, sum(new) OVER (PARTITION BY {key} ORDER BY a) AS island FROM near),
islands AS (SELECT {key}, island, any_value(seq) AS seq, CAST(min(a) AS BIGINT) AS a, CAST(max(b) AS BIGINT) AS b, sum(n) AS n FROM joined GROUP BY {key}, island),
texts AS (SELECT *, substr(seq, a, b - a) AS t FROM islands),
headed AS (SELECT *, CASE WHEN strpos(t, '{block}') > 0 THEN strpos(t, '{block}') ELSE 1 END AS h, strpos(reverse(t), reverse('{block}')) AS z FROM texts),
tract AS (
  SELECT {key}, seq, CAST(a + h - 1 AS INTEGER) AS s, CAST(CASE WHEN z > 0 AND length(t) - z + 2 - {len(block)} >= h THEN b - z ELSE b - 1 END AS INTEGER) AS e, CAST(n AS INTEGER) AS n FROM headed
)"""


_CUT = f"""WITH {SEGMENT_SQL}, mids AS (SELECT file_stem, qname, mid AS seq FROM split WHERE mid IS NOT NULL),
{_tract_sql("mids", "file_stem, qname", "CAG", 2, 2)},
best AS (SELECT * FROM tract QUALIFY row_number() OVER (PARTITION BY file_stem, qname ORDER BY e - s DESC, s) = 1),
cut AS (
  SELECT split.file_stem, split.qname, "left", mid, "right", s, e, best.n AS pattern_count, CASE WHEN s IS NULL THEN mid ELSE nullif(substr(mid, 1, s - 1), '') END AS mid_1,
         nullif(substr(mid, s, e - s + 1), '') AS mid_2, CASE WHEN s IS NOT NULL THEN nullif(substr(mid, e + 1), '') END AS mid_3
  FROM split LEFT JOIN best ON best.file_stem = split.file_stem AND best.qname = split.qname
)"""


@query(
    f"""{_CUT} SELECT file_stem, qname, coalesce("left", '') || coalesce(mid_1, '') AS "left", mid_2 AS mid, coalesce(mid_3, '') || coalesce("right", '') AS "right",
    round_even(length(mid_2) / 3.0, 0) AS repeat_count_full, CAST(len(regexp_extract_all(mid_2, 'CAG')) AS INTEGER) AS repeat_count_match,
    array_to_string(list_transform(regexp_extract_all(mid_2, '((?:CAG)+)', 1), lambda x: length(x) // 3), ',') AS repeat_count_tracts,
    s AS pattern_start, e AS pattern_end, pattern_count FROM cut"""
)
def f5_detect_repeats(spark, sf_dir):
    return _detected(spark, sf_dir).select("file_stem", "qname", "left", "mid", "right", "repeat_count_full", "repeat_count_match", "repeat_count_tracts", "pattern_start", "pattern_end", "pattern_count")


@query(f"""WITH {_tract_sql("(SELECT doc_id, text AS seq FROM documents)", "doc_id", "an", 1, 1)} SELECT doc_id, s AS start, e AS "end", n AS repeat_count FROM tract""")
def f2_all_tracts(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", F.explode(repeats.tracts(F.col("text"), motif="an", min_repeats=1, start_perfect=1, end_perfect=1, choice="all")).alias("t")).select("doc_id", "t.start", "t.end", "t.repeat_count")


@query(
    f"""WITH {SEGMENT_SQL} SELECT file_stem, count(*) AS total, CAST(count(mid) AS BIGINT) AS with_repeat, CAST(count(*) - count(mid) AS BIGINT) AS without_repeat, round(count(mid) / count(*), 6) AS detection_rate,
    round(avg(length(mid)), 6) AS mean, round(median(length(mid)), 6) AS median FROM split GROUP BY 1"""
)
def a15_detection_summary(spark, sf_dir):
    split = alignments.split_segments(segment_rows(spark, sf_dir))
    return repeats.detection_summary(split.withColumn("repeat_count_full", F.length("mid").cast("double")))


@query(
    f"""WITH {READS_SQL} SELECT file_stem, {r("avg(repeat_count_full) AS mean_full", "avg(repeat_count_match) AS mean_match", "median(repeat_count_full) AS median_full", "median(repeat_count_match) AS median_match",
    "avg(repeat_count_full - repeat_count_match) AS mean_difference", "avg(CASE WHEN round_even(repeat_count_full, 0) = repeat_count_match THEN 1.0 ELSE 0.0 END) AS concordance")} FROM reads GROUP BY 1"""
)
def a16_method_comparison(spark, sf_dir):
    return repeats.method_comparison(counted_reads(spark, sf_dir))


@query(
    f"""WITH {SEGMENT_SQL}, c AS (SELECT file_stem, qname, CASE WHEN k % 3 > 0 THEN CAST(length(mid) AS DOUBLE) END AS repeat_count FROM split)
    SELECT file_stem, qname, coalesce(repeat_count, 0) AS repeat_count FROM c"""
)
def p4_missing_counts(spark, sf_dir):
    split = alignments.split_segments(segment_rows(spark, sf_dir))
    rows = split.select("file_stem", "qname", F.when(F.col("qname").cast("long") % 3 > 0, F.length("mid").cast("double")).alias("repeat_count"))
    return repeats.missing_counts(rows)


_FENCE = f"WITH {READS_SQL}, q AS (SELECT file_stem, quantile_cont(flank_total, 0.25) AS q1, quantile_cont(flank_total, 0.75) AS q3 FROM reads GROUP BY 1)"


@query(f"{_FENCE} SELECT file_stem, count(*) AS n FROM reads JOIN q USING (file_stem) WHERE q3 = q1 OR flank_total BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) GROUP BY 1")
def p5_flank_filter(spark, sf_dir):
    kept = repeats.flank_filter(counted_reads(spark, sf_dir), 1.5, F.col("flank_total"), F.lit(True))
    return kept.groupBy("file_stem").agg(F.count("*").alias("n"))


@query(f"{_FENCE} SELECT file_stem, q1 AS fq1, q3 AS fq3 FROM q")
def a19_flank_fences(spark, sf_dir):
    return repeats.flank_fences(counted_reads(spark, sf_dir), F.col("flank_total"), F.lit(True))


@query(f"{_FENCE} SELECT file_stem, " + ", ".join(f"round(100 * count(*) FILTER (WHERE NOT flank_total BETWEEN q1 - {m} * (q3 - q1) AND q3 + {m} * (q3 - q1)) / count(*), 6) AS removed_{str(m).replace('.', '_')}" for m in (1, 1.5, 2, 3, 5, 10)) + " FROM reads JOIN q USING (file_stem) GROUP BY 1")
def a21_fence_sweep(spark, sf_dir):
    return repeats.fence_sweep(counted_reads(spark, sf_dir), total=F.col("flank_total"), has_mid=F.lit(True))


@query(
    f"""{_FENCE}, b AS (SELECT file_stem, count(*) AS n_before FROM reads GROUP BY 1), a AS (SELECT file_stem, count(*) AS n FROM reads JOIN q USING (file_stem) WHERE q3 = q1 OR flank_total BETWEEN q1 - (q3 - q1) AND q3 + (q3 - q1) GROUP BY 1)
    SELECT file_stem, n_before, coalesce(n, 0) AS n_after, n_before - coalesce(n, 0) AS n_lost, round(coalesce(n, 0) / n_before, 6) AS retained FROM b LEFT JOIN a USING (file_stem)"""
)
def a22_flank_filter_counts(spark, sf_dir):
    rows = counted_reads(spark, sf_dir)
    return reads.compare_read_counts(rows, repeats.flank_filter(rows, 1, F.col("flank_total"), F.lit(True)))


@query(
    f"""WITH {READS_SQL}, t AS (SELECT file_stem, flank_total AS t FROM reads), c AS (SELECT file_stem, t, row_number() OVER (PARTITION BY file_stem ORDER BY count(*) DESC, t) AS i FROM t GROUP BY 1, 2),
    j AS (SELECT t.file_stem, t.t, c.t AS modal, abs(t.t - c.t) AS off FROM t JOIN c ON c.file_stem = t.file_stem AND i = 1)
    SELECT file_stem, count(*) AS n, round(avg(t), 6) AS mean, round(stddev_samp(t), 6) AS sd, round(quantile_cont(t, 0.75) - quantile_cont(t, 0.25), 6) AS iqr, max(modal) AS modal, round(100 * count(*) FILTER (WHERE off = 0) / count(*), 6) AS percent_at_modal,
    min(t) AS "min", max(t) AS "max", CAST(count(*) FILTER (WHERE off = 0) AS BIGINT) AS at_modal, CAST(count(*) FILTER (WHERE off BETWEEN 1 AND 10) AS BIGINT) AS off_1_10, CAST(count(*) FILTER (WHERE off BETWEEN 11 AND 50) AS BIGINT) AS off_11_50,
    CAST(count(*) FILTER (WHERE off > 50) AS BIGINT) AS off_over_50 FROM j GROUP BY 1"""
)
def a18_flank_summary(spark, sf_dir):
    return repeats.flank_summary(counted_reads(spark, sf_dir), F.col("flank_total"))


@query(f"WITH {READS_SQL}, b AS (SELECT file_stem, CAST(floor(repeat_count / 5) * 5 AS DOUBLE) AS bin, count(*) AS n FROM reads GROUP BY 1, 2) SELECT *, round(n / sum(n) OVER (PARTITION BY file_stem), 6) AS fraction FROM b")
def a23_heatmap(spark, sf_dir):
    return repeats.heatmap(counted_reads(spark, sf_dir), 5)


_SUMMARY = 'count(*) AS n_reads, round(median(repeat_count), 6) AS median, round(avg(repeat_count), 6) AS mean, min(repeat_count) AS "min", max(repeat_count) AS "max"'


@query(
    f"""WITH {READS_SQL}, m AS (SELECT file_stem, repeat_count AS mode FROM reads GROUP BY 1, 2 QUALIFY row_number() OVER (PARTITION BY file_stem ORDER BY count(*) DESC, repeat_count) = 1)
    SELECT file_stem, {_SUMMARY}, max(repeat_count) - min(repeat_count) AS "range", round(stddev_samp(repeat_count), 6) AS sd, quantile_cont(repeat_count, 0.25) AS q25, quantile_cont(repeat_count, 0.75) AS q75, max(mode) AS mode
    FROM reads JOIN m USING (file_stem) GROUP BY 1"""
)
def a24_repeat_summary(spark, sf_dir):
    return repeats.repeat_summary(counted_reads(spark, sf_dir))


@query(f"WITH {READS_SQL}, s AS (SELECT file_stem, median(repeat_count) AS m FROM reads GROUP BY 1) SELECT file_stem, m AS median, CAST(row_number() OVER (ORDER BY m, file_stem) AS INTEGER) AS sample_index FROM s")
def w10_sample_index(spark, sf_dir):
    medians = counted_reads(spark, sf_dir).groupBy("file_stem").agg(F.median("repeat_count").alias("median"))
    return medians.withColumn("sample_index", F.row_number().over(Window.orderBy("median", "file_stem")))


# ---- clusters, consensus, variants ----------------------------------------------------------------------------------

_RENUMBER = f"WITH {READS_SQL}, c AS (SELECT file_stem, CASE WHEN cluster_number < 7 THEN cluster_number END AS cluster_number, repeat_count FROM reads), t AS (SELECT file_stem, cluster_number AS cluster_number_old, count(*) AS n_reads FROM c GROUP BY 1, 2), m AS (SELECT *, CAST(row_number() OVER (PARTITION BY file_stem ORDER BY n_reads DESC, cluster_number_old NULLS LAST) AS INTEGER) AS cluster_number, n_reads / sum(n_reads) OVER (PARTITION BY file_stem) AS proportion FROM t)"


def _numbered(spark, sf_dir):
    return counted_reads(spark, sf_dir).withColumn("cluster_number", F.when(F.col("cluster_number") < 7, F.col("cluster_number")))


@query(f"{_RENUMBER} SELECT file_stem, cluster_number_old, n_reads, cluster_number, round(proportion, 6) AS proportion FROM m")
def w8_renumber_map(spark, sf_dir):
    return clusters.renumber_map(_numbered(spark, sf_dir))


@query(f"{_RENUMBER} SELECT c.file_stem, m.cluster_number, count(*) AS n, sum(c.repeat_count) AS total FROM c JOIN m ON m.file_stem = c.file_stem AND m.cluster_number_old IS NOT DISTINCT FROM c.cluster_number GROUP BY 1, 2")
def j8_null_safe_renumber(spark, sf_dir):
    return clusters.renumber(_numbered(spark, sf_dir)).groupBy("file_stem", "cluster_number").agg(F.count("*").alias("n"), F.sum("repeat_count").alias("total"))


@query(
    f"""WITH {READS_SQL}, m AS (SELECT file_stem, cluster_number, repeat_count AS mode FROM reads GROUP BY 1, 2, 3 QUALIFY row_number() OVER (PARTITION BY file_stem, cluster_number ORDER BY count(*) DESC, repeat_count) = 1)
    SELECT file_stem, cluster_number, {_SUMMARY}, round(stddev_samp(repeat_count), 6) AS sd, round(quantile_cont(repeat_count, 0.75) - quantile_cont(repeat_count, 0.25), 6) AS iqr, max(mode) AS mode FROM reads JOIN m USING (file_stem, cluster_number) GROUP BY 1, 2"""
)
def a25_cluster_summary(spark, sf_dir):
    return clusters.cluster_summary(counted_reads(spark, sf_dir))


@query(f"WITH {READS_SQL} SELECT file_stem, count(DISTINCT cluster_number) AS n_clusters FROM reads GROUP BY 1")
def a26_clusters_per_sample(spark, sf_dir):
    return clusters.clusters_per_sample(counted_reads(spark, sf_dir))


@query()
def m4_length_clusters(spark, sf_dir):
    found = clusters.length_clusters(counted_reads(spark, sf_dir).select("file_stem", "qname", "repeat_count"), 4)
    return found.groupBy("file_stem", "repeat_cluster").agg(F.count("*").alias("n"), F.min("repeat_count").alias("least"), F.max("repeat_count").alias("most"))


@query()
def m6_clusters_of_clusters(spark, sf_dir):
    found = clusters.assign_clusters(_detected(spark, sf_dir), ("repeat", "haplotype"), 5)
    return found.groupBy("file_stem", "cluster_number", "repeat_cluster", "haplotype_cluster").agg(F.count("*").alias("n"))


@query(
    f"""WITH {SEGMENT_SQL}, h AS (SELECT file_stem, qname, coalesce("left", '') AS l, coalesce("right", '') AS rt FROM split),
    ml AS (SELECT file_stem, length(l) AS n FROM h GROUP BY 1, 2 QUALIFY row_number() OVER (PARTITION BY file_stem ORDER BY count(*) DESC, length(l)) = 1),
    mr AS (SELECT file_stem, length(rt) AS n FROM h GROUP BY 1, 2 QUALIFY row_number() OVER (PARTITION BY file_stem ORDER BY count(*) DESC, length(rt)) = 1)
    SELECT h.file_stem, qname, nullif("right"(l, ml.n) || "left"(rt, mr.n), '') AS haplotype FROM h JOIN ml ON ml.file_stem = h.file_stem JOIN mr ON mr.file_stem = h.file_stem"""
)
def f20_haplotypes(spark, sf_dir):
    return clusters.haplotypes(alignments.split_segments(segment_rows(spark, sf_dir))).select("file_stem", "qname", "haplotype")


def _consensus(spark, sf_dir):
    rows = _detected(spark, sf_dir).withColumn("cluster_number", (F.col("qname").cast("long") % 3).cast("int"))
    return consensus.cluster_consensus(rows, sample=20)


@query()
def m9_consensus(spark, sf_dir):
    return _consensus(spark, sf_dir)


_REFERENCE = "AC" * 8 + "CAG" * 10 + "GGT" * 8


@query()
def m12_variants(spark, sf_dir):
    return consensus.variants(_consensus(spark, sf_dir), _REFERENCE)


_VARIANTS = "v AS (SELECT l_returnflag AS file_stem, l_linenumber AS cluster_number, CASE l_partkey % 3 WHEN 0 THEN 'insertion' WHEN 1 THEN 'deletion' ELSE 'mismatch' END AS variant_type FROM lineitem)"


@query(f"WITH {_VARIANTS} SELECT file_stem, cluster_number, " + ", ".join(f"CAST(count(*) FILTER (WHERE variant_type = '{t}') AS BIGINT) AS {t}" for t in ("insertion", "deletion", "mismatch")) + " FROM v GROUP BY 1, 2")
def a34_variant_summary(spark, sf_dir):
    kind = F.when(F.col("l_partkey") % 3 == 0, "insertion").when(F.col("l_partkey") % 3 == 1, "deletion").otherwise("mismatch")
    return consensus.variant_summary(table(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("file_stem"), F.col("l_linenumber").alias("cluster_number"), kind.alias("variant_type")))


@query("SELECT l_partkey AS position, l_returnflag AS ref, l_linestatus AS query FROM lineitem WHERE l_partkey > 1 AND l_returnflag <> 'N'")
def p11_vcf_filter(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("position"), F.col("l_returnflag").alias("ref"), F.col("l_linestatus").alias("query"))
    return consensus.vcf_rows(rows)


@query("SELECT '>' || item_id || chr(10) || regexp_replace(upper(replace(text, 'ß', 's')), '[^ACGTN-]', '-', 'g') AS value FROM benchmark")
def k3_fasta_lines(spark, sf_dir):
    return sinks.fasta_lines(table(spark, sf_dir, "benchmark").select(F.col("item_id").cast("string").alias("name"), F.upper(F.replace(F.col("text"), F.lit("ß"), F.lit("s"))).alias("sequence")))


@query(
    """SELECT o_orderpriority AS file_stem, CAST(o_orderkey AS VARCHAR) AS qname, CASE WHEN o_orderkey % 2 = 0 THEN '+' ELSE '+c' END AS strand_1, CAST(5 + o_orderkey % 30 AS DOUBLE) AS repeat_count FROM orders"""
)
def m1_align_flanks(spark, sf_dir):
    refs = tables.parse_reference("locus", "ACGTTGCAAGTCCATGACGATTGACCTTAGCA" + "N" * 6 + "GGTACCATTGACAGTTCAAGGCTTAACCGTAT")
    key = F.col("o_orderkey")
    # One read in three has errors in its flanks: a substitution, a lost base, one too many.
    left, right = refs[0][3], refs[1][3]
    flaws = F.when(key % 9 == 1, left[:9] + "T" + left[10:]).when(key % 9 == 4, left[:12] + left[13:]).otherwise(left), F.when(key % 9 == 7, right[:15] + "A" + right[15:]).when(key % 9 == 4, right[:20] + "C" + right[21:]).otherwise(right)
    read = F.concat(flaws[0], F.repeat(F.lit("CAG"), (5 + key % 30).cast("int")), flaws[1])
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("file_stem"), key.cast("string").alias("qname"), F.when(key % 2 == 0, read).otherwise(sequence.reverse_complement(read)).alias("sequence"))
    rows = rows.repartition(spark.sparkContext.defaultParallelism)  # one small file, much work a row
    found = alignments.split_segments(alignments.ordered_flanks(alignments.correct_strand(alignments.dual_flank(aligner.align(rows, refs)))))
    return repeats.detect_repeats(found).select("file_stem", "qname", "strand_1", "repeat_count")


# ---- plot tables and plain verbs ------------------------------------------------------------------------------------


@query(f"WITH {READS_SQL} SELECT file_stem, cluster_number, count(*) AS n_reads FROM reads GROUP BY 1, 2 HAVING count(*) >= 5")
def p16_large_clusters(spark, sf_dir):
    return plotdata.large_clusters(counted_reads(spark, sf_dir))


def _waterfall(spark, sf_dir):
    split = alignments.split_segments(segment_rows(spark, sf_dir))
    return split.withColumns({"cluster_number": (F.col("qname").cast("long") % 2).cast("int"), "repeat_count": F.length("mid").cast("double")})


@query(
    f"""WITH {SEGMENT_SQL} SELECT file_stem, CAST(count(mid) AS BIGINT) AS n_reads, count(*) AS total, count(DISTINCT CASE WHEN mid IS NOT NULL THEN k % 2 END) AS n_clusters, round(avg(length(mid)), 6) AS mean_mid_bp FROM split GROUP BY 1"""
)
def a36_waterfall_summary(spark, sf_dir):
    return plotdata.waterfall_summary(_waterfall(spark, sf_dir))


@query(f"WITH {SEGMENT_SQL}, u AS (SELECT * FROM split WHERE mid IS NOT NULL) SELECT file_stem, qname, CAST(row_number() OVER (PARTITION BY file_stem ORDER BY length(mid) DESC, k % 2, qname) AS INTEGER) AS read_order FROM u")
def w11_read_order(spark, sf_dir):
    return plotdata.waterfall_order(plotdata.waterfall_rows(_waterfall(spark, sf_dir)), 10**9).select("file_stem", "qname", "read_order")


@query(
    f"""WITH {SEGMENT_SQL}, u AS (SELECT *, coalesce("left", '') AS l, coalesce("right", '') AS rt FROM split WHERE mid IS NOT NULL), s AS (
      SELECT file_stem, qname, 'left' AS segment, l AS bases, -length(l) AS start FROM u UNION ALL SELECT file_stem, qname, 'mid', mid, 0 FROM u UNION ALL SELECT file_stem, qname, 'right', rt, length(mid) FROM u)
    SELECT file_stem, qname, segment, CAST(start + i AS INTEGER) AS position, substr(bases, CAST(i + 1 AS INTEGER), 1) AS base FROM (SELECT *, unnest(range(0, length(bases))) AS i FROM s)"""
)
def u8_waterfall_bases(spark, sf_dir):
    rows = plotdata.waterfall_rows(_waterfall(spark, sf_dir))
    return plotdata.waterfall_bases(plotdata.waterfall_order(rows, 10**9)).select("file_stem", "qname", "segment", "position", "base")


@query(f"WITH {READS_SQL} SELECT file_stem, CAST(floor(repeat_count / 2) * 2 AS DOUBLE) AS bin, count(*) AS n FROM reads GROUP BY 1, 2")
def v_histogram(spark, sf_dir):
    return plotdata.histogram(counted_reads(spark, sf_dir), 2)


@query("SELECT s_suppkey, n_name, r_name FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey")
def j9_metadata_join(spark, sf_dir):
    s, n, g = (table(spark, sf_dir, t) for t in ("supplier", "nation", "region"))
    return s.join(n, s["s_nationkey"] == n["n_nationkey"], "left").join(g, F.col("n_regionkey") == F.col("r_regionkey"), "left").select("s_suppkey", "n_name", "r_name")


@query(f"WITH {READS_SQL} SELECT a.file_stem, a.n AS n_reads, b.n AS n_long FROM (SELECT file_stem, count(*) AS n FROM reads GROUP BY 1) a LEFT JOIN (SELECT file_stem, count(*) AS n FROM reads WHERE repeat_count > 48 GROUP BY 1) b USING (file_stem)")
def j1_left_join(spark, sf_dir):
    rows = counted_reads(spark, sf_dir)
    return rows.groupBy("file_stem").agg(F.count("*").alias("n_reads")).join(rows.filter("repeat_count > 48").groupBy("file_stem").agg(F.count("*").alias("n_long")), "file_stem", "left")


@query("SELECT l_orderkey, o_orderstatus, sum(l_quantity) AS total FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2")
def j6_counts_join(spark, sf_dir):
    li, o = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    totals = li.groupBy("l_orderkey").agg(F.sum("l_quantity").alias("total"))  # before the join: one row for each key moves
    return totals.join(o, F.col("l_orderkey") == F.col("o_orderkey"), "left").select("l_orderkey", "o_orderstatus", "total")


@query("SELECT p_partkey, p_brand FROM part WHERE p_size IN (SELECT n_nationkey FROM nation)")
def j12_membership(spark, sf_dir):
    n = table(spark, sf_dir, "nation")
    return table(spark, sf_dir, "part").join(n, F.col("p_size") == F.col("n_nationkey"), "left_semi").select("p_partkey", "p_brand")


@query(
    """SELECT p_type, min_by(n_name, d) AS nearest, CAST(min(d.dist) AS INTEGER) AS distance FROM (SELECT p_type, n_name, {'dist': levenshtein(p_type, n_name), 'name': n_name} AS d FROM (SELECT DISTINCT p_type FROM part) CROSS JOIN nation) GROUP BY 1"""
)
def j13_nearest_pattern(spark, sf_dir):
    kinds = table(spark, sf_dir, "part").select("p_type").distinct()
    names = F.broadcast(table(spark, sf_dir, "nation").select("n_name"))  # 25 rows by definition: a stated pattern set
    d = F.levenshtein("p_type", "n_name")
    return kinds.join(names).groupBy("p_type").agg(F.min_by("n_name", F.struct(d, "n_name")).alias("nearest"), F.min(d).alias("distance"))


@query("SELECT 'customer' AS kind, c_name AS name, c_mktsegment AS segment FROM customer UNION ALL SELECT 'supplier', s_name, NULL FROM supplier")
def u1_union(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(F.lit("customer").alias("kind"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    s = table(spark, sf_dir, "supplier").select(F.lit("supplier").alias("kind"), F.col("s_name").alias("name"))
    return c.unionByName(s, allowMissingColumns=True)


@query("SELECT DISTINCT l_returnflag, l_linestatus FROM lineitem")
def u3_distinct(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus").distinct()


@query("SELECT l_returnflag, sum(CASE WHEN l_linestatus = 'F' THEN l_quantity END) AS F, sum(CASE WHEN l_linestatus = 'O' THEN l_quantity END) AS O FROM lineitem GROUP BY 1")
def u4_pivot(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").groupBy("l_returnflag").pivot("l_linestatus", ["F", "O"]).agg(F.sum("l_quantity"))


@query("SELECT o_custkey, array_to_string(list_sort(list(DISTINCT o_orderpriority)), ',') AS priorities FROM orders GROUP BY 1")
def u10_collect(spark, sf_dir):
    return table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.concat_ws(",", F.sort_array(F.collect_set("o_orderpriority"))).alias("priorities"))


@query("SELECT p_brand, p_partkey, p_retailprice, CAST(k AS INTEGER) AS k FROM (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC, p_partkey) AS k FROM part) WHERE k <= 3")
def o2_top_k(spark, sf_dir):
    k = F.row_number().over(Window.partitionBy("p_brand").orderBy(F.desc("p_retailprice"), "p_partkey"))
    return table(spark, sf_dir, "part").withColumn("k", k).filter("k <= 3").select("p_brand", "p_partkey", "p_retailprice", "k")


@query("SELECT o_custkey, o_orderkey, round(sum(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS UNBOUNDED PRECEDING), 2) AS running FROM orders")
def w17_running_sum(spark, sf_dir):
    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey").rowsBetween(Window.unboundedPreceding, 0)
    return table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", F.round(F.sum("o_totalprice").over(w), 2).alias("running"))


@query(
    """WITH g AS (SELECT user_id, event_id, ts, CASE WHEN epoch(ts) - epoch(lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id)) <= 3600 THEN 0 ELSE 1 END AS new FROM events),
    i AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS island FROM g)
    SELECT user_id, CAST(island AS BIGINT) AS island, count(*) AS n FROM i GROUP BY 1, 2"""
)
def w16_gaps_and_islands(spark, sf_dir):
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    gap = F.unix_micros(F.col("ts").cast("timestamp")) - F.unix_micros(F.lag("ts").over(w).cast("timestamp"))
    rows = table(spark, sf_dir, "events").withColumn("new", F.when(gap <= 3_600_000_000, 0).otherwise(1))
    return rows.withColumn("island", F.sum("new").over(w.rowsBetween(Window.unboundedPreceding, 0))).groupBy("user_id", "island").agg(F.count("*").alias("n"))


@query("SELECT event_id, CASE WHEN isfinite(v) THEN v END AS v FROM (SELECT event_id, CASE event_id % 3 WHEN 0 THEN value WHEN 1 THEN CAST('NaN' AS DOUBLE) ELSE CAST('Infinity' AS DOUBLE) END AS v FROM events)")
def p15_finite_only(spark, sf_dir):
    k = F.col("event_id") % 3
    v = F.when(k == 0, F.col("value")).when(k == 1, F.lit(float("nan"))).otherwise(F.lit(float("inf")))
    rows = table(spark, sf_dir, "events").select("event_id", v.alias("v"))
    return ranges.finite_only(rows)


# ---- the inventory's remaining lines --------------------------------------------------------------------------------


@query(f"WITH {ALIGN_SQL} SELECT file_stem, qname, rname, strand FROM aln WHERE rname = 'L'")
def p2_drop_unaligned(spark, sf_dir):
    rows = alignment_rows(spark, sf_dir).withColumn("rname", F.when(F.col("rname") == "L", F.col("rname")))
    return alignments.aligned_only(rows).select("file_stem", "qname", "rname", "strand")


@query(f'WITH {SEGMENT_SQL} SELECT file_stem, qname, CAST(length("left") AS INTEGER) AS left_length, CAST(length(mid) AS INTEGER) AS mid_length, CAST(length("right") AS INTEGER) AS right_length, CAST(length(mid) AS DOUBLE) AS repeat_length FROM split WHERE mid IS NOT NULL')
def p6_waterfall_filter(spark, sf_dir):
    return plotdata.waterfall_rows(_waterfall(spark, sf_dir)).select("file_stem", "qname", "left_length", "mid_length", "right_length", "repeat_length")


@query(f"WITH {READS_SQL} SELECT file_stem, qname, repeat_count FROM reads WHERE repeat_count BETWEEN 14 AND 35")
def p7_range_predicate(spark, sf_dir):
    return counted_reads(spark, sf_dir).filter(F.col("repeat_count").between(14, 35)).select("file_stem", "qname", "repeat_count")


@query("SELECT p_partkey AS part, p_brand AS brand, p_retailprice AS price FROM part")
def p13_rename(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_retailprice").withColumnsRenamed({"p_partkey": "part", "p_brand": "brand", "p_retailprice": "price"})


@query(f"WITH {READS_SQL} SELECT file_stem, round(avg(repeat_count_match), 6) AS mean FROM reads GROUP BY 1")
def p14_chosen_column(spark, sf_dir):
    method = "repeat_count_match"  # named at run time
    return counted_reads(spark, sf_dir).groupBy("file_stem").agg(F.avg(F.col(method)).alias("mean"))


@query(f"WITH {FREQ_SQL} SELECT file_stem, analysis_range_name, round(sum(length * freq) / sum(freq), 6) AS weighted_mean FROM freq GROUP BY 1, 2")
def a31_weighted_mean(spark, sf_dir):
    freq = range_tables(spark, sf_dir)[0]
    return freq.groupBy("file_stem", "analysis_range_name").agg((F.sum(F.col("length") * F.col("freq")) / F.sum("freq")).alias("weighted_mean"))


@query(f"""{_PICKED} SELECT "group", analysis_range_name, count(*) AS n_controls, count(DISTINCT file_stem) AS n_samples FROM eligible WHERE group_control_sample = 'TRUE' GROUP BY 1, 2""")
def a35_control_counts(spark, sf_dir):
    return _controls(spark, sf_dir)[2].groupBy("group", "analysis_range_name").agg(F.count("*").alias("n_controls"), F.count_distinct("file_stem").alias("n_samples"))


@query(
    """WITH m AS (SELECT o_orderpriority AS module, sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS seconds FROM orders GROUP BY 1), c AS (SELECT module, seconds, sum(seconds) OVER (ORDER BY module) AS cumulative FROM m)
    SELECT module, round(CAST(seconds AS DOUBLE), 2) AS seconds, round(CAST(cumulative AS DOUBLE), 2) AS cumulative FROM c UNION ALL SELECT 'Total', round(CAST(sum(seconds) AS DOUBLE), 2), round(CAST(sum(seconds) AS DOUBLE), 2) FROM m"""
)
def a38_timing_table(spark, sf_dir):
    each = table(spark, sf_dir, "orders").groupBy(F.col("o_orderpriority").alias("module")).agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("seconds"))
    rows = each.withColumn("cumulative", F.sum("seconds").over(Window.orderBy("module")))  # one row for each module
    total = each.agg(F.lit("Total").alias("module"), F.sum("seconds").alias("seconds"), F.sum("seconds").alias("cumulative"))
    return rows.unionByName(total).select("module", *(F.round(F.col(c).cast("double"), 2).alias(c) for c in ("seconds", "cumulative")))


@query("SELECT l_orderkey, l_linenumber, o_orderpriority FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey WHERE l_quantity > 45")
def j2_query_sequences(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").filter("l_quantity > 45").select("l_orderkey", "l_linenumber")
    return rows.join(table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderpriority"), "l_orderkey", "left")


@query(f'WITH {SEGMENT_SQL} SELECT file_stem, qname, nullif(substr(seq, 1, 4), \'\') AS "left", mid FROM split')
def j7_replace_columns(spark, sf_dir):
    split = alignments.split_segments(segment_rows(spark, sf_dir)).select("file_stem", "qname", "left", "mid", "query_sequence")
    other = split.select("file_stem", "qname", F.substring("query_sequence", 1, 4).alias("left"))
    return split.drop("left", "query_sequence").join(other, ["file_stem", "qname"], "left").select("file_stem", "qname", "left", "mid")


@query(f"WITH {READS_SQL}, t AS (SELECT file_stem, count(*) AS total FROM reads GROUP BY 1) SELECT file_stem, cluster_number, count(*) AS n, round(count(*) / max(total), 6) AS share FROM reads JOIN t USING (file_stem) GROUP BY 1, 2")
def j10_join_back_totals(spark, sf_dir):
    each = counted_reads(spark, sf_dir).groupBy("file_stem", "cluster_number").agg(F.count("*").alias("n"))  # totals come from the counts, not from the reads
    return each.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy("file_stem")))


@query(
    f"""WITH {READS_SQL}, m AS (SELECT file_stem, cluster_number, repeat_count AS mode FROM reads GROUP BY 1, 2, 3 QUALIFY row_number() OVER (PARTITION BY file_stem, cluster_number ORDER BY count(*) DESC, repeat_count) = 1),
    c AS (SELECT file_stem, cluster_number, count(*) AS read_count FROM reads GROUP BY 1, 2)
    SELECT c.file_stem || '_cluster' || lpad(CAST(c.cluster_number AS VARCHAR), 2, '0') || '_n' || read_count || '_mode' || CAST(mode AS INTEGER) || '_prop' || printf('%.3f', read_count / sum(read_count) OVER (PARTITION BY c.file_stem)) || '_full' AS name
    FROM c JOIN m ON m.file_stem = c.file_stem AND m.cluster_number = c.cluster_number"""
)
def j11_consensus_names(spark, sf_dir):
    rows = clusters.cluster_summary(counted_reads(spark, sf_dir))
    share = F.col("n_reads") / F.sum("n_reads").over(Window.partitionBy("file_stem"))
    return sinks.consensus_names(rows.select("file_stem", "cluster_number", F.col("n_reads").alias("read_count"), "mode", share.alias("proportion")), "full").select("name")


@query(f"WITH {DUAL_SQL} SELECT file_stem, qname, rname, mapq, alignment_length_on_ref, ref_start FROM ranked WHERE best = 1")
def w2_best_per_flank(spark, sf_dir):
    return alignments.best_per_flank(alignment_rows(spark, sf_dir)).select("file_stem", "qname", "rname", "mapq", "alignment_length_on_ref", "ref_start")


@query(f"WITH {ALIGN_SQL} SELECT file_stem, qname, count(*) AS n, min(strand) = max(strand) AS one_strand FROM aln GROUP BY 1, 2")
def w3_same_strand(spark, sf_dir):
    return alignment_rows(spark, sf_dir).groupBy("file_stem", "qname").agg(F.count("*").alias("n"), (F.min("strand") == F.max("strand")).alias("one_strand"))


@query(f"WITH {ALIGN_SQL} SELECT file_stem, qname, query_start, ref_start, CAST(row_number() OVER (PARTITION BY file_stem, qname ORDER BY query_start, query_end, ref_start) AS INTEGER) AS alignment_number FROM aln")
def w6_alignment_number(spark, sf_dir):
    number = F.row_number().over(Window.partitionBy("file_stem", "qname").orderBy("query_start", "query_end", "ref_start"))
    return alignment_rows(spark, sf_dir).select("file_stem", "qname", "query_start", "ref_start", number.alias("alignment_number"))


@query(f"WITH {READS_SQL}, m AS (SELECT file_stem, cluster_number, avg(repeat_count) AS mean FROM reads GROUP BY 1, 2) SELECT file_stem, cluster_number, CAST(row_number() OVER (PARTITION BY file_stem ORDER BY mean, cluster_number) AS INTEGER) AS relabelled FROM m")
def w9_relabel_by_mean(spark, sf_dir):
    return clusters.relabelled_by_mean(counted_reads(spark, sf_dir))


@query(f"WITH {READS_SQL}, m AS (SELECT file_stem, repeat_count AS mode FROM reads GROUP BY 1, 2 QUALIFY row_number() OVER (PARTITION BY file_stem ORDER BY count(*) DESC, repeat_count) = 1) SELECT file_stem, repeat_count - mode AS deviation, count(*) AS n FROM reads JOIN m USING (file_stem) GROUP BY 1, 2")
def w12_modal_deviation(spark, sf_dir):
    each = counted_reads(spark, sf_dir).groupBy("file_stem", "repeat_count").agg(F.count("*").alias("n"))
    mode = F.first("repeat_count").over(Window.partitionBy("file_stem").orderBy(F.desc("n"), "repeat_count").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return each.select("file_stem", (F.col("repeat_count") - mode).alias("deviation"), "n")


@query(f"{_FENCE} SELECT file_stem, flank_total BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS within, count(*) AS n FROM reads JOIN q USING (file_stem) GROUP BY 1, 2")
def w14_fence_flag(spark, sf_dir):
    fences = repeats.flank_fences(counted_reads(spark, sf_dir), F.col("flank_total"), F.lit(True))
    spread = F.col("fq3") - F.col("fq1")
    each = counted_reads(spark, sf_dir).groupBy("file_stem", "flank_total").agg(F.count("*").alias("c"))
    within = F.col("flank_total").between(F.col("fq1") - 1.5 * spread, F.col("fq3") + 1.5 * spread)
    return each.join(fences, "file_stem").groupBy("file_stem", within.alias("within")).agg(F.sum("c").alias("n"))


@query(f"WITH {READS_SQL}, m AS (SELECT file_stem, avg(repeat_count) AS mean FROM reads GROUP BY 1) SELECT file_stem, round(mean, 6) AS mean, abs(mean - avg(mean) OVER ()) > 2 * stddev_samp(mean) OVER () AS outlier FROM m")
def w15_cohort_outliers(spark, sf_dir):
    means = counted_reads(spark, sf_dir).groupBy("file_stem").agg(F.avg("repeat_count").alias("mean"))
    return reads.cohort_outliers(means, "mean")


@query("SELECT n_nationkey, n_name, n_regionkey FROM nation ORDER BY n_regionkey, n_name DESC")
def o1_sort(spark, sf_dir):
    return table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey").orderBy("n_regionkey", F.desc("n_name"))


@query(f"WITH {READS_SQL} SELECT file_stem, qname, repeat_count FROM reads QUALIFY row_number() OVER (PARTITION BY file_stem ORDER BY repeat_count, qname, read_index) = 1")
def o3_first_of_group(spark, sf_dir):
    first = F.min_by(F.struct("qname", "repeat_count"), F.struct("repeat_count", "qname", "read_index"))
    return counted_reads(spark, sf_dir).groupBy("file_stem").agg(first.alias("r")).select("file_stem", "r.qname", "r.repeat_count")


@query(
    f"""WITH {ALIGN_SQL}, picked AS (SELECT file_stem, qname FROM (SELECT DISTINCT file_stem, qname FROM aln) QUALIFY row_number() OVER (PARTITION BY file_stem ORDER BY md5(qname || ':123'), qname) <= 1000)
    SELECT file_stem, qname, query_start, query_end FROM aln JOIN picked USING (file_stem, qname)"""
)
def o5_plot_sample(spark, sf_dir):
    some = reads.downsample(alignment_rows(spark, sf_dir).select("file_stem", "qname").distinct(), 1000)
    return alignment_rows(spark, sf_dir).join(some, ["file_stem", "qname"], "left_semi").select("file_stem", "qname", "query_start", "query_end")


@query(f"WITH {READS_SQL}, m AS (SELECT cluster_number, avg(repeat_count) AS mean FROM reads GROUP BY 1) SELECT cluster_number, CAST(row_number() OVER (ORDER BY mean DESC, cluster_number) AS INTEGER) AS level FROM m")
def o7_levels_by_mean(spark, sf_dir):
    means = counted_reads(spark, sf_dir).groupBy("cluster_number").agg(F.avg("repeat_count").alias("mean"))
    return means.select("cluster_number", F.row_number().over(Window.orderBy(F.desc("mean"), "cluster_number")).alias("level"))  # one row for each cluster number


@query("SELECT item_id, CAST(i AS INTEGER) AS i, substr(t, CAST(i + 1 AS INTEGER), 1) AS base FROM (SELECT item_id, t, unnest(range(0, length(t))) AS i FROM (SELECT item_id, text AS t FROM benchmark))")
def m13_alignment_matrix(spark, sf_dir):
    rows = table(spark, sf_dir, "benchmark").select("item_id", F.posexplode(F.split("text", "")).alias("i", "base"))
    return rows.filter("base <> ''")


@query(f"{_CUT} SELECT file_stem, qname, mid_1, mid_2, mid_3, pattern_count FROM cut")
def f3_cut_tract(spark, sf_dir):
    split = alignments.split_segments(segment_rows(spark, sf_dir))
    return repeats.cut_tract(split).select("file_stem", "qname", "mid_1", "mid_2", "mid_3", "pattern_count")


@query("SELECT n_nationkey, upper(n_name) AS u, lower(n_name) AS l, length(n_name) AS n, substr(n_name, 2, 3) AS part, regexp_replace(n_name, '[AEIOU]', '', 'g') AS consonants, n_name || '-' || n_regionkey AS joined, regexp_matches(n_name, '^[A-M]') AS early FROM nation")
def f15_string_set(spark, sf_dir):
    n = F.col("n_name")
    return table(spark, sf_dir, "nation").select("n_nationkey", F.upper(n).alias("u"), F.lower(n).alias("l"), F.length(n).cast("long").alias("n"), F.substring(n, 2, 3).alias("part"), F.regexp_replace(n, "[AEIOU]", "").alias("consonants"), F.concat(n, F.lit("-"), F.col("n_regionkey").cast("string")).alias("joined"), n.rlike("^[A-M]").alias("early"))


@query("SELECT s_suppkey, round_even(s_acctbal, 0) AS even, CAST(floor(s_acctbal) AS BIGINT) AS low, CAST(ceil(s_acctbal) AS BIGINT) AS high, abs(s_acctbal) AS size, round(sqrt(abs(s_acctbal)), 6) AS root, round(ln(abs(s_acctbal) + 1), 6) AS log FROM supplier")
def f16_math_set(spark, sf_dir):
    x = F.col("s_acctbal")
    return table(spark, sf_dir, "supplier").select("s_suppkey", F.bround(x, 0).alias("even"), F.floor(x).alias("low"), F.ceil(x).alias("high"), F.abs(x).alias("size"), F.sqrt(F.abs(x)).alias("root"), F.log(F.abs(x) + 1).alias("log"))


@query("SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 'debt' WHEN c_acctbal < 5000 THEN 'some' ELSE 'much' END AS band, coalesce(nullif(c_mktsegment, 'BUILDING'), 'other') AS segment FROM customer")
def f17_conditionals(spark, sf_dir):
    band = F.when(F.col("c_acctbal") < 0, "debt").when(F.col("c_acctbal") < 5000, "some").otherwise("much")
    return table(spark, sf_dir, "customer").select("c_custkey", band.alias("band"), F.coalesce(F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")), F.lit("other")).alias("segment"))


@query()
def m5_haplotype_clusters(spark, sf_dir):
    rows = clusters.haplotypes(alignments.split_segments(segment_rows(spark, sf_dir)))
    return clusters.haplotype_clusters(rows).groupBy("file_stem", "haplotype_cluster").agg(F.count("*").alias("n"), F.min("haplotype").alias("first_haplotype"))


@query(f"WITH {READS_SQL} SELECT file_stem, qname, 1 AS cluster_number FROM reads")
def m8_single_cluster(spark, sf_dir):
    return clusters.assign_clusters(counted_reads(spark, sf_dir), None).select("file_stem", "qname", "cluster_number")


@query(
    f"""WITH {SEGMENT_SQL} SELECT file_stem, qname AS read_id, CAST(length(mid) AS DOUBLE) AS repeat_count_full, CAST(len(regexp_extract_all(mid, 'CAG')) AS INTEGER) AS repeat_count_match,
    CASE WHEN mid IS NULL THEN NULL WHEN len(regexp_extract_all(mid, 'CAG')) = 0 THEN '0' ELSE array_to_string(list_transform(regexp_extract_all(mid, '((?:CAG)+)', 1), lambda x: length(x) // 3), ',') END AS repeat_count_tracts
    FROM (SELECT file_stem, qname, mid FROM split)"""
)
def k2_read_counts(spark, sf_dir):
    split = alignments.split_segments(segment_rows(spark, sf_dir))
    made = sequence.count_repeats(F.col("mid"), "CAG")
    return split.select("file_stem", F.col("qname").alias("read_id"), F.length("mid").cast("double").alias("repeat_count_full"), made["repeat_count_match"].alias("repeat_count_match"), made["repeat_count_tracts"].alias("repeat_count_tracts"))


@query(
    """WITH v AS (SELECT l_partkey AS position, l_returnflag AS ref, l_linestatus AS query, l_linenumber AS cluster FROM lineitem WHERE l_partkey > 1 AND l_returnflag <> 'N')
    SELECT position, ref, query, """ + ", ".join(f"CASE WHEN bool_or(cluster = {c}) THEN '0/1' ELSE '0/0' END AS cluster{c}" for c in range(1, 8)) + " FROM v GROUP BY 1, 2, 3"
)
def k6_vcf_genotypes(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("position"), F.col("l_returnflag").alias("ref"), F.col("l_linestatus").alias("query"), F.col("l_linenumber").alias("cluster"))
    has = [F.when(F.bool_or(F.col("cluster") == c), "0/1").otherwise("0/0").alias(f"cluster{c}") for c in range(1, 8)]
    return consensus.vcf_rows(rows).groupBy("position", "ref", "query").agg(*has)


# ---- sources and sinks: written, then read back -----------------------------------------------------------------------


@query("SELECT 'sample' || n_nationkey || '.' || CASE n_nationkey % 4 WHEN 0 THEN 'fastq' WHEN 1 THEN 'fastq.gz' WHEN 2 THEN 'bam' ELSE 'fa' END AS file_name, CAST(n_nationkey + 1 AS BIGINT) AS bytes FROM nation")
def s1_file_discovery(spark, sf_dir):
    root = scratch(spark, "files")
    for r_ in table(spark, sf_dir, "nation").collect():  # one small file for each nation
        k = r_["n_nationkey"]
        folder = f"{root}/deep/{k % 3}"
        sinks.write_bytes(spark, f"{folder}/sample{k}.{('fastq', 'fastq.gz', 'bam', 'fa')[k % 4]}", b"x" * (k + 1))
        sinks.write_bytes(spark, f"{folder}/notes{k}.txt", b"y")
    found = catalog.discover(spark, root)
    return found.select(F.regexp_extract("file_path", "([^/]*)$", 1).alias("file_name"), "bytes")


@query("SELECT CAST(event_id AS VARCHAR) AS qname, props AS sequence, reverse(props) AS quality FROM events")
def s3_fastq_round_trip(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select(F.concat_ws("\n", F.concat(F.lit("@"), F.col("event_id").cast("string"), F.lit(" more words")), "props", F.lit("+"), F.reverse("props")).alias("value"))
    path = scratch(spark, "fastq")
    rows.write.text(path)
    return sequences.read_sequences(spark, path, "fastq").select("qname", "sequence", "quality")


@query("SELECT CAST(item_id AS VARCHAR) AS qname, regexp_replace(upper(replace(text, 'ß', 's')), '[^ACGTN-]', '-', 'g') AS sequence FROM benchmark")
def s4_fasta_round_trip(spark, sf_dir):
    rows = table(spark, sf_dir, "benchmark").select(F.col("item_id").cast("string").alias("name"), F.upper(F.replace(F.col("text"), F.lit("ß"), F.lit("s"))).alias("sequence"))
    path = scratch(spark, "fasta")
    sinks.write_fasta(rows, path)
    return sequences.read_sequences(spark, path, "fasta").select("qname", "sequence")


@query("SELECT n_name AS adapter_name, 'ACGT' || n_name AS adapter_sequence FROM nation")
def s7_adapters(spark, sf_dir):
    path = scratch(spark, "adapters")
    rows = table(spark, sf_dir, "nation").select(F.col("n_name").alias("adapter_name"), F.concat(F.lit("ACGT"), F.col("n_name")).alias("adapter_sequence"))
    rows.coalesce(1).write.option("header", True).csv(f"{path}/adapters.csv")
    return spark.createDataFrame(list(tables.read_adapters(spark, f"{path}/adapters.csv").items()), "adapter_name string, adapter_sequence string")


@query(f"""WITH {META_SQL} SELECT file_stem, file_stem || '.fastq.gz' AS file_name, '{RANGES}' AS analysis_ranges, "group", CAST(CAST(time AS INTEGER) AS VARCHAR) AS time FROM meta""")
def s9_settings_workbook(spark, sf_dir):
    rows = settings(spark, sf_dir).select(F.concat("file_stem", F.lit(".fastq.gz")).alias("file_name"), "analysis_ranges", "floor", "max_peaks", "group", F.col("time").cast("int").alias("time"))
    path = f"{scratch(spark, 'settings')}/settings.xlsx"
    sinks.write_bytes(spark, path, sinks.workbook({"settings": rows}))
    return tables.read_settings(spark, path).select("file_stem", "file_name", "analysis_ranges", "group", "time")


@query("SELECT DISTINCT o_orderpriority AS file_stem, CAST(o_orderkey AS VARCHAR) AS qname FROM orders")
def s10_exclusions(spark, sf_dir):
    path = scratch(spark, "exclusions") + "/list.tsv"
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("file_name"), F.col("o_orderkey").cast("string").alias("read_name"), F.lit("by hand").alias("reason"))
    rows.write.option("header", True).option("sep", "\t").csv(path)
    return tables.read_exclusions(spark, path)


@query(f"WITH {READS_SQL} SELECT file_stem, CAST(count(*) AS BIGINT) AS n_reads FROM reads GROUP BY 1")
def s12_stage_load(spark, sf_dir):
    root = scratch(spark, "stage")
    made = counted_reads(spark, sf_dir).groupBy("file_stem").agg(F.count("*").alias("n_reads"))
    sinks.StageStore(spark, root).save("range_analysis", {"counts": made}, "digest")
    again = sinks.StageStore(spark, root)
    if not again.fresh("range_analysis", "digest") or again.fresh("range_analysis", "other"):
        raise RuntimeError("the manifest doesn't say what was saved")
    return again.load("range_analysis")["counts"]


@query(f"WITH {READS_SQL}, r AS (SELECT file_stem, cluster_number, count(*) AS n FROM reads GROUP BY 1, 2 HAVING count(*) >= 5) SELECT file_stem, cluster_number, CAST(n AS BIGINT) AS n_reads FROM r")
def s13_resumed_table(spark, sf_dir):
    root = scratch(spark, "resume")
    made = plotdata.large_clusters(counted_reads(spark, sf_dir))
    sinks.StageStore(spark, root).keeper("allele_calling", "digest")("assigned", made)
    return sinks.StageStore(spark, root).keeper("allele_calling", "digest", True)("assigned", made.limit(0))


@query("SELECT CAST(n_nationkey AS VARCHAR) AS n_nationkey, n_name, CAST(n_regionkey AS VARCHAR) AS n_regionkey FROM nation")
def k1_workbook(spark, sf_dir):
    path = f"{scratch(spark, 'book')}/book.xlsx"
    sinks.write_bytes(spark, path, sinks.workbook({"regions": table(spark, sf_dir, "region"), "nations": table(spark, sf_dir, "nation")}))
    head, *body = tables.xlsx_rows(sinks.read_bytes(spark, path), 2)
    return spark.createDataFrame(body, ", ".join(f"{h} string" for h in head))


@query(f"WITH {READS_SQL} SELECT file_stem, qname AS read_id, repeat_count_full, repeat_count_match, CAST(cluster_number AS VARCHAR) AS repeat_count_tracts FROM reads")
def k2_written_counts(spark, sf_dir):
    path = scratch(spark, "counts")
    sinks.write_counts(counted_reads(spark, sf_dir).withColumn("repeat_count_tracts", F.col("cluster_number").cast("string")), path)
    kinds = "read_id string, repeat_count_full double, repeat_count_match int, repeat_count_tracts string, file_stem string"
    return spark.read.schema(kinds).option("header", True).option("sep", "\t").csv(path)


@query(
    f"""WITH {READS_SQL}, c AS (SELECT file_stem, cluster_number, count(*) AS n FROM reads GROUP BY 1, 2)
    SELECT file_stem || '_cluster' || lpad(CAST(cluster_number AS VARCHAR), 2, '0') || '_n' || n || '_mode' || 17 || '_prop' || printf('%.3f', n / sum(n) OVER (PARTITION BY file_stem)) || '_mid' AS qname, repeat('CAG', CAST(n AS INTEGER)) AS sequence FROM c"""
)
def k4_consensus_fasta(spark, sf_dir):
    n = counted_reads(spark, sf_dir).groupBy("file_stem", "cluster_number").agg(F.count("*").alias("n_reads"))
    made = n.select("file_stem", "cluster_number", F.col("n_reads").alias("read_count"), *(F.repeat(F.lit(b), F.col("n_reads").cast("int")).alias(f"consensus_{c}") for c, b in (("full", "A"), ("left", "C"), ("mid", "CAG"), ("right", "G"))))
    path = scratch(spark, "consensus")
    exports.export_consensus({"cluster_summary": n.withColumn("mode", F.lit(17.0)), "consensus": made}, path)
    return sequences.read_fasta(spark, f"{path}/consensus_mid").select("qname", "sequence")


@query("SELECT l_returnflag AS file_stem, l_linenumber AS cluster_number, CAST(l_partkey AS INTEGER) AS position_on_reference, l_returnflag AS ref, l_linestatus AS query, 'mismatch' AS variant_type FROM lineitem")
def k5_variants_csv(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("file_stem"), F.col("l_linenumber").alias("cluster_number"), F.col("l_partkey").cast("int").alias("position"), F.col("l_returnflag").alias("ref"), F.col("l_linestatus").alias("query"), F.lit("mismatch").alias("variant_type"))
    path = scratch(spark, "variants")
    exports.write_variants(rows, path)
    return spark.read.schema("file_stem string, cluster_number int, position_on_reference int, ref string, query string, variant_type string").option("header", True).csv(f"{path}/variants_csv")


@query(f"WITH {READS_SQL} SELECT file_stem, CAST(count(*) AS BIGINT) AS n FROM reads GROUP BY 1")
def u7_split_by_key(spark, sf_dir):
    path = scratch(spark, "split")
    sinks.write_split(counted_reads(spark, sf_dir).select("file_stem", "qname"), "file_stem", path)
    return spark.read.schema("qname string, file_stem string").parquet(path).groupBy("file_stem").agg(F.count("*").alias("n"))


@query(
    """SELECT p_partkey, CASE WHEN b < 1024 THEN printf('%.1f B', b) ELSE printf('%.1f KB', b / 1024) END AS size,
    CASE WHEN t < 60 THEN printf('%.1f s', t) WHEN t < 3600 THEN printf('%.1f min', t / 60) ELSE printf('%.2f h', t / 3600) END AS elapsed
    FROM (SELECT p_partkey, CAST(floor(p_retailprice) AS DOUBLE) AS b, p_partkey * 36.0::DOUBLE AS t FROM part)"""
)
def f18_formats(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", sequence.size_text(F.floor("p_retailprice")).alias("size"), sequence.elapsed_text(F.col("p_partkey") * 36.0).alias("elapsed"))


@query("SELECT c_custkey, (SELECT n_name FROM nation WHERE n_nationkey = c_nationkey) AS nation, (SELECT count(*) FROM nation) AS n_names, (SELECT n_name FROM nation WHERE n_nationkey = c_custkey) AS unknown FROM customer")
def f27_named_map(spark, sf_dir):
    names = sequence.named_map(table(spark, sf_dir, "nation"), "n_nationkey", "n_name")
    return table(spark, sf_dir, "customer").join(F.broadcast(names)).select("c_custkey", F.try_element_at("named", F.col("c_nationkey")).alias("nation"), F.cardinality("named").cast("long").alias("n_names"), F.try_element_at("named", F.col("c_custkey").cast("int")).alias("unknown"))  # one row


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
