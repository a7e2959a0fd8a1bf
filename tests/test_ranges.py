"""Range metrics against hand-computed values."""

import math

import pytest
from pyspark.sql import functions as F

from strandlake.functions.brackets import expand_settings
from strandlake.operators import ranges


def tables(spark, counts, low=None, high=None, floor=None, most=2):
    rows = [("s", float(x)) for x, n in counts.items() for _ in range(n)]
    reads = spark.createDataFrame(rows, "file_stem string, repeat_count double")
    bounds = spark.createDataFrame([("s", "range1", low, high, floor, most)], "file_stem string, analysis_range_name string, window_min double, window_max double, floor double, max_peaks int")
    c = ranges.sample_counts(reads)
    b = ranges.range_bounds(bounds, c)
    return ranges.length_freq(c, b), b


COUNTS = {15: 1, 16: 2, 17: 6, 18: 3, 19: 1, 40: 1}


@pytest.mark.parametrize(
    ("floor", "want"),
    [
        (None, {"n_reads_total": 14, "n_reads_used": 14, "modal_length": 17, "modal_frequency": 6, "mean_length": 18.714286, "median_length": 17, "sd": 6.207050, "sem": 1.658904, "interquartile_range": 1.0, "percentile_5th": 15.65, "percentile_95th": 26.35, "skewness": 3.178371, "kurtosis": 11.476149, "gini_coefficient": 0.380952, "reads_below_modal": 3, "reads_above_modal": 5, "tail_balance": 0.25, "entropy_normalised": 0.857661, "peak_sharpness": 2.571429}),
        (2.0, {"n_reads_total": 14, "n_reads_used": 11, "modal_length": 17, "mean_length": 17.090909, "sd": 0.700649, "sem": 0.211254, "interquartile_range": 0.5, "percentile_5th": 16, "percentile_95th": 18, "skewness": -0.105842, "kurtosis": 2.228395, "gini_coefficient": 0.242424, "reads_below_modal": 2, "reads_above_modal": 3, "tail_balance": 0.2, "entropy_normalised": 0.905619, "peak_sharpness": 1.636364, "floor_threshold": 2}),
    ],
)
def test_distribution(spark, floor, want):
    got = ranges.distribution_summary(*tables(spark, COUNTS, floor=floor)).first().asDict()
    for k, v in want.items():
        assert got[k] == pytest.approx(v, abs=1e-6), k


def test_distribution_edges(spark):
    one = ranges.distribution_summary(*tables(spark, {20: 1}, floor=3.0)).first()
    assert (one.modal_length, one.mean_length, one.median_length, one.modal_frequency, one.n_reads_analysed, one.sd, one.n_reads_used) == (20, 20, 20, 1, 1, None, 1)
    none = ranges.distribution_summary(*tables(spark, COUNTS, 100.0, 200.0)).first()
    assert (none.n_reads_total, none.modal_length, none.n_reads_used) == (0, None, None)
    cut = ranges.distribution_summary(*tables(spark, COUNTS, floor=99.0)).first()
    assert (cut.n_reads_total, cut.n_reads_used, cut.modal_length, cut.floor_threshold) == (14, 0, None, 99)
    share = ranges.floored(tables(spark, COUNTS, floor=0.5)[0])
    assert sorted(r.length for r in share.collect()) == [17, 18]


@pytest.mark.parametrize(
    ("counts", "most", "want"),
    [
        (COUNTS, 2, [(17, 6, 1)]),
        ({14: 3, 15: 5, 16: 2, 40: 4, 41: 7, 42: 1}, 2, [(41, 7, 1), (15, 5, 2)]),
        ({14: 3, 15: 5, 16: 2, 40: 4, 41: 7, 42: 1}, 1, [(41, 7, 1)]),
        ({17: 6, 18: 3}, 2, [(17, 6, 1)]),
        ({10: 9, 11: 5, 12: 1}, 2, [(10, 9, 1)]),
        ({10: 1, 11: 5, 12: 5, 13: 1}, 2, [(11, 5, 1)]),
    ],
)
def test_peaks(spark, counts, most, want):
    got = ranges.modal_peaks(*tables(spark, counts, most=most)).orderBy("peak_rank").collect()
    assert [(r.modal_length, r.modal_frequency, r.peak_rank) for r in got] == want


def test_no_peak_gives_nulls(spark):
    got = ranges.modal_peaks(*tables(spark, COUNTS, 100.0, 200.0)).collect()
    assert [(r.modal_length, r.modal_frequency, r.peak_rank) for r in got] == [(None, None, None)]


@pytest.mark.parametrize(
    ("s", "floor", "want"),
    [
        (17.0, None, {"instability_index": 1.714286, "expansion_index": 5.6, "contraction_index": -1.333333, "reads_at_setpoint": 6, "reads_below_setpoint": 3, "reads_above_setpoint": 5, "contraction_ratio": 0.5, "expansion_ratio": 0.833333, "total_tail_ratio": 1.333333, "expansion_vs_contraction_balance": 1.666667}),
        (17.0, 2.0, {"instability_index": 0.090909, "expansion_index": 1.0, "contraction_index": -1.0, "expansion_vs_contraction_balance": 1.5}),
        (16.5, 2.0, {"instability_index": 0.590909, "expansion_index": 0.833333, "contraction_index": -0.5, "reads_at_setpoint": 2, "reads_below_setpoint": 0, "reads_above_setpoint": 9, "contraction_ratio": 0, "expansion_ratio": 4.5, "expansion_vs_contraction_balance": math.inf}),
    ],
)
def test_instability(spark, s, floor, want):
    freq, bounded = tables(spark, COUNTS, floor=floor)
    points = bounded.select("file_stem", "analysis_range_name", F.lit("sample_relative").alias("setpoint_type"), F.lit(s).alias("setpoint"), F.lit(s).alias("sample_setpoint"), F.lit(None).cast("double").alias("control_setpoint"), F.lit(None).cast("double").alias("control_sd"), *(F.lit(s).alias(f"{m}_length") for m in ("modal", "mean", "median")))
    got = ranges.instability(freq, points).first().asDict()
    for k, v in want.items():
        assert got[k] == (v if math.isinf(v) else pytest.approx(v, abs=1e-6)), k


@pytest.mark.parametrize(("method", "want"), [("mean", 21), ("median", 17), ("trimmed_mean", 21)])
def test_controls(spark, method, want):
    rows = spark.createDataFrame([("g", "range1", f"s{i}", float(x)) for i, x in enumerate((16, 17, 30))], "`group` string, analysis_range_name string, file_stem string, median_length double")
    got = ranges.control_setpoints(rows, method=method).first()
    assert got.control_setpoint == pytest.approx(want)
    assert got.control_sd == pytest.approx(7.810250, abs=1e-6)
    assert got.control_n == 3


def test_settings_language(spark):
    df = spark.createDataFrame([("a", "[0-35][36-NA]", "[3][0.05]", "2"), ("b", None, "3", "1")], "file_stem string, analysis_ranges string, floor string, max_peaks string")
    got = [tuple(r) for r in expand_settings(df).orderBy("analysis_range_name").collect()]
    assert got == [("a", "range1", 0.0, 35.0, 3.0, 2), ("a", "range2", 36.0, None, 0.05, 2)]
    with pytest.raises(Exception, match="min-max"):
        expand_settings(df.withColumn("analysis_ranges", F.lit("[0-35-40]"))).collect()


def test_plan_has_no_cartesian_product(spark):
    freq, bounded = tables(spark, COUNTS)
    assert "CartesianProduct" not in ranges.distribution_summary(freq, bounded)._jdf.queryExecution().toString()
