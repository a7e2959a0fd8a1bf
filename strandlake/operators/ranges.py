"""Range analysis on the frequency table of repeat lengths: boundaries, peaks, distribution, controls, instability.

Reads are reduced to (sample, range, length, freq) once, with map-side combining; every metric is a weighted aggregate of that table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KEY = ("file_stem", "analysis_range_name")


def sample_counts(reads: DataFrame, length: str = "repeat_count") -> DataFrame:
    """(file_stem, length, freq) of the reads that have a length."""
    return reads.filter(F.col(length).isNotNull()).groupBy("file_stem", F.col(length).cast("double").alias("length")).agg(F.count("*").alias("freq"))


def range_bounds(ranges: DataFrame, counts: DataFrame) -> DataFrame:
    """``ranges`` with range_min and range_max: open ends take the sample's own least and largest length."""
    # The filter, always true, keeps freq in this branch: both uses of the counts then share one exchange and one scan of the reads.
    ends = counts.filter("freq > 0").groupBy("file_stem").agg(F.min("length").alias("sample_min"), F.max("length").alias("sample_max"))
    out = ranges.join(ends, "file_stem", "left")
    return out.withColumns({"range_min": F.coalesce("window_min", "sample_min"), "range_max": F.coalesce("window_max", "sample_max")}).drop("sample_min", "sample_max")


def length_freq(counts: DataFrame, bounded: DataFrame) -> DataFrame:
    """The frequency table of each sample and range, closed at both ends; a length counts in every range that holds it."""
    hit = (F.col("length") >= F.col("range_min")) & (F.col("length") <= F.col("range_max"))
    return counts.join(bounded, "file_stem").filter(hit).select(*KEY, "length", "freq", "floor", "max_peaks")


def floored(freq: DataFrame) -> DataFrame:
    """Lengths at least as frequent as the floor: below one a share of the largest frequency, null no floor."""
    top = F.max("freq").over(Window.partitionBy(*KEY))
    limit = F.when(F.col("floor") < 1, F.col("floor") * top).otherwise(F.col("floor"))
    return freq.withColumn("floor_threshold", limit).filter(F.col("floor").isNull() | (F.col("freq") >= F.col("floor_threshold")))


def range_boundaries(bounded: DataFrame, freq: DataFrame) -> DataFrame:
    """Settings, analysis and observed ends of every range with its reads."""
    seen = freq.groupBy(*KEY).agg(F.min("length").alias("observed_min"), F.max("length").alias("observed_max"), F.sum("freq").alias("n_reads"))
    out = bounded.join(seen, list(KEY), "left")
    return out.select(*KEY, F.col("window_min").alias("settings_min"), F.col("window_max").alias("settings_max"), "range_min", "range_max", "observed_min", "observed_max", F.coalesce("n_reads", F.lit(0).cast("long")).alias("n_reads"))


def modal_peaks(freq: DataFrame, bounded: DataFrame, span: int = 3) -> DataFrame:
    """The highest strict local maxima of each floored table, ``max_peaks`` at most; else its most frequent length.

    Neighbours are neighbouring rows of the table; its ends are no peaks. Ranges without a row get one row of nulls.
    """
    near = Window.partitionBy(*KEY).orderBy("length")
    whole = Window.partitionBy(*KEY)
    rows = floored(freq).withColumns({"before": F.lag("freq").over(near), "after": F.lead("freq").over(near), "n": F.count("*").over(whole)})
    peak = F.col("before").isNotNull() & F.col("after").isNotNull() & (F.col("freq") > F.col("before")) & (F.col("freq") > F.col("after")) & (F.col("n") >= span)
    rows = rows.withColumn("peak", peak).withColumn("any_peak", F.max(F.col("peak").cast("int")).over(whole) == 1)
    rank = F.row_number().over(Window.partitionBy(*KEY).orderBy(F.desc("peak"), F.desc("freq"), "length"))
    best = rows.withColumn("peak_rank", rank).filter((F.col("any_peak") & F.col("peak") & (F.col("peak_rank") <= F.col("max_peaks"))) | (~F.col("any_peak") & (F.col("peak_rank") == 1)))
    best = best.select(*KEY, F.col("length").alias("modal_length"), F.col("freq").alias("modal_frequency"), "peak_rank")
    return bounded.select(*KEY).join(best, list(KEY), "left")


def peaks_wide(peaks: DataFrame, most: int) -> DataFrame:
    """One row for each sample and range: peak1_length, peak1_frequency, ... up to ``most``."""
    wide = [F.max(F.when(F.col("peak_rank") == i, F.col(c))).alias(f"peak{i}_{n}") for i in range(1, most + 1) for c, n in (("modal_length", "length"), ("modal_frequency", "frequency"))]
    return peaks.groupBy(*KEY).agg(*wide)


def comprehensive_summary(boundaries: DataFrame, peaks: DataFrame, summary: DataFrame, meta: DataFrame, most: int = 5) -> DataFrame:
    """Boundaries, peaks side by side, distribution and sample settings of every range in one row."""
    wide = peaks_wide(peaks, most)
    return boundaries.join(wide, list(KEY), "left").join(summary, list(KEY), "left").join(meta, "file_stem", "left")


def _ratio(a: Column, b: Column) -> Column:
    return F.try_divide(a.cast("double"), b.cast("double"))


def distribution_summary(freq: DataFrame, bounded: DataFrame) -> DataFrame:
    """Centre, spread, shape and tails of every sample and range, on its floored table.

    A range with one read has its length as mode, mean and median and nothing else, whatever the floor; a range that the floor
    empties has nulls and n_reads_used 0; without reads all is null and n_reads_total 0.
    """
    totals = freq.groupBy(*KEY).agg(F.sum("freq").alias("n_reads_total"), F.max("length").alias("only"), F.max("freq").alias("top"))
    whole = Window.partitionBy(*KEY)
    mode = F.first("length").over(whole.orderBy(F.desc("freq"), "length").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    kept = floored(freq).withColumns({"mode": mode, "n": F.sum("freq").over(whole), "mean": F.sum(F.col("length") * F.col("freq")).over(whole) / F.sum("freq").over(whole), "i": F.row_number().over(whole.orderBy("freq", "length"))})
    x, y, n = F.col("length"), F.col("freq").cast("double"), F.col("n").cast("double")
    d, p = x - F.col("mean"), y / n
    stats = kept.groupBy(*KEY).agg(
        F.max("mode").alias("modal_length"), F.max("freq").alias("modal_frequency"), F.max("mean").alias("mean_length"),
        F.percentile(x, F.array(*map(F.lit, (0.05, 0.25, 0.5, 0.75, 0.95))), F.col("freq")).alias("q"),
        F.min(x).alias("min_length"), F.max(x).alias("max_length"), F.max("n").alias("n_reads_used"), F.count("*").alias("rows"), F.avg(y).alias("mean_freq"),
        F.sum(d * d * y).alias("m2"), F.sum(d * d * d * y).alias("m3"), F.sum(d * d * d * d * y).alias("m4"),
        F.sum((2 * F.col("i") - 1) * y).alias("ranked"), F.sum(F.when(x < F.col("mode"), F.col("freq")).otherwise(0)).alias("reads_below_modal"),
        F.sum(F.when(x > F.col("mode"), F.col("freq")).otherwise(0)).alias("reads_above_modal"), F.sum(-p * F.log(p + 1e-10)).alias("entropy"),
    )
    out = bounded.select(*KEY, F.col("floor").alias("floor_set")).join(totals, list(KEY), "left").join(stats, list(KEY), "left")
    total, used = F.coalesce("n_reads_total", F.lit(0).cast("long")), F.col("n_reads_used")
    one = total == 1
    m2, m3, m4, below, above, top = (F.col(c).cast("double") for c in ("m2", "m3", "m4", "reads_below_modal", "reads_above_modal", "modal_frequency"))
    sd = F.when(used > 1, F.sqrt(_ratio(m2, used - 1)))
    low, high = _ratio(below, used), _ratio(above, used)
    rows = F.col("rows")
    limit = F.when(F.col("floor_set") < 1, F.col("floor_set") * F.col("top")).otherwise(F.col("floor_set"))

    def many(value: Column) -> Column:
        return F.when(~one, value)

    def single(value: Column, alone: Column) -> Column:
        return F.when(one, alone).otherwise(value)

    only = F.col("only")
    return out.select(
        *KEY,
        single(F.col("modal_length"), only).alias("modal_length"),
        single(F.col("modal_frequency"), F.lit(1).cast("long")).alias("modal_frequency"),
        single(F.col("mean_length"), only).alias("mean_length"),
        many(F.col("mean_length") - F.col("modal_length")).alias("mean_to_modal_difference"),
        single(F.get("q", F.lit(2)), only).alias("median_length"),
        many(F.col("min_length")).alias("min_length"),
        many(F.col("max_length")).alias("max_length"),
        many(F.col("max_length") - F.col("min_length")).alias("range_length"),
        many(sd).alias("sd"),
        many(sd / F.sqrt(used)).alias("sem"),
        many(F.when(F.col("mean_length") != 0, sd / F.col("mean_length"))).alias("coefficient_of_variation"),
        many(F.get("q", F.lit(3)) - F.get("q", F.lit(1))).alias("interquartile_range"),
        many(F.get("q", F.lit(0))).alias("percentile_5th"),
        many(F.get("q", F.lit(4))).alias("percentile_95th"),
        many(_ratio(m3 / used, F.pow(m2 / used, 1.5))).alias("skewness"),
        many(_ratio(m4 / used, F.pow(m2 / used, 2.0))).alias("kurtosis"),
        many(_ratio(F.col("ranked") - rows * used, rows * used)).alias("gini_coefficient"),
        single(used, F.lit(1).cast("long")).alias("n_reads_analysed"),
        many(F.col("reads_below_modal")).alias("reads_below_modal"),
        many(F.col("reads_above_modal")).alias("reads_above_modal"),
        many(low).alias("contraction_proportion"),
        many(high).alias("expansion_proportion"),
        many(_ratio(high - low, high + low)).alias("tail_balance"),
        many(_ratio(below, top)).alias("contraction_to_modal_ratio"),
        many(_ratio(above, top)).alias("expansion_to_modal_ratio"),
        many(_ratio(above - below, above + below)).alias("tail_modal_balance"),
        many(F.when(rows > 1, F.col("entropy") / F.log(F.nullif(rows, F.lit(1)).cast("double")))).alias("entropy_normalised"),
        many(_ratio(top, F.col("mean_freq"))).alias("peak_sharpness"),
        F.when((total > 1) & used.isNull(), limit).otherwise(F.col("floor_set")).alias("floor_threshold"),
        total.alias("n_reads_total"),
        F.when(total == 0, None).when(one, F.lit(1).cast("long")).otherwise(F.coalesce(used, F.lit(0).cast("long"))).alias("n_reads_used"),
    )


def finite_only(rows: DataFrame) -> DataFrame:
    """``rows`` with NaN and infinite doubles made null."""
    return rows.select(*(F.when(~F.isnan(c) & (F.abs(c) != float("inf")), F.col(c)).alias(c) if t == "double" else F.col(c) for c, t in rows.dtypes))


def control_samples(summary: DataFrame, meta: DataFrame, metric: str = "median_length", selection: str = "flagged", strict: bool = False) -> DataFrame:
    """Rows that may set a group's control: not excluded, in a group, with the metric; flagged, earliest or all of them.

    ``strict`` takes any value of the flag as true; otherwise it must read as true.
    """
    rows = finite_only(summary).join(meta, "file_stem").filter(F.col("exclude").isNull() & F.col(metric).isNotNull() & F.col("group").isNotNull())
    if selection == "flagged":
        flag = F.col("group_control_sample").cast("string")
        return rows.filter(flag.isNotNull() if strict else F.lower(flag).isin("true", "t", "1", "yes", "y"))
    if selection == "earliest":
        return rows.withColumn("first_time", F.min("time").over(Window.partitionBy("group", "analysis_range_name"))).filter("time = first_time").drop("first_time")
    if selection != "all":
        raise ValueError(f"unknown selection of controls: {selection}")
    return rows


def trimmed_mean(column: str, share: float = 0.1) -> Column:
    """Mean without the ``share`` of values (rounded down) at each end; for groups of samples, not of reads."""
    values = F.sort_array(F.collect_list(column))
    cut = F.floor(F.size(values) * share).cast("int")
    kept = F.slice(values, cut + 1, F.size(values) - 2 * cut)
    return F.try_divide(F.aggregate(kept, F.lit(0.0), lambda total, x: total + x), F.size(kept))


def control_setpoints(controls: DataFrame, metric: str = "median_length", method: str = "median") -> DataFrame:
    """(group, range) -> control_setpoint, control_sd, control_sem, control_n, and the aggregates of all three centres that are there.

    ``method`` is mean, median or trimmed_mean (a tenth at each end).
    """
    how = {"mean": F.avg, "median": F.median, "trimmed_mean": trimmed_mean}
    if method not in how:
        raise ValueError(f"unknown way to aggregate controls: {method}")
    sd = F.stddev_samp(metric)
    centres = [how[method](c).alias(f"control_{c}") for c in ("modal_length", "mean_length", "median_length") if c in controls.columns]
    return controls.groupBy("group", "analysis_range_name").agg(how[method](metric).alias("control_setpoint"), sd.alias("control_sd"), (sd / F.sqrt(F.count("*"))).alias("control_sem"), F.count("*").alias("control_n"), *centres)


def setpoints(summary: DataFrame, meta: DataFrame, controls: DataFrame, metric: str = "median_length") -> DataFrame:
    """Each sample's own setpoint and, where its group has one, the control's."""
    base = summary.filter(F.col(metric).isNotNull()).select(*KEY, F.col(metric).alias("sample_setpoint"), "modal_length", "mean_length", "median_length")
    rows = base.join(meta.select("file_stem", "group"), "file_stem", "left").join(controls.select("group", "analysis_range_name", "control_setpoint", "control_sd", "control_sem", "control_n"), ["group", "analysis_range_name"], "left")
    own = rows.withColumn("setpoint_type", F.lit("sample_relative")).withColumn("setpoint", F.col("sample_setpoint"))
    other = rows.filter("control_setpoint is not null").withColumn("setpoint_type", F.lit("control_relative")).withColumn("setpoint", F.col("control_setpoint"))
    return own.unionByName(other)


def instability(freq: DataFrame, points: DataFrame) -> DataFrame:
    """Signed mean distance from each setpoint, tails around its rounded value, and their ratios."""
    whole = Window.partitionBy(*KEY)
    total = F.sum("freq").over(whole)
    kept = floored(freq.withColumn("n_reads_total", total)).select(*KEY, "length", "freq", "floor_threshold", "n_reads_total")
    limits = freq.groupBy(*KEY).agg(F.sum("freq").alias("all_reads"), F.max("freq").alias("top"), F.max("floor").alias("floor"))
    x, y, s = F.col("length"), F.col("freq"), F.col("setpoint")
    at = F.bround(s, 0)
    part = lambda cond, v: F.sum(F.when(cond, v))
    stats = points.join(kept, list(KEY)).groupBy(*KEY, "setpoint_type").agg(
        (F.sum(y * (x - s)) / F.sum(y)).alias("instability_index"),
        F.try_divide(part(x > s, y * (x - s)), part(x > s, y)).alias("expansion_index"),
        F.try_divide(part(x < s, y * (x - s)), part(x < s, y)).alias("contraction_index"),
        F.coalesce(part(x == at, y), F.lit(0)).cast("long").alias("reads_at_setpoint"),
        F.coalesce(part(x < at, y), F.lit(0)).cast("long").alias("reads_below_setpoint"),
        F.coalesce(part(x > at, y), F.lit(0)).cast("long").alias("reads_above_setpoint"),
        F.sum(y).alias("n_reads_used"),
    )
    out = points.join(limits, list(KEY)).join(stats, [*KEY, "setpoint_type"], "left")
    low, mid, high = (F.col(f"reads_{c}_setpoint").cast("double") for c in ("below", "at", "above"))
    left, right = F.when(mid > 0, low / F.nullif(mid, F.lit(0.0))), F.when(mid > 0, high / F.nullif(mid, F.lit(0.0)))
    z = F.when((F.col("control_sd") > 0) & (F.col("setpoint_type") == "control_relative"), (F.col("sample_setpoint") - F.col("control_setpoint")) / F.nullif(F.col("control_sd"), F.lit(0.0)))
    return out.select(
        *KEY, "setpoint_type", F.col("setpoint").alias("setpoint_repeat_length"), "instability_index", "expansion_index", "contraction_index",
        "reads_at_setpoint", "reads_below_setpoint", "reads_above_setpoint", left.alias("contraction_ratio"), right.alias("expansion_ratio"),
        F.when(mid > 0, (low + high) / F.nullif(mid, F.lit(0.0))).alias("total_tail_ratio"),
        F.when(low > 0, F.try_divide(right, left)).when(high > 0, F.lit(float("inf"))).alias("expansion_vs_contraction_balance"),
        F.when(F.col("floor") < 1, F.col("floor") * F.col("top")).otherwise(F.col("floor")).alias("floor_threshold"),
        F.col("all_reads").alias("n_reads_total"), F.coalesce("n_reads_used", F.lit(0).cast("long")).alias("n_reads_used"),
        F.when(F.col("setpoint_type") == "control_relative", F.col("control_sd")).alias("control_sd"), z.alias("z_score"),
        *((F.col(f"{m}_length") - s).alias(f"{m}_diff") for m in ("modal", "median", "mean")),
    )
