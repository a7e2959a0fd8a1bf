"""The tables behind the reports' plots; drawing them is left to other tools."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.sequence import axis_step
from ..operators.reads import downsample


def waterfall_rows(reads: DataFrame, value: str = "repeat_count") -> DataFrame:
    """Reads with a mid segment and a cluster, with the lengths of their segments."""
    out = reads.filter("mid is not null and cluster_number is not null")
    return out.withColumns({f"{s}_length": F.coalesce(F.length(s), F.lit(0)) for s in ("left", "mid", "right")} | {"repeat_length": F.col(value)})


def waterfall_order(rows: DataFrame, most: int = 1000) -> DataFrame:
    """At most ``most`` reads of a sample, the longest repeats first, with their row and the axis step."""
    some = downsample(rows, most)
    order = Window.partitionBy("file_stem").orderBy(F.desc("repeat_length"), "cluster_number", "qname")
    return some.withColumns({"read_order": F.row_number().over(order), "axis_step": axis_step(F.count("*").over(Window.partitionBy("file_stem")))})


def waterfall_bases(rows: DataFrame) -> DataFrame:
    """One row for each base: the left flank ends at -1, the repeat starts at 0, the right flank follows it."""
    keep = ["file_stem", "qname", "read_order", "cluster_number", "repeat_length"]
    mid = F.coalesce(F.length("mid"), F.lit(0))
    parts = [("left", -F.length("left")), ("mid", F.lit(0)), ("right", mid)]
    segments = F.array(*(F.struct(F.lit(name).alias("segment"), F.coalesce(F.col(name), F.lit("")).alias("bases"), F.coalesce(start, F.lit(0)).cast("int").alias("start")) for name, start in parts))
    rows = rows.select(*keep, F.explode(segments).alias("s")).filter("s.bases <> ''")
    rows = rows.select(*keep, "s.segment", F.col("s.start").alias("start"), F.posexplode(F.split("s.bases", "")).alias("i", "base"))
    return rows.filter("base <> ''").select(*keep, "segment", (F.col("start") + F.col("i")).alias("position"), "base")


def waterfall_summary(reads: DataFrame) -> DataFrame:
    used = F.col("mid").isNotNull() & F.col("cluster_number").isNotNull()
    return reads.groupBy("file_stem").agg(F.count_if(used).alias("n_reads"), F.count("*").alias("total"), F.count_distinct(F.when(used, F.col("cluster_number"))).alias("n_clusters"), F.avg(F.when(used, F.length("mid"))).alias("mean_mid_bp"))


def large_clusters(reads: DataFrame, least: int = 5) -> DataFrame:
    return reads.groupBy("file_stem", "cluster_number").agg(F.count("*").alias("n_reads")).filter(F.col("n_reads") >= least)


def histogram(rows: DataFrame, width: int = 1, value: str = "repeat_count") -> DataFrame:
    bins = (F.floor(F.col(value) / width) * width).cast("double")
    return rows.filter(F.col(value).isNotNull()).groupBy("file_stem", bins.alias("bin")).agg(F.count("*").alias("n"))


def tagged_density(freq: DataFrame) -> DataFrame:
    """Share of each length among the reads of its sample and range."""
    return freq.withColumn("share", F.col("freq") / F.sum("freq").over(Window.partitionBy("file_stem", "analysis_range_name")))


def long_metrics(summary: DataFrame, columns: list[str]) -> DataFrame:
    """(file_stem, analysis_range_name, metric, value) of chosen columns."""
    cast = summary.select("file_stem", "analysis_range_name", *(F.col(c).cast("double").alias(c) for c in columns))
    return cast.unpivot(["file_stem", "analysis_range_name"], columns, "metric", "value")


def regression(rows: DataFrame, x: str, y: str, key: tuple[str, ...] = ()) -> DataFrame:
    """Slope, intercept and R2 of y on x."""
    stats = [F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"), F.regr_r2(y, x).alias("r2"), F.regr_count(y, x).alias("n")]
    return rows.groupBy(*key).agg(*stats)


def experiment_map(meta: DataFrame) -> DataFrame:
    return meta.groupBy("group", "time").agg(F.count("*").alias("n"))
