"""Repeat detection in the mid segment: tract finder, repositioning, counts, policies, flank checks and summaries."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.sequence import count_repeats

TRACT = "struct<start: int, end: int, repeat_count: int>"


def motif_starts(seq: str, motif: str, mismatches: int) -> list[int]:
    """0-based places where the motif stands with at most ``mismatches`` substitutions; they may overlap."""
    n = len(motif)
    if not mismatches:
        out, at = [], seq.find(motif)
        while at >= 0:
            out.append(at)
            at = seq.find(motif, at + 1)
        return out
    return [i for i in range(len(seq) - n + 1) if sum(a != b for a, b in zip(motif, seq[i : i + n], strict=True)) <= mismatches]


def find_tracts(seq: str | None, motif: str = "CAG", min_repeats: int = 2, mismatches: int = 0, start_perfect: int = 2, end_perfect: int = 2, max_gap: int = 6, max_tract_gap: int = 18, choice: str = "longest") -> list[tuple[int, int, int]]:
    """Tracts (start, end, repeats; 1-based, closed) of a sequence: ``first``, ``longest`` or ``all`` of them.

    Matches closer than ``max_gap`` form a tract; tracts of too few repeats go; those closer than ``max_tract_gap`` merge; ends move inwards to the first
    and last perfect block. A tract shorter than that block, or without one, keeps its end.
    """
    n = len(motif)
    starts = motif_starts(seq, motif, mismatches) if seq else []
    runs: list[list[int]] = []
    for s in starts:
        if runs and s - runs[-1][1] <= max_gap:
            runs[-1][1:] = [s + n, runs[-1][2] + 1]
        else:
            runs.append([s, s + n, 1])
    merged: list[list[int]] = []
    for a, b, count in (r for r in runs if r[2] >= min_repeats):
        if merged and a - merged[-1][1] <= max_tract_gap:
            merged[-1][1:] = [b, merged[-1][2] + count]
        else:
            merged.append([a, b, count])
    out = []
    for a, b, count in merged:
        head, tail = motif * start_perfect, motif * end_perfect
        first = seq.find(head, a, b) if len(head) <= b - a else -1
        start = first if first >= 0 else a
        last = seq.rfind(tail, start, b) if len(tail) <= b - start else -1
        out.append((start + 1, last + len(tail) if last >= 0 else b, count))
    if choice == "first":
        return out[:1]
    if choice == "longest":
        return sorted(out, key=lambda t: t[0] - t[1])[:1]
    if choice != "all":
        raise ValueError(f"unknown choice of tracts: {choice}")
    return out


def tracts(seq: Column, **options) -> Column:
    """Array of (start, end, repeat_count) of a sequence column; empty without a tract."""

    @F.arrow_udf(f"array<{TRACT}>")
    def found(column: Iterator[pa.Array]) -> Iterator[pa.Array]:
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("repeat_count", pa.int32())]))
        for part in column:
            yield pa.array([[dict(zip(("start", "end", "repeat_count"), t, strict=True)) for t in find_tracts(x, **options)] for x in part.to_pylist()], kind)

    return found(seq)


def cut_tract(rows: DataFrame, **options) -> DataFrame:
    """mid_1, mid_2, mid_3: what stands before the tract, the tract, and what stands behind; without one all is mid_1.

    ``choice='all'`` gives a row for each tract, numbered by tract_number.
    """
    made = rows.withColumn("_tracts", tracts(F.col("mid"), **options))
    if options.get("choice") == "all":
        made = made.select("*", F.posexplode_outer("_tracts").alias("_i", "_t")).withColumn("tract_number", F.col("_i") + 1).drop("_i")
    else:
        made = made.withColumn("_t", F.get("_tracts", F.lit(0)))
    t, mid = F.col("_t"), F.col("mid")
    cut = lambda a, b: F.nullif(F.substring(mid, a, b - a + 1), F.lit(""))
    return made.withColumns({
        "mid_1": F.when(t.isNull(), mid).otherwise(cut(F.lit(1), t["start"] - 1)),
        "mid_2": F.when(t.isNotNull(), cut(t["start"], t["end"])),
        "mid_3": F.when(t.isNotNull(), cut(t["end"] + 1, F.length(mid))),
        "pattern_start": t["start"], "pattern_end": t["end"], "pattern_count": t["repeat_count"],
    }).drop("_tracts", "_t")


def reposition(rows: DataFrame) -> DataFrame:
    """What stands around the tract moves to the flanks; mid becomes the tract."""
    blank = lambda c: F.coalesce(F.col(c), F.lit(""))
    moved = {"left": F.concat(blank("left"), blank("mid_1")), "right": F.concat(blank("mid_3"), blank("right")), "mid": F.col("mid_2")}
    return rows.withColumns(moved).drop("mid_1", "mid_2", "mid_3")


def detect_repeats(split: DataFrame, motif: str = "CAG", method: str = "repeat_count_full", digits: int = 0, **options) -> DataFrame:
    """Tract, repositioned segments and counts of every read; ``repeat_count`` is the chosen method's."""
    rows = reposition(cut_tract(split, motif=motif, **options))
    return rows.withColumns(count_repeats(F.col("mid"), motif, digits)).withColumn("repeat_count", F.col(method).cast("double"))


def missing_counts(rows: DataFrame, policy: str = "convert_to_zero") -> DataFrame:
    """Reads without a count: ``convert_to_zero`` (the run text stays null), ``filter``, or anything else keeps them."""
    if policy == "filter":
        return rows.filter("repeat_count is not null")
    if policy == "convert_to_zero":
        return rows.fillna(0, [c for c in ("repeat_count", "repeat_count_full", "repeat_count_match") if c in rows.columns])
    return rows


def flank_total() -> Column:
    return F.coalesce(F.length("left"), F.lit(0)) + F.coalesce(F.length("right"), F.lit(0))


def flank_fences(rows: DataFrame, total: Column | None = None, has_mid: Column | None = None) -> DataFrame:
    """Quartiles of the flanks' total length of each sample, over reads with a mid segment."""
    total = flank_total() if total is None else total
    has_mid = (F.coalesce(F.length("mid"), F.lit(0)) > 0) if has_mid is None else has_mid
    q = rows.filter(has_mid).groupBy("file_stem").agg(F.percentile(total, F.array(F.lit(0.25), F.lit(0.75))).alias("q"))
    return q.select("file_stem", F.get("q", F.lit(0)).alias("fq1"), F.get("q", F.lit(1)).alias("fq3"))


def flank_filter(rows: DataFrame, multiplier: float = 1.5, total: Column | None = None, has_mid: Column | None = None) -> DataFrame:
    """Reads whose flanks lie within the fences. Samples whose quartiles agree keep all reads; those without any mid segment have no fences and lose all."""
    total = flank_total() if total is None else total
    spread = F.col("fq3") - F.col("fq1")
    kept = (spread == 0) | total.between(F.col("fq1") - multiplier * spread, F.col("fq3") + multiplier * spread)
    return rows.join(flank_fences(rows, total, has_mid), "file_stem", "left").filter(kept).drop("fq1", "fq3")


def flank_summary(rows: DataFrame, total: Column | None = None) -> DataFrame:
    """Spread of the flanks' total length, its mode, and deviations from it in bands."""
    total = flank_total() if total is None else total
    base = rows.select("file_stem", total.alias("t"))
    mode = base.groupBy("file_stem", "t").agg(F.count("*").alias("c")).groupBy("file_stem").agg(F.min_by("t", F.struct((-F.col("c")).alias("a"), F.col("t").alias("b"))).alias("modal"))
    rows = base.join(mode, "file_stem")
    off, n = F.abs(F.col("t") - F.col("modal")), F.count("*")
    q = F.percentile("t", F.array(F.lit(0.25), F.lit(0.75)))
    return rows.groupBy("file_stem").agg(
        n.alias("n"), F.avg("t").alias("mean"), F.stddev_samp("t").alias("sd"), (F.get(q, F.lit(1)) - F.get(q, F.lit(0))).alias("iqr"), F.first("modal").alias("modal"),
        (100 * F.count_if(off == 0) / n).alias("percent_at_modal"), F.min("t").alias("min"), F.max("t").alias("max"),
        F.count_if(off == 0).alias("at_modal"), F.count_if(off.between(1, 10)).alias("off_1_10"), F.count_if(off.between(11, 50)).alias("off_11_50"), F.count_if(off > 50).alias("off_over_50"),
    )


def fence_sweep(rows: DataFrame, multipliers: tuple[float, ...] = (1, 1.5, 2, 3, 5, 10), total: Column | None = None, has_mid: Column | None = None) -> DataFrame:
    """Percent of reads outside the fences for several multipliers, side by side; equal quartiles are not exempt."""
    total = flank_total() if total is None else total
    base = rows.join(flank_fences(rows, total, has_mid), "file_stem")
    spread = F.col("fq3") - F.col("fq1")
    out = [(100 * F.count_if(~total.between(F.col("fq1") - m * spread, F.col("fq3") + m * spread)) / F.count("*")).alias(f"removed_{str(m).replace('.', '_')}") for m in multipliers]
    return base.groupBy("file_stem").agg(*out)


def repeat_summary(rows: DataFrame, value: str = "repeat_count") -> DataFrame:
    """Reads, centre, mode (least of equals), spread and quartiles of the counts of each sample."""
    x = F.col(value)
    mode = rows.filter(x.isNotNull()).groupBy("file_stem", x.alias("x")).agg(F.count("*").alias("c")).groupBy("file_stem").agg(F.min_by("x", F.struct((-F.col("c")).alias("a"), F.col("x").alias("b"))).alias("mode"))
    q = F.percentile(x, F.array(F.lit(0.25), F.lit(0.75)))
    out = rows.groupBy("file_stem").agg(F.count("*").alias("n_reads"), F.median(x).alias("median"), F.avg(x).alias("mean"), F.min(x).alias("min"), F.max(x).alias("max"), (F.max(x) - F.min(x)).alias("range"), F.stddev_samp(x).alias("sd"), F.get(q, F.lit(0)).alias("q25"), F.get(q, F.lit(1)).alias("q75"))
    return out.join(mode, "file_stem", "left")


def detection_summary(rows: DataFrame, value: str = "repeat_count_full") -> DataFrame:
    found = F.col(value).isNotNull()
    return rows.groupBy("file_stem").agg(F.count("*").alias("total"), F.count_if(found).alias("with_repeat"), F.count_if(~found).alias("without_repeat"), (F.count_if(found) / F.count("*")).alias("detection_rate"), F.avg(value).alias("mean"), F.median(value).alias("median"))


def method_comparison(rows: DataFrame) -> DataFrame:
    """Means and medians of both count methods, their difference, and how often they agree."""
    full, match = F.col("repeat_count_full"), F.col("repeat_count_match")
    return rows.groupBy("file_stem").agg(F.avg(full).alias("mean_full"), F.avg(match).alias("mean_match"), F.median(full).alias("median_full"), F.median(match).alias("median_match"), F.avg(full - match).alias("mean_difference"), F.avg(F.when(F.bround(full, 0) == match, 1.0).when(full.isNotNull() & match.isNotNull(), 0.0)).alias("concordance"))


def heatmap(rows: DataFrame, width: float = 1, value: str = "repeat_count") -> DataFrame:
    """Reads of each sample by bin of counts, as shares of the sample."""
    bins = rows.filter(F.col(value).isNotNull()).groupBy("file_stem", (F.floor(F.col(value) / width) * width).cast("double").alias("bin")).agg(F.count("*").alias("n"))
    return bins.withColumn("fraction", F.col("n") / F.sum("n").over(Window.partitionBy("file_stem")))
