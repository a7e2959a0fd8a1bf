"""Alignment tables: dual-flank filter, strand correction, flank order, exclusions, segments, summaries.

The filter, the order check and the segments all work by (file_stem, qname, ref_id), so one shuffle serves them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.sequence import reverse_complement

READ = ("file_stem", "qname", "ref_id")
SEGMENTS = ("pre", "left", "mid", "right", "post")


def aligned_only(rows: DataFrame) -> DataFrame:
    return rows.filter("rname is not null")


def with_reference(rows: DataFrame, refs: DataFrame) -> DataFrame:
    """ref_id and ref_flank by reference name; ``refs`` has two rows for each locus."""
    return rows.join(refs.select("rname", "ref_id", "ref_flank"), "rname", "left")  # small enough for Spark to broadcast by itself, as a rule


def best_per_flank(rows: DataFrame) -> DataFrame:
    """The best alignment of each read on each flank: highest mapq, then longest, then first."""
    best = F.row_number().over(Window.partitionBy(*READ, "rname").orderBy(F.desc("mapq"), F.desc("alignment_length_on_ref"), "ref_start", "cigar"))
    return rows.withColumn("_best", best).filter("_best = 1").drop("_best")


def dual_flank(rows: DataFrame) -> DataFrame:
    """The best alignment on each flank (highest mapq, then longest, then first) of reads on both flanks and on one strand."""
    by_read = Window.partitionBy(*READ)
    both = F.size(F.collect_set("rname").over(by_read)) == 2
    kept = best_per_flank(aligned_only(rows).withColumn("_both", both).filter("_both"))
    return kept.withColumn("_one", F.min("strand").over(by_read) == F.max("strand").over(by_read)).filter("_one").drop("_both", "_one")


def correct_strand(rows: DataFrame) -> DataFrame:
    """Reverse alignments turned: sequences complemented, strand ``+c``, coordinates as they are."""
    back = F.col("strand") == "-"
    turned = {c: F.when(back, reverse_complement(F.col(c))).otherwise(F.col(c)) for c in ("query_sequence", "aligned_subsequence") if c in rows.columns}
    return rows.withColumns(turned | {"strand": F.when(back, "+c").otherwise(F.col("strand"))})


def _order(rows: DataFrame) -> DataFrame:
    by_read = Window.partitionBy(*READ)
    first = F.min_by("ref_flank", F.struct("query_start", "query_end")).over(by_read)
    last = F.max_by("ref_flank", F.struct("query_start", "query_end")).over(by_read)
    return rows.withColumns({"_n": F.count("*").over(by_read), "_ok": (first == "left") & (last == "right")}).filter("_n = 2")


def ordered_flanks(rows: DataFrame) -> DataFrame:
    """Reads with exactly two alignments, the left flank before the right one."""
    return _order(rows).filter("_ok").drop("_n", "_ok")


def order_summary(rows: DataFrame) -> DataFrame:
    reads = _order(rows).select(*READ, "_ok").distinct()
    good, bad = F.count_if("_ok"), F.count_if(~F.col("_ok"))
    return reads.groupBy("file_stem").agg(good.alias("correct_order"), bad.alias("incorrect_order"), F.count("*").alias("total"), (good / F.count("*")).alias("retention_rate"))


def exclude_reads(rows: DataFrame, excluded: DataFrame) -> DataFrame:
    """``rows`` without the (file_stem, qname) of a list of excluded reads; null names match nothing."""
    return rows.join(excluded.select("file_stem", "qname").distinct(), ["file_stem", "qname"], "left_anti")


def split_segments(rows: DataFrame) -> DataFrame:
    """One row for each read: the two alignments side by side (suffixes _1, _2) and the segments around them, '' as null."""
    number = F.row_number().over(Window.partitionBy(*READ).orderBy("query_start", "query_end"))
    each = ["rname", "ref_flank", "strand", "ref_start", "ref_end", "alignment_length_on_ref", "query_start", "query_end", "alignment_length_on_query", "mapq", "mismatches", "insertions", "deletions", "cigar"]
    each = [c for c in each if c in rows.columns]
    wide = rows.withColumn("_k", number).groupBy(*READ).agg(F.first("query_sequence").alias("query_sequence"), *(F.max(F.when(F.col("_k") == k, F.struct(*each))).alias(f"_{k}") for k in (1, 2)))
    seq, size = F.col("query_sequence"), F.length("query_sequence")
    s1, e1, s2, e2 = (F.col(c) for c in ("_1.query_start", "_1.query_end", "_2.query_start", "_2.query_end"))

    def cut(a, b):
        return F.nullif(F.substring(seq, a, b - a + 1), F.lit(""))

    parts = {
        "pre": F.when(s1 > 1, cut(F.lit(1), s1 - 1)),
        "left": F.when(s1.isNotNull() & e1.isNotNull(), cut(s1, e1)),
        "mid": F.when(s2 > e1, cut(e1 + 1, s2 - 1)),
        "right": F.when(s2.isNotNull() & e2.isNotNull(), cut(s2, e2)),
        "post": F.when(e2 < size, cut(e2 + 1, size)),
    }
    flat = [F.col(f"_{k}.{c}").alias(f"{c}_{k}") for k in (1, 2) for c in each]
    return wide.select(*READ, "query_sequence", size.alias("query_length"), *flat, *(v.alias(k) for k, v in parts.items()))


def alignment_summary(rows: DataFrame) -> DataFrame:
    return rows.groupBy("file_stem").agg(F.count("*").alias("n_alignments"), F.count_distinct("qname").alias("n_reads"), F.avg("mapq").alias("mean_mapq"), F.avg("mismatches").alias("mean_mismatches"))


def flank_quality(rows: DataFrame) -> DataFrame:
    n = F.col("alignment_length_on_ref")
    return rows.groupBy("file_stem", "ref_flank").agg(F.count("*").alias("n"), F.avg(n).alias("mean_length"), F.median(n).alias("median_length"), F.avg("mapq").alias("mean_mapq"), F.avg("mismatches").alias("mean_mismatches"))


def strand_summary(rows: DataFrame) -> DataFrame:
    strand = F.when(F.col("strand") == ".", "+").otherwise(F.col("strand"))
    out = rows.groupBy("file_stem", strand.alias("strand")).agg(F.count_distinct("qname").alias("n_reads"))
    return out.withColumn("proportion", F.col("n_reads") / F.sum("n_reads").over(Window.partitionBy("file_stem")))


def flanks_per_read(rows: DataFrame) -> DataFrame:
    return aligned_only(rows).groupBy(*READ).agg(F.count_distinct("rname").alias("n_flanks"))


def segment_summary(split: DataFrame) -> DataFrame:
    return split.groupBy("file_stem").agg(F.count("*").alias("n_reads"), *(F.avg(F.length(s)).alias(f"mean_{s}") for s in SEGMENTS), F.median(F.length("mid")).alias("median_mid"))
