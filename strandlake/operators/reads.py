"""Read-level quality control: name duplicates, downsampling, quality summaries, adapter trimming."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.sequence import phred_mean, phred_sum


def longest_per_name(reads: DataFrame) -> DataFrame:
    """One read for each (file_stem, qname): the longest, of equals the first in the file (read_index)."""
    order = Window.partitionBy("file_stem", "qname").orderBy(F.desc(F.length("sequence")), "read_index")
    return reads.withColumn("_rank", F.row_number().over(order)).filter("_rank = 1").drop("_rank")


def name_multiplicity(reads: DataFrame) -> DataFrame:
    """How many read names of a sample occur once, twice, ..., and their share of its names."""
    names = reads.groupBy("file_stem", "qname").agg(F.count("*").alias("occurrences"))
    tally = names.groupBy("file_stem", "occurrences").agg(F.count("*").alias("n_readnames"))
    return tally.withColumn("proportion", F.col("n_readnames") / F.sum("n_readnames").over(Window.partitionBy("file_stem")))


def duplication_rate(multiplicity: DataFrame) -> DataFrame:
    """Share of duplicated names of each sample, and whether it lies over two deviations from the mean of all samples."""
    dup = F.coalesce(F.sum(F.when(F.col("occurrences") > 1, F.col("proportion"))), F.lit(0.0))
    return cohort_outliers(multiplicity.groupBy("file_stem").agg(dup.alias("duplication_rate")), "duplication_rate")


def cohort_outliers(samples: DataFrame, value: str) -> DataFrame:
    """``samples`` with outlier: whether a sample's value lies over two deviations from the mean of all; a lone sample doesn't."""
    cohort = samples.agg(F.avg(value).alias("_m"), F.stddev_samp(value).alias("_s"))
    far = F.abs(F.col(value) - F.col("_m")) > 2 * F.col("_s")
    return samples.join(F.broadcast(cohort)).withColumn("outlier", F.coalesce(far, F.lit(False))).drop("_m", "_s")  # one row


def compare_read_counts(before: DataFrame, after: DataFrame, names: tuple[str, str] = ("before", "after")) -> DataFrame:
    """Reads of each sample at two stages, with what is left."""
    a, b = (d.groupBy("file_stem").agg(F.count("*").alias(f"n_{n}")) for d, n in zip((before, after), names, strict=True))
    out = a.join(b, "file_stem", "left")
    left = F.coalesce(F.col(f"n_{names[1]}"), F.lit(0).cast("long"))
    return out.withColumn(f"n_{names[1]}", left).withColumns({"n_lost": F.col(f"n_{names[0]}") - left, "retained": left / F.col(f"n_{names[0]}")})


def read_quality(reads: DataFrame) -> DataFrame:
    """Length, Phred sum and mean of every read."""
    return reads.select("file_stem", F.col("qname").alias("read_name"), F.length("sequence").alias("length"), phred_sum(F.col("quality")).alias("phred_sum"), phred_mean(F.col("quality")).alias("read_phred"))


def quality_summary(quality: DataFrame) -> DataFrame:
    """Reads of each sample with mean, median and deviation of length and quality."""
    stats = [f(c).alias(f"{n}_{c}") for c in ("length", "read_phred") for n, f in (("mean", F.avg), ("median", F.median), ("sd", F.stddev_samp))]
    return quality.groupBy("file_stem").agg(F.count("*").alias("n_reads"), *stats)


def final_summary(reads: DataFrame) -> DataFrame:
    return reads.groupBy("file_stem").agg(F.count("*").alias("n_reads"), F.avg(F.length("sequence")).alias("mean_length"))


def downsample(rows: DataFrame, n: int, key: tuple[str, ...] = ("file_stem",), by: str = "qname", seed: int = 123) -> DataFrame:
    """At most ``n`` rows of each key, in the order of a seeded hash: the same rows on any cluster, and in any engine that has MD5."""
    order = Window.partitionBy(*key).orderBy(F.md5(F.concat(F.col(by), F.lit(f":{seed}"))), by)
    return rows.withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") <= n).drop("_rank")


def with_complements(adapters: dict[str, str]) -> dict[str, str]:
    """Adapters and their reverse complements (``_rc``), in order."""
    turn = str.maketrans("ACGTN", "TGCAN")
    return adapters | {f"{k}_rc": v.translate(turn)[::-1] for k, v in adapters.items()}


def _hit(seq: Column, pattern: Column, mismatches: int, indels: bool, right: bool) -> Column:
    """Whether a pattern of full length lies at an end of a sequence with at most ``mismatches`` edits."""
    n = F.length(pattern)
    end = (lambda s, k: F.right(s, k)) if right else (lambda s, k: F.left(s, k))
    if not indels:
        pairs = F.zip_with(F.split(end(seq, n), ""), F.split(pattern, ""), lambda x, y: F.when(x == y, 0).otherwise(1))
        return (F.length(seq) >= n) & (F.aggregate(pairs, F.lit(0), lambda a, x: a + x) <= mismatches)
    sizes = F.sequence(F.greatest(n - mismatches, F.lit(1)), n + mismatches)
    return F.exists(sizes, lambda k: F.levenshtein(end(seq, k), pattern) <= mismatches)


def trim_span(seq: Column, pattern: Column, mismatches: int = 3, indels: bool = True) -> Column:
    """(start, end) of what trimming both ends of a read keeps; end < start where nothing is left."""
    n, size = F.length(pattern), F.length(seq)
    start = F.when(_hit(seq, pattern, mismatches, indels, False), F.least(n, size) + 1).otherwise(1)
    end = F.when(_hit(seq, pattern, mismatches, indels, True), F.greatest(size - n, F.lit(0))).otherwise(size)
    return F.struct(start.alias("start"), F.greatest(end, start - 1).alias("end"))


def trim_locations(reads: DataFrame, adapters: dict[str, str], mismatches: int = 3, indels: bool = True) -> DataFrame:
    """What each adapter alone would keep of each untrimmed read, and on which side.

    The sides name where the kept part stands, as the reports have it: ``left`` means that the far end went.
    """
    patterns = F.array(*(F.struct(F.lit(k).alias("name"), F.lit(v).alias("seq")) for k, v in with_complements(adapters).items()))
    rows = reads.select("file_stem", F.col("qname").alias("read_name"), "sequence", F.explode(patterns).alias("p"))
    rows = rows.withColumn("kept", trim_span(F.col("sequence"), F.col("p.seq"), mismatches, indels))
    size, start, end = F.length("sequence"), F.col("kept.start"), F.col("kept.end")
    width = end - start + 1
    side = F.when((start == 1) & (end < size), "left").when((start > 1) & (end == size), "right").when((start == 1) & (end == size), "both").otherwise("internal")
    return rows.select("file_stem", F.col("p.name").alias("trim_pattern_name"), "read_name", size.alias("read_length"), start.alias("start"), end.alias("end"), width.alias("width"), (size - width).alias("trim_length"), (width < size).alias("trim"), side.alias("side"))


def trim_reads(reads: DataFrame, adapters: dict[str, str], mismatches: int = 3, indels: bool = True) -> DataFrame:
    """Reads trimmed by each adapter and complement in turn; qualities are cut alike."""
    patterns = F.array(*map(F.lit, with_complements(adapters).values()))

    def step(kept: Column, pattern: Column) -> Column:
        seq = F.substring("sequence", kept["at"], kept["size"])
        span = trim_span(seq, pattern, mismatches, indels)
        return F.struct((kept["at"] + span["start"] - 1).alias("at"), (span["end"] - span["start"] + 1).alias("size"))

    whole = F.struct(F.lit(1).alias("at"), F.length("sequence").alias("size"))
    out = reads.withColumn("_kept", F.aggregate(patterns, whole, step))
    cut = lambda c: F.substring(c, F.col("_kept.at"), F.col("_kept.size"))
    return out.withColumns({"sequence": cut("sequence"), "quality": cut("quality")}).drop("_kept")


def trim_by_adapter(locations: DataFrame) -> DataFrame:
    """Trimmed reads of each sample by adapter, untrimmed reads as an adapter of their own, and their share of the sample's reads."""
    by = locations.groupBy("file_stem", "trim_pattern_name").agg(F.sum(F.col("trim").cast("long")).alias("n_trimmed"))
    reads = locations.groupBy("file_stem", "read_name").agg(F.bool_or("trim").alias("any"))
    none = reads.groupBy("file_stem").agg(F.lit("untrimmed").alias("trim_pattern_name"), F.sum((~F.col("any")).cast("long")).alias("n_trimmed"))
    total = reads.groupBy("file_stem").agg(F.count("*").alias("n_reads"))
    return by.unionByName(none).join(total, "file_stem").withColumn("proportion", F.col("n_trimmed") / F.col("n_reads"))


def trim_by_side(locations: DataFrame, by_sample: bool = False) -> DataFrame:
    """Lengths that went, by adapter and side. Without samples the share is of the distinct read names of all samples."""
    key = (["file_stem"] if by_sample else []) + ["trim_pattern_name", "side"]
    n = F.count("*")
    stats = [n.alias("n"), *(f("trim_length").alias(f"{k}_trim_length") for k, f in (("median", F.median), ("mean", F.avg), ("sd", F.stddev_samp), ("min", F.min), ("max", F.max)))]
    out = locations.filter("trim").groupBy(*key).agg(*stats)
    if by_sample:
        total = locations.groupBy("file_stem").agg(F.count_distinct("read_name").alias("n_reads"))
        out = out.join(total, "file_stem")
    else:
        out = out.join(F.broadcast(locations.agg(F.count_distinct("read_name").alias("n_reads"))))
    return out.withColumn("proportion", F.col("n") / F.col("n_reads")).drop("n_reads")


