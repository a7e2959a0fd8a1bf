"""Column functions on sequences, qualities and alignments; all of them run in the JVM."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# IUPAC codes and their complements.
IUPAC, COMPLEMENT = "ACGTUNRYSWKMBDHVacgtunryswkmbdhv", "TGCAANYRSWMKVHDBtgcaanyrswmkvhdb"


def reverse_complement(seq: Column) -> Column:
    return F.reverse(F.translate(seq, IUPAC, COMPLEMENT))


def phred_sum(quality: Column) -> Column:
    """Sum of Phred scores of a Phred+33 string; null stays null, '' gives 0."""
    scores = F.transform(F.filter(F.split(quality, ""), lambda c: c != ""), lambda c: F.ascii(c) - 33)
    return F.aggregate(scores, F.lit(0).cast("long"), lambda a, x: a + x.cast("long"))


def phred_mean(quality: Column) -> Column:
    """Arithmetic mean of the scores; null for '' and null."""
    return F.try_divide(phred_sum(quality).cast("double"), F.length(quality))


def cigar_total(cigar: Column, codes: str) -> Column:
    """Total length of a CIGAR's operations of the given codes."""
    found = F.regexp_extract_all(cigar, F.lit(rf"(\d+)[{codes}]"), F.lit(1))
    return F.aggregate(found, F.lit(0), lambda a, x: a + x.cast("int"))


def leading_softclip(cigar: Column) -> Column:
    return F.coalesce(F.nullif(F.regexp_extract(cigar, r"^(\d+)S", 1), F.lit("")).cast("int"), F.lit(0))


def cigar_columns(cigar: Column, ref_start: Column) -> dict[str, Column]:
    """Alignment metrics of a CIGAR that starts at ``ref_start``."""
    width, on_query, clip = cigar_total(cigar, "MDN=X"), cigar_total(cigar, "MI=X"), leading_softclip(cigar)
    return {
        "ref_end": ref_start + width - 1,
        "alignment_length_on_ref": width,
        "query_start": clip + 1,
        "query_end": clip + on_query,
        "alignment_length_on_query": on_query,
        "insertions": cigar_total(cigar, "I"),
        "deletions": cigar_total(cigar, "D"),
    }


def count_repeats(seq: Column, motif: str, digits: int = 0) -> dict[str, Column]:
    """Three counts of a motif: length over motif length (half-even), non-overlapping matches, and run lengths as text.

    All are null for null and '' sequences; without a match the runs are '0'.
    """
    full = seq.isNotNull() & (seq != "")
    n = len(motif)
    runs = F.transform(F.regexp_extract_all(seq, F.lit(f"((?:{motif})+)"), F.lit(1)), lambda r: (F.length(r) / n).cast("int").cast("string"))
    return {
        "repeat_count_full": F.when(full, F.bround(F.length(seq) / F.lit(float(n)), digits)),
        "repeat_count_match": F.when(full, F.regexp_count(seq, F.lit(motif)).cast("int")),
        "repeat_count_tracts": F.when(full, F.when(F.size(runs) == 0, "0").otherwise(F.concat_ws(",", runs))),
    }


def clean_consensus(seq: Column) -> Column:
    """Gaps dropped, anything but A, C, G, T made N."""
    return F.regexp_replace(F.regexp_replace(seq, "-", ""), "[^ACGT]", "N")


def hamming(a: Column, b: Column) -> Column:
    """Number of differing places; null where lengths differ."""
    pairs = F.zip_with(F.split(a, ""), F.split(b, ""), lambda x, y: F.when(x == y, 0).otherwise(1))
    return F.when(F.length(a) == F.length(b), F.aggregate(pairs, F.lit(0), lambda s, x: s + x))


def edit_distance(a: Column, b: Column, method: str = "levenshtein") -> Column:
    """Levenshtein, or Hamming with Levenshtein where lengths differ."""
    if method == "hamming":
        return F.coalesce(hamming(a, b), F.levenshtein(a, b))
    if method != "levenshtein":
        raise ValueError(f"unknown distance: {method}")
    return F.levenshtein(a, b)


def axis_step(span: Column) -> Column:
    """Label step of a read axis that covers ``span`` repeats."""
    out = None
    for most, step in ((30, 1), (50, 3), (100, 5), (200, 10), (500, 20), (1000, 50), (5000, 100)):
        out = F.when(span <= most, step) if out is None else out.when(span <= most, step)
    return out.otherwise(500)


def split_reference(seq: Column) -> tuple[Column, Column]:
    """Left and right flank of a reference around its first run of five or more N; null without one."""
    at = r"(?s)^(.*?)[Nn]{5,}(.*)$"
    has = seq.rlike("[Nn]{5,}")
    return F.when(has, F.regexp_extract(seq, at, 1)), F.when(has, F.regexp_extract(seq, at, 2))


def size_text(size: Column) -> Column:
    """Bytes with a unit and one digit."""
    units = ("B", "KB", "MB", "GB")
    out = None
    for i, unit in enumerate(units):
        text = F.format_string(f"%.1f {unit}", size.cast("double") / 1024.0**i)
        out = F.when(size < 1024.0 ** (i + 1), text) if out is None else out.when(size < 1024.0 ** (i + 1), text)
    return out.otherwise(F.format_string("%.1f TB", size.cast("double") / 1024.0 ** len(units)))


def elapsed_text(seconds: Column) -> Column:
    """Seconds, minutes or hours, whichever is the largest that fits."""
    x = seconds.cast("double")
    return F.when(x < 60, F.format_string("%.1f s", x)).when(x < 3600, F.format_string("%.1f min", x / 60)).otherwise(F.format_string("%.2f h", x / 3600))


def named_map(rows: DataFrame, key: str, value: str) -> DataFrame:
    """One row with the map ``named`` of a small table of names, as adapters and colours are; the greatest value of a repeated name counts."""
    last = rows.groupBy(key).agg(F.max(value).alias(value))
    return last.agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct(key, value)))).alias("named"))
