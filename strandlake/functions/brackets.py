"""The bracket language of the settings table: ``[0-35][36-NA]``, ``[3][0.05]``, ``0-35``, ``3``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def bracket_parts(text: Column) -> Column:
    """The texts inside the brackets, or the whole text where there are none."""
    inner = F.regexp_extract_all(text, F.lit(r"\[([^\[\]]+)\]"), F.lit(1))
    return F.when(text.contains("["), inner).when(text.isNotNull(), F.array(text))


def number(text: Column) -> Column:
    """A number, null for NA."""
    return F.when(F.trim(text) == "NA", F.lit(None)).otherwise(F.trim(text).try_cast("double"))


def parse_ranges(text: Column) -> Column:
    """Array of (min, max); NA is null. A part that isn't ``min-max`` raises."""

    def one(part: Column) -> Column:
        ends = F.split(part, "-")
        bad = F.raise_error(F.concat(F.lit("a range needs the form min-max: "), part))
        return F.when(F.size(ends) == 2, F.struct(number(F.get(ends, 0)).alias("min"), number(F.get(ends, 1)).alias("max"))).otherwise(bad.cast("struct<min: double, max: double>"))

    return F.transform(bracket_parts(text), one)


def parse_values(text: Column) -> Column:
    """Array of numbers; NA is null."""
    return F.transform(bracket_parts(text), lambda p: number(p))


def range_name(place: Column, total: Column) -> Column:
    """``range1`` and so on, zero-padded to the digits of the number of ranges."""
    digits = F.length(total.cast("string"))
    return F.concat(F.lit("range"), F.lpad(place.cast("string"), digits, F.lit("0")))


def expand_settings(settings):
    """One row for each sample and range of a settings table (file_stem, analysis_ranges, floor, max_peaks; all text).

    Samples that lack one of the three are left out; a single floor or peak number holds for every range.
    """
    full = settings.filter("analysis_ranges is not null and floor is not null and max_peaks is not null")
    made = full.select("file_stem", parse_ranges(F.col("analysis_ranges")).alias("ranges"), parse_values(F.col("floor")).alias("floors"), parse_values(F.col("max_peaks")).alias("peaks"))
    rows = made.select("file_stem", "floors", "peaks", F.size("ranges").alias("n"), F.posexplode("ranges").alias("i", "range"))
    return rows.select(
        "file_stem",
        range_name(F.col("i") + 1, F.col("n")).alias("analysis_range_name"),
        F.col("range.min").alias("window_min"),
        F.col("range.max").alias("window_max"),
        F.when(F.size("floors") == 1, F.get("floors", F.lit(0))).otherwise(F.get("floors", F.col("i"))).alias("floor"),
        F.when(F.size("peaks") == 1, F.get("peaks", F.lit(0))).otherwise(F.get("peaks", F.col("i"))).cast("int").alias("max_peaks"),
    )
