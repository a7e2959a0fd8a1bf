"""Benchmark decontamination by template canonicalisation.

Numbers, units and names become typed placeholders (``#num``, ``#unit``, ``#name``) that keep their value behind a ``=``; windows of
``WIDTH`` canonical words are hash-joined between documents and benchmark. Windows on one alignment of a document with an item must map slot values one to
one (the same value always stands for the same value), which catches an item whose numbers and names were changed and
leaves texts alone that merely share a pattern. An item leaks into a document where windows so confirmed cover at least ``COVER`` of the item's.

A window with fewer than ``LITERAL`` literal words proves nothing as a template alone. An item that has no other windows, as those full of numbers,
is looked for in two ways: as a whole, where its literal words and the repeats among its slot values are ``EVIDENCE`` at least (the pattern of the
window that says most finds the place, then all words of the item are compared), and by windows that stand word for word, slot values included.

Everything is made of column expressions. Cases: null and short texts match nothing (items shorter than a window are one window of all their words);
a null doc_id is one document; repeated rows count once; items of equal text are found each; a text is held whole, with its words and
a hash for each, by one task; an empty table on either side gives no row.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

WIDTH = 5
LITERAL = 3
COVER = 0.8
EVIDENCE = 2
KEPT = r"\p{L}\p{M}\p{N}.,!?\n"  # characters that stay for the canonical form
# Units of measure that may follow a number.
UNITS = ("mm", "cm", "m", "km", "mg", "g", "kg", "ml", "l", "s", "sec", "seconds", "min", "minutes", "h", "hours", "days", "weeks", "months", "years", "meters", "metres", "miles", "feet", "inches", "pounds", "dollars", "euros", "cents", "percent", "degrees", "liters", "litres", "grams", "kilograms", "kilometers", "kilometres")


def canonical_words(text: Column) -> Column:
    """The words of a text, numbers, units and names as ``#kind=value``, all in lower case."""
    # Each pattern starts with what is rare in a text, so that plain words and single spaces cost one test a character.
    t = F.regexp_replace(F.coalesce(text, F.lit("")), rf" *[^{KEPT} ][^{KEPT}]*|  +", " ")
    t = F.regexp_replace(t, r"\p{N}+(?:[.,]\p{N}+)*", "#num=$0 ")
    t = F.regexp_replace(t, rf"(?i)(#num=\S+ +)({'|'.join(sorted(UNITS, key=lambda u: (-len(u), u)))})(?![\p{{L}}\p{{M}}])", "$1#unit=$2")
    t = F.regexp_replace(t, r"\p{Lu}(?<=[\p{L}\p{M}\p{N},] .)[\p{Ll}\p{M}]+(?!\p{Lu})", "#name=$0")
    t = F.lower(F.regexp_replace(t, r"[!?\n]|[.,](?!\p{N})", " "))
    return F.filter(F.split(t, " "), lambda w: w != "")


def kind_of(word: Column) -> Column:
    return F.substring_index(word, "=", 1)


def is_slot(word: Column) -> Column:
    return word.startswith("#")


def pattern(words: Column) -> Column:
    """Literal words, and for each placeholder its kind and the place where its value stands first: what a change of values leaves as it is."""
    return F.transform(words, lambda w: F.when(is_slot(w), F.concat(kind_of(w), F.array_position(words, w).cast("string"))).otherwise(w))


def template(words: Column) -> Column:
    return F.transform(words, lambda w: F.when(is_slot(w), kind_of(w)).otherwise(w))


def evidence(words: Column) -> Column:
    """How many words are literal, and how many placeholders repeat a value."""
    slots = F.filter(words, is_slot)
    return F.size(words) - F.size(F.array_distinct(slots))


def exact_hash(words: Column) -> Column:
    """Of words with their values; odd, while templates are even."""
    return F.shiftleft(F.xxhash64(F.lit("="), words), 1) + 1


def pattern_hash(words: Column) -> Column:
    return F.shiftleft(F.xxhash64(F.lit("~"), pattern(words)), 1) + 1


def is_exact(h: Column) -> Column:
    return h.bitwiseAND(F.lit(1)) == 1


def windows(words: Column, width: int = WIDTH, literal: int = LITERAL) -> Column:
    """The hash of each window of canonical words: of its template, or of its very words where too few of them are literal.

    A text of fewer words is one window of all of them.
    """
    codes = F.transform(words, lambda w: F.when(is_slot(w), -F.abs(F.xxhash64(kind_of(w)))).otherwise(F.abs(F.xxhash64(w))))

    def each(codes: Column) -> Column:
        last = F.greatest(F.size(codes) - width, F.lit(0))

        def one(i: Column) -> Column:
            part = [F.get(codes, i + j) for j in range(width)]
            plain = reduce(lambda a, b: a + b, (F.when(p > 0, 1).otherwise(0) for p in part))
            enough = plain >= F.greatest(F.least(F.lit(literal), F.size(codes)), F.lit(1))
            return F.when((F.least(*part) > 0) | enough, F.shiftleft(F.xxhash64(*part), 1)).otherwise(exact_hash(F.slice(words, i + 1, F.lit(width))))

        return F.transform(F.sequence(F.lit(0), last), one)

    # The codes are bound once, else each window would make all of them again.
    return F.element_at(F.transform(F.array(codes), each), 1)


def exact_places(hashes: Column) -> Column:
    """The windows that have no template."""
    return F.filter(F.transform(hashes, lambda h, i: F.when(is_exact(h), i)), lambda i: i.isNotNull())


def _windowed(df: DataFrame, id_col: str, text_col: str, width: int, literal: int) -> DataFrame:
    """id, words and the hashes of their windows."""
    made = df.select(F.col(id_col).alias("id"), canonical_words(F.col(text_col).cast("string")).alias("words"))
    return made.select("id", "words", F.when(F.size("words") > 0, windows(F.col("words"), width, literal)).alias("hashes"))


def document_windows(docs: DataFrame, id_col: str, text_col: str, width: int, literal: int) -> DataFrame:
    """id, words, hashes, place, hash: each window once, and once more by its pattern where it has no template (places behind the last window)."""
    made = _windowed(docs, id_col, text_col, width, literal)
    patterns = F.transform(exact_places(F.col("hashes")), lambda i: pattern_hash(F.slice("words", i + 1, F.lit(width))))
    listed = F.when(F.exists("hashes", is_exact), F.concat("hashes", patterns)).otherwise(F.col("hashes"))
    # The outer form: for the plain one the optimiser adds a filter on the array's size, which makes the array twice.
    return made.select("id", "words", "hashes", F.posexplode_outer(listed).alias("place", "hash"))


def position(hashes: Column, place: Column) -> Column:
    """The window of a place."""
    return F.when(place < F.size(hashes), place).otherwise(F.get(exact_places(hashes), place - F.size(hashes)))


def item_windows(benchmark: DataFrame, id_col: str, text_col: str, width: int, literal: int) -> DataFrame:
    """item_id, item_pos, item_hash, and what has to stand there: first word, slots and template; places: the windows that it proves."""
    made = _windowed(benchmark, id_col, text_col, width, literal).filter(F.size("words") > 0)
    made = made.withColumn("bare", ~F.exists("hashes", lambda h: ~is_exact(h)))
    each = made.select("*", F.posexplode("hashes").alias("pos", "hash"))
    part = F.slice("words", F.col("pos") + 1, F.lit(width))
    single = each.filter(F.col("bare") | ~is_exact(F.col("hash"))).select("id", "pos", "hash", F.col("pos").alias("first"), part.alias("part"), F.array("pos").alias("places"))
    last = F.greatest(F.size("words") - width, F.lit(0))
    best = F.array_max(F.transform(F.sequence(F.lit(0), last), lambda i: F.struct(evidence(F.slice("words", i + 1, F.lit(width))).alias("said"), (-i).alias("back"))))
    whole = made.filter(F.col("bare") & (evidence(F.col("words")) >= EVIDENCE)).withColumn("pos", -best["back"])
    whole = whole.select("id", "pos", pattern_hash(part).alias("hash"), F.lit(0).alias("first"), F.col("words").alias("part"), F.sequence(F.lit(0), last).alias("places"))
    return single.unionByName(whole).select(
        F.col("id").alias("item_id"), F.col("pos").alias("item_pos"), F.col("hash").alias("item_hash"), F.col("first").alias("item_first"),
        F.col("part").alias("item_part"), template(F.col("part")).alias("item_template"), "places",
    )


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, literal: int = LITERAL, cover: float = COVER) -> DataFrame:
    """doc_id, item_id, n_windows, n_matched, coverage of every item that leaks into a document."""
    items = common.staged(item_windows(benchmark, "item_id", "text", width, literal), "benchmark-windows", True)
    sizes = items.groupBy("item_id").agg(F.size(F.array_distinct(F.flatten(F.collect_list("places")))).alias("n_windows"))
    n = items.limit(common.BROADCAST_ROWS + 1).count()  # the size bound of the broadcast
    small = (lambda df: F.broadcast(df)) if n <= common.BROADCAST_ROWS else (lambda df: df)
    # All documents by hashes alone, so that their words aren't copied for each window; then those whose hashes cover an item, word by word.
    met = document_windows(docs, id_col, text_col, width, literal).select("id", "hash").join(small(items.select("item_id", "item_hash", "places")), F.col("hash") == F.col("item_hash"))
    met = met.groupBy("id", "item_id").agg(F.size(F.array_distinct(F.flatten(F.collect_set("places")))).alias("n")).join(small(sizes), "item_id")
    likely = common.staged(met.filter(F.col("n") >= F.col("n_windows") * cover).select(F.col("id").alias("likely_id")).distinct(), "likely", True)
    few = likely.limit(common.BROADCAST_ROWS + 1).count() <= common.BROADCAST_ROWS
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    docs = docs.join(F.broadcast(likely) if few else likely, docs["id"].eqNullSafe(likely["likely_id"]), "left_semi")
    found = document_windows(docs, "id", "text", width, literal).join(small(items), F.col("hash") == F.col("item_hash"))
    found = found.withColumn("at", position(F.col("hashes"), F.col("place")) - F.col("item_pos") + F.col("item_first")).filter("at >= 0")
    found = found.withColumn("ours", F.slice("words", F.col("at") + 1, F.size("item_part"))).filter(template(F.col("ours")) == F.col("item_template"))
    pairs = F.filter(F.zip_with("item_part", "ours", lambda x, y: F.when(is_slot(x), F.struct(x.alias("theirs"), y.alias("ours")))), lambda p: p.isNotNull())
    found = found.select(F.col("id").alias("doc_id"), "item_id", (F.col("at") - F.col("item_first")).alias("shift"), "places", pairs.alias("pairs"))
    aligned = found.groupBy("doc_id", "item_id", "shift").agg(F.array_distinct(F.flatten(F.collect_set("places"))).alias("places"), F.array_distinct(F.flatten(F.collect_set("pairs"))).alias("pairs"))
    one_way = lambda side: F.size(F.array_distinct(F.transform("pairs", lambda p: p[side]))) == F.size("pairs")
    sound = aligned.filter(one_way("theirs") & one_way("ours"))
    total = sound.groupBy("doc_id", "item_id").agg(F.size(F.array_distinct(F.flatten(F.collect_list("places")))).cast("long").alias("n_matched"))
    total = total.join(small(sizes), "item_id").withColumn("n_windows", F.col("n_windows").cast("long")).withColumn("coverage", F.col("n_matched") / F.col("n_windows"))
    return total.filter(F.col("coverage") >= cover).select("doc_id", "item_id", "n_windows", "n_matched", "coverage")


def keep_uncontaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` without the documents that an item leaks into."""
    gone = common.staged(leaks(docs, benchmark, id_col, text_col, **options).select(F.col("doc_id").alias("gone_id")).distinct(), "leaks", True)
    return docs.join(gone, docs[id_col].eqNullSafe(gone["gone_id"]), "left_anti")
