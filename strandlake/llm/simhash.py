"""SimHash near-duplicates by deletion-variant signatures.

Fingerprints that differ in k bits at most, cut into k // 2 + 1 segments, agree in some segment up to one bit. So each distinct
fingerprint is indexed under every segment with one bit as a wildcard; equal keys meet, and the pairs are verified on all 64 bits. A key's
fingerprints are linked to a spanning forest, never to all their pairs. Keys with more than about ``BLOCK`` fingerprints are known beforehand from
counts of segment values; their fingerprints go another exact way, whose cost grows with their number and not with its square: two of them
lie within k bits if and only if some bit string lies within k / 2 bits of both (rounded up for one of them), so each is sent to every string
around it, and those that meet there are tied to one of them.

Cases: null text and texts without a word have fingerprint zero and link like any other; exact copies share a fingerprint and are
indexed once; ties don't arise (a component's id is its least doc_id); rows that repeat a doc_id belong to it; a text is held whole by one
task, its shingles in chunks; columns of other names don't matter; an empty table gives no row.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from itertools import combinations
from math import ceil, comb

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from .components import components

BITS = 64
MAX_DIFFER = 4
SHINGLE = 4
BLOCK = 2048
#: Of similar documents: words of a shingle, the similarity, bits of 128 that may differ in a pair that is looked at (a similarity of 0.8 is 19 on average,
#: with a deviation of 4), bits of a segment, rows of a key that are compared at a time.
STAGE_SHINGLE, STAGE_LEAST, STAGE_DIFFER, STAGE_SEGMENT, STAGE_BLOCK = 5, 0.8, 24, 16, 1024
#: Documents that the order of shingles is learnt from, common shingles at most, classes of shingles whose parity is always kept (a power of two).
STAGE_SAMPLE, STAGE_COMMON, STAGE_BITS = 20_000, 200_000, 512
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def digests(text: str | None, shingle: int, digest: Callable[[bytes], bytes], chunk: int = 1 << 16) -> Iterator[np.ndarray]:
    """The digests of a text's word shingles (of the whole sequence of fewer words), repeats included: rows of bytes, ``chunk`` at a time; none without a word."""
    joined = b" ".join(_WORD.findall((text or "").encode().translate(_LOWER)))
    if not joined:
        return
    gaps = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
    starts, ends = np.append(0, gaps + 1), np.append(gaps, len(joined))
    size = min(shingle, len(starts))
    starts, ends = starts[: len(starts) - size + 1], ends[size - 1 :]
    for at in range(0, len(starts), chunk):
        spans = zip(starts[at : at + chunk].tolist(), ends[at : at + chunk].tolist(), strict=True)
        yield np.frombuffer(b"".join([digest(joined[a:b]) for a, b in spans]), np.uint8).reshape(min(chunk, len(starts) - at), -1)


def votes(raws: Iterator[np.ndarray]) -> bytes:
    """A fingerprint's bytes: each bit is that of most digests; empty without any."""
    count, total = 0, 0
    for raw in raws:
        count, total = count + np.unpackbits(raw, axis=1).sum(0, dtype=np.int64), total + len(raw)
    return np.packbits(count * 2 > total).tobytes() if total else b""


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = 42, chunk: int = 1 << 16) -> int:
    """64-bit SimHash of a text's word shingles by XXH64; zero without a word."""
    return int.from_bytes(votes(digests(text, shingle, lambda x: xxhash.xxh64_digest(x, seed), chunk)), "big")


def wide_fingerprint(text: str | None, shingle: int = STAGE_SHINGLE) -> int:
    """128-bit SimHash of a text's word shingles by XXH3; zero without a word."""
    return int.from_bytes(votes(digests(text, shingle, xxhash.xxh3_128_digest)), "big")


def shingle_set(raws: Iterator[np.ndarray]) -> np.ndarray:
    """The distinct shingles, sorted: the first 64 bits of their digests."""
    kept = [np.unique(np.ascontiguousarray(raw[:, :8]).view(">i8").astype(np.int64)) for raw in raws]
    return np.unique(np.concatenate(kept)) if kept else np.empty(0, np.int64)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """doc_id, fp (the fingerprint's bits as a signed long)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches, 1):
            found = np.array([fingerprint(x, shingle) for x in batch.column(1).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], names=["doc_id", "fp"])

    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(run, "doc_id long, fp long")


def segments(differ: int = MAX_DIFFER) -> list[tuple[int, int]]:
    """(lowest bit, width) of the fewest segments of which one differs by one bit at most."""
    parts = differ // 2 + 1
    edges = [BITS * i // parts for i in range(parts + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:], strict=False)]


def segment_values(reps: DataFrame, differ: int = MAX_DIFFER) -> DataFrame:
    """fp, segment, value: one row for each segment of a fingerprint."""
    values = [F.struct(F.lit(i).alias("segment"), (F.shiftrightunsigned(F.col("fp"), low).bitwiseAND(F.lit((1 << width) - 1)) if width < BITS else F.col("fp")).alias("value")) for i, (low, width) in enumerate(segments(differ))]
    return reps.select("fp", F.inline(F.array(*values)))


def variants(values: DataFrame, differ: int = MAX_DIFFER) -> DataFrame:
    """``values`` with a key for each wildcard bit of its segment; the key packs segment, wildcard and the other bits."""
    widths = [width for _, width in segments(differ)]
    before = [sum(widths[:i]) for i in range(len(widths))]
    width, first = (F.element_at(F.array(*map(F.lit, x)), F.col("segment") + 1) for x in (widths, before))
    spread = values.withColumn("bit", F.explode(F.sequence(F.lit(0), width - 1)))
    mask = F.bitwise_not(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("bit")))
    return spread.withColumn("key", F.call_function("shiftleft", (first + F.col("bit")).cast("long"), F.lit(56)).bitwiseOR(F.col("value").bitwiseAND(mask))).drop("segment", "value", "bit")


def distance(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Differing bits of fingerprints, rows of one or more 64-bit words."""
    return np.bitwise_count(x ^ y).sum(-1, dtype=np.int64)


def forest(n: int, pairs: Iterator[tuple[int, int]]) -> list[tuple[int, int]]:
    """Those of the pairs of ``n`` things that join what wasn't joined by the ones before."""
    parent, out = list(range(n)), []

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i, j in pairs:
        a, b = root(i), root(j)
        if a != b:
            parent[max(a, b)] = min(a, b)
            out.append((i, j))
    return out


def near_pairs(keys: np.ndarray, fps: np.ndarray, differ: int, few: int = 64) -> tuple[np.ndarray, np.ndarray]:
    """Places (i, j) of rows with equal keys, which are sorted, whose fingerprints differ by ``differ`` bits at most; the nearest pairs first.

    Rows of small groups are compared with the row some places on, all at a time; a large group row by row.
    """
    cuts = np.flatnonzero(np.diff(keys)) + 1
    starts, ends = np.append(0, cuts), np.append(cuts, len(keys))
    left = np.repeat(ends, ends - starts) - np.arange(len(keys)) - 1  # rows of the same key behind each row
    small = np.repeat(ends - starts <= few, ends - starts)
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def put(i: np.ndarray, j: np.ndarray) -> None:
        d = distance(fps[i], fps[j])
        near = d <= differ
        if near.any():
            found.append((i[near], j[near], d[near]))

    at = np.flatnonzero(small & (left > 0))
    for lag in range(1, few):
        at = at[left[at] >= lag]
        if not len(at):
            break
        put(at, at + lag)
    for i in np.flatnonzero(~small & (left > 0)).tolist():
        rest = np.arange(i + 1, i + 1 + left[i])
        put(np.full(len(rest), i), rest)
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    i, j, d = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.argsort(d, kind="stable")
    return i[order], j[order]


def edge_names(words: int) -> list[str]:
    return [f"{side}{k}" for side in "ab" for k in range(words)]


def key_links(batches: Iterator[pa.RecordBatch], differ: int, words: int = 1) -> Iterator[pa.RecordBatch]:
    """a, b (a column for each word): the links of each key, from rows (key, words) sorted by key. Holds one batch and the fingerprints of one key."""
    keys, fps = np.empty(0, np.int64), np.empty((0, words), np.uint64)

    def links_of(n: int) -> pa.RecordBatch:
        i, j = near_pairs(keys[:n], fps[:n], differ)
        found = forest(n, zip(i.tolist(), j.tolist(), strict=True))
        i, j = np.array(found, np.int64).reshape(-1, 2).T
        columns = [fps[side, k].view(np.int64) for side in (i, j) for k in range(words)]
        return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in columns], names=edge_names(words))

    for rows in batches:
        more = [rows.column(k).to_numpy(zero_copy_only=False) for k in range(words + 1)]
        keys = np.concatenate([keys, more[0]])
        fps = np.concatenate([fps, np.stack([x.view(np.uint64) for x in more[1:]], 1)])
        if len(keys):
            n = int(np.searchsorted(keys, keys[-1]))  # the last key may go on in the next batch
            yield links_of(n)
            keys, fps = keys[n:], fps[n:].copy()
    yield links_of(len(keys))


def ball_links(hot: DataFrame, differ: int) -> DataFrame:
    """a, b: links of fingerprints (column fp, distinct) by the strings around them; as many rows for each as there are strings."""
    near, far = differ // 2, differ - differ // 2
    masks = [sum(1 << i for i in bits) for k in range(far + 1) for bits in combinations(range(BITS), k)]
    signed = [m - (1 << BITS) if m >> BITS - 1 else m for m in masks]
    listed = F.split(F.lit(",".join(map(str, signed))), ",").cast("array<long>")  # folds to one literal
    centres = hot.select("fp", F.posexplode(listed).alias("place", "mask"))
    inside = sum(comb(BITS, k) for k in range(near + 1))
    centres = centres.select("fp", F.col("fp").bitwiseXOR(F.col("mask")).alias("centre"), (F.col("place") < inside).alias("inside"))
    hubs = centres.groupBy("centre").agg(F.min(F.when(F.col("inside"), F.col("fp"))).alias("hub"), F.count("*").alias("n")).filter("n > 1 AND hub IS NOT NULL")
    return centres.join(hubs.select("centre", "hub"), "centre").filter("fp != hub").select(F.col("hub").alias("a"), F.col("fp").alias("b"))


def links(reps: DataFrame, differ: int = MAX_DIFFER, block: int = BLOCK) -> DataFrame:
    """a, b: links between distinct fingerprints (column fp) that connect whatever lies within ``differ`` bits."""
    spark = reps.sparkSession
    values = segment_values(reps, differ)
    # A key holds the fingerprints of two values of its segment: no more than ``block`` where neither has more than half.
    heavy = common.staged(values.groupBy("segment", "value").agg(F.count("*").alias("n")).filter(F.col("n") > block // 2).select("segment", "value"), "heavy", True)
    keyed = variants(values, differ)
    n = heavy.limit(common.BROADCAST_ROWS + 1).count()
    around = None
    if n:
        hot_keys = variants(heavy, differ).distinct().withColumn("hot", F.lit(True))
        keyed = keyed.join(F.broadcast(hot_keys) if n * BITS <= common.BROADCAST_ROWS else hot_keys, "key", "left")
        around = ball_links(common.staged(keyed.filter("hot").select("fp").distinct(), "hot", True), differ)
        keyed = keyed.filter("hot IS NULL")
    spread = keyed.select("key", "fp").repartition("key").sortWithinPartitions("key", "fp")
    found = spread.mapInArrow(lambda batches: key_links(batches, differ), "a0 long, b0 long").toDF("a", "b")
    return common.staged((found.unionAll(around) if around is not None else found).distinct(), "links", True)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", differ: int = MAX_DIFFER, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, fp, component_id of every row: the least doc_id that links reach, its own included.

    Only ids and fingerprints are shuffled, one row for each distinct fingerprint wherever copies allow it.
    """
    prints = common.staged(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    with common.scratch(docs.sparkSession) as stage:
        reps = stage(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "reps", True)
        roots = components(links(reps.select("fp"), differ))
        grouped = reps.join(roots, reps["fp"] == roots["node"]).select("fp", "first_id", "root")
        least = grouped.groupBy("root").agg(F.min("first_id").alias("least_id"))
        moved = grouped.select("fp", "root").join(least, "root").select("fp", "least_id")
        classes = common.staged(reps.join(moved, "fp", "left").select("fp", F.coalesce("least_id", "first_id").alias("component_id")), "classes", True)
    return prints.join(classes, "fp").select("doc_id", "fp", "component_id")


def wide_values(reps: DataFrame, width: int = STAGE_SEGMENT) -> DataFrame:
    """hi, lo, segment, value: one row for each segment of ``width`` bits."""
    word = lambda i: F.col("lo" if i * width < BITS else "hi")
    values = [F.struct(F.lit(i).alias("segment"), F.shiftrightunsigned(word(i), i * width % BITS).bitwiseAND(F.lit((1 << width) - 1)).alias("value")) for i in range(2 * BITS // width)]
    return reps.select("hi", "lo", F.inline(F.array(*values)))


def wide_variants(values: DataFrame, width: int = STAGE_SEGMENT) -> DataFrame:
    """``values`` with a key for each wildcard bit of its segment; the key packs segment, wildcard and the segment's other bits."""
    spread = values.withColumn("bit", F.explode(F.sequence(F.lit(0), F.lit(width - 1))))
    mask = F.bitwise_not(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("bit")))
    key = F.call_function("shiftleft", (F.col("segment") * width + F.col("bit")).cast("long"), F.lit(width)).bitwiseOR(F.col("value").bitwiseAND(mask))
    return spread.withColumn("key", key).drop("segment", "value", "bit")


def wide_links(reps: DataFrame, differ: int = STAGE_DIFFER, width: int = STAGE_SEGMENT, block: int = STAGE_BLOCK) -> DataFrame:
    """a0, a1, b0, b1: links (hi, lo) between distinct wide fingerprints that meet under a key and differ by ``differ`` bits at most.

    Keys that may have more than ``block`` fingerprints are known from counts of segment values; their rows are dealt to blocks, each pair of blocks is a
    key of its own, and so no task holds many blocks, and no pair is left out.
    """
    values = wide_values(reps, width)
    heavy = common.staged(values.groupBy("segment", "value").agg(F.count("*").alias("n")).filter(F.col("n") > block // 2), "heavy", True)
    keyed = wide_variants(values, width)
    n = heavy.limit(common.BROADCAST_ROWS + 1).count()
    rows = keyed.select(F.col("key").alias("place"), "hi", "lo")
    if n:
        hot = wide_variants(heavy, width).groupBy("key").agg(F.ceil((F.sum("n") + block // 2) / block).cast("int").alias("parts"))  # a second, light value has half a block at most
        marked = keyed.join(F.broadcast(hot) if n * width <= common.BROADCAST_ROWS else hot, "key", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
        spread = marked.withColumn("part", F.pmod(F.xxhash64("hi", "lo"), F.col("parts")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        # A block meets itself once, and each other block once.
        rows = spread.select(F.xxhash64("key", F.least("part", "other"), F.greatest("part", "other")).alias("place"), "hi", "lo")
    spread = rows.repartition("place").sortWithinPartitions("place", "hi", "lo")
    names = edge_names(2)
    return common.staged(spread.mapInArrow(lambda batches: key_links(batches, differ, 2), ", ".join(f"{c} long" for c in names)).distinct(), "links", True)


def common_shingles(docs: DataFrame, shingle: int, sample: int = STAGE_SAMPLE, most: int = STAGE_COMMON) -> tuple[np.ndarray, np.ndarray]:
    """(shingles, sorted; documents): the commonest shingles of about ``sample`` documents.

    They only set the order in which a document's shingles are taken, which costs or saves time; any order finds the same pairs.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches, 1):
            sets = [shingle_set(digests(x, shingle, xxhash.xxh3_128_digest)) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([np.empty(0, np.int64), *sets]))], names=["token"])

    part = max(1, docs.count() // sample)
    some = docs.filter(F.pmod(F.xxhash64("doc_id"), F.lit(part)) == 0).select("doc_id", "text")
    found = some.mapInArrow(run, "token long").groupBy("token").count().filter("count >= 3").orderBy(F.desc("count"), "token").limit(most).toArrow()
    tokens, counts = (c.to_numpy() for c in found.columns)
    order = np.argsort(tokens)
    return tokens[order], counts[order]


def prefix(tokens: np.ndarray, ranks: tuple[np.ndarray, np.ndarray], least: float) -> np.ndarray:
    """The rarest of a set's sorted shingles, so many that any set similar to ``least`` has one of them among its own."""
    known, counts = ranks
    weight = np.zeros(len(tokens), np.int64)
    if len(known):
        at = np.minimum(np.searchsorted(known, tokens), len(known) - 1)
        weight = np.where(known[at] == tokens, counts[at], 0)
    return tokens[np.argsort(weight, kind="stable")][: len(tokens) - ceil(least * len(tokens) - 1e-9) + 1]


def parities(tokens: np.ndarray, classes: int = STAGE_BITS) -> bytes:
    """For each of the classes of shingles, whether their number is odd: as many bits differ, at most, as there are shingles that two sets don't share."""
    return np.packbits(np.bincount(tokens & (classes - 1), minlength=classes) & 1).tobytes()


def wide_parities(tokens: np.ndarray) -> bytes | None:
    """Parities in as many classes as there are shingles, or up to twice as many, where ``STAGE_BITS`` are too few."""
    return parities(tokens, 1 << (len(tokens) - 1).bit_length()) if len(tokens) > STAGE_BITS else None


def least_apart(x: bytes, y: bytes) -> int:
    """Differing parities in the classes of the one that has fewer: halves of the other add up."""
    x, y = (np.frombuffer(v, np.uint64) for v in sorted((x, y), key=len))
    while len(y) > len(x):
        y = y[: len(y) // 2] ^ y[len(y) // 2 :]
    return int(distance(x, y))


def _profiles(docs: DataFrame, shingle: int, least: float, ranks: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """doc_id, hi, lo, mark (hash of the shingle set), n (its size), bits, wide, prefix from (doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches, 1):
            prints, sets = [], []
            for text in batch.column(1).to_pylist():
                raws = list(digests(text, shingle, xxhash.xxh3_128_digest))
                prints.append(votes(raws).ljust(16, b"\0"))
                sets.append(shingle_set(raws))
            both = np.frombuffer(b"".join(prints), ">i8").astype(np.int64).reshape(-1, 2)
            marks = np.array([xxhash.xxh3_64_intdigest(x.tobytes()) for x in sets], np.uint64).view(np.int64)
            columns = [batch.column(0), *(pa.array(np.ascontiguousarray(both[:, k])) for k in (0, 1)), pa.array(marks), pa.array([len(x) for x in sets], pa.int32())]
            yield pa.RecordBatch.from_arrays([*columns, *(pa.array(list(map(f, sets)), pa.binary()) for f in (parities, wide_parities)), pa.array([prefix(x, ranks, least) for x in sets], pa.list_(pa.int64()))], names=["doc_id", "hi", "lo", "mark", "n", "bits", "wide", "prefix"])

    return docs.mapInArrow(run, "doc_id long, hi long, lo long, mark long, n int, bits binary, wide binary, prefix array<long>")


def _shingle_sets(texts: DataFrame, shingle: int) -> DataFrame:
    """mark, shingles of rows (text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches, 0, 200):
            sets = [shingle_set(digests(x, shingle, xxhash.xxh3_128_digest)) for x in batch.column(0).to_pylist()]
            marks = np.array([xxhash.xxh3_64_intdigest(x.tobytes()) for x in sets], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(marks), pa.array(sets, pa.list_(pa.int64()))], names=["mark", "shingles"])

    return texts.mapInArrow(run, "mark long, shingles array<long>")


def rep_sets(named: DataFrame, reps: DataFrame, docs: DataFrame, shingle: int) -> DataFrame:
    """rep, shingles of the reps in ``named`` (rep, distinct).

    Only the texts of these are read again: by their id, or by their shingle set where no document of it has an id.
    """
    wanted = common.staged(reps.join(named, "rep").select("rep", "mark", "first_id"), "wanted", True)
    few = wanted.limit(common.BROADCAST_ROWS + 1).count() <= common.BROADCAST_ROWS
    small = F.broadcast if few else lambda x: x
    texts = docs.join(small(wanted.select("first_id").distinct()), docs["doc_id"] == F.col("first_id"), "left_semi").select("text")
    if not wanted.filter("first_id IS NULL").isEmpty():
        texts = texts.unionAll(docs.filter("doc_id IS NULL").select("text"))
    sets = common.staged(_shingle_sets(texts, shingle).join(small(wanted), "mark").select("rep", "shingles"), "shingles")
    return sets.dropDuplicates(["rep"]) if sets.count() > wanted.count() else sets  # rows that repeat an id


def verified(edges: DataFrame, reps: DataFrame, docs: DataFrame, least: float, shingle: int) -> DataFrame:
    """Those of the edges (a, b: rep) whose shingle sets have a Jaccard similarity of ``least`` or more."""
    named = edges.select(F.col("a").alias("rep")).unionAll(edges.select(F.col("b").alias("rep"))).distinct()
    sets = rep_sets(named, reps, docs, shingle)
    both = edges.join(sets.toDF("a", "ours"), "a").join(sets.toDF("b", "theirs"), "b")
    shared = F.size(F.array_intersect("ours", "theirs"))
    return both.filter(shared >= least * (F.size("ours") + F.size("theirs") - shared)).select("a", "b")


def whole_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by their first column, a key, in batches that no key goes beyond. Holds one batch and the rows of one key."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(0).to_numpy(zero_copy_only=False)
        cut = int(np.searchsorted(keys, keys[-1])) if not held or keys[-1] != held[-1].column(0)[-1].as_py() else 0
        if cut or (held and keys[0] != held[-1].column(0)[-1].as_py()):
            yield pa.concat_batches([*held, batch.slice(0, cut)])
            held = []
        held.append(batch.slice(cut))
    if held:
        yield pa.concat_batches(held)


def meetings(place: np.ndarray, n: np.ndarray, root: np.ndarray, least: float, few: int = 64) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(i, j), some at a time: of rows sorted by place and size, those of one place and two roots whose sizes don't rule out that they are similar.

    Rows of small groups are compared with the row some places on, all at a time; a large group row by row.
    """
    cuts = np.flatnonzero(np.diff(place)) + 1
    starts, ends = np.append(0, cuts), np.append(cuts, len(place))
    many = np.minimum.reduceat(root, starts) != np.maximum.reduceat(root, starts)
    left = np.repeat(np.where(many, ends, 0), ends - starts) - np.arange(len(place)) - 1
    small = np.repeat(ends - starts <= few, ends - starts)

    def fit(i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        near = (root[i] != root[j]) & (n[i] >= least * n[j] - 1e-6)
        return i[near], j[near]

    at = np.flatnonzero(small & (left > 0))
    for lag in range(1, few):
        at = at[left[at] >= lag]
        if not len(at):
            break
        yield fit(at, at + lag)
    for i in np.flatnonzero(~small & (left > 0)).tolist():
        # Sizes grow, so those that are too large for this one lie at the end.
        rest = np.arange(i + 1, i + 1 + int(np.searchsorted(n[i + 1 : i + 1 + left[i]], n[i] / least + 1e-6, "right")))
        yield fit(np.full(len(rest), i), rest)


#: Of rows (place, n, rest, rep, root, ...): for vectors (i, j) of their places, whether the pairs may be similar.
Test = Callable[[np.ndarray, np.ndarray], np.ndarray]


def rest_test(rows: pa.RecordBatch, least: float) -> Test:
    """Two sets whose first common shingle this is share no more than the lesser of what each has from there on (``rest``)."""
    n, rest = (rows.column(k).to_numpy().astype(np.int64) for k in (1, 2))
    return lambda i, j: (1 + least) * np.minimum(rest[i], rest[j]) >= least * (n[i] + n[j]) - 1e-6


def narrow_test(rows: pa.RecordBatch, least: float) -> Test:
    """By the parities in column 5."""
    n = rows.column(1).to_numpy().astype(np.int64)
    bits = np.frombuffer(b"".join(rows.column(5).to_pylist()), np.uint64).reshape(rows.num_rows, -1)
    return lambda i, j: (1 + least) * distance(bits[i], bits[j]) <= (1 - least) * (n[i] + n[j]) + 1e-6


def parity_test(rows: pa.RecordBatch, least: float) -> Test:
    """By ``rest`` and the parities in columns 5 and 6."""
    tests = rest_test(rows, least), narrow_test(rows, least)
    n, wide = rows.column(1).to_pylist(), rows.column(6)
    wide = {k: wide[k].as_py() for k in np.flatnonzero(wide.is_valid().to_numpy(zero_copy_only=False)).tolist()}

    def test(i: np.ndarray, j: np.ndarray) -> np.ndarray:
        near = tests[0](i, j)
        near[near] = tests[1](i[near], j[near])
        for k in np.flatnonzero(near).tolist():
            a, b = int(i[k]), int(j[k])
            if a in wide and b in wide:
                near[k] = (1 + least) * least_apart(wide[a], wide[b]) <= (1 - least) * (n[a] + n[b]) + 1e-6
        return near

    return test


def first_test(rows: pa.RecordBatch, least: float) -> Test:
    """By the parities in column 5, and whether no lesser place is in both rows' lists of places (column 6): a pair that meets in many places is left in one."""
    narrow = narrow_test(rows, least)
    before = [{p for p in places if p < place} for place, places in zip(rows.column(0).to_pylist(), rows.column(6).to_pylist(), strict=True)]

    def test(i: np.ndarray, j: np.ndarray) -> np.ndarray:
        near = narrow(i, j)
        near[near] = [before[a].isdisjoint(before[b]) for a, b in zip(i[near].tolist(), j[near].tolist(), strict=True)]
        return near

    return test


def facing(batches: Iterator[pa.RecordBatch], least: float, of: Callable[[pa.RecordBatch, float], Test], columns: int) -> Iterator[pa.RecordBatch]:
    """Of rows (place, n, rest, rep, root, ...) sorted by place and n, the first columns of those that meet one there that the test leaves. Never more rows than came."""
    for rows in whole_keys(batches):
        place, n = (rows.column(k).to_numpy() for k in (0, 1))
        test, kept = of(rows, least), np.zeros(rows.num_rows, bool)
        for i, j in meetings(place, n, pc.coalesce(rows.column(4), rows.column(3)).to_numpy(), least):
            near = test(i, j)
            kept[i[near]] = kept[j[near]] = True
        yield rows.select(list(range(columns))).filter(pa.array(kept))


def counted_links(batches: Iterator[pa.RecordBatch], least: float) -> Iterator[pa.RecordBatch]:
    """a, b: of rows (place, n, rest, rep, root, bits, shingles) sorted by place and n, a forest of reps similar to ``least`` or more, counted on their shingles, for each place."""
    for rows in whole_keys(batches):
        place, n, rep = (rows.column(k).to_numpy() for k in (0, 1, 3))
        root = pc.coalesce(rows.column(4), rows.column(3)).to_numpy()
        near, sets = narrow_test(rows, least), rows.column(6)
        parent: dict[tuple[int, int], tuple[int, int]] = {}

        def top(x: tuple[int, int]) -> tuple[int, int]:
            while (up := parent.get(x, x)) != x:
                parent[x] = x = parent.get(up, up)
            return x

        found = []
        for i, j in meetings(place, n, root, least):
            alike = near(i, j)
            for a, b in zip(i[alike].tolist(), j[alike].tolist(), strict=True):
                x, y = (top((int(place[k]), int(root[k]))) for k in (a, b))
                if x == y:
                    continue
                shared = len(np.intersect1d(sets[a].values.to_numpy(), sets[b].values.to_numpy(), assume_unique=True))
                if shared >= least * (int(n[a]) + int(n[b]) - shared):
                    parent[x] = y
                    found.append((rep[a], rep[b]))
        ends = np.array(found, np.int64).reshape(-1, 2)
        yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(ends[:, k])) for k in (0, 1)], names=["a", "b"])


def rest_links(reps: DataFrame, roots: DataFrame, docs: DataFrame, least: float, shingle: int, block: int = 4 * STAGE_BLOCK, most: int = 1 << 22) -> DataFrame:
    """a, b: links of reps similar to ``least`` or more that join whatever is so similar and the components (node, root) don't join yet.

    Two sets so similar share a shingle of their prefixes, so they meet under these; no table of pairs is made. Each step only drops rows that meet no row
    of another component that may be similar: by sizes and what is left behind the shingle; by parities; in all places but the first of those where a pair
    meets. The sets of the few rows left are then compared place by place, and each place gives a forest of links. Shingles with more than about ``block`` rows,
    or ``most`` shingles in these, are dealt to blocks, each pair of blocks a place of its own.
    """
    spark = reps.sparkSession
    kinds = "place long, n int, rest int, rep long, root long"

    def meet(rows: DataFrame, of: Callable[[pa.RecordBatch, float], Test], columns: int, label: str) -> DataFrame:
        kept = rows.repartition("place").sortWithinPartitions("place", "n").mapInArrow(lambda batches: facing(batches, least, of, columns), kinds + ", bits binary" * (columns > 5))
        return common.staged(kept.repartition(spark.sparkContext.defaultParallelism), label)  # made by many tasks, few rows: few files

    placed = reps.join(roots, reps["rep"] == roots["node"], "left").select("rep", "n", "prefix", F.when(F.col("root") != F.col("rep"), F.col("root")).alias("root"))
    spread = placed.select("rep", "n", "root", F.posexplode("prefix").alias("at", "place")).select("place", "n", (F.col("n") - F.col("at")).alias("rest"), "rep", "root")
    rows = meet(spread, rest_test, 5, "tokens")
    common.free_memory(spark)
    heavy = rows.groupBy("place").agg(F.ceil(F.greatest(F.count("*") / block, F.sum("n") / most)).cast("int").alias("parts")).filter("parts > 1")
    heavy = common.staged(heavy, "heavy", True)
    if n := heavy.limit(common.BROADCAST_ROWS + 1).count():
        rows = rows.join(F.broadcast(heavy) if n <= common.BROADCAST_ROWS else heavy, "place", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
        rows = rows.withColumn("part", F.pmod(F.xxhash64("rep"), F.col("parts")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        own = F.when(F.col("parts") > 1, F.xxhash64("place", F.least("part", "other"), F.greatest("part", "other"))).otherwise(F.col("place"))
        rows = rows.select(own.alias("place"), "n", "rest", "rep", "root")
    rows = rows.join(reps.select("rep", "bits", "wide"), "rep").select("place", "n", "rest", "rep", "root", "bits", "wide")
    rows = meet(rows, parity_test, 6, "alike")
    lists = rows.groupBy("rep").agg(F.collect_list("place").alias("places"))
    rows = meet(rows.join(lists, "rep").select(*rows.columns, "places"), first_test, 6, "first")
    common.free_memory(spark)
    sets = rep_sets(rows.select("rep").distinct(), reps, docs, shingle)
    rows = rows.join(sets, "rep").select(*rows.columns, "shingles").repartition("place").sortWithinPartitions("place", "n")
    return rows.mapInArrow(lambda batches: counted_links(batches, least), "a long, b long").repartition(spark.sparkContext.defaultParallelism)


def similar_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", differ: int = STAGE_DIFFER, least: float = STAGE_LEAST, shingle: int = STAGE_SHINGLE, width: int = STAGE_SEGMENT) -> DataFrame:
    """doc_id, component_id of every row: documents joined by all pairs whose shingle sets are similar to ``least`` or more.

    Most are found by 128-bit fingerprints with the deletion variants of ``near_duplicates``, in segments of ``width`` bits: a pair is looked at if some segment
    differs by one bit at most and the whole by ``differ`` bits; each key's pairs are thinned to a forest of the nearest ones, whose similarity is then
    counted on the shingles themselves. Documents of different components that are left meet under the rarest fifth of their shingles and are linked there (``rest_links``).
    """
    body = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    prints = common.staged(_profiles(body, shingle, least, common_shingles(body, shingle)), "fingerprints")
    with common.scratch(docs.sparkSession) as stage:
        firsts = prints.groupBy("hi", "lo", "mark").agg(F.min("doc_id").alias("first_id"), *(F.first(c).alias(c) for c in ("n", "bits", "wide", "prefix")))
        reps = stage(firsts.withColumn("rep", F.monotonically_increasing_id()), "reps")
        found = wide_links(reps.select("hi", "lo").distinct(), differ, width)
        ends = [reps.select(F.col("hi").alias(f"{x}0"), F.col("lo").alias(f"{x}1"), F.col("rep").alias(x)) for x in "ab"]
        common.free_memory(docs.sparkSession)
        edges = stage(found.join(ends[0], ["a0", "a1"]).join(ends[1], ["b0", "b1"]).select("a", "b"), "pairs", True)
        roots = components(verified(edges, reps, body, least, shingle))
        common.free_memory(docs.sparkSession)
        others = stage(rest_links(reps, roots, body, least, shingle), "others")
        common.free_memory(docs.sparkSession)
        if not others.isEmpty():
            roots = components(roots.select(F.col("root").alias("a"), F.col("node").alias("b")).unionAll(others))
        grouped = reps.join(roots, reps["rep"] == roots["node"]).select("rep", "first_id", "root")
        nearest = grouped.groupBy("root").agg(F.min("first_id").alias("least_id"))
        moved = grouped.select("rep", "root").join(nearest, "root").select("rep", "least_id")
        classes = common.staged(reps.join(moved, "rep", "left").select("hi", "lo", "mark", F.coalesce("least_id", "first_id").alias("component_id")), "classes", True)
    return prints.join(classes, ["hi", "lo", "mark"]).select("doc_id", "component_id")


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with one document of each group of similar ones: that with the least id (all rows of that id, where it repeats)."""
    found = similar_documents(docs, id_col, text_col, **options)
    gone = common.staged(found.filter("doc_id != component_id").select(F.col("doc_id").alias("gone_id")).distinct(), "gone", True)
    return docs.join(gone, docs[id_col] == gone["gone_id"], "left_anti")
