"""Toxicity: a factorization machine over hashed terms.

Terms are a document's distinct words and their first four and five letters, hashed to ``SLOTS`` slots; each slot has a weight and
``FACTORS`` factors, so that a pair of terms can count for what neither says alone. The machine is fitted on the driver, on a sample of labelled rows
bounded by ``SAMPLE`` for each label; of the slots that tell the labels apart
beyond chance it keeps the ``KEPT`` best.

Cases: null and empty texts score as what no term says (the bias); a null doc_id counts as an empty id for the fold, which isn't held out; a
document with several labels is toxic if one says so, one with several texts is learnt by the least of them; a text is held whole by one task; without labelled rows of both kinds every score is the share of toxic rows
(0.0 without any); repeated rows score alike; an empty table gives no row.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

SLOTS = 1 << 18
KEPT = 4096
FACTORS = 8
SAMPLE = 3000
FOLDS, HELD_OUT = 4, 2
THRESHOLD = 0.3
CACHE = 150_000
CHANCE = 0.0
_WORDS = re.compile(r"[^\W\d_]+")


def slots_of(word: str) -> tuple[int, ...]:
    """Hash slots of a word's terms."""
    terms = [word, *("^" + word[:n] for n in (4, 5) if len(word) > n)]
    return tuple(zlib.crc32(t.encode("utf-8", "replace")) % SLOTS for t in terms)


def text_slots(text: str | None) -> np.ndarray:
    found: set[int] = set()
    for word in set(_WORDS.findall((text or "").lower())):
        found.update(slots_of(word))
    return np.fromiter(found, np.int64, len(found))


def fold(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % FOLDS


class Machine:
    """The fitted machine: bias, weight and factors of the kept slots."""

    def __init__(self, bias: float, slots: np.ndarray, weights: np.ndarray, factors: np.ndarray):
        self.bias, self.place = bias, {int(s): i for i, s in enumerate(slots)}
        self.weights, self.factors = weights, factors
        self.cache: dict[str, tuple[int, ...]] = {}

    def __getstate__(self):
        return self.__dict__ | {"cache": {}}

    def known(self, word: str) -> tuple[int, ...]:
        got = self.cache.get(word)
        if got is None:
            if len(self.cache) > CACHE:
                self.cache.clear()
            got = self.cache[word] = tuple(self.place[s] for s in slots_of(word) if s in self.place)
        return got

    def score(self, text: str | None) -> float:
        on: set[int] = set()
        for word in set(_WORDS.findall((text or "").lower())):
            on.update(self.known(word))
        at = np.fromiter(sorted(on), np.int64, len(on))
        return float(1 / (1 + np.exp(-np.clip(margin(self.bias, self.weights[at], self.factors[at]), -30, 30))))


def margin(bias: float, weights: np.ndarray, factors: np.ndarray) -> float:
    """Bias, weights and all pairs of the terms that are there, by the sum-of-squares identity; each term weighs 1/sqrt(1 + terms/16)."""
    scale = 1 / np.sqrt(1 + len(weights) / 16)
    total = factors.sum(0)
    return bias + scale * weights.sum() + 0.5 * scale * scale * float((total * total).sum() - (factors * factors).sum())


def fit(rows: list[tuple[np.ndarray, int]], kept: int = KEPT, factors: int = FACTORS, epochs: int = 12, rate: float = 0.05, decay: float = 1e-5, seed: int = 7) -> Machine:
    """A machine from (slots, label) rows: logistic loss, adaptive gradient steps row by row."""
    y = np.array([label for _, label in rows], float)
    share = float(y.mean()) if len(y) else 0.0
    if not 0 < share < 1:
        bias = -30.0 if share == 0 else 30.0
        return Machine(bias, np.empty(0, np.int64), np.empty(0), np.empty((0, factors)))
    seen, toxic = np.zeros(SLOTS), np.zeros(SLOTS)
    for slots, label in rows:
        seen[slots] += 1
        if label:
            toxic[slots] += 1
    # Twice the log likelihood ratio of a slot's labels against the whole sample's, and what chance alone reaches among so many slots.
    clean, tried = seen - toxic, max(int((seen > 0).sum()), 2)
    with np.errstate(divide="ignore", invalid="ignore"):
        ratio = 2 * (np.where(toxic > 0, toxic * np.log(toxic / (seen * share)), 0) + np.where(clean > 0, clean * np.log(clean / (seen * (1 - share))), 0))
    best = np.argsort(-ratio, kind="stable")[:kept]
    best = np.sort(best[ratio[best] > 2 * np.log(tried) + CHANCE])
    place = np.full(SLOTS, -1)
    place[best] = np.arange(len(best))
    data = [(at[at >= 0], label) for at, label in ((place[slots], label) for slots, label in rows)]
    rng = np.random.default_rng(seed)
    w, v = np.zeros(len(best)), rng.normal(0, 0.01, (len(best), factors))
    gw, gv, gb = np.full(len(best), 1e-3), np.full((len(best), factors), 1e-3), 1e-3
    bias = float(np.log(share / (1 - share)))
    for _ in range(epochs):
        for i in rng.permutation(len(data)):
            at, label = data[i]
            scale = 1 / np.sqrt(1 + len(at) / 16)
            va = v[at]
            total = va.sum(0)
            miss = 1 / (1 + np.exp(-np.clip(margin(bias, w[at], va), -30, 30))) - label
            gb += miss * miss
            bias -= rate * miss / np.sqrt(gb)
            step = miss * scale + decay * w[at]
            gw[at] += step * step
            w[at] -= rate * 4 * step / np.sqrt(gw[at])
            step = miss * scale * scale * (total - va) + decay * va
            gv[at] += step * step
            v[at] -= rate * step / np.sqrt(gv[at])
    return Machine(bias, best, w, v)


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE, **options) -> Machine:
    """A machine from at most ``sample`` labelled rows of each label outside the held-out fold, taken in hash order."""
    known = labels.select(F.col("doc_id").alias("labelled_id"), F.col("toxic").cast("int").alias("label")).filter(F.col("label").isNotNull() & F.col("labelled_id").isNotNull() & (fold(F.col("labelled_id")) != HELD_OUT))
    known = known.groupBy("labelled_id").agg(F.max("label").alias("label"))
    order = (F.xxhash64("labelled_id"), F.col("labelled_id"))
    picked = known.filter("label = 1").orderBy(*order).limit(sample).unionAll(known.filter("label = 0").orderBy(*order).limit(sample))
    chosen = docs.sparkSession.createDataFrame(picked.collect(), "labelled_id long, label int")  # 2 * sample rows at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in common.slices(batches, 1):
            rows = [text_slots(x).astype("<i4").tobytes() for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(rows, pa.binary()), b.column(2)], names=["id", "slots", "label"])

    texts = docs.select(F.col(id_col).cast("long").alias("labelled_id"), F.col(text_col).cast("string").alias("body")).join(F.broadcast(chosen), "labelled_id")
    found = texts.groupBy("labelled_id").agg(F.min("body").alias("body"), F.first("label").alias("label")).mapInArrow(run, "id long, slots binary, label int").collect()
    found.sort(key=lambda r: r["id"])
    return fit([(np.frombuffer(r["slots"], "<i4").astype(np.int64), r["label"]) for r in found], **options)


def scorer(machine: Machine):
    """An Arrow function of a text column: the machine's score."""

    @F.arrow_udf("double")
    def toxicity(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in texts:
            yield pa.array([machine.score(x.as_py()) for x in column], pa.float64())

    return toxicity


def score_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, **options) -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""
    machine = train(docs, labels, id_col, text_col, **options)
    scored = docs.select(F.col(id_col).alias("doc_id"), scorer(machine)(F.col(text_col).cast("string")).alias("score"))
    return scored.select("doc_id", (fold(F.col("doc_id")) == HELD_OUT).alias("held_out"), "score", F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"))


def keep_clean(docs: DataFrame, labels: DataFrame, text_col: str = "text", threshold: float = THRESHOLD, **options) -> DataFrame:
    """``docs`` without the rows whose score reaches ``threshold``."""
    machine = train(docs, labels, text_col=text_col, **options)
    score = common.free_name(docs, "toxicity")
    return docs.withColumn(score, scorer(machine)(F.col(text_col).cast("string"))).filter(F.col(score) < threshold).drop(score)
