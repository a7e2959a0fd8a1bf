"""Language identification by Bayesian evidence fusion.

A document's posterior combines the likelihood of its text (byte trigrams, fitted on a bounded sample of labelled rows), the language that it
declares, and a prior of its host. Priors are smoothed from all documents to address suffix to host, and come from one grouped
aggregation of text posteriors; so does the reliability of declarations.

Texts are scored once: their likelihoods are staged, and both the aggregation and the fusion read them there. The text model is the only part that learns from
labels; a label column is no evidence of its own row unless a caller names it as the declared one.

Cases: null and empty texts, and texts without a letter, have language ``und`` and are rejected; so are texts of
whose trigrams less than ``KNOWN`` occur in any language's sample; a null or unknown declaration counts as ``other``; a null host is a host of its own; languages come in alphabetical
order, the first of equals wins; a text is held whole by one task, its trigrams added up in chunks; repeated rows are judged alike; an empty table gives no row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

SLOTS = 1 << 15
SAMPLE = 300
HOSTS = 100_000
EVIDENCE = 60.0
KNOWN = 0.3
SMOOTH_HOST, SMOOTH_SUFFIX = 20.0, 20.0
LEAST = 0.5
LETTER = np.array([97 <= b <= 122 or b >= 128 or b in (10, 32) for b in range(256)])


def gram_slots(text: str) -> np.ndarray:
    """The slots of hashed byte trigrams in the lower-cased letters and spaces of a text, a space at each end; none without a letter."""
    raw = np.frombuffer(f" {text.lower()} ".encode("utf-8", "replace"), np.uint8)
    raw = raw[LETTER[raw]]
    if not (raw > 32).any():
        return np.zeros(0, np.int64)
    raw = raw.astype(np.uint32)
    h = (raw[:-2] * np.uint32(40503) + raw[1:-1] * np.uint32(9973) + raw[2:] * np.uint32(31)) * np.uint32(2654435761)
    return (h >> np.uint32(17)).astype(np.int64)


def gram_counts(text: str) -> np.ndarray:
    """How often each slot occurs in a text."""
    return np.bincount(gram_slots(text), minlength=SLOTS)


def declared_code(column: Column) -> Column:
    """The primary subtag of a language tag."""
    return F.lower(F.regexp_extract(F.coalesce(column, F.lit("")), r"^\s*([A-Za-z]+)", 1))


def page_evidence(html: Column, url: Column) -> tuple[Column, Column, Column]:
    """(declared language, host, address suffix) of a page, from its markup and its url."""
    said = F.regexp_extract(html, r"""(?is)<html\b[^>]*?\blang\s*=\s*["']?([A-Za-z-]+)""", 1)
    host = F.lower(F.regexp_extract(url, r"^[^:]*://([^/?#:]*)", 1))
    return said, host, F.regexp_extract(host, r"([^.]*)$", 1)


class TextModel:
    """Log probabilities of trigram slots for each language, and which slots any language's sample has."""

    def __init__(self, languages: list[str], counts: np.ndarray):
        self.languages = languages
        logs = np.log((counts + 0.5) / (counts + 0.5).sum(1, keepdims=True)) if len(languages) else np.zeros((0, SLOTS))
        self.table = np.ascontiguousarray(np.vstack([logs, counts.sum(0) > 0]).T, np.float32)

    def likelihoods(self, text: str | None, chunk: int = 1 << 16) -> list[float] | None:
        """Tempered log likelihoods of a text; None where it has no letter or is like no language."""
        slots = gram_slots(text or "")
        n = len(slots)
        if not n or not self.languages:
            return None
        total = sum(self.table[slots[i : i + chunk]].sum(0, dtype=np.float64) for i in range(0, n, chunk))
        return None if total[-1] < KNOWN * n else (total[:-1] / n * min(n, EVIDENCE)).tolist()


def train(docs: DataFrame, text_col: str = "text", label_col: str = "lang", sample: int = SAMPLE) -> TextModel:
    """A text model from about ``sample`` rows of each labelled language, chosen by a hash of the text."""
    code = declared_code(F.col(label_col).cast("string"))
    tally = docs.groupBy(code.alias("code")).count().filter("code <> ''").collect()
    share = {r["code"]: min(1.0, sample / r["count"]) for r in tally}
    names = sorted(share)
    if not names:
        return TextModel([], np.zeros((0, SLOTS)))
    rate = F.coalesce(*(F.when(code == k, F.lit(v)) for k, v in share.items()), F.lit(0.0))
    draw = F.pmod(F.xxhash64(F.col(text_col)), F.lit(1 << 20)) / float(1 << 20)
    picked = docs.filter(draw < rate).select(code, F.col(text_col).cast("string"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for b in common.slices(batches, 1):
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                total[lang] = total.get(lang, 0) + gram_counts(text or "")
        for lang, counts in total.items():
            at = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(counts[at], pa.int64())], names=["lang", "slot", "n"])

    counts = np.zeros((len(names), SLOTS))
    # a row for each language and slot at most
    found = picked.mapInArrow(run, "lang string, slot int, n long").groupBy("lang", "slot").agg(F.sum("n").alias("n")).toArrow()
    place = {x: i for i, x in enumerate(names)}
    rows = np.array([place[x] for x in found["lang"].to_pylist()], int)
    counts[rows, found["slot"].to_numpy()] = found["n"].to_numpy()
    return TextModel(names, counts)


def likelihood_udf(model: TextModel):
    @F.arrow_udf("array<double>")
    def likelihoods(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in texts:
            yield pa.array([model.likelihoods(x.as_py()) for x in column], pa.list_(pa.float64()))

    return likelihoods


def normal(logs: Column) -> Column:
    """Probabilities of an array of log weights."""
    raised = F.transform(logs, lambda x: F.exp(x - F.array_max(logs)))
    return F.transform(raised, lambda x: x / F.aggregate(raised, F.lit(0.0), lambda a, b: a + b))


def _numbers(values) -> Column:
    return F.expr(f"array({', '.join(f'{float(v)!r}D' for v in values)})")  # one call, however many languages


def with_language(docs: DataFrame, text_col: str = "text", declared_col: str | None = None, host_col: str | None = "source", suffix_col: str | None = None, label_col: str = "lang", model: TextModel | None = None, least: float = LEAST, keep: list[str] | None = None) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with three more columns (their names: language, posterior, accepted), every row kept, and every column or those in ``keep``."""
    model = model or train(docs, text_col, label_col)
    k = len(model.languages)
    keep = docs.columns if keep is None else keep
    names = {x: common.free_name(docs, x) for x in ("language", "posterior", "accepted")}
    kept = [F.col(f"`{c}`") for c in keep]
    if not k:
        return docs.select(*kept).withColumns({names["language"]: F.lit("und"), names["posterior"]: F.lit(0.0), names["accepted"]: F.lit(False)}), names
    logs, host, suffix, said, prior = (common.free_name(docs, x) for x in ("sl_logs", "sl_host", "sl_suffix", "sl_said", "sl_prior"))
    code = declared_code(F.col(declared_col).cast("string")) if declared_col else F.lit("")
    place = F.coalesce(*(F.when(code == x, F.lit(i)) for i, x in enumerate(model.languages)), F.lit(k))
    given = [
        place.alias(said),
        (F.coalesce(F.col(host_col).cast("string"), F.lit("")) if host_col else F.lit("")).alias(host),
        (F.coalesce(F.col(suffix_col).cast("string"), F.lit("")) if suffix_col else F.lit("")).alias(suffix),
    ]
    seen = common.staged(docs.select(*kept, *given, likelihood_udf(model)(F.col(text_col).cast("string")).alias(logs)), "likelihoods")

    # One grouped aggregation of text posteriors; everything else is rolled up from it.
    belief = seen.filter(F.col(logs).isNotNull()).select(host, suffix, said, normal(F.col(logs)).alias("p"))
    sums = [F.sum(F.element_at("p", i + 1)).alias(f"s{i}") for i in range(k)]
    tally = common.staged(belief.groupBy(host, suffix, said).agg(*sums), "evidence", True)
    up = [F.sum(f"s{i}").alias(f"s{i}") for i in range(k)]
    table = np.ones((k + 1, k)) * 0.5
    for r in tally.groupBy(said).agg(*up).collect():  # languages + 1 rows at most
        table[r[said]] += [r[f"s{i}"] for i in range(k)]
    whole = table.sum(0) / table.sum()
    reliable = np.log(table / table.sum(0, keepdims=True))

    def smoothed(prefix: str, parent: list[Column], weight: float) -> Column:
        own = [F.coalesce(F.col(f"{prefix}{i}"), F.lit(0.0)) for i in range(k)]
        n = F.aggregate(F.array(*own), F.lit(0.0), lambda a, b: a + b)
        return F.array(*((own[i] + parent[i] * weight) / (n + weight) for i in range(k)))

    by_suffix = tally.groupBy(suffix).agg(*(F.sum(f"s{i}").alias(f"u{i}") for i in range(k)))
    by_host = tally.groupBy(host, suffix).agg(*up).join(by_suffix, suffix)
    up_prior = smoothed("u", [F.lit(float(x)) for x in whole], SMOOTH_SUFFIX)
    priors = by_host.withColumn("above", up_prior)
    priors = priors.select(host, suffix, F.transform(smoothed("s", [F.element_at("above", i + 1) for i in range(k)], SMOOTH_HOST), lambda x: F.log(x)).alias(prior))
    priors = common.staged(priors, "host-priors", True)
    few = priors.limit(HOSTS + 1).count() <= HOSTS  # the size bound of the broadcast
    fused = seen.join(F.broadcast(priors) if few else priors, [host, suffix], "left")
    base = F.coalesce(F.col(prior), _numbers(np.log(whole)))
    declared = F.element_at(F.array(*(_numbers(row) for row in reliable)), F.col(said) + 1) if declared_col else _numbers(np.zeros(k))
    posterior = normal(F.zip_with(F.zip_with(F.col(logs), base, lambda a, b: a + b), declared, lambda a, b: a + b))
    fused = fused.withColumn(prior, posterior)
    top = F.array_max(prior)
    language = F.element_at(F.array(*map(F.lit, model.languages)), F.array_position(F.col(prior), top).cast("int"))
    known = F.col(logs).isNotNull()
    out = fused.withColumns({
        names["language"]: F.when(known, language).otherwise("und"),
        names["posterior"]: F.when(known, top).otherwise(0.0),
        names["accepted"]: F.when(known, top >= least).otherwise(False),
    })
    return out.select(*kept, *names.values()), names


def identify(docs: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """doc_id, language, posterior, accepted of every row; of its columns only the id is staged."""
    found, names = with_language(docs, keep=[id_col], **options)
    return found.select(F.col(id_col).alias("doc_id"), *(F.col(v).alias(k) for k, v in names.items()))


def identify_pages(pages: DataFrame, model: TextModel, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, language, posterior, accepted of every page: its visible text, ``<html lang>``, host and address suffix together."""
    html = F.col(html_col).cast("string")
    said, host, suffix = page_evidence(html, F.col(url_col).cast("string"))
    text = F.regexp_replace(html, r"(?is)<(script|style|title)\b(?:.*?</\1\s*>|.*)|<!--(?:.*?-->|.*)|<[^>]*(?:>|\z)", " ")
    seen = pages.select(F.col(id_col).cast("long").alias("page_id"), text.alias("text"), said.alias("said"), host.alias("host"), suffix.alias("suffix"))
    return identify(seen, "page_id", declared_col="said", host_col="host", suffix_col="suffix", model=model).withColumnRenamed("doc_id", "page_id")


def identify_corpus(docs: DataFrame, pages: DataFrame, **options) -> DataFrame:
    """kind, doc_id, page_id, language, posterior, accepted of every document and of every page, by one text model that the documents' labels train."""
    model = train(docs)
    one = identify(docs, model=model, **options).select(F.lit("document").alias("kind"), F.col("doc_id").cast("long").alias("doc_id"), F.lit(None).cast("long").alias("page_id"), "language", "posterior", "accepted")
    two = identify_pages(pages, model).select(F.lit("page").alias("kind"), F.lit(None).cast("long").alias("doc_id"), "page_id", "language", "posterior", "accepted")
    return one.unionAll(two)


def keep_accepted(docs: DataFrame, **options) -> DataFrame:
    """``docs`` without the rows that language identification rejects."""
    found, names = with_language(docs, **options)
    return found.filter(names["accepted"]).select(*(F.col(f"`{c}`") for c in docs.columns))
