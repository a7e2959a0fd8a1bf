"""URL filters: host and path rules first, else logistic regression on hashed character n-grams.

Everything on the main path is a column expression: n-grams, hashing and the weighted sum stay in the JVM. The
weights are fitted on the driver from a small labelled table (``MAX_LABELLED`` rows at most), whose features come from the same
expressions.

Cases: a null url, or one without ``://``, has an empty host and path and is judged by the model alone; of rules of equal length
``block`` wins; a url is one row, however long;
repeated rows are judged alike; an empty table gives no row.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import labelled_urls

MAX_LABELLED = 10_000
DIMS = 1 << 12
GRAMS = (3, 4)

RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/")]


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url column; both empty where it has no ``://``."""
    rest = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1), F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)


def rule_columns(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, else nulls. A rule is ``host/path``."""
    rule = verdict = None
    for said, text in sorted(rules, key=lambda r: (-len(r[1]), r[0] != "block")):
        name, _, tail = text.partition("/")
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith("/" + tail)
        rule = F.when(fits, text) if rule is None else rule.when(fits, text)
        verdict = F.when(fits, said) if verdict is None else verdict.when(fits, said)
    none = F.lit(None).cast("string")
    return (none, none) if rule is None else (rule.otherwise(none), verdict.otherwise(none))


def gram_slots(host: Column, path: Column, dims: int = DIMS) -> Column:
    """Hash slots of the n-grams of ``^host$`` and ``^path$``; the two parts hash apart."""

    def grams(text: Column, mark: str, n: int) -> Column:
        bounded = F.concat(F.lit("^"), text, F.lit("$"))
        starts = F.sequence(F.lit(1), F.greatest(F.length(bounded) - (n - 1), F.lit(1)))
        return F.transform(starts, lambda i: F.pmod(F.xxhash64(F.concat(F.lit(mark), F.substring(bounded, i, F.lit(n)))), F.lit(dims)).cast("int"))

    return F.concat(*(grams(text, mark, n) for text, mark in ((host, "h"), (path, "p")) for n in GRAMS))


def fit(spark: SparkSession, labelled: list[tuple[str, int]] | None = None, dims: int = DIMS, epochs: int = 300, rate: float = 0.5, decay: float = 1e-4) -> tuple[np.ndarray, float]:
    """Weights and bias by full-batch gradient steps on a labelled table of at most MAX_LABELLED rows."""
    labelled = labelled_urls.rows() if labelled is None else labelled
    if len(labelled) > MAX_LABELLED:
        raise ValueError(f"at most {MAX_LABELLED} labelled urls")
    df = spark.createDataFrame(labelled, "url string, label int")
    rows = df.select(gram_slots(*split_url(F.col("url")), dims).alias("slots"), "label").collect()
    x = np.zeros((len(rows), dims))
    for i, row in enumerate(rows):
        np.add.at(x[i], row["slots"], 1 / np.sqrt(len(row["slots"])))
    y = np.array([r["label"] for r in rows], float)
    share = max(y.mean(), 1e-9)
    weight = np.where(y > 0, 0.5 / share, 0.5 / max(1 - share, 1e-9))
    w, b = np.zeros(dims), 0.0
    for _ in range(epochs):
        miss = (1 / (1 + np.exp(-(x @ w + b))) - y) * weight
        w -= rate * (x.T @ miss / len(y) * 10 + decay * w)
        b -= rate * miss.mean()
    return w, float(b)


def score(host: Column, path: Column, model: tuple[np.ndarray, float]) -> Column:
    """Probability that a url is to be blocked."""
    w, b = model
    weights = F.split(F.lit(",".join(f"{x:.6g}" for x in w)), ",").cast("array<double>")  # folds to one literal
    slots = gram_slots(host, path, len(w))
    total = F.aggregate(slots, F.lit(0.0), lambda acc, i: acc + F.element_at(weights, i + 1))
    return 1 / (1 + F.exp(-(total / F.sqrt(F.size(slots)) + F.lit(b))))


def judge(pages: DataFrame, rules: list[tuple[str, str]] | None = None, labelled: list[tuple[str, int]] | None = None, id_col: str = "page_id", url_col: str = "url", threshold: float = 0.5) -> DataFrame:
    """page_id, host, path, rule, verdict, score of every row."""
    model = fit(pages.sparkSession, labelled)
    host, path = split_url(F.col(url_col).cast("string"))
    parts = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
    rule, verdict = rule_columns(F.col("host"), F.col("path"), RULES if rules is None else rules)
    scored = parts.select("*", rule.alias("rule"), verdict.alias("said"), score(F.col("host"), F.col("path"), model).alias("score"))
    return scored.select("page_id", "host", "path", "rule", F.coalesce("said", F.when(F.col("score") >= threshold, "block").otherwise("allow")).alias("verdict"), "score")
