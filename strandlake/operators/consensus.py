"""Consensus sequences of clusters and variants against a reference, by dynamic programming in numpy."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .reads import downsample

VARIANTS = "file_stem string, cluster_number int, position int, ref string, query string, variant_type string, ref_pos int"
NEVER = -1e9


def align_global(query: str, ref: str, match: float = 2.0, mismatch: float = -6.0, gap_open: float = 5.0, gap_extend: float = 2.0) -> tuple[str, str]:
    """Global alignment with affine gaps (a gap of n costs open + n * extend): both sequences with ``-``.

    Ties prefer the diagonal, then a gap in the reference.
    """
    n, m = len(query), len(ref)
    q, r = np.frombuffer(query.encode("latin-1", "replace"), np.uint8), np.frombuffer(ref.encode("latin-1", "replace"), np.uint8)
    best, down, side = (np.full((n + 1, m + 1), NEVER) for _ in range(3))
    best[0, 0] = 0
    steps = np.arange(m + 1)
    side[0, 1:] = -gap_open - gap_extend * steps[1:]
    best[0, 1:] = side[0, 1:]
    for i in range(1, n + 1):
        down[i] = np.maximum(best[i - 1] - gap_open, down[i - 1]) - gap_extend
        row = np.full(m + 1, NEVER)
        row[1:] = best[i - 1, :-1] + np.where(r == q[i - 1], match, mismatch)
        row = np.maximum(row, down[i])
        # The best gap along the row, from a running maximum of what each cell could open.
        opened = np.maximum.accumulate(row + gap_extend * steps)
        side[i, 1:] = opened[:-1] - gap_open - gap_extend * steps[1:]
        best[i] = np.maximum(row, side[i])
    i, j, a, b, state = n, m, [], [], 0
    while i or j:
        if state == 0:
            if i and j and np.isclose(best[i, j], best[i - 1, j - 1] + (match if q[i - 1] == r[j - 1] else mismatch)):
                i, j = i - 1, j - 1
                a.append(query[i])
                b.append(ref[j])
            elif i and np.isclose(best[i, j], down[i, j]):
                state = 1
            else:
                state = 2
        elif state == 1:
            state = 0 if np.isclose(down[i, j], best[i - 1, j] - gap_open - gap_extend) else 1
            i -= 1
            a.append(query[i])
            b.append("-")
        else:
            state = 0 if np.isclose(side[i, j], best[i, j - 1] - gap_open - gap_extend) else 2
            j -= 1
            a.append("-")
            b.append(ref[j])
    return "".join(reversed(a)), "".join(reversed(b))


def consensus(seqs: list[str], threshold: float = 0.5) -> str | None:
    """Majority sequence of a star alignment around the commonest sequence; gaps dropped, undecided columns N.

    ``threshold`` is the disagreement that a column may have: 0.05 calls a base that 95 % share, 0.5 the majority's. Columns that reads put between those of
    the centre are called alike, what the other reads have there being a gap. Sequences don't vote beyond their own ends. One sequence is its own
    consensus; none gives None.
    """
    seqs = [s for s in seqs if s]
    if not seqs:
        return None
    if len(seqs) == 1:
        return seqs[0]
    tally = Counter(seqs)
    centre = min(tally, key=lambda s: (-tally[s], abs(len(s) - float(np.median([len(x) for x in seqs]))), s))
    width = len(centre)
    inserts: dict[int, Counter] = {}
    votes = [Counter() for _ in range(width)]
    spans: list[tuple[int, int, int]] = []
    for seq, n in sorted(tally.items()):
        a, b = (seq, centre) if seq == centre else align_global(seq, centre, 1, -1, 2, 1)
        real = [k for k, x in enumerate(a) if x != "-"]
        at, run, first, last = 0, "", None, -1
        for k, (x, y) in enumerate(zip(a, b, strict=True)):
            if y == "-":
                run += x
                continue
            if run:
                inserts.setdefault(at, Counter())[run] += n
                run = ""
            if real and real[0] <= k <= real[-1]:
                votes[at][x] += n
                first, last = at if first is None else first, at
            at += 1
        if run:
            inserts.setdefault(at, Counter())[run] += n
        spans.append((first or 0, last, n))
    out, need = [], 1 - threshold - 1e-12
    for at in range(width + 1):
        if at in inserts:
            text, n = min(inserts[at].items(), key=lambda t: (-t[1], t[0]))
            over = sum(c for a, b, c in spans if a <= at <= b + 1)
            gap = (over - inserts[at].total()) / over if over else 1.0
            if over and n / over >= need and n / over > gap:
                out.append(text)
            elif gap < need:
                out.append("N" * len(text))
        if at < width and votes[at]:
            base, n = min(votes[at].items(), key=lambda t: (-t[1], t[0]))
            out.append(base if n / votes[at].total() >= need and list(votes[at].values()).count(n) == 1 else "N")
    text = "".join(out).replace("-", "")
    return "".join(c if c in "ACGT" else "N" for c in text)


def cluster_consensus(rows: DataFrame, threshold: float = 0.5, sample: int = 50) -> DataFrame:
    """Consensus of the whole read (left, mid, right joined) and of each segment, of at most ``sample`` reads of each cluster."""
    key = ("file_stem", "cluster_number")
    total = rows.groupBy(*key).agg(F.count("*").alias("read_count"))
    some = downsample(rows, sample, key).select(*key, "qname", "left", "mid", "right")

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("qname")
        parts = {c: pdf[c].fillna("").tolist() for c in ("left", "mid", "right")}
        full = ["".join(x) for x in zip(*parts.values(), strict=True)]
        made = {"consensus_full": consensus(full, threshold)} | {f"consensus_{c}": consensus(v, threshold) for c, v in parts.items()}
        return pd.DataFrame([{"file_stem": pdf["file_stem"].iloc[0], "cluster_number": pdf["cluster_number"].iloc[0], "n_seqs_consensus": len(pdf)} | made])

    found = some.groupBy(*key).applyInPandas(run, "file_stem string, cluster_number int, n_seqs_consensus int, consensus_full string, consensus_left string, consensus_mid string, consensus_right string")
    total = total.toDF("_stem", "_cluster", "read_count")
    both = F.col("file_stem").eqNullSafe(F.col("_stem")) & F.col("cluster_number").eqNullSafe(F.col("_cluster"))
    return found.join(total, both).drop("_stem", "_cluster")


def call_variants(query: str, ref: str, **scores) -> list[tuple[int, str, str, str, int]]:
    """(alignment column, ref, query, type, reference place) of each column that isn't a match; an insertion stands at the base before it."""
    a, b = align_global(query, ref, **scores)
    out, place = [], 0
    for column, (x, y) in enumerate(zip(a, b, strict=True), 1):
        place += y != "-"
        if x != y:
            out.append((column, y, x, "insertion" if y == "-" else "deletion" if x == "-" else "mismatch", place))
    return out


def variants(found: DataFrame, reference: str, column: str = "consensus_full", **scores) -> DataFrame:
    """VARIANTS of every cluster's consensus against one reference sequence."""

    def run(parts):
        for pdf in parts:
            rows = [(f, c, p, r, q, t, at) for f, c, s in pdf.itertuples(index=False) if s for p, r, q, t, at in call_variants(s, reference, **scores)]
            yield pd.DataFrame(rows, columns=["file_stem", "cluster_number", "position", "ref", "query", "variant_type", "ref_pos"])

    return found.select("file_stem", "cluster_number", column).mapInPandas(run, VARIANTS)


def variant_summary(rows: DataFrame) -> DataFrame:
    """Variants of each cluster by type, side by side."""
    return rows.groupBy("file_stem", "cluster_number").agg(*(F.count_if(F.col("variant_type") == t).alias(t) for t in ("insertion", "deletion", "mismatch")))


def vcf_rows(rows: DataFrame) -> DataFrame:
    """Variants that a VCF can hold: substitutions behind the first base, without N."""
    return rows.filter("position > 1 and ref not in ('N', '-') and query not in ('N', '-')")
