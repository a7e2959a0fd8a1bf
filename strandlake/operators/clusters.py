"""Allele calling: clusters of reads by repeat length, by haplotype, or by one inside the other; renumbering and summaries.

Each sample is reduced to its distinct lengths or haplotypes (with counts) before any Python sees it; reads get their cluster by a join.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def mixture_order(x: np.ndarray, w: np.ndarray, most: int, rounds: int = 200) -> int:
    """Number of normal components, up to ``most``, with the best BIC on weighted values; equal and own variances are both tried.

    The search ends where two more components in a row haven't bettered it.
    """
    n, best, best_k = w.sum(), -np.inf, 1
    order = np.argsort(x)
    x, w = x[order], w[order]
    share = np.cumsum(w) / n
    floor = 1e-2
    for k in range(1, min(most, len(x)) + 1):
        if k > best_k + 2:
            break
        for equal in (True, False) if k > 1 else (True,):
            mean = x[np.searchsorted(share, (np.arange(k) + 0.5) / k).clip(0, len(x) - 1)].astype(float)
            mean += np.arange(k) * 1e-6
            var, mix = np.full(k, max(np.average((x - np.average(x, weights=w)) ** 2, weights=w) / k**2, floor)), np.full(k, 1 / k)
            last = -np.inf
            for _ in range(rounds):
                log = np.log(mix) - 0.5 * np.log(2 * np.pi * var) - 0.5 * (x[:, None] - mean) ** 2 / var
                top = log.max(1, keepdims=True)
                total = top[:, 0] + np.log(np.exp(log - top).sum(1))
                fit = float((total * w).sum())
                if fit - last < 1e-5 * (1 + abs(fit)):
                    break
                last = fit
                r = np.exp(log - total[:, None]) * w[:, None]
                mass = r.sum(0) + 1e-12
                mean, mix = (r * x[:, None]).sum(0) / mass, mass / mass.sum()
                var = (r * (x[:, None] - mean) ** 2).sum(0) / mass
                var = np.full(k, np.average(var, weights=mass)) if equal else var
                var = np.maximum(var, floor)
            score = 2 * last - np.log(n) * (2 * k + (1 if equal else k) - 1)
            if score > best + 1e-9:
                best, best_k = score, k
    return best_k


def best_split(x: np.ndarray, w: np.ndarray, k: int) -> np.ndarray:
    """Exact weighted one-dimensional k-means: label (from 1, ascending) of each sorted value."""
    n = len(x)
    cw, cx, cxx = (np.concatenate([[0], np.cumsum(v)]) for v in (w, w * x, w * x * x))

    def cost(i: np.ndarray, j: int) -> np.ndarray:
        mass = cw[j] - cw[i]
        return cxx[j] - cxx[i] - (cx[j] - cx[i]) ** 2 / mass

    table, back = np.full((k + 1, n + 1), np.inf), np.zeros((k + 1, n + 1), int)
    table[0, 0] = 0
    for c in range(1, k + 1):
        for j in range(c, n + 1):
            i = np.arange(c - 1, j)
            total = table[c - 1, i] + cost(i, j)
            back[c, j] = i[np.argmin(total)]
            table[c, j] = total.min()
    labels, j = np.zeros(n, int), n
    for c in range(k, 0, -1):
        i = back[c, j]
        labels[i:j] = c
        j = i
    return labels


def length_clusters(rows: DataFrame, most: int = 20, value: str = "repeat_count", key: tuple[str, ...] = ("file_stem",)) -> DataFrame:
    """``rows`` with repeat_cluster, numbered from the shortest. Samples with one distinct length have one cluster, nulls included; else nulls stay null."""
    names = list(key)
    table = rows.groupBy(*names, F.col(value).cast("double").alias("_x")).agg(F.count("*").alias("_w"))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        known = pdf.dropna(subset=["_x"]).sort_values("_x")
        out = pdf[[*names, "_x"]].copy()
        if len(known) < 2:
            out["repeat_cluster"] = 1
            return out
        x, w = known["_x"].to_numpy(float), known["_w"].to_numpy(float)
        labels = best_split(x, w, mixture_order(x, w, most))
        place = dict(zip(x.tolist(), labels.tolist(), strict=True))
        out["repeat_cluster"] = [place.get(v) for v in out["_x"]]
        out["repeat_cluster"] = out["repeat_cluster"].astype("Int32")
        return out

    kinds = ", ".join(f"{c} {dict(rows.dtypes)[c]}" for c in names)
    found = table.groupBy(*names).applyInPandas(run, f"{kinds}, _x double, repeat_cluster int")
    found = found.toDF(*(f"_{c}" for c in names), "_x", "repeat_cluster")
    cond = F.col(value).cast("double").eqNullSafe(F.col("_x"))
    for c in names:
        cond = cond & F.col(c).eqNullSafe(F.col(f"_{c}"))
    return rows.join(found, cond, "left").drop(*(f"_{c}" for c in names), "_x")


def haplotypes(rows: DataFrame, region: str = "both", trim: str | int | None = "auto") -> DataFrame:
    """``rows`` with haplotype: flanks next to the repeat, cut to equal lengths.

    ``auto`` cuts each flank to the sample's modal length (the least of equals), a number to half of it for each flank, None leaves whole flanks. The left flank keeps
    its end, the right flank its start.
    """
    left, right = F.coalesce(F.col("left"), F.lit("")), F.coalesce(F.col("right"), F.lit(""))
    if trim == "auto":
        for side, text in (("left", left), ("right", right)):
            tally = rows.groupBy("file_stem", F.length(text).alias("_n")).agg(F.count("*").alias("_c"))
            modal = tally.groupBy("file_stem").agg(F.min_by("_n", F.struct((-F.col("_c")).alias("a"), F.col("_n").alias("b"))).alias(f"_{side}"))
            rows = rows.join(modal, "file_stem", "left")
        left, right = F.right(left, F.col("_left")), F.left(right, F.col("_right"))
    elif trim is not None:
        each = -(-int(trim) // 2) if region == "both" else int(trim)
        left, right = F.right(left, F.lit(each)), F.left(right, F.lit(each))
    made = {"left": left, "right": right, "both": F.concat(left, right)}[region]
    return rows.withColumn("haplotype", F.nullif(made, F.lit(""))).drop("_left", "_right")


def one_length(seqs: list[str]) -> bool:
    return len({len(s) for s in seqs}) <= 1


def code_table(seqs: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the sequences' characters, padded with zeros to one width, and their lengths."""
    size = np.array([len(s) for s in seqs], int)
    codes = np.zeros((len(seqs), int(size.max()) if len(seqs) else 0), np.uint32)
    for i, s in enumerate(seqs):
        codes[i, : len(s)] = np.frombuffer(s.encode("utf-32-le"), np.uint32)
    return codes, size


def distances_to(one: str, codes: np.ndarray, size: np.ndarray, method: str) -> np.ndarray:
    """Distances of one sequence to the rows of a code table; ``hamming`` needs equal lengths."""
    said = np.frombuffer(one.encode("utf-32-le"), np.uint32)
    return (codes != said).sum(1) if method == "hamming" else edit_distances(said, codes, size)


def pair_distances(seqs: list[str], method: str = "levenshtein") -> np.ndarray:
    """Distances of all pairs, one sequence against all later ones at a time; sequences of unequal lengths have edit distances."""
    n = len(seqs)
    codes, size = code_table(seqs)
    method = method if one_length(seqs) else "levenshtein"
    out = np.zeros((n, n), np.int32)
    for i in range(n - 1):
        out[i, i + 1 :] = out[i + 1 :, i] = distances_to(seqs[i], codes[i + 1 :], size[i + 1 :], method)
    return out


def edit_distances(one: np.ndarray, many: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Levenshtein distance of one code sequence to many (rows padded to one width).

    A column of the dynamic programme is a bit vector of its upward and downward steps, in words of 64 bits, so that a character of every
    row costs a few machine operations a word.
    """
    m, n = len(one), len(many)
    if not m:
        return np.asarray(sizes, np.int32).copy()
    letters, place = np.unique(one, return_inverse=True)
    words = -(-m // 64)
    bits = np.zeros((len(letters) + 1, words), np.uint64)  # the last row: letters that the sequence doesn't have
    for i, k in enumerate(place.tolist()):
        bits[k, i // 64] |= np.uint64(1) << np.uint64(i % 64)
    at = np.searchsorted(letters, many).clip(0, len(letters) - 1)
    at = np.where(letters[at] == many, at, len(letters))
    up, down = np.full((words, n), ~np.uint64(0)), np.zeros((words, n), np.uint64)
    score, out = np.full(n, m, np.int32), np.full(n, m, np.int32)
    top, last = np.uint64(63), np.uint64((m - 1) % 64)
    unit = np.uint64(1)
    for j in range(int(np.max(sizes, initial=0))):
        here = bits[at[:, j]]
        plus, minus = np.ones(n, np.uint64), np.zeros(n, np.uint64)  # the step along the row above a word
        for w in range(words):
            pv, mv, eq = up[w], down[w], here[:, w]
            xv = eq | mv
            eq = eq | minus
            xh = (((eq & pv) + pv) ^ pv) | eq
            ph, mh = mv | ~(xh | pv), pv & xh
            if w == words - 1:
                score += (ph >> last & unit).astype(np.int32) - (mh >> last & unit).astype(np.int32)
            ph, mh, plus, minus = ph << unit | plus, mh << unit | minus, ph >> top, mh >> top
            up[w], down[w] = mh | ~(xv | ph), ph & xv
        done = sizes == j + 1
        out[done] = score[done]
    return out


def complete_linkage(d: np.ndarray) -> list[tuple[int, int, float]]:
    """Merges (a, b, height) of complete-linkage clustering; a keeps the merged cluster, the lower pair wins ties.

    Each row knows its nearest other row, which is looked for again only where that row went or moved away.
    """
    n = len(d)
    work = d.astype(float)
    np.fill_diagonal(work, np.inf)
    near = work.argmin(1) if n else np.empty(0, int)
    least = work[np.arange(n), near] if n else np.empty(0)
    out = []
    for _ in range(n - 1):
        i = int(np.argmin(least))
        a, b = sorted((i, int(near[i])))
        out.append((a, b, float(work[a, b])))
        joined = np.maximum(work[a], work[b])
        work[a], work[:, a] = joined, joined
        work[b], work[:, b] = np.inf, np.inf
        work[a, a] = np.inf
        least[b] = np.inf
        again = np.flatnonzero(((near == a) | (near == b)) & (least < np.inf))
        for k in {a, *again.tolist()}:
            near[k] = work[k].argmin()
            least[k] = work[k, near[k]]
        least[b] = np.inf
    return out


def cut_tree(merges: list[tuple[int, int, float]], n: int, k: int | None = None, height: float | None = None) -> np.ndarray:
    """Labels from 1 in order of first members, for ``k`` clusters or below a height."""
    parent = np.arange(n)
    for i, (a, b, h) in enumerate(merges):
        if (k is not None and i >= n - k) or (height is not None and h > height):
            break
        parent[parent == parent[b]] = parent[a]
    seen: dict[int, int] = {}
    return np.array([seen.setdefault(p, len(seen) + 1) for p in parent.tolist()])


def silhouette(d: np.ndarray, labels: np.ndarray, w: np.ndarray) -> float:
    """Weighted mean silhouette width; a lone read has width zero."""
    groups = np.unique(labels)
    sums = np.stack([(d * (w * (labels == g))).sum(1) for g in groups], 1)
    mass = np.array([w[labels == g].sum() for g in groups])
    at = np.searchsorted(groups, labels)
    own = mass[at] - 1
    a = sums[np.arange(len(d)), at] / np.maximum(own, 1e-12)
    other = sums / mass
    other[np.arange(len(d)), at] = np.inf
    b = other.min(1)
    top = np.maximum(a, b)
    width = np.where((own > 0) & (top > 0), (b - a) / np.where(top > 0, top, 1), 0.0)
    return float((width * w).sum() / w.sum())


def group_haplotypes(seqs: list[str], weights: list[int], method: str = "levenshtein", downsample: int = 5000) -> list[int]:
    """Cluster numbers of distinct sequences with counts.

    Up to ``downsample`` reads: complete linkage, cut where the mean silhouette is best (2 to 10 clusters, one below three reads). More: linkage of as many of the
    commonest sequences, cut at a fifth of the largest distance; the rest joins the nearest cluster's first sequence.
    """
    w, n = np.array(weights, float), len(seqs)
    reads = int(w.sum())
    if reads < 3 or n == 1:
        return [1] * n
    method = method if one_length(seqs) else "levenshtein"  # for linkage and for the rest alike
    order = sorted(range(n), key=lambda i: (-weights[i], seqs[i]))
    if reads <= downsample:
        d = pair_distances([seqs[i] for i in order], method)
        merges, ww = complete_linkage(d), w[order]
        scored = [(silhouette(d, cut_tree(merges, n, k=k), ww), -k) for k in range(2, min(10, reads - 1, n) + 1)]
        labels = cut_tree(merges, n, k=-max(scored)[1])
    else:
        head = order[:downsample]
        d = pair_distances([seqs[i] for i in head], method)
        some = cut_tree(complete_linkage(d), len(head), height=float(d.max()) * 0.2)
        firsts = [seqs[head[int(np.flatnonzero(some == g)[0])]] for g in range(1, some.max() + 1)]
        labels = np.empty(n, int)
        labels[: len(head)] = some
        if len(head) < n:
            codes, size = code_table([seqs[i] for i in order[len(head) :]])
            labels[len(head) :] = np.stack([distances_to(f, codes, size, method) for f in firsts]).argmin(0) + 1
    out = [0] * n
    for i, label in zip(order, labels.tolist(), strict=True):
        out[i] = label
    return out


def haplotype_clusters(rows: DataFrame, method: str = "levenshtein", downsample: int = 5000, key: tuple[str, ...] = ("file_stem",)) -> DataFrame:
    """``rows`` (with haplotype) with haplotype_cluster; reads without a haplotype have none."""
    names = list(key)
    table = rows.filter("haplotype is not null").groupBy(*names, "haplotype").agg(F.count("*").alias("_w"))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        out = pdf[[*names, "haplotype"]].copy()
        out["haplotype_cluster"] = group_haplotypes(pdf["haplotype"].tolist(), pdf["_w"].tolist(), method, downsample)
        return out

    kinds = ", ".join(f"{c} {dict(rows.dtypes)[c]}" for c in names)
    found = table.groupBy(*names).applyInPandas(run, f"{kinds}, haplotype string, haplotype_cluster int")
    found = found.toDF(*(f"_{c}" for c in names), "_haplotype", "haplotype_cluster")
    cond = F.col("haplotype") == F.col("_haplotype")
    for c in names:
        cond = cond & F.col(c).eqNullSafe(F.col(f"_{c}"))
    return rows.join(found, cond, "left").drop(*(f"_{c}" for c in names), "_haplotype")


def assign_clusters(rows: DataFrame, cluster_by: str | tuple[str, ...] | None = "repeat", repeat_max: int = 20, method: str = "levenshtein", downsample: int = 5000, region: str = "both", trim: str | int | None = "auto") -> DataFrame:
    """cluster_number (and the labels repeat_cluster ``R1``, haplotype_cluster ``H1``) by one or two criteria, or one cluster for all.

    With two, the second is applied inside each cluster of the first; numbers follow the first, then the second.
    """
    steps = [] if cluster_by in (None, "none") else [cluster_by] if isinstance(cluster_by, str) else list(cluster_by)
    key: tuple[str, ...] = ("file_stem",)
    for step in steps:
        if step in ("repeat", "repeat_length"):
            rows = length_clusters(rows, repeat_max, key=key)
            key = (*key, "repeat_cluster")
        elif step == "haplotype":
            rows = haplotype_clusters(haplotypes(rows, region, trim), method, downsample, key=key)
            key = (*key, "haplotype_cluster")
        else:
            raise ValueError(f"unknown way to cluster: {step}")
    if not steps:
        number = F.lit(1)
    else:
        known = F.lit(True)
        for c in key[1:]:
            known = known & F.col(c).isNotNull()
        number = F.when(known, F.dense_rank().over(Window.partitionBy("file_stem").orderBy(*(F.col(c).asc_nulls_last() for c in key[1:]))))
    labels = {c: F.concat(F.lit(m), F.col(c).cast("string")) if c in key else F.lit(None).cast("string") for c, m in (("repeat_cluster", "R"), ("haplotype_cluster", "H"))}
    return rows.withColumns({"cluster_number": number.cast("int")} | labels)


def relabelled_by_mean(rows: DataFrame, value: str = "repeat_count") -> DataFrame:
    """(file_stem, cluster_number, relabelled): clusters of each sample numbered from the lowest mean; the lower number wins ties."""
    means = rows.groupBy("file_stem", "cluster_number").agg(F.avg(value).alias("_mean"))
    return means.select("file_stem", "cluster_number", F.row_number().over(Window.partitionBy("file_stem").orderBy("_mean", "cluster_number")).alias("relabelled"))


def renumber_map(rows: DataFrame) -> DataFrame:
    """(file_stem, cluster_number_old, cluster_number, n_reads, proportion): clusters numbered from the largest; the lower number wins ties."""
    tally = rows.groupBy("file_stem", F.col("cluster_number").alias("cluster_number_old")).agg(F.count("*").alias("n_reads"))
    order = Window.partitionBy("file_stem").orderBy(F.desc("n_reads"), F.col("cluster_number_old").asc_nulls_last())
    return tally.withColumns({"cluster_number": F.row_number().over(order), "proportion": F.col("n_reads") / F.sum("n_reads").over(Window.partitionBy("file_stem"))})


def renumber(rows: DataFrame) -> DataFrame:
    """``rows`` with clusters numbered by size; a null cluster is a cluster too."""
    names = renumber_map(rows).select(F.col("file_stem").alias("_stem"), "cluster_number_old", F.col("cluster_number").alias("_new"))
    joined = rows.join(names, F.col("file_stem").eqNullSafe(F.col("_stem")) & F.col("cluster_number").eqNullSafe(F.col("cluster_number_old")))
    return joined.withColumn("cluster_number", F.col("_new")).drop("_stem", "cluster_number_old", "_new")


def cluster_summary(rows: DataFrame, value: str = "repeat_count") -> DataFrame:
    """Reads, mode (least of equals), centre and spread of the counts of each cluster."""
    x: Column = F.col(value)
    key = ("file_stem", "cluster_number")
    mode = rows.filter(x.isNotNull()).groupBy(*key, x.alias("x")).agg(F.count("*").alias("c")).groupBy(*key).agg(F.min_by("x", F.struct((-F.col("c")).alias("a"), F.col("x").alias("b"))).alias("mode"))
    q = F.percentile(x, F.array(F.lit(0.25), F.lit(0.75)))
    out = rows.groupBy(*key).agg(F.count("*").alias("n_reads"), F.median(x).alias("median"), F.avg(x).alias("mean"), F.stddev_samp(x).alias("sd"), F.min(x).alias("min"), F.max(x).alias("max"), (F.get(q, F.lit(1)) - F.get(q, F.lit(0))).alias("iqr"))
    mode = mode.toDF("_stem", "_cluster", "mode")
    both = F.col("file_stem").eqNullSafe(F.col("_stem")) & F.col("cluster_number").eqNullSafe(F.col("_cluster"))
    return out.join(mode, both, "left").drop("_stem", "_cluster")


def clusters_per_sample(rows: DataFrame) -> DataFrame:
    return rows.groupBy("file_stem").agg(F.count_distinct("cluster_number").alias("n_clusters"))
