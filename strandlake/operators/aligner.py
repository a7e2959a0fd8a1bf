"""Flank alignment: each read against both flanks, both strands, by seeded semi-global alignment in numpy."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

ALIGNED = (
    "file_stem string, qname string, rname string, ref_id string, ref_flank string, strand string, ref_start int, ref_end int, alignment_length_on_ref int, "
    "query_start int, query_end int, alignment_length_on_query int, mapq int, mismatches int, insertions int, deletions int, query_sequence string, aligned_subsequence string, cigar string"
)
_TURN = str.maketrans("ACGTUNacgtun", "TGCAANtgcaan")


CELLS = 1 << 23  # of dynamic programmes that are held at a time


def local_alignments(queries: list[str], ref: str, match: int = 2, mismatch: int = -4, gap: int = -4) -> list[tuple[int, int, int, int, int, str] | None]:
    """(score, query start, query end, ref start, ref end, moves) of each query's best local alignment, 0-based and half open; moves are M, I, D.

    Queries of like length go through one programme together, a row of all of them at a time; shorter ones are padded by a letter that matches nothing.
    """
    out: list[tuple[int, int, int, int, int, str] | None] = [None] * len(queries)
    m = len(ref)
    if not m:
        return out
    r = np.frombuffer(ref.upper().encode("latin-1", "replace"), np.uint8)
    order = sorted((i for i, q in enumerate(queries) if q), key=lambda i: len(queries[i]))
    kind = np.int16 if match * m < 1 << 14 and -gap * m < 1 << 14 else np.int32
    steps = (np.arange(m + 1) * -gap).astype(kind)
    while order:
        n = len(queries[order[-1]])
        part = order[-max(1, CELLS // ((n + 1) * (m + 1))) :]
        del order[-len(part) :]
        q = np.zeros((len(part), n), np.uint8)
        for k, i in enumerate(part):
            q[k, : len(queries[i])] = np.frombuffer(queries[i].upper().encode("latin-1", "replace"), np.uint8)
        table = np.zeros((n + 1, len(part), m + 1), kind)
        for i in range(1, n + 1):
            row = np.zeros((len(part), m + 1), kind)
            np.maximum(table[i - 1, :, :-1] + np.where(q[:, i - 1, None] == r, match, mismatch).astype(kind), table[i - 1, :, 1:] + gap, out=row[:, 1:])
            np.maximum(row, 0, out=row)
            np.maximum(np.maximum.accumulate(row + steps, axis=1) - steps, 0, out=table[i])
        for k, i in enumerate(part):
            out[i] = _trace(table[:, k], q[k], r, match, mismatch, gap)
    return out


def _trace(table: np.ndarray, q: np.ndarray, r: np.ndarray, match: int, mismatch: int, gap: int) -> tuple[int, int, int, int, int, str] | None:
    """The alignment that ends in the first of a programme's best cells; the diagonal wins ties, then a gap in the reference."""
    i, j = divmod(int(table.argmax()), table.shape[1])
    score, end_q, end_r, moves = int(table[i, j]), i, j, []
    while i and j and table[i, j] > 0:
        here = int(table[i, j])
        if here == int(table[i - 1, j - 1]) + (match if q[i - 1] == r[j - 1] else mismatch):
            moves.append("M")
            i, j = i - 1, j - 1
        elif here == int(table[i - 1, j]) + gap:
            moves.append("I")
            i -= 1
        else:
            moves.append("D")
            j -= 1
    return (score, i, end_q, j, end_r, "".join(reversed(moves))) if score else None


def local_alignment(query: str, ref: str, **scores: int) -> tuple[int, int, int, int, int, str] | None:
    """The best local alignment of one query."""
    return local_alignments([query], ref, **scores)[0]


def seeds(ref: str, k: int) -> dict[str, list[int]]:
    index: dict[str, list[int]] = defaultdict(list)
    for i in range(len(ref) - k + 1):
        index[ref[i : i + k].upper()].append(i)
    return index


def window(read: str, index: dict[str, list[int]], size: int, k: int) -> tuple[int, int, int] | None:
    """(start, end, seed hits) of the part of a read around the diagonal band with most seeds."""
    hits: dict[int, int] = defaultdict(int)
    upper = read.upper()
    for i in range(len(read) - k + 1):
        for j in index.get(upper[i : i + k], ()):
            hits[(i - j) // 32] += 1
    if not hits:
        return None
    band = max(hits, key=lambda b: (hits[b] + hits.get(b + 1, 0), -b))
    start = band * 32
    pad = max(32, size // 10)
    return max(0, start - pad), min(len(read), start + size + 64 + pad), hits[band] + hits.get(band + 1, 0)


def cigar_of(moves: str, before: int, behind: int) -> str:
    out, run, kind = [f"{before}S"] if before else [], 0, ""
    for m in [*moves, ""]:
        if m == kind:
            run += 1
            continue
        if run:
            out.append(f"{run}{kind}")
        run, kind = 1, m
    return "".join([*out, *([f"{behind}S"] if behind else [])])


def align_reads(batch: list[str], flanks: list[tuple], indexes: list[dict], k: int, least: float) -> list[list[tuple]]:
    """The best alignment of each read on each flank: both strands tried where seeds are found; null flanks are left out.

    A flank that stands in a read as it is needs no dynamic programme; the others of all reads share one. mapq is 60 times the share by which the better
    strand's score beats the other's, as far as the score reaches its best possible.
    """
    out: list[list[tuple]] = [[] for _ in batch]
    strands = [{"+": read, "-": read.translate(_TURN)[::-1]} for read in batch]
    for flank, index in zip(flanks, indexes, strict=True):
        ref = flank[3]
        found: list[list[tuple]] = [[] for _ in batch]
        near: list[tuple[int, str, str, tuple[int, int, int]]] = []
        for at, both in enumerate(strands):
            for strand, text in both.items():
                exact = text.upper().find(ref.upper())
                if exact >= 0:
                    found[at].append((2 * len(ref), strand, exact, (2 * len(ref), 0, len(ref), 0, len(ref), "M" * len(ref)), text))
                elif (span := window(text, index, len(ref), k)) is not None:
                    near.append((at, strand, text, span))
        for (at, strand, text, span), got in zip(near, local_alignments([t[a:b] for _, _, t, (a, b, _) in near], ref), strict=True):
            if got and got[0] >= least:
                found[at].append((got[0], strand, span[0], got, text))
        for at, read in enumerate(batch):
            if found[at]:
                out[at].append(_row(read, flank, sorted(found[at], key=lambda f: (-f[0], f[1]))))
    return out


def _row(read: str, flank: tuple, found: list[tuple]) -> tuple:
    """The alignment columns behind the read's name, from the hits on one flank, the best first."""
    rname, ref_id, ref_flank, ref = flank
    score, strand, at, (_, qs, qe, rs, re_, moves), text = found[0]
    second = found[1][0] if len(found) > 1 else 0
    mapq = int(round(60 * (1 - second / score)))
    qs, qe = qs + at, qe + at
    i, j, wrong = qs, rs, 0
    for m in moves:
        if m == "M":
            wrong += text[i].upper() != ref[j].upper()
        i, j = i + (m != "D"), j + (m != "I")
    gaps_in, gaps_out = moves.count("I"), moves.count("D")
    return (rname, ref_id, ref_flank, strand, rs + 1, re_, re_ - rs, qs + 1, qe, qe - qs, mapq, wrong + gaps_in + gaps_out, gaps_in, gaps_out, read, text[qs:qe], cigar_of(moves, qs, len(text) - qe))


def align(reads: DataFrame, refs: list[tuple[str, str, str, str]], k: int = 11, least: float = 40) -> DataFrame:
    """ALIGNED rows of reads (file_stem, qname, sequence) against flanks (rname, ref_id, ref_flank, sequence).

    Query coordinates of reverse hits are those of the turned read, as an aligner reports them. Reads that hit nothing give no row.
    """

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        size = min(k, max(4, min(len(r[3]) for r in refs) // 2))
        indexes = [seeds(r[3], size) for r in refs]
        names = [c.split()[0] for c in ALIGNED.split(", ")]
        for pdf in parts:
            named = [(f, q, s) for f, q, s in pdf.itertuples(index=False) if s]
            hits = align_reads([s for _, _, s in named], refs, indexes, size, least)
            rows = [(f, q, *hit) for (f, q, _), found in zip(named, hits, strict=True) for hit in found]
            yield pd.DataFrame(rows, columns=names)

    return reads.select("file_stem", "qname", "sequence").mapInPandas(run, ALIGNED)
