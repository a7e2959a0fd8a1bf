"""Best-fit packing of tokenised documents by bin completion.

Sequences are planned from the histogram of piece lengths, which has ``size`` entries at most whatever the corpus holds; pieces then find their
place by their rank among those of their length, so no task and no driver ever sees all documents.

Cases: null text = empty text = one piece of length 1 (the end id); repeated rows are documents of their own; a null doc_id is carried along;
equal lengths are ranked by doc_id and piece; a text is tokenised whole, one document at a time; an empty table gives no row.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common

SIZE = 2048
END_ID = 0
SALTS = 64
STEPS = 3_000_000
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PLACED = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"

# Fixed value: the splitting pattern of byte-level BPE vocabularies of this family.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _alphabet() -> dict[str, int]:
    """Character -> byte of the byte-level alphabet: printable bytes stand for themselves, the rest follow from 256 on."""
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(kept)]
    return {chr(b): b for b in kept} | {chr(256 + i): b for i, b in enumerate(rest)}


@lru_cache(maxsize=4)
def encoder(path: str):
    """text -> ids of a tokenizers JSON file, as ``encode(text, add_special_tokens=False)`` gives them.

    A byte-level BPE file whose ids follow its merges is run by tiktoken, which gives the same ids in a quarter of the time, the text cut at the
    file's added tokens first; any other file by tokenizers itself.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, pre, added = spec["model"], spec.get("pre_tokenizer") or {}, spec.get("added_tokens") or []
    plain = model.get("type") == "BPE" and pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and not spec.get("normalizer") and not model.get("unk_token")
    if plain and not any(x.get("lstrip") or x.get("rstrip") or x.get("single_word") for x in added):
        alphabet, special = _alphabet(), {x["content"]: x["id"] for x in added}
        vocab = {k: v for k, v in model["vocab"].items() if k not in special}
        merges = ["".join(m.split(" ")) if isinstance(m, str) else "".join(m) for m in model["merges"]]
        ids = [vocab[m] for m in merges if m in vocab]
        if ids == sorted(ids) and len(vocab) == 256 + len(ids):
            import tiktoken

            ranks = {bytes(alphabet[c] for c in token): i for token, i in vocab.items()}
            ordinary = tiktoken.Encoding("from-json", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
            # The longest of those that begin at a place counts, as in tokenizers.
            marks = re.compile("(" + "|".join(re.escape(x) for x in sorted(special, key=len, reverse=True)) + ")") if special else None

            def encode(text: str) -> list[int]:
                if not marks or not any(x in text for x in special):
                    return ordinary(text)
                return [i for part in marks.split(text) if part for i in ([special[part]] if part in special else ordinary(part))]

            return encode
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    return lambda text: tok.encode(text, add_special_tokens=False).ids


def cut(n: int, size: int = SIZE) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: only the first may be shorter than ``size``."""
    first = n % size or min(n, size)
    return [(0, first)] + [(at, size) for at in range(first, n, size)]


def tokenised(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE, end_id: int = END_ID) -> DataFrame:
    """PIECES of every document: its ids, then the end id, cut where longer than ``size``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
        for batch in common.slices(batches, 1, 500):
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = np.array([*encode(text or ""), end_id], "<u4")
                rows += [(doc_id, k, at, n, zlib.crc32(ids[at : at + n])) for k, (at, n) in enumerate(cut(len(ids), size))]
            found = zip(*rows, strict=True) if rows else [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(found, kinds, strict=True)], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(run, PIECES)


def best_fit(counts: dict[int, int], size: int) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit decreasing on a histogram: (lengths of a bin, number of such bins).

    All pieces of a length are placed at once: a tightest bin takes as many as fit before the next one is looked at.
    """
    rooms: dict[int, list[list]] = {}  # free room -> [lengths, bins]
    order: list[int] = []

    def put(room: int, lengths: tuple[int, ...], bins: int) -> None:
        if bins:
            if room not in rooms:
                insort(order, room)
                rooms[room] = []
            rooms[room].append([lengths, bins])

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            i = bisect_left(order, length)
            if i == len(order):
                each = size // length
                put(size - each * length, (length,) * each, left // each)
                put(size - left % each * length, (length,) * (left % each), int(left % each > 0))
                break
            room = order[i]
            lengths, bins = rooms[room].pop()
            if not rooms[room]:
                del rooms[room]
                order.pop(i)
            each = room // length
            full = min(bins, left // each)
            put(room - each * length, lengths + (length,) * each, full)
            left -= full * each
            bins -= full
            if bins and left:
                put(room - left * length, lengths + (length,) * left, 1)
                bins, left = bins - 1, 0
            put(room, lengths, bins)
    return [(tuple(lengths), bins) for groups in rooms.values() for lengths, bins in groups]


def least_bins(counts: dict[int, int], size: int) -> int:
    """A lower bound: for each threshold t, pieces over size - t stand alone, those over half have a bin each, and what is at least t must fit beside those."""
    n = np.zeros(size + 2, np.int64)
    for k, c in counts.items():
        n[k] = c
    volume, pieces = np.cumsum(n * np.arange(size + 2)), np.cumsum(n)
    half = size // 2
    t = np.arange(half + 1)
    alone = pieces[-1] - pieces[size - t]
    middle_n, middle = pieces[size - t] - pieces[half], volume[size - t] - volume[half]
    small = volume[half] - np.where(t > 0, volume[np.maximum(t - 1, 0)], 0)
    need = np.maximum(0, -(-(small - (middle_n * size - middle)) // size))
    return int(max((alone + middle_n + need).max(), -(-volume[-1] // size)))


class _Work:
    """Elementary steps that a search may still take; its answer depends on them, never on the clock."""

    def __init__(self, steps: int):
        self.left = steps

    def spent(self, steps: int) -> bool:
        self.left -= steps
        return self.left < 0


def _copies(sums: int, length: int, count: int, mask: int) -> int:
    """A bit set of sums (bit s: the sum s) with up to ``count`` more pieces of a length."""
    step = 1
    while count:
        take = min(step, count)
        sums |= sums << take * length & mask
        count -= take
        step *= 2
    return sums


def dominated(filling: tuple[int, ...], spare: int, room: int) -> bool:
    """Whether a spare piece (bit set of lengths beyond those of the filling) could take the place of some of the filling's pieces.

    It can where they are together no longer than it and it fits; a single piece of its own length doesn't count.
    """
    free = room - sum(filling)
    one, more = 0, 0  # sums of single pieces, and of two or more
    for x in filling:
        more |= (one | more) << x
        one |= 1 << x
    longer, done = ((1 | one | more) << 1, 1) if free else (0, 0)  # lengths one above a sum (no piece at all: 0), widened to ``free`` above it
    while done < free:
        step = min(done, free - done)
        longer |= longer << step
        done += step
    return bool((more | longer) & spare)


def fillings(lengths: list[int], counts: dict[int, int], room: int, work: _Work) -> Iterator[tuple[int, ...]]:
    """All undominated fillings of ``room``, least waste first, made one by one.

    ``lengths`` are those left that fit, longest first. A piece of the room's length dominates all else. Pairs that fill the room are looked up; then bit
    sets of the sums that the lengths from some place on can make lead straight to the fillings of each sum, so no step is lost on sums that can't be reached.
    """
    if counts.get(room):
        yield (room,)
        return
    pairs = set()
    for x in lengths:
        if 2 * x < room:
            break
        if counts.get(room - x, 0) > (2 * x == room):
            pairs.add((x, room - x))
            yield x, room - x
    if work.spent(1 + len(lengths) // 16):
        return
    mask = (1 << room + 1) - 1
    reach = [1]
    for x in reversed(lengths):
        reach.append(_copies(reach[-1], x, min(counts[x], room // x), mask))
    if work.spent(2 * len(lengths) + 1):
        return
    reach.reverse()  # reach[i]: sums by lengths[i:]

    def exact(total: int) -> Iterator[tuple[int, ...]]:
        stack = [(0, total, ())]
        while stack:
            i, rest, held = stack.pop()
            if work.spent(1):
                return
            if not rest:
                yield held
                continue
            while i < len(lengths) and lengths[i] > rest:
                i += 1
            if i == len(lengths):
                continue
            x = lengths[i]
            for k in range(min(counts[x], rest // x) + 1):  # the most copies lie on top of the stack
                if reach[i + 1] >> rest - k * x & 1:
                    stack.append((i + 1, rest - k * x, held + (x,) * k))

    sums = reach[0]
    while sums:
        total = sums.bit_length() - 1
        sums ^= 1 << total
        for filling in exact(total):
            used = Counter(filling)
            spare = sum(1 << x for x in lengths if counts[x] > used[x])
            if work.spent(1 + len(lengths) // 16):
                return
            if filling not in pairs and not dominated(filling, spare, room):
                yield filling
        if work.left < 0:
            return


def bin_completion(counts: dict[int, int], size: int = SIZE, steps: int = STEPS) -> list[tuple[tuple[int, ...], int]]:
    """Few bins for a histogram of lengths: bins as (lengths, number of such bins).

    Best-fit gives the first incumbent. While it lies above the lower bound, the largest piece left is completed by each of its undominated fillings, as
    often as counts allow and then once; a branch ends where its waste leaves no room to beat the incumbent, or where the lower bound of what is left
    does. Best-fit on what a branch leaves may improve the incumbent, which stands after ``steps`` elementary steps: the limit bounds the search, never
    the pieces, and holds at every size alike.
    """
    left = {k: n for k, n in sorted(counts.items(), reverse=True) if n}
    if not left:
        return []
    best = best_fit(left, size)
    best_n, bound = sum(n for _, n in best), least_bins(left, size)
    total = sum(k * n for k, n in left.items())
    order = list(left)  # longest first
    work = _Work(steps)
    used = wasted = seen = 0
    done: list[tuple[tuple[int, ...], int]] = []

    def options(last: tuple[int, ...] | None) -> Iterator[tuple[tuple[int, ...], int]]:
        """Bins around the largest piece; of bins with the same largest piece, those behind the last one (orders of equal bins are one solution)."""
        top = next(x for x in order if left[x])
        left[top] -= 1
        fit = [x for x in order if left[x] and x <= size - top]
        held = {x: left[x] for x in fit}
        left[top] += 1
        place = (lambda b: (-sum(b), [-x for x in b])) if last and last[0] == top else None
        for filling in fillings(fit, held, size - top, work):
            made = (top, *filling)
            if place and place(made) < place(last):
                continue
            need = Counter(made)
            most = min(left[x] // n for x, n in need.items())
            for times in dict.fromkeys((most, 1)):
                yield made, times

    def move(lengths: tuple[int, ...], times: int) -> None:
        nonlocal used, wasted
        for x in lengths:
            left[x] -= times
        used += times
        wasted += times * (size - sum(lengths))

    stack: list[list] = [[options(None), None]]
    while stack and best_n > bound and work.left > 0:
        frame = stack[-1]
        if frame[1]:
            move(frame[1][0], -frame[1][1])
            done.pop()
        frame[1] = next(frame[0], None)
        if not frame[1]:
            stack.pop()
            continue
        seen += 1
        move(*frame[1])
        done.append(frame[1])
        if wasted > (best_n - 1) * size - total:
            continue
        rest = {x: n for x, n in left.items() if n}
        work.spent(1 + len(order) // 16)
        if not rest:
            best, best_n = list(done), used
            continue
        if seen % 64 == 0 or len(rest) <= 64:
            work.spent(8 * len(rest))
            more = best_fit(rest, size)
            if used + sum(n for _, n in more) < best_n:
                best, best_n = done + more, used + sum(n for _, n in more)
            work.spent(50)
            if used + least_bins(rest, size) >= best_n:
                continue
        stack.append([options(frame[1][0]), None])
    return best


class Plan:
    """Where the pieces of each length go: runs of equal bins, found by a piece's rank among its length."""

    def __init__(self, bins: list[tuple[tuple[int, ...], int]]):
        runs: dict[int, list[tuple[int, int, int, int]]] = {}  # length -> (first rank, first sequence, pieces in a bin, offset)
        ranks: Counter = Counter()
        sequence = 0
        for lengths, times in bins:
            offset = 0
            for length, each in sorted(Counter(lengths).items(), reverse=True):
                runs.setdefault(length, []).append((ranks[length], sequence, each, offset))
                ranks[length] += each * times
                offset += each * length
            sequence += times
        self.runs = {k: np.array(v, np.int64) for k, v in runs.items()}
        self.sequences = sequence

    def place(self, lengths: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sequence, offset = np.empty_like(ranks), np.empty_like(ranks)
        for length in np.unique(lengths).tolist():
            at = np.flatnonzero(lengths == length)
            runs = self.runs[length]
            run = runs[np.searchsorted(runs[:, 0], ranks[at], side="right") - 1]
            inner = ranks[at] - run[:, 0]
            sequence[at] = run[:, 1] + inner // run[:, 2]
            offset[at] = run[:, 3] + inner % run[:, 2] * length
        return sequence, offset


def pack(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE, end_id: int = END_ID, salts: int = SALTS, steps: int = STEPS) -> DataFrame:
    """PLACED: every piece with its sequence and its offset there.

    Pieces of full size are sequences of their own, numbered behind the planned ones without any shuffle; the others are ranked among
    their length, ``salts`` ways for each, and placed by the plan.
    """
    pieces = common.staged(tokenised(docs, path or default_tokenizer(), id_col, text_col, size, end_id), "pieces")
    salted = pieces.filter(F.col("length") < size).withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(salts)).cast("int"))
    tally = {(r["length"], r["salt"]): r["n"] for r in salted.groupBy("length", "salt").agg(F.count("*").alias("n")).collect()}  # size * salts rows at most
    counts: Counter = Counter()
    first = np.zeros((size + 1, salts), np.int64)
    for (length, salt), n in sorted(tally.items()):
        first[length, salt] = counts[length]
        counts[length] += n
    plan = Plan(bin_completion(dict(counts), size, steps))
    ranked = salted.withColumn("rank", F.row_number().over(Window.partitionBy("length", "salt").orderBy("doc_id", "piece")) - 1)
    alone = pieces.filter(F.col("length") == size).select("*", (F.monotonically_increasing_id() + plan.sequences).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            length, salt, rank = (b.column(i).to_numpy(zero_copy_only=False) for i in (3, 5, 6))
            sequence, offset = plan.place(length, first[length, salt] + rank)
            yield pa.RecordBatch.from_arrays([*b.columns[:5], pa.array(sequence), pa.array(offset)], names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    placed = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "salt", F.col("rank").cast("long")).mapInArrow(place, PLACED)
    return placed.unionAll(alone)
