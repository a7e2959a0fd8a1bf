"""SimHash components and benchmark decontamination against brute force."""

import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from strandlake.llm import components, decontam, simhash
from strandlake.llm.queries import op2_simhash_components, op3_decontamination

from ..conftest import DATA

SF = f"{DATA}/sf0.001"


def plain_fingerprint(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())
    words = [bytes(b + 32 if 65 <= b <= 90 else b for b in w) for w in words]
    if not words:
        return 0
    grams = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(ids, fps, differ=4):
    parent = {i: i for i in range(len(ids))}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= differ:
                parent[root(i)] = root(j)
    least = {}
    for i, d in enumerate(ids):
        least[root(i)] = min(least.get(root(i), d), d)
    return {d: least[root(i)] for i, d in enumerate(ids)}


@pytest.mark.parametrize("text", [None, "", " \n\t", "One", "a b c", "Ä Ö ü ẞ x", "a b c d e f a b c d", "x\x0by\x1cz"])
def test_fingerprint(text):
    assert simhash.fingerprint(text) == plain_fingerprint(text)
    assert simhash.fingerprint((text or "") * 50, chunk=7) == plain_fingerprint((text or "") * 50)


def test_query_matches_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    fps = [plain_fingerprint(r.text) for r in docs]
    want = plain_components([r.doc_id for r in docs], fps)
    got = op2_simhash_components(spark, SF).collect()
    assert {r.doc_id: r.component_id for r in got} == want
    assert {r.doc_id: r.fingerprint for r in got} == {r.doc_id: f"{f:016x}" for r, f in zip(docs, fps, strict=True)}
    assert len(set(want.values())) < len(want)


def linked(spark, fps, block, differ=4):
    df = spark.createDataFrame([(int(np.uint64(f).astype(np.int64)),) for f in set(fps)], "fp long")
    edges = [(int(np.uint64(r.a % (1 << 64))), int(np.uint64(r.b % (1 << 64)))) for r in simhash.links(df, differ, block).collect()]
    assert all(bin(a ^ b).count("1") <= differ for a, b in edges)
    parent = {f: f for f in fps}

    def root(f):
        while parent[f] != f:
            f = parent[f]
        return f

    for a, b in edges:
        parent[root(a)] = root(b)
    return {frozenset(f for f in fps if root(f) == root(g)) for g in fps}


@pytest.mark.parametrize("block", [4096, 6, 3])
def test_links_lose_nothing(spark, block):
    rng = random.Random(4)
    base = [rng.getrandbits(64) for _ in range(60)]
    fps = set(base)
    for b in base[:20]:
        for _ in range(6):
            x = b
            for bit in rng.sample(range(64), rng.randint(1, 6)):
                x ^= 1 << bit
            fps.add(x)
    fps |= {0, 1, (1 << 64) - 1, (1 << 63)}
    fps = sorted(fps)
    want = plain_components(fps, fps)
    groups = {frozenset(f for f in fps if want[f] == want[g]) for g in fps}
    assert linked(spark, fps, block) == groups


@pytest.mark.parametrize("differ", [2, 3, 4])
def test_large_group_of_near_copies(spark, differ):
    rng = random.Random(9)
    centre = rng.getrandbits(64)
    fps = {centre} | {rng.getrandbits(64) for _ in range(100)}
    while len(fps) < 500:
        x = centre
        for bit in rng.sample(range(64), rng.randint(1, 9)):
            x ^= 1 << bit
        fps.add(x)
    fps = sorted(fps)
    want = plain_components(fps, fps, differ)
    assert linked(spark, fps, 40, differ) == {frozenset(f for f in fps if want[f] == want[g]) for g in fps}


def test_segments_leave_one_bit_at_most():
    for differ in range(7):
        parts = simhash.segments(differ)
        assert sum(w for _, w in parts) == 64
        assert differ // len(parts) <= 1
    assert len(simhash.segments(4)) == 3


def test_simhash_cases(spark):
    rows = [(5, None), (3, ""), (9, "a b"), (9, "a b"), (2, "A B"), (None, "a b"), (7, "quite another text altogether here")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"fp": F.lit(1), "root": F.lit(2), "component_id": F.lit(3)})
    got = sorted(((r.doc_id, r.component_id) for r in simhash.near_duplicates(df).collect()), key=repr)
    assert got == sorted([(5, 3), (3, 3), (9, 2), (9, 2), (2, 2), (None, 2), (7, 7)], key=repr)
    kept = simhash.keep_first(df)
    assert kept.columns == df.columns
    assert sorted((r.doc_id for r in kept.collect() if r.doc_id is not None)) == [2, 3, 7]
    assert simhash.near_duplicates(df.limit(0)).count() == 0


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 30)] + [(200, 200), (301, 300), (300, 301)]
    df = spark.createDataFrame([*edges, (None, 7), (8, None), (0, 1)], "a long, b long").withColumns({"node": F.lit("x"), "low": F.lit(1)})
    got = {r.node: r.root for r in components.components(df).collect()}
    assert components.components(df.limit(0)).count() == 0
    assert got == {i: 0 for i in range(61)} | {100 + i: 100 for i in range(30)} | {300: 300, 301: 300}


def canonical(text):
    t = re.sub(r" *[^\w.,!?\n ][^\w.,!?\n]*|  +", " ", (text or "").replace("_", "-"))
    t = re.sub(r"\d+(?:[.,]\d+)*", lambda m: f"#num={m[0]} ", t)
    units = "|".join(sorted(decontam.UNITS, key=lambda u: (-len(u), u)))
    t = re.sub(rf"(?i)(#num=\S+ +)({units})(?![^\W\d_])", r"\1#unit=\2", t)
    caps = "".join(c for c in map(chr, range(0x250)) if c.isupper())
    low = "".join(c for c in map(chr, range(0x250)) if c.islower())
    t = re.sub(rf"(?<=[\w,] )([{caps}][{low}]+)(?![{caps}])", r"#name=\1", t)
    t = re.sub(r"(?:[!?\s]|[.,](?!\d))+", " ", t)
    return [w for w in t.lower().split(" ") if w]


def plain_leaks(docs, items, width=5, literal=3, cover=0.8):
    def wins(words):
        kinds = [w.split("=")[0] if w.startswith("#") else w for w in words]
        for i in range(max(len(words) - width, 0) + 1):
            part = kinds[i : i + width]
            if part and sum(not w.startswith("#") for w in part) >= min(literal, len(words)):
                yield i, tuple(part)

    out = {}
    for item, text in items:
        theirs = canonical(text)
        mine = list(wins(theirs))
        for doc, body in docs:
            ours = canonical(body)
            by = {}
            for i, w in wins(ours):
                for j, v in mine:
                    if w == v:
                        by.setdefault(i - j, []).append((i, j))
            places = set()
            for hits in by.values():
                pairs = {(theirs[j + k], ours[i + k]) for i, j in hits for k in range(width) if j + k < len(theirs) and theirs[j + k].startswith("#")}
                if len({a for a, _ in pairs}) == len(pairs) == len({b for _, b in pairs}):
                    places |= {j for _, j in hits}
            if mine and len(places) / len(mine) >= cover:
                out[doc, item] = (len(mine), len(places))
    return out


QUESTION = "A farmer named Tom has 12 kg of apples and gives 5 kg to Anna before Tom sells the other 7 kg at the market."


def test_reparameterised_questions(spark):
    docs = [
        (1, "Intro words. " + QUESTION + " And then some more."),
        (2, "Intro words. A farmer named Joe has 31 kg of apples and gives 9 kg to Mary before Joe sells the other 22 kg at the market."),
        (3, "A farmer named Joe has 31 kg of apples and gives 9 kg to Mary before Bill sells the other 22 kg at the market."),
        (4, "A farmer has some pears and sells them. Numbers like 12 kg and 5 kg occur here and there, Tom and Anna too."),
        (5, None), (6, ""), (None, QUESTION.upper().replace("TOM", "Tom").replace("ANNA", "Anna")), (7, "word " * 5000 + QUESTION),
    ]
    bench = spark.createDataFrame([(10, QUESTION), (11, None), (12, "")], "item_id long, text string")
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumns({"id": F.lit(0), "hash": F.lit(0), "item_id": F.lit(0), "pos": F.lit("x")})
    got = {(r.doc_id, r.item_id) for r in decontam.leaks(df, bench).collect()}
    assert got == {(1, 10), (2, 10), (7, 10), (None, 10)}
    assert sorted(r.doc_id for r in decontam.keep_uncontaminated(df, bench).collect()) == [3, 4, 5, 6]
    assert decontam.leaks(df.limit(0), bench).count() == 0
    assert decontam.leaks(df, bench.limit(0)).count() == 0


def test_decontamination_matches_brute_force(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    rng = random.Random(2)
    found = {(r.doc_id, r.item_id): (r.n_windows, r.n_matched) for r in op3_decontamination(spark, SF).collect()}
    some = [d for d in docs if any(d[0] == k for k, _ in found)] + rng.sample(docs, 60)
    want = plain_leaks(some, items)
    assert {k: v for k, v in found.items() if k[0] in {d for d, _ in some}} == want
    assert found


def test_items_without_template_windows_leak_verbatim(spark):
    items = [(1, "What is 12 + 35 * 4 - 7?"), (2, "1, 4, 9, 16, 25, 36, what next?"), (3, "Alice, Bob, Carla, Dora: 12, 15, 18, 21.")]
    docs = [(i, f"Some words before. {text} Some words after.") for i, text in items]
    docs += [(14, "Some words before. What is 13 + 36 * 5 - 8? Some words after."), (15, "2, 5, 10, 17, 26, 37, what next?"), (16, "Dave, Eve, Frank, Gina: 1, 2, 3, 4."), (17, ""), (18, None)]
    bench = spark.createDataFrame([*items, (4, ""), (5, None)], "item_id long, text string")
    df = spark.createDataFrame(docs, "doc_id long, text string")
    # The third item says nothing but four names and four numbers, so only its own values prove it.
    assert {(r.doc_id, r.item_id) for r in decontam.leaks(df, bench).collect()} == {(1, 1), (14, 1), (2, 2), (15, 2), (3, 3)}
    assert sorted(r.doc_id for r in decontam.keep_uncontaminated(df, bench).collect()) == [16, 17, 18]


def changed(text, rng):
    """The text with each number and each name inside it replaced by another, the same one for the same."""
    new = {}
    names = "Olga Piet Quin Rosa Sven Tara Uwe Vera Wim Xara".split()

    def put(m):
        x = m[0]
        while x not in new or list(new.values()).count(new[x]) > 1:
            new[x] = str(rng.randint(2, 9999)) if x[0].isdigit() else rng.choice(names)
        return new[x]

    return text[0] + re.sub(r"\d+|(?<=[a-z,] )[A-Z][a-z]+", put, text[1:])


def test_number_heavy_items_are_found(spark):
    rng = random.Random(3)
    words = "how many does each have left after they share what remains of the total when it is given to".split()
    items = ["The 12 km 30 km 44 km 5 kg 7 kg 8 kg 9 kg"]
    for k in range(60):
        parts = [rng.choice(words) if rng.random() < 0.45 else str(rng.randint(1, 999)) for _ in range(rng.randint(6, 25))]
        items.append("Item " + " ".join(parts))
    docs = [(1000 + i, f"Before it all, something else. {t}. And then something after.") for i, t in enumerate(items)]
    docs += [(2000 + i, f"Before it all, something else. {changed(t, rng)}. And then something after.") for i, t in enumerate(items)]
    docs += [(3000 + i, " ".join(rng.choice([*words, "12", "99", "km"]) for _ in range(60))) for i in range(100)]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontam.leaks(spark.createDataFrame(docs, "doc_id long, text string"), bench).collect()}
    assert sum((1000 + i, i) in got for i in range(len(items))) == len(items)
    assert sum((2000 + i, i) in got for i in range(len(items))) >= 0.9 * len(items)
    assert not any(d >= 3000 for d, _ in got)


def test_decontamination_stays_native(spark):
    plan = op3_decontamination(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan)
