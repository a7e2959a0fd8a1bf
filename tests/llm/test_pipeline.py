"""The pipeline's stages, and the registry with and without the training-data operators."""

import os
import random
import re
import shutil
import subprocess
import sys

import duckdb
import pytest

import corpus_pipeline
from strandlake.llm import decontam, langid, queries, simhash, toxicity

from ..conftest import DATA
from ..test_oracle import rows

SF = f"{DATA}/sf0.01"


def test_stages_keep_columns_and_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels, bench = spark.read.parquet(f"{SF}/labels.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "toxicity", "simhash_near_dedup", "benchmark_decontamination", "best_fit_packing"]
    now = docs.cache()
    for name, stage in corpus_pipeline.STAGES[:4]:
        after = stage(spark, now, SF).cache()
        assert after.columns == docs.columns
        got = {r.doc_id for r in after.collect()}
        before = {r.doc_id for r in now.collect()}
        if name == "language_id":
            want = {r.doc_id for r in langid.identify(now).collect() if r.accepted}
        elif name == "toxicity":
            want = {r.doc_id for r in toxicity.score_documents(now, labels).collect() if not r.predicted}
        elif name == "simhash_near_dedup":
            want = {r.component_id for r in simhash.similar_documents(now).collect()}
        else:
            want = before - {r.doc_id for r in decontam.leaks(now, bench).collect()}
        assert got == want
        assert len(got) > 0.5 * len(before)
        now = after
    packed = corpus_pipeline.STAGES[4][1](spark, now, SF)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == {r.doc_id for r in now.collect()}


def test_near_dedup_matches_exact_similarity(spark):
    """Against the components of all pairs whose five-word shingle sets have a Jaccard similarity of 0.8 or more."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    rng = random.Random(8)
    rows = [tuple(r) for r in docs.collect()]
    for k in range(150):
        words = rows[rng.randrange(len(rows))][1].split()
        for at in rng.sample(range(len(words)), max(1, len(words) // 60)) if words else ():
            words[at] = rng.choice(["other", "words", "", "a b"])
        rows.append((10_000 + k, " ".join(words)))
    sets = {}
    for i, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets[i] = frozenset(tuple(words[j : j + 5]) for j in range(max(1, len(words) - 4))) if words else frozenset()
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    near = 0
    for a in sets:
        for b in sets:
            if a < b and (sets[a] == sets[b] or 0.8 * (len(sets[a]) + len(sets[b])) <= 1.8 * len(sets[a] & sets[b])):
                near += sets[a] != sets[b]
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    want = {i: root(i) for i in sets}
    got = {r.doc_id: r.component_id for r in simhash.similar_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert near > 50
    assert all(want[got[i]] == want[i] for i in got)  # nothing is joined that isn't similar
    gone, ideal = (sum(c[i] != i for i in c) for c in (got, want))
    assert gone >= 0.95 * ideal
    blocks = {r for r in simhash.wide_links(fingerprints(spark, rows), block=3).collect()}
    whole = {r for r in simhash.wide_links(fingerprints(spark, rows)).collect()}
    assert classes(blocks) == classes(whole)


def fingerprints(spark, rows):
    both = {divmod(simhash.wide_fingerprint(t), 1 << 64) for _, t in rows}
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    return spark.createDataFrame([(signed(a), signed(b)) for a, b in both], "hi long, lo long")


def classes(links):
    parent = {}

    def root(i):
        while parent.setdefault(i, i) != i:
            i = parent[i]
        return i

    for r in links:
        parent[root((r.a0, r.a1))] = root((r.b0, r.b1))
    return {frozenset(i for i in parent if root(i) == root(j)) for j in list(parent)}


def test_stages_take_odd_rows(spark):
    from pyspark.sql import functions as F

    docs = spark.read.parquet(f"{DATA}/sf0.001/documents.parquet")
    odd = [(None, None, None, None, None), (1, None, "en", "s", 0), (-1, "", None, None, None), (-2, "short words of text", None, "new", 3), (-2, "short words of text", None, "new", 3), (-3, "the and of " * 60_000, "en", "src1", 1)]
    rows = docs.unionByName(spark.createDataFrame(odd, docs.schema))
    clash = {c: F.lit(1) for c in ("gone_id", "fp", "language", "accepted", "toxicity", "hash", "words", "id", "component_id", "sl_logs")}
    for now in (rows.withColumns(clash), docs.limit(0), rows.filter("doc_id < 0")):
        for _, stage in corpus_pipeline.STAGES[:4]:
            after = stage(spark, now, f"{DATA}/sf0.001")
            assert after.columns == now.columns
            assert after.count() <= now.count()
        packed = corpus_pipeline.STAGES[4][1](spark, now, f"{DATA}/sf0.001")
        assert packed.select("doc_id").distinct().count() == now.select("doc_id").distinct().count()
    kept = corpus_pipeline.language_id(spark, rows, "").filter("doc_id < 0").collect()
    assert sorted(r.doc_id for r in kept) == [-3, -2, -2]


def test_run(spark):
    assert corpus_pipeline.run(spark, f"{DATA}/sf0.001").count() > 0


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("pages", "conversations"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got, want = queries.queries()[name](spark, SF).toPandas(), con.sql(queries.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_registry_without_these_operators(tmp_path):
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    shutil.copytree(f"{root}/strandlake", tmp_path / "strandlake", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{root}/__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; n = set(e.queries()); assert n and not any(x.startswith('op') and x[2].isdigit() or x == 'pipeline' for x in n); assert set(e.oracle_sql()) <= n"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=os.environ | {"PYTHONPATH": str(tmp_path)}, check=True)


def test_every_operator_has_its_query():
    names = set(queries.queries())
    assert {int(n[2:].split("_")[0]) for n in names} == set(range(1, 11))


def test_near_dedup_loses_no_pair(spark):
    """Pairs at or just above the threshold, however their fingerprints differ; nothing that is below it."""
    rng = random.Random(31)
    rows, above, below = [], [], []
    for k in range(600):
        n = rng.randrange(40, 160)
        words = [f"w{rng.randrange(10**6)}" for _ in range(n + 4)]
        # Shingles that differ: 5 for each word changed on its own; 2 * 9 (n - d) >= 8 * 2 n holds up to d = n / 9.
        most = n // 9
        other = words[: len(words) - most] + [f"v{rng.randrange(10**6)}" for _ in range(most)]
        less = words[: len(words) - most - 1] + [f"u{rng.randrange(10**6)}" for _ in range(most + 1)]
        if k % 2:
            rows += [(10 * k, " ".join(words)), (10 * k + 1, " ".join(other))]
            above.append(10 * k)
        else:
            rows += [(10 * k, " ".join(words)), (10 * k + 1, " ".join(less))]
            below.append(10 * k)
    got = {r.doc_id: r.component_id for r in simhash.similar_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [i for i in above if got[i + 1] != i] == []
    assert [i for i in below if got[i + 1] != i + 1] == []


def test_near_dedup_goes_by_shingles_not_fingerprints(spark):
    """A shingle that outvotes the others gives texts one fingerprint; a row without an id still ties those like it."""
    line = "one two three four five "
    texts = [line * 40 + " ".join(f"{c}{i}" for i in range(12)) for c in "xy"]
    assert simhash.wide_fingerprint(texts[0]) == simhash.wide_fingerprint(texts[1])
    words = [f"w{i}" for i in range(104)]
    chain = [" ".join(words), " ".join(words[:-11] + [f"a{i}" for i in range(11)]), " ".join([f"b{i}" for i in range(11)] + words[11:])]
    rows = [(1, texts[0]), (2, texts[1]), (None, chain[0]), (4, chain[1]), (5, chain[2])]
    got = simhash.similar_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.component_id for r in got} == {1: 1, 2: 2, None: 4, 4: 4, 5: 4}


def test_parities_rule_out_no_similar_pair():
    import numpy as np

    rng = np.random.default_rng(5)
    for n in (3, 400, 600, 1000, 1100, 5000):
        for gone in (0, 1, n // 20, n // 9):
            x = np.unique(rng.integers(-(2**63), 2**63 - 1, n))
            y = np.unique(np.concatenate([x[gone:], rng.integers(-(2**63), 2**63 - 1, gone // 2)]))
            apart = len(np.setxor1d(x, y))
            assert simhash.least_apart(simhash.parities(x), simhash.parities(y)) <= apart
            wide = simhash.wide_parities(x), simhash.wide_parities(y)
            assert None in wide or simhash.least_apart(*wide) <= apart


def near_copies(rng, n, words=60):
    """Texts of one source whose shingle sets are mostly a little less similar than the threshold: some words at random places are others."""
    source = [f"w{i}" for i in range(words * 5)]
    for k in range(n):
        text = list(source)
        for at in rng.sample(range(len(text)), rng.choice([3, 6, 7, 8])):
            text[at] = f"x{rng.randrange(10**6)}"
        yield " ".join(text)


def similar_classes(texts, least=0.8):
    sets = {}
    for i, text in texts:
        words = text.split()
        sets[i] = {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    similar = 0
    for a in sets:
        for b in sets:
            if a < b and len(both := sets[a] & sets[b]) >= least * (len(sets[a]) + len(sets[b]) - len(both)):
                similar += 1
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {i: root(i) for i in sets}, similar


def test_near_dedup_makes_no_table_of_pairs(spark, monkeypatch):
    """A large group of near copies: what the steps write grows with its rows, not with its pairs."""
    made = {}
    staged = simhash.common.staged

    def counted(df, label, *args, **options):
        out = staged(df, label, *args, **options)
        made[label] = max(made.get(label, 0), out.count())
        return out

    monkeypatch.setattr(simhash.common, "staged", counted)
    rows = list(enumerate(near_copies(random.Random(12), 260)))
    want, similar = similar_classes(rows)
    got = {r.doc_id: r.component_id for r in simhash.similar_documents(spark.createDataFrame(rows, "doc_id long, text string"), differ=0).collect()}
    assert got == want
    assert similar > 2 * len(rows)
    assert made["others"] < 2 * len(rows)


@pytest.mark.parametrize("block,most", [(10**6, 10**9), (16, 10**9), (10**6, 4000)])
def test_rest_links_lose_nothing(spark, block, most):
    """All links without any first pass, also where places are dealt to blocks by their rows or by their shingles."""
    import numpy as np

    rng = random.Random(40)
    rows = [(100 * k + i, t) for k in range(3) for i, t in enumerate(near_copies(rng, 40, 20 + 45 * k))]
    want, _ = similar_classes(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    reps = simhash._profiles(docs, 5, 0.8, (np.empty(0, np.int64), np.empty(0, np.int64))).withColumnRenamed("doc_id", "first_id").selectExpr("*", "first_id AS rep").cache()
    alone = spark.createDataFrame([], "node long, root long")
    links = [(r.a, r.b) for r in simhash.rest_links(reps, alone, docs, 0.8, 5, block, most).collect()]
    assert all(want[a] == want[b] for a, b in links)
    parent = {i: i for i, _ in rows}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in links:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    assert {i: root(i) for i in parent} == want
    assert 3 < len(set(want.values())) < len(rows)


CLUSTER = """
import os, sys, time
import corpus_pipeline
import pyspark
from pyspark.sql import SparkSession

spark = SparkSession.builder.master("local-cluster[1,2,1500]").config("spark.executor.memory", "900m").config("spark.ui.enabled", "false").config("spark.checkpoint.dir", "file://" + sys.argv[1]).config("spark.sql.shuffle.partitions", "4").getOrCreate()


def resident(_):
    daemon = os.getppid()
    executor = open(f"/proc/{daemon}/stat").read().rsplit(")", 1)[1].split()[1]
    yield int(next(x for x in open(f"/proc/{executor}/status") if x.startswith("VmRSS")).split()[1]) // 1024


now = lambda: spark.sparkContext.parallelize([0], 1).mapPartitions(resident).first()
spark.range(0, 6_000_000, 1, 4).selectExpr("id", "sha2(CAST(id AS STRING), 512) AS h").repartition(2, "h").sortWithinPartitions("h").write.format("noop").mode("overwrite").save()
before = now()
docs = spark.read.parquet(sys.argv[2] + "/documents.parquet")
corpus_pipeline.language_id(spark, docs.limit(0), sys.argv[2])
time.sleep(2)
print("MB", before, now())
"""


def test_a_stage_begins_without_the_memory_of_the_last(tmp_path):
    """An executor's heap, once grown, is given back before the next stage."""
    import pyspark

    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    (tmp_path / "cluster.py").write_text(CLUSTER)
    (tmp_path / "home").mkdir()
    installed = os.path.dirname(pyspark.__file__)
    for name in os.listdir(installed):
        if name != "work":  # the executors' logs go there
            (tmp_path / "home" / name).symlink_to(f"{installed}/{name}")
    env = {k: v for k, v in os.environ.items() if not k.startswith(("PYSPARK_SUBMIT", "PYSPARK_GATEWAY"))} | {"PYTHONPATH": root, "SPARK_HOME": str(tmp_path / "home"), "SPARK_SCALA_VERSION": "2.13", "SPARK_LOCAL_IP": "127.0.0.1", "PYSPARK_PYTHON": sys.executable}
    out = subprocess.run([sys.executable, "cluster.py", str(tmp_path / "shared"), f"{DATA}/sf0.001"], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=240)
    before, after = map(int, re.search(r"MB (\d+) (\d+)", out.stdout + out.stderr[-3000:]).groups())
    assert before > 700
    assert after < 0.7 * before
