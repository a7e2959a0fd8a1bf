"""Sequence functions, tracts, segments, alignment filters, clusters, consensus, simulation from reads to counts."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from strandlake.functions import sequence
from strandlake.operators import aligner, alignments, clusters, consensus, reads, repeats
from strandlake.sources.tables import parse_reference

TRACTS = [
    ("CAG" * 5, (1, 15), "", "CAG" * 5, "", 5, 5, "5"),
    ("TTCAGCAGCAGTT", (3, 11), "TT", "CAG" * 3, "TT", 3, 3, "3"),
    ("CAGCAGCAACAGCAG", (1, 15), "", "CAGCAGCAACAGCAG", "", 5, 4, "2,2"),
    ("CAGCAG" + "T" * 10 + "CAG" * 3, (1, 25), "", "CAGCAG" + "T" * 10 + "CAG" * 3, "", 8, 5, "2,3"),
    ("CAGCAG" + "T" * 20 + "CAG" * 3, (27, 35), "CAGCAG" + "T" * 20, "CAG" * 3, "", 3, 3, "3"),
    ("AACAGAA", None, "AACAGAA", None, "", None, None, None),
    ("GGCAGTCAGGG", (3, 9), "GG", "CAGTCAG", "GG", 2, 2, "1,1"),
    ("CAGTCAGCAGCAGTCAG", (5, 13), "CAGT", "CAG" * 3, "TCAG", 3, 3, "3"),
    (None, None, "", None, "", None, None, None),
]


def test_repeat_tracts(spark):
    df = spark.createDataFrame([(i, "", t[0], "") for i, t in enumerate(TRACTS)], "i int, left string, mid string, right string")
    got = {r.i: r for r in repeats.detect_repeats(df).collect()}
    for i, (_, span, left, mid, right, full, match, runs) in enumerate(TRACTS):
        r = got[i]
        assert (r.pattern_start, r.pattern_end) == (span or (None, None))
        assert (r.left, r.mid, r.right) == (left, mid, right)
        assert (r.repeat_count_full, r.repeat_count_match, r.repeat_count_tracts) == (full, match, runs)
    zero = {r.i: r for r in repeats.missing_counts(repeats.detect_repeats(df)).collect()}
    assert (zero[5].repeat_count, zero[5].repeat_count_tracts) == (0, None)


def test_half_even_counts(spark):
    df = spark.createDataFrame([("ATATA",), ("ATATATA",)], "s string")
    got = [r[0] for r in df.select(sequence.count_repeats(F.col("s"), "AT")["repeat_count_full"]).collect()]
    assert got == [2.0, 4.0]


def test_all_tracts_are_rows(spark):
    df = spark.createDataFrame([("a", "CAGCAG" + "T" * 30 + "CAGCAGCAG")], "qname string, mid string")
    got = repeats.cut_tract(df, choice="all").orderBy("tract_number").collect()
    assert [(r.tract_number, r.pattern_start, r.pattern_end) for r in got] == [(1, 1, 6), (2, 37, 45)]


def test_cigar(spark):
    df = spark.createDataFrame([("5S10M2I3M1D", 100), ("14M", 1)], "cigar string, at int")
    a, b = (r.asDict() for r in df.select(*(v.alias(k) for k, v in sequence.cigar_columns(F.col("cigar"), F.col("at")).items())).collect())
    assert a == {"ref_end": 113, "alignment_length_on_ref": 14, "query_start": 6, "query_end": 20, "alignment_length_on_query": 15, "insertions": 2, "deletions": 1}
    assert (b["query_start"], b["query_end"], b["ref_end"]) == (1, 14, 14)


@pytest.mark.parametrize(("left", "right", "want"), [((3, 12), (25, 38), (2, 10, 12, 14, 2)), ((1, 12), (13, 40), (None, 12, None, 28, None)), ((1, 15), (13, 40), (None, 15, None, 28, None))])
def test_segments(spark, left, right, want):
    rows = [("s", "q", "r", "A" * 40, f, *span) for f, span in (("left", left), ("right", right))]
    df = spark.createDataFrame(rows, "file_stem string, qname string, ref_id string, query_sequence string, ref_flank string, query_start int, query_end int")
    got = alignments.split_segments(df).first()
    assert tuple(None if got[s] is None else len(got[s]) for s in alignments.SEGMENTS) == want


def test_dual_flank_cases(spark):
    cases = {
        "a": [("left", "+", 60, 100, 1), ("right", "+", 60, 100, 150)], "b": [("left", "+", 60, 100, 1)], "c": [("left", "+", 60, 100, 1), ("right", "-", 60, 100, 150)],
        "d": [("left", "+", 60, 100, 1), ("left", "+", 10, 200, 5), ("right", "+", 60, 90, 150)], "e": [("left", "+", 60, 80, 9), ("left", "+", 60, 100, 1), ("right", "+", 60, 90, 150)],
        "f": [("right", "+", 60, 100, 1), ("left", "+", 60, 100, 150)], "g": [("left", "-", 60, 100, 1), ("right", "-", 60, 100, 150)],
    }
    rows = [("s1", q, f, "r", f, s, m, n, 1, at, at + n - 1, "AAC", f"{n}M") for q, hits in cases.items() for f, s, m, n, at in hits]
    df = spark.createDataFrame(rows, "file_stem string, qname string, rname string, ref_id string, ref_flank string, strand string, mapq int, alignment_length_on_ref int, ref_start int, query_start int, query_end int, query_sequence string, cigar string")
    both = alignments.dual_flank(df)
    assert sorted({r.qname for r in both.collect()}) == ["a", "d", "e", "f", "g"]
    assert {(r.qname, r.alignment_length_on_ref) for r in both.collect() if r.ref_flank == "left" and r.qname in "de"} == {("d", 100), ("e", 100)}
    kept = alignments.ordered_flanks(alignments.correct_strand(both)).collect()
    assert sorted({r.qname for r in kept}) == ["a", "d", "e", "g"]
    assert {(r.strand, r.query_sequence, r.query_start) for r in kept if r.qname == "g"} == {("+c", "GTT", 1), ("+c", "GTT", 150)}


def test_longest_per_name(spark):
    rows = [("s1", "r1", "A" * 100, 1), ("s1", "r1", "A" * 120, 2), ("s1", "r2", "A" * 90, 3), ("s1", "r2", "A" * 90, 4), ("s2", "r1", "A" * 50, 5)]
    df = spark.createDataFrame(rows, "file_stem string, qname string, sequence string, read_index int")
    assert sorted(r.read_index for r in reads.longest_per_name(df).collect()) == [2, 3, 5]


def test_flank_fences(spark):
    def kept(totals, m=1.5):
        df = spark.createDataFrame([("s", "x" * t, "", "m") for t in totals], "file_stem string, left string, right string, mid string")
        return sorted(len(r.left) for r in repeats.flank_filter(df, m).collect())

    assert kept([100, 100, 100, 100, 140]) == [100, 100, 100, 100, 140]
    assert kept([98, 99, 100, 101, 102, 150]) == [98, 99, 100, 101, 102]
    none = spark.createDataFrame([("s", "x", "", None)], "file_stem string, left string, right string, mid string")
    assert repeats.flank_filter(none).count() == 0


def test_renumber(spark):
    rows = [("s", c) for c, n in ((1, 10), (2, 30), (3, 30), (None, 5)) for _ in range(n)]
    df = spark.createDataFrame(rows, "file_stem string, cluster_number int")
    assert {(r.cluster_number_old, r.cluster_number) for r in clusters.renumber_map(df).collect()} == {(2, 1), (3, 2), (1, 3), (None, 4)}
    assert {r.cluster_number: r["count"] for r in clusters.renumber(df).groupBy("cluster_number").count().collect()} == {1: 30, 2: 30, 3: 10, 4: 5}


def test_trim(spark):
    adapters = {"x": "ACGTACGTAC"}
    df = spark.createDataFrame([("s", "a", "ACGTACGTACTTTTTTTTTT", None), ("s", "b", "TTTTTTTTTTACGTTCGTAC", None), ("s", "c", "TTTTTTTTTTTTTTTTTTTT", None)], "file_stem string, qname string, sequence string, quality string")
    got = {r.qname: r.sequence for r in reads.trim_reads(df, adapters, 1).collect()}
    assert got["a"].startswith("TTTTTT")
    assert got["c"] == "T" * 20
    sides = {(r.read_name, r.side) for r in reads.trim_locations(df, adapters, 1).filter("trim and trim_pattern_name = 'x'").collect()}
    assert ("a", "right") in sides
    assert ("b", "left") in sides


def test_length_clusters(spark):
    rng = random.Random(3)
    rows = [("s", f"q{i}", float(round(rng.gauss(m, 1)))) for i, m in enumerate([17] * 200 + [45] * 100)] + [("t", f"q{i}", 20.0) for i in range(5)] + [("s", "n", None)]
    df = spark.createDataFrame(rows, "file_stem string, qname string, repeat_count double")
    got = {(r.file_stem, r.repeat_cluster): (r.a, r.b) for r in clusters.length_clusters(df, 5).groupBy("file_stem", "repeat_cluster").agg(F.min("repeat_count").alias("a"), F.max("repeat_count").alias("b")).collect()}
    assert got[("t", 1)] == (20, 20)
    assert got[("s", 1)][1] < 30 < max(b for (f, _), (_, b) in got.items() if f == "s" and b)
    assert ("s", None) in got


def test_exact_split_is_optimal():
    rng = np.random.default_rng(0)
    for _ in range(20):
        x = np.sort(rng.integers(0, 40, 7).astype(float) + np.arange(7) * 0.01)
        w = rng.integers(1, 5, 7).astype(float)
        labels = clusters.best_split(x, w, 3)

        def cost(at):
            return sum(float((w[a:b] * (x[a:b] - np.average(x[a:b], weights=w[a:b])) ** 2).sum()) for a, b in zip((0, *at), (*at, 7), strict=True))

        cuts = tuple(np.flatnonzero(np.diff(labels)) + 1)
        assert cost(cuts) == pytest.approx(min(cost((i, j)) for i in range(1, 6) for j in range(i + 1, 7)))


def test_rare_allele_beyond_the_thousandth_haplotype_has_its_cluster():
    base = "ACGT" * 15
    turn = str.maketrans("ACGT", "CGTA")
    near = [base[:i] + base[i].translate(turn) + base[i + 1 : j] + base[j].translate(turn) + base[j + 1 :] for i in range(60) for j in range(i + 1, 60)][:1100]
    got = clusters.group_haplotypes([*near, base.translate(turn)], [2] * 1100 + [1], "hamming", downsample=2000)
    assert set(got[:-1]) == {1} and got[-1] == 2


def test_haplotypes_and_distances():
    assert clusters.pair_distances(["ACGT", "AGT", "TTTT"]).tolist() == [[0, 1, 3], [1, 0, 3], [3, 3, 0]]
    a, b = "ACGTACGTAC", "TTTTGGGGCC"
    got = clusters.group_haplotypes([a, a[:-1] + "G", b, b[:-1] + "A"], [1, 1, 1, 1])
    assert got[0] == got[1] != got[2] == got[3]
    assert clusters.group_haplotypes([a, b], [1, 1]) == [1, 1]
    many = clusters.group_haplotypes([a, a[:-1] + "G", b], [40, 2, 40], downsample=50)
    assert many[0] == many[1] != many[2]


def test_two_step_clusters(spark):
    rows = [("s", f"{h}{c}{i}", h * 5, "CAG", h, float(c)) for h in ("A", "T") for c in (10, 30) for i in range(12)]
    df = spark.createDataFrame(rows, "file_stem string, qname string, left string, mid string, right string, repeat_count double")
    got = clusters.assign_clusters(df, ("repeat", "haplotype"), 3)
    assert {(r.repeat_cluster, r.haplotype_cluster, r.cluster_number) for r in got.collect()} == {("R1", "H1", 1), ("R1", "H2", 2), ("R2", "H1", 3), ("R2", "H2", 4)}
    assert {r.cluster_number for r in clusters.assign_clusters(df, None).collect()} == {1}


def test_consensus_and_variants():
    assert consensus.consensus([]) is None
    assert consensus.consensus(["ACGT"]) == "ACGT"
    true = "ACGTTGCAAGTCCATGACG"
    assert consensus.consensus([true] * 5 + [true[:7] + "T" + true[8:], true[:4] + true[5:], true[:10] + "G" + true[10:]]) == true
    assert consensus.call_variants("ACGTACGT", "ACGTACGT") == []
    assert consensus.call_variants("ACGAACGT", "ACGTACGT") == [(4, "T", "A", "mismatch", 4)]
    deleted = consensus.call_variants("ACGTTTGCA"[:3] + "TTGCA", "ACGTTTGCA")
    assert [v[3] for v in deleted] == ["deletion"]
    a, b = consensus.align_global("ACGTT", "ACGGGTT")
    assert (a.replace("-", ""), b.replace("-", ""), len(a)) == ("ACGTT", "ACGGGTT", len(b))


def test_simulated_reads_give_their_counts(spark):
    rng = random.Random(5)
    bases = lambda n: "".join(rng.choice("ACGT") for _ in range(n))
    left, right = bases(80) + "TTCG", "TGCC" + bases(80)
    refs = parse_reference("locus", left + "NNNNNNN" + right)
    turn = str.maketrans("ACGT", "TGCA")
    rows = []
    for i in range(40):
        k = rng.randint(4, 40)
        read = bases(rng.randint(0, 9)) + left + "CAG" * k + right + bases(5)
        if i % 4 == 0:
            at = rng.randint(15, 60)
            read = read[:at] + "A" + read[at + 1 :]
        rows.append(("s", f"q{i}", read if i % 2 else read.translate(turn)[::-1], k))
    df = spark.createDataFrame(rows, "file_stem string, qname string, sequence string, k int")
    found = alignments.split_segments(alignments.ordered_flanks(alignments.correct_strand(alignments.dual_flank(aligner.align(df, refs)))))
    got = {r.qname: r for r in repeats.detect_repeats(found).collect()}
    assert len(got) == 40
    assert all(got[q].repeat_count == k for _, q, _, k in rows)
    for r in found.collect():
        assert "".join(r[s] or "" for s in alignments.SEGMENTS) == r.query_sequence


def plain_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_pair_distances_match_the_plain_programme():
    rng = random.Random(1)
    for _ in range(12):
        seqs = ["".join(rng.choice("ACGT") for _ in range(rng.choice([0, 1, 5, 63, 64, 65, 127, 128, 129, 200]))) for _ in range(8)]
        d = clusters.pair_distances(seqs, rng.choice(["levenshtein", "hamming"]))
        assert d.tolist() == [[plain_distance(a, b) for b in seqs] for a in seqs]
    assert clusters.pair_distances(["ACGT", "CGTA"], "hamming").tolist() == [[0, 4], [4, 0]]


def test_complete_linkage_matches_the_plain_search():
    rng = random.Random(2)
    for _ in range(40):
        n = rng.randint(1, 30)
        d = np.zeros((n, n))
        for i in range(n):
            for j in range(i):
                d[i, j] = d[j, i] = rng.randint(0, 9)
        groups, want = {i: [i] for i in range(n)}, []
        while len(groups) > 1:
            h, a, b = min((max(d[x, y] for x in groups[i] for y in groups[j]), i, j) for i in groups for j in groups if i < j)
            groups[a] += groups.pop(b)
            want.append((a, b, h))
        assert clusters.complete_linkage(d) == want


def test_the_rest_joins_by_the_same_distance():
    a, b = "ACGT" * 5, "TGCA" * 5
    turned = a[1:] + a[0]  # two edits from a, but twenty places
    got = clusters.group_haplotypes([a, b, turned], [30, 30, 1], "hamming", downsample=2)
    near = min((sum(x != y for x, y in zip(turned, c, strict=True)), k) for k, c in ((got[0], a), (got[1], b)))
    assert got[2] == near[1]


def test_consensus_threshold_is_the_disagreement_allowed():
    reads = ["ACGT"] * 6 + ["ACTT"] * 4
    assert consensus.consensus(reads, 0.05) == "ACNT"
    assert consensus.consensus(reads, 0.39) == "ACNT"
    assert consensus.consensus(reads, 0.4) == consensus.consensus(reads, 0.5) == consensus.consensus(reads, 0.9) == "ACGT"
    assert consensus.consensus(["ACGT"] * 5 + ["ACTT"] * 5, 0.5) == "ACNT"
    assert consensus.consensus(["ACGT"] * 96 + ["ACTT"] * 4, 0.05) == "ACGT"
    longer = ["AACCGGTT"] * 6 + ["AACCAGGTT"] * 4
    assert consensus.consensus(longer, 0.5) == "AACCGGTT"
    assert consensus.consensus(longer, 0.05) == "AACCNGGTT"


def plain_local_score(query, ref, match=2, mismatch=-4, gap=-4):
    best, row = 0, [0] * (len(ref) + 1)
    for x in query:
        new = [0]
        for j, y in enumerate(ref, 1):
            new.append(max(0, row[j - 1] + (match if x == y else mismatch), row[j] + gap, new[-1] + gap))
        best, row = max(best, *new), new
    return best


def test_alignments_of_a_batch_match_the_plain_programme(monkeypatch):
    rng = random.Random(3)
    ref = "".join(rng.choice("ACGT") for _ in range(40))
    queries = ["", "T" * 7, ref, ref.lower()]
    for _ in range(40):
        flawed = "".join(c if rng.random() > 0.1 else rng.choice(["", c + "A", "T"]) for c in ref)
        queries.append("".join(rng.choice("ACGT") for _ in range(rng.randint(0, 30))) + flawed[rng.randint(0, 10) :])
    alone = [aligner.local_alignment(q, ref) for q in queries]
    for cells in (1, 5000, 1 << 23):
        monkeypatch.setattr(aligner, "CELLS", cells)
        assert aligner.local_alignments(queries, ref) == alone
    for q, got in zip(queries, alone, strict=True):
        assert (got[0] if got else 0) == plain_local_score(q.upper(), ref)
        if got:
            score, i, _, j, _, moves = got
            for x in moves:
                score += {"M": -2 if q.upper()[i] == ref[j] else 4, "I": 4, "D": 4}[x]
                i, j = i + (x != "D"), j + (x != "I")
            assert (score, i, j) == (0, got[2], got[4])
