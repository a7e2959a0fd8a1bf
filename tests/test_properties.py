"""Properties that hold for any input."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strandlake.functions import sequence
from strandlake.operators import alignments, repeats
from strandlake.operators.clusters import pair_distances
from strandlake.operators.consensus import align_global
from strandlake.plans import bindings
from strandlake.plans.queries import queries

from .conftest import DATA

SF = f"{DATA}/sf0.001"
dna = st.text("ACGT", max_size=40)


@given(st.lists(st.sampled_from(["CAG", "CAA", "T", "G", "CAGCAG", "ACGT"]), max_size=25).map("".join), st.integers(0, 8), st.integers(1, 3))
@settings(max_examples=300, deadline=None)
def test_tracts_lie_apart_and_hold_the_motif(seq, gap, least):
    found = repeats.find_tracts(seq, max_gap=gap, min_repeats=least, max_tract_gap=gap, choice="all")
    assert all(1 <= a <= b <= len(seq) and "CAG" in seq[a - 1 : b] for a, b, _ in found)
    assert all(b < c for (_, b, _), (c, _, _) in zip(found, found[1:], strict=False))
    longest = repeats.find_tracts(seq, max_gap=gap, min_repeats=least, max_tract_gap=gap)
    assert longest == ([max(found, key=lambda t: (t[1] - t[0], -t[0]))] if found else [])


@given(dna, dna)
@settings(max_examples=200, deadline=None)
def test_global_alignment_keeps_both_sequences(a, b):
    x, y = align_global(a, b)
    assert len(x) == len(y)
    assert (x.replace("-", ""), y.replace("-", "")) == (a, b)
    assert not any(p == q == "-" for p, q in zip(x, y, strict=True))


@given(st.lists(dna, min_size=2, max_size=5))
@settings(max_examples=100, deadline=None)
def test_distances_are_levenshtein(seqs):
    def plain(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            new = [i]
            for j, y in enumerate(b, 1):
                new.append(min(new[-1] + 1, row[j] + 1, row[j - 1] + (x != y)))
            row = new
        return row[-1]

    d = pair_distances(seqs)
    assert all(d[i, j] == plain(a, b) for i, a in enumerate(seqs) for j, b in enumerate(seqs))


def test_reverse_complement_twice_is_the_same(spark):
    df = spark.createDataFrame([("ACGTNRYKMBDHVacgtn",), ("",), (None,)], "s string")
    assert all(r.s == r.t for r in df.withColumn("t", sequence.reverse_complement(sequence.reverse_complement(F.col("s")))).collect())


def test_tail_counts_add_up(spark):
    for r in queries()["a29_instability"](spark, SF).collect():
        assert r.reads_at_setpoint + r.reads_below_setpoint + r.reads_above_setpoint == r.n_reads_used
    for r in queries()["a28_distribution_summary"](spark, SF).filter("reads_below_modal is not null").collect():
        assert r.reads_below_modal + r.reads_above_modal + r.modal_frequency == r.n_reads_analysed == r.n_reads_used


def test_exclusion_and_its_complement_are_all(spark):
    rows = bindings.counted_reads(spark, SF)
    some = rows.filter("repeat_count > 40")
    kept, gone = alignments.exclude_reads(rows, some), rows.join(some.select("file_stem", "qname").distinct(), ["file_stem", "qname"], "left_semi")
    assert kept.count() + gone.count() == rows.count()


@pytest.mark.parametrize("name", ["a28_distribution_summary", "a29_instability", "a27_modal_peaks", "m3_ordered_flanks", "p3_exclusions", "u8_waterfall_bases"])
def test_plans_have_no_product(spark, name):
    plan = queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


