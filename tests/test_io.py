"""Sources and sinks: round trips."""

import gzip
import struct
import zipfile
import zlib

import pytest
from pyspark.sql import functions as F

from strandlake.operators import aligner
from strandlake.plans import exports, pipeline
from strandlake.plans.config import Config, Timing
from strandlake.plans.pipeline import plan, run
from strandlake.sources import catalog, sequences, sinks, tables
from strandlake.streaming import ingest


def bam(records):
    out = b"BAM\1" + struct.pack("<ii", 0, 0)
    for name, seq, quality in records:
        n = len(seq)
        codes = [sequences.BAM_BASES.index(c) for c in seq] + [0] * (n % 2)
        packed = bytes(codes[i] << 4 | codes[i + 1] for i in range(0, len(codes), 2))
        body = struct.pack("<iiBBHHHiiii", -1, -1, len(name) + 1, 0, 0, 0, 4, n, -1, -1, 0) + name.encode() + b"\0" + packed
        body += bytes(ord(c) - 33 for c in quality) if quality else b"\xff" * n
        out += struct.pack("<i", len(body)) + body
    half = len(out) // 2
    member = lambda raw: gzip.compress(raw)
    return member(out[:half]) + member(out[half:]) + member(b"")


def test_fastq(spark, tmp_path):
    text = "".join(f"@r{i} more\n{'ACGT' * (i % 3 + 1)}\n+\n{'I@+#' * (i % 3 + 1)}\n" for i in range(50))
    (tmp_path / "a.fastq").write_text(text)
    (tmp_path / "b.fastq.gz").write_bytes(gzip.compress(text.replace("\n", "\r\n").encode()))
    got = sequences.read_fastq(spark, [str(tmp_path / "a.fastq"), str(tmp_path / "b.fastq.gz")])
    rows = got.orderBy("file_stem", "read_index").collect()
    assert [(r.file_stem, r.qname) for r in rows] == [(s, f"r{i}") for s in "ab" for i in range(50)]
    assert all(r.sequence == "ACGT" * (i % 3 + 1) and r.quality == "I@+#" * (i % 3 + 1) for i, r in ((int(r.qname[1:]), r) for r in rows))


def test_fasta_and_reference(spark, tmp_path):
    (tmp_path / "x.fasta").write_text(">one two\nACGT\nAC\n>three\n\nGG\n")
    got = sequences.read_fasta(spark, str(tmp_path / "x.fasta")).orderBy("read_index").collect()
    assert [(r.file_stem, r.qname, r.sequence) for r in got] == [("x", "one two", "ACGTAC"), ("x", "three", "GG")]
    (tmp_path / "ref.fasta").write_text(">HTT\nACGTNNNNNNTTTT\n")
    assert tables.read_reference(spark, str(tmp_path / "ref.fasta")) == [("HTT_left", "HTT", "left", "ACGT"), ("HTT_right", "HTT", "right", "TTTT")]
    with pytest.raises(ValueError, match="run of at least five"):
        tables.parse_reference("x", "ACGTNNACG")


def test_bam(spark, tmp_path):
    records = [("r1", "ACGTN", "IIII#"), ("r2", "GGG", None)]
    (tmp_path / "s.bam").write_bytes(bam(records))
    got = sequences.read_sequences(spark, str(tmp_path / "s.bam"), "bam").orderBy("read_index").collect()
    assert [(r.file_stem, r.qname, r.sequence, r.quality) for r in got] == [("s", *x) for x in records]
    with pytest.raises(ValueError, match="unsupported"):
        sequences.read_sequences(spark, "x", "fasta.gz")
    assert zlib.crc32(b"") == 0


def test_long_bam_is_read_in_pieces(tmp_path):
    import io

    records = [(f"r{i}", "ACGT" * 400, "I" * 1600) for i in range(3000)]
    handle = io.BytesIO(bam(records))
    assert list(sequences.bam_records(handle)) == records
    with pytest.raises(ValueError, match="cut short"):
        list(sequences.bam_records(io.BytesIO(gzip.compress(gzip.decompress(bam(records[:3]))[:-5]))))


def test_aligned_bam(spark, tmp_path):
    def record(name, flag, ref, start, cigar, seq, tags):
        codes = [sequences.BAM_BASES.index(c) for c in seq] + [0] * (len(seq) % 2)
        body = struct.pack("<iiBBHHHiiii", ref, start, len(name) + 1, 37, 0, len(cigar), flag, len(seq), -1, -1, 0) + name.encode() + b"\0"
        body += b"".join(struct.pack("<I", n << 4 | sequences.BAM_OPS.index(op)) for n, op in cigar) + bytes(codes[i] << 4 | codes[i + 1] for i in range(0, len(codes), 2)) + b"\xff" * len(seq) + tags
        return struct.pack("<i", len(body)) + body

    raw = b"BAM\1" + struct.pack("<i", 0) + struct.pack("<i", 2) + b"".join(struct.pack("<i", len(n) + 1) + n + b"\0" + struct.pack("<i", 99) for n in (b"HTT_left", b"HTT_right"))
    raw += record("a", 0, 0, 4, [(2, "S"), (5, "M"), (1, "I"), (3, "M")], "ACGTACGTACG", b"NMC\x02" + b"XBBc" + struct.pack("<ib", 1, 3) + b"MDZ3A4\0")
    raw += record("b", 16, 1, 0, [(4, "M")], "ACGT", b"") + record("c", 4, -1, -1, [], "GG", b"NMi" + struct.pack("<i", 0))
    (tmp_path / "s.bam").write_bytes(gzip.compress(raw))
    refs = [("HTT_left", "HTT", "left", "A"), ("HTT_right", "HTT", "right", "C")]
    got = {r.qname: r for r in sequences.read_alignments(spark, str(tmp_path / "s.bam"), refs).collect()}
    a = got["a"]
    assert (a.file_stem, a.rname, a.ref_flank, a.strand, a.ref_start, a.ref_end, a.query_start, a.query_end, a.mapq) == ("s", "HTT_left", "left", "+", 5, 12, 3, 11, 37)
    assert (a.cigar, a.insertions, a.mismatches, a.md, a.aligned_subsequence) == ("2S5M1I3M", 1, 2, "3A4", "GTACGTACG")
    assert (got["b"].strand, got["b"].mismatches, got["b"].md) == ("-", None, None)
    assert (got["c"].rname, got["c"].strand, got["c"].ref_start) == (None, None, None)
    built_in = [c.split()[0] for c in aligner.ALIGNED.split(", ")]
    assert set(built_in) <= set(sequences.read_alignments(spark, str(tmp_path / "s.bam"), refs).columns)


def test_tables(spark, tmp_path):
    (tmp_path / "adapters.csv").write_text("﻿adapter_name,adapter_sequence\np5,AATG\n", encoding="utf-8")
    assert tables.read_adapters(spark, str(tmp_path / "adapters.csv")) == {"p5": "AATG"}
    book = sinks.workbook({"settings": spark.createDataFrame([("a.bam", "[0-35]", "3", "1", None)], "file_name string, analysis_ranges string, floor string, max_peaks string, time string"), "x" * 40: spark.range(2)})
    (tmp_path / "s.xlsx").write_bytes(book)
    got = tables.read_settings(spark, str(tmp_path / "s.xlsx")).first()
    assert (got.file_stem, got.analysis_ranges, got.group, got.time) == ("a", "[0-35]", None, None)
    assert sinks.sheet_names(["x" * 40, "x" * 40]) == ["x" * 29 + "..", "x" * 29 + "_2"]
    assert tables.read_exclusions(spark, None).count() == 0
    (tmp_path / "e.tsv").write_text("file_name\tread_name\na\tr1\n")
    assert [tuple(r) for r in tables.read_exclusions(spark, str(tmp_path / "e.tsv")).collect()] == [("a", "r1")]
    with pytest.raises(ValueError, match="old binary workbooks"):
        tables.read_settings(spark, str(tmp_path / "old.XLS"))
    with pytest.raises(ValueError, match="settings lack"):
        tables.read_settings(spark, str(tmp_path / "e.tsv"))


def test_fasta_lines(spark):
    names = sinks.consensus_names(spark.createDataFrame([("s", 3, 10, 17.0, 0.25, "ACXT")], "file_stem string, cluster_number int, read_count int, mode double, proportion double, sequence string"), "mid")
    assert [r.value for r in sinks.fasta_lines(names).collect()] == [">s_cluster03_n10_mode17_prop0.250_mid\nAC-T"]


def test_vcf_files(spark, tmp_path):
    rows = [("s1", 5, "A", "G", "mismatch", "cluster1"), ("s1", 5, "A", "G", "mismatch", "cluster2"), ("s1", 9, "C", "T", "mismatch", "cluster2"), ("s2", 7, "A", "C", "mismatch", "cluster1"), ("s3", 7, "A", "-", "deletion", "cluster1")]
    df = spark.createDataFrame(rows, "file_stem string, position int, ref string, query string, variant_type string, cluster string")
    exports.write_lines(exports.vcf_lines(df, "HTT", 100, "ref.fa"), str(tmp_path / "vcf"))
    text = {p.parent.name: p.read_text().splitlines() for p in (tmp_path / "vcf").glob("*/part-*")}
    assert set(text) == {"file_stem=s1", "file_stem=s2"}
    one = text["file_stem=s1"]
    assert one[0] == "##fileformat=VCFv4.2"
    assert one[7].split("\t")[9:] == ["cluster1", "cluster2"]
    assert one[8:] == ["HTT\t5\t.\tA\tG\t.\tPASS\tTYPE=mismatch\tGT\t0/1\t0/1", "HTT\t9\t.\tC\tT\t.\tPASS\tTYPE=mismatch\tGT\t0/0\t0/1"]


def test_catalog(spark, tmp_path):
    for name in ("a_R1_1.fastq.gz", "a_R2_1.fastq.gz", "b.bam", "notes.md"):
        (tmp_path / name).write_text("x")
    got = catalog.catalog(catalog.discover(spark, str(tmp_path))).orderBy("file_name").collect()
    assert [(r.file_stem, r.file_format, r.paired, r.include) for r in got] == [("a_R1_1", "fastq.gz", True, True), ("a_R2_1", "fastq.gz", True, False), ("b", "bam", False, True)]


def test_pipeline_runs_resumes_and_recomputes(spark, tmp_path):
    import random

    rng = random.Random(9)
    bases = lambda n: "".join(rng.choice("ACGT") for _ in range(n))
    left, right = bases(60), bases(60)
    data = tmp_path / "data"
    data.mkdir()
    counts = {"s1": [17] * 6 + [18] * 3, "s2": [20] * 5 + [22] * 2}
    for s, ks in counts.items():
        (data / f"{s}.fastq").write_text("".join(f"@{s}_{i}\n{(r := left + 'CAG' * k + right)}\n+\n{'I' * len(r)}\n" for i, k in enumerate(ks)))
    (tmp_path / "ref.fasta").write_text(f">HTT\n{left}NNNNNN{right}\n")
    (tmp_path / "settings.csv").write_text("file_name,analysis_ranges,floor,max_peaks,group,group_control_sample\ns1.fastq,[0-35],[NA],[1],g,TRUE\ns2.fastq,[0-35],[NA],[1],g,NA\n")
    config = Config(dir_data=str(data), dir_out=str(tmp_path / "out"), path_ref=str(tmp_path / "ref.fasta"), path_settings=str(tmp_path / "settings.csv"))
    seen, plain_align = spark.sparkContext.accumulator(0), pipeline.align

    def counted(reads, *options):
        def look(parts):
            for part in parts:
                seen.add(part.num_rows)
                yield part

        return plain_align(reads.mapInArrow(look, reads.schema), *options)

    pipeline.align = counted
    try:
        done = run(spark, config)
    finally:
        pipeline.align = plain_align
    assert seen.value == 16  # each read once, whatever follows from its alignments
    summary = {r.file_stem: r for r in done[6]["distribution_summary"].collect()}
    assert (summary["s1"].modal_length, summary["s2"].modal_length) == (17, 20)
    control = {r.file_stem: r.instability_index for r in done[6]["instability_metrics"].filter("setpoint_type = 'control_relative'").collect()}
    assert control["s2"] == pytest.approx(3 + 4 / 7)
    assert done[4]["variants"].columns[:3] == ["file_stem", "cluster_number", "position"]
    wide = {r.file_stem: r for r in done[6]["comprehensive_range_summary"].collect()}
    assert (wide["s1"].peak1_length, wide["s1"].n_reads, wide["s1"].group) == (17, 9, "g")
    out = tmp_path / "out"
    book = tables.xlsx_rows((out / "range_analysis" / "range_analysis.xlsx").read_bytes(), 3)
    assert book[0][:2] == ["file_stem", "analysis_range_name"]
    assert len(book) == 3
    names = [x for f in (out / "allele_calling" / "consensus_mid").glob("part-*") for x in f.read_text().split() if x[0] == ">"]
    assert any(n.startswith(">s1_cluster01_n") and n.endswith("_mid") for n in names)
    reads_out = spark.read.option("header", True).option("sep", "\t").csv(str(out / "repeat_detection" / "per_read"))
    assert reads_out.count() == 16
    assert (out / "allele_calling" / "variants_csv").exists()
    page = (out / "visualisation" / "visualisation.html").read_text()
    assert "<svg" in page and "<h2>histogram</h2>" in page and "repeat_histogram_binwidth" in page
    page = (out / "range_analysis" / "range_analysis.html").read_text()
    assert all(f"<h2>{t}</h2>" in page for t in ("modal peaks", "distribution summary")) and "<td>s1</td>" in page
    assert {w for _, w in plan(spark, config) if _ not in (5, 7)} == {"SKIP"}
    changed = Config(**{**config.__dict__, "rpt_min_repeats": 3})
    assert dict(plan(spark, changed))[2] == "SKIP"
    assert dict(plan(spark, changed))[3] == "RUN"
    said = sinks.StageStore(spark, str(out)).manifest("allele_calling")["tables"]
    assert {t["object"]: t["description"] for t in said}["variants"].startswith("differences")
    assert all(t["bytes"] > 0 and t["size"].endswith("B") for t in said)
    log = (out / "run_log.txt").read_text().splitlines()
    assert "rpt_pattern: CAG" in log and log[-1].startswith("Total")
    assert Timing({"a": 1.0, "b": 2.0}).table()[-1][1] == 3.0


def test_unfinished_module_resumes_behind_its_last_table(spark, tmp_path):
    store = sinks.StageStore(spark, str(tmp_path))
    store.keeper("m", "d1")("root", spark.range(3))
    later = store.keeper("m", "d1", True)("root", spark.range(99))
    assert later.count() == 3
    assert store.keeper("m", "d2", True)("root", spark.range(4)).count() == 4
    assert store.keeper("m", "d2")("root", spark.range(5)).count() == 5
    done = store.save("m", {"root": spark.range(5), "more": spark.range(2)}, "d2")
    assert {k: v.count() for k, v in done.items()} == {"root": 5, "more": 2}


def test_empty_tables_stay_out_of_workbooks(spark, tmp_path):
    config = Config(dir_out=str(tmp_path))
    full, none = spark.createDataFrame([("s", 1)], "file_stem string, n int"), spark.createDataFrame([], "file_stem string, n int")
    exports.export_module(spark, config, 7, "visualisation", {"histogram": none})
    assert not (tmp_path / "visualisation" / "visualisation.xlsx").exists()
    exports.export_module(spark, config, 6, "range_analysis", {"ranges": full, "modal_peaks": none})
    with zipfile.ZipFile(tmp_path / "range_analysis" / "range_analysis.xlsx") as z:
        assert z.read("xl/workbook.xml").count(b"<sheet ") == 1


def test_stream(spark, tmp_path):
    folder = tmp_path / "in"
    rows = spark.createDataFrame([("s", f"q{i}", float(i % 3)) for i in range(9)], ingest.COUNTS)
    rows.write.parquet(str(folder))
    q = ingest.maintain_length_freq(ingest.stream_counts(spark, str(folder)), str(tmp_path / "out"), str(tmp_path / "cp"))
    q.awaitTermination(120)
    assert {r.length: r.freq for r in ingest.read_length_freq(spark, str(tmp_path / "out")).collect()} == {0.0: 3, 1.0: 3, 2.0: 3}
    spark.createDataFrame([("s", "q9", 2.0), ("t", "q0", 2.0), ("t", "q1", None)], ingest.COUNTS).coalesce(1).write.mode("append").parquet(str(folder))
    ingest.maintain_length_freq(ingest.stream_counts(spark, str(folder)), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination(120)
    want = {("s", 0.0): 3, ("s", 1.0): 3, ("s", 2.0): 4, ("t", 2.0): 1}
    assert {(r.file_stem, r.length): r.freq for r in ingest.read_length_freq(spark, str(tmp_path / "out")).collect()} == want
    newest = max(p for p in (tmp_path / "out").iterdir() if p.name.startswith("batch="))
    assert spark.read.parquet(str(newest)).count() == 2
    ingest.compact_length_freq(spark, str(tmp_path / "out"), str(tmp_path / "new"))
    assert {(r.file_stem, r.length): r.freq for r in ingest.read_length_freq(spark, str(tmp_path / "new")).collect()} == want


ODD = ["s1", "s 2", "a/b", "50%", "x=y", "ü", "[z]^", None]


def test_counts_have_one_file_for_each_sample(spark, tmp_path):
    """However many tasks hold its rows; the number of files is what a run with many samples takes its time for."""
    texts = ["plain", "tab\there", 'quo"te', " spaces ", "", None, "back\\slash", "é"]
    rows = [(ODD[i % len(ODD)], f"q{i}", float(i) if i % 5 else None, i, texts[i % 7]) for i in range(400)]
    df = spark.createDataFrame(rows, "file_stem string, qname string, repeat_count_full double, repeat_count_match int, repeat_count_tracts string").repartition(16)
    path = str(tmp_path / "counts")
    sinks.write_counts(df, path)
    sinks.write_counts(df, path)  # again, over what is there
    files = [p for p in (tmp_path / "counts").rglob("*.gz") if not p.name.startswith(".")]
    assert len(files) == len(ODD)
    assert all(gzip.decompress(p.read_bytes()).startswith(b"read_id\trepeat_count_full\trepeat_count_match\trepeat_count_tracts\n") for p in files)
    plain = str(tmp_path / "plain")
    df.select("file_stem", F.col("qname").alias("read_id"), "repeat_count_full", "repeat_count_match", "repeat_count_tracts").write.partitionBy("file_stem").option("sep", "\t").option("header", True).csv(plain)
    kinds = "read_id string, repeat_count_full double, repeat_count_match int, repeat_count_tracts string, file_stem string"
    got, want = (sorted(map(repr, spark.read.schema(kinds).option("header", True).option("sep", "\t").csv(p).collect())) for p in (path, plain))
    assert got == want
    assert {p.name for p in (tmp_path / "counts").iterdir()} >= {p.name for p in (tmp_path / "plain").iterdir() if p.is_dir()}


def test_split_has_one_file_for_each_key(spark, tmp_path):
    rows = [(ODD[i % len(ODD)], f"q{i}", i) for i in range(400)]
    df = spark.createDataFrame(rows, "k string, qname string, n long").repartition(16)
    path = str(tmp_path / "split")
    sinks.write_split(df, "k", path)
    assert len([p for p in (tmp_path / "split").rglob("*.parquet")]) == len(ODD)
    assert sorted(map(repr, map(tuple, spark.read.schema("k string, qname string, n long").parquet(path).select("k", "qname", "n").collect()))) == sorted(map(repr, rows))
    sinks.write_split(df.limit(0), "k", path)
    assert spark.read.schema("k string, qname string, n long").parquet(path).count() == 0
