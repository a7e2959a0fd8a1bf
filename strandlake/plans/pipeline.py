"""The modules of a run as lazy stages: each reads the tables of those before it and saves its own.

A module is skipped where its tables are there and were made with the same parameters. Inside a module every table that others follow from is written
first (``keep``) and read from there, so aligner, tract finder, clustering and consensus run once, and a run that failed begins again behind the last one.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import asdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import ship
from ..functions.brackets import expand_settings
from ..operators import alignments, clusters, consensus, ranges, reads, repeats
from ..operators.aligner import align
from ..sources import catalog, sequences, sinks, tables
from . import exports, plotdata
from .config import Config, Timing

Keep = Callable[[str, DataFrame], DataFrame]
NAMES = {1: "import_and_qc", 2: "alignment", 3: "repeat_detection", 4: "allele_calling", 5: "waterfall", 6: "range_analysis", 7: "visualisation"}


def module1(spark: SparkSession, config: Config, done: dict, keep: Keep) -> dict[str, DataFrame]:
    files = catalog.catalog(catalog.discover(spark, config.dir_data, config.import_patterns, config.import_recursive), config.r1_pattern, config.r2_pattern, config.select_one_of_pair)
    wanted = files.filter("include").select("file_format", "file_path").collect()  # one row for each file
    by: dict[str, list[str]] = {}
    for row in wanted:
        by.setdefault(row["file_format"], []).append(row["file_path"])
    if not by:
        raise FileNotFoundError(f"no sample files in {config.dir_data}")
    found = None
    for kind, paths in sorted(by.items()):
        part = [sequences.read_sequences(spark, p, kind) for p in paths] if kind == "bam" else [sequences.read_sequences(spark, paths, kind)]
        for df in part:
            found = df if found is None else found.unionByName(df)
    multiplicity = reads.name_multiplicity(found)
    kept = reads.longest_per_name(found) if config.check_duplicate_readnames else found
    kept = reads.downsample(kept, config.downsample) if config.downsample else kept
    trimmed = bool(config.trim and config.path_trim_patterns)
    kept = keep("untrimmed" if trimmed else "reads", kept)
    multiplicity, quality = keep("multiplicity", multiplicity), keep("read_qc", reads.read_quality(kept))
    out = {"file_details": files, "multiplicity": multiplicity, "duplication": reads.duplication_rate(multiplicity), "read_qc": quality, "qc_summary": reads.quality_summary(quality)}
    if trimmed:
        adapters = tables.read_adapters(spark, config.path_trim_patterns)
        places = keep("trim_locations", reads.trim_locations(kept, adapters, config.trim_max_mismatch, config.trim_with_indels))
        out |= {"untrimmed": kept, "trim_locations": places, "trim_by_adapter": reads.trim_by_adapter(places), "trim_by_side": reads.trim_by_side(places), "trim_by_sample_side": reads.trim_by_side(places, True)}
        kept = keep("reads", reads.trim_reads(kept, adapters, config.trim_max_mismatch, config.trim_with_indels))
    return out | {"reads": kept, "final_summary": reads.final_summary(kept)}


def module2(spark: SparkSession, config: Config, done: dict, keep: Keep) -> dict[str, DataFrame]:
    refs = tables.read_reference(spark, config.path_ref)
    raw = keep("alignments", align(done[1]["reads"], refs, config.align_seed, config.align_least_score))
    both = keep("dual_flank", alignments.dual_flank(raw))
    turned = alignments.correct_strand(both)
    ordered = alignments.ordered_flanks(turned)
    kept = alignments.exclude_reads(ordered, tables.read_exclusions(spark, config.path_manual_exclusions))
    split = keep("split", alignments.split_segments(kept))
    return {
        "alignments": raw, "dual_flank": both, "alignment_summary": alignments.alignment_summary(raw), "filtering": reads.compare_read_counts(raw.select("file_stem", "qname").distinct(), both.select("file_stem", "qname").distinct()),
        "strands": alignments.strand_summary(turned), "order": alignments.order_summary(turned), "quality": alignments.flank_quality(turned), "split": split, "segments": alignments.segment_summary(split),
    }


def module3(spark: SparkSession, config: Config, done: dict, keep: Keep) -> dict[str, DataFrame]:
    options = dict(min_repeats=config.rpt_min_repeats, mismatches=config.rpt_max_mismatch, start_perfect=config.rpt_start_perfect_repeats, end_perfect=config.rpt_end_perfect_repeats, max_gap=config.rpt_max_gap, max_tract_gap=config.rpt_max_tract_gap, choice=config.rpt_return_option)
    counted = keep("detected", repeats.detect_repeats(done[2]["split"].select("file_stem", "qname", "ref_id", "left", "mid", "right"), config.rpt_pattern, config.repeat_count_method, **options))
    detection = repeats.detection_summary(counted)
    rows = repeats.missing_counts(counted, config.na_repeat_handling)
    rows = repeats.flank_filter(rows, config.flank_iqr_multiplier) if config.rm_flank_length_outliers else rows
    rows = keep("repeat_counts", rows.select("file_stem", "qname", "ref_id", "left", "mid", "right", "repeat_count", "repeat_count_full", "repeat_count_match", "repeat_count_tracts"))
    return {"detected": counted, "repeat_counts": rows, "detection": detection, "methods": repeats.method_comparison(rows), "flanks": repeats.flank_summary(rows), "sweep": repeats.fence_sweep(rows), "repeat_summary": repeats.repeat_summary(rows), "heatmap": repeats.heatmap(rows)}


def module4(spark: SparkSession, config: Config, done: dict, keep: Keep) -> dict[str, DataFrame]:
    rows = clusters.assign_clusters(done[3]["repeat_counts"], config.cluster_by if config.cluster else None, config.repeat_cluster_max, config.haplotype_method, config.haplotype_cluster_downsample, config.haplotype_region, config.haplotype_trim_length)
    rows = keep("assigned", clusters.renumber(keep("numbered", rows)))
    summary = clusters.cluster_summary(rows)
    out = {"assigned": rows, "clusters": rows.select("file_stem", "qname", "cluster_number", "repeat_cluster", "haplotype_cluster"), "cluster_summary": summary, "cluster_sizes": clusters.clusters_per_sample(rows)}
    if config.cluster_consensus:
        made = keep("consensus", consensus.cluster_consensus(rows, config.consensus_threshold, config.consensus_downsample))
        out["consensus"] = made
        if config.call_variants:
            refs = tables.read_reference(spark, config.path_ref)
            whole = keep("variants", consensus.variants(made, refs[0][3] + refs[1][3]))
            out |= {"variants": whole, "variant_summary": consensus.variant_summary(whole)}
    return out


def joined_reads(done: dict) -> DataFrame:
    return done[3]["repeat_counts"].join(done[4]["clusters"], ["file_stem", "qname"], "left")


def module5(spark: SparkSession, config: Config, done: dict, keep: Keep) -> dict[str, DataFrame]:
    rows = joined_reads(done)
    order = plotdata.waterfall_order(plotdata.waterfall_rows(rows), config.waterfall_downsample)
    return {"waterfall_summary": plotdata.waterfall_summary(rows), "waterfall": plotdata.waterfall_bases(order)}


def module6(spark: SparkSession, config: Config, done: dict, keep: Keep) -> dict[str, DataFrame]:
    settings = tables.read_settings(spark, config.path_settings)
    meta = settings.select("file_stem", "group", "group_control_sample", F.col("time").try_cast("double").alias("time"), "exclude")
    counts = ranges.sample_counts(joined_reads(done))
    bounded = keep("bounds", ranges.range_bounds(expand_settings(settings), counts).join(counts.select("file_stem").distinct(), "file_stem", "left_semi"))
    freq = keep("length_freq", ranges.length_freq(counts, bounded))
    summary = keep("distribution_summary", ranges.distribution_summary(freq, bounded))
    peaks = keep("modal_peaks", ranges.modal_peaks(freq, bounded, config.range_peak_span))
    picked = ranges.control_samples(summary, meta, config.control_setpoint_metric, config.control_sample_selection, config.strict_flags)
    controls = ranges.control_setpoints(picked if config.group_control else picked.limit(0), config.control_setpoint_metric, config.control_aggregation_method)
    whole = ranges.comprehensive_summary(ranges.range_boundaries(bounded, freq), peaks, summary, meta)
    points = ranges.setpoints(summary, meta, controls, config.control_setpoint_metric)
    return {"bounds": bounded, "ranges": ranges.range_boundaries(bounded, freq), "length_freq": freq, "modal_peaks": peaks, "distribution_summary": summary, "group_controls": controls, "instability_metrics": ranges.instability(freq, points), "comprehensive_range_summary": whole, "experiment": plotdata.experiment_map(meta)}


def module7(spark: SparkSession, config: Config, done: dict, keep: Keep) -> dict[str, DataFrame]:
    return {"histogram": plotdata.histogram(done[3]["repeat_counts"], config.repeat_histogram_binwidth), "density": plotdata.tagged_density(done[6]["length_freq"])}


MODULES = {1: module1, 2: module2, 3: module3, 4: module4, 5: module5, 6: module6, 7: module7}
NEEDS = {1: (), 2: (1,), 3: (2,), 4: (3,), 5: (3, 4), 6: (3, 4), 7: (3, 6)}


def run_log(config: Config, timing: Timing) -> str:
    """The parameters of a run and the time of each module, as text."""
    said = [f"{k}: {v}" for k, v in sorted(asdict(config).items())]
    return "\n".join(["parameters", *said, "", "modules", *("\t".join(map(str, row)) for row in timing.table()), ""])


def plan(spark: SparkSession, config: Config) -> list[tuple[int, str]]:
    """What a run would do with each module: RUN or SKIP."""
    store = sinks.StageStore(spark, config.dir_out)
    rerun = False
    out = []
    for m in config.run_modules:
        skip = (m == 5 and not config.waterfall) or (config.resume and not rerun and store.fresh(NAMES[m], config.digest(m)))
        rerun |= not skip and m != 5
        out.append((m, "SKIP" if skip else "RUN"))
    return out


def run(spark: SparkSession, config: Config) -> dict[int, dict[str, DataFrame]]:
    """Runs the chosen modules; returns the saved tables of every module that was run or skipped as fresh."""
    ship(spark)
    store, timing, done = sinks.StageStore(spark, config.dir_out), Timing(), {}
    for m, what in plan(spark, config):
        if config.dry_run:
            print(f"[{what}] module {m}: {NAMES[m]}")
            continue
        if what == "RUN":
            began = time.monotonic()
            for need in NEEDS[m]:
                done.setdefault(need, None)
                done[need] = done[need] or store.load(NAMES[need])
            keep = store.keeper(NAMES[m], config.digest(m), config.resume and not timing.seconds)
            done[m] = store.save(NAMES[m], MODULES[m](spark, config, done, keep), config.digest(m))
            timing.seconds[NAMES[m]] = time.monotonic() - began
            exports.export_module(spark, config, m, NAMES[m], done[m])
        elif not (m == 5 and not config.waterfall):
            done[m] = store.load(NAMES[m])
    if timing.seconds:
        sinks.write_bytes(spark, f"{config.dir_out}/run_log.txt", run_log(config, timing).encode())
        spark.createDataFrame(timing.table(), "module string, seconds double, elapsed string, cumulative double").write.mode("overwrite").parquet(f"{config.dir_out}/timing")
    return done
