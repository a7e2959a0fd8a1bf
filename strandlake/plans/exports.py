"""Files of a run beside its stage tables: workbooks and reports of summaries, consensus FASTA, variants as CSV and VCF.

Files of many samples are written by the executors, one folder for each sample; only workbooks of small summary tables are made on the driver.
"""

from __future__ import annotations

from datetime import date
from html import escape

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.consensus import vcf_rows
from ..sources import sinks, tables
from .config import Config

#: Tables of each module that go into its workbook where they have rows: summaries, a row for a sample, cluster or range.
WORKBOOKS = {
    1: ("qc", ("file_details", "duplication", "qc_summary", "final_summary")),
    2: ("alignment", ("alignment_summary", "filtering", "strands", "order", "quality", "segments")),
    3: ("repeat_detection", ("detection", "methods", "flanks", "sweep", "repeat_summary")),
    4: ("allele_calling", ("cluster_summary", "cluster_sizes", "variant_summary")),
    5: ("waterfall", ("waterfall_summary",)),
    6: ("range_analysis", ("ranges", "modal_peaks", "distribution_summary", "group_controls", "instability_metrics", "comprehensive_range_summary")),
    7: ("visualisation", ("histogram",)),
}


def vcf_lines(variants: DataFrame, contig: str, length: int, reference: str, group: str = "file_stem", column: str = "cluster") -> DataFrame:
    """(group, place, value): the lines of one VCF 4.2 for each group, with a genotype column for each of its ``column`` names.

    Groups without a variant that a VCF can hold have no lines.
    """
    kept = vcf_rows(variants)
    names = kept.groupBy(group).agg(F.sort_array(F.collect_set(column)).alias("_names"))
    fixed = [
        "##fileformat=VCFv4.2", f"##fileDate={date.today():%Y%m%d}", "##source=strandlake", f"##reference={reference}", f"##contig=<ID={contig},length={length}>",
        '##INFO=<ID=TYPE,Number=1,Type=String,Description="Kind of difference from the reference: mismatch, insertion or deletion">', '##FORMAT=<ID=GT,Number=1,Type=String,Description="Genotype">',
    ]
    top = F.concat_ws("\t", *map(F.lit, ("#CHROM", "POS", "ID", "REF", "ALT", "QUAL", "FILTER", "INFO", "FORMAT")), F.col("_names"))
    head = names.select(group, F.posexplode(F.array(*map(F.lit, fixed), top)).alias("_i", "value")).select(group, (F.col("_i") - 100).cast("long").alias("place"), "value")
    found = kept.groupBy(group, "position", "ref", "query", "variant_type").agg(F.collect_set(column).alias("_who")).join(names, group)
    order = F.row_number().over(Window.partitionBy(group).orderBy("position", "ref", "query", "variant_type"))
    genotypes = F.transform("_names", lambda n: F.when(F.array_contains("_who", n), "0/1").otherwise("0/0"))
    value = F.concat_ws("\t", F.lit(contig), F.col("position").cast("string"), F.lit("."), "ref", "query", F.lit("."), F.lit("PASS"), F.concat(F.lit("TYPE="), "variant_type"), F.lit("GT"), genotypes)
    return head.unionByName(found.select(group, order.cast("long").alias("place"), value.alias("value")))


def write_lines(lines: DataFrame, path: str, group: str = "file_stem") -> None:
    """Ordered lines as text, one folder and file for each group."""
    lines.repartition(group).sortWithinPartitions(group, "place").select(group, "value").write.partitionBy(group).mode("overwrite").text(path)


def export_consensus(done: dict[str, DataFrame], path: str) -> None:
    """Four FASTA folders: the whole consensus and its segments; clusters without a sequence are left out."""
    share = F.col("n_reads") / F.sum("n_reads").over(Window.partitionBy("file_stem"))
    stats = done["cluster_summary"].select("file_stem", "cluster_number", "mode", share.alias("proportion"))
    rows = done["consensus"].join(stats, ["file_stem", "cluster_number"], "left")
    for part in ("full", "left", "mid", "right"):
        named = sinks.consensus_names(rows, "" if part == "full" else part).filter(F.col(f"consensus_{part}").isNotNull())
        sinks.write_fasta(named, f"{path}/consensus_{part}", sequence=f"consensus_{part}")


def write_variants(variants: DataFrame, path: str) -> None:
    """All variants as CSV, a folder of parts."""
    variants.withColumnRenamed("position", "position_on_reference").write.mode("overwrite").option("header", True).csv(f"{path}/variants_csv")


def export_variants(variants: DataFrame, refs: list[tuple[str, str, str, str]], reference: str, path: str) -> None:
    """All variants as CSV; substitutions as VCF, one for each sample and one for the cohort."""
    write_variants(variants, path)
    rows = variants.withColumn("cluster", F.concat(F.lit("cluster"), F.col("cluster_number").cast("string")))
    length = sum(len(r[3]) for r in refs)
    write_lines(vcf_lines(rows, refs[0][1], length, reference), f"{path}/vcf_by_sample")
    cohort = rows.withColumns({"cohort": F.lit("all_samples"), "cluster": F.concat("file_stem", F.lit("_"), "cluster")})
    write_lines(vcf_lines(cohort, refs[0][1], length, reference, "cohort"), f"{path}/vcf_combined", "cohort")


def bars(rows: list[tuple[str, float]], width: int = 600) -> str:
    """A bar chart as SVG: (label, value) from top to bottom."""
    most = max((v for _, v in rows), default=0) or 1
    parts = [f'<text x="0" y="{16 * i + 12}">{escape(label)}</text><rect x="120" y="{16 * i + 2}" width="{(width - 200) * v / most:.1f}" height="12"/><text x="{125 + (width - 200) * v / most:.1f}" y="{16 * i + 12}">{v:g}</text>' for i, (label, v) in enumerate(rows)]
    return f'<svg xmlns="http://www.w3.org/2000/svg" width="{width}" height="{16 * len(rows) + 4}" font-size="11" fill="#345">{"".join(parts)}</svg>'


def report(title: str, said: dict, tables: dict[str, DataFrame], most: int = 200) -> str:
    """A page with a module's parameters and its summary tables: their first ``most`` rows and how many there are; the tables hold them all."""
    cell = lambda v: "" if v is None else escape(f"{v:.6g}" if isinstance(v, float) else str(v))
    line = lambda tag, values: "<tr>" + "".join(f"<{tag}>{cell(v)}</{tag}>" for v in values) + "</tr>"
    parts = [f"<h1>{escape(title)}</h1><h2>Parameters</h2><table>{''.join(line('td', x) for x in sorted(said.items()))}</table>"]
    for name, df in tables.items():
        n, rows = df.count(), df.limit(most).collect()
        chart = bars([(f"{r['bin']:g}", r["n"]) for r in df.groupBy("bin").agg(F.sum("n").alias("n")).orderBy("bin").limit(most).collect()]) if {"bin", "n"} <= set(df.columns) else ""
        note = f"<p>{most} of {n} rows</p>" if n > most else ""
        parts.append(f"<h2>{escape(name.replace('_', ' '))}</h2>{chart}{note}<table>{line('th', df.columns)}{''.join(line('td', r) for r in rows)}</table>")
    return f"<!DOCTYPE html><html lang=\"en\"><head><meta charset=\"utf-8\"><title>{escape(title)}</title><style>table{{border-collapse:collapse}}td,th{{border:1px solid #ccc;padding:2px 6px}}</style></head><body>{''.join(parts)}</body></html>"


def export_module(spark: SparkSession, config: Config, module: int, name: str, done: dict[str, DataFrame]) -> None:
    """The files of one module, below its folder."""
    root = f"{config.dir_out}/{name}"
    book, wanted = WORKBOOKS[module]
    chosen = {t: done[t] for t in wanted if t in done and not done[t].isEmpty()}
    if chosen:
        sinks.write_bytes(spark, f"{root}/{book}.xlsx", sinks.workbook(chosen))
        sinks.write_bytes(spark, f"{root}/{book}.html", report(f"Module {module}: {name}", config.of(module), chosen).encode())
    if module == 3 and config.export_read_counts:
        sinks.write_counts(done["repeat_counts"], f"{root}/per_read")
    if module == 4 and "consensus" in done:
        export_consensus(done, root)
        if "variants" in done:
            export_variants(done["variants"], tables.read_reference(spark, config.path_ref), config.path_ref.rpartition("/")[2], root)
