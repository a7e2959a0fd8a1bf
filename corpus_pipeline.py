"""The corpus pipeline: stages of training-data operators over ``documents``.

Each stage takes all that the one before it kept. The first four return the columns of ``documents``; the last one the packing plan of what is left.

Cases: null and empty texts are rejected by language identification; later stages, should they meet one, keep it (one of all empty texts in near-dedup) and pack it as
one piece. Rows with a null id are judged like any other: near-dedup removes none of them, decontamination takes them as one document. Repeated rows are judged
alike; near-dedup keeps all rows of the id that stays. Texts are held whole, one task a few at a time. Empty tables give empty tables, and extra columns
pass through the first four stages whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strandlake import ship
from strandlake.llm import common, decontam, langid, packing, simhash, toxicity


def _begin(spark: SparkSession) -> None:
    """Workers get the source; what the stage before left in the executors' memory goes."""
    ship(spark)
    common.free_memory(spark)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that language identification rejects go."""
    _begin(spark)
    return langid.keep_accepted(docs)


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity reaches the threshold go; the machine learns from the labels of those that are here."""
    _begin(spark)
    return toxicity.keep_clean(docs, common.table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    _begin(spark)
    return simhash.keep_first(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that an item of the benchmark leaks into go."""
    _begin(spark)
    return decontam.keep_uncontaminated(docs, common.table(spark, sf_dir, "benchmark"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of what is left with its place in a sequence."""
    _begin(spark)
    return packing.pack(docs)


STAGES = [
    ("language_id", language_id),
    ("toxicity", toxicity_filter),
    ("simhash_near_dedup", near_dedup),
    ("benchmark_decontamination", decontamination),
    ("best_fit_packing", best_fit_packing),
]
#: SQL can't express the trained stages; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies STAGES to ``documents``; each stage's rows are written as Parquet and read again for the next."""
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = common.staged(stage(spark, docs, sf_dir), name)
    return docs
