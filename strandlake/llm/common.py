"""Helpers shared by the training-data operators: shared storage, tables, safe names."""

from __future__ import annotations

import atexit
import contextlib
import gc
import re
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT = "spark.checkpoint.dir"
#: Rows that a broadcast table may have; beyond it the join is shuffled.
BROADCAST_ROWS = 1_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table, read by Spark (so any store that Spark reaches will do)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: one for this application inside the folder that the session names.

    Where ``spark.checkpoint.dir`` is unset and everything runs on one machine (a local master, as in tests), a temporary folder is made and set, which
    goes when Python ends; on a cluster it must be set. Results are read from stage tables lazily: ``release_all`` removes them once results are read.
    """
    found = spark.sparkContext.getConf().get(CHECKPOINT) or spark.conf.get(CHECKPOINT, None)
    if not found:
        if not one_machine(spark):
            raise ValueError(f"{CHECKPOINT} must name a folder that all executors share")
        own = tempfile.mkdtemp(prefix="strandlake-")
        atexit.register(shutil.rmtree, own, ignore_errors=True)
        found = f"file://{own}"
        spark.conf.set(CHECKPOINT, found)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(found)
    return f"{found.rstrip('/')}/strandlake-{spark.sparkContext.applicationId}"


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder name in the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def staged(df: DataFrame, label: str, narrow: bool = False, folder: str | None = None) -> DataFrame:
    """``df`` written to the shared folder and read again: lineage ends there, lost executors lose nothing.

    ``narrow``: for rows of a few numbers, no more files than the cluster has cores, as each file costs far more than its rows.
    """
    spark = df.sparkSession
    folder = folder or new_folder(spark, label)
    (df.coalesce(spark.sparkContext.defaultParallelism) if narrow else df).write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def release(spark: SparkSession, folder: str) -> None:
    """Deletes one folder made by ``new_folder`` through Spark's own file system layer."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def release_all(spark: SparkSession) -> None:
    """Deletes every stage table of this application; results not read yet are lost."""
    release(spark, shared_dir(spark))


def one_machine(spark: SparkSession) -> bool:
    """Whether driver and executor are one process."""
    return bool(re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master))


def free_memory(spark: SparkSession) -> None:
    """Has driver and executors collect their garbage.

    Spark deletes the shuffle files of plans that nothing holds any more at a collection of the driver's garbage only, and an executor's heap, once grown, is
    given back to the machine, with buffers and generated classes that nothing holds, at a full collection only. There is a task for each core, so that each
    executor gets some; one that gets none is as it was.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    if not one_machine(spark):
        cores = spark.sparkContext.defaultParallelism
        spark.range(0, cores, 1, cores).select(F.expr("java_method('java.lang.System', 'gc')")).write.format("noop").mode("overwrite").save()


@contextlib.contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[..., DataFrame]]:
    """``staged`` for tables that nothing reads after the block: they are deleted at its end."""
    made: list[str] = []

    def stage(df: DataFrame, label: str, narrow: bool = False) -> DataFrame:
        made.append(new_folder(spark, label))
        return staged(df, label, narrow, made[-1])

    try:
        yield stage
    finally:
        for folder in made:
            release(spark, folder)


def free_name(df: DataFrame, base: str) -> str:
    """A column name that ``df`` doesn't have (Spark compares names without case)."""
    taken = {c.lower() for c in df.columns}
    name = base
    while name.lower() in taken:
        name += "_"
    return name


def slices(batches: Iterator[pa.RecordBatch], column: int, rows: int = 1000, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The rows of Arrow batches in slices of at most ``rows`` rows and, by the texts of one column, ``most`` bytes; a longer text is alone.

    Spark bounds what it sends at once by rows and bytes of its own; slices bound the Python objects that are made of it.
    """
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))
        at = 0
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            end = max(at + 1, min(at + rows, int(np.searchsorted(ends, before + most, "right"))))
            yield batch.slice(at, end - at)
            at = end
