"""New sample files as a stream: reads counted into the frequency table as they arrive.

The batch engine needs no stream; this is the continuous form of its frequency table, for cohorts that grow.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

COUNTS = "file_stem string, qname string, repeat_count double"


def stream_counts(spark: SparkSession, folder: str, schema: str = COUNTS, files_at_once: int = 100) -> DataFrame:
    """Parquet files of per-read counts that appear in a folder."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_at_once).parquet(folder)


def stream_length_freq(counts: DataFrame) -> DataFrame:
    """Reads of every sample and length so far."""
    return counts.filter("repeat_count is not null").groupBy("file_stem", F.col("repeat_count").alias("length")).agg(F.count("*").alias("freq"))


def maintain_length_freq(counts: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Keeps the frequency table of a stream below ``target`` as Parquet: each batch adds a folder of its own counts only, so its cost is that of what is new.

    ``read_length_freq`` adds them up. A batch that runs again after a failure writes the same folder anew.
    """

    def write(df: DataFrame, epoch: int) -> None:
        stream_length_freq(df).write.mode("overwrite").parquet(f"{target}/batch={epoch:012d}")

    return counts.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def read_length_freq(spark: SparkSession, target: str) -> DataFrame:
    """file_stem, length, freq of everything that has arrived."""
    return spark.read.parquet(target).groupBy("file_stem", "length").agg(F.sum("freq").alias("freq"))


def compact_length_freq(spark: SparkSession, target: str, into: str) -> None:
    """The sums of all batches as one table, to begin a new target with when the folders have become many."""
    read_length_freq(spark, target).write.mode("overwrite").parquet(f"{into}/batch={0:012d}")


def windowed_counts(events: DataFrame, late: str = "1 hour", size: str = "1 day") -> DataFrame:
    """Reads by sample and arrival window, with late rows accepted up to the watermark."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", size), "file_stem").agg(F.count("*").alias("n_reads"), F.avg("repeat_count").alias("mean_count"))
