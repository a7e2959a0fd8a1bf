"""Connected components of an edge table by alternating large and small stars.

Each round's edges are written to the shared folder, so that a lost executor costs one round at most and hot nodes are plain scans
that adaptive execution may split; a round's tables go when the next one's are there.

Cases: loops, repeated edges and edges given in both directions count once; edges with a null end are ignored; an empty table gives no row;
nodes without an edge don't occur; other columns of the edge table are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common


def components(edges: DataFrame, a: str = "a", b: str = "b", rounds: int = 60) -> DataFrame:
    """(node, root) for every node of the edge table; root is the least node that can be reached."""
    spark = edges.sparkSession
    now = edges.select(F.least(a, b).alias("low"), F.greatest(a, b).alias("high")).filter(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("low") < F.col("high"))).distinct()
    seen, folder = None, common.new_folder(spark, "edges")
    now = common.staged(now, "edges", True, folder)
    for _ in range(rounds):
        with common.scratch(spark) as stage:
            # Large star: every larger neighbour of a node is tied to the least of its neighbourhood.
            ends = now.select(F.col("high").alias("node"), F.col("low").alias("other")).unionAll(now.select(F.col("low").alias("node"), F.col("high").alias("other")))
            least = ends.groupBy("node").agg(F.least(F.min("other"), F.first("node")).alias("top"))
            large = ends.filter("other > node").join(least, "node").select(F.col("other").alias("high"), F.col("top").alias("low")).filter("low < high").distinct()
            # Small star: a node's smaller neighbours and itself are tied to the least of them.
            large = stage(large, "large", True)
            floor = large.groupBy("high").agg(F.min("low").alias("top"))
            small = large.join(floor, "high").select("high", "low", "top")
            small = small.select(F.col("low").alias("high"), F.col("top").alias("low")).unionAll(small.select("high", F.col("top").alias("low")))
            done, folder = folder, common.new_folder(spark, "edges")
            now = common.staged(small.filter("low < high").distinct(), "edges", True, folder)
        common.release(spark, done)
        state = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("high", "low").cast("decimal(38,0)")).alias("s")).first()
        if seen == tuple(state):
            break
        seen = tuple(state)
    else:
        raise RuntimeError(f"no fixed point in {rounds} rounds")
    leaves = now.select(F.col("high").alias("node"), F.col("low").alias("root"))
    return leaves.unionAll(now.select(F.col("low").alias("node"), F.col("low").alias("root")).distinct())
