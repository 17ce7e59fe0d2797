"""Connected components by alternating large-star and small-star rounds, all state in checkpointed tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridmill.llm.common import shared_dir


def _large(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()


def _small(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()


def components(edges: DataFrame, rounds: int = 50) -> DataFrame:
    """(node, component) for every node of the edges (u, v), the component being its smallest node.

    Self-links and repeated edges are harmless; no edges give no rows. A node without
    an edge is not listed. Each round writes its edges to the checkpoint folder; the
    work ends when a round changes nothing.
    """
    spark = edges.sparkSession
    if not spark.sparkContext.getCheckpointDir():
        shared_dir(spark)
    edges = edges.select("u", "v").filter("u <> v").distinct().checkpoint()
    state = None
    for _ in range(rounds):
        edges = _small(_large(edges)).checkpoint()
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        state = now
    raise RuntimeError(f"components did not settle in {rounds} rounds")
