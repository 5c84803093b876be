"""Connected components of a distributed edge table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import remove, stored


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Link each node's neighbours to the least node near it: larger ones (large star) or smaller ones (small star)."""
    if large:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        both = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    linked = both.join(least, "u")
    if large:
        out = linked.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = linked.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
    return out.where("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """Nodes of ``edges`` (long columns ``u``, ``v``) with the least node they reach.

    Returns ``node``, ``root``; roots themselves are included. Every round is written to the shared
    folder, so a lost executor repeats one round at most. Rounds grow with the logarithm of the
    longest chain. A hot node is only ever aggregated with map-side combine or joined with a table
    of one row per node, which adaptive execution splits.
    """
    spark = edges.sparkSession
    now, path = stored(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "star")
    before = None
    while True:
        big, big_path = stored(_star(now, True), "star")
        small, small_path = stored(_star(big, False), "star")
        state = small.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        remove(spark, path, big_path)
        now, path = small, small_path
        if before == tuple(state):
            break
        before = tuple(state)
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
