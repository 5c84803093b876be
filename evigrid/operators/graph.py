"""Connected components of rows that share keys, by alternating star contraction."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; a temporary one only where that is unset and all runs on one machine, as in tests."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = tempfile.mkdtemp(prefix="evigrid-")
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


def cut(df: DataFrame) -> DataFrame:
    """``df`` written to a table in the shared folder and read from there, which keeps later plans short and survives lost executors."""
    path, schema = f"{shared_folder(df.sparkSession)}/cut-{uuid.uuid4().hex}", df.schema
    df.write.parquet(path)
    return df.sparkSession.read.schema(schema).parquet(path)


def _contracted(edges: DataFrame, large: bool) -> DataFrame:
    """Every node's neighbours linked to the least node near it: the larger ones, or all that are smaller."""
    if large:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        both = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    near = both.join(least, "u")
    if large:
        out = near.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = near.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
    return out.where("u <> v").distinct()


def components(rows: DataFrame, row_id: str, keys: list[str]) -> DataFrame:
    """``rows`` with ``component``: the least id over rows linked by equal non-blank keys, over any number of steps.

    A key's rows are linked to its least row, found with map-side combine, so a hot key is a star and
    not all pairs. Rounds grow with the logarithm of the longest chain; each is written to the
    shared folder, so it survives lost executors.
    """
    each = F.explode(F.array_compact(F.array(*(F.when(F.coalesce(F.col(k).cast("string"), F.lit("")) != "", F.concat(F.lit(f"{k}:"), F.col(k).cast("string"))) for k in keys))))
    held = rows.select(F.col(row_id).alias("u"), each.alias("key"))
    first = held.groupBy("key").agg(F.min("u").alias("v"))
    now = cut(held.join(first, "key").select("u", "v").where("u <> v").distinct())
    before = None
    while True:
        now = cut(_contracted(_contracted(now, True), False))
        state = tuple(now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if state == before:
            break
        before = state
    return rows.join(now.select(F.col("u").alias(row_id), F.col("v").alias("_root")), row_id, "left").withColumn("component", F.coalesce("_root", F.col(row_id))).drop("_root")
