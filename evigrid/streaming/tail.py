"""Incremental runs: landed pages as a stream, deduplicated within the cache time, fed to a batch plan."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.text import content_hash, normalize_url

# How long a fetched page counts as fresh, and how often a tail looks for new ones.
CACHE_HOURS, TAIL_SECONDS = 24, 300


def landed_stream(spark: SparkSession, folder: str, schema: StructType) -> DataFrame:
    return spark.readStream.schema(schema).parquet(folder)


def fresh(pages: DataFrame, url: str = "target_url", at: str = "fetched_at", content: str = "content") -> DataFrame:
    """Pages whose URL and content were not seen within the cache time, late rows included up to it."""
    keyed = pages.withColumns({"normalized_url": normalize_url(F.col(url)), "content_hash": content_hash(F.col(content))})
    return keyed.withWatermark(at, f"{CACHE_HOURS} hours").dropDuplicatesWithinWatermark(["normalized_url", "content_hash"])


def tail(pages: DataFrame, batch: Callable[[DataFrame, int], None], checkpoint: str, once: bool = False, seconds: int = TAIL_SECONDS):
    """Feed each micro-batch to a batch plan; ``once`` takes what is there and stops."""
    writer = pages.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime=f"{seconds} seconds")).start()
