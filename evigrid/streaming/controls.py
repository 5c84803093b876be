"""Controls of a crawl's domains as a stored table that a running stream reads anew at each micro-batch."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import normalize_domain
from ..operators.frontier import path_of
from ..plans.runs import clean_prefix
from ..sources.store import KeyedTable

SCHEMA = "domain string, control string, detail string, amount long, reason string, source string, at long"
HELD = "domain string, quarantined boolean, stop_requested boolean, discovery boolean, max_pages long, suppressed_prefixes array<string>"
# What an action sets.
SETS = {
    "quarantine-seed": ("quarantined",), "suppress-prefix": ("prefix",), "cap-domain": ("max_pages",), "stop-domain": ("stop_requested",), "clear-domain": ("cleared",),
    "auto_quarantine_seed": ("quarantined", "stop_requested", "no_discovery"), "auto_stop_domain": ("stop_requested", "no_discovery"),
    "auto_disable_discovery": ("no_discovery",), "auto_suppress_prefix": ("prefix",),
}


class LiveControls:
    """One row a domain, control and prefix. A change is an upsert: of two writers at once the later is tried again on the other's version, so none is lost."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = 16):
        self.spark, self.table = spark, KeyedTable(spark, root, ["domain", "control", "detail"], buckets)

    def apply(self, action: str, domain: str, reason: str, prefix: str = "", max_pages: int = 0) -> int:
        """An operator's change; clearing a domain ends all that was set before. Gives the version that holds it."""
        if action not in SETS or action.startswith("auto_"):
            raise ValueError(f"unknown action: {action}")
        if action == "cap-domain" and max_pages < 1 or action == "suppress-prefix" and not prefix.strip():
            raise ValueError(f"{action} needs a positive number of pages or a prefix")
        rows = [(domain.strip().lower(), s, clean_prefix(prefix) if s == "prefix" else "", max_pages, reason, "operator", time.time_ns()) for s in SETS[action]]
        return self.table.upsert(self.spark.createDataFrame(rows, SCHEMA), F.col("at"))["version"]

    def record(self, found: DataFrame) -> int:
        """Put a stream's interventions (``domains.domain_stream``) in force. Those recorded before, as when a micro-batch is repeated, change nothing, also after the domain was cleared."""
        sets = F.coalesce(*(F.when(F.col("action") == a, F.array(*map(F.lit, s))) for a, s in SETS.items() if a.startswith("auto_")))
        rows = found.withColumn("control", F.explode(sets)).select(
            "domain", "control", F.when(F.col("control") == "prefix", F.col("detail")).otherwise("").alias("detail"), F.col("event_id").alias("amount"), "reason",
            F.lit("auto").alias("source"), F.lit(time.time_ns()).alias("at"),
        )
        if self.table.versions():
            before = self.table.read().where("source = 'auto'").select("domain", "control", "detail", F.col("amount").alias("_amount"))
            rows = rows.join(before, ["domain", "control", "detail"], "left").where("_amount IS NULL OR _amount < amount").drop("_amount")
        return self.table.upsert(rows, F.col("amount"))["version"]

    def current(self, version: int | None = None) -> DataFrame:
        """What holds for each domain in a version, by default the newest. A domain's prefixes are one array."""
        if not self.table.versions():
            return self.spark.createDataFrame([], HELD)
        rows = self.table.read(version)
        cleared = rows.where("control = 'cleared'").select("domain", F.col("at").alias("_cleared"))
        held = rows.where("control <> 'cleared'").join(cleared, "domain", "left").where("_cleared IS NULL OR at > _cleared")
        has = lambda name: F.coalesce(F.bool_or(F.col("control") == name), F.lit(False))
        return held.groupBy("domain").agg(
            has("quarantined").alias("quarantined"), has("stop_requested").alias("stop_requested"), (~has("no_discovery")).alias("discovery"),
            F.max(F.when(F.col("control") == "max_pages", F.col("amount"))).alias("max_pages"), F.sort_array(F.collect_set(F.when(F.col("control") == "prefix", F.col("detail")))).alias("suppressed_prefixes"),
        )


def admitted(pages: DataFrame, held: DataFrame, url: str = "url", landed: DataFrame | None = None) -> DataFrame:
    """Pages that the controls let through: none of stopped or quarantined domains or below a suppressed prefix, and no more than a cap.

    ``landed`` has ``domain`` and ``pages``, what came before of each; under a cap the rest is filled in
    order of the URL. Only capped domains are ordered. Equal rows count each; a page without a URL has no
    domain and passes. All columns stay.
    """
    path = path_of(F.col(f"_row.{url}"))
    rows = pages.select(F.struct("*").alias("_row"), normalize_domain(F.col(url)).alias("domain"))
    below = F.exists(F.coalesce("suppressed_prefixes", F.array().cast("array<string>")), lambda p: (path == F.rtrim(p, F.lit("/"))) | path.startswith(p))
    open_ = rows.join(held, "domain", "left").where(~F.coalesce(F.col("quarantined") | F.col("stop_requested"), F.lit(False)) & ~below)
    capped = open_.where("max_pages IS NOT NULL")
    if landed is not None:
        capped = capped.join(landed.select("domain", F.col("pages").alias("_before")), "domain", "left")
    else:
        capped = capped.withColumn("_before", F.lit(0))
    place = F.row_number().over(Window.partitionBy("domain").orderBy(f"_row.{url}"))
    kept = capped.withColumn("_place", place).where(F.col("_place") + F.coalesce("_before", F.lit(0)) <= F.col("max_pages"))
    return open_.where("max_pages IS NULL").select("_row").unionByName(kept.select("_row")).select("_row.*")


def live(controls: LiveControls, batch: Callable[[DataFrame, int], None], url: str = "url", landed: Callable[[int], DataFrame] | None = None) -> Callable[[DataFrame, int], None]:
    """``batch`` over what the controls admit, read anew at each micro-batch: for ``foreachBatch`` and ``tail.tail``.

    ``landed`` gives the pages by domain that came before a micro-batch of this number, without its own, so a
    repeated one admits the same pages under the same controls.
    """
    def each(pages: DataFrame, n: int) -> None:
        batch(admitted(pages, controls.current(), url, landed(n) if landed is not None else None), n)

    return each
