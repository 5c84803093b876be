"""Upserts as folds: the state that ordered writes leave, computed by one aggregation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: What counts as "no value" for a column unless a rule says otherwise.
BLANK = ("",)


def fold_upserts(rows: DataFrame, keys: Sequence[str], order: Column, rules: Mapping[str, Sequence[str]]) -> DataFrame:
    """One row per key: for each column the last value that is not a sentinel, else the first value.

    ``rules`` maps columns to their sentinels. The fold is associative, so it is aggregated before
    the shuffle and a hot key costs one row per task.
    """
    folded = []
    for name, sentinels in rules.items():
        c = F.col(name)
        real = c.isNotNull() & ~c.cast("string").isin(*sentinels)
        # an order struct that ranks real values first picks the last of them without a filter
        folded.append(F.coalesce(F.max_by(F.when(real, c), F.when(real, order)), F.min_by(c, order)).alias(name))
    return rows.groupBy(*keys).agg(*folded)


def replace_upserts(rows: DataFrame, keys: Sequence[str], order: Column) -> DataFrame:
    """The last row of each key."""
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*(c for c in rows.columns if c not in keys)), order).alias("_r")).select(*keys, "_r.*")


def ordered_union(values: Column, order: Column) -> Column:
    """Distinct non-blank values in order of first appearance, as an aggregate."""
    pairs = F.array_sort(F.collect_list(F.when(F.coalesce(values, F.lit("")) != "", F.struct(order.alias("o"), values.alias("v")))))
    return F.array_distinct(F.transform(pairs, lambda x: x["v"]))


def ordered_values(rows: DataFrame, key: str, value: str, order: Column) -> DataFrame:
    """``key``, ``values``: its distinct non-blank values in order of first appearance.

    A value is reduced to its first appearance before a key's values come together, so a hot key costs
    its distinct values only.
    """
    first = rows.where(F.coalesce(F.col(value), F.lit("")) != "").groupBy(key, value).agg(F.min(order).alias("o"))
    return first.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("o", F.col(value).alias("v")))).alias("p")).select(key, F.transform("p", lambda x: x["v"]).alias("values"))


def counters(events: DataFrame, key: str, order: Column, failed: Column, streak: bool = True) -> DataFrame:
    """Attempts, successes, failures and, with ``streak``, the failures since the last success of each key.

    All but the streak is one aggregation with map-side combine. The streak needs the last success
    first: then only failures are read again, those after it are counted, and no window over a key's
    whole history is needed.
    """
    totals = events.groupBy(key).agg(
        F.count("*").alias("attempts"), F.count_if(~failed).alias("successes"), F.count_if(failed).alias("failures"),
        F.max(F.when(~failed, order)).alias("last_success_at"), F.max(F.when(failed, order)).alias("last_failure_at"),
    )
    if not streak:
        return totals
    ends = events.groupBy(key).agg(F.max(F.when(~failed, order)).alias("_last"))
    later = events.where(failed).select(key, order.alias("_at")).join(ends, key).where(F.col("_last").isNull() | (F.col("_at") > F.col("_last")))
    runs = later.groupBy(key).agg(F.count("*").alias("_run"))
    return totals.join(runs, key, "left").withColumn("consecutive_failures", F.coalesce("_run", F.lit(0))).drop("_run").select(
        key, "attempts", "successes", "failures", "consecutive_failures", "last_success_at", "last_failure_at"
    )


def first_per_key(rows: DataFrame, keys: Sequence[str], *order: Column) -> DataFrame:
    """The first row of each key; its rank limit is applied before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def validate(rows: DataFrame, unique: Sequence[Sequence[str]] = (), checks: Mapping[str, Column] | None = None) -> DataFrame:
    """Violations of unique keys and of check conditions: ``rule``, ``violations``; empty if all hold."""
    found = rows.sparkSession.createDataFrame([], "rule string, violations long")
    for keys in unique:
        twice = rows.groupBy(*keys).count().where("count > 1").agg(F.count("*").alias("violations"))
        found = found.unionByName(twice.select(F.lit("unique:" + ",".join(keys)).alias("rule"), "violations"))
    if checks:
        counted = rows.agg(*(F.count_if(~F.coalesce(c, F.lit(True))).alias(n) for n, c in checks.items()))
        pairs = F.explode(F.array(*(F.struct(F.lit(f"check:{n}").alias("rule"), F.col(n).alias("violations")) for n in checks)))
        found = found.unionByName(counted.select(pairs.alias("x")).select("x.*"))
    return found.where("violations > 0")


def orphans(rows: DataFrame, key: str, parents: DataFrame, parent_key: str) -> DataFrame:
    """Rows whose foreign key has no parent."""
    return rows.join(parents.select(F.col(parent_key).alias(key)), key, "left_anti")
