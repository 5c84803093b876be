"""Export frames: approved records, grouped dossiers and documents as text columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import slug

def top(rows: DataFrame, order: Sequence[Column], limit: int) -> DataFrame:
    """The first rows in an order with a unique last key."""
    return rows.orderBy(*order).limit(limit)


def dossiers(rows: DataFrame, group: str, order: Sequence[Column], name: str, location: Sequence[str]) -> DataFrame:
    """One row per group: its first row's columns, the distinct names, and how many places it has."""
    w = Window.partitionBy(group).orderBy(*order)
    primary = rows.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")
    rolled = rows.groupBy(group).agg(
        F.array_sort(F.collect_set(F.when(F.coalesce(F.col(name), F.lit("")) != "", F.col(name)))).alias("contacts"),
        F.count_distinct(*location).alias("locations"), F.count("*").alias("records"),
    )
    return primary.join(rolled, group)


def shortest_names(rows: DataFrame, group: str, name: str) -> DataFrame:
    """The shortest spelling of each canonical name (first and last word, lower case) of a group."""
    words = F.split(F.lower(F.trim(F.col(name))), " +")
    canonical = F.concat_ws(" ", F.element_at(words, 1), F.element_at(words, -1))
    best = F.min_by(name, F.struct(F.length(name), F.col(name)))
    return rows.where(F.trim(F.col(name)) != "").groupBy(group, canonical.alias("canonical")).agg(best.alias("name"))


def markdown(title: Column, facts: Sequence[tuple[str, Column]], lists: Sequence[tuple[str, Column]] = ()) -> Column:
    """A document as one text column: a heading, facts as bullets, lists as sections; blank values are left out."""
    lines = [F.concat(F.lit("# "), title), F.lit("")]
    lines += [F.when(F.coalesce(c.cast("string"), F.lit("")) != "", F.concat(F.lit(f"- **{label}:** "), c.cast("string"))) for label, c in facts]
    for label, values in lists:
        body = F.array_join(F.transform(values, lambda x: F.concat(F.lit("- "), x)), "\n")
        lines.append(F.when(F.size(values) > 0, F.concat(F.lit(f"\n## {label}\n\n"), body)))
    return F.array_join(F.array_compact(F.array(*lines)), "\n")


def file_name(*parts: Column) -> Column:
    return F.array_join(F.array(*(slug(p) for p in parts)), "-")
