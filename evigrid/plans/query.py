"""Interactive queries over registered tables."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# How a statement may begin and the words that it may not hold.
ALLOWED_STARTS = ("select", "with", "pragma")
FORBIDDEN_WORDS = ("insert", "update", "delete", "alter", "drop", "create", "replace", "attach", "detach", "vacuum", "reindex")


class RefusedQuery(ValueError):
    """The statement is not a read-only query."""


def guard(statement: str) -> str:
    """The statement without its last semicolon; refused unless it reads only. Forbidden words count anywhere, in literals too."""
    text = statement.strip().rstrip(";").strip()
    low = text.lower()
    if not low.startswith(ALLOWED_STARTS):
        raise RefusedQuery("only read-only statements are run")
    if ";" in text:
        raise RefusedQuery("one statement at a time")
    hit = next((w for w in FORBIDDEN_WORDS if re.search(rf"\b{w}\b", low)), None)
    if hit:
        raise RefusedQuery(f"{hit} is not allowed")
    return text


def run_sql(spark: SparkSession, statement: str, limit: int = 200) -> DataFrame:
    """A guarded statement's rows, at most ``limit``. ``PRAGMA table_info(t)`` describes a table."""
    text = guard(statement)
    info = re.fullmatch(r"(?i)pragma\s+table_info\((\w+)\)", text)
    if info:
        return spark.sql(f"DESCRIBE TABLE {info[1]}").limit(limit)
    if text.lower().startswith("pragma"):
        raise RefusedQuery("of the pragmas only table_info is known")
    return spark.sql(f"SELECT * FROM ({text}) AS q LIMIT {int(limit)}")


def search(rows: DataFrame, columns: list[str], needle: str, order: list[str], limit: int = 20) -> DataFrame:
    """Rows one of whose columns holds the needle, regardless of letter case; ``%`` and ``_`` are wildcards."""
    pattern = f"%{needle.lower()}%"
    hit = F.lit(False)
    for c in columns:
        hit = hit | F.lower(F.coalesce(F.col(c), F.lit(""))).like(pattern)
    return rows.where(hit).orderBy(*order).limit(limit)


def status_counts(tables: dict[str, DataFrame], filters: dict[str, tuple[str, str]] | None = None) -> DataFrame:
    """Row counts of tables, and of filtered ones by ``{name: (table, condition)}``: ``metric``, ``value``."""
    parts = [df.agg(F.count("*").alias("value")).select(F.lit(n).alias("metric"), "value") for n, df in tables.items()]
    parts += [tables[t].where(cond).agg(F.count("*").alias("value")).select(F.lit(n).alias("metric"), "value") for n, (t, cond) in (filters or {}).items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# The six presets: table, columns, condition and order; all end in a limit.
PRESETS = {
    "failed-domains": ("seed_telemetry", "seed_domain, last_status_code, last_run_status, last_run_success_pages, last_run_failure_pages, last_run_completed_at",
                       "last_run_success_pages = 0 OR last_run_status <> 'completed'", "last_run_completed_at DESC, seed_domain ASC"),
    "blocked-domains": ("seed_telemetry", "seed_domain, last_status_code, last_run_status, last_run_completed_at", "last_status_code IN (401, 403, 429, 503)", "last_run_completed_at DESC, seed_domain ASC"),
    "low-confidence-records": ("provider_practice_records", "provider_name_snapshot AS provider_name, practice_name_snapshot AS practice_name, record_confidence, review_status, blocked_reason",
                               "record_confidence < 0.60", "record_confidence ASC, updated_at DESC"),
    "review-queue": ("review_queue", "review_type, provider_name, practice_name, reason, source_url, status, created_at", "TRUE", "created_at DESC, review_id ASC"),
    "contradictions": ("contradictions JOIN provider_practice_records USING (record_id)",
                       "field_name, preferred_value, conflicting_value, preferred_source_url, conflicting_source_url, provider_name_snapshot AS provider_name, practice_name_snapshot AS practice_name",
                       "TRUE", "contradictions.created_at DESC, contradiction_id ASC"),
    "outreach-ready": ("provider_practice_records", "provider_name_snapshot AS provider_name, practice_name_snapshot AS practice_name, outreach_fit_score, record_confidence, diagnoses_asd, diagnoses_adhd, license_status",
                       "outreach_ready = 1", "outreach_fit_score DESC, record_confidence DESC, provider_name_snapshot ASC"),
}
# What ends the ties that a preset's order leaves open, so that reruns and other partitions give the same rows.
TIES = {"low-confidence-records": "record_id ASC", "outreach-ready": "record_id ASC"}


def preset(spark: SparkSession, name: str, limit: int = 20) -> DataFrame:
    """A preset over the registered views."""
    table, columns, condition, order = PRESETS[name]
    if name in TIES:
        order = f"{order}, {TIES[name]}"
    return spark.sql(f"SELECT {columns} FROM {table} WHERE {condition} ORDER BY {order} LIMIT {int(limit)}")


def tail(rows: DataFrame, order: str, n: int) -> DataFrame:
    """The last n rows, oldest first."""
    return rows.orderBy(F.desc(order)).limit(n).orderBy(order)
