"""Schemas of the record store and their fingerprint."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .sources import files

EVIDENCE = "array<struct<field:string,value:string,quote:string,source_url:string>>"
TABLES = {
    "seeds": "name string, website string, state string, market string, source string, priority int, tier string, source_type string, browser_required boolean, extraction_profile string, metadata map<string,string>",
    "providers": "provider_id string, provider_name string, credentials string, npi string, primary_license_state string, primary_license_type string, created_at timestamp, updated_at timestamp",
    "practices": "practice_id string, practice_name string, website string, intake_url string, phone string, fax string, created_at timestamp, updated_at timestamp",
    "practice_locations": "location_id string, practice_id string, address_1 string, city string, state string, zip string, metro string, phone string, telehealth string, created_at timestamp, updated_at timestamp",
    "licenses": "license_id string, provider_id string, license_state string, license_type string, license_number string, license_status string, source_url string, retrieved_at timestamp",
    "extracted_records": f"extracted_id string, source_url string, source_tier string, source_type string, provider_name string, credentials string, npi string, practice_name string, intake_url string, phone string, fax string, city string, state string, license_type string, license_status string, diagnoses_asd string, diagnoses_adhd string, age_groups array<string>, telehealth string, evidence {EVIDENCE}, website string, license_state string, created_at timestamp",
    "field_evidence": "evidence_id string, record_id string, field_name string, field_value string, quote string, source_url string, source_tier string, captured_at timestamp",
    "contradictions": "contradiction_id string, record_id string, field_name string, preferred_value string, conflicting_value string, preferred_source_url string, conflicting_source_url string, note string, created_at timestamp",
    "review_queue": "review_id string, record_id string, review_type string, provider_name string, practice_name string, reason string, source_url string, evidence_quote string, status string, created_at timestamp",
    "prescriber_rules": "rule_id string, schema_name string, state string, credential string, license_type string, authority string, limitations string, rationale string, citation_title string, citation_url string, retrieved_at string, active int",
    "seed_telemetry": "seed_domain string, seed_name string, attempts long, successes long, failures long, consecutive_failures long, last_status_code int, last_success_at timestamp, last_failure_at timestamp, last_run_status string, last_run_success_pages long, last_run_failure_pages long, last_run_completed_at timestamp",
}


#: Which schemas a store has had, and since when.
MIGRATIONS = "fingerprint string, tables int, applied_at timestamp"


def migrate(spark: SparkSession, folder: str) -> list[str]:
    """Make the tables that a store lacks and note the schemas it has now; the names of new tables. Doing it twice changes nothing.

    Columns that a table lacks need no rewriting: its files are read under the present schema.
    """
    made = [n for n in sorted(TABLES) if not files.exists(files.join(folder, n))]
    for name in made:
        empty(spark, name).write.parquet(files.join(folder, name))
    log = files.join(folder, "schema_migrations")
    known = spark.read.schema(MIGRATIONS).parquet(log) if files.exists(log) else spark.createDataFrame([], MIGRATIONS)
    if known.where(F.col("fingerprint") == fingerprint()).isEmpty():
        row = spark.range(1).select(F.lit(fingerprint()).alias("fingerprint"), F.lit(len(TABLES)).alias("tables"), F.current_timestamp().alias("applied_at"))
        row.coalesce(1).write.mode("append").parquet(log)
    return made


def fingerprint() -> str:
    """Digest of all schemas, kept in a run's manifest to notice drift."""
    return hashlib.sha256("\n".join(f"{n}: {ddl}" for n, ddl in sorted(TABLES.items())).encode()).hexdigest()


def empty(spark: SparkSession, name: str) -> DataFrame:
    return spark.createDataFrame([], TABLES[name])


def drift(df: DataFrame, name: str) -> list[str]:
    """Columns that are missing from a table or of another type."""
    have = dict(df.dtypes)
    return [f.name for f in StructType.fromDDL(TABLES[name]) if have.get(f.name) != f.dataType.simpleString()]
