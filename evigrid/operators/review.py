"""Contradictions, triage and approval of scored records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.signals import directory_source, has_contact, indirect_source, person_name, practice_signal, triage
from ..functions.text import make_pk, normalize_domain, normalize_text
from .score import CRITICAL_FIELDS

# What a conflict costs, the gates of approval, and when a source is to be retired.
CONFLICT_PENALTY = 0.15
LEAST_CONFIDENCE, READY_CONFIDENCE, READY_FIT = 0.60, 0.70, 0.70
RETIRE_QUEUED = 5
# What each lane of triage and a source to be retired say.
LANE_REASONS = {
    "directory_sludge": "Directory sludge: generic snippet was extracted as a provider from a broad listing page; keep for parser review, not operator review.",
    "practice_only_signal": "Practice-only signal: service/evaluation evidence exists but no credible named clinician was verified; review as practice coverage, not provider outreach.",
    "indirect_provider_signal": "Indirect provider signal: named clinician was found on a webinar/FAQ/resource page without strong direct service evidence; needs corroboration before outreach.",
    "weak_provider_signal": "Weak provider signal: evidence is too thin to justify operator review yet; likely parser noise or unsupported mention.",
}
RETIRE_REASON = (
    "Seed retire candidate: this source produced repeated directory-sludge records without credible clinician-level evidence; "
    "retire or parser-block this source before the next clean run."
)


def tier_order(tier: Column) -> Column:
    return F.when(tier == "A", 0).when(tier == "B", 1).otherwise(2)


def _valued(evidence: DataFrame, fields: Sequence[str]) -> DataFrame:
    return evidence.where(F.col("field_name").isin(*fields) & (F.coalesce(F.col("field_value"), F.lit("")) != ""))


def conflicting_fields(evidence: DataFrame, fields: Sequence[str] = CRITICAL_FIELDS) -> DataFrame:
    """``record_id``, ``conflicts``: the fields that have more than one value, which is all that a decision needs of the contradictions."""
    least, most = F.min("field_value"), F.max("field_value")
    per = _valued(evidence, fields).groupBy("record_id", "field_name").agg((least != most).alias("differ")).where("differ")
    return per.groupBy("record_id").agg(F.array_sort(F.collect_set("field_name")).alias("conflicts"))


def contradictions(evidence: DataFrame, fields: Sequence[str] = CRITICAL_FIELDS) -> DataFrame:
    """For fields with more than one value: the preferred value against every other row of evidence.

    Preferred is the best tier, then the latest, then the least evidence id. Rows that repeat the
    preferred value are listed too, as the preferred row only is left out.
    """
    rows = _valued(evidence, fields)
    per = rows.groupBy("record_id", "field_name").agg(
        F.min(F.struct(tier_order(F.col("source_tier")).alias("t"), (-F.unix_micros(F.col("captured_at").cast("timestamp"))).alias("c"), F.col("evidence_id"), F.col("field_value"), F.col("source_url"))).alias("_p"),
        F.count_distinct("field_value").alias("_n"),
    )
    joined = rows.join(per.where("_n > 1"), ["record_id", "field_name"]).where(F.col("evidence_id") != F.col("_p.evidence_id"))
    return joined.select(
        make_pk("cnf", F.col("record_id"), F.col("field_name"), F.col("_p.field_value"), F.col("field_value"), F.col("source_url")).alias("contradiction_id"),
        "record_id", "field_name", F.col("_p.field_value").alias("preferred_value"), F.col("field_value").alias("conflicting_value"),
        F.col("_p.source_url").alias("preferred_source_url"), F.col("source_url").alias("conflicting_source_url"),
        F.concat(F.lit("Preferred "), F.col("_p.field_value"), F.lit(" over "), F.col("field_value")).alias("note"),
    ).dropDuplicates(["contradiction_id"])


def source_summary(evidence: DataFrame, fields: Sequence[str] = CRITICAL_FIELDS) -> DataFrame:
    """Per record: count of evidence, latest source and quote, sorted domains, critical fields that are shown, and those that have more than one value."""
    latest = F.max(F.struct(F.col("captured_at"), F.col("evidence_id"), F.col("source_url"), F.col("quote")))
    shown = (F.coalesce(F.col("source_url"), F.lit("")) != "") & (F.coalesce(F.col("quote"), F.lit("")) != "")
    each = []
    for i, f in enumerate(fields):  # flags and extremes by field, so that one pass over the evidence is enough
        value = F.when(F.col("field_name") == f, F.nullif(F.col("field_value"), F.lit("")))
        each += [F.bool_or((F.col("field_name") == f) & shown).alias(f"_s{i}"), F.min(value).alias(f"_l{i}"), F.max(value).alias(f"_m{i}")]
    listed = lambda holds: F.array_sort(F.array_compact(F.array(*(F.when(holds(i), F.lit(f)) for i, f in enumerate(fields)))))
    return evidence.groupBy("record_id").agg(
        F.count("*").alias("evidence_count"), latest.alias("_l"), F.array_sort(F.array_remove(F.collect_set(normalize_domain(F.col("source_url"))), "")).alias("domains"), *each,
    ).select(
        "record_id", "evidence_count", F.col("_l.source_url").alias("latest_source_url"), F.col("_l.quote").alias("latest_quote"), "domains",
        listed(lambda i: F.col(f"_s{i}")).alias("critical_present"), listed(lambda i: F.col(f"_l{i}") != F.col(f"_m{i}")).alias("conflicts"),
    )


def decide(records: DataFrame, evidence: DataFrame, fields: Sequence[str] = CRITICAL_FIELDS) -> DataFrame:
    """Each scored record with its conflicts, lane and approval.

    The penalty for conflicts is taken from the scored confidence, so deciding twice gives the same.
    """
    joined = records.join(source_summary(evidence, fields).withColumnRenamed("conflicts", "_conflicts"), "record_id", "left")
    none = F.array().cast("array<string>")
    conflict, shown = F.coalesce("_conflicts", none), F.coalesce("critical_present", none)
    in_order = [F.lit(f) for f in fields]
    notes = F.transform(F.filter(F.array(*in_order), lambda f: F.array_contains(conflict, f)), lambda f: F.concat(f, F.lit(" conflict")))
    first_url = F.try_element_at("source_urls", F.lit(1)) if "source_urls" in records.columns else F.lit("")
    missing = F.filter(F.array(*in_order), lambda f: ~F.array_contains(shown, f))
    joined = joined.withColumns({
        "conflict_notes": notes, "missing_critical": missing, "latest_source_url": F.coalesce("latest_source_url", first_url, F.lit("")), "latest_quote": F.coalesce("latest_quote", F.lit("")),
        "final_confidence": F.when(F.size(notes) > 0, F.greatest(F.lit(0.0), F.round(F.col("record_confidence") - CONFLICT_PENALTY, 3))).otherwise(F.col("record_confidence")),
    })
    # columns of their own, so that each is computed once a record and not wherever a lane looks at it
    joined = joined.withColumns({"_valid": person_name(F.col("provider_name_snapshot")), "_practice": normalize_text(F.col("practice_name_snapshot"))})
    practice, url = F.col("_practice"), F.col("latest_source_url")
    contact = has_contact(F.col("phone"), F.col("website"), F.col("intake_url"))
    lane = triage(
        directory_source(practice, url), F.col("_valid"), practice_signal(practice, url, F.col("latest_quote")), indirect_source(url), contact,
        F.size(shown), F.col("final_confidence"), F.size("missing_critical") > 0,
    )
    reasons = F.array_compact(F.concat(
        F.array(
            F.when(F.col("final_confidence") < LEAST_CONFIDENCE, F.lit("low_confidence")),
            F.when(F.col("prescriptive_authority").isin("limited", "unknown"), F.lit("prescriptive_review")),
            F.when(F.size("missing_critical") > 0, F.concat(F.lit("missing_critical:"), F.array_join("missing_critical", ","))),
        ), F.col("conflict_notes"),
    ))
    joined = joined.withColumn("lane", lane).withColumn("reasons", reasons)
    joined = joined.withColumn("review_type", F.coalesce("lane", F.when(F.size("reasons") > 0, F.lit("record_review"))))
    approved = F.col("review_type").isNull()
    ready = approved & (F.col("final_confidence") >= READY_CONFIDENCE) & (F.col("outreach_fit_score") >= READY_FIT) & (F.col("license_status") == "active") & (
        (F.col("diagnoses_asd") == "yes") | (F.col("diagnoses_adhd") == "yes")) & contact
    return joined.withColumns({
        "review_status": F.when(approved, "ready").otherwise("queued"), "export_status": F.when(approved, "approved").otherwise("blocked"),
        "outreach_ready": F.coalesce(ready, F.lit(False)).cast("int"), "blocked_reason": F.coalesce(_lane_reason(F.col("lane")), F.array_join("reasons", "; ")),
        "conflict_note": F.array_join("conflict_notes", "; "),
    }).drop("_conflicts", "_valid", "_practice")


def _lane_reason(lane: Column) -> Column:
    out = F.when(F.lit(False), "")
    for name, reason in LANE_REASONS.items():
        out = out.when(lane == name, reason)
    return out


def queue(decided: DataFrame, at: Column) -> DataFrame:
    """Review items of decided records, and of sources to be retired."""
    c = F.col
    decided = decided.withColumn("_at", at)
    held = decided.where("review_type IS NOT NULL")
    key = F.when(c("lane").isNotNull(), make_pk("rev", c("record_id"), c("latest_source_url"), c("lane"))).otherwise(make_pk("rev", c("record_id"), c("blocked_reason")))
    items = held.select(
        key.alias("review_id"), "record_id", "review_type", c("provider_name_snapshot").alias("provider_name"), c("practice_name_snapshot").alias("practice_name"), c("blocked_reason").alias("reason"),
        c("latest_source_url").alias("source_url"), c("latest_quote").alias("evidence_quote"), F.lit("pending").alias("status"), c("_at").alias("created_at"),
    )
    name = F.coalesce(F.nullif(c("domain"), F.lit("")), c("latest_source_url"))
    retired = retire_candidates(decided).select(
        make_pk("rev", name, c("latest_source_url"), F.lit("seed_retire_candidate")).alias("review_id"), F.lit("").alias("record_id"), F.lit("seed_retire_candidate").alias("review_type"),
        F.lit("").alias("provider_name"), name.alias("practice_name"), F.lit(RETIRE_REASON).alias("reason"), c("latest_source_url").alias("source_url"), F.lit("").alias("evidence_quote"),
        F.lit("pending").alias("status"), c("_at").alias("created_at"),
    )
    return items.unionByName(retired)


def source_rollup(decided: DataFrame) -> DataFrame:
    """Records in triage by source: how many, and how many of each lane."""
    each = [F.count_if(F.col("lane") == n).alias(n) for n in LANE_REASONS]
    return decided.where("lane IS NOT NULL").groupBy(F.col("latest_source_url").alias("source_url")).agg(F.count("*").alias("queued"), *each)


def stats(decided: DataFrame) -> DataFrame:
    """One row of counts: approved, queued, ready, fields in conflict, lanes, sources to be retired."""
    c = F.col
    flags = {
        "approved_records": c("export_status") == "approved", "queued_records": c("review_type").isNotNull(), "outreach_ready_records": c("outreach_ready") == 1,
        **{f"triage_{n}": c("lane") == n for n in LANE_REASONS},
    }
    ones = decided.select(*(F.coalesce(f, F.lit(False)).cast("long").alias(n) for n, f in flags.items()), F.size("conflict_notes").cast("long").alias("contradictions"), F.lit(0).cast("long").alias("seed_retire_candidates"))
    retired = retire_candidates(decided).select(*(F.lit(0).cast("long").alias(n) for n in ones.columns[:-1]), F.lit(1).cast("long").alias("seed_retire_candidates"))
    return ones.unionByName(retired).agg(*(F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in ones.columns))


def retire_candidates(decided: DataFrame) -> DataFrame:
    """Sources all of whose queued records, five at least, are directory sludge."""
    queued = decided.where(F.col("lane").isNotNull()).groupBy("latest_source_url").agg(F.count("*").alias("queued"), F.count_if(F.col("lane") == "directory_sludge").alias("sludge"), *([F.max("_at").alias("_at")] if "_at" in decided.columns else []))
    return queued.where((F.col("queued") >= RETIRE_QUEUED) & (F.col("queued") == F.col("sludge"))).withColumn("domain", normalize_domain(F.col("latest_source_url")))


def latest(rows: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """The latest row of each key."""
    w = Window.partitionBy(key).orderBy(*(F.desc(o) for o in order))
    return rows.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")
