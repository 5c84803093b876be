"""Confidence and fit of records from their evidence and rules."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.signals import credential_class, has_contact
from ..functions.text import make_pk
from .merge import first_per_key

# Weights of evidence tiers, caps of weak values, and the fields that must be shown.
TIER_WEIGHTS = {"A": 0.92, "B": 0.78, "C": 0.55}
OTHER_TIER = 0.4
WEAK_CAP, LIMITED_CAP = 0.45, 0.68
CRITICAL_FIELDS = ("diagnoses_asd", "diagnoses_adhd", "license_status", "prescriptive_authority")


def tier_weight(tier: Column, weights: Mapping[str, float] = TIER_WEIGHTS, other: float = OTHER_TIER) -> Column:
    out = F.when(F.lit(False), 0.0)
    for name, w in weights.items():
        out = out.when(F.upper(F.coalesce(tier, F.lit(""))) == name, w)
    return out.otherwise(other)


def best_evidence(evidence: DataFrame, record: str = "record_id", field: str = "field_name") -> DataFrame:
    """Greatest tier weight of each record's field over evidence with a source; 0 where none has one."""
    weight = F.when(F.coalesce(F.col("source_url"), F.lit("")) != "", tier_weight(F.col("source_tier")))
    return evidence.groupBy(record, field).agg(F.coalesce(F.max(weight), F.lit(0.0)).alias("weight"))


def capped(weight: Column, value: Column) -> Column:
    """Confidence in a field: unknown and unclear values are capped, and so are limited ones."""
    w = F.coalesce(weight, F.lit(0.0))
    return F.round(F.when(value.isin("unknown", "unclear"), F.least(w, F.lit(WEAK_CAP))).when(value == "limited", F.least(w, F.lit(LIMITED_CAP))).otherwise(w), 3)


def field_confidence(records: DataFrame, evidence: DataFrame, fields: Sequence[str] = CRITICAL_FIELDS, record: str = "record_id") -> DataFrame:
    """``records`` with ``conf_<field>`` for each field and ``record_confidence``, their mean."""
    # one pass with map-side combine: the greatest weight of each field is a column of its own
    weight = F.when(F.coalesce(F.col("source_url"), F.lit("")) != "", tier_weight(F.col("source_tier")))
    best = evidence.groupBy(record).agg(*(F.max(F.when(F.col("field_name") == f, weight)).alias(f"_w_{f}") for f in fields))
    joined = records.join(best, record, "left")
    joined = joined.withColumns({f"conf_{f}": capped(F.col(f"_w_{f}"), F.col(f)) for f in fields}).drop(*(f"_w_{f}" for f in fields))
    total = sum((F.col(f"conf_{f}") for f in fields[1:]), F.col(f"conf_{fields[0]}"))
    # the sum is rounded first, as sums of binary fractions miss ties
    return joined.withColumn("record_confidence", F.round(F.round(total, 6) / len(fields), 3))


def authority(records: DataFrame, rules: DataFrame) -> DataFrame:
    """``records`` with authority and basis of the first active rule of state and credential, and the rule's quote and citation.

    ``prescriptive_authority``, ``prescriptive_basis``, ``rule_quote`` and ``rule_citation``; unknown
    and blank without a rule. Rules are reduced to one per state and credential before the join.
    """
    if "citation_title" not in rules.columns:
        rules = rules.withColumn("citation_title", F.lit(""))
    first = first_per_key(rules.where("active = 1"), ["state", "credential"], F.col("rule_id"))
    rule = first.select(
        F.col("state").alias("_state"), F.col("credential").alias("_class"), F.col("authority").alias("_authority"), F.coalesce("rationale", F.lit("")).alias("_basis"),
        F.coalesce(F.nullif(F.col("rationale"), F.lit("")), F.col("citation_title"), F.lit("")).alias("rule_quote"), F.coalesce("citation_url", F.lit("")).alias("rule_citation"),
    )
    keyed = records.drop("prescriptive_authority", "prescriptive_basis").withColumn("_credential", credential_class(F.col("credentials"), F.col("license_type")))
    joined = keyed.join(rule, (F.col("license_state") == F.col("_state")) & (F.col("_credential") == F.col("_class")), "left")
    return joined.withColumns({
        "prescriptive_authority": F.coalesce(F.nullif(F.col("_authority"), F.lit("")), F.lit("unknown")), "prescriptive_basis": F.coalesce("_basis", F.lit("")), "has_rule": F.col("_class").isNotNull(),
    }).drop("_authority", "_basis", "_credential", "_state", "_class")


def rule_evidence(ruled: DataFrame, at: Column) -> DataFrame:
    """Evidence of tier A for the authority of each record with a rule: its rationale as quote, its citation as source and part of the key."""
    c = F.col
    return ruled.where("has_rule").select(
        make_pk("evi", c("record_id"), F.lit("prescriptive_authority"), c("prescriptive_authority"), c("rule_citation")).alias("evidence_id"), "record_id",
        F.lit("prescriptive_authority").alias("field_name"), c("prescriptive_authority").alias("field_value"), c("rule_quote").alias("quote"), c("rule_citation").alias("source_url"),
        F.lit("").alias("source_document_id"), F.lit("A").alias("source_tier"), at.alias("captured_at"),
    )


# What makes a record fit for outreach, in order, with its weight.
FIT_WEIGHTS = {
    "explicit_asd_diagnostic_signal": 0.30, "explicit_adhd_diagnostic_signal": 0.20, "active_license": 0.20, "public_contact_channel": 0.10,
    "telehealth_available": 0.05, "pediatric_access": 0.05, "medication_support_path": 0.05, "high_confidence_diagnostic_evidence": 0.03,
    "official_license_evidence": 0.02,
}


def weighted_reasons(conditions: Mapping[str, Column], weights: Mapping[str, float]) -> Column:
    """Struct of the capped sum of weights whose condition holds and the reasons in order."""
    score, reasons = F.lit(0.0), []
    for name, c in conditions.items():
        holds = F.coalesce(c, F.lit(False))
        score = score + F.when(holds, weights[name]).otherwise(0.0)
        reasons.append(F.when(holds, F.lit(name)))
    return F.struct(F.round(F.least(score, F.lit(1.0)), 3).alias("score"), F.array_compact(F.array(*reasons)).alias("reasons"))


def outreach_fit() -> Column:
    """Fit of a scored record and its reasons."""
    c = F.col
    conditions = {
        "explicit_asd_diagnostic_signal": c("diagnoses_asd") == "yes",
        "explicit_adhd_diagnostic_signal": c("diagnoses_adhd") == "yes",
        "active_license": c("license_status") == "active",
        "public_contact_channel": has_contact(c("phone"), c("website"), c("intake_url")),
        "telehealth_available": c("telehealth") == "yes",
        "pediatric_access": F.arrays_overlap(c("age_groups"), F.array(F.lit("child"), F.lit("adolescent"))),
        "medication_support_path": c("prescriptive_authority").isin("yes", "limited"),
        "high_confidence_diagnostic_evidence": (c("conf_diagnoses_asd") >= 0.78) | (c("conf_diagnoses_adhd") >= 0.78),
        "official_license_evidence": c("conf_license_status") >= 0.90,
    }
    return weighted_reasons(conditions, FIT_WEIGHTS)


def score(records: DataFrame, evidence: DataFrame, rules: DataFrame, at: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """Records with authority, field and record confidence, fit and reasons; and all evidence, that of rules included.

    A rule that applies is evidence of tier A for the authority, under its citation; without a
    citation it has no source and counts nothing.
    """
    ruled = authority(records, rules)
    shown = rule_evidence(ruled, F.col("updated_at") if at is None else at)
    own = evidence if "source_document_id" in evidence.columns else evidence.withColumn("source_document_id", F.lit(""))
    own = own.select(*shown.columns)
    # only ids of the form that rules' evidence has can be among them, so others are not looked up
    alike = F.coalesce(F.col("evidence_id").startswith("evi_"), F.lit(False))
    own = own.where(~alike).unionByName(own.where(alike).join(shown.select("evidence_id"), "evidence_id", "left_anti"))
    all_evidence = own.unionByName(shown)
    scored = field_confidence(ruled, all_evidence).withColumn("_fit", outreach_fit())
    scored = scored.withColumns({"outreach_fit_score": F.col("_fit.score"), "outreach_reasons": F.col("_fit.reasons"), "outreach_ready": F.lit(0)})
    return scored.drop("_fit", "rule_quote", "rule_citation", "has_rule"), all_evidence


def score_base(tables: Mapping[str, DataFrame], providers_from: str = "inner") -> DataFrame:
    """Records with the credentials of their provider and the contact channels of their practice and place.

    The place's phone counts before the practice's. Records without practice or place are left out,
    and with ``providers_from`` "inner" those without a provider; "left" keeps these.
    """
    records, providers, practices, places = (tables[n] for n in ("provider_practice_records", "providers", "practices", "practice_locations"))
    return (
        records.join(providers.select("provider_id", "provider_name", "credentials"), "provider_id", providers_from)
        .join(practices.select("practice_id", "website", "intake_url", F.col("phone").alias("_practice_phone")), "practice_id")
        .join(places.select("location_id", "city", F.col("state").alias("location_state"), "metro", F.col("phone").alias("_place_phone")), "location_id")
        .withColumn("phone", F.coalesce("_place_phone", "_practice_phone", F.lit(""))).drop("_practice_phone", "_place_phone")
    )
