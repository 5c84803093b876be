"""Cases of resolution, scoring, decision and export over small tables."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from evigrid.operators import accounts, resolve
from evigrid.plans import stages

T0 = dt.datetime(2026, 3, 9)
EVIDENCE = "array<struct<field:string,value:string,quote:string,source_url:string>>"
NAMES = (
    "extracted_id source_document_id source_url source_tier source_type extraction_profile provider_name credentials npi practice_name intake_url phone fax address_1 city state zip metro license_state "
    "license_type license_status diagnoses_asd diagnoses_adhd telehealth insurance_notes waitlist_notes referral_requirements website"
).split()
SCHEMA = ", ".join(f"{n} string" for n in NAMES) + f", age_groups array<string>, evidence {EVIDENCE}, created_at timestamp"
BASE = dict.fromkeys(NAMES, "") | {
    "source_url": "https://hill.org/team", "source_tier": "C", "source_type": "practice_site", "practice_name": "Hill Clinic", "phone": "201-555-0100", "city": "Union", "state": "NJ", "license_state": "NJ",
    "license_type": "unknown", "license_status": "unknown", "diagnoses_asd": "unclear", "diagnoses_adhd": "unclear", "telehealth": "unknown", "age_groups": ["unknown"], "evidence": [],
}


def extracted(spark, *rows):
    out = []
    for i, r in enumerate(rows):
        row = BASE | {"extracted_id": f"e{i}", "created_at": T0 + dt.timedelta(minutes=i)} | r
        row["website"] = row["source_url"]
        out.append(tuple(row[f.split(" ")[0]] for f in [*NAMES, "age_groups", "evidence", "created_at"]))
    return spark.createDataFrame(out, SCHEMA)


def counts_of(tables):
    return tuple(resolve.counts(tables).first())


def test_same_number_twice_is_one_record(spark):
    t = resolve.resolve_rows(extracted(spark, {"provider_name": "Ann Lee", "npi": "1"}, {"provider_name": "Ann Lee", "npi": "1", "diagnoses_asd": "yes"}))
    assert counts_of(t) == (2, 0) and t["providers"].count() == 1
    (r,) = t["provider_practice_records"].collect()
    assert r.diagnoses_asd == "yes" and r.source_urls == ["https://hill.org/team"]


def test_practice_only_rows_are_queued_once(spark):
    t = resolve.resolve_rows(extracted(spark, {"diagnoses_asd": "yes"}, {"diagnoses_asd": "yes", "source_url": "https://hill.org/autism"}, {}))
    assert counts_of(t) == (0, 2) and t["provider_practice_records"].count() == 0
    assert [r.review_type for r in t["review_queue"].collect()] == ["missing_provider"]


def test_one_practice_two_providers(spark):
    t = resolve.resolve_rows(extracted(spark, {"provider_name": "Ann Lee"}, {"provider_name": "Bob Ray"}))
    assert (t["providers"].count(), t["provider_practice_records"].count(), t["practices"].count(), t["practice_locations"].count()) == (2, 2, 1, 1)


def test_board_enriches_records_that_exist(spark):
    quote = [("license_status", "active", "License Status: Active", "https://board.gov/1")]
    board = {"provider_name": "Ann Lee", "source_type": "licensing_board", "source_url": "https://board.gov/1", "license_status": "active", "license_type": "psychologist", "npi": "77", "source_tier": "A", "evidence": quote}
    t = resolve.resolve_rows(extracted(spark, {"provider_name": "Ann Lee", "license_type": "unknown"}, board))
    (r,) = t["provider_practice_records"].collect()
    assert (r.license_status, r.license_type, r.npi, r.source_urls) == ("active", "psychologist", "77", ["https://hill.org/team", "https://board.gov/1"])
    (p,) = t["providers"].collect()
    assert (p.npi, p.primary_license_type) == ("77", "psychologist") and t["licenses"].count() == 2
    assert [(e.field_name, e.field_value, e.source_tier) for e in t["field_evidence"].collect()] == [("license_status", "active", "A")]
    early = resolve.resolve_rows(extracted(spark, board, {"provider_name": "Ann Lee"}))
    assert early["provider_practice_records"].first().license_status == "unknown"
    assert [r.reason for r in early["review_queue"].collect()] == [resolve.UNMATCHED_LICENSE]
    away = resolve.resolve_rows(extracted(spark, {"provider_name": "Ann Lee", "npi": "77"}, board | {"license_state": "NY", "state": "NY"}))
    assert [r.reason for r in away["review_queue"].collect()] == [resolve.BOARD_ORPHAN]


def test_chains_of_pointers(spark):
    rows = [{"provider_name": "P0", "npi": "n0"}]
    for i in range(1, 20):  # each row is found by the number that the row before brought along under its name
        rows += [{"provider_name": f"P{i - 1}", "npi": f"m{i}"}, {"provider_name": f"P{i}", "npi": f"m{i}"}]
    got = resolve.assign_providers(extracted(spark, *rows).repartition(5)).select("provider_id").distinct().count()
    assert got == 1


def test_components_over_long_chains(spark):
    rows = spark.createDataFrame([(f"r{i:03d}", f"a{i // 2}", f"b{(i + 1) // 2}") for i in range(200)] + [("s", "", "")], "id string, x string, y string")
    got = {r.id: r.component for r in resolve.components(rows, "id", ["x", "y"]).collect()}
    assert got.pop("s") == "s" and set(got.values()) == {"r000"}


SHOWN = [(f, v, f"This sentence shows the {f} of the clinic.", "https://hill.org/team") for f, v in (("diagnoses_asd", "yes"), ("diagnoses_adhd", "yes"), ("license_status", "active"))]
READY = {"provider_name": "Jane Doe", "credentials": "PsyD", "license_type": "psychologist", "license_status": "active", "diagnoses_asd": "yes", "diagnoses_adhd": "yes", "source_tier": "A", "age_groups": ["child"], "evidence": SHOWN}


@pytest.fixture(scope="module")
def rules(spark):
    return spark.createDataFrame([("r1", "NJ", "PsyD/PhD", "no", "Psychologists do not prescribe here.", "Title", "https://law.gov/45", 1), ("r0", "NJ", "PsyD/PhD", "yes", "", "", "", 0)],
                                 "rule_id string, state string, credential string, authority string, rationale string, citation_title string, citation_url string, active int")


def test_approved_record_is_exported_with_the_rule_as_evidence(spark, rules):
    tables = stages.score_and_decide(stages.resolve_records(extracted(spark, READY)), rules)
    (r,) = tables["decided"].collect()
    assert (r.prescriptive_authority, r.export_status, r.outreach_ready, r.blocked_reason) == ("no", "approved", 1, "")
    shown = {e.field_name: (e.source_url, e.quote, e.source_tier) for e in tables["field_evidence"].collect()}
    assert shown["prescriptive_authority"] == ("https://law.gov/45", "Psychologists do not prescribe here.", "A")
    assert r.conf_prescriptive_authority == 0.92 and tables["stats"].first().approved_records == 1
    out = stages.export_accounts(tables)
    (sale,) = out["sales"].collect()
    assert sale.source_urls == ["https://hill.org/team", "https://law.gov/45"] and sale.target_buyer == "clinical director or practice owner"
    (d,) = out["dossiers"].collect()
    assert (d.qa_state, d.primary_contact, d.named_providers, d.locations, d.phone) == ("approved_outreach_ready", "Jane Doe, PsyD", ["Jane Doe"], ["Union, NJ"], "(201) 555-0100")
    assert len(d.contacts) == 3 and len(d.recommended_sequence) == 4 and d.evidence_quotes
    (b,) = out["bundles"].select(accounts.profile_markdown().alias("m"), "evidence").collect()
    assert b.m.startswith("# Jane Doe - Hill Clinic") and [e.field_name for e in b.evidence] == sorted(e.field_name for e in b.evidence)


def test_a_rule_without_citation_is_no_source(spark, rules):
    bare = rules.where("active = 1").withColumn("citation_url", F.lit(""))
    (r,) = stages.score_and_decide(stages.resolve_records(extracted(spark, READY)), bare)["decided"].collect()
    assert r.prescriptive_authority == "no" and r.conf_prescriptive_authority == 0 and "prescriptive_authority" in r.missing_critical


def test_sludge_retires_its_source(spark, rules):
    url = "https://www.psychologytoday.com/us/therapists/nj"
    names = [f"{w} For Therapists Help" for w in ("Find", "Browse", "Ask", "Call", "See")]
    rows = [READY | {"provider_name": n, "source_url": url, "evidence": [("provider_name", n, "quote", url)], "phone": str(i)} for i, n in enumerate(names)]
    tables = stages.score_and_decide(stages.resolve_records(extracted(spark, *rows)), rules.where("rule_id = 'none'"))
    kinds = sorted(r.review_type for r in tables["review_queue"].collect())
    assert kinds == ["directory_sludge"] * 5 + ["seed_retire_candidate"]
    s = tables["stats"].first()
    assert (s.queued_records, s.triage_directory_sludge, s.seed_retire_candidates) == (5, 5, 1)


def test_review_only_accounts_stay_apart(spark, rules):
    said = {"diagnoses_asd": "yes", "practice_name": "Hill Autism Clinic", "referral_requirements": "A referral by a physician is required before intake.", "evidence": [("diagnoses_asd", "yes", "Autism evaluations are offered.", "")]}
    rows = [said | {"source_url": u} for u in ("https://hill.org/faq/billing", "https://hill.org/autism/evaluation", "https://hill.org/autism/clinic")]
    tables = stages.score_and_decide(stages.resolve_records(extracted(spark, *rows)), rules)
    out = stages.export_accounts(tables)
    assert out["dossiers"].count() == 0
    (a,) = out["internal_review"].collect()
    assert a.qa_state == "under_review" and a.provider_count == 0 and a.confidence_score == 22 and a.review_notes == ["The service is shown; no clinician is verified yet."]
    mixed = stages.score_and_decide(stages.resolve_records(extracted(spark, READY, *rows)), rules)
    both = stages.export_accounts(mixed)
    (d,) = both["dossiers"].collect()
    assert d.review_notes == [] and d.practice_name == "Hill Clinic" and both["internal_review"].count() == 1


def test_documents_brief_the_account(spark, rules):
    docs = spark.createDataFrame([
        ("https://hill.org/team", "<title>Old</title>", T0), ("https://hill.org/team", '<meta name="description" content="Evaluations for children and adults in Union.">', T0 + dt.timedelta(days=1)),
    ], "source_url string, content string, fetched_at timestamp")
    tables = stages.score_and_decide(stages.resolve_records(extracted(spark, READY)), rules) | {"source_documents": docs}
    (d,) = stages.export_accounts(tables)["dossiers"].collect()
    assert [(b.url, b.summary) for b in d.source_briefs] == [("https://hill.org/team", "Evaluations for children and adults in Union.")]
    assert spark.createDataFrame([d.asDict()], stages.export_accounts(tables)["dossiers"].schema).select(accounts.dossier_markdown().alias("m")).first().m.startswith("# Account - Hill Clinic")
