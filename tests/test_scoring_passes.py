"""Scoring and decisions read the evidence in one pass each."""

import contextlib
import io

from evigrid.operators import review, score

EVIDENCE = "evidence_id string, record_id string, field_name string, field_value string, quote string, source_tier string, source_url string, captured_at long"
ROWS = [
    ("1", "a", "diagnoses_asd", "yes", "q", "A", "https://x.org", 1), ("2", "a", "diagnoses_asd", "unclear", "", "B", "https://y.org", 2), ("3", "a", "license_status", "active", "q", "C", "", 3),
    ("4", "b", "license_status", "", "q", "B", "https://x.org", 1), ("5", "b", "license_status", "active", "q", "A", "https://x.org", 1), ("6", "b", None, "z", "q", "A", "https://x.org", 1),
]


def _plan(df):
    with contextlib.redirect_stdout(io.StringIO()) as out:
        df.explain()
    return out.getvalue()


def test_one_pass_gives_what_is_shown_and_what_is_in_conflict(spark):
    found = {r.record_id: r for r in review.source_summary(spark.createDataFrame(ROWS, EVIDENCE)).collect()}
    assert (found["a"].critical_present, found["a"].conflicts, found["a"].evidence_count) == (["diagnoses_asd"], ["diagnoses_asd"], 3)
    assert (found["b"].critical_present, found["b"].conflicts) == (["license_status"], [])


def test_confidence_aggregates_evidence_once(spark):
    records = spark.createDataFrame([("a", "yes", "unclear", "active", "unknown"), ("c", "yes", "unclear", "active", "unknown")], "record_id string, diagnoses_asd string, diagnoses_adhd string, license_status string, prescriptive_authority string")
    scored = score.field_confidence(records, spark.createDataFrame(ROWS, EVIDENCE))
    assert {r.record_id: (r.conf_diagnoses_asd, r.conf_license_status) for r in scored.collect()} == {"a": (0.92, 0.0), "c": (0.0, 0.0)}
    assert "pivotfirst" not in _plan(scored)
