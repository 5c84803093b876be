from pyspark.sql import functions as F

from evigrid.operators import dossier


def one(spark, rows, schema, *columns):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*columns).collect()]


def test_names(spark):
    rows = [("Dr. Ann Lee, Director of",), ("Ann M. Lee",), ("Ann",), ("Ann Lee Ann",), (None,), ("Ann Lee Licensed Psychologist",)]
    assert [r[0] for r in one(spark, rows, "x string", dossier.contact_name(F.col("x")))] == ["Ann Lee", "Ann M Lee", "", "Ann Lee", "", "Ann Lee"]
    rows = [("Clinic Dr. Ann Lee Director",), ("Ann Director Lee",), ("A B C D E",)]
    assert [r[0] for r in one(spark, rows, "x string", dossier.provider_name(F.col("x")))] == ["Ann Lee", "Ann Director Lee", "A B C D"]
    assert one(spark, [("Ann M. Lee",), ("Ann",)], "x string", dossier.canonical_name(F.col("x"))) == [("ann lee",), ("ann",)]
    assert one(spark, [(" MD , PhD,, X, Y",)], "x string", dossier.credentials(F.col("x"))) == [("MD, PhD, X",)]


def test_quotes(spark):
    rows = [("yes",), ("Too short",), ("lower case start of a sentence here",), ("A full sentence &amp; more of it here.",), ("Word " * 60,), (None,)]
    got = [r[0] for r in one(spark, rows, "x string", dossier.quote(F.col("x")))]
    assert got[:4] == ["", "", "", "A full sentence & more of it here."] and got[5] == ""
    assert got[4].endswith("Word...") and len(got[4]) <= 180


def test_labels(spark):
    schema = "c string, w string, p string, n int, l int"
    rows = [("MD", "", "Hill", 1, 1), ("PsyD", "https://x.college.org", "Hill", 1, 1), ("", "", "Autism Clinic", 2, 1), ("NP", "", "General Hospital", 0, 0)]
    got = one(spark, rows, schema, dossier.target_buyer(F.col("c")), dossier.contact_role(F.col("c"), F.col("w"), F.col("p")), dossier.budget(F.col("p"), F.col("w"), F.col("n"), F.col("l")))
    assert [g[1] for g in got] == ["medical director", "clinical lead / psychologist", "clinical lead / faculty clinician", "practice lead"]
    assert [g[2] for g in got] == ["Single-site / owner-led", "Institutional / specialty program", "Regional / growing group", "Enterprise / multi-site"]
    assert got[3][0] == "clinical lead or practice administrator"
    assert one(spark, [("under_review",), ("",)], "x string", dossier.display_state(F.col("x"))) == [("Under review",), ("unknown",)]


def test_accounts(spark):
    rows = [("https://E.org/treatment-care/a/b/c/d",), ("https://e.org/a/b/c",), ("https://e.org/",), ("",)]
    assert [r[0] for r in one(spark, rows, "x string", dossier.account_key(F.col("x")))] == ["e.org::treatment-care::a::b::c", "e.org::a::b", "e.org", "review-only"]
    assert one(spark, [("12 Oak Street West Orange",), ("1 A Road Union",), ("Union",)], "x string", dossier.market_city(F.col("x"))) == [("West Orange",), ("Union",), ("Union",)]
    schema = "review_id string, review_type string, practice_name string, source_url string, created_at int"
    rows = [("1", "missing_provider", "Autism Center", "https://e.org/a/b/1", 1), ("2", "missing_provider", "Autism Center", "https://e.org/a/b/2", 2), ("3", "missing_provider", "FAQ", "https://e.org/faq", 3), ("4", "record_review", "Autism Center", "https://e.org/c", 4)]
    got = dossier.review_accounts(spark.createDataFrame(rows, schema), 5).collect()
    assert [(r.account, r.sources, r.reviews) for r in got] == [("review-only:e-org--a--b", ["https://e.org/a/b/1", "https://e.org/a/b/2"], 2)]


def test_notes_and_playbook(spark):
    got = one(spark, [("low_confidence; missing_critical:license_status,other_field",), ("low_confidence",), ("x",)], "x string", dossier.review_note(F.col("x")))
    assert got[0][0].endswith("license status, other field.") and got[1][0].startswith("Clinicians are named") and got[2] == ("x",)
    book = one(spark, [("Ann Lee", "approved", "", "https://i", "1"), ("", "approved_outreach_ready", "", "", "")], "n string, s string, w string, i string, p string", dossier.playbook(F.col("n"), F.lit("practice lead"), F.col("s"), F.col("w"), F.col("i"), F.col("p")))
    assert [c.best_channel for c in book[0][0]] == ["Website form"] * 4 and len(book[1][0]) == 2 and book[1][0][0].best_channel == "Manual research"
    evidence = [("e", [("license_status", "Active license is shown on the board page."), ("diagnoses_asd", "Autism evaluations are offered to children.")])]
    assert one(spark, evidence, "i string, e array<struct<field:string,quote:string>>", dossier.evidence_summary(F.col("e"))) == [("Autism evaluations are offered to children. | Active license is shown on the board page.",)]
    assert one(spark, [("Ann Lee", "e.org"), ("Ann", "e.org")], "n string, d string", dossier.email_guesses(F.col("n"), F.col("d"))) == [(["ann.lee@e.org", "alee@e.org", "ann@e.org"],), ([],)]
