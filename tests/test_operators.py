import datetime as dt

from pyspark.sql import functions as F

from evigrid.operators import export, frontier, merge, resolve, review, score
from evigrid.sources import landing, seeds

T0 = dt.datetime(2026, 3, 9)


def test_fold_keeps_known_values(spark):
    rows = spark.createDataFrame([("k", 1, "a", "unknown"), ("k", 2, "", "active"), ("k", 3, None, "unknown"), ("m", 1, "", "unknown")], "k string, o int, x string, s string")
    got = {r.k: (r.x, r.s) for r in merge.fold_upserts(rows, ["k"], F.col("o"), {"x": ("",), "s": ("", "unknown")}).collect()}
    assert got == {"k": ("a", "active"), "m": ("", "unknown")}


def test_counters_and_streak(spark):
    rows = spark.createDataFrame([("a", 1, True), ("a", 2, False), ("a", 3, True), ("a", 4, True), ("b", 1, True)], "d string, o int, f boolean")
    got = {r.d: (r.attempts, r.successes, r.failures, r.consecutive_failures) for r in merge.counters(rows, "d", F.col("o"), F.col("f")).collect()}
    assert got == {"a": (4, 1, 3, 2), "b": (1, 0, 1, 1)}


def test_ordered_union(spark):
    rows = spark.createDataFrame([(3, "a"), (1, "b"), (2, "a"), (4, ""), (5, None)], "o int, u string")
    assert rows.agg(merge.ordered_union(F.col("u"), F.col("o")).alias("u")).first().u == ["b", "a"]


def test_validate(spark):
    rows = spark.createDataFrame([(1, 0.5), (1, 2.0)], "k int, c double")
    got = {(r.rule, r.violations) for r in merge.validate(rows, [["k"]], {"range": F.col("c").between(0, 1)}).collect()}
    assert got == {("unique:k", 1), ("check:range", 1)}


def _extracted(spark, rows):
    names = "extracted_id created_at npi provider_name license_state website city phone"
    frame = spark.createDataFrame(rows, ", ".join(f"{n} {'int' if n == 'created_at' else 'string'}" for n in names.split()))
    return frame.withColumns({"credentials": F.lit("PsyD"), "source_url": F.col("website")})


def test_resolution_is_ordered_and_stable(spark):
    rows = [
        ("e1", 1, "111", "Ann Lee", "NJ", "https://a.org", "Union", "1"), ("e2", 2, "222", "Ann Lee", "NJ", "https://b.org", "Union", "2"),
        ("e3", 3, "", "ann  lee", "NJ", "https://b.org/x", "", ""), ("e4", 4, "", "Ann Lee", "NJ", "https://c.org", "", ""), ("e5", 5, "111", "A. Lee", "NY", "", "", ""),
        ("e6", 6, "", "", "NJ", "https://a.org", "", ""), ("e7", 7, "", "Bob Ray", "", "", "", ""),
    ]
    want = None
    for parts in (1, 7):
        got = {r.extracted_id: (r.provider_id, r.matched_by) for r in resolve.assign_providers(_extracted(spark, rows).repartition(parts)).collect()}
        assert want in (None, got)
        want = got
    assert want["e2"] == (want["e1"][0], "name_state")
    assert want["e3"] == (want["e1"][0], "domain_state")
    assert want["e4"] == (want["e1"][0], "name_state")
    assert want["e5"] == (want["e1"][0], "npi")
    assert want["e6"] == ("", "none") and want["e7"][1] == "new"


def test_confidence_caps(spark):
    evidence = spark.createDataFrame([("r", "a", "A", "u"), ("r", "b", "A", "u"), ("r", "c", "C", ""), ("r", "a", "C", "u")], "record_id string, field_name string, source_tier string, source_url string")
    records = spark.createDataFrame([("r", "yes", "unknown", "yes"), ("s", "yes", "yes", "limited")], "record_id string, a string, b string, c string")
    got = {r.record_id: (r.conf_a, r.conf_b, r.conf_c, r.record_confidence) for r in score.field_confidence(records, evidence, ("a", "b", "c")).collect()}
    assert got == {"r": (0.92, 0.45, 0.0, round(1.37 / 3, 3)), "s": (0.0, 0.0, 0.0, 0.0)}


EVIDENCE = "evidence_id string, record_id string, field_name string, field_value string, quote string, source_url string, source_tier string, captured_at timestamp"


def test_contradictions_prefer_tier_then_recency(spark):
    rows = [
        ("1", "r", "license_status", "active", "q", "u1", "B", T0), ("2", "r", "license_status", "inactive", "q", "u2", "A", T0), ("3", "r", "license_status", "inactive", "q", "u3", "C", T0),
        ("4", "s", "license_status", "active", "q", "u4", "A", T0),
    ]
    got = {(r.preferred_value, r.conflicting_value, r.conflicting_source_url) for r in review.contradictions(spark.createDataFrame(rows, EVIDENCE)).collect()}
    assert got == {("inactive", "active", "u1"), ("inactive", "inactive", "u3")}


def test_decisions(spark):
    base = dict(
        provider_name_snapshot="Jane Doe", practice_name_snapshot="P", prescriptive_authority="no", record_confidence=0.8, diagnoses_asd="yes", diagnoses_adhd="yes",
        license_status="active", outreach_fit_score=0.9, website="w", intake_url="", phone="",
    )
    rows = [dict(base, record_id="ok"), dict(base, record_id="thin", record_confidence=0.5), dict(base, record_id="sludge", provider_name_snapshot="and more", practice_name_snapshot="Find a therapist")]
    evidence = [(f"{r['record_id']}{f}", r["record_id"], f, "yes", "quote", "https://e.org/x", "A", T0) for r in rows for f in score.CRITICAL_FIELDS]
    got = {r.record_id: r for r in review.decide(spark.createDataFrame(rows), spark.createDataFrame(evidence, EVIDENCE)).collect()}
    assert (got["ok"].export_status, got["ok"].outreach_ready, got["ok"].review_type) == ("approved", 1, None)
    assert got["thin"].blocked_reason == "low_confidence" and got["thin"].review_type == "record_review"
    assert got["sludge"].lane == "directory_sludge"


def test_frontier(spark):
    urls = ["https://e.org/", "https://e.org/providers", "https://e.org/js/x.js", "https://e.org/privacy", "https://e.org/a.pdf", "https://o.org/providers"]
    rows = spark.createDataFrame([(u,) for u in urls], "u string")
    got = rows.select("u", frontier.reject_reason(F.col("u")).alias("r"), frontier.research_score(F.col("u"), F.lit("https://e.org/"), F.lit("practice_site")).alias("s"), frontier.path_prefix(F.col("u")).alias("p")).collect()
    assert [r.r for r in got] == ["", "", "static_path", "low_value_path", "static_extension", ""]
    assert (got[0].s, got[1].s, got[5].s) == (52, 44, -1000)
    assert [r.p for r in got][:4] == ["/", "/providers/", "/js/", "/privacy"]


def test_proximity(spark):
    rows = spark.createDataFrame([("https://e.org/a/b/c", "https://e.org/a/b"), ("https://e.org/a/x", "https://e.org/a/b"), ("https://e.org/z", "https://e.org/a")], "u string, s string")
    assert [r[0] for r in rows.select(frontier.proximity(F.col("u"), F.col("s"))).collect()] == [48, 18, 0]


def test_storms(spark):
    rows = spark.createDataFrame([("d", i, "blocked") for i in range(5)] + [("d", 9, "dns"), ("e", 1, "blocked")], "domain string, ts int, kind string")
    got = {(r.domain, r.kind, r.ts, r.failures) for r in frontier.storms(rows, "domain", ["ts"], "kind").collect()}
    assert got == {("d", "blocked", 2, 3), ("d", "dns", 9, 1)}


def test_seeds(spark, tmp_path):
    (tmp_path / "s.json").write_text('{"sources": [{"name": "A", "website": "https://a.org/", "state": "NJ", "sourceType": "practice_site", "priority": 2, "note": "x"}, {"name": "B", "url": "a.org", "state": "nj"}, {"name": "C"}]}')
    found = seeds.coerce(seeds.read_rows(spark, str(tmp_path / "s.json")), source="pack")
    assert found.count() == 2
    first = seeds.ordered(seeds.dedupe(found)).collect()
    assert len(first) == 1 and first[0].name == "A" and first[0].metadata == {"note": "x"} and first[0].source_type == "practice_site"


def test_robots_and_policies(spark):
    robots = spark.createDataFrame([("User-agent: *\nSitemap: https://e.org/s.xml\nsitemap: https://e.org/s.xml",)], "r string")
    assert robots.select(seeds.sitemaps(F.col("r"))).first()[0] == ["https://e.org/s.xml"]
    policies = spark.createDataFrame([("e.org", "browser"), ("*.o.org", "browser"), ("p.org", "odd")], "domain string, mode string")
    urls = spark.createDataFrame([("https://e.org/1",), ("https://x.o.org/1",), ("https://p.org/",)], "url string")
    assert {r.url: r["mode"] for r in seeds.with_policy(urls, policies, "http").collect()} == {"https://e.org/1": "browser", "https://x.o.org/1": "http", "https://p.org/": "http"}


def test_export_frames(spark, tmp_path):
    rows = spark.createDataFrame([("p", "Ann Lee", "l1", 2), ("p", "Ann M. Lee", "l2", 1), ("q", "", "l1", 1)], "practice string, name string, loc string, rank int")
    got = {r.practice: (r["rank"], r.contacts, r.locations) for r in export.dossiers(rows, "practice", [F.col("rank")], "name", ["loc"]).collect()}
    assert got == {"p": (1, ["Ann Lee", "Ann M. Lee"], 2), "q": (1, [], 1)}
    assert export.shortest_names(rows, "practice", "name").first().name == "Ann Lee"
    landing.write_csv(rows.groupBy("practice").agg(F.collect_list("name").alias("names")), str(tmp_path / "out"))
    assert spark.read.option("header", True).option("escape", '"').csv(str(tmp_path / "out")).where("practice = 'q'").first().names == '[""]'
