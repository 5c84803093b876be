import datetime as dt

import pytest
from pyspark.sql import functions as F

from evigrid import schemas
from evigrid.plans import query, runs, stages
from evigrid.streaming import storms, tail

PAGE = """<html><head><title>Hill Clinic</title></head><body><main>Meet our team. Dr. Ann Lee, PsyD offers autism diagnostic evaluations and ADHD testing for children in Union, NJ.
License status: active. Telehealth visits. Call (201) 555-0100. Fax: 201-555-0101</main><a href="/intake">Start</a></body></html>"""


def _pages(spark):
    rows = [
        ("https://hill.org/team", PAGE, 200, "practice_site", "Hill", "A"), ("https://hill.org/x", "<p>Access denied</p>", 200, "practice_site", "Hill", "A"),
        ("https://hill.org/news/1", PAGE.replace("Clinic", "News"), 200, "practice_site", "Hill", "A"),
        ("https://dale.org/services", "<title>Dale Center</title><p>Autism evaluation services</p>", 200, "practice_site", "Dale", "C"),
    ]
    return spark.createDataFrame(rows, "url string, html string, status_code int, source_type string, seed_name string, tier string")


def test_pages_to_accounts(spark):
    extracted = stages.extract_pages(_pages(spark), F.lit(dt.datetime(2026, 3, 9)))
    found = {r.source_url: r for r in extracted.collect()}
    assert set(found) == {"https://hill.org/team", "https://dale.org/services"}
    hill = found["https://hill.org/team"]
    assert (hill.provider_name, hill.credentials, hill.diagnoses_asd, hill.telehealth) == ("Ann Lee", "PsyD", "yes", "yes")
    assert (hill.phone, hill.fax, hill.license_status, hill.intake_url) == ("(201) 555-0100", "201-555-0101", "active", "https://hill.org/intake")
    tables = stages.resolve_records(extracted)
    assert tables["provider_practice_records"].count() == 1 and tables["review_queue"].first().review_type == "missing_provider"
    rules = spark.createDataFrame([("r1", "NJ", "PsyD/PhD", "no", "no prescribing", "https://law", 1)], "rule_id string, state string, credential string, authority string, rationale string, citation_url string, active int")
    tables = stages.score_and_decide(tables, rules)
    row = tables["decided"].first()
    assert (row.prescriptive_authority, row.export_status, row.outreach_ready) == ("no", "approved", 1)
    account = stages.export_accounts(tables)["dossiers"].first()
    assert account.named_providers == ["Ann Lee"] and account.practice_name == "Hill Clinic" and account.budget_band == "Single-site / owner-led"


def test_sql_guard(spark):
    spark.range(5).createOrReplaceTempView("numbers")
    assert query.run_sql(spark, "SELECT id FROM numbers", 2).count() == 2
    assert query.run_sql(spark, "PRAGMA table_info(numbers)").first().col_name == "id"
    for bad in ("DROP TABLE numbers", "SELECT replace('a', 'b', 'c')", "SELECT 1; SELECT 2", "PRAGMA journal_mode"):
        with pytest.raises(query.RefusedQuery):
            query.run_sql(spark, bad)


def test_run_resumes(spark, tmp_path):
    calls = []

    def step(name, fail=False):
        def go(spark, run):
            calls.append(name)
            if fail and calls.count(name) == 1:
                raise RuntimeError("lost")
            return spark.range(1)

        return go

    steps = {"a": step("a"), "b": step("b", fail=True), "c": step("c")}
    with pytest.raises(RuntimeError):
        runs.Run(str(tmp_path), "r1", "T 1", ("a", "b", "c")).execute(spark, steps)
    run = runs.Run(str(tmp_path), "r1", "T 1", ("a", "b", "c"))
    assert run.next_stage() == "b" and run.state["last_error"]["stage"] == "b"
    assert run.execute(spark, steps)["status"] == "completed" and calls == ["a", "b", "b", "c"]
    assert run.table(spark, "c").count() == 1


def test_controls_and_policy(spark, tmp_path):
    controls = runs.Controls(str(tmp_path / "c.json"))
    controls.apply("suppress-prefix", "e.org", "noise", prefix="tag")
    controls.apply("cap-domain", "e.org", "large", max_pages=4)
    for _ in range(250):
        controls.apply("stop-domain", "o.org", "storm", source="auto")
    again = runs.Controls(str(tmp_path / "c.json"))
    assert len(again.state["interventions"]) == 200 and again.summary()["capped_domains"] == {"e.org": 4}
    assert {r.domain: r.suppressed_prefixes for r in again.frame(spark).collect()}["e.org"] == ["/tag/"]
    runs.check_tool("sync", {"reason": "x", "max": 3, "limit": 25})
    for tool, args in (("sync", {"reason": ""}), ("rm", {"reason": "x"}), ("sync", {"reason": "x", "max": 4}), ("sync", {"reason": "x", "crawl_mode": "full"}), ("control_apply", {"reason": "x", "action": "cap-domain", "domain": "d"}), ("sql", {"reason": "x", "query": "drop"})):
        with pytest.raises(runs.PolicyError):
            runs.check_tool(tool, args)


def test_session_tail_is_per_tenant(spark, tmp_path):
    sessions = runs.Sessions(spark, str(tmp_path / "s"))
    for i in range(6):
        sessions.add("s", "A", "turn", "user", f"turn-{i}")
    assert [r.content for r in sessions.last("s", "a", "turn", 3).collect()] == ["turn-3", "turn-4", "turn-5"]
    assert sessions.last("s", "b", "turn", 3).count() == 0


def test_storm_stream(spark, tmp_path):
    schema = "domain string, ts long, event_id long, kind string, prefix string"
    spark.createDataFrame([("d", i, i, "blocked", "/a/") for i in range(4)] + [("e", 1, 9, "dns", "/")], schema).coalesce(1).write.parquet(str(tmp_path / "in"))
    spark.createDataFrame([("d", 8, 20, "dns", "/a/")], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    q = storms.storm_stream(stream).writeStream.format("memory").queryName("storms").outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination(120)
    got = {(r.domain, r.action, r.failures) for r in spark.table("storms").collect()}
    assert got == {("d", "auto_stop_domain", 3), ("d", "auto_suppress_prefix", 3), ("d", "auto_quarantine_seed", 1), ("e", "auto_quarantine_seed", 1)}


def test_tail_drops_cached_pages(spark, tmp_path):
    schema = "target_url string, content string, fetched_at timestamp"
    t = dt.datetime(2026, 3, 9)
    spark.createDataFrame([("https://www.e.org/a/", "x", t), ("https://e.org/a", "x", t), ("https://e.org/a", "y", t)], schema).write.parquet(str(tmp_path / "in"))
    seen = []
    pages = tail.fresh(tail.landed_stream(spark, str(tmp_path / "in"), spark.read.parquet(str(tmp_path / "in")).schema))
    tail.tail(pages, lambda df, _: seen.extend(df.collect()), str(tmp_path / "c"), once=True).awaitTermination(120)
    assert sorted(r.content for r in seen) == ["x", "y"]


def test_schemas(spark):
    assert len(schemas.fingerprint()) == 64
    assert schemas.drift(schemas.empty(spark, "providers"), "providers") == []
    assert schemas.drift(schemas.empty(spark, "providers").drop("npi"), "providers") == ["npi"]


def test_presets_end_ties_by_record(spark):
    from evigrid.plans import query

    rows = spark.range(40, 0, -1, 4).selectExpr(
        "id AS record_id", "'n' AS provider_name_snapshot", "CAST(id AS STRING) AS practice_name_snapshot", "0.1D AS record_confidence", "'' AS review_status", "'' AS blocked_reason", "1 AS updated_at",
        "0.5D AS outreach_fit_score", "'yes' AS diagnoses_asd", "'' AS diagnoses_adhd", "'active' AS license_status", "1 AS outreach_ready",
    )
    rows.createOrReplaceTempView("provider_practice_records")
    for name in ("low-confidence-records", "outreach-ready"):
        assert [r.practice_name for r in query.preset(spark, name).collect()] == [str(i) for i in range(1, 21)]
