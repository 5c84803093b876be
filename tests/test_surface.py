"""The outer surface: rule and policy files, crawls, controls, agents, files of an export, the command line."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from evigrid import schemas
from evigrid.__main__ import main
from evigrid.functions import text
from evigrid.operators import frontier, render
from evigrid.plans import agents, runs
from evigrid.sources import files, landing, seeds

T0 = dt.datetime(2026, 3, 9)
PAGE = """<html><head><title>Hill Clinic</title></head><body><main>Meet our team. Dr. Ann Lee, PsyD offers autism diagnostic evaluations and ADHD testing for children in Union, NJ.
License status: active. Telehealth visits. Call (201) 555-0100.</main><a href="/intake">Start</a></body></html>"""
RULES = {"rules": [
    {"rule_id": "r1", "state": "NJ", "credential": "PsyD/PhD", "authority": "yes", "active": False}, {"rule_id": "r1", "state": "NJ", "credential": "PsyD/PhD", "authority": "no", "rationale": "Psychologists do not prescribe.", "citation_url": "https://law/1", "active": True},
    {"rule_id": "", "state": "NY"},
]}


def test_rules_and_policies_from_files(spark, tmp_path):
    (tmp_path / "r.json").write_text(json.dumps(RULES))
    (r,) = seeds.read_rules(spark, str(tmp_path / "r.json"), "board").collect()
    assert (r.rule_id, r.authority, r.active, r.schema_name, r.limitations) == ("r1", "no", 1, "board", "")
    (tmp_path / "p.json").write_text('{"domains": {"E.org": "Browser", "p.org": {"mode": "http", "pages": 3}, "q.org": {"pages": 1}}}')
    assert {x.domain: x["mode"] for x in seeds.read_policies(spark, str(tmp_path / "p.json")).collect()} == {"E.org": "browser", "p.org": "http"}


def test_pages_find_their_seed(spark):
    known = spark.createDataFrame([("Hill", "https://www.hill.org/", "NJ", "North", "A", "practice_site", "")], "name string, website string, state string, market string, tier string, source_type string, extraction_profile string")
    pages = spark.createDataFrame([("https://hill.org", "x"), ("https://o.org", "own")], "seed_website string, seed_name string")
    got = {r.seed_website: (r.seed_name, r.tier, r.seed_state) for r in seeds.with_seed(pages, known).collect()}
    assert got == {"https://hill.org": ("Hill", "A", "NJ"), "https://o.org": ("own", "", "")}


def test_crawl_leaves_jobs_results_and_telemetry(spark):
    def row(run, url, status, attempts, minute):
        return ("Hill", "https://hill.org", run, url, status, "x" if status == 200 else "", "", attempts, T0 + dt.timedelta(minutes=minute))

    fetches = spark.createDataFrame(
        [row("1", "https://hill.org/a", 200, 1, 1), row("1", "https://hill.org/b", 200, 1, 2), row("1", "https://hill.org/c", 500, 2, 3), row("1", "https://hill.org/d", 404, 3, 4),
         row("2", "https://hill.org/a", 500, 1, 10), row("3", "https://hill.org/a", 500, 1, 20), row("1", "https://www.hill.org/a/", 200, 0, 5)],
        "seed_name string, seed_website string, run_id string, requested_url string, status_code int, content string, error_message string, attempts int, fetched_at timestamp")
    jobs, results = landing.record_crawl(fetches)
    assert results.where("target_url = 'https://hill.org/a' and status_code = 200").count() == 1
    by = {r.status: (r.attempts, r.success_pages, r.failure_pages, r.last_status_code) for r in jobs.collect()}
    assert by["partial"] == (7, 3, 2, 200) and by["failed"] == (1, 0, 1, 500)
    (t,) = landing.seed_telemetry(jobs).collect()
    assert (t.attempts, t.successes, t.failures, t.success_runs, t.failure_runs, t.consecutive_failures, t.last_run_status) == (9, 3, 4, 1, 3, 2, "failed")


def test_links_expand_level_by_level(spark):
    html = '<a href="/providers">p</a><a href="/privacy">x</a><a href="https://o.org/">o</a><a href="/team/a">t</a><a href="mailto:a@b.c">m</a><a href="/staff">s</a>'
    pages = spark.createDataFrame([("https://e.org/", html, "https://e.org/", "practice_site", 0), ("https://e.org/deep", html, "https://e.org/", "practice_site", 2)], "url string, html string, seed string, source_type string, depth int")
    seen = spark.createDataFrame([("https://e.org/",), ("https://e.org/staff",)], "url string")
    got = {r.url: r.depth for r in frontier.expanded(pages, seen, 2, 10).collect()}
    assert got == {"https://e.org/providers": 1, "https://e.org/team/a": 1}
    assert frontier.expanded(pages, seen.limit(0), 2, 1).count() == 1


def test_runtime_and_controls_live_in_one_document(tmp_path):
    path = str(tmp_path / "c.json")
    crawl, operator = runs.Controls(path), runs.Controls(path)
    crawl.observe("e.org", status="running", failure_pages=2, last_error="blocked")
    operator.apply("cap-domain", "e.org", "large", max_pages=4)
    crawl.succeeded("e.org", success_pages=1)
    again = runs.Controls(path)
    assert again.state["runtime"]["e.org"] | {"updated_at": ""} == {"status": "running", "failure_pages": 2, "success_pages": 1, "last_error": "", "updated_at": ""}
    assert again.limits("e.org", {"pages": 30, "browser_pages": 2}) | {} == {"pages": 4, "browser_pages": 2, "suppressed_prefixes": [], "stop": False, "quarantined": False}
    assert again.escalate("e.org", "blocked", "auto", True, 5, 9) and not again.escalate("e.org", "blocked", "auto", True, 5, 9)
    assert not again.escalate("o.org", "blocked", "http_only", True, 5, 9) and not again.escalate("o.org", "blocked", "auto", True, 5, 0)
    assert [i["action"] for i in runs.Controls(path).summary()["recent_interventions"]] == ["cap-domain", "browser_escalation"]


def test_sessions_keep_their_order_when_reopened(spark, tmp_path):
    first = runs.Sessions(spark, str(tmp_path / "s"))
    first.add_all("s", "t", [("turn", "user", f"turn-{i}") for i in range(3)])
    runs.Sessions(spark, str(tmp_path / "s")).add("s", "t", "turn", "user", "turn-3")
    third = runs.Sessions(spark, str(tmp_path / "s"))
    third.add("u", "t", "turn", "user", "other")
    assert [r.content for r in third.last("s", "t", "turn", 2).collect()] == ["turn-2", "turn-3"] and third.latest_session("T") == "u"


def test_tools_are_audited_and_remembered(spark, tmp_path):
    def failing(_):
        raise RuntimeError("lost")

    box = agents.Toolbox({"sync": lambda a: {"run_id": "r9", "summary": {"n": 1}}, "status": failing, "control_apply": lambda a: {"ok": True}}, runs.Sessions(spark, str(tmp_path / "s")), agents.Memory(spark, str(tmp_path / "m")), "T")
    with pytest.raises(runs.PolicyError):
        box.invoke("s", "sync", {"reason": ""})

    class Model:
        def generate(self, goal, history):
            calls = [("sync", {"reason": "go"}), ("status", {"reason": "look"}), ("sql", {"reason": "x", "query": "select 1"}), ("control_apply", {"reason": "noise", "action": "suppress-prefix", "domain": "https://www.E.org/x", "prefix": "tag"})]
            return agents.Reply("done" if history else "start", [] if history else calls)

    seen = []
    end = agents.run_agent(Model(), box, "s", "goal", trace=lambda kind, what: seen.append(kind))
    assert end["status"] == "completed" and end["calls"] == {"control_apply": 1, "status": 1, "sync": 1} and end["recommended_next_actions"] == ["repeat status", "export"]
    assert seen == ["turn", "tool", "tool", "tool", "tool", "turn"] and [r.content for r in box.sessions.last("s", "t", "turn", 9).collect()] == ["goal", "start", "done"]
    assert box.memory.get("run", "r9")["summary"] == {"n": 1} and box.memory.get("tactic", "e.org")["value"] == "tag" and box.memory.get("run", "none") is None
    box.memory.put("client", "c", {"v": 1})
    box.memory.put("client", "c", {"v": 2})
    assert [json.loads(r.content) for r in box.memory.latest("client").collect()] == [{"v": 2}]
    assert box.memory.latest("tactic", at="2000-01-01").count() == 1 and box.memory.latest("tactic", at="9999-01-01").count() == 0
    strict = agents.nullable({"properties": {"a": {"type": "string"}, "b": {"type": "string", "enum": ["x"]}}, "required": ["a"]})
    assert strict["required"] == ["a", "b"] and strict["properties"]["b"] == {"type": ["string", "null"], "enum": ["x", None]}


def test_documents_are_replaced_with_what_hangs_on_them(spark):
    pages = spark.createDataFrame([("https://e.org/a", "x", "A", "b", T0), ("https://e.org/a", "x", "A", "b", T0 + dt.timedelta(1)), ("https://e.org/b", "y", "A", "b", T0)], "source_url string, content string, source_tier string, source_type string, fetched_at timestamp")
    docs = landing.source_documents(pages)
    assert docs.count() == 2 and docs.where("source_url = 'https://e.org/a'").first().fetched_at == T0 + dt.timedelta(1)
    old = spark.createDataFrame([("d1", "r1"), ("d1", "r2"), ("d2", "r3")], "source_document_id string, extracted_id string")
    new = spark.createDataFrame([("d1", "r4"), ("d3", "r5")], "source_document_id string, extracted_id string")
    assert sorted(r.extracted_id for r in landing.replaced(old, new, "source_document_id").collect()) == ["r3", "r4", "r5"]


def test_migrations_are_noted_once(spark, tmp_path):
    folder = str(tmp_path / "t")
    assert len(schemas.migrate(spark, folder)) == len(schemas.TABLES) and schemas.migrate(spark, folder) == []
    assert [r.fingerprint for r in spark.read.parquet(f"{folder}/schema_migrations").collect()] == [schemas.fingerprint()]


def test_json_arrays(spark):
    rows = spark.createDataFrame([('["a", " b ", ""]',), ("plain",), ("",), (None,), ("[broken",), ("[1, 2]",)], "x string")
    assert [r[0] for r in rows.select(text.json_array(F.col("x"))).collect()] == [["a", "b"], ["plain"], [], [], ["[broken"], ["1", "2"]]


def test_documents():
    body = "# Title (x)\n\n## Part\n- a < b\n- c\nline\n" + "word " * 3000
    page = render.to_html(body)
    assert "<h1>Title (x)</h1>" in page and "<li>a &lt; b</li>" in page and page.count("<ul>") == page.count("</ul>") == 1
    pdf = render.to_pdf(body)
    assert pdf.startswith(b"%PDF-1.4") and pdf.rstrip().endswith(b"%%EOF") and b"(Title \\(x\\))" in pdf and pdf.count(b"/Type /Page ") > 2


def test_files_on_any_file_system(spark, tmp_path):
    for folder in (str(tmp_path / "a"), f"file://{tmp_path}/b"):
        path = files.join(folder, "x.json")
        assert not files.exists(path) and files.latest(folder) is None
        files.write_bytes(path, b"one")
        files.write_bytes(path, b"two")
        assert files.read_bytes(path) == b"two" and files.latest(folder, ".json").endswith("x.json")


def test_command_line(spark, tmp_path, capsys):
    store = f"file://{tmp_path}/store"

    def call(*argv):
        code = main(["--store", store, *argv], spark)
        return code, json.loads(capsys.readouterr().out.strip().splitlines()[-1])

    rows = [("https://hill.org/team", PAGE, 200, "https://hill.org"), ("https://hill.org/x", "<p>Access denied</p>", 200, "https://hill.org")]
    spark.createDataFrame(rows, "url string, html string, status_code int, seed_website string").write.parquet(str(tmp_path / "pages"))
    (tmp_path / "seeds.json").write_text('{"sources": [{"name": "Hill", "website": "https://hill.org", "state": "NJ", "tier": "A", "source_type": "practice_site"}]}')
    (tmp_path / "rules.json").write_text(json.dumps(RULES))
    assert call("doctor")[1]["data"]["ok"] is False and call("init")[0] == 0 and call("doctor")[1]["data"]["ok"] is True
    assert call("status")[1]["data"] == {"status": "none"}
    code, out = call("sync", "--pages", str(tmp_path / "pages"), "--seeds", str(tmp_path / "seeds.json"), "--rules", str(tmp_path / "rules.json"), "--run-id", "r1")
    assert code == 0 and out["data"]["summary"]["approved_records"] == 1 and out["data"]["report"]["sales_count"] == 1
    root = tmp_path / "store/out/export"
    assert json.loads((root / "provider_records_r1.json").read_text())[0]["provider_name"] == "Ann Lee"
    assert (root / "sales_report_r1.csv").read_text().startswith("record_id,provider_name,") and len(list(root.rglob("profile.pdf"))) == 1
    assert len(list(root.rglob("lead_intelligence.json"))) == 1 and (root / "review_queue_r1").is_dir()
    assert call("status")[1]["data"]["run_id"] == "r1" and len(call("search", "ann")[1]["data"]) == 1
    assert call("sql", "SELECT count(*) AS n FROM providers")[1]["data"] == [{"n": 1}]
    assert call("sql", "DROP TABLE providers")[0] == 2 and call("control", "cap-domain", "e.org")[0] == 2
    assert call("control", "cap-domain", "e.org", "--max-pages", "3")[1]["data"]["capped_domains"] == {"e.org": 3}
    assert call("sync", "--pages", "nowhere", "--seeds", "x", "--rules", "y", "--run-id", "r2")[0] == 1
