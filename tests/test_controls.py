"""Live controls: what is set between micro-batches holds from the next one on, and no writer's change is lost."""

import threading
import time

from pyspark.sql import functions as F

from evigrid.plans import runs
from evigrid.streaming import controls, domains, tail

PAGE = "url string, domain string"


def held(live):
    return {r.domain: (r.quarantined, r.stop_requested, r.discovery, r.max_pages, r.suppressed_prefixes) for r in live.current().collect()}


def test_controls_hold_from_the_next_micro_batch(spark, tmp_path):
    live, seen, folder = controls.LiveControls(spark, f"file://{tmp_path}/controls"), {}, str(tmp_path / "in")

    def landed(n):
        rows = [(d, sum(u.count(f"//{d}/") for k, us in seen.items() if k < n for u in us)) for d in ("e.org", "o.org", "p.org")]
        return spark.createDataFrame(rows, "domain string, pages long")

    def land(*urls):
        spark.createDataFrame([(u, "kept") for u in urls], PAGE).coalesce(1).write.mode("append").parquet(folder)
        stream = tail.landed_stream(spark, folder, spark.read.parquet(folder).schema)
        batch = controls.live(live, lambda df, n: seen.__setitem__(n, sorted(r.url for r in df.collect())), landed=landed)
        tail.tail(stream, batch, str(tmp_path / "check"), once=True).awaitTermination(120)
        return seen[max(seen)]

    urls = ["https://e.org/a/1", "https://e.org/ab", "https://o.org/1", "https://o.org/2", "https://p.org/1"]
    assert land(*urls) == urls
    live.apply("suppress-prefix", "e.org", "noise", prefix="a")
    live.apply("cap-domain", "o.org", "large", max_pages=3)
    live.apply("stop-domain", "p.org", "enough")
    assert land(*urls) == ["https://e.org/ab", "https://o.org/1"]
    live.apply("clear-domain", "p.org", "again")
    live.apply("clear-domain", "o.org", "again")
    assert land(*urls) == ["https://e.org/ab", "https://o.org/1", "https://o.org/2", "https://p.org/1"]


def test_interventions_are_recorded_once(spark, tmp_path):
    live = controls.LiveControls(spark, f"file://{tmp_path}/controls", 4)
    assert held(live) == {}
    rows = [("e.org", "auto_stop_domain", "blocked_storm", "", 7, 3, None), ("e.org", "auto_suppress_prefix", "blocked_storm", "/x/", 8, 3, None), ("f.org", "observed", "", "", 9, 0, 4), ("g.org", "auto_quarantine_seed", "dns_failure", "", 1, 1, None)]
    found = spark.createDataFrame(rows, domains.OUTPUT)
    live.record(found)
    want = {"e.org": (False, True, False, None, ["/x/"]), "g.org": (True, True, False, None, [])}
    assert held(live) == want
    live.apply("clear-domain", "g.org", "mended")
    live.record(found)
    assert held(live) == {"e.org": want["e.org"]}
    live.record(found.withColumn("event_id", F.col("event_id") + 100))
    assert held(live) == want


def test_of_two_writers_at_once_none_is_lost(spark, tmp_path):
    root = f"file://{tmp_path}/controls"
    writers = [threading.Thread(target=lambda n=n: controls.LiveControls(spark, root, 1).apply("stop-domain", f"d{n}.org", "x")) for n in range(3)]
    for w in writers:
        w.start()
    for w in writers:
        w.join()
    assert set(held(controls.LiveControls(spark, root, 1))) == {"d0.org", "d1.org", "d2.org"}


def test_admission_keeps_all_columns(spark):
    pages = spark.createDataFrame([("https://e.org/a", "mine"), (None, "none"), ("https://e.org/a", "mine")], PAGE)
    none = spark.createDataFrame([], controls.HELD)
    got = controls.admitted(pages, none)
    assert got.columns == ["url", "domain"] and got.count() == 3 and controls.admitted(pages.limit(0), none).count() == 0
    capped = spark.createDataFrame([("e.org", False, False, True, 1, [])], controls.HELD)
    assert sorted(r.domain for r in controls.admitted(pages, capped).collect()) == ["mine", "none"]


def test_documents_of_controls_lose_no_change(tmp_path):
    path = str(tmp_path / "c.json")

    def write(n):
        mine = runs.Controls(path)
        for i in range(15):
            mine.apply("suppress-prefix", "e.org", f"{n}-{i}", prefix=f"p{n}x{i}") if n % 2 else mine.observe(f"d{n}.org", status="running", pages=i)
            time.sleep(0.001)

    writers = [threading.Thread(target=write, args=(n,)) for n in range(4)]
    for w in writers:
        w.start()
    for w in writers:
        w.join()
    end = runs.Controls(path)
    assert len(end.state["domains"]["e.org"]["suppressed_prefixes"]) == 30 and len(end.state["interventions"]) == 30
    assert {d: r["pages"] for d, r in end.state["runtime"].items()} == {"d0.org": 14, "d2.org": 14}
    assert len(list(tmp_path.glob("c.json.v*"))) <= 22


def test_a_run_is_finalised(tmp_path):
    path = str(tmp_path / "c.json")
    crawl = runs.Controls(path)
    crawl.observe("e.org", status="running", success_pages=1)
    crawl.observe("f.org", status="running", last_error="blocked")
    crawl.observe("g.org", status="completed")
    runs.Controls(path).finalise("failed", message="driver crashed")
    got = {d: (r["status"], r["last_error"]) for d, r in crawl.refresh()["runtime"].items()}
    assert got == {"e.org": ("failed", "driver crashed"), "f.org": ("failed", "blocked"), "g.org": ("completed", "")} and crawl.state["status"] == "failed"
