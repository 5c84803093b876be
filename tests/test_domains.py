"""A crawl's domains as a state machine: the stream, stopped and restarted, gives the batch plan's rows."""

import datetime as dt
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from evigrid.streaming import domains

SCHEMA = "domain string, at timestamp, event_id long, kind string, prefix string, error string, escalation string, browser_pages int"
START = dt.datetime(2026, 3, 9)
LIMIT = 6


def history(rng, n, first=0):
    out = []
    for i in range(first, first + n):
        kind = rng.choice([None, None, "blocked", "not_found", "not_found", "dns", "error"]) if rng.random() < 0.9 else None
        domain = rng.choice(["hot"] * 4 + list("abcdefg"))
        block = "status:403" if kind == "blocked" else None
        out.append((domain, START + dt.timedelta(seconds=i // 3), i, kind, rng.choice(["/", "/x/", "/y/", "/z/"]), rng.choice(["", "boom " * 80]) if kind else "", block, 0 if domain in "abc" else 2))
    return out


def plain(rows):
    """The fetches one by one, as a crawl sees them."""
    found, state = [], {}
    for domain, _, i, kind, prefix, error, block, browser in sorted(rows, key=lambda r: (r[1], r[2])):
        s = state.setdefault(domain, {"kinds": {}, "prefixes": {}, "pages": 0, "failures": 0, "error": "", "browser": False})
        if kind is None:
            s["pages"], s["error"] = s["pages"] + 1, ""
            continue
        s["failures"], s["error"] = s["failures"] + 1, (error or kind)[:240]
        n = s["kinds"][kind] = s["kinds"].get(kind, 0) + 1
        if {"dns": 1, "blocked": 3, "not_found": 8}.get(kind) == n:
            action = {"dns": "auto_quarantine_seed", "blocked": "auto_stop_domain", "not_found": "auto_disable_discovery"}[kind]
            found.append((domain, action, "dns_failure" if kind == "dns" else f"{kind}_storm", "", i, n))
        if prefix != "/":
            n = s["prefixes"][prefix] = s["prefixes"].get(prefix, 0) + 1
            if n == 3:
                found.append((domain, "auto_suppress_prefix", f"{kind}_storm", prefix, i, n))
        if block and browser > 0 and not s["browser"] and s["pages"] < LIMIT:
            s["browser"] = True
            found.append((domain, "browser_escalation", block, "", i, None))
    return sorted(found, key=str), {d: (s["error"], s["failures"], s["pages"]) for d, s in state.items()}


def land(spark, rows, folder):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def run(spark, tmp_path, known=None, forget_after=0, out="out"):
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    if forget_after:
        stream = stream.withWatermark("at", "1 second")
    states = domains.domain_stream(stream, LIMIT, known, forget_after)
    write = lambda df, n: df.withColumn("batch", F.lit(n)).write.mode("append").parquet(str(tmp_path / out))
    domains.with_state(spark, lambda: states.writeStream.foreachBatch(write).outputMode("update").option("checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True).start().awaitTermination(240))
    return spark.read.parquet(str(tmp_path / out))


def acts(df):
    return sorted((tuple(r) for r in df.where("action NOT IN ('observed', 'forgotten')").select(*domains.INTERVENTIONS).collect()), key=str)


def states(df):
    last = df.where("action = 'observed'").groupBy("domain").agg(F.max_by(F.struct("reason", "failures", "pages"), "batch").alias("s"))
    return {r.domain: tuple(r.s) for r in last.collect()}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_batch_plan_equals_a_walk(spark, seed):
    rows = history(random.Random(seed), 400)
    want, held = plain(rows)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert sorted((tuple(r) for r in domains.interventions(df, LIMIT).collect()), key=str) == want and want
    assert {r.domain: (r.error, r.failures, r.pages) for r in domains.observed(df).collect()} == held
    assert domains.interventions(df.limit(0), LIMIT).count() == 0 and not [r for r in domains.interventions(df, 0).collect() if r.action == "browser_escalation"]


def test_a_restarted_stream_equals_the_batch_plan(spark, tmp_path):
    rows = history(random.Random(7), 240)
    want, held = plain(rows)
    parts = [rows[:30], rows[30:60], rows[60:150], rows[150:]]
    for part in parts[:2]:
        land(spark, random.Random(1).sample(part, len(part)), str(tmp_path / "in"))
    before = spark.conf.get(domains.STORE)
    run(spark, tmp_path)
    for part in parts[2:]:
        land(spark, part, str(tmp_path / "in"))
    out = run(spark, tmp_path)
    assert out.select("batch").distinct().count() == 4 and spark.conf.get(domains.STORE) == before
    assert acts(out) == want and states(out) == held


def test_a_stream_goes_on_from_what_earlier_runs_counted(spark, tmp_path):
    rows = history(random.Random(9), 200)
    cut = rows[89][2]
    want, held = plain(rows)
    land(spark, rows[90:], str(tmp_path / "in"))
    out = run(spark, tmp_path, domains.totals(spark.createDataFrame(rows[:90], SCHEMA), LIMIT))
    assert acts(out) == [w for w in want if w[4] > cut]
    assert {d: s[1:] for d, s in states(out).items()} == {d: held[d][1:] for d in {r[0] for r in rows[90:]}}


def test_a_silent_domain_is_forgotten(spark, tmp_path):
    def fetch(i, domain, seconds, kind="blocked"):
        return (domain, START + dt.timedelta(seconds=seconds), i, kind, "/", "", None, 0)

    for part in ([fetch(1, "d", 0), fetch(2, "d", 1)], [fetch(3, "e", 500, None)], [fetch(4, "e", 501, None)], [fetch(5, "d", 502)]):
        land(spark, part, str(tmp_path / "in"))
    out = run(spark, tmp_path, forget_after=60_000)
    gone = [(r.domain, r.reason, r.failures) for r in out.where("action = 'forgotten'").collect()]
    assert gone == [("d", "blocked", 2)] and acts(out) == []
    assert states(out)["d"] == ("blocked", 1, 0)


class Kept:
    """A value or map of a state's handle, which notes what is asked of it."""

    def __init__(self, calls):
        self.calls, self.held = calls, {}

    def exists(self):
        return self.containsKey(())

    def get(self):
        return self.getValue(())

    def update(self, value):
        self.updateValue((), value)

    def containsKey(self, key):
        self.calls.append(key)
        return key in self.held

    def getValue(self, key):
        self.calls.append(key)
        return self.held[key]

    def updateValue(self, key, value):
        self.calls.append(key)
        self.held[key] = value


def test_a_domain_costs_a_few_exchanges_with_the_state():
    """Each is a message to the JVM and back; there were three or so for every kind, prefix and total, which with a frame for each domain made 35 ms a domain."""
    calls = []
    state = domains.DomainState(LIMIT)
    state.init(type("Handle", (), {"getMapState": lambda *_: Kept(calls), "getValueState": lambda *_: Kept(calls)})())
    rows = history(random.Random(3), 60)

    def arrive(some):
        calls.clear()
        fetches = [(int((at - START).total_seconds()), i, kind, prefix if kind and prefix != "/" else None, (error or kind or "")[:240], block if browser else None) for _, at, i, kind, prefix, error, block, browser in some]
        packed = [("d", *zip(*fetches[i : i + 9])) for i in range(0, len(fetches), 9)]
        return [tuple(r) for r in state.handleInputRows(("d",), iter(packed), None)]

    want, held = plain([("d", *r[1:]) for r in rows])
    first = arrive(rows[:40])
    assert len(calls) == 2
    second = arrive(rows[40:])
    assert len(calls) == 3
    assert sorted((r[:6] for r in first + second if r[1] != "observed"), key=str) == want
    assert (second[-1][2], *second[-1][5:]) == held["d"]


def test_packed_fetches_are_all_fetches(monkeypatch):
    rng = random.Random(5)
    rows = [(rng.choice(["hot", "hot", "hot", None, *"abcdefgh"]), i, i, rng.choice([None, "dns"]), rng.choice([None, "/x/"]), "", None) for i in range(3000)]
    batches = [pa.RecordBatch.from_pylist([dict(zip(["domain", *domains.PACKED], r)) for r in rows[i : i + 500]], pa.schema([("domain", pa.string()), *((n, pa.int64() if t == "long" else pa.string()) for n, t in domains.PACKED.items())])) for i in range(0, 3000, 500)]
    for most in (1, 40_000, domains.PACK_BYTES):
        monkeypatch.setattr(domains, "PACK_BYTES", most)
        lists = [r for b in domains._pack(iter([batches[0].slice(0, 0), *batches])) for r in b.to_pylist()]
        assert max(len(r["place"]) for r in lists) <= domains.AT_ONCE and len(lists) < 400
        back = [(r["domain"], *f) for r in lists for f in zip(*(r[n] for n in domains.PACKED), strict=True)]
        assert sorted(back, key=lambda r: r[1]) == rows


@pytest.mark.parametrize("zone", ["timestamp_ltz", "timestamp_ntz"])
def test_a_stream_orders_by_instant_and_takes_nulls(spark, tmp_path, zone):
    """Where clocks go back an hour, an instant after another has an earlier local time; a null time or id comes first and is no failure."""
    rows = [("d", "2026-11-01 05:50:00", 1, None, "/", None, None, 2), ("d", "2026-11-01 06:10:00", 2, "blocked", None, None, "status:403", 2), ("d", None, 3, "dns", "/x/", "", None, None), (None, "2026-11-01 06:10:00", None, "not_found", "/y/", "", None, 0)]
    at = "CAST(at AS timestamp_ntz)" if zone == "timestamp_ntz" else "to_timestamp_ltz(concat(at, 'Z'))"
    spark.createDataFrame(rows, SCHEMA.replace("timestamp", "string")).withColumn("at", F.expr(at)).coalesce(1).write.parquet(str(tmp_path / "in"))
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        stream = spark.readStream.schema(SCHEMA.replace("at timestamp", f"at {zone}")).parquet(str(tmp_path / "in"))
        out = domains.stored(domains.domain_stream(stream, LIMIT), str(tmp_path / "out")).drop("batch")
        got = {tuple(r) for r in out.collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert got == {
        ("d", "auto_quarantine_seed", "dns_failure", "", 3, 1, None), ("d", "browser_escalation", "status:403", "", 2, None, None), ("d", "observed", "blocked", "", 2, 2, 1),
        (None, "observed", "not_found", "", None, 1, 0),
    }


def test_many_prefixes_are_counted_apart_from_the_others(spark, tmp_path):
    fetches = [("d", START + dt.timedelta(seconds=i), i, "error", f"/p{i % 100}/", "", None, 0) for i in range(400)]
    for part in (fetches[:150], fetches[150:220], fetches[220:]):
        land(spark, part, str(tmp_path / "in"))
    known = domains.totals(spark.createDataFrame([("d", START, 0, "error", f"/p{i}/", "", None, 0) for i in range(40)], SCHEMA), LIMIT)
    out = run(spark, tmp_path, known)
    assert {(r.detail, r.event_id) for r in out.where("action = 'auto_suppress_prefix'").collect()} == {(f"/p{i}/", i + (100 if i < 40 else 200)) for i in range(100)}
    assert states(out)["d"] == ("error", 440, 0)
