"""Ordered resolution held against a plain fold that walks from row to row."""

import hashlib
import random
import re

import pytest

from evigrid.operators import resolve

COLUMNS = "extracted_id created_at provider_name credentials npi practice_name source_url city state phone license_state license_type license_status source_type diagnoses_asd diagnoses_adhd telehealth".split()
SCHEMA = ", ".join(f"{c} {'long' if c == 'created_at' else 'string'}" for c in COLUMNS) + ", age_groups array<string>, evidence array<struct<field:string,value:string,quote:string,source_url:string>>"
MORE = "intake_url address_1 zip metro fax insurance_notes waitlist_notes referral_requirements source_document_id source_tier extraction_profile".split()


def pk(prefix, *parts):
    return prefix + "_" + hashlib.sha1("|".join(p.strip().lower() for p in parts).encode()).hexdigest()[:16]


def domain(url):
    return re.sub(r"^www\.", "", re.sub(r"^[a-z]+://", "", url.lower()).split("/")[0])


def plain_fold(rows):
    """The tables after all rows, each row looking up what the ones before it left."""
    providers, records, practices, assigned = {}, {}, {}, {}

    def look_up(r):
        board, name = r["source_type"] == "licensing_board", r["provider_name"].lower()
        wanted = (r["license_state"] or r["state"]).lower()
        if r["npi"]:
            for i, p in providers.items():
                if p["npi"] == r["npi"]:
                    return i, "npi"
        if name and not board:
            for q in records.values():
                if r["state"] and q["name"].lower() == name and q["license_state"].lower() == r["state"].lower() and domain(r["source_url"]) in practices[q["practice"]].lower():
                    return q["provider"], "domain_state"
            for q in records.values():
                if r["city"] and r["phone"] and q["name"].lower() == name and q["city"].lower() == r["city"].lower() and q["phone"] == r["phone"]:
                    return q["provider"], "city_phone"
        if name and wanted:
            for i, p in providers.items():
                if p["name"].lower() == name and p["state"].lower() == wanted:
                    return i, "name_state"
            for q in records.values():
                if q["name"].lower() == name and q["license_state"].lower() == wanted:
                    return q["provider"], "name_state"
        return None

    for r in sorted(rows, key=lambda r: (r["created_at"], r["extracted_id"])):
        board = r["source_type"] == "licensing_board"
        makes = bool(r["provider_name"]) and not board
        found = look_up(r) if board or makes else None
        own = pk("prov", r["provider_name"], r["credentials"], r["state"], r["npi"] or r["source_url"])
        provider, how = found or ((own, "new") if makes else ("", "none"))
        assigned[r["extracted_id"]] = (provider, how)
        if not provider:
            continue
        p = providers.setdefault(provider, dict.fromkeys(("name", "credentials", "npi", "state", "type"), ""))
        state = r["license_state"] if makes else r["license_state"] or r["state"]
        kind = "" if board and r["license_type"] == "unknown" else r["license_type"]
        for key, value in (("name", r["provider_name"]), ("credentials", r["credentials"]), ("npi", r["npi"]), ("state", state), ("type", kind)):
            p[key] = value or p[key]
        if makes:
            practice = pk("prac", r["practice_name"], domain(r["source_url"]))
            practices[practice] = r["source_url"]
            place = pk("loc", practice, r["city"], r["state"], r["phone"] or domain(r["source_url"]))
            q = records.setdefault(pk("rec", provider, practice, place, r["state"]), {"provider": provider, "practice": practice, "city": r["city"], "phone": r["phone"], "npi": "", "license_state": "", "license_status": "unknown", "urls": []})
            q["name"] = r["provider_name"]
            touched = [q]
        else:
            touched = [q for q in records.values() if q["provider"] == provider and (not state or q["license_state"].lower() == state.lower())]
        for q in touched:
            q["npi"], q["license_state"] = r["npi"] or q["npi"], state or q["license_state"]
            if r["license_status"] != "unknown":
                q["license_status"] = r["license_status"]
            if r["source_url"] not in q["urls"]:
                q["urls"].append(r["source_url"])
    return providers, records, assigned


def history(rng, n, rows):
    """Rows of few people, numbers and places, so that keys are shared, replaced and set by boards."""
    out = []
    for _ in range(rows):
        board = rng.random() < 0.3
        host = rng.choice(("hill", "lake", "the-hill", "www.hill"))
        out.append({
            "provider_name": "" if rng.random() < 0.1 else f"{rng.choice(('Ann', 'Bo', 'ann'))} Q{n:04d}", "credentials": rng.choice(("PsyD", "")), "npi": rng.choice(("", "", f"{n:04d}1", f"{n:04d}2", f"{n:04d}3")),
            "practice_name": rng.choice(("One", "Two")), "source_url": rng.choice((f"https://{host}-{n:04d}.org/{rng.choice('ab')}", f"https://web.net/x/hill-{n:04d}.org/{rng.choice('ab')}")),
            "city": rng.choice(("", "Union", "Edison")), "state": rng.choice(("NJ", "NY", "")), "phone": rng.choice(("", "1", "2")), "license_state": rng.choice(("", "NJ", "NY", "nj")),
            "license_type": rng.choice(("unknown", "physician")), "license_status": rng.choice(("unknown", "active", "inactive")), "source_type": "licensing_board" if board else "practice_site",
        })
    return out


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(8)
    rows = [r for n in range(1000) for r in history(rng, n, rng.randint(2, 9))]
    rng.shuffle(rows)
    return [dict(r, extracted_id=f"e{i:06d}", created_at=rng.randrange(3000)) for i, r in enumerate(rows)]


@pytest.fixture(scope="module")
def folded(rows):
    return plain_fold(rows)


def frame(spark, rows):
    from pyspark.sql import functions as F

    made = spark.createDataFrame([tuple(r.get(c, "") for c in COLUMNS) + (["child"], []) for r in rows], SCHEMA).repartition(5)
    return made.withColumns({c: F.lit("") for c in MORE})


def test_a_thousand_histories_equal_a_fold_from_row_to_row(spark, rows, folded):
    tables = resolve.resolve_rows(frame(spark, rows))
    providers, records, assigned = folded
    assert {r.extracted_id: r.provider_id for r in tables["assigned"].collect()} == {i: a[0] for i, a in assigned.items()}
    got = {r.provider_id: (r.provider_name, r.credentials, r.npi, r.primary_license_state, r.primary_license_type) for r in tables["providers"].collect()}
    assert got == {i: (p["name"], p["credentials"], p["npi"], p["state"], p["type"]) for i, p in providers.items()}
    got = {r.record_id: (r.provider_id, r.provider_name_snapshot, r.npi, r.license_state, r.license_status, r.source_urls) for r in tables["provider_practice_records"].collect()}
    assert got == {i: (q["provider"], q["name"], q["npi"], q["license_state"], q["license_status"], q["urls"]) for i, q in records.items()}
    hows = {how for _, how in assigned.values()}
    assert hows == {"npi", "domain_state", "city_phone", "name_state", "new", "none"}


def test_which_lookup_matched(spark, rows, folded):
    got = {r.extracted_id: r.matched_by for r in resolve.assign_providers(frame(spark, rows)).select("extracted_id", "matched_by").collect()}
    assert got == {i: a[1] for i, a in folded[2].items()}


def row(i, **values):
    return {"extracted_id": f"e{i}", "created_at": i, "source_url": "https://hill.org/a", "practice_name": "Hill", "state": "NJ", "license_state": "NJ", "license_type": "unknown", "license_status": "unknown", "source_type": "practice_site"} | values


def test_a_board_sets_the_number_that_later_rows_are_found_by(spark):
    rows = [row(0, provider_name="Ann Lee"), row(1, provider_name="Ann Lee", npi="111", source_type="licensing_board"), row(2, provider_name="Ann Lee-Smith", npi="111", state="NY", license_state="NY", source_url="https://x.org/")]
    got = {r.extracted_id: (r.provider_id, r.matched_by) for r in resolve.assign_providers(frame(spark, rows)).collect()}
    assert got["e2"] == (got["e0"][0], "npi") and got["e1"] == (got["e0"][0], "name_state")


def test_a_replaced_number_finds_nobody(spark):
    rows = [row(0, provider_name="Bo Roe", npi="222"), row(1, provider_name="Bo Roe", npi="333"), row(2, provider_name="Cy Poe", npi="222", source_url="https://x.org/")]
    got = {r.extracted_id: (r.provider_id, r.matched_by) for r in resolve.assign_providers(frame(spark, rows)).collect()}
    assert got["e1"][0] == got["e0"][0] and got["e2"][1] == "new"


def test_domains_within_addresses(spark):
    urls = ["https://www.my-hill.org/x", "https://web.net/hill.org/b", "http://hill.org.uk", "https://lake.com/?q=hill.org", "nothing", "https://HILL.org"]
    domains = ["hill.org", "lake.com", "org", "web.net", "zzz.zz", "a"]
    got = resolve.containing(spark.createDataFrame([(d,) for d in domains], "domain string"), spark.createDataFrame([(u,) for u in urls], "url string"))
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Join Cross" not in plan and "Cartesian" not in plan
    assert {tuple(r) for r in got.collect()} == {(d, u) for d in domains for u in urls if d in u.lower()}
    assert resolve.containing(spark.createDataFrame([], "domain string"), spark.createDataFrame([(u,) for u in urls], "url string")).count() == 0


def test_spans_of_a_key_over_many_ranges(spark):
    rng = random.Random(1)
    events = [(rng.choice("ab"), p, p // 7, rng.choice((None, "x", "x", "y")), f"e{p}") for p in range(200)]
    got = [(r.key, r.v, r.since, r.until, r.born, r.id) for r in resolve.spans(spark.createDataFrame(events, "key string, pos long, split long, v string, id string"), "key", ["v"], "id").collect()]
    want = []
    for key in "ab":
        mine, state, starts = [e for e in events if e[0] == key], object(), []
        held = None
        for e in mine:
            held = e[3] or held
            if held != state:
                starts.append((held, e[1], e[4]))
                state = held
        ends = [s[1] for s in starts[1:]] + [None]
        want += [(key, v, since, until, mine[0][1], i) for (v, since, i), until in zip(starts, ends, strict=True)]
    assert sorted(want, key=str) == sorted(got, key=str)


def test_holders_of_a_key_over_many_ranges(spark):
    rng = random.Random(5)
    places = [(split << 33) + i for split in range(11) for i in range(20)]
    held = []
    for _ in range(120):
        since, until = sorted(rng.sample(places, 2))
        held.append((rng.choice("ab"), rng.randrange(4), since, rng.choice((until, until, None)), rng.choice(places)))
    each = [(key, p) for key in "abc" for p in places if rng.random() < 0.7]
    want = set()
    for key, p in each:
        found = [(k, b, s) for h, k, s, u, b in held if h == key and s < p and (u is None or u >= p)]
        want |= {(p, *min(found))} if found else set()
    from pyspark.sql import functions as F

    each, held = spark.createDataFrame(each, "key string, pos long"), spark.createDataFrame(held, "key string, rank int, since long, until long, born long")
    for hot in (None, spark.createDataFrame([("a",)], "key string")):
        assert {tuple(r) for r in resolve.holders(each, held, F.lit(11), hot).collect()} == want


def test_histories_with_hot_keys(spark, rows, folded, monkeypatch):
    monkeypatch.setattr(resolve, "HOT_PROBES", 3)
    got = {r.extracted_id: (r.provider_id, r.matched_by) for r in resolve.assign_providers(frame(spark, rows)).collect()}
    assert got == folded[2]


def test_later_rounds_look_up_changed_keys_only(spark, rows, folded, monkeypatch):
    asked, holders = [], resolve.holders
    monkeypatch.setattr(resolve, "PARTS_FROM", 0, raising=False)
    monkeypatch.setattr(resolve, "holders", lambda each, *a: asked.append(each.count()) or holders(each, *a))
    got = {r.extracted_id: (r.provider_id, r.matched_by) for r in resolve.assign_providers(frame(spark, rows)).collect()}
    assert got == folded[2]
    assert len(asked) > 3 and asked[-1] < asked[0] / 10


def test_spans_at_once_are_those_of_dealt_keys(spark):
    rng = random.Random(3)
    events = [(rng.choice("abcd"), p, p // 7, rng.choice((None, "x", "x", "y")), rng.choice((None, "1", "2")), f"e{p}") for p in range(300)]
    events = spark.createDataFrame(events, "key string, pos long, split long, v string, w string, id string")
    assert sorted(map(str, resolve._spans_at_once(events, "key", ["v", "w"], "id").collect())) == sorted(map(str, resolve.spans(events, "key", ["v", "w"], "id").collect()))


def test_records_of_a_portal_grow_with_its_rows(spark):
    """A practice whose address changes with each row: keys and probes double with the rows, they don't quadruple."""
    found = []
    for n in (30, 60):
        rows = [row(i, provider_name=f"P{i}", source_url=f"https://portal.net/site{i % 2}.org", phone=str(i)) for i in range(n)]
        base, each, splits, hot = resolve._prepared(frame(spark, rows), "extracted_id", "created_at")
        keys, _ = resolve._lookup_spans(base.withColumn("provider_id", base["new_id"]))
        found.append(keys.count() + each.count())
    assert found[1] <= 2 * found[0] + 10


def test_only_wanted_tables_and_boards_without_a_record(spark):
    rows = [row(0, provider_name="Ann Lee", npi="111"), row(1, provider_name="Ann Lee", npi="111", source_type="licensing_board"), row(2, provider_name="Ann Lee", npi="111", source_type="licensing_board", license_state="NY", source_url="https://ny.gov/")]
    tables = resolve.resolve_rows(frame(spark, rows), wanted=("review_queue",))
    assert list(tables) == ["review_queue"]
    assert [(r.review_type, r.source_url) for r in tables["review_queue"].collect()] == [("unmatched_license", "https://ny.gov/")]


def test_pointers_are_followed_four_times_as_far_each_round(spark, monkeypatch):
    written, cut = [], resolve.cut
    monkeypatch.setattr(resolve, "cut", lambda df: written.append(1) or cut(df))
    ends = resolve._followed(spark.range(1, 201).selectExpr("id", "id - 1 AS at"))
    assert {(r.id, r.at) for r in ends.collect()} == {(i, 0) for i in range(1, 201)}
    assert len(written) <= 5  # nine by single doubling


def test_numbers_names_and_records_have_their_spans_in_one_pass(spark, monkeypatch):
    made, spans = [], resolve.spans
    rows = [dict.fromkeys(COLUMNS, "") | {"extracted_id": f"e{i}", "created_at": i, "provider_name": "Ann Lee", "state": "NJ", "license_state": "NJ", "npi": n, "source_url": "https://a.org"} for i, n in enumerate(("1", "", "2"))]
    df = spark.createDataFrame([tuple(r[c] for c in COLUMNS) + ([], []) for r in rows], SCHEMA)
    base, *_ = resolve._prepared(df, "extracted_id", "created_at")
    monkeypatch.setattr(resolve, "spans", lambda *a: made.append(1) or spans(*a))
    keys, records = resolve._lookup_spans(base.selectExpr("*", "'x' AS provider_id"))
    at = {p.id: p.pos for p in base.collect()}
    assert {(r.key.split("\x1f")[1], r.since, r.until, r.born) for r in keys.where("rank = 0").collect()} == {("1", at["e0"], at["e2"], at["e0"]), ("2", at["e2"], None, at["e0"])}
    assert records.count() == 1 and len(made) == 1
