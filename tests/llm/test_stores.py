import hashlib
import itertools
import json
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from evigrid.llm import _common, fixity, sharding


def rows_of(spark, n, start=0):
    return spark.range(start, start + n).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), F.col("id").cast("string")).alias("text"), F.lit(None).cast("string").alias("path"))


def test_append_compact_vacuum(spark, tmp_path):
    store = sharding.ShardStore(spark, f"file://{tmp_path}/s", target_bytes=1 << 20)
    for i in range(5):
        store.append(rows_of(spark, 40, 40 * i).coalesce(1), rows=10)
    assert store.versions() == [1, 2, 3, 4, 5] and len(store.shards()) == 20
    before = store.read().count()
    assert store.compact() == 1 and len(store.shards()) == 1
    assert store.read().count() == before == 200 and store.read(2).count() == 80
    assert store.vacuum() == 0 and store.versions() == [5, 6] and store.read(5).count() == 200
    assert store.vacuum(keep=1, grace=0) == 20 and store.versions() == [6]
    assert sorted(r.doc_id for r in store.read().collect()) == list(range(200))


def test_tiers_merge_like_sizes(spark, tmp_path):
    store = sharding.ShardStore(spark, f"file://{tmp_path}/s", target_bytes=64 << 20)
    store._jvm, store._fs = store._jvm, store._fs
    shards = [sharding.Shard(f"a{i}", 1000) for i in range(3)] + [sharding.Shard(f"b{i}", 5 << 20) for i in range(4)] + [sharding.Shard("c", 60 << 20)]
    store.shards = lambda version=None: shards
    assert {s.path for s in store.due()} == {"b0", "b1", "b2", "b3"}
    shards.append(sharding.Shard("a3", 900))
    assert {s.path for s in store.due()} == {"a0", "a1", "a2", "a3"}


def test_rival_commits_conflict(spark, tmp_path):
    store = sharding.ShardStore(spark, f"file://{tmp_path}/s")
    store.append(rows_of(spark, 5))
    schema = rows_of(spark, 1).schema.json()
    base = store.manifest()
    store.commit(base, schema, [])
    with pytest.raises(sharding.Conflict):
        store.commit(base, schema, [])
    assert store.read().count() == 5 and len([p for p in (tmp_path / "s/manifest").iterdir() if p.suffix == ".tmp"]) == 0
    json.loads((tmp_path / "s/manifest/v00000002.json").read_text())


def test_appends_go_after_rivals(spark, tmp_path, monkeypatch):
    store, rival = (sharding.ShardStore(spark, f"file://{tmp_path}/s") for _ in range(2))
    store.append(rows_of(spark, 5))
    write = store._write

    def late(df, rows=None):
        found = write(df, rows)
        rival.append(rows_of(spark, 7, 100))
        return found

    old, once = store.manifest(), []
    monkeypatch.setattr(store, "_write", late)
    monkeypatch.setattr(store, "manifest", lambda version=None: old if version is None and not once.append(1) and len(once) == 1 else sharding.ShardStore.manifest(store, version))
    assert store.append(rows_of(spark, 3, 50)) == 3
    assert rival.read().count() == 15


def test_parts_are_written_once(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sharding, "PART_SHARDS", 8)
    store = sharding.ShardStore(spark, f"file://{tmp_path}/s")
    store.append(rows_of(spark, 60).coalesce(1), rows=10)
    first = {p["name"] for p in store.manifest()["parts"]}
    store.append(rows_of(spark, 60, 60).coalesce(1), rows=10)
    assert first < {p["name"] for p in store.manifest()["parts"]} and len(store.shards()) == 12
    for i in range(5):
        store.append(rows_of(spark, 1, 200 + i).coalesce(1))
    assert len(store.manifest()["parts"]) <= 2 + store.fan_in and store.read().count() == 125
    store.compact()
    assert store.read().count() == 125 and len(store.shards()) == 1


def test_vacuum_takes_what_no_version_lists(spark, tmp_path):
    store = sharding.ShardStore(spark, f"file://{tmp_path}/s")
    store.append(rows_of(spark, 5).coalesce(1))
    store._write(rows_of(spark, 9).coalesce(1))  # a writer that failed before its commit
    assert store.vacuum() == 0 and store.vacuum(grace=0) == 1 and store.read().count() == 5


def test_compaction_keeps_all_rows(spark, tmp_path):
    rows = [(1, "a", 1), (1, "a", 1), (None, None, None), (2, "", 0), (3, "x" * 200_000, 5), (4, "é", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, bytes int").repartition(5)
    out = sharding.compacted(df, f"file://{tmp_path}/s", arrivals=1)
    assert sorted(map(str, out.collect())) == sorted(map(str, df.collect()))
    got = {r.doc_id: (r.n_bytes, r.text_sha256) for r in sharding.digests(out).collect()}
    assert got[4] == (2, hashlib.sha256("é".encode()).hexdigest()) and got[None] == (None, None) and got[2][0] == 0
    assert sharding.compacted(df.limit(0), f"file://{tmp_path}/e").count() == 0


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(i, f"https://e.org/{i}", f"<p>{i}</p>" * (i % 7), "ok") for i in range(2500)]
    rows += [(7, "https://e.org/7", "<p>again</p>", "ok"), (7, "https://e.org/7", "<p>again</p>", "ok"), (None, None, None, None), (9000, None, "x" * 100_000, "ok"), (-5, "u", "", "ok")]
    return spark.createDataFrame(rows, "page_id long, url string, html string, status string").repartition(6)


def plain_record(page_id, url, html):
    body = (html or "").encode()
    head = f"WARC/1.0\r\nWARC-Type: resource\r\nWARC-Date: {fixity.DATE}\r\nWARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>\r\nWARC-Target-URI: {url or ''}\r\n"
    return head.encode() + f"Content-Length: {len(body)}\r\n\r\n".encode() + body + b"\r\n\r\n"


@pytest.mark.parametrize("hot", [fixity.HOT_RECORDS, 3])
def test_offsets_are_those_of_the_file(pages, monkeypatch, hot):
    monkeypatch.setattr(fixity, "HOT_RECORDS", hot)
    by_file = {}
    for r in fixity.records(pages).collect():
        by_file.setdefault(r.file, []).append(r)
    for rows in by_file.values():
        rows.sort(key=lambda r: (r.page_id is not None, r.page_id or 0, r.leaf))
        assert [r.offset for r in rows] == list(itertools.accumulate((r.n * r.length for r in rows[:-1]), initial=0))
    body = plain_record(3, "https://e.org/3", "<p>3</p>" * 3)
    row = next(r for r in by_file[0] if r.page_id == 3)
    assert (row.length, row.leaf) == (len(body), hashlib.sha256(body).hexdigest())
    assert sum(r.n for rows in by_file.values() for r in rows) == pages.count()


def test_audit_finds_exactly_the_damage(spark, pages):
    good = fixity.records(pages)
    assert fixity.audit(good, fixity.records(pages)).count() == 0
    found = fixity.audited(pages, fixity.damaged(pages)).collect()
    ids = [r.page_id for r in pages.collect() if r.page_id is not None]
    corrupt = sorted(r.page_id for r in pages.collect() if r.page_id is not None and r.page_id % 97 == 0 and r.html)
    by_status = {s: sorted(r.page_id for r in found if r.status == s) for s in ("corrupt", "missing", "extra")}
    assert by_status["corrupt"] == corrupt
    assert by_status["missing"] == sorted(i for i in ids if i % 89 == 0 and i % 97 != 0)
    assert by_status["extra"] == sorted(i for i in ids if i % 83 == 0)
    assert len(found) == pages.count() + len(by_status["extra"])


def plain_audit(a, b):
    """Per id and address: equal records cancel out, the rest is paired in order of hash."""
    out = Counter()
    groups = [{}, {}]
    for side, rows in zip(groups, (a, b), strict=True):
        for page_id, url, html in rows:
            side.setdefault((page_id, url or ""), Counter())[hashlib.sha256(plain_record(page_id, url, html)).hexdigest()] += 1
    for key in groups[0].keys() | groups[1].keys():
        ours, theirs = groups[0].get(key, Counter()), groups[1].get(key, Counter())
        left, right = sorted((ours - theirs).elements()), sorted((theirs - ours).elements())
        both = min(len(left), len(right))
        out.update((*key, leaf, "corrupt" if i < both else "missing") for i, leaf in enumerate(left))
        out.update((*key, leaf, "extra") for leaf in right[both:])
    return out


@pytest.mark.parametrize("hot", [fixity.HOT_RECORDS, 5])
def test_audit_equals_plain_comparison(spark, monkeypatch, hot):
    monkeypatch.setattr(fixity, "HOT_RECORDS", hot)
    monkeypatch.setattr(_common, "COPIES", 2)
    rng = random.Random(4)
    a = [(rng.choice([None, *range(200), 5, 5, 5]), rng.choice(["u", "v", None, ""]), rng.choice(["", "x", "y", None, "z" * 50])) for _ in range(600)]
    b = [r for r in a if rng.random() > 0.03]
    b = [(i, u, "w" + (h or "") if rng.random() < 0.05 else h) for i, u, h in b] + [(rng.randrange(220), "u", "new") for _ in range(9)]
    rng.shuffle(b)
    schema = "page_id long, url string, html string"
    got = Counter()
    for r in fixity.audited(*(spark.createDataFrame(x, schema) for x in (a, b))).collect():
        got[(r.page_id, r.url, r.record_sha256, r.status)] += 1
    want = plain_audit(a, b)
    assert {k: v for k, v in got.items() if k[3] != "ok"} == dict(want)
    assert sum(v for k, v in got.items() if k[3] != "extra") == len(a)


def test_one_missing_record_is_one_finding(spark, pages):
    base = pages.where("page_id between 0 and 199 and page_id <> 7")
    got = fixity.audited(base, base.where("page_id <> 50")).where("status <> 'ok'").collect()
    assert [(r.page_id, r.status) for r in got] == [(50, "missing")]
    got = fixity.audited(base.where("page_id <> 50"), base).where("status <> 'ok'").collect()
    assert [(r.page_id, r.status) for r in got] == [(50, "extra")]
    assert fixity.audited(base.limit(0), base.limit(0)).count() == 0
    loose = spark.createDataFrame([(None, f"u{i}", f"t{i}") for i in range(200)], "page_id long, url string, html string")
    changed = loose.withColumn("html", F.when(F.col("url") == "u9", "other").otherwise(F.col("html")))
    assert [(r.url, r.status) for r in fixity.audited(loose, changed).where("status <> 'ok'").collect()] == [("u9", "corrupt")]


def test_root_is_that_of_hand_made_tree(spark, pages):
    recs = fixity.records(pages.where("page_id between 0 and 39 and page_id <> 7"))
    rows = sorted(recs.collect(), key=lambda r: r.page_id)
    digest = lambda lines: hashlib.sha256("|".join(lines).encode()).hexdigest()
    parts = [[r for r in rows if r.page_id // 32 == i] for i in (0, 1)]
    ranges = [digest(f"{r.page_id}:{r.offset - part[0].offset}:{r.n}:{r.leaf}" for r in part) for part in parts]
    sizes = [sum(r.n * r.length for r in part) for part in parts]
    node = digest(f"{i:>20}/:{s}:{h}" for i, s, h in zip((0, 1), sizes, ranges, strict=True))
    for _ in range(3):
        node = digest([f"0:{sum(sizes)}:{node}"])
    assert fixity.tree(recs)["root"].first().hash == node


def test_narrower_and_wider_arrivals_keep_all_columns(spark, tmp_path):
    store = sharding.ShardStore(spark, f"file://{tmp_path}/wide")
    store.append(spark.createDataFrame([(1, "a", 1.5)], "doc_id long, text string, extra double"))
    store.append(spark.createDataFrame([(2, "b")], "doc_id long, text string"))
    store.append(spark.createDataFrame([(3, "new", "c")], "doc_id long, more string, text string"))
    want = [(1, "a", 1.5, None), (2, "b", None, None), (3, "c", None, "new")]
    assert sorted(tuple(r) for r in store.read().collect()) == want and store.read().columns == ["doc_id", "text", "extra", "more"]
    for clash in ("doc_id string, text string", "doc_id long, Text string"):
        with pytest.raises(ValueError):
            store.append(spark.createDataFrame([], clash))
    assert len(store.versions()) == 3
    while store.compact_once():
        pass
    assert sorted(tuple(r) for r in store.read().collect()) == want
