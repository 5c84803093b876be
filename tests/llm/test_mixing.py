import random

import pytest
from pyspark.sql import functions as F

from evigrid.llm import _common, mixing


def brute_targets(sizes):
    """Share by weight, cap, reshare the excess until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(order)}
    capped = {}
    while True:
        left = sum(sizes.values()) - sum(capped.values())
        free = [s for s in order if s not in capped]
        share = {s: left * weight[s] / sum(weight[f] for f in free) for s in free}
        over = [s for s in free if share[s] > 3 * sizes[s]]
        if not over:
            return capped | share
        capped |= {s: 3.0 * sizes[s] for s in over}


def test_targets():
    rng = random.Random(1)
    for _ in range(300):
        sizes = {rng.choice([None, "a", "B", "é", "z", "10", "2"]): rng.choice([0, 1, 50, rng.randint(0, 10**6)]) for _ in range(6)}
        want = brute_targets(sizes)
        assert mixing.targets(sizes) == pytest.approx(want)


def test_plan_takes_each_block_once_a_pass_and_meets_targets():
    rng = random.Random(3)
    for _ in range(200):
        sizes = {f"s{i}": rng.choice([0, 1, 5, rng.randint(1, 5000)]) for i in range(rng.randint(1, 7))}
        block = rng.choice([1, 7, 64])
        ranges, facts = mixing.plan(sizes, block)
        assert ranges.equals(mixing.plan(sizes, block)[0])
        names, got, seen = list(facts["targets"]), {}, set()
        for x in ranges.to_dict("records"):
            for k in range(x["first"], x["last"] + 1):
                at = (k * x["step"] + x["shift"]) % x["n"]
                size = sizes[names[x["s"]]]
                length = min(block, size - at * block)
                taken = length if k != x["short_slot"] else x["short_words"]
                assert 0 < taken <= length and (x["s"], x["turn"], at) not in seen
                seen.add((x["s"], x["turn"], at))
                got[names[x["s"]]] = got.get(names[x["s"]], 0) + taken
        assert got == {n: round(t) for n, t in facts["targets"].items() if round(t)}


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(7)
    rows = [(i, " ".join(f"d{i}w{j}" for j in range(rng.choice([0, 1, 30, 400]))), rng.choice([None, "a", "a", "a", "b", "c", ""]), 1, "x") for i in range(120)]
    rows += [(3, "same row", "a", 1, "x")] * 3 + [(None, "no id", "b", 1, None), (200, None, "c", 0, "x"), (201, "long " * 20_000, "a", 0, "y"), (202, "\x0b nbsp\xa0kept \x1c", None, 0, "x")]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars int, taken string").repartition(6)


def test_mix(spark, docs):
    got = mixing.mix(docs, block=32).collect()
    assert len(got) == docs.count()
    per: dict = {}
    for r in got:
        parts = sum(p["to"] - p["from"] for p in r.parts)
        assert r.taken == r.full_takes * r["size"] + parts <= 3 * r["size"]
        per.setdefault(r.source, []).append(r)
    sizes = {s: sum(r["size"] for r in rows) for s, rows in per.items()}
    assert {s: rows[0].target for s, rows in per.items()} == pytest.approx(brute_targets(sizes))
    assert all(sum(r.taken for r in rows) == round(rows[0].target) for rows in per.values())
    assert all(r.source_size == sizes[r.source] for r in got)
    again = mixing.mix(docs.repartition(2), block=32).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))


def test_mixed_documents_hold_what_was_taken(docs):
    out = mixing.mixed_documents(docs, block=32)
    assert out.columns == docs.columns
    want = {(r.doc_id, r.source): 0 for r in docs.collect()}
    for r in mixing.mix(docs, block=32).collect():
        want[r.doc_id, r.source] += r.taken
    got = {(r.doc_id, r.source): r.n for r in out.groupBy("doc_id", "source").agg(F.sum(mixing.words(F.col("text"))).alias("n")).collect()}
    assert got == {k: v for k, v in want.items() if v}


def test_taken_equals_plain_walk_over_the_plan(docs):
    """Each document's words by laying sources out in the operator's order and walking the plan slot by slot."""
    block = 32
    rows = mixing.mix(docs, block).collect()
    sizes: dict = {}
    for r in rows:
        sizes[r.source] = sizes.get(r.source, 0) + r["size"]
    ranges, facts = mixing.plan(sizes, block)
    names = list(facts["targets"])
    placed, *_ = mixing._laid(docs, block, mixing.WEIGHTS, mixing.REPEATS)
    lines = {s: [] for s in range(len(names))}
    for r in sorted(placed.collect(), key=lambda r: (r.s, r.offset, r["size"])):
        assert r["size"] == 0 or r.offset == len(lines[r.s])
        lines[r.s] += [(r.doc_id, r.text_hash, r.i)] * r["size"]
    want: dict = {}
    for x in ranges.to_dict("records"):
        for k in range(x["first"], x["last"] + 1):
            at = (k * x["step"] + x["shift"]) % x["n"]
            words = lines[x["s"]][at * block : (at + 1) * block]
            for w in words if k != x["short_slot"] else words[: x["short_words"]]:
                want[x["s"], *w] = want.get((x["s"], *w), 0) + 1
    place = {name: s for s, name in enumerate(names)}
    assert {(place[r.source], r.doc_id, r.text_hash, r.i): r.taken for r in rows if r.taken} == want


def test_packed_blocks_hold_the_words_taken(docs):
    block = 32
    out = mixing.packed(docs, block).collect()
    assert len({(r.source, r.turn, r.slot) for r in out}) == len(out) and all(r.n_words == len(r.text.split(" ")) <= block for r in out)
    sizes, want = {}, {}
    for r in mixing.mix(docs, block).collect():
        sizes[r.source] = sizes.get(r.source, 0) + r["size"]
        want[r.source] = want.get(r.source, 0) + r.taken
    got: dict = {}
    for r in out:
        got[r.source] = got.get(r.source, 0) + r.n_words
    assert got == {s: n for s, n in want.items() if n}
    drawn = mixing.plan(sizes, block)[1]
    assert {r.shard for r in out} == set(range(drawn["shards"]))
    known = {w for r in docs.collect() for w in (r.text or "").replace("\x0b", " ").split(" ")}
    assert {w for r in out for w in r.text.split(" ")} <= known


def test_equal_rows_of_a_hot_group(spark, monkeypatch):
    monkeypatch.setattr(_common, "COPIES", 7)
    rows = [(1, "one two three", "a", i % 2, "x") for i in range(40)] + [(i, "four five six seven", "b", 0, "y") for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars int, taken string")
    first, again = (sorted(map(str, mixing.mixed_documents(d, block=5).collect())) for d in (df, df.repartition(3)))
    assert first == again and len(mixing.mix(df, block=5).collect()) == 70


def test_empty_and_wordless(docs):
    assert mixing.mix(docs.limit(0)).count() == 0
    assert mixing.mixed_documents(docs.limit(0)).count() == 0 and mixing.packed(docs.limit(0)).count() == 0
    assert {r.taken for r in mixing.mix(docs.withColumn("text", F.lit(None).cast("string"))).collect()} == {0}


def test_another_draw_moves_blocks_to_other_shards_and_takes_the_same(spark):
    docs = spark.range(1200).selectExpr("id AS doc_id", "concat('s', id % 3) AS source", "repeat(concat('w', id, ' '), 40 + CAST(id % 50 AS INT)) AS text")
    a, b = ({r.doc_id: r for r in mixing.mix(docs, 8, seed=seed).collect()} for seed in (1, 2))
    assert {i: r.taken for i, r in a.items()} == {i: r.taken for i, r in b.items()}
    assert sum((a[i].first_shard, a[i].last_shard) != (b[i].first_shard, b[i].last_shard) for i in a) > 50
    assert all(r.first_shard is not None and 0 <= r.first_shard <= r.last_shard for r in a.values() if r.taken)
    assert len({r.first_shard for r in a.values()}) > 5
