"""Stored tables: upserts rewrite their buckets only, versions stay, no writer loses rows."""

import random
import threading

import pytest
from pyspark.sql import functions as F

from evigrid.operators import merge
from evigrid.plans import stages
from evigrid.sources.store import KeyedTable

from test_ordered_lookup import frame, history

SCHEMA = "id long, v string, at long"


def rows(spark, *values):
    return spark.createDataFrame(list(values), SCHEMA)


def test_upserts_rewrite_only_their_buckets(spark, tmp_path):
    table = KeyedTable(spark, f"file://{tmp_path}/t", ["id"], 16)
    table.upsert(rows(spark, *((i, "old", 0) for i in range(200))))
    first = table.manifest()
    done = table.upsert(rows(spark, (5, "new", 1), (5, "newer", 2), (1000, "added", 1)), F.col("at"))
    assert done["version"] == 2 and 1 <= len(done["rewritten"]) <= 2
    second = table.manifest()
    assert {int(b) for b in second["folders"] if second["folders"][b] != first["folders"].get(b)} == set(done["rewritten"])
    got = {r.id: r.v for r in table.read().collect()}
    assert got == {i: "old" for i in range(200)} | {5: "newer", 1000: "added"}
    assert {r.v for r in table.read(1).collect()} == {"old"} and table.read(1).count() == 200
    assert table.upsert(rows(spark).limit(0)) == {"version": 2, "rewritten": []}


def test_random_upserts_equal_a_dictionary(spark, tmp_path):
    rng, want = random.Random(3), {}
    table = KeyedTable(spark, f"file://{tmp_path}/t", ["id"], 8)
    for turn in range(4):
        batch = [(rng.randrange(60), f"{turn}-{n}", n) for n in range(40)]
        table.upsert(rows(spark, *batch), F.col("at"))
        want |= {i: v for i, v, _ in sorted(batch, key=lambda r: r[2])}
    assert {r.id: r.v for r in table.read().collect()} == want


def test_known_values_are_kept_by_a_fold(spark, tmp_path):
    table = KeyedTable(spark, f"file://{tmp_path}/t", ["id"], 4)
    fold = lambda both: merge.fold_upserts(both, ["id"], F.struct("_new", "at"), {"v": ("", "unknown"), "at": ()})
    table.upsert(rows(spark, (1, "x", 0), (2, "", 0)), fold=fold)
    table.upsert(rows(spark, (1, "unknown", 1), (2, "y", 1)), fold=fold)
    assert sorted(tuple(r) for r in table.read().collect()) == [(1, "x", 1), (2, "y", 1)]


def test_other_columns_are_refused(spark, tmp_path):
    table = KeyedTable(spark, f"file://{tmp_path}/t", ["id"])
    table.upsert(rows(spark, (1, "x", 0)))
    for bad in ("id long, v string", "id long, v string, at int", "id long, v string, at long, w string"):
        with pytest.raises(Exception):
            table.upsert(spark.createDataFrame([], bad).union(spark.createDataFrame([tuple([1, "x", 2, "w"][: bad.count(",") + 1])], bad)))
    with pytest.raises(ValueError):
        table.upsert(spark.createDataFrame([("x",)], "v string"))
    assert table.versions() == [1]


def test_of_two_writers_at_once_none_is_lost(spark, tmp_path):
    table = KeyedTable(spark, f"file://{tmp_path}/t", ["id"], 2)
    table.upsert(rows(spark, (0, "x", 0)))
    writers = [threading.Thread(target=lambda n=n: KeyedTable(spark, f"file://{tmp_path}/t", ["id"], 2).upsert(rows(spark, *((i, f"w{n}", n) for i in range(n * 100, n * 100 + 20))))) for n in (1, 2, 3)]
    for w in writers:
        w.start()
    for w in writers:
        w.join()
    assert table.read().count() == 61 and table.versions() == [1, 2, 3, 4]


def test_two_runs_give_the_tables_of_one(spark, tmp_path):
    rng = random.Random(12)
    all_rows = [r for n in range(20) for r in history(rng, n, 6)]
    all_rows = [dict(r, extracted_id=f"e{i:04d}", created_at=i) for i, r in enumerate(all_rows)]
    table = KeyedTable(spark, f"file://{tmp_path}/extracted", ["extracted_id"], 8)
    for part in (all_rows[::2], all_rows[1::2]):
        table.upsert(frame(spark, part), F.col("created_at"))
    twice, once = stages.resolve_records(table.read()), stages.resolve_records(frame(spark, all_rows))
    for name in ("providers", "provider_practice_records"):
        assert sorted(map(str, twice[name].collect())) == sorted(map(str, once[name].collect()))
