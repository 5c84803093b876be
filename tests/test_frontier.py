"""The frontier against a plain breadth-first search."""

import random

from pyspark.sql import functions as F

from evigrid.operators import frontier, score

SITE = "https://e.org"


def page(spark, pages):
    return spark.createDataFrame([(f"{SITE}{u}", "".join(f"<a href='{x}'>x</a>" for x in links)) for u, links in pages.items()], "url string, html string")


def test_seen_links_use_up_no_limit(spark):
    pages = page(spark, {"/": ["/team", "/staff", "/x"]}).withColumns({"seed": F.lit(SITE), "source_type": F.lit("practice_site"), "depth": F.lit(0)})
    seen = spark.createDataFrame([(f"{SITE}/team",), (f"{SITE}/staff",)], "url string")
    assert [(r.url, r["rank"]) for r in frontier.expanded(pages, seen, 2, 2).collect()] == [(f"{SITE}/x", 1)]


def test_links_of_equal_score_go_by_length_and_letters_as_written(spark):
    pages = page(spark, {"/": ["/zz", "https://e.org/b", "/aaa", "b"]}).withColumns({"seed": F.lit(SITE), "source_type": F.lit("practice_site"), "depth": F.lit(0)})
    got = frontier.expanded(pages, spark.createDataFrame([], "url string"), 1, 9).orderBy("rank").collect()
    assert [r.url for r in got] == [f"{SITE}/b", f"{SITE}/zz", f"{SITE}/aaa"]


def test_levels_equal_a_breadth_first_search(spark):
    rng = random.Random(7)
    links = {f"/n{i}": [f"/n{rng.randrange(60)}" for _ in range(rng.randrange(3))] for i in range(50)}
    starts = spark.createDataFrame([(f"{SITE}/n0", SITE, "practice_site"), (f"{SITE}/n1", SITE, "practice_site")], "url string, seed string, source_type string")
    for most in (0, 1, 3, 8):
        want, level = {"/n0": 0, "/n1": 0}, ["/n0", "/n1"]
        for depth in range(1, most + 1):
            level = sorted({x for u in level for x in links.get(u, []) if x not in want})
            want |= dict.fromkeys(level, depth)
        got = {r.url.removeprefix(SITE): r.depth for r in frontier.crawled(page(spark, links), starts, most, 10).collect()}
        assert got == want
    few = frontier.crawled(page(spark, links), starts, 8, 10, per_seed=5)
    assert few.count() == 5


def test_records_without_a_provider_stay_where_asked(spark):
    one = lambda schema, *values: spark.createDataFrame([values], schema)
    tables = {
        "provider_practice_records": one("record_id string, provider_id string, practice_id string, location_id string", "r", "p", "q", "l"), "providers": one("provider_id string, provider_name string, credentials string", "x", "", ""),
        "practices": one("practice_id string, website string, intake_url string, phone string", "q", "w", "", "1"), "practice_locations": one("location_id string, city string, state string, metro string, phone string", "l", "", "", "", None),
    }
    assert score.score_base(tables).count() == 0
    assert [(r.record_id, r.provider_name, r.phone) for r in score.score_base(tables, "left").collect()] == [("r", None, "1")]
