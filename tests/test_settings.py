import json

from pyspark.sql import functions as F

from evigrid.functions import signals
from evigrid.operators import frontier
from evigrid.plans import settings
from evigrid.sources import seeds


def test_load(tmp_path):
    path = tmp_path / "c.json"
    path.write_text(json.dumps({"max_depth": 4, "denylist": [".A.org"], "research_enabled": "off", "max_total_pages": ""}))
    got = settings.load(str(path), {"EVIGRID_MAX_DEPTH": "1", "EVIGRID_ALLOWED_SCHEMES": "https, ftp"})
    assert (got.max_depth, got.research_enabled, got.max_total_pages, got.allowed_schemes) == (1, False, None, ["https", "ftp"])
    assert got.denied_domains("b.org, .a.org") == ["a.org", "b.org"]
    assert settings.load(None, {}) == settings.Settings()


def test_budgets():
    s = settings.Settings(max_pages_per_domain=0, max_depth=20)
    assert settings.page_budget(s) == 30 and settings.page_budget(s, 3, 9) == 3 and settings.page_budget(s, None, 9) == 9
    assert settings.total_budget(s, 12) == 12 and settings.total_budget(s, 12, 40) == 12 and settings.total_budget(s, 12, 5) == 5
    assert settings.depth(s) == 10 and settings.depth(s, 0) == 0 and settings.depth(s, None, 1) == 1
    assert "/license-lookup" not in settings.research_paths(s, "practice_site", False, False)
    assert "/license-lookup" in settings.research_paths(s, "licensing_board", True, False)
    assert settings.research_paths(s, "practice_site", True, False) == [] == settings.research_paths(s, "insurer_directory", False, True)


def test_statuses(spark):
    rows = [("Status code: 429 x", "status:503", "a"), ("x", "marker:captcha", "7"), (None, "", None)]
    df = spark.createDataFrame(rows, "e string, b string, v string")
    got = df.select(signals.status_in_error(F.col("e")), signals.status_of_block(F.col("b")), signals.first_positive(F.col("v"), F.lit("0"), F.lit("3"))).collect()
    assert [tuple(r) for r in got] == [(429, 503, 3), (0, 403, 7), (0, 0, 3)]
    rows = [(True, False, False, 1, 1), (False, True, False, 0, 0), (False, False, True, 0, 0), (False, False, True, 2, 3), (False, False, False, 2, 3), (False, False, False, 0, 3), (False, False, False, 0, 0)]
    df = spark.createDataFrame(rows, "q boolean, f boolean, s boolean, n int, m int")
    got = [r[0] for r in df.select(signals.seed_status(*(F.col(c) for c in df.columns))).collect()]
    assert got == ["quarantined", "failed", "stopped", "partial", "completed", "partial", "empty"]
    assert spark.range(1).select(signals.is_html(F.lit("Text/HTML; x")), signals.is_html(F.lit(None).cast("string"))).first() == (True, False)


def test_detail_pages_and_metros(spark):
    rows = [("https://e.org/a/dr-ann-b-lee", "practice_site"), ("https://e.org/staff", "practice_site"), ("https://e.org/a/index.html", "practice_site"), ("https://e.org/a/b/page", "state_registry"), ("https://e.org/a/b", "licensing_board")]
    df = spark.createDataFrame(rows, "u string, t string")
    assert [r[0] for r in df.select(frontier.detail_page(F.col("u"), F.col("t"))).collect()] == [True, False, False, True, False]
    cities = spark.createDataFrame([(" Union ",), (None,)], "city string")
    assert [r.metro for r in seeds.with_metro(cities, {"union": "North"}, default="?").collect()] == ["North", "?"]
