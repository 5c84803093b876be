"""Entities, blanks and snippets against the language's own functions."""

import html
import random
import re
from html.entities import html5

from pyspark.sql import functions as F

from evigrid.functions import signals, text


def column(spark, values, f):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r.o for r in rows.select("i", f(F.col("v")).alias("o")).orderBy("i").collect()]


def test_every_entity_is_unescaped_as_by_the_library(spark):
    values = [f"x&{n}y" for n in html5] + [f"&{n.rstrip(';')}" for n in html5] + [f"&{n[:-1]}z;" for n in html5]
    values += [f"&#{n}{end}" for n in (*range(0, 300), 0xD7FF, 0xD800, 0xDFFF, 0xFDD0, 0xFFFE, 0xFFFF, 0x1F600, 0x1FFFE, 0x10FFFF, 0x110000, 10**30, 10**60) for end in ("", ";", "a")]
    values += [f"&#{x}{n:x};" for n in (0, 0x41, 0x80, 0x9F, 0xA0, 0x1F600, 0x110000, 10**20, 16**40) for x in "xX"]
    values += ["", "&", "&&amp;amp;", "&#;", "&#x;", "&amp", "a & b", "&notit;", "&nosuchname;", "&" + "a" * 40, "no entity", "&lt;&gt;&lt", "\n&amp;\n&copy"]
    rng = random.Random(5)
    values += ["".join(rng.choice(("&", "amp", "lt", ";", "#", "x", "6", "5", "not", "in", " ", "é")) for _ in range(rng.randint(1, 12))) for _ in range(2000)]
    got = column(spark, values, text.unescape)
    assert [(v, g) for v, g in zip(values, got, strict=True) if g != html.unescape(v)] == []
    assert column(spark, [None], text.unescape) == [None]


def test_blanks_of_all_kinds_collapse(spark):
    blanks = [chr(c) for c in range(0x3001) if chr(c).isspace()]
    values = [f"{b}a{b}{b}b{b}" for b in blanks] + ["a​b", "a᠎b", "", "  "]
    assert column(spark, values, text.normalize_text) == [" ".join(v.split()) for v in values]


def test_snippets_are_about_the_match(spark):
    pattern = r"(?i)\b(insurance)\b"
    rng = random.Random(2)
    values = ["reinsurance is no " + "x" * 100 + " but Insurance is taken", "none", "", "insurance", " \n insurance \n "]
    values += [" ".join(rng.choice(("reinsurance", "insurance", "insurances", "a\nb", " ", "word")) for _ in range(60)) for _ in range(300)]

    def plain(v):
        m = re.search(pattern, v)
        return v[max(m.start() - 40, 0) : m.end() + 40].strip().replace("\n", " ")[:180] if m else ""

    assert column(spark, values, lambda c: text.snippet(c, pattern)) == [plain(v) for v in values]


def test_block_markers_behind_entities(spark):
    pages = ["<p>Access&nbsp;denied</p>", "Access denied", "<p>Acc&#101;ss <b>denied</b></p>", "<p>fine</p>", None, "<script>access denied</script>", "a < b access denied"]
    got = column(spark, pages, lambda c: signals.block_reason(F.lit(200), c, ("access denied",)))
    assert got == ["marker:access denied"] * 3 + ["", "", "", "marker:access denied"]


def test_the_text_of_a_page_is_computed_once(spark):
    rows = spark.createDataFrame([("<p>x</p>", 200)], "html string, status int").select(signals.block_reason(F.col("status"), F.col("html"), ("a", "b", "c")))
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("<!--") <= 2
