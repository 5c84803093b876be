import pytest
from pyspark.sql import functions as F

from evigrid.functions import signals, text


def values(spark, rows, schema, *columns):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*columns).collect()]


def test_normalisation_and_keys(spark):
    got = values(spark, [("  a \n b\t",), (None,), ("",)], "x string", text.normalize_text(F.col("x")), text.make_pk("p", F.col("x"), F.lit("Z")))
    assert [g[0] for g in got] == ["a b", "", ""]
    assert got[1][1] == got[2][1] and got[0][1].startswith("p_") and len(got[0][1]) == 18


@pytest.mark.parametrize(
    ("raw", "want"),
    [
        ("HTTPS://www.Ex.org/A/?b=2&a=1&c=#x", "https://ex.org/A?a=1&b=2"), ("ex.org", "https://ex.org/"), ("http://ex.org:80/a/", "http://ex.org:80/a"),
        ("https://ex.org/?q=", "https://ex.org/"),
    ],
)
def test_normalize_url(spark, raw, want):
    assert values(spark, [(raw,)], "x string", text.normalize_url(F.col("x"))) == [(want,)]


def test_domain_keeps_port(spark):
    rows = [("WWW.Ex.org:8080/a",), ("https://u@ex.org/",), (None,)]
    assert values(spark, rows, "x string", text.normalize_domain(F.col("x"))) == [("ex.org:8080",), ("u@ex.org",), ("",)]


def test_html(spark):
    page = '<html><title> A  <b>b</b></title><script>var x=1;</script><p>t</p><a href="/x#y">1</a><a href="/x">2</a><a href="https://e.org/intake">3</a></html>'
    got = values(spark, [(page,)], "x string", text.extract_title(F.col("x")), text.extract_links(F.col("x")), text.first_link_with(text.extract_links(F.col("x"))), text.strip_html(F.col("x"), True))
    assert got == [("A b", ["/x", "https://e.org/intake"], "https://e.org/intake", "A b t 1 2 3")]


def test_links_resolve(spark):
    base = "https://ex.org/a/b"
    rows = [("/c",), ("d?x=1",), ("//o.org/e",), ("https://p.org/f/",)]
    got = values(spark, rows, "x string", text.resolve_link(F.lit(base), F.col("x")))
    assert [g[0] for g in got] == ["https://ex.org/c", "https://ex.org/a/d?x=1", "https://o.org/e", "https://p.org/f"]


def test_snippet_and_contacts(spark):
    t = "x" * 60 + " call (201) 555-0100 now " + "y" * 60
    got = values(spark, [(t,), (None,), ("none",)], "x string", text.snippet(F.col("x"), text.PHONE), text.first_phone(F.col("x")))
    assert got[0][1] == "(201) 555-0100" and got[0][0].startswith("x" * 34) and len(got[0][0]) <= 180
    assert got[1] == ("", "") and got[2] == ("", "")
    rows = [("2015550100",), ("1-201-555-0100",), ("55",)]
    assert [g[0] for g in values(spark, rows, "x string", text.format_phone(F.col("x")))] == ["(201) 555-0100", "+1 (201) 555-0100", "55"]


def test_status_cascades(spark):
    rows = [(0, ""), (204, ""), (429, ""), (302, ""), (500, ""), (404, "DNS error: x"), (600, ""), (None, "connection reset")]
    got = values(spark, rows, "s int, e string", signals.status_class(F.col("s")), signals.failure_kind(F.col("s"), F.col("e")))
    assert [g[0] for g in got] == ["network_error", "success", "throttle", "redirect", "server_error", "client_error", "unknown_error", "network_error"]
    assert [g[1] for g in got] == ["error", "error", "blocked", "error", "error", "dns", "error", "connect"]


def test_block_reason_looks_at_visible_text(spark):
    rows = [(200, "<script>captcha</script><p>fine</p>"), (200, "<p>Please Verify you are HUMAN</p>"), (403, ""), (200, None)]
    assert [g[0] for g in values(spark, rows, "s int, c string", signals.block_reason(F.col("s"), F.col("c")))] == ["", "marker:verify you are human", "status:403", ""]


def test_credentials_keep_their_order(spark):
    rows = [("PA", ""), ("", "physician_assistant"), ("PsyD", ""), ("LCSW", ""), ("", "advanced_practice_nurse"), ("NP", "")]
    got = [g[0] for g in values(spark, rows, "c string, l string", signals.credential_class(F.col("c"), F.col("l")))]
    assert got == ["PA", "MD/DO", "PsyD/PhD", "LCSW", "", "APN/NP"]


def test_person_names(spark):
    rows = [("Jane Q. Doe",), ("and Jane Doe",), ("Jane",), ("Jane Doe 2",), ("Sleep Testing",), ("jane doe",), (None,), ("Ann O'Hara-Lee",)]
    assert [g[0] for g in values(spark, rows, "x string", signals.person_name(F.col("x")))] == [True, False, False, False, False, False, False, True]


def test_diagnosis_and_ages(spark):
    rows = [("Autism diagnostic evaluations for children",), ("We know autism",), ("adults",), ("",)]
    got = values(spark, rows, "x string", signals.diagnosis(F.col("x"), signals.CONDITIONS["diagnoses_asd"]), signals.age_groups(F.col("x")))
    assert got == [("yes", ["child", "adolescent"]), ("unclear", ["unknown"]), ("unclear", ["adult"]), ("unclear", ["unknown"])]


def test_domains_and_links_look_at_their_text_once(spark):
    from evigrid.functions.text import normalize_domain, resolve_link

    cases = {
        "HTTPS://www.A.org:80/x": "a.org:80", "www.b.org/p": "b.org", "a/b://c": "", "1x://c": "", "": "", None: "", "//d.org": "", "mailto:x@y": "mailto:x@y", "http://www.": "", "x y?://": "",
    }
    rows = spark.createDataFrame([(k, v) for k, v in cases.items()], "u string, want string")
    assert {r.u: r.got for r in rows.select("u", normalize_domain(F.col("u")).alias("got")).collect()} == cases
    plan = lambda made: spark.range(1).select(F.lit("a").alias("u"), F.lit("b").alias("l")).select(made.alias("x"))._jdf.queryExecution().analyzed().toString()
    assert plan(normalize_domain(F.col("u"))).count("coalesce(u") == 1
    assert plan(resolve_link(F.col("u"), F.col("l"))).count("regexp_extract(") < 20
