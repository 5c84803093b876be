"""Registered queries over the driver's tables, each with the SQL that gives the same rows.

The tables stand in for the engine's own: pages for landed pages, documents for sources, events for
fetches, orders and customers for records and accounts, labels for evidence.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import signals, text
from ..operators import dossier, export, frontier, merge, resolve, review, score
from ..operators.graph import shared_folder
from ..streaming import domains

from . import query

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def registered(sql: str | None = None):
    """Register a function of (spark, sf_dir) under its own name, with its SQL if there is one."""
    def keep(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return keep


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


c = F.col

# Pieces of SQL that several queries share.
_SP = r"[ \t\n\x0B\f\r]+"
_NORM = f"trim(regexp_replace(coalesce({{}}, ''), '{_SP}', ' ', 'g'))"


def _norm(x: str) -> str:
    return _NORM.format(x)


def _strip(x: str) -> str:
    return _norm(f"regexp_replace(coalesce({x}, ''), '<[^>]+>', ' ', 'g')")


# ---------------------------------------------------------------- text, URLs and keys


#: Blanks of other kinds that a third of the texts get, as chr() numbers; SQL turns each into a plain blank.
_BLANKS = (160, 8195, 12288, 133, 28, 8232)


@registered(f"""
WITH t AS (SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN replace(replace(text, 'e ', 'e' || chr(160) || chr(8195)), 'n ', chr(12288) || 'n' || chr(133) || chr(28) || chr(8232)) ELSE text END AS text FROM documents),
n AS (SELECT doc_id, trim(regexp_replace(translate(coalesce(text, ''), {' || '.join(f'chr({b})' for b in (*_BLANKS, 9, 10, 11, 12, 13))}, '{' ' * 11}'), ' +', ' ', 'g')) AS n FROM t)
SELECT doc_id, sha256(n) AS norm_hash, CAST(length(n) AS BIGINT) AS norm_length FROM n""")
def normalize_text(spark, sf_dir):
    nbsp, em, wide, nel, fs, line = (F.lit(chr(b)) for b in _BLANKS)
    other = F.replace(F.replace(c("text"), F.lit("e "), F.concat(F.lit("e"), nbsp, em)), F.lit("n "), F.concat(wide, F.lit("n"), nel, fs, line))
    n = text.normalize_text(F.when(c("doc_id") % 3 == 0, other).otherwise(c("text")))
    return read(spark, sf_dir, "documents").select("doc_id", F.sha2(n, 256).alias("norm_hash"), F.length(n).cast("long").alias("norm_length"))


@registered(f"SELECT page_id, {_strip('html')} AS visible FROM pages")
def strip_html(spark, sf_dir):
    return read(spark, sf_dir, "pages").select("page_id", text.strip_html(c("html")).alias("visible"))


_TITLE = _strip("regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)")
_H1 = _strip("regexp_extract(html, '(?is)<h1[^>]*>(.*?)</h1>', 1)")


@registered(f"SELECT page_id, coalesce(nullif({_TITLE}, ''), {_H1}) AS title FROM pages")
def extract_title(spark, sf_dir):
    return read(spark, sf_dir, "pages").select("page_id", text.extract_title(c("html")).alias("title"))


_HREF = """(?i)href=["'']([^"''#]+)"""
_LINKS = f"list_filter(list_transform(regexp_extract_all(html, '{_HREF}', 1), lambda x: trim(x)), lambda x: x <> '')"


@registered(f"SELECT page_id, array_to_string(list_sort(list_distinct({_LINKS})), ' ') AS links, CAST(len(list_distinct({_LINKS})) AS BIGINT) AS n_links FROM pages")
def extract_links(spark, sf_dir):
    found = text.extract_links(c("html"))
    return read(spark, sf_dir, "pages").select("page_id", F.array_join(F.array_sort(found), " ").alias("links"), F.size(found).cast("long").alias("n_links"))


@registered(f"SELECT page_id, coalesce(list_filter({_LINKS}, lambda x: regexp_matches(lower(x), 'about|contact|page|item'))[1], '') AS link FROM pages")
def intake_link(spark, sf_dir):
    link = text.first_link_with(text.extract_links(c("html")), ("about", "contact", "page", "item"))
    return read(spark, sf_dir, "pages").select("page_id", link.alias("link"))


_DOMAIN = "regexp_replace(lower(regexp_extract({}, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)), '^www\\.', '')"
_PATH = "regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#;]*)', 1)"
_PAIRS = "list_sort(list_filter(string_split(regexp_extract(url, '\\?([^#]*)', 1), '&'), lambda x: regexp_matches(x, '^[^=]*=.+$')))"
_URL_SQL = f"""
SELECT page_id, lower(regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*):', 1)) || '://' || {_DOMAIN.format('url')}
  || CASE WHEN {_PATH} = '' THEN '/' WHEN {_PATH} = '/' THEN '/' ELSE regexp_replace({_PATH}, '/$', '') END
  || CASE WHEN len({_PAIRS}) = 0 THEN '' ELSE '?' || array_to_string({_PAIRS}, '&') END AS normalized_url
FROM pages"""


@registered(_URL_SQL)
def normalize_url(spark, sf_dir):
    return read(spark, sf_dir, "pages").select("page_id", text.normalize_url(c("url")).alias("normalized_url"))


@registered(f"SELECT page_id, {_DOMAIN.format('url')} AS domain FROM pages")
def normalize_domain(spark, sf_dir):
    return read(spark, sf_dir, "pages").select("page_id", text.normalize_domain(c("url")).alias("domain"))


_LINKED = "regexp_extract(html, 'href=\"(https?://[^\"#]+)', 1)"


@registered(f"SELECT page_id, {_DOMAIN.format('url')} = {_DOMAIN.format(_LINKED)} AS same FROM pages")
def same_domain(spark, sf_dir):
    linked = F.regexp_extract("html", 'href="(https?://[^"#]+)', 1)
    return read(spark, sf_dir, "pages").select("page_id", text.same_domain(c("url"), linked).alias("same"))


@registered(f"SELECT doc_id, 'doc_' || substr(sha1(lower({_norm('source')} || '|' || {_norm('CAST(doc_id AS VARCHAR)')} || '|' || {_norm('lang')})), 1, 16) AS pk FROM documents")
def make_pk(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", text.make_pk("doc", c("source"), c("doc_id"), c("lang")).alias("pk"))


@registered("SELECT doc_id, sha256(coalesce(text, '')) AS content_hash FROM documents")
def content_hash(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", text.content_hash(c("text")).alias("content_hash"))


_EMAILS = "regexp_extract_all(coalesce(text, ''), '[A-Za-z0-9._%+\\-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{2,}')"


@registered(f"SELECT doc_id, array_to_string({_EMAILS}, ' ') AS emails FROM documents WHERE len({_EMAILS}) > 0")
def email_scan(spark, sf_dir):
    found = text.emails(c("text"))
    return read(spark, sf_dir, "documents").where(F.size(found) > 0).select("doc_id", F.array_join(found, " ").alias("emails"))


_PHONE = r"(?:\+?1[-.\s]?)?\(?\d{3}\)?[-.\s]?\d{3}[-.\s]?\d{4}"


@registered(f"SELECT doc_id, {_norm(f'regexp_extract(text, {chr(39)}{_PHONE}{chr(39)}, 0)')} AS phone FROM documents WHERE regexp_matches(text, '{_PHONE}')")
def phone_first(spark, sf_dir):
    return read(spark, sf_dir, "documents").where(c("text").rlike(text.PHONE)).select("doc_id", text.first_phone(c("text")).alias("phone"))


_WORD = "(?i)\\b(license|password|contact)\\b"
_MATCH = f"regexp_extract(text, '{_WORD}', 0)"
#: The match's place is the length of what comes before it; the word also occurs within other words.
_AT = "length(regexp_extract(text, '(?is)^(.*?)\\b(?:license|password|contact)\\b', 1)) + 1"
_START = f"greatest({_AT} - 40, 1)"


@registered(f"""
SELECT doc_id, substr(replace(trim(substr(text, {_START}, {_AT} + length({_MATCH}) + 40 - {_START}), chr(9) || chr(10) || chr(13) || ' '), chr(10), ' '), 1, 180) AS quote
FROM (SELECT doc_id, 'uncontact relicensed ' || text AS text FROM documents) WHERE {_MATCH} <> ''""")
def snippet(spark, sf_dir):
    rows = read(spark, sf_dir, "documents").select("doc_id", F.concat(F.lit("uncontact relicensed "), c("text")).alias("text"))
    return rows.where(F.regexp_extract("text", _WORD, 0) != "").select("doc_id", text.snippet(c("text"), _WORD).alias("quote"))


@registered("""
SELECT c_custkey, CASE WHEN s = '' THEN 'record' ELSE s END AS slug
FROM (SELECT c_custkey, regexp_replace(regexp_replace(lower(c_name), '[^a-z0-9]', '-', 'g'), '^-+|-+$', '', 'g') AS s FROM customer)""")
def safe_slug(spark, sf_dir):
    return read(spark, sf_dir, "customer").select("c_custkey", text.slug(c("c_name")).alias("slug"))


# ---------------------------------------------------------------- predicates and cascades

_STATUS = "CASE CAST(page_id % 9 AS INTEGER) WHEN 0 THEN 403 WHEN 1 THEN 404 WHEN 2 THEN 503 ELSE 200 END"


def _with_status(pages: DataFrame) -> DataFrame:
    m = c("page_id") % 9
    return pages.withColumn("status_code", F.when(m == 0, 403).when(m == 1, 404).when(m == 2, 503).otherwise(200))


def _visible(x: str) -> str:
    v = f"regexp_replace({x}, '(?is)<!--.*?-->', ' ', 'g')"
    for tag in ("script", "style", "noscript"):
        v = f"regexp_replace({v}, '(?is)<{tag}\\b[^>]*>.*?</{tag}>', ' ', 'g')"
    return f"lower({_strip(v)})"


#: On every other page two markers are written with entities.
_CODED = "CASE WHEN page_id % 2 = 0 THEN html ELSE replace(replace(html, 'cookies', 'c&#111;okies'), 'subscribe', 'subscr&#x69;be') END"


def _coded(pages: DataFrame) -> DataFrame:
    out = c("html")
    for plain, coded in (("cookies", "c&#111;okies"), ("subscribe", "subscr&#x69;be")):
        out = F.replace(out, F.lit(plain), F.lit(coded))
    return pages.withColumn("html", F.when(c("page_id") % 2 == 0, c("html")).otherwise(out))


_BLOCK = f"""CASE WHEN {_STATUS} IN (401, 403, 429, 503) THEN 'status:' || CAST({_STATUS} AS VARCHAR)
 {' '.join(f"WHEN contains(replace(replace({_visible('html')}, '&#111;', 'o'), '&#x69;', 'i'), '{m}') THEN 'marker:{m}'" for m in (*signals.BLOCK_MARKERS, 'cookies', 'subscribe', 'buy'))} ELSE '' END"""
_EXTRA_MARKERS = ("cookies", "subscribe", "buy")


@registered(f"SELECT page_id, {_BLOCK} AS reason FROM (SELECT page_id, {_CODED} AS html FROM pages)")
def block_signal(spark, sf_dir):
    return _with_status(_coded(read(spark, sf_dir, "pages"))).select("page_id", signals.block_reason(c("status_code"), c("html"), _EXTRA_MARKERS).alias("reason"))


@registered(f"SELECT page_id FROM (SELECT page_id, {_CODED} AS html FROM pages) WHERE {_STATUS} = 200 AND coalesce(html, '') <> '' AND {_BLOCK} = ''")
def usable_content(spark, sf_dir):
    return _with_status(_coded(read(spark, sf_dir, "pages"))).where(signals.usable(c("status_code"), c("html"), _EXTRA_MARKERS)).select("page_id")


_ROLES = {
    "admin_noise": r"(?i)\b(jobs|privacy)\b", "publication_news": r"(?i)\b(news|blog)\b", "faq_help": r"(?i)\b(faq|help)\b",
    "directory_listing": r"(?i)\b(page/1|page/2|results)\b", "provider_page": r"(?i)\b(with|that)\b", "practice_service": r"(?i)\b(the|le|der|el)\b",
}


def _letters(x: str) -> str:
    """SQL's word borders know ASCII only: letters and digits of other scripts as x, their other signs as hyphens, so that borders are those of the text."""
    for signs, stand_in in ((r"[^\x00-\x7F\P{L}]", "x"), (r"[^\x00-\x7F\P{Nd}]", "x"), (r"[^\x00-\x7F]", "-")):
        x = f"regexp_replace({x}, '{signs}', '{stand_in}', 'g')"
    return x


_HAY = _letters(_norm(f"coalesce(nullif({_TITLE}, ''), {_H1}) || ' ' || url || ' ' || substr({_strip('html')}, 1, 1200)"))
_ROLE_SQL = f"""CASE WHEN page_id % 11 = 0 THEN 'board' WHEN regexp_matches(hay, '{_ROLES['admin_noise']}') THEN 'admin_noise'
 WHEN regexp_matches(hay, '{_ROLES['publication_news']}') THEN 'publication_news' WHEN regexp_matches(hay, '{_ROLES['faq_help']}') THEN 'faq_help'
 WHEN regexp_matches(hay, '{_ROLES['directory_listing']}') THEN 'directory_listing' WHEN regexp_matches(hay, '{_ROLES['provider_page']}') AND page_id % 2 = 0 THEN 'provider_page'
 WHEN regexp_matches(hay, '{_ROLES['practice_service']}') THEN 'practice_service' ELSE 'unknown' END"""


def _classified(spark, sf_dir) -> DataFrame:
    pages = read(spark, sf_dir, "pages").withColumns({"_title": text.extract_title(c("html")), "_text": text.strip_html(c("html"))})
    kind = F.when(c("page_id") % 11 == 0, "licensing_board").otherwise("practice_site")
    role = signals.page_role(kind, c("_title"), c("url"), c("_text"), c("page_id") % 2 == 0, _ROLES, r"(?i)\b(page|item)\b")
    return pages.withColumns({"_kind": kind, "_role": role})


@registered(f"SELECT page_id, {_ROLE_SQL} AS role FROM (SELECT page_id, {_HAY} AS hay FROM pages)")
def page_classification(spark, sf_dir):
    return _classified(spark, sf_dir).select("page_id", c("_role.role").alias("role"))


@registered(f"""
SELECT page_id FROM (SELECT page_id, url, title, {_ROLE_SQL} AS role, regexp_matches(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1)), '(?i)\\b(page|item)\\b') AS detail
  FROM (SELECT page_id, url, coalesce(nullif({_TITLE}, ''), {_H1}) AS title, {_HAY} AS hay FROM pages))
WHERE role = 'board' OR ((role IN ('faq_help', 'provider_page', 'practice_service', 'unknown') OR (role = 'directory_listing' AND page_id % 2 = 0 AND detail))
  AND (page_id % 5 = 0 OR regexp_matches(title || ' ' || url, '(?i)(1|2|3)')))""")
def page_relevance(spark, sf_dir):
    df = _classified(spark, sf_dir)
    return df.where(signals.page_relevant(c("_kind"), c("_role"), c("page_id") % 5 == 0, c("_title"), c("url"), "(?i)(1|2|3)")).select("page_id")


@registered(f"""
SELECT doc_id, CASE WHEN regexp_matches(t, '(?i)\\b(?:the|le|der).{{0,80}}\\b(?:of|la|die)\\b') OR regexp_matches(t, '(?i)\\b(?:of|la|die).{{0,80}}\\b(?:the|le|der)\\b')
  OR regexp_matches(t, '(?i)\\bassessment\\s*,\\s*diagnosis\\s+and\\s+management\\s+of.{{0,60}}\\b(?:the|le|der)\\b') THEN 'yes' ELSE 'unclear' END AS signal
FROM (SELECT doc_id, {_norm(_letters("text"))} AS t FROM documents)""")
def diagnosis_signal(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", signals.diagnosis(text.normalize_text(c("text")), "(?:the|le|der)", "(?:of|la|die)").alias("signal"))


_PLAIN = _letters("text")


@registered(f"""
SELECT doc_id, CASE WHEN a AND b THEN 'child,adolescent,adult' WHEN a THEN 'child,adolescent' WHEN b THEN 'adult' ELSE 'unknown' END AS groups
FROM (SELECT doc_id, regexp_matches({_PLAIN}, '(?i)\\b(with|pour)\\b') AS a, regexp_matches({_PLAIN}, '(?i)\\b(was|nicht)\\b') AS b FROM documents)""")
def age_groups(spark, sf_dir):
    groups = signals.age_groups(c("text"), r"(?i)\b(with|pour)\b", r"(?i)\b(was|nicht)\b")
    return read(spark, sf_dir, "documents").select("doc_id", F.array_join(groups, ",").alias("groups"))


@registered(f"SELECT doc_id, CASE WHEN regexp_matches({_PLAIN}, '(?i)\\b(license|version)\\b') THEN 'yes' ELSE 'unknown' END AS telehealth FROM documents")
def telehealth_flag(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", signals.telehealth(c("text"), r"(?i)\b(license|version)\b").alias("telehealth"))


@registered("""
SELECT p_partkey, CASE WHEN contains(v, 'st') OR contains(v, 'ec') THEN 'MD/DO' WHEN contains(v, 'pr') OR contains(v, 'la') THEN 'PsyD/PhD' WHEN contains(v, 'sm') THEN 'APN/NP'
  WHEN trim(v) = 'pa' OR contains(v, 'physician_assistant') THEN 'PA' WHEN contains(v, 'lcsw') THEN 'LCSW' ELSE '' END AS credential
FROM (SELECT p_partkey, lower(p_type || ' ' || p_brand) AS v FROM part)""")
def credential_key(spark, sf_dir):
    classes = (("MD/DO", ("st", "ec")), ("PsyD/PhD", ("pr", "la")), ("APN/NP", ("sm",)))
    return read(spark, sf_dir, "part").select("p_partkey", signals.credential_class(c("p_type"), c("p_brand"), classes).alias("credential"))


@registered("""
SELECT p_partkey, CASE WHEN contains(v, 'st') THEN 'physician' WHEN contains(v, 'pr') THEN 'psychologist' WHEN trim(v) = 'pa' THEN 'physician_assistant'
  WHEN contains(v, 'lcsw') THEN 'clinical_social_worker' WHEN p_size > 25 THEN 'board_listing' ELSE 'unknown' END AS license_type
FROM (SELECT p_partkey, p_size, lower(p_type) AS v FROM part)""")
def license_type(spark, sf_dir):
    kind = F.when(c("p_size") > 25, "licensing_board").otherwise("")
    return read(spark, sf_dir, "part").select("p_partkey", signals.license_type(c("p_type"), kind, (("physician", ("st",)), ("psychologist", ("pr",)))).alias("license_type"))


_EVENT_STATUS = "CASE event_type WHEN 'error' THEN CASE CAST(user_id % 5 AS INTEGER) WHEN 0 THEN 404 WHEN 1 THEN 429 WHEN 2 THEN 503 WHEN 3 THEN 0 ELSE 700 END WHEN 'signup' THEN 301 WHEN 'view' THEN 204 ELSE 200 END"


def _event_status() -> F.Column:
    m = c("user_id") % 5
    failed = F.when(m == 0, 404).when(m == 1, 429).when(m == 2, 503).when(m == 3, 0).otherwise(700)
    return F.when(c("event_type") == "error", failed).when(c("event_type") == "signup", 301).when(c("event_type") == "view", 204).otherwise(200)


@registered(f"""
SELECT event_id, CASE WHEN s = 0 THEN 'network_error' WHEN s BETWEEN 200 AND 299 THEN 'success' WHEN s = 429 THEN 'throttle' WHEN s BETWEEN 300 AND 399 THEN 'redirect'
  WHEN s BETWEEN 500 AND 599 THEN 'server_error' WHEN s BETWEEN 400 AND 499 THEN 'client_error' ELSE 'unknown_error' END AS status_class
FROM (SELECT event_id, {_EVENT_STATUS} AS s FROM events)""")
def status_class(spark, sf_dir):
    return read(spark, sf_dir, "events").select("event_id", signals.status_class(_event_status()).alias("status_class"))


@registered(f"""
SELECT event_id, CASE WHEN contains(e, 'dns error') OR contains(e, 'lookup address') OR contains(e, 'nodename nor servname') THEN 'dns' WHEN s IN (401, 403, 429, 503) THEN 'blocked'
  WHEN s = 404 THEN 'not_found' WHEN contains(e, 'failed to connect') OR contains(e, 'connecterror') OR contains(e, 'connection') THEN 'connect' ELSE 'error' END AS kind
FROM (SELECT event_id, {_EVENT_STATUS} AS s, CASE WHEN user_id % 7 = 0 THEN 'dns error: x' WHEN user_id % 7 = 1 THEN 'Connection reset' ELSE '' END AS e0,
  lower(CASE WHEN user_id % 7 = 0 THEN 'dns error: x' WHEN user_id % 7 = 1 THEN 'Connection reset' ELSE '' END) AS e FROM events WHERE event_type = 'error')""")
def failure_kind(spark, sf_dir):
    error = F.when(c("user_id") % 7 == 0, "dns error: x").when(c("user_id") % 7 == 1, "Connection reset").otherwise("")
    return read(spark, sf_dir, "events").where("event_type = 'error'").select("event_id", signals.failure_kind(_event_status(), error).alias("kind"))


_STOP = ("steel", "tin", "green")


@registered(f"""
SELECT p_partkey, length(v) BETWEEN 6 AND 80 AND NOT contains(v, '|') AND NOT starts_with(lower(v), 'small ') AND NOT regexp_matches(v, '[0-9]')
  AND len(string_split(v, ' ')) BETWEEN 2 AND 5 AND len(w) >= 2 AND NOT list_has_any(list_transform(w, lambda x: lower(x)), ['steel', 'tin', 'green'])
  AND len(list_filter(w, lambda x: regexp_matches(x, '^[''-]*[A-Z]'))) >= 2 AS person
FROM (SELECT p_partkey, v, list_filter(list_transform(string_split(v, ' '), lambda x: regexp_replace(x, '[^A-Za-z''-]', '', 'g')), lambda x: x <> '') AS w
  FROM (SELECT p_partkey, {_norm('p_type')} AS v FROM part))""")
def person_name_filter(spark, sf_dir):
    return read(spark, sf_dir, "part").select("p_partkey", signals.person_name(c("p_type"), ("small ",), _STOP).alias("person"))


# ---------------------------------------------------------------- seeds and upserts


@registered("SELECT source, lang, min(doc_id) AS doc_id FROM documents GROUP BY source, lang")
def seed_dedupe_first(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", "source", "lang")
    return merge.first_per_key(docs, ["source", "lang"], c("doc_id"))



@registered("""
SELECT user_id, coalesce(arg_max(event_type, ts) FILTER (event_type <> 'view'), arg_min(event_type, ts)) AS event_type,
       coalesce(arg_max(props, ts) FILTER (props <> '{"k": 0}' AND props <> ''), arg_min(props, ts)) AS props
FROM events GROUP BY user_id""")
def upsert_fold_last_nonempty(spark, sf_dir):
    return merge.fold_upserts(read(spark, sf_dir, "events"), ["user_id"], c("ts"), {"event_type": ("view",), "props": ('{"k": 0}', "")})


@registered("SELECT user_id, arg_max(event_id, ts) AS event_id, arg_max(event_type, ts) AS event_type FROM events GROUP BY user_id")
def upsert_replace_last(spark, sf_dir):
    return merge.replace_upserts(read(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "ts"), ["user_id"], c("ts")).select("user_id", "event_id", "event_type")


@registered("""
SELECT o_custkey, string_agg(o_orderpriority, ',' ORDER BY first_key) AS priorities
FROM (SELECT o_custkey, o_orderpriority, min(o_orderkey) AS first_key FROM orders WHERE o_orderpriority <> '' GROUP BY 1, 2) GROUP BY o_custkey""")
def source_urls_ordered_union(spark, sf_dir):
    found = read(spark, sf_dir, "orders").groupBy("o_custkey").agg(merge.ordered_union(c("o_orderpriority"), c("o_orderkey")).alias("p"))
    return found.select("o_custkey", F.array_join("p", ",").alias("priorities"))


@registered("""
SELECT user_id, count(*) AS attempts, count(*) FILTER (event_type <> 'error') AS successes, count(*) FILTER (event_type = 'error') AS failures FROM events GROUP BY user_id""")
def telemetry_counters(spark, sf_dir):
    found = merge.counters(read(spark, sf_dir, "events"), "user_id", c("ts"), c("event_type") == "error")
    return found.select("user_id", "attempts", "successes", "failures")


@registered("""
SELECT e.user_id, count(*) FILTER (event_type = 'error' AND (l.last IS NULL OR e.ts > l.last)) AS streak
FROM events e LEFT JOIN (SELECT user_id, max(ts) AS last FROM events WHERE event_type <> 'error' GROUP BY 1) l ON e.user_id = l.user_id GROUP BY e.user_id""")
def failure_streak(spark, sf_dir):
    found = merge.counters(read(spark, sf_dir, "events"), "user_id", c("ts"), c("event_type") == "error")
    return found.select("user_id", c("consecutive_failures").alias("streak"))


@registered("""
SELECT rule, violations FROM (
  SELECT 'unique:doc_id' AS rule, CAST((SELECT count(*) FROM (SELECT doc_id FROM documents GROUP BY 1 HAVING count(*) > 1)) AS BIGINT) AS violations
  UNION ALL SELECT 'unique:source,lang', CAST((SELECT count(*) FROM (SELECT source, lang FROM documents GROUP BY 1, 2 HAVING count(*) > 1)) AS BIGINT)
  UNION ALL SELECT 'check:length', CAST((SELECT count(*) FROM documents WHERE NOT n_chars > 20) AS BIGINT)) WHERE violations > 0""")
def validate_keys_checks(spark, sf_dir):
    return merge.validate(read(spark, sf_dir, "documents"), [["doc_id"], ["source", "lang"]], {"length": c("n_chars") > 20})


# ---------------------------------------------------------------- joins


@registered("SELECT doc_id, min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS entity_id, count(*) OVER (PARTITION BY coalesce(text, '')) AS members FROM documents")
def exact_text_copies(spark, sf_dir):
    return resolve.exact_copies(read(spark, sf_dir, "documents"), "doc_id", "text")


@registered("""
SELECT c_custkey, coalesce(a.v, b.v, n.v, 'none') AS match FROM customer
LEFT JOIN (SELECT s_suppkey, min(s_name) AS v FROM supplier WHERE s_acctbal > 5000 GROUP BY 1) a ON c_custkey = a.s_suppkey
LEFT JOIN (SELECT s_nationkey, min(s_name) AS v FROM supplier WHERE s_acctbal < 0 GROUP BY 1) b ON c_nationkey = b.s_nationkey
LEFT JOIN (SELECT n_nationkey, min(n_name) AS v FROM nation WHERE n_regionkey < 3 GROUP BY 1) n ON c_nationkey = n.n_nationkey""")
def provider_cascade_lookup(spark, sf_dir):
    s, n = read(spark, sf_dir, "supplier"), read(spark, sf_dir, "nation")
    lookups = [
        (s.where("s_acctbal > 5000").select(c("s_suppkey").alias("c_custkey"), c("s_name").alias("value")), ["c_custkey"]),
        (s.where("s_acctbal < 0").select(c("s_nationkey").alias("c_nationkey"), c("s_name").alias("value")), ["c_nationkey"]),
        (n.where("n_regionkey < 3").select(c("n_nationkey").alias("c_nationkey"), c("n_name").alias("value")), ["c_nationkey"]),
    ]
    return resolve.cascade(read(spark, sf_dir, "customer"), lookups, "none").select("c_custkey", "match")


@registered("""
SELECT l_orderkey, l_linenumber, o_custkey, c_name, n_name, p_name, l_extendedprice FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey JOIN part ON l_partkey = p_partkey WHERE l_returnflag = 'R' ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber LIMIT 100""")
def approved_export_topk(spark, sf_dir):
    t = {n: read(spark, sf_dir, n) for n in ("lineitem", "orders", "customer", "nation", "part")}
    joined = (
        t["lineitem"].where("l_returnflag = 'R'").join(t["orders"], c("l_orderkey") == c("o_orderkey")).join(t["customer"], c("o_custkey") == c("c_custkey"))
        .join(t["nation"], c("c_nationkey") == c("n_nationkey")).join(t["part"], c("l_partkey") == c("p_partkey"))
        .select("l_orderkey", "l_linenumber", "o_custkey", "c_name", "n_name", "p_name", "l_extendedprice")
    )
    return export.top(joined, [F.desc("l_extendedprice"), c("l_orderkey"), c("l_linenumber")], 100)




@registered("SELECT c_custkey, c_name, count(o_orderkey) AS n_orders, coalesce(max(o_orderkey), 0) AS last_order FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY 1, 2")
def dossier_left_join(spark, sf_dir):
    per = read(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count("*").alias("n"), F.max("o_orderkey").alias("last"))
    joined = read(spark, sf_dir, "customer").join(per, c("c_custkey") == c("o_custkey"), "left")
    return joined.select("c_custkey", "c_name", F.coalesce("n", F.lit(0)).alias("n_orders"), F.coalesce("last", F.lit(0)).alias("last_order"))


@registered("""
SELECT s_suppkey, r.p_partkey, coalesce(r.p_name, '') AS rule FROM supplier LEFT JOIN (
  SELECT *, row_number() OVER (PARTITION BY p_size ORDER BY p_partkey) AS n FROM part WHERE p_retailprice > 1000) r ON s_nationkey = r.p_size AND r.n = 1""")
def rule_top1(spark, sf_dir):
    rules = merge.first_per_key(read(spark, sf_dir, "part").where("p_retailprice > 1000"), ["p_size"], c("p_partkey")).select("p_size", "p_partkey", "p_name")
    joined = read(spark, sf_dir, "supplier").join(rules, c("s_nationkey") == c("p_size"), "left")
    return joined.select("s_suppkey", "p_partkey", F.coalesce("p_name", F.lit("")).alias("rule"))


@registered("SELECT doc_id, source FROM documents WHERE NOT EXISTS (SELECT 1 FROM labels WHERE labels.doc_id = documents.doc_id)")
def missing_critical_anti(spark, sf_dir):
    return merge.orphans(read(spark, sf_dir, "documents").select("doc_id", "source"), "doc_id", read(spark, sf_dir, "labels"), "doc_id")


@registered("""
SELECT DISTINCT user_id FROM events e WHERE NOT EXISTS (
  SELECT 1 FROM events f WHERE f.user_id = e.user_id AND f.ts >= TIMESTAMP '2024-01-31 20:00:00' - INTERVAL 24 HOUR)""")
def cached_recently_anti(spark, sf_dir):
    events = read(spark, sf_dir, "events")
    return frontier.recently_fetched(events.select("user_id").distinct(), events, "user_id", "ts", F.lit("2024-01-31 20:00:00").cast("timestamp"))



@registered("SELECT CAST(count(*) FILTER (c_custkey IN (SELECT o_custkey FROM orders)) AS BIGINT) AS with_orders, count(*) AS customers FROM customer")
def exists_pct(spark, sf_dir):
    customers = read(spark, sf_dir, "customer").select("c_custkey")
    buying = read(spark, sf_dir, "orders").select(c("o_custkey").alias("c_custkey")).distinct().withColumn("_has", F.lit(1))
    return customers.join(buying, "c_custkey", "left").agg(F.count("_has").alias("with_orders"), F.count("*").alias("customers"))


# ---------------------------------------------------------------- aggregations, scores and decisions

_TIER = "CASE WHEN value < 30 THEN 'A' WHEN value < 60 THEN 'B' WHEN value < 90 THEN 'C' ELSE 'X' END"
_WEIGHT = f"CASE {_TIER} WHEN 'A' THEN 0.92 WHEN 'B' THEN 0.78 WHEN 'C' THEN 0.55 ELSE 0.4 END"


def _event_evidence(spark, sf_dir) -> DataFrame:
    tier = F.when(c("value") < 30, "A").when(c("value") < 60, "B").when(c("value") < 90, "C").otherwise("X")
    return read(spark, sf_dir, "events").select(
        c("user_id").alias("record_id"), c("event_type").alias("field_name"), c("props").alias("field_value"), tier.alias("source_tier"),
        F.when(c("event_id") % 4 == 0, "").otherwise(F.concat(F.lit("https://s"), (c("event_id") % 13).cast("string"), F.lit(".org/x"))).alias("source_url"),
        c("props").alias("quote"), c("ts").alias("captured_at"), c("event_id").alias("evidence_id"),
    )


@registered(f"SELECT user_id AS record_id, event_type AS field_name, CAST(round(1000 * coalesce(max({_WEIGHT}) FILTER (event_id % 4 <> 0), 0)) AS BIGINT) AS weight_milli FROM events GROUP BY 1, 2")
def field_confidence(spark, sf_dir):
    return score.best_evidence(_event_evidence(spark, sf_dir)).select("record_id", "field_name", F.round(c("weight") * 1000).cast("long").alias("weight_milli"))


_FIELDS = ("signup", "error", "click", "purchase")
_CAPPED = ", ".join(
    f"coalesce(max(CASE WHEN event_type = '{f}' AND event_id % 4 <> 0 THEN {_WEIGHT} END), 0) AS w_{f}" for f in _FIELDS
)


@registered(f"""
SELECT record_id, CAST(round(1000 * (least(w_signup, 0.45) + w_error + least(w_click, 0.68) + w_purchase)) AS BIGINT) AS total_milli
FROM (SELECT user_id AS record_id, {_CAPPED} FROM events GROUP BY 1)""")
def record_confidence(spark, sf_dir):
    evidence = _event_evidence(spark, sf_dir)
    values = {"signup": "unknown", "error": "yes", "click": "limited", "purchase": "yes"}
    records = evidence.select("record_id").distinct().withColumns({f: F.lit(v) for f, v in values.items()})
    scored = score.field_confidence(records, evidence, _FIELDS)
    total = sum((F.round(c(f"conf_{f}") * 1000).cast("long") for f in _FIELDS[1:]), F.round(c(f"conf_{_FIELDS[0]}") * 1000).cast("long"))
    return scored.select("record_id", total.alias("total_milli"))



@registered(f"""
WITH e AS (SELECT user_id AS record_id, event_type AS field_name, props AS field_value, event_id, {_TIER} AS tier, ts,
    CASE WHEN event_id % 4 = 0 THEN '' ELSE 'https://s' || CAST(event_id % 13 AS VARCHAR) || '.org/x' END AS url FROM events WHERE event_type IN ('click', 'error') AND props <> ''),
k AS (SELECT *, row_number() OVER (PARTITION BY record_id, field_name ORDER BY CASE tier WHEN 'A' THEN 0 WHEN 'B' THEN 1 ELSE 2 END, ts DESC, event_id) AS n,
    first_value(field_value) OVER (PARTITION BY record_id, field_name ORDER BY CASE tier WHEN 'A' THEN 0 WHEN 'B' THEN 1 ELSE 2 END, ts DESC, event_id) AS preferred FROM e),
d AS (SELECT record_id, field_name FROM e GROUP BY 1, 2 HAVING count(DISTINCT field_value) > 1)
SELECT DISTINCT k.record_id, k.field_name, preferred AS preferred_value, field_value AS conflicting_value, url AS conflicting_source_url
FROM k JOIN d ON k.record_id = d.record_id AND k.field_name = d.field_name WHERE n > 1""")
def conflict_pairs(spark, sf_dir):
    found = review.contradictions(_event_evidence(spark, sf_dir), ("click", "error"))
    return found.select("record_id", "field_name", "preferred_value", "conflicting_value", "conflicting_source_url")


_CONF = "(n_chars % 100) / 100.0"


@registered(f"""
SELECT d.doc_id, CASE WHEN quality = 0 AND NOT valid THEN 'directory_sludge' WHEN NOT valid AND toxic = 1 THEN 'practice_only_signal'
  WHEN valid AND lang = 'fr' AND critical <= 1 AND n_chars % 100 < 70 THEN 'indirect_provider_signal'
  WHEN NOT contact AND critical = 0 AND n_chars % 100 < 55 AND quality = 0 THEN 'weak_provider_signal' END AS lane
FROM (SELECT documents.*, doc_id % 3 <> 0 AS valid, doc_id % 2 = 0 AS contact, doc_id % 4 AS critical FROM documents) d JOIN labels ON labels.doc_id = d.doc_id""")
def triage_cascade(spark, sf_dir):
    joined = read(spark, sf_dir, "documents").join(read(spark, sf_dir, "labels"), "doc_id")
    lane = signals.triage(
        c("quality") == 0, c("doc_id") % 3 != 0, c("toxic") == 1, c("lang") == "fr", c("doc_id") % 2 == 0, c("doc_id") % 4, (c("n_chars") % 100) / 100.0, c("quality") == 0
    )
    return joined.select("doc_id", lane.alias("lane"))




@registered("""
SELECT user_id AS record_id, count(*) AS evidence_count, arg_max(CASE WHEN event_id % 4 = 0 THEN '' ELSE 'https://s' || CAST(event_id % 13 AS VARCHAR) || '.org/x' END, ts) AS latest_source_url,
  coalesce(array_to_string(list_sort(list_distinct(list(CASE WHEN event_id % 4 <> 0 THEN 's' || CAST(event_id % 13 AS VARCHAR) || '.org' END) FILTER (event_id % 4 <> 0))), ','), '') AS domains
FROM events GROUP BY 1""")
def evidence_rollup_latest(spark, sf_dir):
    found = review.source_summary(_event_evidence(spark, sf_dir), ("click", "error"))
    return found.select("record_id", "evidence_count", "latest_source_url", F.array_join("domains", ",").alias("domains"))


@registered("""
SELECT o_custkey, o_orderkey, o_totalprice, locations, records FROM (
  SELECT o_custkey, o_orderkey, o_totalprice, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderstatus, o_orderpriority, o_orderdate DESC, o_orderkey) AS n FROM orders) p
JOIN (SELECT o_custkey AS k, count(DISTINCT (o_orderstatus, o_orderpriority)) AS locations, count(*) AS records FROM orders GROUP BY 1) g ON g.k = p.o_custkey WHERE n = 1""")
def dossier_group_primary(spark, sf_dir):
    orders = read(spark, sf_dir, "orders")
    found = export.dossiers(orders, "o_custkey", [c("o_orderstatus"), c("o_orderpriority"), F.desc("o_orderdate"), c("o_orderkey")], "o_orderpriority", ["o_orderstatus", "o_orderpriority"])
    return found.select("o_custkey", "o_orderkey", "o_totalprice", "locations", "records")



@registered("""
SELECT o_custkey, CASE WHEN n >= 4 OR s >= 3 THEN 'Enterprise / multi-site' WHEN n >= 2 OR s >= 2 THEN 'Regional / growing group' ELSE 'Single-site / owner-led' END AS band
FROM (SELECT o_custkey, count(DISTINCT o_orderstatus) AS s, count(DISTINCT o_orderpriority) AS n FROM orders GROUP BY 1)""")
def budget_band(spark, sf_dir):
    per = read(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count_distinct("o_orderstatus").alias("s"), F.count_distinct("o_orderpriority").alias("n"))
    return per.select("o_custkey", dossier.budget(F.lit(""), F.lit(""), c("n"), c("s")).alias("band"))


@registered(f"""
SELECT page_id, CASE WHEN len(p) = 0 THEN h ELSE h || '::' || array_to_string(p[1:2], '::') END AS account FROM (
  SELECT page_id, lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)) AS h,
    list_filter(string_split(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1)), '/'), lambda x: trim(x) <> '') AS p FROM pages)""")
def review_account_key(spark, sf_dir):
    return read(spark, sf_dir, "pages").select("page_id", dossier.account_key(c("url")).alias("account"))


@registered("""
SELECT c_custkey, CASE WHEN contains(v, ' ') THEN string_split(v, ' ')[1] || ' ' || string_split(v, ' ')[-1] ELSE v END AS canonical
FROM (SELECT c_custkey, lower(replace(c_name, '#', ' ')) AS v FROM customer)""")
def canonical_contact_name(spark, sf_dir):
    return read(spark, sf_dir, "customer").select("c_custkey", dossier.canonical_name(F.regexp_replace("c_name", "#", " ")).alias("canonical"))


@registered("""
SELECT source, CASE WHEN a AND r THEN 'approved_outreach_ready' WHEN a THEN 'approved' WHEN p THEN 'practice_signal' WHEN q THEN 'under_review' ELSE 'candidate' END AS state
FROM (SELECT source, bool_or(n_chars > 9000) AS a, bool_or(n_chars > 15000) AS r, bool_or(lang = 'es' AND n_chars > 8000) AS p, bool_or(n_chars < 50) AS q FROM documents GROUP BY 1)""")
def qa_state(spark, sf_dir):
    per = read(spark, sf_dir, "documents").groupBy("source").agg(
        F.bool_or(c("n_chars") > 9000).alias("a"), F.bool_or(c("n_chars") > 15000).alias("r"),
        F.collect_set(F.when((c("lang") == "es") & (c("n_chars") > 8000), "practice_only_signal")).alias("p"), F.bool_or(c("n_chars") < 50).alias("q"),
    )
    return per.select("source", dossier.qa_state(c("a"), c("r"), c("p"), c("q")).alias("state"))


# ---------------------------------------------------------------- presets, search and SQL


def _telemetry(spark, sf_dir) -> DataFrame:
    events = read(spark, sf_dir, "events")
    return events.groupBy(F.concat(F.lit("u"), c("user_id").cast("string")).alias("seed_domain")).agg(
        F.max_by(_event_status(), "ts").alias("last_status_code"), F.max_by(F.when(c("event_type") == "error", "failed").otherwise("completed"), "ts").alias("last_run_status"),
        F.count_if(c("event_type") != "error").alias("last_run_success_pages"), F.count_if(c("event_type") == "error").alias("last_run_failure_pages"), F.max("ts").alias("last_run_completed_at"),
    )


_TELEMETRY = f"""(SELECT 'u' || CAST(user_id AS VARCHAR) AS seed_domain, arg_max({_EVENT_STATUS}, ts) AS last_status_code,
  arg_max(CASE WHEN event_type = 'error' THEN 'failed' ELSE 'completed' END, ts) AS last_run_status, count(*) FILTER (event_type <> 'error') AS last_run_success_pages,
  count(*) FILTER (event_type = 'error') AS last_run_failure_pages, max(ts) AS last_run_completed_at FROM events GROUP BY user_id) AS seed_telemetry"""


def _preset(name: str, view: str, sql_source: str):
    """Register a preset over one view made of driver tables."""
    _, columns, condition, order = query.PRESETS[name]

    def decorate(make):
        def run(spark, sf_dir):
            make(spark, sf_dir).createOrReplaceTempView(view)
            return query.preset(spark, name)

        key = "preset_" + name.replace("-domains", "").replace("-records", "").replace("-", "_")
        QUERIES[key] = run
        SQL[key] = f"SELECT {columns} FROM {sql_source} WHERE {condition} ORDER BY {order} LIMIT 20"
        return run

    return decorate


_preset("failed-domains", "seed_telemetry", _TELEMETRY)(_telemetry)
_preset("blocked-domains", "seed_telemetry", _TELEMETRY)(_telemetry)


def _records(spark, sf_dir) -> DataFrame:
    joined = read(spark, sf_dir, "orders").join(read(spark, sf_dir, "customer"), c("o_custkey") == c("c_custkey"))
    return joined.select(
        c("o_orderkey").alias("record_id"), c("c_name").alias("provider_name_snapshot"), F.concat(F.lit("P"), c("o_orderkey").cast("string")).alias("practice_name_snapshot"),
        (c("o_orderkey") % 1009 / 1009.0).alias("record_confidence"), c("o_orderstatus").alias("review_status"), c("o_orderpriority").alias("blocked_reason"),
        c("o_orderdate").alias("updated_at"), (c("o_orderkey") % 997 / 997.0).alias("outreach_fit_score"), F.lit("yes").alias("diagnoses_asd"), F.lit("unclear").alias("diagnoses_adhd"),
        F.when(c("c_acctbal") > 0, "active").otherwise("unknown").alias("license_status"), (c("o_orderkey") % 7 == 0).cast("int").alias("outreach_ready"),
        c("o_orderdate").alias("created_at"),
    )


_RECORDS = """(SELECT o_orderkey AS record_id, c_name AS provider_name_snapshot, 'P' || CAST(o_orderkey AS VARCHAR) AS practice_name_snapshot, CAST(o_orderkey % 1009 AS DOUBLE) / 1009.0 AS record_confidence,
  o_orderstatus AS review_status, o_orderpriority AS blocked_reason, o_orderdate AS updated_at, CAST(o_orderkey % 997 AS DOUBLE) / 997.0 AS outreach_fit_score, 'yes' AS diagnoses_asd,
  'unclear' AS diagnoses_adhd, CASE WHEN c_acctbal > 0 THEN 'active' ELSE 'unknown' END AS license_status, CASE WHEN o_orderkey % 7 = 0 THEN 1 ELSE 0 END AS outreach_ready
  FROM orders JOIN customer ON o_custkey = c_custkey) AS provider_practice_records"""

_preset("low-confidence-records", "provider_practice_records", _RECORDS)(_records)
_preset("outreach-ready", "provider_practice_records", _RECORDS)(_records)


def _review_rows(spark, sf_dir) -> DataFrame:
    e = read(spark, sf_dir, "events")
    return e.select(
        c("event_id").alias("review_id"), c("event_type").alias("review_type"), F.concat(F.lit("u"), c("user_id").cast("string")).alias("provider_name"), F.lit("").alias("practice_name"),
        c("props").alias("reason"), F.lit("").alias("source_url"), F.lit("pending").alias("status"), c("ts").alias("created_at"),
    )


_preset("review-queue", "review_queue", """(SELECT event_id AS review_id, event_type AS review_type, 'u' || CAST(user_id AS VARCHAR) AS provider_name, '' AS practice_name, props AS reason, '' AS source_url,
  'pending' AS status, ts AS created_at FROM events) AS review_queue""")(_review_rows)


@registered(f"""
SELECT event_type AS field_name, props AS preferred_value, 'x' AS conflicting_value, '' AS preferred_source_url, '' AS conflicting_source_url, provider_name_snapshot AS provider_name, practice_name_snapshot AS practice_name
FROM events JOIN {_RECORDS} ON events.event_id = record_id ORDER BY events.ts DESC, events.event_id LIMIT 20""")
def preset_contradictions(spark, sf_dir):
    _records(spark, sf_dir).createOrReplaceTempView("provider_practice_records")
    read(spark, sf_dir, "events").select(
        c("event_id").alias("contradiction_id"), c("event_id").alias("record_id"), c("event_type").alias("field_name"), c("props").alias("preferred_value"), F.lit("x").alias("conflicting_value"),
        F.lit("").alias("preferred_source_url"), F.lit("").alias("conflicting_source_url"), c("ts").alias("created_at"),
    ).createOrReplaceTempView("contradictions")
    return query.preset(spark, "contradictions")


@registered("SELECT c_custkey, c_name, c_mktsegment FROM customer WHERE lower(c_name) LIKE '%1_3%' OR lower(c_mktsegment) LIKE '%1_3%' ORDER BY c_name, c_custkey LIMIT 20")
def search_like(spark, sf_dir):
    return query.search(read(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment"), ["c_name", "c_mktsegment"], "1_3", ["c_name", "c_custkey"])


@registered("""
SELECT 'documents' AS metric, count(*) AS value FROM documents UNION ALL SELECT 'orders', count(*) FROM orders UNION ALL SELECT 'toxic', count(*) FROM labels WHERE toxic = 1
UNION ALL SELECT 'finished', count(*) FROM orders WHERE o_orderstatus = 'F'""")
def status_counts(spark, sf_dir):
    tables = {n: read(spark, sf_dir, n) for n in ("documents", "orders", "labels")}
    counted = query.status_counts({n: tables[n] for n in ("documents", "orders")})
    part = query.status_counts({"toxic": tables["labels"].where("toxic = 1"), "finished": tables["orders"].where("o_orderstatus = 'F'")})
    return counted.unionByName(part)


_PASSED = """WITH spend AS (SELECT o_custkey, sum(o_totalprice) AS total, count(*) AS n FROM orders GROUP BY o_custkey)
SELECT c_mktsegment, count(*) AS customers, sum(n) AS orders FROM customer JOIN spend ON c_custkey = o_custkey WHERE total > 500000 GROUP BY c_mktsegment ORDER BY c_mktsegment"""


@registered(f"SELECT c_mktsegment, customers, CAST(orders AS BIGINT) AS orders FROM ({_PASSED})")
def sql_passthrough(spark, sf_dir):
    for n in ("customer", "orders"):
        read(spark, sf_dir, n).createOrReplaceTempView(n)
    return query.run_sql(spark, _PASSED)


@registered("SELECT * FROM (SELECT conv_id, turn, role FROM conversations ORDER BY conv_id DESC, turn DESC LIMIT 50) ORDER BY conv_id, turn")
def tail_n_ascending(spark, sf_dir):
    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role").withColumn("_o", F.struct("conv_id", "turn"))
    return query.tail(rows, "_o", 50).drop("_o")


# ---------------------------------------------------------------- frontier

_UPATH = "lower(CASE WHEN regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1) = '' THEN '/' ELSE regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1) END)"
_HINTS = {"1": 22, "2": 18, "page": 10, "item": -40}
_SCORE = f"CASE WHEN {_UPATH} = '/' THEN 52 ELSE 0 END + " + " + ".join(f"CASE WHEN contains({_UPATH}, '{k}') THEN {v} ELSE 0 END" for k, v in _HINTS.items())


def _scored_urls(spark, sf_dir) -> DataFrame:
    pages = read(spark, sf_dir, "pages").select("page_id", "url")
    root = F.concat(F.regexp_extract("url", r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1), F.lit("/"))
    return pages.withColumns({"domain": text.normalize_domain(c("url")), "score": frontier.research_score(c("url"), root, F.lit("practice_site"), hints=_HINTS)})


@registered(f"""
SELECT page_id, domain, score, rank FROM (SELECT page_id, domain, score, row_number() OVER (PARTITION BY domain ORDER BY score DESC, length(p), url) AS rank
  FROM (SELECT page_id, url, {_DOMAIN.format('url')} AS domain, {_UPATH} AS p, {_SCORE} AS score FROM pages) WHERE score >= 10) WHERE rank <= 3""")
def url_rank_topk(spark, sf_dir):
    return frontier.ranked(_scored_urls(spark, sf_dir), "domain", "url", "score", 10, 3).select("page_id", "domain", "score", "rank")


@registered(f"""
SELECT page_id, CASE WHEN p = '/a' OR starts_with(p, '/a/') OR p = '/docs' OR starts_with(p, '/docs/') THEN 'suppressed_prefix'
  WHEN {' OR '.join(f"starts_with(p, '{x}')" for x in frontier.STATIC_PATHS)} THEN 'static_path'
  WHEN {' OR '.join(f"p = '{x.rstrip('/')}' OR starts_with(p, '{x}')" for x in frontier.LOW_VALUE_PATHS)} THEN 'low_value_path'
  WHEN {' OR '.join(f"ends_with(p, '{x}')" for x in frontier.STATIC_ENDINGS)} THEN 'static_extension' ELSE '' END AS reason
FROM (SELECT page_id, {_UPATH} AS p FROM pages)""")
def url_reject_reason(spark, sf_dir):
    return read(spark, sf_dir, "pages").select("page_id", frontier.reject_reason(c("url"), ("/a/", "/docs/")).alias("reason"))


@registered(f"""
SELECT page_id, domain FROM (SELECT page_id, {_DOMAIN.format('url')} AS domain, row_number() OVER (PARTITION BY {_DOMAIN.format('url')} ORDER BY page_id) AS n FROM pages)
WHERE n <= CASE WHEN contains(domain, '1') THEN 2 ELSE 5 END""")
def page_budget(spark, sf_dir):
    pages = read(spark, sf_dir, "pages").select("page_id", text.normalize_domain(c("url")).alias("domain"))
    return frontier.within_budget(pages, "domain", ["page_id"], F.when(c("domain").contains("1"), 2).otherwise(5)).select("page_id", "domain")


@registered(f"""
SELECT user_id, kind, event_id, n AS failures FROM (SELECT user_id, kind, event_id, row_number() OVER (PARTITION BY user_id, kind ORDER BY ts, event_id) AS n
  FROM (SELECT user_id, event_id, ts, CASE WHEN user_id % 7 = 0 THEN 'dns' WHEN {_EVENT_STATUS} IN (429, 503) THEN 'blocked' WHEN {_EVENT_STATUS} = 404 THEN 'not_found' ELSE 'error' END AS kind
    FROM events WHERE event_type = 'error')) WHERE (kind = 'dns' AND n = 1) OR (kind = 'blocked' AND n = 3) OR (kind = 'not_found' AND n = 8)""")
def failure_storm_first_crossing(spark, sf_dir):
    error = F.when(c("user_id") % 7 == 0, "dns error").otherwise("")
    failures = read(spark, sf_dir, "events").where("event_type = 'error'").withColumn("kind", signals.failure_kind(_event_status(), error))
    return frontier.storms(failures, "user_id", ["ts", "event_id"], "kind").select("user_id", "kind", "event_id", "failures")


#: Fetches made of events: users as domains, a path that some events share, a policy by user.
_PAGE_LIMIT = 12
_FETCHED = f"""(SELECT user_id, 'u' || CAST(user_id AS VARCHAR) AS domain, ts, event_id, CASE WHEN event_type <> 'error' THEN NULL WHEN user_id % 7 = 0 THEN 'dns' WHEN {_EVENT_STATUS} IN (429, 503) THEN 'blocked'
  WHEN {_EVENT_STATUS} = 404 THEN 'not_found' WHEN user_id % 7 = 1 THEN 'connect' ELSE 'error' END AS kind, CASE event_id % 4 WHEN 0 THEN '/' WHEN 1 THEN '/a.html' ELSE '/p' || CAST(event_id % 4 AS VARCHAR) || '/' END AS prefix,
  {_EVENT_STATUS} AS status, CASE WHEN user_id % 7 = 0 THEN 'dns error: x' WHEN user_id % 7 = 1 THEN 'Connection reset' ELSE '' END AS error FROM events)"""
_INTERVENED = f"""
SELECT domain, CASE kind WHEN 'dns' THEN 'auto_quarantine_seed' WHEN 'blocked' THEN 'auto_stop_domain' ELSE 'auto_disable_discovery' END AS action, CASE kind WHEN 'dns' THEN 'dns_failure' ELSE kind || '_storm' END AS reason,
  '' AS detail, event_id, n AS failures FROM (SELECT *, count(*) OVER (PARTITION BY domain, kind ORDER BY ts, event_id) AS n FROM {_FETCHED} WHERE kind IS NOT NULL)
  WHERE n = CASE kind WHEN 'dns' THEN 1 WHEN 'blocked' THEN 3 WHEN 'not_found' THEN 8 END
UNION ALL SELECT domain, 'auto_suppress_prefix', kind || '_storm', prefix, event_id, n FROM (SELECT *, count(*) OVER (PARTITION BY domain, prefix ORDER BY ts, event_id) AS n FROM {_FETCHED} WHERE kind IS NOT NULL AND prefix <> '/') WHERE n = 3
UNION ALL SELECT domain, 'browser_escalation', 'status:' || CAST(status AS VARCHAR), '', event_id, NULL FROM (SELECT *, row_number() OVER (PARTITION BY domain ORDER BY ts, event_id) AS k FROM
  (SELECT *, count(*) FILTER (kind IS NULL) OVER (PARTITION BY domain ORDER BY ts, event_id) AS came FROM {_FETCHED}) WHERE kind = 'blocked' AND user_id % 3 <> 0 AND user_id % 4 <> 0 AND came < {_PAGE_LIMIT}) WHERE k = 1"""


def _fetched(rows: DataFrame) -> DataFrame:
    error = F.when(c("user_id") % 7 == 0, "dns error: x").when(c("user_id") % 7 == 1, "Connection reset").otherwise("")
    path = F.when(c("event_id") % 4 == 0, "").when(c("event_id") % 4 == 1, "a.html").otherwise(F.concat(F.lit("p"), (c("event_id") % 4).cast("string"), F.lit("/x")))
    return domains.fetches(
        rows, F.concat(F.lit("u"), c("user_id").cast("string")), c("ts"), c("event_id"), F.concat(F.lit("https://e.org/"), path), _event_status(), error, c("event_type") != "error",
        F.when(c("user_id") % 3 == 0, "http_only").otherwise("auto"), c("user_id") % 4 != 0, F.lit(2),
    )


@registered(_INTERVENED)
def domain_interventions(spark, sf_dir):
    return domains.interventions(_fetched(read(spark, sf_dir, "events")), _PAGE_LIMIT)


@registered(f"""
SELECT *, NULL AS pages FROM ({_INTERVENED})
UNION ALL SELECT domain, 'observed', arg_max(CASE WHEN kind IS NULL THEN '' WHEN error = '' THEN kind ELSE error END, (ts, event_id)), '', arg_max(event_id, (ts, event_id)), count(kind), count(*) FILTER (kind IS NULL) FROM {_FETCHED} GROUP BY domain""")
def domain_state_stream(spark, sf_dir):
    """The same by a stateful stream, run to its end over the table as one micro-batch, with what each domain's state holds then."""
    # a pattern, since a stream's plain path has to be a folder and the table may be one file
    events = spark.readStream.schema(read(spark, sf_dir, "events").schema).parquet(f"{sf_dir}/event[s].parquet")
    return domains.stored(domains.domain_stream(_fetched(events), _PAGE_LIMIT), f"{shared_folder(spark)}/domains-{uuid.uuid4().hex}").drop("batch")


# ---------------------------------------------------------------- quality report

_REFERENCE_DAY = "1998-09-01"


@registered(f"""
SELECT CASE WHEN d <= 30 THEN '0-30' WHEN d <= 90 THEN '31-90' WHEN d <= 180 THEN '91-180' ELSE '180+' END AS bucket, count(*) AS n
FROM (SELECT date_diff('day', CAST(o_orderdate AS DATE), DATE '{_REFERENCE_DAY}') AS d FROM orders) GROUP BY 1""")
def freshness_buckets(spark, sf_dir):
    d = F.date_diff(F.lit(_REFERENCE_DAY).cast("date"), c("o_orderdate").cast("date"))
    bucket = F.when(d <= 30, "0-30").when(d <= 90, "31-90").when(d <= 180, "91-180").otherwise("180+")
    return read(spark, sf_dir, "orders").groupBy(bucket.alias("bucket")).agg(F.count("*").alias("n"))


@registered("SELECT count(*) AS keys, count(*) FILTER (n > 1) AS repeated, CAST(sum(n) FILTER (n > 1) AS BIGINT) AS rows_repeated FROM (SELECT sha256(coalesce(text, '')) AS h, count(*) AS n FROM documents GROUP BY 1)")
def dup_key_rate(spark, sf_dir):
    per = read(spark, sf_dir, "documents").groupBy(text.content_hash(c("text")).alias("h")).agg(F.count("*").alias("n"))
    return per.agg(F.count("*").alias("keys"), F.count_if(c("n") > 1).alias("repeated"), F.sum(F.when(c("n") > 1, c("n"))).alias("rows_repeated"))


@registered("SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1 ORDER BY n DESC, o_custkey LIMIT 10")
def topk_group_count(spark, sf_dir):
    return read(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "o_custkey").limit(10)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed pages with title, domain, role, key and research score, the most promising first."""
    pages = _classified(spark, sf_dir).join(_scored_urls(spark, sf_dir).drop("url"), "page_id")
    keyed = pages.select(
        "page_id", text.make_pk("page", text.normalize_url(c("url")), text.content_hash(c("html"))).alias("page_pk"), "domain", c("_title").alias("title"),
        c("_role.role").alias("role"), "score", F.size(text.extract_links(c("html"))).alias("links"),
    )
    return keyed.orderBy(F.desc("score"), "page_id").limit(20)


