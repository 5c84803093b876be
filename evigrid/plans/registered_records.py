"""Registered queries that run the record engine itself over the driver's tables.

Customers stand for extracted rows and landed pages, orders for records, line items for evidence, so
that every stage runs over whole tables; the SQL states the same rows in its own way.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import make_pk
from ..operators import accounts, extract, frontier, resolve, review, score
from ..operators.graph import cut, shared_folder
from ..sources import landing, seeds, store
from .registered import c, read, registered

FIRST = ("Ann", "Bob", "Cara", "Dale", "Eve", "Finn", "Gail", "Hugo", "Iris", "Jack", "Kate", "Liam", "Mona")
LAST = ("Abel", "Brook", "Cole", "Dunn", "Ellis", "Ford", "Grant", "Hale", "Irwin", "Jones", "Kemp", "Lane", "Moss", "Nash", "Owen", "Page", "Quinn")


def _pick(values: tuple[str, ...], at: str) -> str:
    """SQL that both engines read: the value at a place, counted from 0."""
    return f"CASE {at} " + " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values)) + " END"


_K = "c_custkey"
_NAME = f"({_pick(FIRST, f'{_K} % 13')}) || ' ' || ({_pick(LAST, f'CAST(floor({_K} / 13) AS BIGINT) % 17')})"
#: Columns of an extracted row, as SQL over ``customer`` that both engines read.
ROW = {
    "extracted_id": f"'e' || lpad(CAST({_K} AS STRING), 9, '0')", "created_at": f"CAST(({_K} * 37) % 5000 AS BIGINT)", "provider_name": f"CASE WHEN {_K} % 11 = 0 THEN '' ELSE {_NAME} END",
    "credentials": _pick(("PsyD", "MD", "PhD", ""), f"{_K} % 4"), "npi": f"CASE WHEN {_K} % 5 = 0 THEN '1' || lpad(CAST({_K} % 300 AS STRING), 9, '0') ELSE '' END",
    "source_url": f"CASE WHEN {_K} % 7 = 3 THEN 'https://www.portal.net/site' || CAST({_K} % 37 AS STRING) || '.org' ELSE 'https://site' || CAST({_K} % 37 AS STRING) || '.org/p' || CAST({_K} % 3 AS STRING) END", "source_tier": _pick(("A", "B", "C"), f"{_K} % 3"),
    "source_type": f"CASE WHEN {_K} % 9 = 0 THEN 'licensing_board' ELSE 'practice_site' END", "practice_name": f"'Clinic ' || CAST({_K} % 41 AS STRING)",
    "intake_url": f"CASE WHEN {_K} % 4 = 0 THEN 'https://site' || CAST({_K} % 37 AS STRING) || '.org/intake' ELSE '' END",
    "phone": f"CASE WHEN {_K} % 3 = 0 THEN '' ELSE '201555' || lpad(CAST({_K} % 50 AS STRING), 4, '0') END", "city": _pick(("Newark", "Edison", "Union", ""), f"CAST(floor({_K} / 4) AS BIGINT) % 4"),
    "state": _pick(("NJ", "NY"), "c_nationkey % 2"), "license_state": _pick(("NJ", "NY"), "c_nationkey % 2"),
    "license_type": f"CASE WHEN {_K} % 9 = 0 THEN {_pick(('psychologist', 'unknown'), f'{_K} % 2')} ELSE {_pick(('physician', 'psychologist', 'unknown'), f'{_K} % 3')} END",
    "license_status": _pick(("active", "unknown", "inactive"), "c_nationkey % 3"), "diagnoses_asd": _pick(("yes", "unclear"), f"{_K} % 2"),
    "diagnoses_adhd": f"CASE WHEN {_K} % 7 = 0 THEN 'yes' ELSE 'unclear' END", "telehealth": f"CASE WHEN {_K} % 6 = 0 THEN 'yes' ELSE 'unknown' END",
}
_ROW_SQL = "SELECT " + ", ".join(f"{sql} AS {name}" for name, sql in ROW.items()).replace("AS STRING", "AS VARCHAR") + " FROM customer"


def extracted(spark, sf_dir) -> DataFrame:
    """Extracted rows made of customers, with evidence of their diagnosis and licence."""
    rows = read(spark, sf_dir, "customer").select(*(F.expr(sql).alias(name) for name, sql in ROW.items()))
    item = lambda f, v: F.struct(F.lit(f).alias("field"), v.alias("value"), F.concat(F.lit(f"{f}: "), v).alias("quote"), c("source_url").alias("source_url"))
    shown = F.array_compact(F.array(item("diagnoses_asd", c("diagnoses_asd")), F.when(c("license_status") != "unknown", item("license_status", c("license_status")))))
    return rows.withColumns({"website": c("source_url"), "age_groups": F.array(F.lit("child")), "evidence": shown})


def _pk(prefix: str, *parts: str) -> str:
    return f"'{prefix}_' || substr(sha1(lower(" + " || '|' || ".join(f"coalesce({p}, '')" for p in parts) + ")), 1, 16)"


_DOMAIN = "CASE WHEN source_url LIKE '%portal.net%' THEN 'portal.net' ELSE 'site' || regexp_extract(source_url, 'site([0-9]+)', 1) || '.org' END"
_ORDER = "lpad(CAST(created_at AS VARCHAR), 6, '0') || extracted_id"
#: Assignment in SQL, one row after the other: ``walk`` holds the tables of providers, records and practices as the rows so far
#: leave them, and looks the next row up in them.
_ASSIGNED = f"""
WITH RECURSIVE x AS (
  SELECT *, row_number() OVER (ORDER BY o) AS i,
    {_pk('prov', 'provider_name', 'credentials', 'state', "coalesce(nullif(npi, ''), source_url)")} AS own_id, {_pk('prac', 'practice_name', 'dom')} AS practice_id
  FROM (SELECT *, lower(provider_name) AS nm, {_DOMAIN} AS dom, lower(state) AS st, {_ORDER} AS o, source_type = 'licensing_board' AS board FROM ({_ROW_SQL}))),
steps AS (SELECT *, {_pk('loc', 'practice_id', 'city', 'state', "coalesce(nullif(phone, ''), dom)")} AS location_id FROM x),
walk(kind, id, i, born, name, npi, st, city, phone, site, practice, provider, how) USING KEY (kind, id) AS (
  SELECT 'cursor', '', 0::BIGINT, 0::BIGINT, '', '', '', '', '', '', '', '', ''
  UNION
  SELECT * FROM (
    WITH r AS (SELECT s.* FROM steps s JOIN walk w ON w.kind = 'cursor' AND s.i = w.i + 1),
    near AS (SELECT t.* FROM recurring.walk t, r WHERE (t.kind IN ('provider', 'record') AND r.nm <> '' AND t.name = r.nm) OR (t.kind = 'provider' AND r.npi <> '' AND t.npi = r.npi)),
    met AS (
      SELECT CASE WHEN n.kind = 'provider' AND r.npi <> '' AND n.npi = r.npi THEN 1 WHEN n.kind = 'record' AND NOT r.board AND n.st = r.st AND p.site LIKE '%' || r.dom || '%' THEN 2
                  WHEN n.kind = 'record' AND NOT r.board AND r.city <> '' AND r.phone <> '' AND n.city = lower(r.city) AND n.phone = r.phone THEN 3
                  WHEN n.name = r.nm AND n.st = r.st THEN CASE n.kind WHEN 'provider' THEN 4 ELSE 5 END END AS rank,
             n.born, CASE n.kind WHEN 'provider' THEN n.id ELSE n.provider END AS provider
      FROM near n CROSS JOIN r LEFT JOIN recurring.walk p ON p.kind = 'practice' AND p.id = n.practice),
    best AS (SELECT provider, ['npi', 'domain_state', 'city_phone', 'name_state', 'name_state'][rank] AS how FROM met WHERE rank IS NOT NULL ORDER BY rank, born LIMIT 1),
    d AS (
      SELECT r.*, nm <> '' AND NOT board AS makes, coalesce(b.provider, CASE WHEN nm <> '' AND NOT board THEN own_id ELSE '' END) AS provider,
             coalesce(b.how, CASE WHEN nm <> '' AND NOT board THEN 'new' ELSE 'none' END) AS how
      FROM r LEFT JOIN best b ON board OR nm <> ''),
    e AS (SELECT *, {_pk('rec', 'provider', 'practice_id', 'location_id', 'state')} AS record_id FROM d),
    w AS (
      SELECT unnest(CASE WHEN makes THEN [{{'k': 'provider', 'id': provider}}, {{'k': 'record', 'id': record_id}}] WHEN provider <> '' THEN [{{'k': 'provider', 'id': provider}}] ELSE [] END) AS u, * FROM e)
    SELECT 'cursor', '', i, 0, '', '', '', '', '', '', '', '', '' FROM e
    UNION ALL SELECT 'row', extracted_id, i, i, '', '', '', '', '', '', '', provider, how FROM e
    UNION ALL SELECT 'practice', practice_id, i, i, '', '', '', '', '', lower(source_url), '', '', '' FROM e WHERE makes
    UNION ALL
    SELECT u.k, u.id, w.i, coalesce(t.born, w.i), CASE WHEN nm <> '' THEN nm ELSE coalesce(t.name, '') END, CASE WHEN w.npi <> '' THEN w.npi ELSE coalesce(t.npi, '') END,
      CASE WHEN w.st <> '' THEN w.st ELSE coalesce(t.st, '') END, lower(w.city), w.phone, '', practice_id, w.provider, '' FROM w LEFT JOIN recurring.walk t ON t.kind = u.k AND t.id = u.id)),
assigned AS (SELECT x.*, walk.provider AS provider_id, walk.how AS matched_by FROM x JOIN walk ON walk.kind = 'row' AND walk.id = x.extracted_id)"""


@registered(f"{_ASSIGNED} SELECT extracted_id, provider_id, matched_by FROM assigned")
def assign_providers(spark, sf_dir):
    return resolve.assign_providers(extracted(spark, sf_dir)).select("extracted_id", "provider_id", "matched_by")


def _fold(name: str, *unknown: str) -> str:
    known = f"FILTER ({name} NOT IN ({', '.join(repr(u) for u in unknown)}))"
    return f"coalesce(arg_max({name}, o) {known}, arg_min({name}, o)) AS {name}"


_OWN = f"""{_ASSIGNED},
own0 AS (SELECT * FROM assigned WHERE NOT board AND nm <> ''),
own1 AS (SELECT *, {_pk('loc', 'practice_id', 'city', 'state', "coalesce(nullif(phone, ''), dom)")} AS location_id FROM own0),
own AS (SELECT *, {_pk('rec', 'provider_id', 'practice_id', 'location_id', 'state')} AS record_id FROM own1),
born AS (SELECT record_id, any_value(provider_id) AS provider_id, min(o) AS b, arg_min(state, o) AS st0 FROM own GROUP BY 1),
touched AS (
  SELECT born.record_id, a.o, a.npi, a.state AS license_state, CASE WHEN a.license_type = 'unknown' THEN '' ELSE a.license_type END AS license_type, a.license_status, a.source_url, a.extracted_id, a.source_tier,
         a.diagnoses_asd, a.created_at
  FROM assigned a JOIN born ON a.provider_id = born.provider_id WHERE a.board AND a.provider_id <> '' AND a.o > born.b AND lower(a.state) = lower(born.st0)),
happened AS (
  SELECT record_id, o, npi, license_state, license_type, license_status, source_url, extracted_id, source_tier, diagnoses_asd, created_at FROM own
  UNION ALL SELECT record_id, o, npi, license_state, license_type, license_status, source_url, extracted_id, source_tier, diagnoses_asd, created_at FROM touched)"""


@registered(f"""{_OWN}
SELECT h.*, s.provider_name_snapshot, s.diagnoses_asd, s.diagnoses_adhd, s.telehealth, s.provider_id, s.practice_id, s.location_id, u.source_urls FROM (
  SELECT record_id, {_fold('npi', '')}, {_fold('license_type', '')}, {_fold('license_status', 'unknown')}, min(created_at) AS created_at, max(created_at) AS updated_at FROM happened GROUP BY 1) h
JOIN (SELECT record_id, arg_max(provider_name, o) AS provider_name_snapshot, {_fold('diagnoses_asd', 'unclear')}, {_fold('diagnoses_adhd', 'unclear')}, {_fold('telehealth', 'unknown')},
  any_value(provider_id) AS provider_id, any_value(practice_id) AS practice_id, any_value(location_id) AS location_id FROM own GROUP BY 1) s USING (record_id)
JOIN (SELECT record_id, string_agg(source_url, ' ' ORDER BY f) AS source_urls FROM (SELECT record_id, source_url, min(o) AS f FROM happened GROUP BY 1, 2) GROUP BY 1) u USING (record_id)""")
def resolve_records(spark, sf_dir):
    found = resolve.resolve_rows(extracted(spark, sf_dir), wanted=("provider_practice_records",))["provider_practice_records"]
    return found.select(
        "record_id", "npi", "license_type", "license_status", "created_at", "updated_at", "provider_name_snapshot", "diagnoses_asd", "diagnoses_adhd", "telehealth", "provider_id", "practice_id", "location_id",
        F.array_join("source_urls", " ").alias("source_urls"),
    )


@registered(f"""{_OWN},
writes AS (
  SELECT provider_id, o, created_at, provider_name, credentials, npi, state AS primary_license_state, license_type AS primary_license_type FROM own
  UNION ALL SELECT provider_id, o, created_at, provider_name, credentials, npi, state, CASE WHEN license_type = 'unknown' THEN '' ELSE license_type END FROM assigned WHERE board AND provider_id <> '')
SELECT provider_id, {_fold('provider_name', '')}, {_fold('credentials', '')}, {_fold('npi', '')}, {_fold('primary_license_state', '')}, {_fold('primary_license_type', '')},
  min(created_at) AS created_at, max(created_at) AS updated_at FROM writes GROUP BY 1""")
def resolve_providers(spark, sf_dir):
    return resolve.resolve_rows(extracted(spark, sf_dir), wanted=("providers",))["providers"]


@registered(f"""{_OWN}
SELECT 'practice' AS kind, practice_id AS id, arg_max(practice_name, o) || ' ' || arg_max(source_url, o) || ' ' || coalesce(arg_max(intake_url, o) FILTER (intake_url <> ''), '') AS facts FROM own GROUP BY practice_id
UNION ALL SELECT 'location', location_id, coalesce(arg_max(city, o) FILTER (city <> ''), '') || ' ' || arg_max(state, o) || ' ' || coalesce(arg_max(telehealth, o) FILTER (telehealth <> 'unknown'), 'unknown') FROM own GROUP BY location_id""")
def resolve_practices_and_locations(spark, sf_dir):
    t = resolve.resolve_rows(extracted(spark, sf_dir), wanted=("practices", "practice_locations"))
    practices = t["practices"].select(F.lit("practice").alias("kind"), c("practice_id").alias("id"), F.concat_ws(" ", "practice_name", "website", "intake_url").alias("facts"))
    return practices.unionByName(t["practice_locations"].select(F.lit("location").alias("kind"), c("location_id").alias("id"), F.concat_ws(" ", "city", "state", "telehealth").alias("facts")))


@registered(f"""{_OWN},
held AS (
  SELECT *, {_pk('lic', 'provider_id', 'state', 'license_type', "coalesce(nullif(npi, ''), provider_name)")} AS license_id FROM assigned WHERE provider_id <> '' AND (board OR nm <> ''))
SELECT license_id, any_value(provider_id) AS provider_id, any_value(license_type) AS license_type, any_value(npi) AS license_number, {_fold('license_status', 'unknown')}, arg_max(source_url, o) AS source_url FROM held GROUP BY 1""")
def resolve_licenses(spark, sf_dir):
    found = resolve.resolve_rows(extracted(spark, sf_dir), wanted=("licenses",))["licenses"]
    return found.select("license_id", "provider_id", "license_type", "license_number", "license_status", "source_url")


@registered(f"""{_OWN},
items AS (
  SELECT record_id, 'diagnoses_asd' AS field_name, diagnoses_asd AS field_value, source_url, source_tier, created_at, o FROM happened
  UNION ALL SELECT record_id, 'license_status', license_status, source_url, source_tier, created_at, o FROM happened WHERE license_status <> 'unknown')
SELECT {_pk('evi', 'record_id', 'field_name', 'field_value', 'source_url')} AS evidence_id, record_id, field_name, field_value, field_name || ': ' || field_value AS quote, arg_max(source_tier, o) AS source_tier,
  max(created_at) AS captured_at FROM items GROUP BY record_id, field_name, field_value, source_url""")
def resolve_evidence(spark, sf_dir):
    found = resolve.resolve_rows(extracted(spark, sf_dir), wanted=("field_evidence",))["field_evidence"]
    return found.select("evidence_id", "record_id", "field_name", "field_value", "quote", "source_tier", "captured_at")


@registered(f"""{_OWN},
waiting AS (
  SELECT {_pk('rev', 'practice_name', 'dom', "'missing_provider'")} AS review_id, 'missing_provider' AS review_type, '' AS provider_name, source_url, o FROM assigned
  WHERE NOT board AND nm = '' AND (diagnoses_asd = 'yes' OR diagnoses_adhd = 'yes')
  UNION ALL SELECT {_pk('rev', 'provider_name', 'state', 'source_url', "'unmatched_license'")}, 'unmatched_license', provider_name, source_url, o FROM assigned
  WHERE board AND provider_id = '' AND nm <> '' AND license_status <> 'unknown'
  UNION ALL SELECT {_pk('rev', 'provider_id', 'state', 'source_url', "'board_orphan'")}, 'unmatched_license', provider_name, source_url, o FROM assigned
  WHERE board AND provider_id <> '' AND extracted_id NOT IN (SELECT extracted_id FROM touched))
SELECT review_id, any_value(review_type) AS review_type, arg_max(provider_name, o) AS provider_name, arg_max(source_url, o) AS source_url FROM waiting GROUP BY 1""")
def resolve_reviews(spark, sf_dir):
    return resolve.resolve_rows(extracted(spark, sf_dir), wanted=("review_queue",))["review_queue"].select("review_id", "review_type", "provider_name", "source_url")


@registered("""
WITH RECURSIVE n AS (SELECT s_suppkey AS id, 'n' || CAST(s_nationkey * 40 + s_suppkey % 40 AS VARCHAR) AS x, 'b' || CAST(floor(abs(s_acctbal) / 2) AS BIGINT) AS y FROM supplier),
e AS (SELECT DISTINCT a.id AS u, b.id AS v FROM n a JOIN n b ON a.x = b.x OR a.y = b.y),
r AS (SELECT id, id AS far FROM n UNION SELECT r.id, e.v FROM r JOIN e ON r.far = e.u)
SELECT id, min(far) AS component FROM r GROUP BY 1""")
def resolve_components(spark, sf_dir):
    keyed = read(spark, sf_dir, "supplier").select(
        c("s_suppkey").alias("id"), F.concat(F.lit("n"), (c("s_nationkey") * 40 + c("s_suppkey") % 40).cast("string")).alias("x"), F.concat(F.lit("b"), F.floor(F.abs("s_acctbal") / 2).cast("string")).alias("y")
    )
    return resolve.components(keyed, "id", ["x", "y"]).select("id", "component")


# ---------------------------------------------------------------- extraction over pages of known content

_SHAPES = 8
_PAGE = [  # page, source type; {name}, {other} and {k} are filled in
    ("<title>Hill Psychology Center</title><main><p>We have cared for families of this county for many years, on every weekday. {name}, PsyD leads the team. Autism diagnostic evaluations for children.</p></main><p>Call (201) 555-0{k3}. Edison, NJ</p>", "practice_site"),
    ("<p>Request unsuccessful. Incapsula incident ID: {k}</p>", "licensing_board"),
    ("<p>Licensee Name: {name} Profession: Psychologist License Status: Active State: NJ</p>", "licensing_board"),
    ("<title>Autism Evaluation Services</title><p>Our program offers autism evaluations in Edison, NJ.</p>", "hospital_directory"),
    ("<title>News</title><p>{name}, PhD wrote an article on autism assessment.</p>", "practice_site"),
    ("<title>Clinic Staff</title><p>ADHD evaluations. Medical Director: {name}, MD. Clinical Director: {other}, PhD. NPI: 1{k9}</p>", "practice_site"),
    ("<title>Autism faculty</title><p>Our team: Dr. {name}. Adults are seen.</p>", "university_directory"),
    ("<title>FAQ</title><p>What can I expect? {name}, PhD. Autism. Telehealth is offered.</p>", "practice_site"),
]


def landed_pages(spark, sf_dir) -> DataFrame:
    """One page for each customer, of eight shapes."""
    rows = read(spark, sf_dir, "customer").select(F.expr(_K).alias("k"), F.expr(_NAME.replace("STRING", "STRING")).alias("name"))
    rows = rows.withColumn("other", F.concat(F.element_at(F.array(*map(F.lit, LAST)), (c("k") % 17 + 1).cast("int")), F.lit(" Stone")))
    shape = c("k") % _SHAPES
    html, kind = F.lit(None).cast("string"), F.lit(None).cast("string")
    for i, (body, source_type) in enumerate(_PAGE):
        text = F.lit(body)
        for slot, value in (("{name}", c("name")), ("{other}", c("other")), ("{k3}", F.lpad((c("k") % 1000).cast("string"), 3, "0")), ("{k9}", F.lpad(c("k").cast("string"), 9, "0")), ("{k}", c("k").cast("string"))):
            text = F.replace(text, F.lit(slot), value)
        html, kind = F.when(shape == i, text).otherwise(html), F.when(shape == i, F.lit(source_type)).otherwise(kind)
    return rows.select(
        F.concat(F.lit("https://h"), c("k").cast("string"), F.lit(".org/autism")).alias("url"), html.alias("html"), F.lit(200).alias("status_code"), kind.alias("source_type"), F.lit("Seed").alias("seed_name"), F.lit("B").alias("tier")
    )


@registered(f"""
WITH p AS (SELECT {_K} AS k, {_NAME.replace('STRING', 'VARCHAR')} AS name, ({_pick(LAST, f'{_K} % 17')}) || ' Stone' AS other, 'https://h' || CAST({_K} AS VARCHAR) || '.org/autism' AS source_url FROM customer),
r AS (
  SELECT source_url, name AS provider_name, 'PsyD' AS credentials, '' AS npi, 'Hill Psychology Center' AS practice_name, 'Edison' AS city, '(201) 555-0' || lpad(CAST(k % 1000 AS VARCHAR), 3, '0') AS phone, 'psychologist' AS license_type,
         'unknown' AS license_status, 'yes' AS diagnoses_asd, 'unclear' AS diagnoses_adhd, 'child,adolescent' AS age_groups, 'unknown' AS telehealth, 'provider_name,credentials,diagnoses_asd' AS shown FROM p WHERE k % 8 = 0
  UNION ALL SELECT source_url, name, '', '', 'Seed', '', '', 'psychologist', 'active', 'unclear', 'unclear', 'unknown', 'unknown', 'provider_name,license_status' FROM p WHERE k % 8 = 2
  UNION ALL SELECT source_url, '', '', '', 'Autism Evaluation Services', 'Edison', '', 'unknown', 'unknown', 'yes', 'unclear', 'unknown', 'unknown', 'diagnoses_asd' FROM p WHERE k % 8 = 3
  UNION ALL SELECT source_url, name, 'MD', '1' || lpad(CAST(k AS VARCHAR), 9, '0'), 'Clinic Staff', '', '1' || lpad(CAST(k AS VARCHAR), 9, '0'), 'physician', 'unknown', 'unclear', 'yes', 'unknown', 'unknown', 'provider_name,credentials,diagnoses_adhd,npi' FROM p WHERE k % 8 = 5
  UNION ALL SELECT source_url, other, 'PhD', '1' || lpad(CAST(k AS VARCHAR), 9, '0'), 'Clinic Staff', '', '1' || lpad(CAST(k AS VARCHAR), 9, '0'), 'psychologist', 'unknown', 'unclear', 'yes', 'unknown', 'unknown', 'provider_name,credentials,diagnoses_adhd,npi' FROM p WHERE k % 8 = 5
  UNION ALL SELECT source_url, name || '. Adults', '', '', 'Seed', '', '', 'unknown', 'unknown', 'unclear', 'unclear', 'adult', 'unknown', 'provider_name,diagnoses_asd' FROM p WHERE k % 8 = 6
  UNION ALL SELECT source_url, '', '', '', 'Seed', '', '', 'unknown', 'unknown', 'unclear', 'unclear', 'unknown', 'yes', 'diagnoses_asd' FROM p WHERE k % 8 = 7)
SELECT * FROM r""")
def extract_records(spark, sf_dir):
    # customers are few bytes a row, so their files are read by few tasks; pages are work, so they are dealt to all
    pages = landed_pages(spark, sf_dir).repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = extract.extract_records(cut(pages))
    return rows.select(
        "source_url", "provider_name", "credentials", "npi", "practice_name", "city", "phone", "license_type", "license_status", "diagnoses_asd", "diagnoses_adhd", F.array_join("age_groups", ",").alias("age_groups"),
        "telehealth", F.array_join(F.transform("evidence", lambda e: e["field"]), ",").alias("shown"),
    )


# ---------------------------------------------------------------- score and decision over orders and line items

_CREDENTIAL = _pick(("MD", "PsyD", "NP", "LCSW"), "o_orderkey % 4")
_CLASS = _pick(("MD/DO", "PsyD/PhD", "APN/NP", "LCSW"), "o_orderkey % 4")
_STATE = _pick(("NJ", "NY", "PA"), "o_custkey % 3")
RECORD = {
    "record_id": "o_orderkey", "credentials": _CREDENTIAL, "license_type": "''", "license_state": _STATE, "diagnoses_asd": _pick(("yes", "unclear", "yes"), "o_orderkey % 3"),
    "diagnoses_adhd": _pick(("yes", "unclear"), "o_custkey % 2"), "license_status": _pick(("active", "active", "unknown", "inactive"), "CAST(floor(o_orderkey / 4) AS BIGINT) % 4"),
    "telehealth": _pick(("yes", "unknown"), "CAST(floor(o_orderkey / 8) AS BIGINT) % 2"), "phone": "CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE '2015550100' END", "website": "''", "intake_url": "''",
    "provider_name_snapshot": "CASE WHEN o_orderkey % 13 = 0 THEN 'about sleep' ELSE 'Jane Doe' END", "practice_name_snapshot": "CASE WHEN o_orderkey % 17 = 0 THEN 'Find a therapist' ELSE 'Hill' END",
    "updated_at": "CAST(o_orderkey AS BIGINT)",
}
_FIELD = _pick(score.CRITICAL_FIELDS[:3], "l_linenumber % 3")
SHOWN = {
    "evidence_id": "CAST(l_linenumber AS STRING) || '-' || CAST(l_partkey AS STRING) || '-' || CAST(l_suppkey AS STRING) || '-' || CAST(CAST(round(l_extendedprice * 100) AS BIGINT) AS STRING)", "record_id": "l_orderkey", "field_name": _FIELD,
    "field_value": "CASE WHEN l_linenumber % 3 = 2 THEN CASE WHEN l_quantity > 40 THEN 'inactive' ELSE 'active' END WHEN l_quantity > 45 THEN 'unclear' ELSE 'yes' END",
    "quote": "CASE WHEN l_quantity < 5 THEN '' ELSE 'Quote ' || CAST(l_linenumber AS STRING) END", "source_tier": _pick(("A", "B", "C", "X"), "CAST(floor(l_quantity) AS BIGINT) % 4"),
    "source_url": "CASE WHEN CAST(floor(l_quantity) AS BIGINT) % 7 = 0 THEN '' ELSE 'https://s' || CAST(l_linenumber AS STRING) || '.org/' || (CASE WHEN l_linenumber = 4 THEN 'blog/' ELSE '' END) || CAST(l_orderkey % 50 AS STRING) END",
    "captured_at": "CAST(l_linenumber AS BIGINT)",
}
_RULES = [  # id, state, credential, authority, rationale, title, citation, active
    ("r1", "NJ", "MD/DO", "yes", "Physicians prescribe.", "T", "https://law/1", 1), ("r2", "NJ", "PsyD/PhD", "no", "Psychologists do not.", "T", "https://law/2", 1),
    ("r3", "NY", "APN/NP", "limited", "", "Title only", "https://law/3", 1), ("r4", "NY", "MD/DO", "yes", "Without source.", "T", "", 1), ("r0", "NJ", "MD/DO", "no", "Not in force.", "T", "https://law/0", 0),
    ("r5", "NJ", "MD/DO", "limited", "A later rule.", "T", "https://law/5", 1), ("r6", "PA", "PsyD/PhD", "no", "Psychologists do not.", "T", "https://law/6", 1), ("r7", "NJ", "APN/NP", "limited", "With a physician.", "T", "https://law/7", 1),
]
_RULE_SCHEMA = "rule_id string, state string, credential string, authority string, rationale string, citation_title string, citation_url string, active int"


def _records_and_evidence(spark, sf_dir) -> tuple[DataFrame, DataFrame, DataFrame]:
    records = read(spark, sf_dir, "orders").select(*(F.expr(sql).alias(n) for n, sql in RECORD.items())).withColumn("age_groups", F.when(c("record_id") % 2 == 0, F.array(F.lit("child"))).otherwise(F.array(F.lit("adult"))))
    evidence = read(spark, sf_dir, "lineitem").select(*(F.expr(sql).alias(n) for n, sql in SHOWN.items()))
    return records, evidence.withColumn("evidence_id", c("evidence_id").cast("string")), spark.createDataFrame(_RULES, _RULE_SCHEMA)


def _cols(columns: dict[str, str]) -> str:
    return ", ".join(f"{sql} AS {n}" for n, sql in columns.items()).replace("AS STRING", "AS VARCHAR")


_WEIGHT = "CASE source_tier WHEN 'A' THEN 920 WHEN 'B' THEN 780 WHEN 'C' THEN 550 ELSE 400 END"


def _cap(w: str, value: str) -> str:
    return f"CASE WHEN {value} IN ('unknown', 'unclear') THEN least({w}, 450) WHEN {value} = 'limited' THEN least({w}, 680) ELSE {w} END"


_RULE_VALUES = ", ".join("(" + ", ".join(repr(v) if isinstance(v, str) else str(v) for v in row) + ")" for row in _RULES)
_SCORED = f"""
WITH rec AS (SELECT {_cols(RECORD)}, {_CLASS} AS class, o_orderkey % 2 = 0 AS young FROM orders),
ev0 AS (SELECT {_cols(SHOWN)} FROM lineitem),
rules AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY s, cr ORDER BY id) AS n FROM (VALUES {_RULE_VALUES}) t(id, s, cr, au, ra, ti, ci, ac) WHERE ac = 1) WHERE n = 1),
ruled AS (SELECT rec.*, coalesce(au, 'unknown') AS authority, coalesce(ra, '') AS basis, coalesce(ci, '') AS citation, coalesce(nullif(ra, ''), ti, '') AS rule_quote, id IS NOT NULL AS has_rule FROM rec LEFT JOIN rules ON license_state = s AND class = cr),
ev AS (
  SELECT CAST(evidence_id AS VARCHAR) AS evidence_id, record_id, field_name, field_value, quote, source_tier, source_url, captured_at FROM ev0
  UNION ALL SELECT 'evi_' || substr(sha1(lower(CAST(record_id AS VARCHAR) || '|prescriptive_authority|' || authority || '|' || citation)), 1, 16), record_id, 'prescriptive_authority', authority, rule_quote, 'A', citation, updated_at FROM ruled WHERE has_rule),
w AS (SELECT record_id, {', '.join(f"coalesce(max({_WEIGHT}) FILTER (field_name = '{f}' AND source_url <> ''), 0) AS w_{f}" for f in score.CRITICAL_FIELDS)} FROM ev GROUP BY 1),
conf AS (SELECT ruled.*, {', '.join(_cap(f"coalesce(w_{f}, 0)", f if f != "prescriptive_authority" else "authority") + f" AS conf_{f}" for f in score.CRITICAL_FIELDS)} FROM ruled LEFT JOIN w USING (record_id)),
fit AS (SELECT *, CAST(floor((conf_diagnoses_asd + conf_diagnoses_adhd + conf_license_status + conf_prescriptive_authority + 2) / 4) AS BIGINT) AS confidence,
  diagnoses_asd = 'yes' AS f1, diagnoses_adhd = 'yes' AS f2, license_status = 'active' AS f3, phone <> '' AS f4, telehealth = 'yes' AS f5, young AS f6, authority IN ('yes', 'limited') AS f7,
  conf_diagnoses_asd >= 780 OR conf_diagnoses_adhd >= 780 AS f8, conf_license_status >= 900 AS f9 FROM conf),
scored AS (SELECT *, CAST(least(1000, 300 * f1::INT + 200 * f2::INT + 200 * f3::INT + 100 * f4::INT + 50 * f5::INT + 50 * f6::INT + 50 * f7::INT + 30 * f8::INT + 20 * f9::INT) AS BIGINT) AS fit,
  concat_ws(',', {', '.join(f"CASE WHEN f{i + 1} THEN '{n}' END" for i, n in enumerate(score.FIT_WEIGHTS))}) AS reasons FROM fit)"""


@registered(f"{_SCORED} SELECT record_id, authority AS prescriptive_authority, basis AS prescriptive_basis, confidence, fit, reasons FROM scored")
def score_records(spark, sf_dir):
    scored, _ = score.score(*_records_and_evidence(spark, sf_dir))
    milli = lambda n: F.round(c(n) * 1000).cast("long")
    return scored.select("record_id", "prescriptive_authority", "prescriptive_basis", milli("record_confidence").alias("confidence"), milli("outreach_fit_score").alias("fit"), F.array_join("outreach_reasons", ",").alias("reasons"))


_DECIDED = f"""{_SCORED},
told AS (SELECT record_id, arg_max(source_url, (captured_at, evidence_id)) AS url, arg_max(quote, (captured_at, evidence_id)) AS quote,
  {', '.join(f"bool_or(field_name = '{f}' AND source_url <> '' AND quote <> '') AS s{i}" for i, f in enumerate(score.CRITICAL_FIELDS))},
  {', '.join(f"count(DISTINCT field_value) FILTER (field_name = '{f}' AND field_value <> '') > 1 AS x{i}" for i, f in enumerate(score.CRITICAL_FIELDS))} FROM ev GROUP BY 1),
j AS (SELECT scored.*, coalesce(url, '') AS url, coalesce(told.quote, '') AS quote, {', '.join(f"coalesce(s{i}, false) AS s{i}, coalesce(x{i}, false) AS x{i}" for i in range(4))} FROM scored LEFT JOIN told USING (record_id)),
f AS (SELECT *, s0::INT + s1::INT + s2::INT + s3::INT AS critical, CASE WHEN x0 OR x1 OR x2 OR x3 THEN greatest(0, confidence - 150) ELSE confidence END AS final,
  concat_ws(',', {', '.join(f"CASE WHEN NOT s{i} THEN '{f}' END" for i, f in enumerate(score.CRITICAL_FIELDS))}) AS missing,
  concat_ws('; ', {', '.join(f"CASE WHEN x{i} THEN '{f} conflict' END" for i, f in enumerate(score.CRITICAL_FIELDS))}) AS conflicts, provider_name_snapshot = 'Jane Doe' AS person FROM j),
lanes AS (SELECT *, CASE WHEN practice_name_snapshot = 'Find a therapist' AND NOT person THEN 'directory_sludge'
  WHEN NOT person AND regexp_matches(lower(practice_name_snapshot || ' ' || url || ' ' || quote), '{'|'.join(sorted(set(('evaluation', 'assessment', 'diagnos', 'autism', 'adhd', 'clinic', 'center'))))}') THEN 'practice_only_signal'
  WHEN person AND contains(url, '/blog/') AND critical <= 1 AND final < 700 THEN 'indirect_provider_signal'
  WHEN phone = '' AND critical = 0 AND final < 550 AND missing <> '' THEN 'weak_provider_signal' END AS lane,
  concat_ws('; ', CASE WHEN final < 600 THEN 'low_confidence' END, CASE WHEN authority IN ('limited', 'unknown') THEN 'prescriptive_review' END, CASE WHEN missing <> '' THEN 'missing_critical:' || missing END, nullif(conflicts, '')) AS why FROM f),
decided AS (SELECT *, coalesce(lane, CASE WHEN why <> '' THEN 'record_review' END) AS review_type,
  CASE WHEN lane IS NULL AND why = '' AND final >= 700 AND fit >= 700 AND license_status = 'active' AND (diagnoses_asd = 'yes' OR diagnoses_adhd = 'yes') AND phone <> '' THEN 1 ELSE 0 END AS ready FROM lanes)"""


def _decided(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    scored, evidence = score.score(*_records_and_evidence(spark, sf_dir))
    decided = review.decide(scored, evidence)
    # domains and counts of evidence are asked for by none of these queries
    return cut(decided.drop("domains", "evidence_count")), evidence


@registered(f"""{_DECIDED} SELECT record_id, lane, review_type, CAST(final AS BIGINT) AS final, conflicts AS conflict_note, CASE WHEN lane IS NULL THEN why END AS reasons, missing, ready,
  CASE WHEN review_type IS NULL THEN 'approved' ELSE 'blocked' END AS export_status FROM decided""")
def decide_records(spark, sf_dir):
    decided, _ = _decided(spark, sf_dir)
    return decided.select(
        "record_id", "lane", "review_type", F.round(c("final_confidence") * 1000).cast("long").alias("final"), "conflict_note", F.when(c("lane").isNull(), c("blocked_reason")).alias("reasons"),
        F.array_join("missing_critical", ",").alias("missing"), c("outreach_ready").alias("ready"), "export_status",
    )


@registered(f"""{_DECIDED} SELECT count(*) FILTER (review_type IS NULL) AS approved_records, count(*) FILTER (review_type IS NOT NULL) AS queued_records,
  CAST(sum(x0::INT + x1::INT + x2::INT + x3::INT) AS BIGINT) AS contradictions, CAST(sum(ready) AS BIGINT) AS outreach_ready_records,
  {', '.join(f"count(*) FILTER (lane = '{n}') AS triage_{n}" for n in review.LANE_REASONS)},
  CAST((SELECT count(*) FROM (SELECT url FROM decided WHERE lane IS NOT NULL GROUP BY 1 HAVING count(*) >= 5 AND count(*) = count(*) FILTER (lane = 'directory_sludge'))) AS BIGINT) AS seed_retire_candidates FROM decided""")
def qa_stats(spark, sf_dir):
    return review.stats(_decided(spark, sf_dir)[0])


@registered(f"""{_DECIDED}, q AS (SELECT 'r' || CAST(record_id AS VARCHAR) AS item, review_type, url FROM decided WHERE review_type IS NOT NULL
  UNION ALL SELECT 's' || url, 'seed_retire_candidate', url FROM decided WHERE lane IS NOT NULL GROUP BY url HAVING count(*) >= 5 AND count(*) = count(*) FILTER (lane = 'directory_sludge'))
SELECT item, review_type, url AS source_url FROM q""")
def review_queue_items(spark, sf_dir):
    found = review.queue(_decided(spark, sf_dir)[0], c("updated_at"))
    item = F.when(c("review_type") == "seed_retire_candidate", F.concat(F.lit("s"), c("source_url"))).otherwise(F.concat(F.lit("r"), c("record_id").cast("string")))
    return found.select(item.alias("item"), "review_type", "source_url")


@registered(f"{_DECIDED} SELECT url AS source_url, count(*) AS queued, {', '.join(f'count(*) FILTER (lane = {n!r}) AS {n}' for n in review.LANE_REASONS)} FROM decided WHERE lane IS NOT NULL GROUP BY 1")
def source_triage_rollup(spark, sf_dir):
    return review.source_rollup(_decided(spark, sf_dir)[0])


# ---------------------------------------------------------------- bundles, accounts, scans

_TABLES_SQL = """
WITH rec AS (SELECT o_orderkey AS record_id, o_custkey AS practice, o_orderkey % 3 = 0 AS asd, o_totalprice FROM orders WHERE o_orderstatus = 'F')"""


def _tables(spark, sf_dir) -> dict[str, DataFrame]:
    """Approved records of finished orders with their evidence, as the tables an export reads."""
    orders = read(spark, sf_dir, "orders").where("o_orderstatus = 'F'")
    key, cust = c("o_orderkey").cast("string"), c("o_custkey").cast("string")
    decided = orders.select(
        key.alias("record_id"), F.concat(F.lit("prov"), key).alias("provider_id"), F.concat(F.lit("prac"), cust).alias("practice_id"), F.concat(F.lit("loc"), key).alias("location_id"),
        F.concat(F.expr(_pick(FIRST, "o_orderkey % 13")), F.lit(" "), F.expr(_pick(LAST, "o_custkey % 17"))).alias("provider_name"), F.expr(_pick(("PsyD", "MD", "NP", ""), "o_orderkey % 4")).alias("credentials"), F.lit("").alias("npi"),
        F.lit("NJ").alias("license_state"), F.lit("psychologist").alias("license_type"), F.lit("active").alias("license_status"), F.concat(F.lit("Clinic "), cust).alias("practice_name_snapshot"),
        F.expr(_pick(("Newark", "Edison", "Union"), "o_orderkey % 3")).alias("city"), F.lit("NJ").alias("location_state"), F.lit("North").alias("metro"), F.concat(F.lit("201555"), F.lpad((c("o_orderkey") % 2).cast("string"), 4, "0")).alias("phone"),
        F.concat(F.lit("https://c"), cust, F.lit(".org")).alias("website"), F.lit("").alias("intake_url"), F.expr(_pick(("yes", "unclear"), "o_orderkey % 2")).alias("diagnoses_asd"), F.lit("unclear").alias("diagnoses_adhd"),
        F.lit("no").alias("prescriptive_authority"), F.lit("").alias("prescriptive_basis"), F.array(F.lit("child")).alias("age_groups"), F.lit("unknown").alias("telehealth"), F.lit("").alias("insurance_notes"), F.lit("").alias("waitlist_notes"),
        F.lit("").alias("referral_requirements"), F.array(F.concat(F.lit("https://c"), cust, F.lit(".org/"), (c("o_orderkey") % 3).cast("string"))).alias("source_urls"), *(F.lit(0.9).alias(f"conf_{f}") for f in score.CRITICAL_FIELDS),
        F.round(c("o_orderkey") % 100 / 100.0, 2).alias("record_confidence"), F.round(c("o_orderkey") % 50 / 50.0, 2).alias("outreach_fit_score"), (c("o_orderkey") % 2).cast("int").alias("outreach_ready"), F.array().cast("array<string>").alias("outreach_reasons"),
        F.lit(0).cast("long").alias("last_verified_at"), F.lit("ready").alias("review_status"), F.lit("approved").alias("export_status"), F.lit("").alias("blocked_reason"), F.lit("").alias("conflict_note"),
    )
    lines = read(spark, sf_dir, "lineitem")
    evidence = lines.select(
        c("l_orderkey").cast("string").alias("record_id"), F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("evidence_id"), F.expr(_pick(score.CRITICAL_FIELDS, "l_linenumber % 4")).alias("field_name"), F.lit("yes").alias("field_value"),
        F.concat(F.lit("The quote number "), c("l_linenumber").cast("string"), F.lit(" of this order.")).alias("quote"), F.concat(F.lit("https://e"), (c("l_linenumber") % 3).cast("string"), F.lit(".org")).alias("source_url"), F.lit("A").alias("source_tier"), F.lit(0).cast("long").alias("captured_at"),
    )
    contradictions = lines.where("l_linenumber = 7").select(
        c("l_orderkey").cast("string").alias("record_id"), F.lit("diagnoses_asd").alias("field_name"), c("l_orderkey").cast("string").alias("contradiction_id"), *(F.lit("x").alias(n) for n in ("preferred_value", "conflicting_value", "preferred_source_url", "conflicting_source_url", "note"))
    )
    return {"decided": decided, "field_evidence": evidence, "contradictions": contradictions}


@registered("""
SELECT CAST(o_orderkey AS VARCHAR) AS record_id, coalesce(n, 0) AS n_evidence, coalesce(fields, '') AS fields, coalesce(x, 0) AS n_contradictions FROM orders
LEFT JOIN (SELECT l_orderkey, count(*) AS n, string_agg(['diagnoses_asd', 'diagnoses_adhd', 'license_status', 'prescriptive_authority'][l_linenumber % 4 + 1], ',' ORDER BY ['diagnoses_asd', 'diagnoses_adhd', 'license_status', 'prescriptive_authority'][l_linenumber % 4 + 1]) AS fields,
  count(*) FILTER (l_linenumber = 7) AS x FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey WHERE o_orderstatus = 'F'""")
def record_bundles(spark, sf_dir):
    t = _tables(spark, sf_dir)
    full = accounts.bundles(accounts.base(t), t["field_evidence"], t["contradictions"])
    return full.select("record_id", F.size("evidence").cast("long").alias("n_evidence"), F.array_join(F.transform("evidence", lambda e: e["field_name"]), ",").alias("fields"), F.size("contradictions").cast("long").alias("n_contradictions"))


@registered(f"""
SELECT CAST(o_orderkey AS VARCHAR) AS record_id, CASE o_orderkey % 4 WHEN 0 THEN 'clinical director or practice owner' WHEN 1 THEN 'medical director or practice owner' WHEN 2 THEN 'clinical lead or practice administrator' ELSE 'practice administrator or intake lead' END AS target_buyer,
  coalesce(u, '') AS source_urls, coalesce(s, '') AS evidence_summary FROM orders
LEFT JOIN (SELECT l_orderkey, array_to_string(list_sort(list_distinct(list('https://e' || CAST(l_linenumber % 3 AS VARCHAR) || '.org'))), ' ') AS u,
  array_to_string(list_slice(list_filter([min(q) FILTER (m = 0), min(q) FILTER (m = 1), min(q) FILTER (m = 2), min(q) FILTER (m = 3)], lambda x: x IS NOT NULL), 1, 3), ' | ') AS s
  FROM (SELECT l_orderkey, l_linenumber, l_linenumber % 4 AS m, 'The quote number ' || CAST(l_linenumber AS VARCHAR) || ' of this order.' AS q FROM lineitem) GROUP BY 1) ON l_orderkey = o_orderkey
WHERE o_orderstatus = 'F' AND o_orderkey % 2 = 1""")
def sales_rows(spark, sf_dir):
    t = _tables(spark, sf_dir)
    found = accounts.sales_rows(accounts.bundles(accounts.base(t), t["field_evidence"], t["contradictions"]))
    return found.select("record_id", "target_buyer", F.array_join("source_urls", " ").alias("source_urls"), "evidence_summary")


_TOWN = "['Newark', 'Edison', 'Union'][o_orderkey % 3 + 1]"
_PERSON = f"(({_pick(FIRST, 'o_orderkey % 13')}) || ' ' || ({_pick(LAST, 'o_custkey % 17')}))"
_PLACE = "(o_orderkey % 50, o_orderkey % 100)"


@registered(f"""
WITH r AS (SELECT *, {_TOWN} AS town, {_PERSON} AS person, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey % 50 DESC, o_orderkey % 100 DESC, CAST(o_orderkey AS VARCHAR)) AS n FROM orders WHERE o_orderstatus = 'F'),
g AS (SELECT o_custkey, count(DISTINCT town) AS location_count, count(DISTINCT person) AS provider_count, count(DISTINCT (town, o_orderkey % 2)) AS sites, bool_or(o_orderkey % 2 = 1) AS ready, bool_or(o_orderkey % 2 = 0) AS asd,
  string_agg(DISTINCT 'https://c' || CAST(o_custkey AS VARCHAR) || '.org/' || CAST(o_orderkey % 3 AS VARCHAR), ' ' ORDER BY 'https://c' || CAST(o_custkey AS VARCHAR) || '.org/' || CAST(o_orderkey % 3 AS VARCHAR)) AS links FROM r GROUP BY 1)
SELECT 'prac' || CAST(o_custkey AS VARCHAR) AS practice_id, town AS city, CASE WHEN ready THEN 'approved_outreach_ready' ELSE 'approved' END AS qa_state, CASE WHEN asd THEN 'Autism evaluations' ELSE 'Developmental and behavioral services' END AS service_focus,
  CAST(location_count AS INT) AS location_count, CAST(provider_count AS INT) AS provider_count,
  CASE WHEN provider_count >= 4 OR sites >= 3 THEN 'Enterprise / multi-site' WHEN provider_count >= 2 OR sites >= 2 THEN 'Regional / growing group' ELSE 'Single-site / owner-led' END AS budget_band,
  CAST((o_orderkey % 50) * 2 AS INT) AS fit_score, CAST(o_orderkey % 100 AS INT) AS confidence_score, links FROM r JOIN g USING (o_custkey) WHERE n = 1""")
def account_dossiers(spark, sf_dir):
    t = _tables(spark, sf_dir)
    rows = accounts.base(t).withColumns({"source_url": F.lit(""), "evidence": F.array().cast("array<struct<field_name:string,field_value:string,quote:string,source_url:string>>")})
    found = accounts.dossiers(rows, "practice_id", None, None)
    return found.select("practice_id", "city", "qa_state", "service_focus", "location_count", "provider_count", "budget_band", "fit_score", "confidence_score", F.array_join(F.array_sort("evidence_links"), " ").alias("links"))


@registered("SELECT source AS source_url, arg_max(sha256(coalesce(text, '')), (n_chars, sha256(coalesce(text, '')))) AS content FROM documents GROUP BY 1")
def latest_documents(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select(c("source").alias("source_url"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("h"), c("n_chars").alias("at"))
    rows = docs.withColumns({"content": c("h"), "fetched_at": F.struct("at", "h")})
    return accounts.latest_documents(rows).select("source_url", "content")


@registered("SELECT o_orderkey AS crawl_job_pk, l_linenumber FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE l_returnflag <> '' AND l_quantity <= 25 AND l_shipdate >= TIMESTAMP '1997-01-01 00:00:00'")
def pages_for_extraction(spark, sf_dir):
    jobs = read(spark, sf_dir, "orders").select(c("o_orderkey").alias("crawl_job_pk"))
    results = read(spark, sf_dir, "lineitem").select(c("l_orderkey").alias("crawl_job_pk"), "l_linenumber", F.when(c("l_quantity") <= 25, 200).otherwise(404).alias("status_code"), c("l_returnflag").alias("content"), c("l_shipdate").alias("fetched_at"))
    return landing.for_extraction(jobs, results, F.lit("1997-01-01 00:00:00").cast("timestamp")).select("crawl_job_pk", "l_linenumber")


@registered("""
WITH s AS (SELECT c_custkey, 'https://c' || CAST(c_custkey % 300 AS VARCHAR) || '.org' AS website, lower(c_mktsegment) AS state, c_name AS name, CAST(c_custkey % 10 AS INT) AS priority FROM customer),
k AS (SELECT *, row_number() OVER (PARTITION BY website, state ORDER BY name) AS n FROM s)
SELECT name, website, state, priority FROM k WHERE n = 1 ORDER BY priority DESC, lower(name) DESC, website DESC LIMIT 50""")
def seed_pack_order(spark, sf_dir):
    rows = read(spark, sf_dir, "customer").select(
        c("c_name").alias("name"), F.concat(F.lit("https://c"), (c("c_custkey") % 300).cast("string"), F.lit(".org")).alias("website"), F.lower("c_mktsegment").alias("state"), (c("c_custkey") % 10).cast("string").alias("priority")
    )
    return seeds.ordered(seeds.dedupe(seeds.coerce(rows)), 50).select("name", "website", "state", "priority")


@registered(f"""
SELECT c_custkey, CASE WHEN {_K} % 11 = 0 THEN 'none' ELSE {_pk('src', f"'https://www.Site' || CAST({_K} AS VARCHAR) || '.org'", f"CAST({_K} AS VARCHAR)")} END AS pk FROM customer""".replace("AS STRING", "AS VARCHAR"))
def source_document_key(spark, sf_dir):
    key = make_pk("src", F.concat(F.lit("https://www.Site"), c("c_custkey").cast("string"), F.lit(".org")), c("c_custkey"))
    return read(spark, sf_dir, "customer").select("c_custkey", F.when(c("c_custkey") % 11 == 0, "none").otherwise(key).alias("pk"))


@registered("""
SELECT o_orderkey AS record_id, c_name AS provider_name, n_name AS website, CASE WHEN s_suppkey % 3 = 0 THEN coalesce(n_name, '') ELSE s_name END AS phone FROM orders JOIN customer ON o_custkey = c_custkey
JOIN nation ON o_orderkey % 30 = n_nationkey JOIN supplier ON o_orderkey % 17 = s_suppkey""")
def score_base_join(spark, sf_dir):
    tables = {
        "provider_practice_records": read(spark, sf_dir, "orders").select(c("o_orderkey").alias("record_id"), c("o_custkey").alias("provider_id"), (c("o_orderkey") % 30).alias("practice_id"), (c("o_orderkey") % 17).alias("location_id")),
        "providers": read(spark, sf_dir, "customer").select(c("c_custkey").alias("provider_id"), c("c_name").alias("provider_name"), F.lit("").alias("credentials")),
        "practices": read(spark, sf_dir, "nation").select(c("n_nationkey").alias("practice_id"), c("n_name").alias("website"), F.lit("").alias("intake_url"), c("n_name").alias("phone")),
        "practice_locations": read(spark, sf_dir, "supplier").select(c("s_suppkey").alias("location_id"), *(F.lit("").alias(n) for n in ("city", "state", "metro")), F.when(c("s_suppkey") % 3 != 0, c("s_name")).alias("phone")),
    }
    return score.score_base(tables).select("record_id", "provider_name", "website", "phone")


# ---------------------------------------------------------------- crawls: jobs, telemetry, seeds of pages, links


def _fetches(spark, sf_dir) -> DataFrame:
    """Every order as a fetch of its customer's site; a run is a year and priority."""
    return read(spark, sf_dir, "orders").select(
        F.concat(F.lit("Seed "), c("o_custkey").cast("string")).alias("seed_name"), F.concat(F.lit("https://www.c"), c("o_custkey").cast("string"), F.lit(".org")).alias("seed_website"), F.year("o_orderdate").cast("string").alias("run_id"),
        F.concat(F.lit("https://c"), c("o_custkey").cast("string"), F.lit(".org/p"), (c("o_orderkey") % 3).cast("string")).alias("requested_url"), F.when(c("o_orderstatus") == "F", 200).otherwise(500).alias("status_code"),
        F.when(c("o_orderstatus") == "F", c("o_orderpriority")).otherwise("").alias("content"), F.lit("").alias("error_message"), (c("o_orderkey") % 4).cast("int").alias("attempts"), c("o_orderkey").alias("fetched_at"),
    )


_JOBS = """
WITH f AS (SELECT 'c' || CAST(o_custkey AS VARCHAR) || '.org' AS seed_domain, year(o_orderdate) AS run, o_orderkey, o_orderstatus = 'F' AND o_orderpriority <> '' AS good, CASE WHEN o_orderstatus = 'F' THEN 200 ELSE 500 END AS code, o_orderkey % 4 AS tries FROM orders),
j AS (SELECT seed_domain, run, CAST(sum(tries) AS BIGINT) AS attempts, count(*) FILTER (good) AS success_pages, count(*) FILTER (NOT good) AS failure_pages, arg_max(code, o_orderkey) AS last_status_code, max(o_orderkey) AS completed_at,
  CASE WHEN count(*) FILTER (good) = 0 THEN 'failed' WHEN count(*) FILTER (NOT good) > 0 THEN 'partial' ELSE 'completed' END AS status FROM f GROUP BY 1, 2)"""


@registered(f"{_JOBS} SELECT seed_domain, attempts, success_pages, failure_pages, last_status_code, completed_at, status FROM j")
def crawl_jobs(spark, sf_dir):
    jobs, _ = landing.record_crawl(_fetches(spark, sf_dir))
    return jobs.select("seed_domain", "attempts", "success_pages", "failure_pages", "last_status_code", "completed_at", "status")


@registered("""
SELECT count(*) AS pages, CAST(sum(k) AS BIGINT) AS latest FROM (
  SELECT max(o_orderkey) AS k FROM orders GROUP BY o_custkey, year(o_orderdate), o_orderkey % 3, CASE WHEN o_orderstatus = 'F' THEN o_orderpriority ELSE '' END)""")
def crawl_results(spark, sf_dir):
    _, results = landing.record_crawl(_fetches(spark, sf_dir))
    return results.agg(F.count("*").alias("pages"), F.sum("fetched_at").alias("latest"))


@registered(f"""{_JOBS},
good AS (SELECT seed_domain, max(completed_at) AS g FROM j WHERE success_pages > 0 GROUP BY 1)
SELECT j.seed_domain, CAST(sum(attempts) AS BIGINT) AS attempts, CAST(sum(success_pages) AS BIGINT) AS successes, CAST(sum(failure_pages) AS BIGINT) AS failures, count(*) FILTER (success_pages > 0) AS success_runs, count(*) FILTER (status <> 'completed') AS failure_runs,
  count(*) FILTER (success_pages = 0 AND (g IS NULL OR completed_at > g)) AS consecutive_failures, arg_max(status, completed_at) AS last_run_status, max(completed_at) FILTER (success_pages > 0) AS last_success_at
FROM j LEFT JOIN good ON good.seed_domain = j.seed_domain GROUP BY 1""")
def seed_run_telemetry(spark, sf_dir):
    jobs, _ = landing.record_crawl(_fetches(spark, sf_dir))
    found = landing.seed_telemetry(jobs)
    return found.select("seed_domain", "attempts", "successes", "failures", "success_runs", "failure_runs", "consecutive_failures", "last_run_status", "last_success_at")


@registered("""
SELECT o_orderkey, coalesce(s_name, 'own') AS seed_name, CASE WHEN s_suppkey IS NULL THEN '' ELSE 'A' END AS tier FROM orders LEFT JOIN supplier ON o_custkey = s_suppkey""")
def page_seed_lookup(spark, sf_dir):
    pages = read(spark, sf_dir, "orders").select("o_orderkey", F.concat(F.lit("https://s"), c("o_custkey").cast("string"), F.lit(".org/")).alias("seed_website"), F.lit("own").alias("seed_name"))
    known = read(spark, sf_dir, "supplier").select(c("s_name").alias("name"), F.concat(F.lit("http"), F.lit("s://www.s"), c("s_suppkey").cast("string"), F.lit(".org")).alias("website"), *(F.lit(v).alias(n) for n, v in (("state", "NJ"), ("market", ""), ("tier", "A"), ("source_type", "x"), ("extraction_profile", ""))))
    return seeds.with_seed(pages, known).select("o_orderkey", "seed_name", "tier")


@registered("""
SELECT page_id, starts_with(url, 'http') AND page_id % 4 <= 2 AND NOT regexp_matches(lower(regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1)), '^/(blog|news)(/|$)') AS accepted FROM pages""")
def url_acceptance(spark, sf_dir):
    return read(spark, sf_dir, "pages").select("page_id", frontier.accepted(c("url"), c("url"), c("page_id") % 4, 2, ("/blog/", "/news/")).alias("accepted"))


@registered("""
WITH k AS (SELECT c_custkey AS k, 'https://h' || CAST(c_custkey % 100 AS VARCHAR) || '.org' AS site FROM customer),
l AS (SELECT site || '/providers/' || CAST(k % 7 AS VARCHAR) AS url, site || '/start' || CAST(k AS VARCHAR) AS from_url FROM k UNION ALL SELECT site || '/team', site || '/start' || CAST(k AS VARCHAR) FROM k)
SELECT url, min(from_url) AS from_url, 1 AS depth FROM l WHERE url NOT IN (SELECT site || '/team' FROM k WHERE k % 10 = 0) GROUP BY 1""")
def link_expansion(spark, sf_dir):
    k, site = c("c_custkey"), F.concat(F.lit("https://h"), (c("c_custkey") % 100).cast("string"), F.lit(".org"))
    rows = read(spark, sf_dir, "customer").select(k.alias("k"), site.alias("site"))
    html = F.concat(F.lit("<a href='/providers/"), (c("k") % 7).cast("string"), F.lit("'>a</a><a href=\"../team\">b</a><a href='https://other.org/'>c</a><a href='x.css'>d</a>"))
    pages = rows.select(F.concat("site", F.lit("/start"), c("k").cast("string")).alias("url"), html.alias("html"), c("site").alias("seed"), F.lit("practice_site").alias("source_type"), F.lit(0).alias("depth"))
    seen = rows.where("k % 10 = 0").select(F.concat("site", F.lit("/team")).alias("url"))
    return frontier.expanded(cut(pages), seen, 2, 10).select("url", "from_url", "depth")


@registered("""
WITH RECURSIVE pages AS (SELECT c_custkey AS n FROM customer WHERE c_custkey > 0),
links AS (SELECT n, n + 7 AS target FROM pages UNION ALL SELECT n, n * 8 + 7 FROM pages UNION ALL SELECT n, n FROM pages),
reached AS (SELECT n, 0 AS depth FROM pages WHERE n <= 7 UNION SELECT l.target, r.depth + 1 FROM reached r JOIN links l ON l.n = r.n WHERE r.depth < 4)
SELECT 'https://h' || CAST(n % 7 AS VARCHAR) || '.org/n' || CAST(n AS VARCHAR) AS url, min(depth) AS depth FROM reached GROUP BY n""")
def frontier_levels(spark, sf_dir):
    n = c("c_custkey")
    pages = read(spark, sf_dir, "customer").where(n > 0)
    link = lambda t, quote: F.concat(F.lit(f"<a href={quote}/n"), t.cast("string"), F.lit(f"{quote}>x</a>"))
    html = F.concat(link(n + 7, "'"), link(n * 8 + 7, '"'), link(n, "'"), F.lit("<a href='x.css'>s</a><a href='https://other.org/n1'>o</a>"))
    site = F.concat(F.lit("https://h"), (n % 7).cast("string"), F.lit(".org"))
    landed = cut(pages.select(F.concat(site, F.lit("/n"), n.cast("string")).alias("url"), html.alias("html"), site.alias("seed"), F.lit("practice_site").alias("source_type"), n.alias("n")))
    return frontier.crawled(landed.select("url", "html"), landed.where("n <= 7").select("url", "seed", "source_type"), 4, 10).select("url", "depth")


@registered("""
WITH base AS (SELECT o_orderkey, o_custkey, o_orderstatus AS status, 0 AS step FROM orders WHERE o_orderkey % 3 <> 0),
delta AS (SELECT o_orderkey, o_custkey + 1 AS o_custkey, 'D' AS status, 1 AS step FROM orders WHERE o_orderkey % 5 = 0 UNION ALL SELECT o_orderkey, 0, 'E', 2 FROM orders WHERE o_orderkey % 35 = 0)
SELECT o_orderkey, o_custkey, status, step FROM (
  SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY step DESC) AS n FROM (SELECT * FROM base UNION ALL SELECT * FROM delta)) WHERE n = 1""")
def stored_upserts(spark, sf_dir):
    orders = read(spark, sf_dir, "orders")
    shape = lambda df, customer, status, at: df.select("o_orderkey", customer.cast("long").alias("o_custkey"), status.alias("status"), F.lit(at).alias("step"))
    table = store.KeyedTable(spark, f"{shared_folder(spark)}/orders-{uuid.uuid4().hex}", ["o_orderkey"], 16)
    table.upsert(shape(orders.where("o_orderkey % 3 <> 0"), c("o_custkey"), c("o_orderstatus"), 0), c("step"))
    delta = shape(orders.where("o_orderkey % 5 = 0"), c("o_custkey") + 1, F.lit("D"), 1).unionByName(shape(orders.where("o_orderkey % 35 = 0"), F.lit(0), F.lit("E"), 2))
    table.upsert(delta, c("step"))
    return table.read()
