"""Seeds, rules and policies as DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import normalize_domain, normalize_url
from ..operators.merge import first_per_key

#: Spellings under which a seed's attributes come.
ALIASES = {
    "name": ("name",), "website": ("website", "url"), "state": ("state",), "market": ("market",), "tier": ("tier",), "source_type": ("source_type", "sourceType"),
    "browser_required": ("browser_required", "browserRequired"), "extraction_profile": ("extraction_profile", "extractionProfile"), "priority": ("priority",),
}


def read_rows(spark: SparkSession, path: str) -> DataFrame:
    """Rows of a seed pack: the ``sources`` of a JSON document, or a CSV file with a header."""
    if path.lower().endswith(".json"):
        return spark.read.option("multiLine", True).json(path).select(F.explode("sources").alias("s")).select("s.*")
    return spark.read.option("header", True).csv(path)


def coerce(rows: DataFrame, source: str = "", priority: int = 0) -> DataFrame:
    """Seeds with their usual columns; what else a row has goes to the map ``metadata``."""
    def first(names: tuple[str, ...]) -> Column:
        there = [F.nullif(F.trim(F.col(n).cast("string")), F.lit("")) for n in names if n in rows.columns]
        return F.coalesce(*there, F.lit("")) if there else F.lit("")

    known = {n for names in ALIASES.values() for n in names}
    rest = [x for c in rows.columns if c not in known for x in (F.lit(c), F.col(c).cast("string"))]
    out = rows.select(
        *(first(names).alias(n) for n, names in ALIASES.items() if n not in ("priority", "browser_required")),
        F.coalesce(first(ALIASES["priority"]).try_cast("int"), F.lit(priority)).alias("priority"),
        F.lower(first(ALIASES["browser_required"])).isin("true", "1", "yes").alias("browser_required"), F.lit(source).alias("source"),
        (F.map_filter(F.create_map(*rest), lambda _, v: v.isNotNull()) if rest else F.create_map().cast("map<string,string>")).alias("metadata"),
    )
    return out.where("website <> ''")


def dedupe(seeds: DataFrame, keys: tuple[str, ...] = ("website", "state", "tier"), order: tuple[str, ...] = ("name",)) -> DataFrame:
    """The first seed of each website, state and tier, regardless of letter case in the latter two."""
    low = {f"_{k}": normalize_url(F.col(k)) if k == "website" else F.lower(F.coalesce(F.col(k), F.lit(""))) for k in keys}
    return first_per_key(seeds.withColumns(low), list(low), *(F.col(o) for o in order)).drop(*low)


def ordered(seeds: DataFrame, limit: int | None = None) -> DataFrame:
    """Seeds by priority, lower-case name and website, all descending."""
    out = seeds.orderBy(F.desc("priority"), F.desc(F.lower("name")), F.desc("website"))
    return out if limit is None else out.limit(limit)


def with_policy(requests: DataFrame, policies: DataFrame, default_mode: str, url: str = "url") -> DataFrame:
    """Each request with its domain's policy mode; exact domains only, wildcards and unknown modes fall back."""
    exact = policies.where(~F.col("domain").contains("*")).select(normalize_domain(F.col("domain")).alias("_host"), F.lower("mode").alias("_mode"))
    exact = exact.where(F.col("_mode").isin("http", "browser", "auto", "skip")).groupBy("_host").agg(F.min("_mode").alias("_mode"))
    return requests.withColumn("_host", normalize_domain(F.col(url))).join(exact, "_host", "left").withColumn("mode", F.coalesce("_mode", F.lit(default_mode))).drop("_host", "_mode")


def sitemaps(robots: Column) -> Column:
    """Sitemap targets of a robots file, first appearance kept."""
    lines = F.filter(F.split(robots, r"\r?\n"), lambda x: F.lower(F.trim(x)).startswith("sitemap:"))
    return F.array_distinct(F.filter(F.transform(lines, lambda x: normalize_url(F.regexp_replace(F.trim(x), r"(?i)^sitemap:\s*", ""))), lambda x: x != "https:///"))


def sitemap_urls(xml: Column) -> Column:
    """Locations listed in a sitemap, first appearance kept."""
    return F.array_distinct(F.transform(F.regexp_extract_all(xml, F.lit(r"(?i)<loc>\s*([^<]+?)\s*</loc>"), F.lit(1)), normalize_url))


def read_rules(spark: SparkSession, path: str, schema_name: str = "") -> DataFrame:
    """Rules of a JSON document (its ``rules``), ready for the store: the last of an id counts, ``active`` is 0 or 1, blanks for what lacks."""
    rows = spark.read.option("multiLine", True).json(path).select(F.explode("rules").alias("r")).select("r.*")

    def text(name: str) -> Column:
        return F.coalesce(F.trim(F.col(name).cast("string")), F.lit("")) if name in rows.columns else F.lit("")

    active = ~F.lower(text("active")).isin("false", "0", "no")
    names = ("rule_id", "schema_name", "state", "credential", "license_type", "authority", "limitations", "rationale", "citation_title", "citation_url", "retrieved_at")
    out = rows.select(*(F.coalesce(F.nullif(text(n), F.lit("")), F.lit(schema_name if n == "schema_name" else "")).alias(n) for n in names), active.cast("int").alias("active"), F.monotonically_increasing_id().alias("_at"))
    w = F.struct(*(n for n in out.columns if n not in ("rule_id", "_at")))
    return out.where("rule_id <> ''").groupBy("rule_id").agg(F.max_by(w, "_at").alias("r")).select("rule_id", "r.*")


def read_policies(spark: SparkSession, path: str) -> DataFrame:
    """Domain policies of a JSON document: ``domains`` maps a domain to its mode, or to a policy with one; none if it has none."""
    text = spark.read.text(path, wholetext=True)
    entries = F.explode(F.from_json(F.get_json_object("value", "$.domains"), "map<string,string>"))
    pairs = text.select(entries.alias("domain", "policy"))
    mode = F.coalesce(F.get_json_object("policy", "$.mode"), F.when(~F.col("policy").startswith("{"), F.col("policy")))
    return pairs.select("domain", F.lower(F.trim(mode)).alias("mode")).where("mode IS NOT NULL")


def with_seed(pages: DataFrame, seeds: DataFrame, website: str = "seed_website") -> DataFrame:
    """Pages with their seed's tier, source type and profile by normalised website; pages of no seed get blanks and keep their own name, state and market."""
    known = seeds.select(normalize_url(F.col("website")).alias("_site"), F.struct("name", "state", "market", "tier", "source_type", "extraction_profile").alias("_seed"))
    known = known.groupBy("_site").agg(F.min("_seed").alias("_seed"))
    out = pages.withColumn("_site", normalize_url(F.col(website))).join(known, "_site", "left")
    own = {f"seed_{n}": F.coalesce(F.nullif(F.col(f"_seed.{n}"), F.lit("")), F.col(f"seed_{n}") if f"seed_{n}" in pages.columns else F.lit(""), F.lit("")) for n in ("name", "state", "market")}
    return out.withColumns(own | {n: F.coalesce(F.col(f"_seed.{n}"), F.lit("")) for n in ("tier", "source_type", "extraction_profile")}).drop("_site", "_seed")


def with_metro(rows: DataFrame, lookup: dict[str, str], city: str = "city", default: str = "") -> DataFrame:
    """Rows with the metro area of their city; the lookup is a literal map, so nothing is joined."""
    if not lookup:
        return rows.withColumn("metro", F.lit(default))
    metro = F.create_map(*(F.lit(x) for k, v in lookup.items() for x in (k.strip().lower(), v)))
    return rows.withColumn("metro", F.coalesce(F.element_at(metro, F.lower(F.trim(F.coalesce(F.col(city), F.lit(""))))), F.lit(default)))
