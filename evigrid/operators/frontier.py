"""The crawl frontier over landed links: admission, scoring, ranking, budgets and failure storms."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import extract_links, let, normalize_domain, resolve_link, same_domain
from .graph import cut

# Paths and endings that are not worth fetching.
STATIC_PATHS = ("/_next/", "/wp-content/", "/wp-includes/", "/assets/", "/static/", "/images/", "/image/", "/img/", "/fonts/", "/css/", "/js/")
LOW_VALUE_PATHS = ("/privacy", "/terms", "/policy", "/policies", "/xmlrpc.php", "/feed", "/author/", "/tag/", "/category/")
STATIC_ENDINGS = (
    ".css", ".js", ".mjs", ".map", ".png", ".jpg", ".jpeg", ".gif", ".webp", ".svg", ".ico", ".woff", ".woff2", ".ttf", ".otf", ".eot", ".pdf",
    ".zip", ".mp4", ".mp3", ".webm",
)
# Weights of path parts for research, and bonuses.
POSITIVE_HINTS = {
    "provider": 22, "providers": 22, "doctor": 18, "doctors": 18, "therapist": 18, "therapists": 18, "psychologist": 22, "psychologists": 22,
    "psychiatrist": 22, "directory": 20, "search": 20, "find": 14, "license": 24, "verify": 24, "lookup": 18, "results": 16, "listing": 14,
    "staff": 14, "team": 14, "evaluation": 18, "evaluations": 18, "assessment": 18, "diagnostic": 18, "autism": 18, "adhd": 18, "telehealth": 10, "contact": 8,
}
NEGATIVE_HINTS = {
    "privacy": -100, "terms": -100, "career": -90, "careers": -90, "job": -90, "jobs": -90, "news": -72, "blog": -72, "article": -72,
    "articles": -72, "event": -56, "events": -56, "press": -56, "donate": -64, "foundation": -64,
}
BOARD_HINTS = ("license", "verify", "lookup", "search", "results", "physician", "psychologist")
ROOT_BONUS, CONFIGURED_BONUS, SEGMENT_BONUS, ALIGNED_BONUS, BOARD_BONUS, XML_PENALTY, OFF_DOMAIN = 52, 64, 18, 12, 18, -80, -1000
# Failures of a kind that trip an intervention.
STORM_LIMITS = {"dns": 1, "blocked": 3, "not_found": 8}
PREFIX_STORM_LIMIT = 3


def path_of(url: Column) -> Column:
    """Lower-case path of a URL, ``/`` where it has none."""
    p = F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1))
    return F.when(p == "", F.lit("/")).otherwise(p)


def _below(path: Column, prefixes: Sequence[str]) -> Column:
    out = F.lit(False)
    for p in prefixes:
        out = out | (path == p.rstrip("/")) | path.startswith(p)
    return out


def reject_reason(url: Column, suppressed: Sequence[str] = ()) -> Column:
    """Why a URL is not fetched, the first that applies; empty if it may be."""
    def reason(path: Column) -> Column:
        static = F.lit(False)
        for p in STATIC_PATHS:
            static = static | path.startswith(p)
        ending = F.lit(False)
        for e in STATIC_ENDINGS:
            ending = ending | path.endswith(e)
        return (
            F.when(_below(path, suppressed), "suppressed_prefix").when(static, "static_path").when(_below(path, LOW_VALUE_PATHS), "low_value_path")
            .when(ending, "static_extension").otherwise("")
        )

    # the path is bound once: a filter computes it anew at each of some sixty places otherwise
    return let(path_of(url), reason)


def accepted(url: Column, seed: Column, depth: Column, most_depth: int, suppressed: Sequence[str] = (), schemes: Sequence[str] = ("http", "https")) -> Column:
    """Whether a URL is queued: a web address on the seed's domain, not too deep, with nothing against it."""
    scheme = F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^([A-Za-z][A-Za-z0-9+.-]*):", 1))
    return scheme.isin(*schemes) & same_domain(url, seed) & (depth <= most_depth) & (reject_reason(url, suppressed) == "")


def expanded(pages: DataFrame, seen: DataFrame, most_depth: int, per_page: int, suppressed: Sequence[str] = ()) -> DataFrame:
    """The next level of a crawl: each page's best links, in its own order, that are accepted and not seen.

    ``pages`` has ``url``, ``html``, ``seed``, ``source_type``, ``depth``; ``seen`` has ``url``. Seen addresses
    don't count against a page's limit. Links are tried by score, then by length and letters of the link
    as it is written. An address that several pages link to is queued once, for the page of the least
    address. Levels are joined with the seen set by address, so no set is held in memory.
    """
    c = F.col
    # the address is part of what is exploded, so that it is computed once
    link = F.explode(F.transform(F.array_distinct(extract_links(c("html"))), lambda x: F.struct(x.alias("raw"), resolve_link(c("url"), x).alias("url"))))
    links = pages.where(c("depth") < most_depth).select(c("url").alias("from_url"), "seed", "source_type", (c("depth") + 1).alias("depth"), link.alias("link")).select("*", "link.raw", "link.url")
    scored = links.where(accepted(c("url"), c("seed"), c("depth"), most_depth, suppressed))
    new = scored.join(seen.select("url").distinct(), "url", "left_anti")
    # several links of a page to one address count as the first of them
    once = new.groupBy("from_url", "url", "seed", "source_type", "depth").agg(F.min(F.struct(F.length("raw").alias("length"), c("raw").alias("raw"))).alias("as"))
    once = once.withColumn("score", research_score(c("url"), c("seed"), c("source_type")))
    w = Window.partitionBy("from_url").orderBy(F.desc("score"), "as", "url")
    best = once.withColumn("rank", F.row_number().over(w)).where(c("rank") <= per_page)
    return best.groupBy("url").agg(F.min_by(F.struct("from_url", "seed", "source_type", "depth", "score", "rank"), "from_url").alias("r")).select("url", "r.*")


def crawled(pages: DataFrame, starts: DataFrame, most_depth: int, per_page: int, per_seed: int | None = None, suppressed: Sequence[str] = ()) -> DataFrame:
    """The frontier to its end over landed pages: every address that is queued, with ``depth``, ``from_url`` and ``seed``.

    ``pages`` has ``url`` and ``html``; ``starts`` has ``url``, ``seed`` and ``source_type`` and is level 0. Each
    round expands the pages of one level against all addresses seen so far and is written to the shared
    folder, so a plan never holds more than one level and a lost executor repeats only that. With
    ``per_seed`` a seed's addresses stop at that number, in order of level, score and address.
    """
    c = F.col
    seen = cut(starts.groupBy("url").agg(F.min_by(F.struct("seed", "source_type"), "seed").alias("s")).select(
        "url", "s.*", F.lit(0).alias("depth"), F.lit("").alias("from_url"), F.lit(0).alias("score")
    ))
    level = seen
    for _ in range(most_depth):
        landed = level.select("url", "seed", "source_type", "depth").join(pages.select("url", "html").dropDuplicates(["url"]), "url")
        found = expanded(landed, seen, most_depth, per_page, suppressed).select(*seen.columns)
        if per_seed is not None:
            used = seen.groupBy("seed").agg(F.count("*").alias("used"))
            w = Window.partitionBy("seed").orderBy(F.desc("score"), "url")
            found = found.withColumn("n", F.row_number().over(w)).join(used, "seed", "left").where(c("n") + F.coalesce("used", F.lit(0)) <= per_seed).select(*seen.columns)
        level = cut(found)
        if level.isEmpty():
            break
        seen = cut(seen.unionByName(level))
    return seen.select("url", "depth", "from_url", "seed")


def path_prefix(url: Column) -> Column:
    """The bucket of paths that failures are counted in."""
    def bucket(path: Column) -> Column:
        first = F.regexp_extract(path, r"^/+([^/]+)", 1)
        out = F.when(path == "/", F.lit("/"))
        for p in (*STATIC_PATHS, *LOW_VALUE_PATHS):
            out = out.when((path == p.rstrip("/")) | path.startswith(p), F.lit(p))
        return out.when(first == "", F.lit("/")).when(first.contains("."), F.concat(F.lit("/"), first)).otherwise(F.concat(F.lit("/"), first, F.lit("/")))

    return let(path_of(url), bucket)


def segments(url: Column) -> Column:
    """Path segments without a file name at the end."""
    parts = F.filter(F.split(path_of(url), "/"), lambda s: s != "")
    last = F.coalesce(F.try_element_at(parts, F.lit(-1)), F.lit(""))
    return F.when(last.contains("."), F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(0)))).otherwise(parts)


# Segments that name no part of a site, leaves that list rather than detail, and the seeds whose leaves may.
GENERIC_SEGMENTS = ("application", "applications", "default", "default.aspx", "default.html", "index", "index.aspx", "index.html", "page", "pages")
LISTING_LEAVES = ("provider", "team", "staff", "directory", "search", "license", "lookup", "verify", "location")
DETAIL_SOURCES = ("hospital_directory", "university_directory", "practice_site", "state_registry")


def anchor(url: Column) -> Column:
    """Path segments up to the last that is neither a file nor generic."""
    parts = segments(url)
    last = F.aggregate(F.transform(parts, lambda s, i: F.when(s.isin(*GENERIC_SEGMENTS), F.lit(0)).otherwise(i + 1)), F.lit(0), lambda a, x: F.greatest(a, x))
    return F.slice(parts, 1, last)


def detail_page(url: Column, source_type: Column) -> Column:
    """Whether a seed points at one entry of a site: a long, hyphenated or deep leaf that names no listing."""
    parts = anchor(url)
    leaf = F.coalesce(F.try_element_at(parts, F.lit(-1)), F.lit(""))
    listing = F.lit(False)
    for token in LISTING_LEAVES:
        listing = listing | leaf.contains(token)
    detailed = (F.length(leaf) >= 18) | (F.length(leaf) - F.length(F.regexp_replace(leaf, "-", "")) >= 2) | (F.size(parts) >= 2)
    return (F.size(parts) > 0) & ~listing & source_type.isin(*DETAIL_SOURCES) & detailed


def proximity(url: Column, seed: Column) -> Column:
    """Points for leading segments shared with the seed's path, more if one path goes on from the other."""
    def points(p: Column) -> Column:
        a, b = p["a"], p["b"]
        n = F.least(F.size(a), F.size(b))
        same = F.zip_with(F.slice(a, F.lit(1), n), F.slice(b, F.lit(1), n), lambda x, y: (x == y).cast("int"))
        start = F.struct(F.lit(0).alias("n"), F.lit(1).alias("on"))
        shared = F.aggregate(same, start, lambda s, x: F.struct((s["n"] + s["on"] * x).alias("n"), (s["on"] * x).alias("on")))["n"]
        return let(shared, lambda k: F.when(k == 0, F.lit(0)).otherwise(k * SEGMENT_BONUS + F.when(k == n, ALIGNED_BONUS).otherwise(0)))

    return let(F.struct(anchor(url).alias("a"), anchor(seed).alias("b")), points)


def research_score(url: Column, seed: Column, source_type: Column, configured: Sequence[str] = (), hints: Mapping[str, int] | None = None) -> Column:
    """How promising a URL is for a seed; far below zero off the seed's domain. Hints add up where one holds another."""
    def hinted(path: Column) -> Column:
        score = F.when(path == "/", ROOT_BONUS).otherwise(0)
        if configured:
            at_end = F.lit(False)
            for c in configured:
                at_end = at_end | path.endswith(c)
            score = score + F.when(at_end, CONFIGURED_BONUS).otherwise(0)
        for token, weight in (POSITIVE_HINTS | NEGATIVE_HINTS if hints is None else hints).items():
            score = score + F.when(path.contains(token), weight).otherwise(0)
        board = F.lit(False)
        for token in BOARD_HINTS:
            board = board | path.contains(token)
        score = score + F.when((source_type == "licensing_board") & board, BOARD_BONUS).otherwise(0)
        return score + F.when(path.endswith(".xml"), XML_PENALTY).otherwise(0)

    return F.when(same_domain(url, seed), let(path_of(url), hinted) + proximity(url, seed)).otherwise(OFF_DOMAIN)


def ranked(candidates: DataFrame, per: str, url: str, score: str, least: int, limit: int) -> DataFrame:
    """The ``limit`` best URLs of each seed: score descending, then shorter path, then URL."""
    order = Window.partitionBy(per).orderBy(F.desc(score), F.length(path_of(F.col(url))), url)
    return candidates.where(F.col(score) >= least).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= limit)


def within_budget(pages: DataFrame, domain: str, order: Sequence[str], budget: Column, total: int | None = None) -> DataFrame:
    """Pages within each domain's budget, in order, and optionally within a budget over all."""
    w = Window.partitionBy(domain).orderBy(*order)
    kept = pages.withColumn("place", F.row_number().over(w)).where(F.col("place") <= budget)
    return kept.orderBy("place", *order).limit(total) if total is not None else kept


def denied(candidates: DataFrame, url: str, denylist: DataFrame) -> DataFrame:
    """Candidates whose domain is not on the list (column ``domain``, a leading dot is dropped)."""
    listed = denylist.select(F.regexp_replace(F.lower("domain"), r"^\.", "").alias("_host")).distinct()
    return candidates.withColumn("_host", normalize_domain(F.col(url))).join(listed, "_host", "left_anti").drop("_host")


def seed_domain_problem(website: Column) -> Column:
    """Why a seed's domain is invalid; empty if it is valid."""
    d = normalize_domain(website)
    return (
        F.when(d == "", "missing_domain").when(d.contains(" "), "invalid_domain_whitespace").when(d.rlike(r"[^a-z0-9.:-]"), "invalid_domain_chars")
        .when(~d.contains(".") & ~d.startswith("localhost"), "invalid_domain_format").otherwise("")
    )


def storms(failures: DataFrame, domain: str, order: Sequence[str], kind: str, limits: Mapping[str, int] = STORM_LIMITS) -> DataFrame:
    """The failure at which each domain first reaches each kind's limit.

    ``failures`` holds failures only; the row numbers of a domain and kind stop at the limit, so the
    rank limit is applied before the shuffle.
    """
    w = Window.partitionBy(domain, kind).orderBy(*order)
    limit = F.coalesce(*(F.when(F.col(kind) == k, n) for k, n in limits.items()))
    rows = failures.where(F.col(kind).isin(*limits)).withColumn("failures", F.row_number().over(w)).where(F.col("failures") <= max(limits.values()))
    return rows.where(F.col("failures") == limit)


def recently_fetched(requests: DataFrame, fetched: DataFrame, key: str, at: str, now: Column, hours: int = 24) -> DataFrame:
    """Requests without a fetch in the last hours."""
    recent = fetched.where(F.col(at) >= now - F.expr(f"interval {hours} hours")).select(key).distinct()
    return requests.join(recent, key, "left_anti")
