"""Pages to typed records with quoted evidence."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import signals
from ..functions.text import PHONE, content_hash, extract_links, extract_title, first_link_with, first_phone, make_pk, normalize_text, resolve_link, snippet, snippet_at, strip_html
from ..sources.seeds import with_metro
from . import dossier

# How names with credentials, roles, licence facts and places are written on pages.
CREDENTIAL = r"(?:MD|DO|PsyD|PhD|NP|APN|PA|LCSW|EdD|BCBA-D|BCBA)"
CREDENTIALS = rf"({CREDENTIAL}(?:\s*,\s*{CREDENTIAL})*)"
NAME = r"[A-Z][a-z]+(?:\s+[A-Z][a-z.'-]+){1,3}"
NAMED_PROVIDER = rf"\b(?:Dr\.\s+)?({NAME})\s*,\s*{CREDENTIALS}\b"
ROLE_PROVIDER = (
    r"(?i)\b(?:Directed by|Led by|Director,|Director:|Medical Director:?|Clinical Director:?|Program Director:?|Psychiatrist:?|Psychologist:?|Physician:?|Provider:)"
    rf"\s+(?:Dr\.\s+)?({NAME})(?:\s*,\s*{CREDENTIALS})?\b"
)
DOCTOR = rf"\bDr\.\s+({NAME})\b"
BOARD_PROVIDERS = (
    r"(?i)\b(?:licensee name|provider name|practitioner name|physician name|psychologist name|licensee)\s*[:\-]\s*(?:dr\.\s+)?"
    r"([A-Z][a-z.'-]+(?:\s+[A-Z][a-z.'-]+){1,3}?)(?=\s+(?:profession|license|status|state)\b|$)",
    r"(?i)\bverification\s+for\s+(?:dr\.\s+)?([A-Z][a-z]+(?:\s+[A-Z][a-z.'-]+){1,3})\b",
)
BOARD_LICENSE = (r"(?i)\blicense type[:\s]+([A-Za-z][A-Za-z /-]{2,60})\b", r"(?i)\bprofession[:\s]+([A-Za-z][A-Za-z /-]{2,60})\b")
BOARD_HEAD = 600
FAX = rf"(?i)\bFax[:\s]+({PHONE})"
NPI = r"(?i)\bNPI(?:\s*(?:Number|#|:))?\s*(\d{10})\b"
CITY = r"\b([A-Z][a-z]+(?:\s+[A-Z][a-z]+)*)\s*,\s*(NJ)\b"
HOME_STATE = "NJ"
LICENSE_STATUS = (
    r"(?i)\blicense status[:\s]+(active|inactive|suspended|revoked)\b", r"(?i)\bstatus[:\s]+(active|inactive|suspended|revoked)\b",
    r"(?i)\b(active|inactive|suspended|revoked)\s+license\b",
)
NOTES = {
    "insurance_notes": r"(?i)\b(insurance|accept(?:s|ing)?\s+insurance|in-network)\b", "waitlist_notes": r"(?i)\b(waitlist|wait list|currently scheduling|next available)\b",
    "referral_requirements": r"(?i)\b(referral|required referral|physician referral|intake form)\b",
}
PRACTICE = r"(?i)\b(?:Center|Clinic|Associates|Psychology|Behavioral|Pediatrics|Hospital|Health|Services|Evaluations)\b"
NO_PRACTICE = "Unknown Practice"
DOCTOR_SOURCES = ("hospital_directory", "university_directory")
SECTIONS = (
    r"(?is)<main\b[^>]*>(.*?)</main>", r"(?is)<article\b[^>]*>(.*?)</article>", r"""(?is)<div\b[^>]*id=["']main-content["'][^>]*>(.*?)</div>""",
    r"""(?is)<section\b[^>]*data-content=["']true["'][^>]*>(.*?)</section>""",
)
SECTION_LETTERS = 80

_PERSON = "array<struct<name:string,credentials:string,at:int,length:int>>"


def main_section(html: Column) -> Column:
    """The first main section with enough text, else the whole page."""
    found = [F.regexp_extract(F.coalesce(html, F.lit("")), p, 1) for p in SECTIONS]
    return F.coalesce(*(F.when(F.length(strip_html(s)) >= SECTION_LETTERS, s) for s in found), html)


def first_group(text: Column, patterns: tuple[str, ...]) -> Column:
    """Lower-case first group of the first pattern that matches; empty if none does."""
    return F.coalesce(*(F.nullif(F.lower(normalize_text(F.regexp_extract(text, p, 1))), F.lit("")) for p in patterns), F.lit(""))


def first_quote(text: Column, patterns: tuple[str, ...]) -> Column:
    """Context of the first pattern that matches; empty if none does."""
    return F.coalesce(*(F.nullif(snippet(text, p), F.lit("")) for p in patterns), F.lit(""))


def _people(text: Column, pattern: str, with_credentials: bool, only_first: bool = False) -> Column:
    """Cleaned names, credentials and places of a pattern's matches, in order."""
    if only_first:
        whole = F.filter(F.array(F.regexp_extract(text, pattern, 0)), lambda m: m != "")
    else:
        whole = F.regexp_extract_all(text, F.lit(f"({pattern})" if not pattern.startswith("(?i)") else f"(?i)({pattern[4:]})"), F.lit(1))
    # each match is looked for behind the one before it
    start = F.struct(F.lit(1).alias("next"), F.array().cast("array<struct<m:string,at:int>>").alias("found"))

    def place(done: Column, m: Column) -> Column:
        at = F.call_function("locate", m, text, done["next"])
        return F.struct((at + F.length(m)).alias("next"), F.concat(done["found"], F.array(F.struct(m.alias("m"), at.alias("at")))).alias("found"))

    placed = F.aggregate(whole, start, place)["found"]

    def person(x: Column) -> Column:
        credentials = dossier.credentials(F.regexp_extract(x["m"], pattern, 2)) if with_credentials else F.lit("")
        return F.struct(dossier.provider_name(F.regexp_extract(x["m"], pattern, 1)).alias("name"), credentials.alias("credentials"), x["at"].alias("at"), F.length(x["m"]).alias("length"))

    return F.filter(F.transform(placed, person), lambda p: p["name"] != "")


def _one_each(people: Column) -> Column:
    """One entry a name: the first, or the first with credentials; in order of place and name."""
    def keep(kept: Column, x: Column) -> Column:
        same = F.filter(kept, lambda k: F.lower(k["name"]) == F.lower(x["name"]))
        others = F.filter(kept, lambda k: F.lower(k["name"]) != F.lower(x["name"]))
        better = (F.size(same) > 0) & (F.try_element_at(same, F.lit(1))["credentials"] == "") & (x["credentials"] != "")
        return F.when(F.size(same) == 0, F.concat(kept, F.array(x))).when(better, F.concat(others, F.array(x))).otherwise(kept)

    merged = F.aggregate(people, F.array().cast(_PERSON), keep)
    ordered = F.array_sort(F.transform(merged, lambda x: F.struct(x["at"].alias("at"), F.lower(x["name"]).alias("low"), x.alias("x"))))
    return F.transform(ordered, lambda x: x["x"])


def provider_candidates(text: Column, source_type: Column) -> Column:
    """People a page names, by the patterns of its kind of source: array of ``name``, ``credentials``, ``at``, ``length``.

    Boards name one licensee; other sources list names with credentials and with roles, hospitals
    and universities also plain doctors.
    """
    none = F.array().cast(_PERSON)
    listed = F.concat(_people(text, NAMED_PROVIDER, True), _people(text, ROLE_PROVIDER, True), F.when(source_type.isin(*DOCTOR_SOURCES), _people(text, DOCTOR, False)).otherwise(none))
    head = F.substring(text, 1, BOARD_HEAD)
    tries = [*(_people(text, p, False, True) for p in BOARD_PROVIDERS), _people(head, NAMED_PROVIDER, True, True), _people(head, DOCTOR, False, True)]
    # the first that is not empty; each is computed at one place
    board = F.coalesce(*(F.nullif(t, none) for t in tries), none)
    return F.when(source_type == "licensing_board", board).otherwise(_one_each(listed))


def practice_name(title: Column, text: Column, seed_name: Column) -> Column:
    """The title where it names a practice, else the seed's name, else the text or title."""
    title, seed = normalize_text(title), F.coalesce(seed_name, F.lit(""))
    return F.when((title != "") & title.rlike(PRACTICE), title).when(seed != "", seed).when(text.rlike(PRACTICE), text).otherwise(F.coalesce(F.nullif(title, F.lit("")), F.lit(NO_PRACTICE)))


def evidence(field: str, value: Column, quote: Column, url: Column) -> Column:
    return F.struct(F.lit(field).alias("field"), value.alias("value"), quote.alias("quote"), url.alias("source_url"))


def extract_records(pages: DataFrame, metros: Mapping[str, str] | None = None) -> DataFrame:
    """Zero or more records per page.

    ``pages`` has ``url``, ``html``, ``status_code``, ``source_type``, ``seed_name``, ``tier``, and may
    have ``extraction_profile``, ``seed_state`` and ``seed_market``. Blocked and irrelevant pages give
    nothing; a page without a named provider gives one record of the practice where its role or its
    evidence allows that. Every record carries quoted evidence.
    """
    c = F.col
    for name in ("extraction_profile", "seed_state", "seed_market"):
        if name not in pages.columns:
            pages = pages.withColumn(name, F.lit(""))
    ready = pages.where((F.coalesce("html", F.lit("")) != "") & (signals.block_reason(c("status_code"), c("html"), signals.EXTRACTION_BLOCK_MARKERS) == ""))
    text = ready.withColumns({"_title": normalize_text(extract_title(c("html"))), "_all": strip_html(c("html")), "_main": strip_html(main_section(c("html")))})
    text = text.withColumn("_text", F.coalesce(F.nullif(c("_main"), F.lit("")), c("_all")))
    found = text.withColumns({
        "_people": provider_candidates(c("_text"), c("source_type")), **{f: signals.diagnosis(c("_text"), pattern) for f, pattern in signals.CONDITIONS.items()},
        "_status": F.coalesce(F.nullif(first_group(c("_text"), LICENSE_STATUS), F.lit("")), F.lit("unknown")), "npi": F.regexp_extract("_all", NPI, 1),
        "city": normalize_text(F.regexp_extract("_all", CITY, 1)),
    })
    role = signals.page_role(c("source_type"), c("_title"), c("url"), c("_text"), F.size("_people") > 0)
    yes = (c("diagnoses_asd") == "yes") | (c("diagnoses_adhd") == "yes")
    judged = found.withColumn("_role", role)
    open_ = (c("_text") != "") & signals.page_relevant(c("source_type"), c("_role"), yes, c("_title"), c("url"))
    reviewable = c("_role.allow_practice") | yes | (c("_status") != "unknown")
    nobody = F.array(F.struct(F.lit("").alias("name"), F.lit("").alias("credentials"), F.lit(0).alias("at"), F.lit(0).alias("length")))
    people = F.when(c("_role.allow_provider") & (F.size("_people") > 0), c("_people")).when(reviewable, nobody).otherwise(F.array().cast(_PERSON))
    # pages that give nothing have an empty array: a condition here would be pushed down and repeat the text's expressions
    rows = judged.withColumn("_p", F.explode_outer(F.when(open_, people))).where("_p IS NOT NULL")
    named, quote = c("_p.name") != "", snippet_at(c("_text"), c("_p.at"), c("_p.length"))
    shown = {f: signals.diagnosis_quote(c("_text"), f) for f in signals.CONDITIONS}
    quotes = F.array_compact(F.array(
        F.when(named, evidence("provider_name", c("_p.name"), quote, c("url"))), F.when(named & (c("_p.credentials") != ""), evidence("credentials", c("_p.credentials"), quote, c("url"))),
        *(F.when(q != "", evidence(f, c(f), q, c("url"))) for f, q in shown.items()),
        F.when(c("_status") != "unknown", evidence("license_status", c("_status"), first_quote(c("_text"), LICENSE_STATUS), c("url"))),
        F.when(c("npi") != "", evidence("npi", c("npi"), snippet(c("_all"), NPI), c("url"))),
    ))
    board = c("source_type") == "licensing_board"
    licence = F.when(board, signals.board_license_type(c("seed_name"), first_group(c("_all"), BOARD_LICENSE))).when(named, signals.license_type(c("_p.credentials"), c("source_type"))).otherwise("unknown")
    state = F.coalesce(F.nullif(F.regexp_extract("_all", CITY, 2), F.lit("")), F.nullif(F.trim("seed_state"), F.lit("")), F.lit(HOME_STATE))
    document = make_pk("src", c("url"), content_hash(c("html")), c("tier"), c("source_type"))
    named_practice = practice_name(c("_title"), c("_text"), c("seed_name"))
    rows = with_metro(rows, dict(metros or {})).withColumn("metro", F.coalesce(F.nullif(c("metro"), F.lit("")), F.nullif(F.trim("seed_market"), F.lit("")), F.lit("unknown")))
    return rows.select(
        make_pk("ext", document, F.when(named, c("_p.name")).otherwise(named_practice), c("url")).alias("extracted_id"), document.alias("source_document_id"), c("url").alias("source_url"),
        c("tier").alias("source_tier"), "source_type", "extraction_profile", c("_p.name").alias("provider_name"), c("_p.credentials").alias("credentials"), "npi",
        named_practice.alias("practice_name"), F.coalesce(F.when(first_link_with(extract_links(c("html"))) != "", resolve_link(c("url"), first_link_with(extract_links(c("html"))))), F.lit("")).alias("intake_url"),
        first_phone(c("_all")).alias("phone"), normalize_text(F.regexp_extract("_all", FAX, 1)).alias("fax"), F.lit("").alias("address_1"), "city", state.alias("state"), F.lit("").alias("zip"), "metro",
        state.alias("license_state"), licence.alias("license_type"), c("_status").alias("license_status"), "diagnoses_asd", "diagnoses_adhd", signals.age_groups(c("_text")).alias("age_groups"),
        signals.telehealth(c("_all")).alias("telehealth"), *(snippet(c("_all"), p).alias(n) for n, p in NOTES.items()), quotes.alias("evidence"),
    )
