"""Decision cascades over statuses, pages, names and records as column expressions.

Vocabularies are parameters, so the same cascades serve other domains.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import let, normalize_text, snippet, strip_html, unescape

# Status codes and page markers that mean a crawler is blocked, in order of precedence.
BLOCKED_STATUSES = (401, 403, 429, 503)
BLOCK_MARKERS = ("captcha", "verify you are human", "access denied", "attention required", "cloudflare", "akamai")
EXTRACTION_BLOCK_MARKERS = (
    "_Incapsula_Resource", "Request unsuccessful", "Incapsula incident ID", "access to this page has been denied", "pardon our interruption",
)

# Vocabulary of page roles, and of the page types that each role lets through.
ROLE_WORDS = {
    "admin_noise": r"(?i)\b(careers|jobs|donate|foundation|press room|privacy policy|terms of use)\b",
    "publication_news": r"(?i)\b(publications|publication|journal|webinar|webinars|continuing education|news|blog|article|articles|event|events)\b",
    "faq_help": r"(?i)\b(faq|frequently asked questions|before your assessment|approach to treatment|what can i expect)\b",
    "directory_listing": r"(?i)\b(find a therapist|find child therapists|directory|results|browse therapists|therapists near)\b",
    "provider_page": r"(?i)\b(provider|providers|staff|team|doctor|doctors|physician|psychologist|psychiatrist|clinician|faculty)\b",
    "practice_service": r"(?i)\b(evaluation|evaluations|assessment|assessments|clinic|clinics|services|service|treatment|diagnostic|diagnostics|autism|adhd)\b",
}
DIRECTORY_DETAIL = r"(?i)\b(profile|bio|provider|staff|team|doctor|therapist|psychologist|psychiatrist)\b"
PAGE_RELEVANCE = r"(?i)\b(autism|asd|adhd|developmental|diagnostic|evaluation|assessment|neurodevelopment)\b"
CHILD = r"(?i)\b(children|child|pediatric|adolescent|teen)\b"
ADULT = r"(?i)\b(adult|adults)\b"
TELEHEALTH = r"(?i)\b(telehealth|virtual visits?|video visits?|remote appointments?)\b"
# Letters of a page's text that its role is judged by.
ROLE_TEXT = 1200

# Signs of a diagnosis, explicit where a condition and a test stand within 80 letters.
TESTS = r"(?:diagnostic evaluations?|diagnostic testing|assessment(?:s)?|testing(?: services?)?|evaluations?)"
CONDITIONS = {
    "diagnoses_asd": r"(?:autism|asd|autism spectrum disorder)",
    "diagnoses_adhd": r"(?:adhd|attention deficit hyperactivity disorder)",
}
AMBIGUOUS = {"diagnoses_asd": r"(?i)\b(autism|ASD|autism spectrum disorder)\b", "diagnoses_adhd": r"(?i)\bADHD\b"}

# Credential classes and licence types by the parts that a credential holds, in order of precedence.
CREDENTIAL_CLASSES = (("MD/DO", ("md", "do", "physician")), ("PsyD/PhD", ("psyd", "phd", "psychologist")), ("APN/NP", ("apn", "np")))
LICENSE_TYPES = (("physician", ("md", "do")), ("psychologist", ("psyd", "phd")), ("advanced_practice_nurse", ("apn", "np")))

# What a person's name does not begin with or hold.
NAME_PREFIXES = ("and ", "are ", "can ", "for ", "from ", "help ", "is ", "may ", "or ", "should ", "sleep ", "to ", "who ", "will ", "with ")
NAME_STOP_WORDS = (
    "about", "adhd", "adult", "assessment", "autism", "because", "beneficial", "can", "child", "children", "connected", "conduct", "counselor",
    "covered", "diagnosable", "doctor", "evaluation", "evaluations", "expert", "experienced", "first", "gather", "health", "help", "initial",
    "insurance", "licensed", "medical", "mental", "network", "order", "other", "physician", "primary", "psychiatrist", "psychologist", "refer",
    "rule", "sleep", "specialists", "substance", "testing", "tests", "therapist", "whose",
)

# Source markers used in triage.
DIRECTORY_SOURCES = ("psychologytoday.com/us/therapists", "psychologytoday.com/us/psychiatrists", "psychologytoday.com/us/treatment-rehab")
DIRECTORY_NAMES = ("find a therapist", "find child therapists")
INDIRECT_PATHS = ("/continuing-education/", "/live-webinars", "/frequently-asked-questions", "/faq", "/news/", "/blog/", "/events/")
PRACTICE_WORDS = ("evaluation", "evaluations", "assessment", "assessments", "diagnostic", "diagnostics", "diagnosis", "autism", "adhd", "clinic", "center")


def contains_any(c: Column, parts: Sequence[str]) -> Column:
    out = F.lit(False)
    for p in parts:
        out = out | c.contains(p)
    return out


def status_class(status: Column) -> Column:
    s = F.coalesce(status.cast("int"), F.lit(0))
    return (
        F.when(s == 0, "network_error").when(s.between(200, 299), "success").when(s == 429, "throttle").when(s.between(300, 399), "redirect")
        .when(s.between(500, 599), "server_error").when(s.between(400, 499), "client_error").otherwise("unknown_error")
    )


# Parts of error texts by kind of failure.
DNS_ERRORS = ("dns error", "lookup address", "nodename nor servname")
CONNECT_ERRORS = ("failed to connect", "connecterror", "connection")


def failure_kind(status: Column, error: Column) -> Column:
    """dns, blocked, not_found, connect or error, the first that applies."""
    e, s = F.lower(F.coalesce(error, F.lit(""))), F.coalesce(status.cast("int"), F.lit(0))
    return (
        F.when(contains_any(e, DNS_ERRORS), "dns").when(s.isin(*BLOCKED_STATUSES), "blocked").when(s == 404, "not_found")
        .when(contains_any(e, CONNECT_ERRORS), "connect").otherwise("error")
    )


def block_reason(status: Column, content: Column, extra: Sequence[str] = ()) -> Column:
    """``status:N`` for a blocking status, else ``marker:x`` for the first marker in the visible text, else empty."""
    markers = [m.strip().lower() for m in (*BLOCK_MARKERS, *extra) if m.strip()]
    v = F.coalesce(content, F.lit(""))
    plain = F.when(v.contains("<") & v.contains(">"), strip_html(F.regexp_replace(v, r"(?is)<!--.*?-->", " "), drop_scripts=True)).otherwise(v)

    def first_marker(text: Column) -> Column:
        out = F.when(F.lit(False), F.lit(""))
        for m in markers:
            out = out.when(text.contains(m), F.lit(f"marker:{m}"))
        return out.otherwise("")

    # the text is computed once and all markers are looked for in it
    marked = let(F.lower(normalize_text(unescape(plain))), first_marker)
    return F.when(status.isin(*BLOCKED_STATUSES), F.concat(F.lit("status:"), status.cast("string"))).otherwise(marked)


def usable(status: Column, content: Column, extra: Sequence[str] = ()) -> Column:
    return (status == 200) & (F.coalesce(content, F.lit("")) != "") & (block_reason(status, content, extra) == "")


def page_role(source_type: Column, title: Column, url: Column, text: Column, has_candidates: Column, words: dict[str, str] = ROLE_WORDS, detail: str = DIRECTORY_DETAIL) -> Column:
    """Struct of the page's role and whether it lets provider and practice records through."""
    hay = normalize_text(F.concat_ws(" ", title, url, F.substring(text, 1, ROLE_TEXT)))
    path = F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1))

    def role(name: str, provider: Column | bool, practice: bool) -> Column:
        provider = F.lit(provider) if isinstance(provider, bool) else provider
        return F.struct(F.lit(name).alias("role"), provider.alias("allow_provider"), F.lit(practice).alias("allow_practice"))

    return (
        F.when(source_type == "licensing_board", role("board", True, True))
        .when(hay.rlike(words["admin_noise"]), role("admin_noise", False, False))
        .when(hay.rlike(words["publication_news"]), role("publication_news", False, False))
        .when(hay.rlike(words["faq_help"]), role("faq_help", False, True))
        .when(hay.rlike(words["directory_listing"]), role("directory_listing", has_candidates & path.rlike(detail), False))
        .when(hay.rlike(words["provider_page"]) & has_candidates, role("provider_page", True, True))
        .when(hay.rlike(words["practice_service"]), role("practice_service", True, True))
        .otherwise(role("unknown", has_candidates, True))
    )


def page_relevant(source_type: Column, role: Column, signals_yes: Column, title: Column, url: Column, pattern: str = PAGE_RELEVANCE) -> Column:
    open_ = role["allow_provider"] | role["allow_practice"]
    return (source_type == "licensing_board") | (open_ & (signals_yes | F.concat_ws(" ", title, url).rlike(pattern)))


def diagnosis(text: Column, condition: str, tests: str = TESTS, gap: int = 80) -> Column:
    """``yes`` where the condition and a test stand within ``gap`` letters, in either order, else ``unclear``."""
    managed = rf"(?i)\bassessment\s*,\s*diagnosis\s+and\s+management\s+of.{{0,60}}\b{condition}\b"
    near = text.rlike(rf"(?i)\b{condition}.{{0,{gap}}}\b{tests}\b") | text.rlike(rf"(?i)\b{tests}.{{0,{gap}}}\b{condition}\b") | text.rlike(managed)
    return F.when(near, "yes").otherwise("unclear")


def diagnosis_quote(text: Column, field: str, tests: str = TESTS, gap: int = 80) -> Column:
    """What shows a diagnosis: the first explicit phrase with its context, else the first mention of the condition, else empty."""
    condition = CONDITIONS[field]
    patterns = (
        rf"(?i)\b{condition}.{{0,{gap}}}\b{tests}\b", rf"(?i)\b{tests}.{{0,{gap}}}\b{condition}\b",
        rf"(?i)\bassessment\s*,\s*diagnosis\s+and\s+management\s+of.{{0,60}}\b{condition}\b", AMBIGUOUS[field],
    )
    return F.coalesce(*(F.nullif(snippet(text, p), F.lit("")) for p in patterns), F.lit(""))


# Words of a board's name or of a profession that tell the licence.
BOARD_LICENSES = (("psychologist", r"psych"), ("advanced_practice_nurse", r"nurs|apn|nurse practitioner"), ("physician_assistant", r"assistant|\bpa\b"), ("physician", r"physician|medical|bme"))


def board_license_type(board: Column, stated: Column) -> Column:
    """Licence of a board's listing by the board's name and the profession it states."""
    both, out = F.lower(F.concat_ws(" ", F.coalesce(board, F.lit("")), stated)), F.when(F.lit(False), "")
    for name, pattern in BOARD_LICENSES:
        out = out.when(both.rlike(pattern), name)
    return out.otherwise("unknown")


def age_groups(text: Column, child: str = CHILD, adult: str = ADULT) -> Column:
    none = F.array().cast("array<string>")
    found = F.concat(
        F.when(text.rlike(child), F.array(F.lit("child"), F.lit("adolescent"))).otherwise(none), F.when(text.rlike(adult), F.array(F.lit("adult"))).otherwise(none)
    )
    return F.when(F.size(found) == 0, F.array(F.lit("unknown"))).otherwise(found)


def telehealth(text: Column, pattern: str = TELEHEALTH) -> Column:
    return F.when(text.rlike(pattern), "yes").otherwise("unknown")


def credential_class(credentials: Column, license_type: Column, classes: Sequence[tuple[str, Sequence[str]]] = CREDENTIAL_CLASSES) -> Column:
    """Class of the first rule one of whose parts occurs anywhere in credentials and licence type."""
    v = F.lower(F.concat_ws(" ", F.coalesce(credentials, F.lit("")), F.coalesce(license_type, F.lit(""))))
    out = F.when(F.lit(False), "")
    for name, parts in classes:
        out = out.when(contains_any(v, parts), name)
    return out.when((F.trim(v) == "pa") | v.contains("physician_assistant"), "PA").when(v.contains("lcsw"), "LCSW").otherwise("")


def license_type(credentials: Column, source_type: Column, types: Sequence[tuple[str, Sequence[str]]] = LICENSE_TYPES) -> Column:
    v = F.lower(F.coalesce(credentials, F.lit("")))
    out = F.when(F.lit(False), "")
    for name, parts in types:
        out = out.when(contains_any(v, parts), name)
    return (
        out.when(F.trim(v) == "pa", "physician_assistant").when(v.contains("lcsw"), "clinical_social_worker")
        .when(source_type == "licensing_board", "board_listing").otherwise("unknown")
    )


def person_name(c: Column, prefixes: Sequence[str] = NAME_PREFIXES, stop_words: Sequence[str] = NAME_STOP_WORDS) -> Column:
    """Whether a text may be a person's name: two to five words of which two are capitalised, no digits, none of the stop words."""
    def words_fit(words: Column) -> Column:
        capitals = F.filter(words, lambda t: t.rlike(r"^['\-]*[A-Z]"))
        return (F.size(words) >= 2) & (F.size(capitals) >= 2) & ~F.arrays_overlap(F.transform(words, F.lower), F.array(*map(F.lit, stop_words)))

    def fits(v: Column) -> Column:
        begins = let(F.lower(v), lambda low: reduce(lambda x, y: x | y, (low.startswith(p) for p in prefixes), F.lit(False)))
        tokens = F.split(v, " ")
        words = F.filter(F.transform(tokens, lambda t: F.regexp_replace(t, r"[^A-Za-z'\-]", "")), lambda t: t != "")
        return F.length(v).between(6, 80) & ~v.contains("|") & ~begins & ~v.rlike(r"[0-9]") & F.size(tokens).between(2, 5) & let(words, words_fit)

    # the text and its words are computed once, however often they are looked at
    return let(normalize_text(c), fits)


def has_contact(*channels: Column) -> Column:
    out = F.lit(False)
    for c in channels:
        out = out | (F.trim(F.coalesce(c, F.lit(""))) != "")
    return out


def directory_source(practice: Column, url: Column) -> Column:
    low = F.lower(normalize_text(practice))
    begins = F.lit(False)
    for p in DIRECTORY_NAMES:
        begins = begins | low.startswith(p)
    return contains_any(F.lower(F.coalesce(url, F.lit(""))), DIRECTORY_SOURCES) | begins


def indirect_source(url: Column, paths: Sequence[str] = INDIRECT_PATHS) -> Column:
    return contains_any(F.lower(F.coalesce(url, F.lit(""))), paths)


def practice_signal(*texts: Column, words: Sequence[str] = PRACTICE_WORDS) -> Column:
    return contains_any(F.lower(F.concat_ws(" ", *texts)), words)


def triage(directory: Column, valid_name: Column, practice: Column, indirect: Column, contact: Column, critical: Column, confidence: Column, missing: Column) -> Column:
    """Review lane of a record, the first that applies; null where none does."""
    return (
        F.when(directory & ~valid_name, "directory_sludge")
        .when(~valid_name & practice, "practice_only_signal")
        .when(valid_name & indirect & (critical <= 1) & (confidence < 0.7), "indirect_provider_signal")
        .when(~contact & (critical == 0) & (confidence < 0.55) & missing, "weak_provider_signal")
    )


# Content types of pages, and the status that a blocking marker stands for.
HTML_TYPES = ("text/html", "application/xhtml+xml")
MARKER_STATUS = 403


def is_html(content_type: Column) -> Column:
    return contains_any(F.lower(F.coalesce(content_type, F.lit(""))), HTML_TYPES)


def status_in_error(error: Column) -> Column:
    """The status code that an error text speaks of; 0 if none."""
    return F.coalesce(F.regexp_extract(F.coalesce(error, F.lit("")), r"(?i)\bstatus code[: ]+(\d{3})\b", 1).try_cast("int"), F.lit(0))


def first_positive(*values: Column) -> Column:
    """The first value that is a positive whole number; 0 if none is."""
    ints = [v.try_cast("int") for v in values]
    return F.coalesce(*(F.when(i > 0, i) for i in ints), F.lit(0))


def status_of_block(reason: Column) -> Column:
    return F.when(reason.startswith("status:"), F.coalesce(F.substring(reason, 8, 10).try_cast("int"), F.lit(0))).when(reason.startswith("marker:"), MARKER_STATUS).otherwise(0)


def seed_status(quarantined: Column, failed: Column, stopped: Column, successes: Column, fetched: Column) -> Column:
    """How a seed's crawl ended."""
    nothing = (successes == 0) & (fetched == 0)
    return (
        F.when(quarantined, "quarantined").when(failed & nothing, "failed").when(stopped & nothing, "stopped")
        .when(successes > 0, F.when(stopped | failed, "partial").otherwise("completed")).when(fetched > 0, "partial").otherwise("empty")
    )
