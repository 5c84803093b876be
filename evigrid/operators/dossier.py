"""Account dossiers: labels, names, quotes and contact plans as column expressions over grouped records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.signals import contains_any
from ..functions.text import let, normalize_text, slug, unescape, unique_nonempty

# Labels of an account's focus, buyer, budget and state.
FOCUS = {"both": "ASD and ADHD evaluations", "asd": "Autism evaluations", "adhd": "ADHD evaluations", "none": "Developmental and behavioral services"}
DIAGNOSTIC_FOCUS = {
    "both": "ASD and ADHD diagnostic services", "asd": "autism diagnostic services", "adhd": "ADHD diagnostic services", "none": "developmental and behavioral evaluation services",
}
BUYERS = (
    (("md", "do"), "medical director or practice owner"), (("psyd", "phd"), "clinical director or practice owner"), (("apn", "np", "pa"), "clinical lead or practice administrator"),
)
OTHER_BUYER = "practice administrator or intake lead"
BUDGETS = ("Enterprise / multi-site", "Institutional / specialty program", "Regional / growing group", "Single-site / owner-led")
LARGE_NAMES, INSTITUTION_NAMES = ("hospital", "health system", "barnabas"), ("rutgers", "university", "college", "school of", "gsapp")
ROLES = ((("md", "do"), "medical director"), (("psyd", "phd"), "clinical lead / psychologist"))
FACULTY_ROLE, OTHER_ROLE = "clinical lead / faculty clinician", "practice lead"
FACULTY_SITES, FACULTY_NAMES = ("rutgers",), ("psychology", "clinic", "autism")
# First path segments below which an account is named by more than two.
DEEP_SEGMENT, DEEP_SEGMENTS = "treatment-care", 4
FIELD_LABELS = {
    "diagnoses_asd": "autism-diagnosis capability", "diagnoses_adhd": "ADHD-diagnosis capability", "license_status": "license status", "prescriptive_authority": "prescriptive authority",
}

# Words that end or spoil a contact's or provider's name.
CONTACT_STOPS = ("and", "faculty", "member", "recognized", "work", "in", "new", "jersey", "co", "director", "learn", "more", "licensed", "psychologist", "stay")
LEADING_NOISE = ("center", "clinic", "psychology", "behavioral", "hospital", "associates", "group", "state", "garden")
TAIL_NOISE = ("director", "associate", "assistant", "professor", "teaching", "clinical", "training", "research", "program", "school", "initiatives", "department", "and", "at", "dr")

# What a quote must not hold, and the points of review sources.
QUOTE_ENUMS, QUOTE_BOILERPLATE = ("yes", "no", "unknown", "unclear"), ("clinics and services", "profiles, and achievements", "leading provider of compassionate, quality")
LEAST_QUOTE, MOST_QUOTE = 24, 180
POSITIVE_SOURCES = ("evaluation", "evaluations", "assessment", "assessments", "autism", "adhd", "clinic", "clinics", "center", "services", "diagnostic", "developmental")
NEGATIVE_SOURCES = (
    "frequently asked questions", "faq", "healthier me", "approach-to-treatment", "approach to treatment", "before-your-assessment", "before your assessment", "billing",
    "insurance", "directions", "resources", "news", "blog",
)
POSITIVE_POINTS, NEGATIVE_POINTS, LEAST_PRIORITY = 8, -12, 8
STREETS, DIRECTIONS = (" road ", " avenue ", " ave ", " street ", " blvd ", " boulevard ", " drive ", " lane "), ("new", "west", "east", "north", "south")


def _text(c: Column) -> Column:
    return normalize_text(c)


def _by_condition(asd: Column, adhd: Column, labels: dict[str, str]) -> Column:
    return F.when(asd & adhd, labels["both"]).when(asd, labels["asd"]).when(adhd, labels["adhd"]).otherwise(labels["none"])


def diagnostic_focus(asd: Column, adhd: Column) -> Column:
    return _by_condition(asd == "yes", adhd == "yes", DIAGNOSTIC_FOCUS)


def service_focus(any_asd: Column, any_adhd: Column, name_and_sources: Column) -> Column:
    """Focus of a group: what its rows show, or what its name and sources speak of."""
    low = F.lower(name_and_sources)
    return _by_condition(any_asd | contains_any(low, ("autism", "asd")), any_adhd | low.contains("adhd"), FOCUS)


def _first_rule(credentials: Column, rules: Sequence[tuple[Sequence[str], str]]) -> Column:
    low = F.lower(F.coalesce(credentials, F.lit("")))
    out = F.when(F.lit(False), "")
    for parts, label in rules:
        out = out.when(contains_any(low, parts), label)
    return out


def target_buyer(credentials: Column) -> Column:
    return _first_rule(credentials, BUYERS).otherwise(OTHER_BUYER)


def contact_role(credentials: Column, website: Column, practice: Column) -> Column:
    faculty = contains_any(F.lower(F.coalesce(website, F.lit(""))), FACULTY_SITES) | contains_any(F.lower(F.coalesce(practice, F.lit(""))), FACULTY_NAMES)
    return _first_rule(credentials, ROLES).when(faculty, FACULTY_ROLE).otherwise(OTHER_ROLE)


def budget(practice: Column, website: Column, contacts: Column, locations: Column) -> Column:
    name, both = F.lower(F.coalesce(practice, F.lit(""))), F.lower(F.concat_ws(" ", practice, website))
    return (
        F.when((contacts >= 4) | (locations >= 3) | contains_any(name, LARGE_NAMES), BUDGETS[0]).when(contains_any(both, INSTITUTION_NAMES), BUDGETS[1])
        .when((contacts >= 2) | (locations >= 2), BUDGETS[2]).otherwise(BUDGETS[3])
    )


def qa_state(any_approved: Column, any_ready: Column, review_types: Column, any_queued: Column) -> Column:
    return (
        F.when(any_approved & any_ready, "approved_outreach_ready").when(any_approved, "approved").when(F.array_contains(review_types, "practice_only_signal"), "practice_signal")
        .when(F.array_contains(review_types, "indirect_provider_signal"), "indirect_provider_signal").when(any_queued, "under_review").otherwise("candidate")
    )


def display_state(c: Column) -> Column:
    v = F.regexp_replace(F.trim(F.coalesce(c, F.lit(""))), "_", " ")
    return F.when(v == "", "unknown").otherwise(F.concat(F.upper(F.substring(v, 1, 1)), F.substring(v, 2, 10_000)))


def quote(c: Column, least: int = LEAST_QUOTE, most: int = MOST_QUOTE) -> Column:
    """A quote fit to be shown, cut at a word; empty if it is an enum, too short, or begins in the middle of a sentence."""
    def fit(v: Column) -> Column:
        low = F.lower(v)
        bad = (v == "") | low.isin(*QUOTE_ENUMS) | (F.length(v) < least) | v.contains("&n") | v.endswith("&") | v.rlike(r"^\p{Ll}") | contains_any(low, QUOTE_BOILERPLATE)
        cut = F.concat(F.regexp_replace(F.substring(v, 1, most - 3), r" [^ ]*$", ""), F.lit("..."))
        return F.when(bad, "").when(F.length(v) > most, cut).otherwise(v)

    return let(_text(unescape(_text(c))), fit)


def evidence_summary(evidence: Column, fields: Sequence[str] = tuple(FIELD_LABELS)) -> Column:
    """The first showable quotes of the fields in order, three at most."""
    def first_of(field: str) -> Column:
        return quote(F.try_element_at(F.filter(evidence, lambda e: e["field"] == field), F.lit(1))["quote"])

    return let(F.array(*(first_of(f) for f in fields)), lambda firsts: F.array_join(F.slice(F.filter(F.array_compact(firsts), lambda x: x != ""), 1, 3), " | "))


def _until(tokens: Column, stop) -> Column:
    """Tokens before the first that stops."""
    start = F.struct(F.array().cast("array<string>").alias("kept"), F.lit(True).alias("on"))
    return F.aggregate(tokens, start, lambda s, t: let(s["on"] & ~stop(t), lambda on: F.struct(F.when(on, F.concat(s["kept"], F.array(t))).otherwise(s["kept"]).alias("kept"), on.alias("on"))))["kept"]


def contact_name(c: Column) -> Column:
    """Two or three words of a person's name, ended by the first word that is none; empty for fewer."""
    tokens = F.filter(F.transform(F.split(_text(F.regexp_replace(c, r"Dr\.? ", "")), " "), lambda t: F.regexp_replace(t, r"^[ ,.;:\-]+|[ ,.;:\-]+$", "")), lambda t: t != "")

    def named(kept: Column) -> Column:
        twice = (F.size(kept) == 3) & ((F.try_element_at(kept, F.lit(1)) == F.try_element_at(kept, F.lit(-1))) | (F.try_element_at(kept, F.lit(2)) == F.try_element_at(kept, F.lit(-1))))
        return F.when(F.size(kept) < 2, "").when(twice, F.array_join(F.slice(kept, 1, 2), " ")).otherwise(F.array_join(kept, " "))

    # fewer than two words leave fewer than two
    return let(F.slice(F.filter(_until(tokens, lambda t: F.lower(t).isin(*CONTACT_STOPS)), lambda t: ~t.rlike(r"^[a-z]$")), 1, 3), named)


def provider_name(c: Column) -> Column:
    """A provider's name without words of places before it and of positions after it; four words at most."""
    tokens = F.split(F.regexp_replace(_text(c), r"Dr\. ", ""), " ")

    def named(lead: Column) -> Column:
        rest = _until(F.slice(lead, 3, 100), lambda t: F.lower(F.regexp_replace(t, r"^[.,]+|[.,]+$", "")).isin(*TAIL_NOISE))
        return F.array_join(F.slice(F.concat(F.slice(lead, 1, 2), rest), 1, 4), " ")

    lead = F.aggregate(tokens, F.array().cast("array<string>"), lambda kept, t: F.when((F.size(kept) == 0) & F.lower(F.regexp_replace(t, r"^\.+|\.+$", "")).isin(*LEADING_NOISE), kept).otherwise(F.concat(kept, F.array(t))))
    return let(lead, named)


def credentials(c: Column) -> Column:
    return F.array_join(F.slice(unique_kept(F.split(_text(c), ",")), 1, 3), ", ")


def unique_kept(values: Column) -> Column:
    return F.filter(F.transform(values, lambda x: F.trim(x)), lambda x: x != "")


def canonical_name(c: Column) -> Column:
    words = F.filter(F.transform(F.split(F.lower(_text(c)), " "), lambda w: F.regexp_replace(w, r"^\.+|\.+$", "")), lambda w: w != "")
    return F.when(F.size(words) >= 2, F.concat_ws(" ", F.element_at(words, 1), F.element_at(words, -1))).otherwise(F.array_join(words, " "))


def market_city(c: Column) -> Column:
    """A city without the street before it."""
    v = _text(c)
    words = F.split(v, " ")
    pair = F.lower(F.try_element_at(words, F.lit(-2))).isin(*DIRECTIONS)
    street = contains_any(F.concat(F.lit(" "), F.lower(v), F.lit(" ")), STREETS)
    return F.when(~street, v).when(F.coalesce(pair, F.lit(False)), F.array_join(F.slice(words, -2, 2), " ")).otherwise(F.element_at(words, -1))


def source_priority(practice: Column, url: Column) -> Column:
    low = F.lower(F.concat_ws(" ", practice, url))
    return sum((F.when(low.contains(m), p).otherwise(0) for ms, p in ((POSITIVE_SOURCES, POSITIVE_POINTS), (NEGATIVE_SOURCES, NEGATIVE_POINTS)) for m in ms), F.lit(0))


def account_key(url: Column) -> Column:
    """Domain and the leading path segments that name an account: two, or more below a deep segment."""
    host = F.lower(F.regexp_extract(F.trim(F.coalesce(url, F.lit(""))), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))
    path = F.lower(F.regexp_extract(F.trim(F.coalesce(url, F.lit(""))), r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1))
    parts = F.filter(F.split(path, "/"), lambda s: F.trim(s) != "")
    deep = (F.coalesce(F.try_element_at(parts, F.lit(1)), F.lit("")) == DEEP_SEGMENT) & (F.size(parts) >= DEEP_SEGMENTS)
    scope = F.when(deep, F.slice(parts, 1, DEEP_SEGMENTS)).otherwise(F.slice(parts, 1, 2))
    return F.when(F.size(parts) == 0, F.when(host == "", "review-only").otherwise(host)).otherwise(F.array_join(F.concat(F.array(host), scope), "::"))


def review_note(c: Column) -> Column:
    """A review's reason in words."""
    v = _text(c)
    low = F.lower(v)
    fields = unique_kept(F.split(F.regexp_extract(low, r"missing_critical:(.*)$", 1), ","))
    label = F.create_map(*(F.lit(x) for kv in FIELD_LABELS.items() for x in kv))
    named = F.array_join(F.transform(fields, lambda f: F.coalesce(F.element_at(label, f), F.regexp_replace(f, "_", " "))), ", ")
    return (
        F.when(low.contains("no named clinician"), "The service is shown; no clinician is verified yet.").when(low.contains("practice-only signal") | (low == "practice_only_signal"), "Account research only; no clinician is verified yet.")
        .when(F.size(fields) > 0, F.concat(F.lit("Clinicians are named; still to be verified: "), named, F.lit(".")))
        .when(low.contains("low_confidence"), "Clinicians are named; the record is still to be verified.").otherwise(v)
    )


def operating_signals(rows: dict[str, Column]) -> Column:
    """What an account publishes, in order."""
    def has(name: str) -> Column:
        return F.trim(F.coalesce(rows[name], F.lit(""))) != ""

    notes = [let(quote(rows[n], 1, 130), lambda q, label=label: F.when(q != "", F.concat(F.lit(f"{label}: "), q))) for n, label in (("referral", "Referrals"), ("insurance", "Insurance"), ("waitlist", "Scheduling"))]
    return F.array_compact(F.array(F.when(has("website"), "Website"), F.when(has("intake_url"), "Online intake"), F.when(rows["telehealth"] == "yes", "Telehealth"), *notes, F.when(has("phone"), "Phone")))


def best_channel(role: Column, website: Column, intake: Column, phone: Column) -> Column:
    """How to reach a role: the phone for those who answer it, else the form, the site, the phone."""
    def has(c: Column) -> Column:
        return F.trim(F.coalesce(c, F.lit(""))) != ""

    answers = contains_any(F.lower(role), ("intake", "administrator"))
    return F.when(answers & has(phone), "Phone").when(has(intake), "Website form").when(has(website), "Website / contact form").when(has(phone), "Phone").otherwise("Manual research")


def playbook(name: Column, role: Column, state: Column, website: Column, intake: Column, phone: Column) -> Column:
    """Contacts to approach, four at most, each role once: the named clinician, operations, intake, and the owner where the account isn't ready."""
    def contact(who: Column, what: Column, influence: str) -> Column:
        return F.struct(who.alias("name"), what.alias("role"), F.lit(influence).alias("influence"), best_channel(what, website, intake, phone).alias("best_channel"))

    rows = F.array_compact(F.array(
        F.when(F.coalesce(name, F.lit("")) != "", contact(name, role, "High")), contact(F.lit("Practice Administrator (inferred)"), F.lit("operations / admin lead"), "High"),
        contact(F.lit("Intake / Referral Coordinator (inferred)"), F.lit("front-line workflow owner"), "Medium"),
        F.when(state != "approved_outreach_ready", contact(F.lit("Owner / Budget Holder (inferred)"), F.lit("economic buyer"), "High")),
    ))
    return F.slice(rows, 1, 4)


def review_accounts(reviews: DataFrame, limit: int) -> DataFrame:
    """Review-only accounts: promising sources of the first reviews, one row per account with its sources."""
    c = F.col
    first = reviews.orderBy(F.desc("created_at"), "review_id").limit(max(limit * 4, 20))
    kept = first.where(c("review_type").isin("missing_provider", "practice_only_signal") & (F.trim("practice_name") != "") & (F.trim("source_url") != ""))
    kept = kept.where(source_priority(c("practice_name"), c("source_url")) >= LEAST_PRIORITY)
    keyed = kept.withColumn("account", F.concat(F.lit("review-only:"), slug(account_key(c("source_url")))))
    return keyed.groupBy("account").agg(F.min("practice_name").alias("practice_name"), unique_nonempty(F.array_sort(F.collect_set("source_url"))).alias("sources"), F.count("*").alias("reviews"))


def email_guesses(name: Column, domain: Column) -> Column:
    """Three usual addresses of a person at a domain; none without two names."""
    words = F.split(F.regexp_replace(F.lower(_text(name)), r"[^a-z ]", ""), " +")
    a, b = F.element_at(words, 1), F.element_at(words, -1)
    all_ = F.array(F.concat(a, F.lit("."), b, F.lit("@"), domain), F.concat(F.substring(a, 1, 1), b, F.lit("@"), domain), F.concat(a, F.lit("@"), domain))
    return F.when((F.size(words) >= 2) & (F.coalesce(domain, F.lit("")) != ""), all_).otherwise(F.array().cast("array<string>"))
