"""Bundles, accounts and review-only accounts: the frames of an export, and their documents as text columns."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import format_phone, slug, unique_nonempty
from . import dossier, export
from .graph import cut
from .score import score_base

# How many candidates, reviews, briefs, links and items an account takes.
CANDIDATES_PER_ROW, LEAST_CANDIDATES = 3, 15
REVIEWS_PER_ROW, LEAST_REVIEWS = 4, 20
BRIEFED_LINKS, BRIEFS, LINKS, QUOTES, ITEMS = 10, 3, 10, 3, 4
BRIEF_LETTERS, TITLE_LETTERS = 170, 120
# Confidence and fit of accounts that are for review only.
REVIEW_CONFIDENCE = {"practice_only_signal": 0.18, "missing_provider": 0.22}
REVIEW_FIT_ASD, REVIEW_FIT = 0.24, 0.16
# Columns of the record export and of the sales export, in order.
RECORD_COLUMNS = (
    "record_id", "provider_id", "provider_name", "credentials", "npi", "license_state", "license_type", "license_status", "practice_name", "city", "state", "metro", "phone", "website", "intake_url",
    "diagnoses_asd", "diagnoses_adhd", "prescriptive_authority", "prescriptive_basis", "age_groups", "telehealth", "insurance_notes", "waitlist_notes", "referral_requirements", "source_urls",
    "field_confidence", "record_confidence", "outreach_fit_score", "outreach_ready", "outreach_reasons", "last_verified_at",
)
SALES_COLUMNS = (
    "record_id", "provider_name", "credentials", "practice_name", "city", "state", "metro", "phone", "website", "intake_url", "diagnoses_asd", "diagnoses_adhd", "license_status",
    "prescriptive_authority", "record_confidence", "outreach_fit_score", "target_buyer", "outreach_angle", "opener", "evidence_summary", "source_urls",
)
CONFIDENCE_FIELDS = ("diagnoses_asd", "diagnoses_adhd", "license_status", "prescriptive_authority")
NOTE_FIELDS = ("referral_requirements", "insurance_notes", "waitlist_notes")

c = F.col


def _or(column: str, other: str) -> Column:
    return F.coalesce(F.nullif(F.trim(c(column)), F.lit("")), F.lit(other))


def base(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Decided records with the columns of their provider, practice and place."""
    rows = tables["decided"] if "decided" in tables else score_base(tables, "left")
    rows = rows.withColumn("practice_name", c("practice_name_snapshot")).withColumn("state", c("location_state"))
    if "final_confidence" in rows.columns:
        rows = rows.withColumn("record_confidence", c("final_confidence"))
    return rows


def approved(tables: Mapping[str, DataFrame], limit: int) -> DataFrame:
    """The first approved records by fit, confidence, name and id, with the columns of the record export."""
    rows = base(tables).where("export_status = 'approved'")
    rows = export.top(rows, [F.desc("outreach_fit_score"), F.desc("record_confidence"), c("provider_name"), c("record_id")], limit)
    confidence = F.to_json(F.struct(*(c(f"conf_{f}").alias(f) for f in sorted(CONFIDENCE_FIELDS))))
    return rows.withColumns({"field_confidence": confidence, **{n: _or(n, "unknown") for n in ("insurance_notes", "waitlist_notes", "referral_requirements")}}).select(*RECORD_COLUMNS)


def bundles(records: DataFrame, evidence: DataFrame, contradictions: DataFrame) -> DataFrame:
    """Each record with its evidence, by field and time, and its contradictions, by field, as arrays."""
    shown = evidence.groupBy("record_id").agg(F.array_sort(F.collect_list(F.struct("field_name", "captured_at", "evidence_id", "field_value", "quote", "source_url", "source_tier"))).alias("evidence"))
    unlike = contradictions.groupBy("record_id").agg(F.array_sort(F.collect_list(F.struct("field_name", "contradiction_id", "preferred_value", "conflicting_value", "preferred_source_url", "conflicting_source_url", "note"))).alias("contradictions"))
    out = records.join(shown, "record_id", "left").join(unlike, "record_id", "left")
    return out.withColumns({n: F.coalesce(n, F.array().cast(out.schema[n].dataType)) for n in ("evidence", "contradictions")})


def latest_documents(documents: DataFrame, urls: DataFrame | None = None) -> DataFrame:
    """The latest content of each address (``source_url``, ``content``), of those in ``urls`` only where given."""
    rows = documents if urls is None else documents.join(urls.select("source_url").distinct(), "source_url", "left_semi")
    return rows.groupBy("source_url").agg(F.max_by("content", F.struct("fetched_at", F.sha2("content", 256))).alias("content"))


def briefs(documents: DataFrame) -> DataFrame:
    """``source_url``, ``summary``: what a page says of itself, its description or else its title."""
    content = F.coalesce(c("content"), F.lit(""))
    described = [F.regexp_extract(content, rf"""(?i)<meta[^>]+{k}[^>]+content=["']([^"']+)""", 1) for k in ("""name=["']description["']""", """property=["']og:description["']""")]
    title = F.regexp_extract(content, r"(?is)<title>(.*?)</title>", 1)
    told = F.coalesce(F.nullif(dossier.quote(F.when(described[0] != "", described[0]).otherwise(described[1]), 1, BRIEF_LETTERS), F.lit("")), dossier.quote(title, 1, TITLE_LETTERS))
    return documents.select("source_url", told.alias("summary")).where("summary <> ''")


def sales_rows(bundled: DataFrame) -> DataFrame:
    """Records that are ready for outreach with buyer, angle, opener and evidence."""
    focus = dossier.diagnostic_focus(c("diagnoses_asd"), c("diagnoses_adhd"))
    angle = (
        F.when(c("telehealth") == "yes", F.concat(F.lit("Referral capture and telehealth scheduling for "), focus))
        .when(_or("referral_requirements", "unknown") != "unknown", F.concat(F.lit("Published referral requirements: faster routing for "), focus))
        .otherwise(F.concat(F.lit("Demand, intake and referral visibility for "), focus))
    )
    place = F.when(F.trim(F.coalesce("city", F.lit(""))) != "", F.concat(F.lit(" in "), F.trim("city"))).otherwise("")
    items = F.transform("evidence", lambda e: F.struct(e["field_name"].alias("field"), e["quote"].alias("quote")))
    rows = bundled.where("outreach_ready = 1").withColumns({
        "target_buyer": dossier.target_buyer(c("credentials")), "outreach_angle": angle, "opener": F.concat(F.trim("practice_name"), place, F.lit(": "), focus, F.lit(" are advertised.")),
        "evidence_summary": dossier.evidence_summary(items),
        "source_urls": F.array_sort(F.array_distinct(F.filter(F.transform("evidence", lambda e: e["source_url"]), lambda u: F.coalesce(u, F.lit("")) != ""))),
    })
    return rows.select(*SALES_COLUMNS)


def _assembled(rows: DataFrame, group: str, priority: Column) -> DataFrame:
    """One row per group: its first row and what all its rows show, the parts of a dossier that need no other table."""
    order = F.struct(-priority, -c("outreach_fit_score"), -c("record_confidence"), c("practice_name"), c("record_id"), c("source_url"))
    ranked = rows.withColumns({"_o": order, "_contact": dossier.contact_name(c("provider_name"))})
    none = F.array().cast("array<string>")
    keep = [n for n in rows.columns if n != group]
    # shortest spelling of each canonical name, in order of first appearance
    named = ranked.where("_contact <> ''").groupBy(group, dossier.canonical_name(c("_contact")).alias("_k")).agg(F.min("_o").alias("_o"), F.min_by("_contact", F.struct(F.length("_contact"), "_o")).alias("_contact"))
    names = named.groupBy(group).agg(F.array_sort(F.collect_list(F.struct("_o", "_contact"))).alias("_n")).select(group, F.transform("_n", lambda x: x["_contact"]).alias("names"))
    label = F.array_join(F.filter(F.array(F.trim("city"), F.trim("location_state")), lambda x: x != ""), ", ")
    places = ranked.withColumn("_l", label).where("_l <> ''").groupBy(group, "_l").agg(F.min("_o").alias("_o"))
    places = places.groupBy(group).agg(F.array_sort(F.collect_list(F.struct("_o", "_l"))).alias("_p")).select(group, F.transform("_p", lambda x: x["_l"]).alias("places"))
    links = ranked.withColumn("_u", F.explode("source_urls")).where("_u <> ''").groupBy(group, "_u").agg(F.min("_o").alias("_o"))
    links = links.groupBy(group).agg(F.array_sort(F.collect_list(F.struct("_o", "_u"))).alias("_s")).select(group, F.transform("_s", lambda x: x["_u"]).alias("links"))
    rolled = ranked.groupBy(group).agg(
        F.min_by(F.struct(*keep), c("_o")).alias("_r"), F.bool_or(c("diagnoses_asd") == "yes").alias("any_asd"), F.bool_or(c("diagnoses_adhd") == "yes").alias("any_adhd"),
        F.bool_or(c("export_status") == "approved").alias("any_approved"), F.bool_or(c("outreach_ready") == 1).alias("any_ready"), F.bool_or(c("review_status") == "queued").alias("any_queued"),
        F.count_distinct(F.lower(F.trim("city")), F.lower(F.trim("location_state")), F.trim("phone")).alias("sites"),
    )
    out = rolled.select(group, "_r.*", "any_asd", "any_adhd", "any_approved", "any_ready", "any_queued", "sites")
    for part, name in ((names, "names"), (places, "places"), (links, "links")):
        out = out.join(part, group, "left").withColumn(name, F.coalesce(name, none))
    return out


def dossiers(rows: DataFrame, group: str, reviews: DataFrame | None, documents: DataFrame | None, priority: Column | None = None) -> DataFrame:
    """One account per group with all that its dossier says.

    ``rows`` have the columns of ``base`` and ``evidence`` (array). ``reviews`` has the group,
    ``review_types`` and ``review_notes``. Identity and contact channels are those of the first row;
    names, places, links, focus and state come from all rows; quotes from the first row's evidence,
    then from what the linked pages say of themselves.
    """
    none = F.array().cast("array<string>")
    # accounts are few, and each part is written so that what is made of it does not repeat its plan
    one = cut(_assembled(cut(rows), group, F.lit(0) if priority is None else priority))
    if reviews is not None:
        one = one.join(reviews, group, "left")
    else:
        one = one.withColumns({"review_types": none, "review_notes": none})
    one = one.withColumns({n: F.coalesce(n, none) for n in ("review_types", "review_notes")})
    shown = F.filter(F.transform("evidence", lambda e: e["source_url"]), lambda u: F.coalesce(u, F.lit("")) != "")
    one = cut(one.withColumn("evidence_links", F.array_distinct(F.concat("links", shown))))
    if documents is not None:
        wanted = one.select(group, F.posexplode(F.slice("evidence_links", 1, BRIEFED_LINKS)).alias("at", "source_url"))
        told = wanted.join(briefs(latest_documents(documents, wanted)), "source_url")
        told = told.groupBy(group).agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "source_url", "summary"))), lambda x: F.struct(x["source_url"].alias("url"), x["summary"].alias("summary"))).alias("source_briefs"))
        one = one.join(told, group, "left")
    else:
        one = one.withColumn("source_briefs", F.lit(None).cast("array<struct<url:string,summary:string>>"))
    one = one.withColumn("source_briefs", F.coalesce("source_briefs", F.array().cast("array<struct<url:string,summary:string>>")))
    state = dossier.qa_state(c("any_approved"), c("any_ready"), c("review_types"), c("any_queued"))
    quotes = F.transform("evidence", lambda e: dossier.quote(e["quote"]))
    one = cut(one).withColumns({
        "qa_state": state, "service_focus": dossier.service_focus(c("any_asd"), c("any_adhd"), F.concat_ws(" ", "practice_name", F.array_join("source_urls", " "))),
        "budget_band": dossier.budget(c("practice_name"), c("website"), F.size("names"), c("sites")), "role": dossier.contact_role(c("credentials"), c("website"), c("practice_name")),
        "evidence_quotes": F.slice(unique_nonempty(F.concat(quotes, F.transform("source_briefs", lambda b: b["summary"]))), 1, QUOTES),
        "operating_signals": dossier.operating_signals({n: c(k) for n, k in (("website", "website"), ("intake_url", "intake_url"), ("telehealth", "telehealth"), ("phone", "phone"), ("referral", "referral_requirements"), ("insurance", "insurance_notes"), ("waitlist", "waitlist_notes"))}),
        "fit_score": F.round(F.coalesce("outreach_fit_score", F.lit(0.0)) * 100).cast("int"), "confidence_score": F.round(F.coalesce("record_confidence", F.lit(0.0)) * 100).cast("int"),
    })
    first = F.coalesce(F.try_element_at("names", F.lit(1)), F.lit(""))
    titled = F.when(first == "", "").otherwise(F.concat(first, F.when(F.trim(F.coalesce("credentials", F.lit(""))) == "", "").otherwise(F.concat(F.lit(", "), F.trim("credentials")))))
    one = cut(one)
    one = one.withColumn("contacts", dossier.playbook(titled, c("role"), c("qa_state"), c("website"), c("intake_url"), c("phone")))
    one = cut(one)
    best = F.coalesce(F.nullif(dossier.evidence_summary(F.transform("evidence", lambda e: F.struct(e["field_name"].alias("field"), e["quote"].alias("quote")))), F.lit("")), F.try_element_at("source_briefs", F.lit(1))["summary"])
    why = F.array_compact(F.array(
        F.concat(F.lit("Shown in public: "), F.lower("service_focus"), F.lit("; fit "), c("fit_score").cast("string"), F.lit("/100, confidence "), c("confidence_score").cast("string"), F.lit("/100.")),
        F.when(c("license_status") == "active", "The licence is active."), F.when((_or("intake_url", "") != "") | (_or("referral_requirements", "") != ""), "Intake or referral is published."),
        F.when(c("qa_state") == "practice_signal", "A signal of the practice only: speak of operations, not of clinicians."), F.when(best.isNotNull(), F.concat(F.lit("Best evidence: "), best)),
    ))
    lead = F.try_element_at("contacts", F.lit(1))
    sequence = F.array(
        F.concat(F.lit("Start with "), lead["name"], F.lit(" at "), c("practice_name"), F.lit(" by "), lead["best_channel"], F.lit(".")), F.lit("Go on with the clinical lead and evidence of the service."),
        F.when(c("qa_state") == "approved_outreach_ready", "Bring in the owner once the need is confirmed.").otherwise("Claim little until a named clinician is confirmed."), F.lit("Speak of budgets last."),
    )
    return one.select(
        group, F.concat_ws("-", group, slug(c("practice_name"))).alias("account_id"), F.trim("practice_name").alias("practice_name"), dossier.market_city(c("city")).alias("city"),
        F.trim("location_state").alias("state"), F.trim("metro").alias("metro"), F.trim("website").alias("website"), F.trim("intake_url").alias("intake_url"), format_phone(c("phone")).alias("phone"),
        "fit_score", "confidence_score", "qa_state", "budget_band", "service_focus", F.size("names").alias("provider_count"), F.slice("names", 1, ITEMS).alias("named_providers"),
        F.size("places").alias("location_count"), F.slice("places", 1, ITEMS).alias("locations"), "operating_signals", F.slice(why, 1, ITEMS).alias("why_this_lead_matters"), "contacts",
        sequence.alias("recommended_sequence"), F.slice("evidence_links", 1, LINKS).alias("evidence_links"), "evidence_quotes", F.slice("source_briefs", 1, BRIEFS).alias("source_briefs"),
        F.array_sort(F.array_distinct("review_types")).alias("review_types"), F.slice(unique_nonempty(c("review_notes")), 1, ITEMS).alias("review_notes"),
        lead["name"].alias("primary_contact"), lead["best_channel"].alias("best_channel"),
    )


def approved_dossiers(tables: Mapping[str, DataFrame], limit: int) -> DataFrame:
    """Accounts of approved records, by practice; candidates are cut before they are grouped."""
    rows = export.top(base(tables).where("export_status = 'approved'"), [F.desc("outreach_fit_score"), F.desc("record_confidence"), c("practice_name"), c("record_id")], max(limit * CANDIDATES_PER_ROW, LEAST_CANDIDATES))
    rows = bundles(rows, tables["field_evidence"], tables["contradictions"]).withColumn("source_url", F.coalesce(F.try_element_at("source_urls", F.lit(1)), F.lit("")))
    return dossiers(rows, "practice_id", None, tables.get("source_documents"))


def review_only(tables: Mapping[str, DataFrame], limit: int) -> DataFrame:
    """Accounts for review only: what was extracted at promising sources of the first reviews, grouped by account."""
    reviews = tables["review_queue"]
    first = reviews.orderBy(F.desc("created_at"), "review_id").limit(max(limit * REVIEWS_PER_ROW, LEAST_REVIEWS))
    held = first.where(c("review_type").isin(*REVIEW_CONFIDENCE) & (F.trim("practice_name") != "") & (F.trim("source_url") != ""))
    held = held.withColumns({"source_url": F.trim("source_url"), "priority": dossier.source_priority(c("practice_name"), c("source_url"))}).where(c("priority") >= dossier.LEAST_PRIORITY)
    held = held.withColumn("account", F.concat(F.lit("review-only:"), slug(dossier.account_key(c("source_url")))))
    # one review stands for an account and source: the first in the queue's order
    held = held.groupBy("account", "source_url").agg(F.min_by(F.struct("practice_name", "review_type", "priority"), F.struct(-F.unix_micros(c("created_at").cast("timestamp")), "review_id")).alias("r")).select("account", "source_url", "r.*")
    found = tables["assigned"].select("source_url", *(n for n in ("phone", "intake_url", "city", "state", "metro", "diagnoses_asd", "diagnoses_adhd", *NOTE_FIELDS)))
    rows = held.join(found, "source_url").withColumns({
        "record_id": F.lit(""), "provider_name": F.lit(""), "credentials": F.lit(""), "website": c("source_url"), "location_state": c("state"), "telehealth": F.lit("unknown"), "license_status": F.lit("unknown"),
        "waitlist_notes": F.lit(""), "outreach_ready": F.lit(0), "review_status": F.lit("queued"), "export_status": F.lit("review_only"), "source_urls": F.array("source_url"),
        "record_confidence": F.when(c("review_type") == "practice_only_signal", REVIEW_CONFIDENCE["practice_only_signal"]).otherwise(REVIEW_CONFIDENCE["missing_provider"]),
        "outreach_fit_score": F.when(c("diagnoses_asd") == "yes", REVIEW_FIT_ASD).otherwise(REVIEW_FIT),
        "evidence": F.filter(F.array(*(F.struct(F.lit(n).alias("field_name"), F.trim(n).alias("field_value"), dossier.quote(c(n)).alias("quote"), c("source_url").alias("source_url")) for n in NOTE_FIELDS)), lambda e: e["quote"] != ""),
    })
    said = rows.select("account", "source_url").distinct().join(reviews.withColumn("source_url", F.trim("source_url")), "source_url").dropDuplicates(["account", "review_id"])
    notes = said.groupBy("account").agg(F.array_sort(F.collect_list(F.struct("review_id", "review_type", dossier.review_note(c("reason")).alias("note")))).alias("r"))
    notes = notes.select("account", F.transform("r", lambda x: x["review_type"]).alias("review_types"), F.transform("r", lambda x: x["note"]).alias("review_notes"))
    return dossiers(rows, "account", notes, tables.get("source_documents"), c("priority"))


def exports(tables: Mapping[str, DataFrame], limit: int = 100) -> dict[str, DataFrame]:
    """All frames of an export: ``records``, ``sales``, ``review_queue``, ``dossiers``, ``internal_review``, ``bundles``.

    Records, and so their bundles and sales rows, are the first ``limit``; the queue is whole.
    """
    records = cut(approved(tables, limit))
    full = cut(bundles(base(tables).join(records.select("record_id"), "record_id", "left_semi"), tables["field_evidence"], tables["contradictions"]))
    return {
        "records": records, "bundles": full, "sales": sales_rows(full), "review_queue": tables["review_queue"].orderBy(F.desc("created_at"), "review_id"),
        "dossiers": approved_dossiers(tables, limit), "internal_review": review_only(tables, limit),
    }


# ---------------------------------------------------------------- documents


def _section(title: str, lines: Column, otherwise: str) -> Column:
    body = F.when(F.size(lines) > 0, F.array_join(F.transform(lines, lambda x: F.concat(F.lit("- "), x)), "\n")).otherwise(f"- {otherwise}")
    return F.concat(F.lit(f"\n## {title}\n"), body)


def _facts(title: str, **facts: Column) -> Column:
    return _section(title, F.array(*(F.concat(F.lit(f"{k.replace('_', ' ').capitalize()}: "), F.coalesce(F.nullif(v.cast("string"), F.lit("")), F.lit("unknown"))) for k, v in facts.items())), "")


def _urls(of: str) -> Column:
    return F.array_sort(F.array_distinct(F.filter(F.transform(of, lambda e: e["source_url"]), lambda u: F.coalesce(u, F.lit("")) != "")))


def profile_markdown() -> Column:
    """A record's profile, over the columns of a bundle."""
    caveat = F.coalesce(F.nullif(c("blocked_reason"), F.lit("")), F.nullif(c("conflict_note"), F.lit("")), F.lit("none"))
    return F.concat_ws(
        "\n", F.concat(F.lit("# "), c("provider_name"), F.lit(" - "), c("practice_name")),
        _facts("Summary", credentials=c("credentials"), license=F.concat_ws(" / ", "license_type", "license_status", "license_state"), record_confidence=c("record_confidence"), last_verified=c("last_verified_at")),
        _facts("Diagnostic capability", asd_diagnosis=c("diagnoses_asd"), adhd_diagnosis=c("diagnoses_adhd")), _facts("Prescribing capability", authority=c("prescriptive_authority"), basis=c("prescriptive_basis")),
        _facts("Practice details", practice=c("practice_name"), city_and_state=F.concat_ws(", ", "city", "location_state"), metro=c("metro"), phone=c("phone"), telehealth=c("telehealth"), age_groups=F.array_join("age_groups", ", "),
               insurance_notes=c("insurance_notes"), waitlist_notes=c("waitlist_notes"), referral_requirements=c("referral_requirements")),
        _section("Evidence links", _urls("evidence"), "none"), _facts("Confidence and caveats", caveats=caveat, contradictions=F.size("contradictions")),
    )


def sales_markdown() -> Column:
    """A sales brief, over the columns of a sales row."""
    return F.concat_ws(
        "\n", F.concat(F.lit("# Sales brief - "), c("provider_name"), F.lit(" / "), c("practice_name")), _facts("Target", buyer=c("target_buyer"), phone=c("phone"), website=c("website"), intake=c("intake_url")),
        _facts("Why", diagnostic_focus=dossier.diagnostic_focus(c("diagnoses_asd"), c("diagnoses_adhd")), license_status=c("license_status"), prescribing=c("prescriptive_authority"), confidence=c("record_confidence"), fit=c("outreach_fit_score")),
        _facts("Approach", angle=c("outreach_angle"), opener=c("opener"), evidence=c("evidence_summary")), _section("Evidence links", c("source_urls"), "none"),
    )


def dossier_markdown() -> Column:
    """An account's dossier, over the columns of ``dossiers``."""
    who = F.transform("contacts", lambda x: F.concat_ws(" | ", x["name"], x["role"], F.concat(F.lit("influence "), x["influence"]), x["best_channel"]))
    return F.concat_ws(
        "\n", F.concat(F.lit("# Account - "), c("practice_name")), _facts("Report", status=dossier.display_state(c("qa_state")), budget=c("budget_band"), fit=c("fit_score"), confidence=c("confidence_score")),
        _facts("Account", market=F.concat_ws(", ", "city", "state", "metro"), service_focus=c("service_focus"), providers=c("provider_count"), locations=c("location_count")),
        _section("Operations", c("operating_signals"), "none"), _section("Why", c("why_this_lead_matters"), "none"), _section("Contacts", who, "none"), _section("Sequence", c("recommended_sequence"), "none"),
        _section("Evidence in hand", c("evidence_quotes"), "see the links"), _section("Verification notes", c("review_notes"), "none"), _section("Evidence links", c("evidence_links"), "none"),
    )


def review_markdown() -> Column:
    """The summary of an account that is for review only."""
    return F.concat_ws(
        "\n", F.concat(F.lit("# Internal review - "), c("practice_name")), _facts("Status", state=dossier.display_state(c("qa_state")), confidence=c("confidence_score"), service_focus=c("service_focus"), named_providers=c("provider_count")),
        _section("Why it is internal", c("review_notes"), "not past the export gate"), _section("Public signals", c("operating_signals"), "none"), _section("Evidence in hand", c("evidence_quotes"), "see the links"),
        _section("Evidence links", c("evidence_links"), "none"),
    )
