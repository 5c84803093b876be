"""Cases of the extraction stage, one page each."""

import pytest
from pyspark.sql import functions as F

from evigrid.functions import text
from evigrid.operators import extract

LONG = "We are a small practice that has cared for families since 1990 and answers calls on weekdays. "
PAGES = {
    "practice": (
        "https://brightpath.org/team", "practice_site", "Bright Path", "C",
        "<title>Bright Path Psychology Center</title><main><p>" + LONG + "Jane A. Rivers, PsyD leads our team. Autism diagnostic evaluations and ADHD testing for children.</p></main>"
        "<p>Call (201) 555-0101. Fax: 201-555-0102. Telehealth visits. Newark, NJ. We accept insurance. Waitlist open. Physician referral needed. NPI: 1234567890</p><a href='/new-patient'>start</a>",
    ),
    "blocked": ("https://board.gov/x", "licensing_board", "State Board", "A", "<p>Request unsuccessful. Incapsula incident ID: 1</p>"),
    "board": ("https://board.gov/lookup/1", "licensing_board", "Board of Psychological Examiners", "A", "<p>Licensee Name: Mary Stone Profession: Psychologist License Status: Active State: NJ</p>"),
    "hospital": ("https://hospital.org/services/autism", "hospital_directory", "General Hospital", "B", "<title>Autism Evaluation Services</title><p>Our program offers autism evaluations for children in Edison, NJ.</p>"),
    "publication": ("https://uni.edu/news/autism", "university_directory", "University", "B", "<title>Publications</title><p>Autism assessment paper by Anna Field, PhD and Dr. Omar Reyes.</p>"),
    "two": (
        "https://clinic.org/staff", "practice_site", "Clinic", "C",
        "<title>Staff of the Clinic</title><p>ADHD evaluations. Medical Director: Paul Ames, MD. Clinical Director: Ruth Bell, PhD. Paul Ames, MD is on the staff.</p>",
    ),
    "doctors": ("https://uni.edu/faculty/autism-team", "university_directory", "University", "B", "<title>Autism faculty</title><p>Our team: Dr. Omar Reyes sees adults.</p>"),
    "status": ("https://e.org/autism-faq", "practice_site", "Seed", "C", "<title>FAQ</title><p>What can I expect? Tom Hall, PhD. Autism.</p>"),
}


@pytest.fixture(scope="module")
def rows(spark):
    data = [(k, u, s, n, t, h, 200) for k, (u, s, n, t, h) in PAGES.items()]
    pages = spark.createDataFrame(data, "page string, url string, source_type string, seed_name string, tier string, html string, status_code int")
    found: dict = {}
    for r in extract.extract_records(pages, {"Newark": "North Jersey"}).collect():
        found.setdefault(next(k for k, p in PAGES.items() if p[0] == r.source_url), []).append(r)
    return found


def test_practice_page(rows):
    (r,) = rows["practice"]
    assert (r.provider_name, r.credentials, r.npi, r.license_type) == ("Jane A. Rivers", "PsyD", "1234567890", "psychologist")
    assert (r.diagnoses_asd, r.diagnoses_adhd, r.telehealth, r.practice_name) == ("yes", "yes", "yes", "Bright Path Psychology Center")
    assert (r.phone, r.fax, r.city, r.state, r.metro) == ("(201) 555-0101", "201-555-0102", "Newark", "NJ", "North Jersey")
    assert r.intake_url == "https://brightpath.org/new-patient" and r.age_groups == ["child", "adolescent"]
    assert "insurance" in r.insurance_notes and "Waitlist" in r.waitlist_notes and "referral" in r.referral_requirements
    assert [e.field for e in r.evidence] == ["provider_name", "credentials", "diagnoses_asd", "diagnoses_adhd", "npi"]
    assert all(e.quote and e.source_url == r.source_url for e in r.evidence) and "Jane A. Rivers" in r.evidence[0].quote


def test_blocked_and_publication_pages_give_nothing(rows):
    assert "blocked" not in rows and "publication" not in rows


def test_board_detail(rows):
    (r,) = rows["board"]
    assert (r.provider_name, r.license_type, r.license_status, r.diagnoses_asd, r.diagnoses_adhd) == ("Mary Stone", "psychologist", "active", "unclear", "unclear")
    assert [(e.field, e.value) for e in r.evidence] == [("provider_name", "Mary Stone"), ("license_status", "active")]


def test_service_page_without_clinician(rows):
    (r,) = rows["hospital"]
    assert (r.provider_name, r.diagnoses_asd, r.city, r.metro, r.license_type) == ("", "yes", "Edison", "unknown", "unknown")


def test_two_clinicians_in_order_and_once(rows):
    assert [(r.provider_name, r.credentials) for r in rows["two"]] == [("Paul Ames", "MD"), ("Ruth Bell", "PhD")]


def test_doctors_of_universities(rows):
    assert [r.provider_name for r in rows["doctors"]][0].startswith("Omar Reyes")


def test_help_pages_keep_the_practice_only(rows):
    (r,) = rows["status"]
    assert r.provider_name == "" and [(e.field, e.value) for e in r.evidence] == [("diagnoses_asd", "unclear")]


def test_links_by_rfc_3986(spark):
    base = "https://a.org/b/c/d?q=1"
    cases = {
        "g": "https://a.org/b/c/g", "./g": "https://a.org/b/c/g", "../g": "https://a.org/b/g", "../../../g": "https://a.org/g", "?y=2": "https://a.org/b/c/d?y=2",
        "/x/../y": "https://a.org/y", "//o.org/z": "https://o.org/z", "http://p.org": "http://p.org/", "g?x=1&a=2": "https://a.org/b/c/g?a=2&x=1", "..": "https://a.org/b",
    }
    rows = spark.createDataFrame(list(cases.items()), "link string, want string")
    assert {r.link: r.got for r in rows.select("link", text.resolve_link(F.lit(base), F.col("link")).alias("got")).collect()} == cases


def test_query_is_decoded_and_encoded(spark):
    cases = {"e.org/?b=%41%20c&a=x+y": "https://e.org/?a=x+y&b=A+c", "https://e.org/?q=100%": "https://e.org/?q=100%25", "e.org/?z=%7Eu*": "https://e.org/?z=~u%2A", "e.org?q=": "https://e.org/", "e.org/?k=é": "https://e.org/?k=%C3%A9"}
    rows = spark.createDataFrame([(k,) for k in cases], "url string")
    assert {r.url: r.n for r in rows.select("url", text.normalize_url(F.col("url")).alias("n")).collect()} == cases
