"""Pages made for these tests, and the records they must give."""

import hashlib

import pytest
from pyspark.sql import functions as F

from siftlode.operators import parsers

SCHEMA = "source_id string, url string, title string, visible_text string, links array<struct<text: string, href: string>>, emails array<string>, expected_parser string, source_language string"


GENERIC = {
    "title": "Unterassistenz Chirurgie | Spital Musterhausen", "url": "https://www.spital.example/jobs/ua",
    "text": "Willkommen bei uns. Die Chirurgie bietet Unterassistenzstellen ab September 2027. Dauer von zwei bis vier Monaten. CHF 1'200 pro Monat ist der Lohn. Bewerbungen 6 Monate im Voraus.",
    "links": [("Start", "https://www.spital.example/"), ("Jetzt bewerben", "https://www.spital.example/form")], "emails": ["hr@spital.example"],
}


LANGUAGES = [
    ("Stage en médecine: candidature pour le stage en pédiatrie dès août 2027.", "fr", ("pediatrics", "available-from", "2027-08", "ClinicalPlacement")),
    ("Tirocinio in medicina interna. Candidatura per il tirocinio in medicina interna da luglio 2027.", "it", ("internal-medicine", "available-from", "2027-07", "Unknown")),
    ("Clinical placement for a medical student. Apply for an internship.", "en", (None, "application-only", None, "Unknown")),
    ("Famulatur in der Radiologie, Stellen ausgebucht bis Ende 2027.", "de", ("radiology", "fully-booked-until", None, "Famulatur")),
]
_SKIPPED, _SILENT = "Generic parser skipped likely irrelevant job page {}.", "Generic parser found no medical placement signal on {}."
OTHER = [
    {"text": "Oberarzt gesucht, Recruiting und HR.", "url": "https://a.example/1", "warning": _SKIPPED}, {"text": "Die Kantine hat offen.", "url": "https://a.example/2", "warning": _SILENT},
    {"text": None, "url": "https://a.example/3", "warning": _SILENT}, {"text": "Assistenzarzt gesucht. Bewerbung mit Nachweis der Ausbildung.", "url": "https://a.example/4", "warning": _SKIPPED},
    {"text": "Kontakt am Empfang. Ausbildung im Haus: Vortrag am 3.4.2027.", "url": "https://a.example/5", "warning": _SILENT},
    {"text": "Die Kantine sucht Hilfe.", "url": "https://www.usz.ch/kantine", "expected": "usz", "warning": "usz parser found no placement section on {}."},
]
CHOICE = {
    "ksw": {"url": "https://www.ksw.ch/a", "text": "Wahlstudienjahr in der Augenklinik.", "expected": "generic"},
    "usz": {"url": "https://www.ksw.ch/b", "text": "Kantine.", "expected": "usz"},
    "ksw ": {"url": "https://www.ksw.ch/c", "text": "Wahlstudienjahr in der Frauenklinik.", "expected": "ksw"},
    "generic": {"url": "https://notksw.ch/d", "text": "Wahlstudienjahr.", "expected": "nobody"},
    "generic ": {"url": "no url", "text": "Wahlstudienjahr.", "expected": None},
}
HOSPITALS = [
    {"url": "https://www.usz.ch/lehre/chirurgie/x", "title": "Unterassistenzen", "text": "Unterassistenzen ab Mai 2027. Verfügbarkeiten nur noch für kurze Zeit. Für Studierende der Humanmedizin ab dem 4. Studienjahr oder im Wahlstudienjahr (bzw. PJ), sonst niemand.", "links": [("Bewerbung für das Jahr 2027", "https://job.usz.ch/1")]},
    {"url": "https://ksa.ch/ua", "text": "Unterassistenz für mindestens 2 Monate. Personalzimmer vorhanden. Frühestens ab dem 4. Jahr des Medizin-Studiums möglich. Benötigte Bewerbungsunterlagen Lebenslauf und Brief. Danke.", "links": [("Angebot", "https://ksa.ch/angebot")]},
    {"url": "https://www.ksgr.ch/ua", "text": "Unterassistenz. Die Chirurgie ist ab Mai 2028 frei. Die Radiologie ist ausgebucht bis Ende 2027.", "links": [("Bewerbung Radiologie", "https://x.example/r")]},
    {"url": "https://www.h-och.ch/ortho", "text": "Unterassistenz in der Orthopädie. Deutschkenntnisse B2 verlangt. Keine Famulaturen möglich, leider.", "links": [("Freie Unterassistenzstellen", "kein Verweis")]},
    {"url": "https://www.kantonsspitalbaden.ch/j", "title": "Stellen", "text": "Unterassistent Chirurgie 100 % Ab Juni 2027. CHF 1500 pro Monat. Wohnung vorhanden. Fragen zum Bewerbungsablauf Eva Muster +41 56 1 Unterassistentin Pädiatrie 100 % Nach Vereinbarung. Wohnen auf dem Gesundheitscampus."},
    {"url": "https://www.kantonsspitalbaden.ch/k", "title": "Unterassistent_in | Innere Medizin", "text": "Ab sofort. Profil Du machst aktuell ein Medizinstudium. Du sprichst Deutsch auf mindestens B2-Niveau. Du hast Zeit. Dauer: 8 bis 16 Wochen."},
    {"url": "https://www.kantonsspitalbaden.ch/l", "title": "Unterassistent Labor und Geräte 100 %", "text": "Jetzt.", "links": [("Jobs", "https://fern.example/")]},
    {"url": "https://www.kantonsspitalbaden.ch/m", "title": "Stellen", "text": "Unterassistent_in gesucht"},
]


@pytest.fixture(scope="module")
def parsed(spark):
    pages = [GENERIC, *({"url": f"https://l.example/{lang}", "text": text, "title": "Haus"} for text, lang, _ in LANGUAGES), *OTHER, *CHOICE.values(), *HOSPITALS]
    rows = [(p.get("source_id", "s1"), p["url"], p.get("title"), p["text"], p.get("links", []), p.get("emails", []), p.get("expected", "generic"), p.get("language")) for p in pages]
    df = spark.createDataFrame(rows, SCHEMA).repartition(1)
    records = parsers.parse(df).cache()
    by_url = {}
    for r in records.collect():
        by_url.setdefault(r.url, []).append(r)
    return by_url, {r.url: r for r in parsers.page_results(df, records).collect()}


def test_generic_record(parsed):
    records, results = parsed
    (r,) = records[GENERIC["url"]]
    assert (r.parser, r.department, r.department_normalized, r.role_type, r.institution) == ("generic", "Chirurgie", "surgery", "Unterassistenz", "Spital Musterhausen")
    assert (r.status, r.available_from, r.booked_until, r.min_weeks, r.max_weeks) == ("available-from", "2027-09", None, 8, 16)
    assert (r.method, r.application_url, r.email) == ("online-form", "https://www.spital.example/form", "hr@spital.example")
    assert (r.confidence, r.review_status, r.extraction_language) == ("medium", "needs-human-review", "de")
    assert r.snippet.startswith("Die Chirurgie bietet") and r.snippet.endswith("der Lohn.") and r.compensation == "CHF 1'200 pro Monat"
    assert r.warnings == ["Generic parser output requires human review."]
    digest = hashlib.sha256("|".join(["s1", "Spital Musterhausen", "surgery", "Unterassistenz", GENERIC["url"]]).encode()).hexdigest()[:12]
    assert r.placement_id == f"spital-musterhausen-surgery-unterassistenz-{digest}"
    assert results[GENERIC["url"]].confidence == "medium" and results[GENERIC["url"]].records == 1


def test_generic_languages(parsed):
    for _, language, want in LANGUAGES:
        (r,) = parsed[0][f"https://l.example/{language}"]
        assert (r.department_normalized, r.status, r.available_from, r.role_type) == want and r.extraction_language == language


def test_pages_without_places(parsed):
    for p in OTHER:
        assert p["url"] not in parsed[0]
        r = parsed[1][p["url"]]
        assert r.records == 0 and r.confidence == "low" and r.warnings == [p["warning"].format(p["url"])]


def test_choice_of_parser(parsed):
    """A matching hospital parser before the expected one, the expected one without a match, else the generic one."""
    assert {name: parsed[1][p["url"]].parser for name, p in CHOICE.items()} == {name: name.strip() for name in CHOICE}


def test_hospital_profiles(parsed):
    records, results = parsed
    got = {(r.parser, r.department): r for p in HOSPITALS[:4] for r in records[p["url"]]}
    assert set(got) == {("usz", "Chirurgie"), ("ksa", None), ("ksgr", "Chirurgie"), ("ksgr", "Radiologie"), ("kssg", "Orthopädie")}
    usz, ksa, surgery, radiology, kssg = (got[k] for k in (("usz", "Chirurgie"), ("ksa", None), ("ksgr", "Chirurgie"), ("ksgr", "Radiologie"), ("kssg", "Orthopädie")))
    assert (usz.status, usz.confidence, usz.review_status, usz.method, usz.canton) == ("available", "high", "auto-published", "external-platform", "ZH")
    # an open page keeps the date that it names
    assert usz.available_from == "2027-05" and usz.eligibility == "Studierende der Humanmedizin ab dem 4. Studienjahr oder im Wahlstudienjahr (bzw. PJ)"
    assert (ksa.min_weeks, ksa.confidence, ksa.housing, ksa.method, ksa.role_type) == (None, "low", "yes", "online-form", "Unterassistenz")
    assert ksa.eligibility == "Frühestens ab dem 4. Jahr des Medizin-Studiums möglich. Benötigte Bewerbungsunterlagen Lebenslauf und Brief"
    assert (surgery.status, surgery.available_from, surgery.application_url) == ("fully-booked-until", None, None) and surgery.warnings == ["ksgr parser found no application URL."]
    assert (radiology.status, radiology.booked_until, radiology.review_status, radiology.application_url) == ("fully-booked-until", "2027-12", "needs-human-review", "https://x.example/r")
    assert (kssg.status, kssg.language_requirement, kssg.eligibility, kssg.method) == ("available", "Deutschkenntnisse B2", "Deutschkenntnisse B2. Keine Famulaturen möglich", "unknown")
    assert (kssg.extraction_method, kssg.record_language, kssg.record_region, kssg.extraction_language) == ("site-parser", "de", "unknown", "unknown")
    assert results["https://www.usz.ch/lehre/chirurgie/x"].confidence == "high" and results["https://www.usz.ch/lehre/chirurgie/x"].warnings == []
    assert results["https://ksa.ch/ua"].confidence == "low" and results["https://ksa.ch/ua"].warnings == ["ksa parser output for https://ksa.ch/ua needs human review."]


def test_sections_by_heading(parsed):
    records, results = parsed
    found = sorted(records["https://www.kantonsspitalbaden.ch/j"], key=lambda r: r.department)
    assert [(r.department, r.status, r.available_from, r.confidence) for r in found] == [("Chirurgie", "available-from", "2027-06", "high"), ("Pädiatrie", "not-specified", None, "medium")]
    assert results["https://www.kantonsspitalbaden.ch/j"].confidence == "medium"
    surgery, children = found
    assert (surgery.housing, surgery.compensation, surgery.contact, surgery.warnings) == (None, "CHF 1500", "Eva Muster", [])
    assert (children.housing, children.compensation, children.contact) == ("yes", None, None)
    assert children.warnings == ["KSB page does not state explicit availability; no date was inferred.", "KSB parser found no application URL or application contact."]
    assert results["https://www.kantonsspitalbaden.ch/j"].warnings == ["KSB parser output for https://www.kantonsspitalbaden.ch/j needs human review."]
    (inner,) = records["https://www.kantonsspitalbaden.ch/k"]
    assert (inner.department, inner.status, inner.min_weeks, inner.max_weeks, inner.language_requirement) == ("Innere Medizin", "available", 8, 16, "Deutsch auf mindestens B2-Niveau")
    assert inner.eligibility == "Du machst aktuell ein Medizinstudium. Du sprichst Deutsch auf mindestens B2-Niveau."
    (labour,) = records["https://www.kantonsspitalbaden.ch/l"]
    assert (labour.department, labour.department_normalized, labour.method, labour.confidence) == ("Labor und Geräte", "labor-und-gerate", "external-platform", "medium")
    (nobody,) = records["https://www.kantonsspitalbaden.ch/m"]
    assert (nobody.department, nobody.confidence) == (None, "low")


def test_regions_and_source_languages(parsed):
    for _, language, _ in LANGUAGES:
        (r,) = parsed[0][f"https://l.example/{language}"]
        assert (r.record_language, r.record_source_language, r.record_region, r.extraction_method) == (language, language, {"en": "unknown"}.get(language, f"{language}-CH"), "generic-parser")
    assert parsed[1][GENERIC["url"]].warnings == [f"Generic parser output for {GENERIC['url']} needs human review."]
    assert parsed[1]["https://l.example/en"].warnings[1:] == ["No medium-confidence record was extracted."]


def _own(id, words):
    """A parser of a test: a record for each link, and a warning of its own for pages without one."""
    section = lambda x: F.struct(x["text"].alias("department"), F.lower(x["text"]).alias("normalized"), x["href"].alias("text"))
    return parsers.RuleSet(
        id, lambda: F.contains(F.coalesce("visible_text", F.lit("")), F.lit(words)), lambda: F.transform("links", section), lambda: (F.col("section.text"), None),
        lambda: {"institution": F.lit(id), "confidence": F.lit("high"), "status": F.col("said.status")}, nothing=lambda: F.array().cast("array<string>"),
        review=lambda: F.array(F.lit(f"{id} has been here")), confidence=lambda: F.lit("high"),
    )


def test_parsers_of_ones_own(spark):
    rows = [
        ("s", "https://a.example", None, "Kiosk Unterassistenz", [("Obst", "ab Mai 2027"), ("Brot", "")], [], None, None), ("s", "https://b.example", None, "Kiosk", [], [], "kiosk", None),
        ("s", "https://www.ksw.ch/c", None, "Kiosk Halle Wahlstudienjahr Augenklinik", [("Obst", "ab sofort")], [], "kiosk", None), ("s", "https://d.example", None, "Wahlstudienjahr", [], [], "hall", None),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    listed = (_own("kiosk", "Kiosk"), *parsers.PARSERS, _own("hall", "Halle"))
    records = parsers.parse(df, listed)
    got = sorted((r.url, r.parser, r.department, r.status) for r in records.collect())
    # the first match other than the expected parser; a list without matches leaves the expected one
    assert got == [("https://a.example", "kiosk", "Brot", "not-specified"), ("https://a.example", "kiosk", "Obst", "available-from"), ("https://www.ksw.ch/c", "ksw", "Augenheilkunde", "not-specified")]
    results = {r.url: (r.parser, r.records, r.confidence, r.warnings) for r in parsers.page_results(df, records, parsers=listed).collect()}
    assert results["https://a.example"] == ("kiosk", 2, "high", ["kiosk has been here"])
    assert results["https://b.example"] == ("kiosk", 0, "low", ["Parser kiosk returned no placement records for https://b.example; human review is needed."])
    assert results["https://d.example"][:2] == ("hall", 0)
    (only,) = parsers.parse(df.filter("url = 'https://d.example'"), ()).collect()
    assert (only.parser, only.role_type) == ("generic", "Wahlstudienjahr")
