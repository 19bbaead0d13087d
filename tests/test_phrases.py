"""The phrases of the survey's fixtures, and more, with what they say."""

import pytest
from pyspark.sql import functions as F

from siftlode.functions import availability, dates

MONTH = {
    "ab Juli 2027": "2027-07", "ab 01.07.2027": "2027-07-01", "ab dem 1.7.2027": "2027-07-01", "ab März 2028": "2028-03", "ab Maerz 2028": "2028-03",
    "keine freien Plätze bis Ende 2026": "2026-12", "ausgebucht bis Dezember 2027": "2027-12", "dès juillet 2027": "2027-07", "à partir de juillet 2027": "2027-07",
    "à partir du 01.07.2027": "2027-07-01", "complet jusqu'à fin 2026": "2026-12", "aucune place disponible jusqu'en décembre 2027": "2027-12", "dès août 2028": "2028-08",
    "da luglio 2027": "2027-07", "a partire da luglio 2027": "2027-07", "a partire dal 01.07.2027": "2027-07-01", "occupato fino a fine 2026": "2026-12",
    "nessun posto disponibile fino a dicembre 2027": "2027-12", "da dicembre 2028": "2028-12", "from September 2029": "2029-09", "fully booked until November 2027": "2027-11",
    "available from 15.09.2028": "2028-09-15", "ab sofort": None, "nach Vereinbarung": None, "Bewerbungen 12 Monate im Voraus": None, "Bewerbungsfrist bis Ende 2026": None,
    "application deadline 01.07.2027": None, "date limite de candidature juillet 2027": None, "scadenza candidatura luglio 2027": None, "ab 31.02.2027": None,
    "Frist 01.09.2026": None, "sur demande septembre 2026": None,
}
LEAD = {
    "Bewerbungen 12 Monate im Voraus": 12, "Bewerbungen ein Jahr im Voraus": 12, "Bewerbungen 18 Monate im Voraus": 18, "mindestens 6 Monate vorher bewerben": 6,
    "Bewerbungen frühestens 12 Monate vor Beginn": 12, "Bewerbungen spaetestens 18 Monate vor Start": 18, "candidature 12 mois à l'avance": 12, "candidature 3 mois avant": 3,
    "candidature 18 mois avant le début": 18, "postulation un an à l’avance": 12, "candidatura con 12 mesi di anticipo": 12, "candidatura 4 mesi prima": 4,
    "candidatura 18 mesi prima dell'inizio": 18, "candidatura un anno di anticipo": 12, "un anno prima": 12, "applications 9 months in advance": 9, "apply one year in advance": 12,
    "3-6 Monate im Voraus": 6, "0 Monate im Voraus": None, "Bewerbungen laufend möglich": None, "ab Juli 2027": None, "ohne Vorlauf": None, "nach Vereinbarung": None,
}
DURATION = {
    "für mindestens 4 Wochen": (4, None), "mindestens 2 Monate": (8, None), "1 bis 4 Monate": (4, 16), "4 bis 8 Wochen": (4, 8), "1-3 Monate": (4, 12), "2 Monate": (8, 8),
    "4 Wochen": (4, 4), "au moins 6 semaines": (6, None), "1 a 3 mois": (4, 12), "almeno 2 mesi": (8, None), "2 a 6 settimane": (2, 6), "at least 5 weeks": (5, None),
    "1 to 4 months": (4, 16), "während 1 – 4 Monaten im Spitalalltag": (4, 16), "zwischen einem und vier Monaten": (4, 16), "Mindestzeitraum von drei bis vier Monaten": (12, 16),
    "Zeitraum von 2-4 Monaten": (8, 16), "Unterassistenzstellen ab einem Monat": (4, None), "ProgrammdauerAb einem Monat": (4, None), "Programmdauer1-4 Monate": (4, 16),
    "ProgrammdauerAb einem MonatProgrammleitungPD Dr.": (4, None), "Programmdauer1-4 MonateProgrammleitungDr.": (4, 16), "Dauer von einem, zwei, drei oder vier Monaten": (4, 16),
    "Dauer von drei Monaten": (12, 12), "ein 2-4 monatiges Curriculum": (8, 16), "Dauer von zwei bis vier Monaten": (8, 16), "Dauer nach Vereinbarung": (None, None),
    "Bewerbungen 12 Monate im Voraus": (None, None), "ab Juli 2027": (None, None),
}
STATUS = {
    "ab August 2027": ("available-from", "2027-08", None), "dès le 01.09.2027": ("available-from", "2027-09-01", None), "a partire da ottobre 2027": ("available-from", "2027-10", None),
    "from March 2028 on": ("available-from", "2028-03", None), "ausgebucht bis Ende 2027": ("fully-booked-until", None, "2027-12"), "fully booked": ("not-specified", None, None),
    "Wir haben keine Famulaturen": ("not-specified", None, None), "occupé jusqu'en mai 2027": ("fully-booked-until", None, "2027-05"), "per sofort": ("available", None, None),
    "sur demande": ("not-specified", None, None), "Bewerbungen per Post": ("application-only", None, None), "freie Plätze": ("available", None, None), "Kantine": ("not-specified", None, None),
    "": ("not-specified", None, None), "ab heute und dann immer wieder einmal auch ab Mai 2028": ("available-from", "2028-05", None),
    "ab und zu einmal hier und dort im Juni 2027": ("not-specified", None, None), "Ab dem Semester: ab September 2027 mindestens 2 Monate": ("available-from", "2027-09", None),
}


def results(spark, cases, expression):
    rows = spark.createDataFrame([(p,) for p in cases], "phrase string").select("phrase", expression(F.col("phrase")).alias("x")).collect()
    return {r.phrase: r.x for r in rows}


@pytest.mark.parametrize("cases, expression", [(MONTH, dates.parse_month), (LEAD, dates.lead_months)], ids=["month", "lead"])
def test_phrases(spark, cases, expression):
    assert results(spark, cases, expression) == cases


def test_durations(spark):
    assert {k: tuple(v) for k, v in results(spark, DURATION, availability.duration_weeks).items()} == DURATION


def test_availability(spark):
    got = results(spark, STATUS, availability.availability)
    assert {k: tuple(v)[:3] for k, v in got.items()} == STATUS
    assert got[""].warnings == [availability.NO_TEXT] and got["per sofort"].warnings == [] and got["fully booked"].warnings == [availability.NO_END]
    assert got["Ab dem Semester: ab September 2027 mindestens 2 Monate"].min_weeks == 8


def test_language_hint(spark):
    rows = [("ab Mai 2027", "de", None), ("ab Juni 2027", "de", "2027-06"), ("dès mai 2027", "fr", "2027-05"), ("da maggio 2027", "de", None), ("from May 2027", "en", "2027-05"), ("ab Mai 2027", None, "2027-05")]
    df = spark.createDataFrame(rows, "phrase string, language string, want string")
    got = df.select("want", availability.available_from(F.col("phrase"), F.col("language")).alias("x")).collect()
    assert [r.x for r in got] == [r.want for r in got]


def test_months(spark):
    rows = [("2026-07-07 08:00:00", "2027-07", 12), ("2026-07-31 23:00:00", "2026-08", 1), ("2026-07-07 08:00:00", "2026-06", -1), ("2026-07-07 08:00:00", "2027-07-01", 12), ("2026-07-07 08:00:00", "July 2027", None)]
    df = spark.createDataFrame(rows, "at string, target string, want int")
    assert all(r.x == r.want for r in df.select("want", dates.months_until(F.to_timestamp("at"), F.col("target")).alias("x")).collect())
