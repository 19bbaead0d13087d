"""Durations and availability in phrases of four languages, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from siftlode.functions.dates import ARRANGED, any_of, date_text, lead_of, month_of, says
from siftlode.functions.text import full, let, lookup

# Folded number words.
NUMBERS = {
    "ein": 1, "eine": 1, "einem": 1, "einen": 1, "zwei": 2, "drei": 3, "vier": 4, "funf": 5, "fuenf": 5, "sechs": 6,
    "sieben": 7, "acht": 8, "neun": 9, "zehn": 10, "un": 1, "una": 1, "due": 2, "tre": 3, "quattro": 4,
    "one": 1, "two": 2, "three": 3, "four": 4,
}
# Folded wordings by what they say.
LEAST = ("mindestens", "minimum", "au moins", "almeno", "at least", "ab")
AHEAD = ("im voraus", "vorher", "vorlauf", "a l'avance", "d'avance", "avant", "di anticipo", "prima", "in advance")
BOOKED = (
    "ausgebucht", "keine freien platze", "keine freien stellen", "keine famulaturen", "keine angeboten", "bietet keine", "voll belegt", "complet",
    "aucune place disponible", "occupe", "occupato", "nessun posto disponibile", "posti esauriti", "fully booked",
)
AT_ONCE = ("ab sofort", "per sofort", "sofort moglich", "des maintenant", "da subito", "immediately")
APPLY = ("bewerbung", "bewerbungen", "bewerben", "bewerbungsfrist", "candidature", "postulation", "candidatura", "apply", "application")
FREE = ("freie platze", "freie stellen", "verfugbar", "disponible", "posto disponibile", "posti disponibili", "available")
# Folded wordings of a start by language.
START = {
    "de": r"ab(?:\s+(?:dem|den|semester|monat))?",
    "fr": r"des|a\s+partir\s+(?:du|de)",
    "it": r"da|a\s+partire\s+(?:dal|da)",
    "en": r"from|starting(?:\s+from)?",
}
# What is said about a phrase that has no clear status.
NO_TEXT = "No availability text was provided."
NO_END = "Fully booked wording was detected, but no end date could be parsed."
BY_ARRANGEMENT = "Availability is described as by arrangement rather than as a date."
APPLY_ONLY = "Application information was detected without explicit availability."
NO_STATUS = "No explicit availability status could be parsed."
#: Characters after a wording of a start that may hold its date, and words between them.
WINDOW, BETWEEN = 40, 4
EXPLICIT = ("available", "available-from", "fully-booked-until")


_ONE = r"(\d{1,2}|" + "|".join(NUMBERS) + ")"
_MONTH, _WEEK = r"monate?|monaten|mois|mesi|months?", r"wochen|semaines?|settimane|weeks?"
_MONTHS = _MONTH + "|monatiges"
_SPAN = rf"\b{_ONE}\s*(?:bis|und|-|\u2013|a|to)\s*{_ONE}\s*"
_LIST = rf"\b{_ONE}(?:\s*,\s*{_ONE})?(?:\s*,\s*{_ONE})?\s+oder\s+{_ONE}\s+({_MONTH}|{_WEEK})\b"
_IN_MONTHS, _IN_WEEKS = rf"{_SPAN}(?:{_MONTHS})\b", rf"{_SPAN}(?:{_WEEK})\b"
_AT_LEAST, _SINGLE = rf"\b{any_of(LEAST)}\s+{_ONE}\s+({_MONTH}|{_WEEK})\b", rf"\b{_ONE}\s*({_MONTHS}|{_WEEK})\b"


def weeks_of(text: Column) -> Column:
    """``duration_weeks`` of a text that went through ``date_text``."""
    number = lambda x: let(x, lambda n: F.when(n.rlike("^[0-9]"), n.cast("int")).otherwise(lookup(NUMBERS, n).cast("int")))
    pair = lambda lo, hi: F.struct(lo.cast("int").alias("min_weeks"), hi.cast("int").alias("max_weeks"))
    weeks = lambda unit: F.when(F.startswith(unit, F.lit("m")), 4).otherwise(1)
    nothing = F.lit(None).cast("int")

    def first(pattern: str, said, other: Column) -> Column:
        """What is made of the pattern's parts where it stands, else the other."""
        part = lambda found: lambda i: full(F.regexp_extract(found, pattern, i))
        return let(F.regexp_extract(text, pattern, 0), lambda found: F.when(found != "", said(part(found))).otherwise(other))

    def listed(part):
        return let(F.array_compact(F.array(*(number(part(i)) for i in (1, 2, 3, 4)))), lambda n: pair(F.array_min(n) * weeks(part(5)), F.array_max(n) * weeks(part(5))))

    single = first(_SINGLE, lambda part: let(number(part(1)) * weeks(part(2)), lambda n: pair(n, n)), pair(nothing, nothing))
    least = first(_AT_LEAST, lambda part: pair(number(part(1)) * weeks(part(2)), nothing), single)
    in_weeks = first(_IN_WEEKS, lambda part: pair(number(part(1)), number(part(2))), least)
    in_months = first(_IN_MONTHS, lambda part: pair(number(part(1)) * 4, number(part(2)) * 4), in_weeks)
    # whatever unit a text has, one of these is part of it
    some = text.rlike("mon|moi|mes|woch|sem|sett|wee") & (~says(text, AHEAD) | F.contains(text, F.lit("dauer")))
    return F.when(some, first(_LIST, listed, in_months)).otherwise(pair(nothing, nothing))


def duration_weeks(phrase: Column) -> Column:
    """``(min_weeks, max_weeks)``: of a list, a range of months, one of weeks, a minimum or a single quantity, whichever comes first in this order.

    A month has four weeks; a minimum has no maximum. Times in advance are no durations unless the phrase speaks of one.
    """
    return let(date_text(phrase), weeks_of)


_DATE = r"(?:\d{1,2}\.\d{1,2}\.\d{4}|(?:ende|fin|fine) \d{4}|[a-z]+ \d{4})"


def _dated_starts(text: Column, cue: str) -> Column:
    """What stands from each wording of a start on, WINDOW characters of it, where a date follows within BETWEEN words."""
    initials = "".join(sorted({x.lstrip("(?:")[0] for x in cue.split("|")}))
    windows = F.regexp_extract_all(text, F.lit(rf"\b(?=[{initials}])(?=(?:{cue})\b)(?=(.{{1,{WINDOW}}}))(?:{cue})\b"), F.lit(1))
    near = rf"^(?:{cue})(?: \d{{4}}\b|\b(?:[^a-z]*[a-z]+){{0,{BETWEEN}}}[^a-z]*\b{_DATE}\b)"
    return F.filter(windows, lambda w: w.rlike(near))


def start_of(text: Column, language: Column | None = None) -> Column:
    """``available_from`` of a text that went through ``date_text``."""
    every = "|".join(START.values())
    found = _dated_starts(text, every)
    if language is not None:
        case = F
        for name, cue in START.items():
            case = case.when(language == name, _dated_starts(text, cue))
        found = case.otherwise(found)
    months = F.filter(F.transform(found, lambda w: month_of(w, language)), lambda m: m.isNotNull())
    return F.when(text.rlike(r"\d{4}"), F.get(months, F.lit(0)))


def available_from(phrase: Column, language: Column | None = None) -> Column:
    """The month or date that follows the first wording of a start that has one, within WINDOW characters and BETWEEN words."""
    return let(date_text(phrase), lambda text: start_of(text, language))


def _kind(text: Column) -> Column:
    return F.when(says(text, BOOKED), "booked").when(says(text, AT_ONCE), "at once").when(says(text, ARRANGED), "arranged").otherwise("")


def _month(text: Column, kind: Column, language: Column | None) -> Column:
    """The month until which all is booked, or from which there is a place."""
    return F.when(kind == "booked", month_of(text)).when(kind == "", start_of(text, language))


def status_of(text: Column, language: Column | None = None) -> Column:
    """``availability`` of a text that went through ``date_text``."""
    told = lambda status, said=None: F.struct(F.lit(status).alias("status"), F.lit(said).cast("string").alias("said"))

    def out(kind: Column, month: Column) -> Column:
        booked = kind == "booked"
        what = (
            F.when(booked & month.isNotNull(), told("fully-booked-until"))
            .when(booked, told("not-specified", NO_END))
            .when(kind == "at once", told("available"))
            .when(kind == "arranged", told("not-specified", BY_ARRANGEMENT))
            .when(month.isNotNull(), told("available-from"))
            .when(says(text, APPLY), told("application-only", APPLY_ONLY))
            .when(says(text, FREE), told("available"))
            .otherwise(told("not-specified", NO_STATUS))
        )
        return let(F.struct(what.alias("what"), weeks_of(text).alias("weeks")), lambda s: _said(s["what"]["status"], F.when(~booked, month), F.when(booked, month), lead_of(text), s["weeks"], s["what"]["said"]))

    said = let(_kind(text), lambda kind: let(_month(text, kind, language), lambda month: out(kind, month)))
    nothing = F.lit(None)
    silent = _said(F.lit("not-specified"), nothing, nothing, nothing, F.struct(nothing.cast("int").alias("min_weeks"), nothing.cast("int").alias("max_weeks")), F.lit(NO_TEXT))
    return F.when(text != "", said).otherwise(silent)


def _said(status, start, until, lead, weeks, warning) -> Column:
    return F.struct(
        status.alias("status"), start.cast("string").alias("available_from"), until.cast("string").alias("booked_until"), lead.cast("int").alias("lead_months"),
        weeks["min_weeks"].alias("min_weeks"), weeks["max_weeks"].alias("max_weeks"), F.array_compact(F.array(warning)).alias("warnings"),
    )


def availability(phrase: Column, language: Column | None = None) -> Column:
    """``(status, available_from, booked_until, lead_months, min_weeks, max_weeks, warnings)`` of a phrase.

    What it says first in this order counts: booked, at once, by arrangement, from a date, applications only, available. Null and
    blank phrases say nothing.
    """
    return let(date_text(phrase), lambda text: status_of(text, language))


#: Wordings and digits of which a text with an explicit status has one.
_HINT = rf"\d{{4}}|\b{any_of((*AT_ONCE, *FREE))}\b"


def explicit(text: Column, language: Column | None = None) -> Column:
    """Whether a text that went through ``date_text`` has one of the statuses EXPLICIT, without reading the rest of what it says."""
    free = says(text, FREE) & ~says(text, APPLY)
    told = lambda kind: F.when(kind == "at once", True).when(kind == "arranged", False).otherwise(_month(text, kind, language).isNotNull() | ((kind == "") & free))
    return F.when(text.rlike(_HINT), let(_kind(text), told)).otherwise(False)
