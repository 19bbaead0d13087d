"""Month arithmetic and date phrases in four languages, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from siftlode.functions.text import fold, full, let, lookup

# Folded month names by month.
MONTHS = {
    1: ("januar", "january", "janvier", "gennaio"),
    2: ("februar", "february", "fevrier", "febbraio"),
    3: ("marz", "maerz", "march", "mars", "marzo"),
    4: ("april", "avril", "aprile"),
    5: ("mai", "may", "maggio"),
    6: ("juni", "june", "juin", "giugno"),
    7: ("juli", "july", "juillet", "luglio"),
    8: ("august", "aout", "agosto"),
    9: ("september", "septembre", "settembre"),
    10: ("oktober", "october", "octobre", "ottobre"),
    11: ("november", "novembre"),
    12: ("dezember", "december", "decembre", "dicembre"),
}
# Folded wordings of deadlines and of mere arrangement, which name no start.
DEADLINE = ("bewerbungsfrist", "frist", "deadline", "delai de candidature", "date limite", "scadenza")
ARRANGED = ("nach vereinbarung", "sur accord", "sur demande", "da concordare", "previo accordo")
# What follows the number in a lead time, and the wordings of a year ahead.
AHEAD = (
    r"monate?\s+(?:im\s+voraus|vorher|vorlauf)",
    r"mois\s+(?:a\s+l'avance|d'avance|avant)",
    r"mesi\s+(?:di\s+anticipo|prima)",
    r"months?\s+in\s+advance",
)
BEFORE_START = r"(?:fruhestens|fruehestens|spatestens|spaetestens)\s+(\d{1,2})\s+monate?\s+vor\s+(?:beginn|start|antritt)"
YEAR_AHEAD = (
    r"(?:ein|einem|1)\s+jahr\s+(?:im\s+voraus|vorher)",
    r"(?:un|1)\s+an\s+(?:a\s+l'avance|d'avance|avant)",
    r"(?:un|1)\s+anno\s+(?:di\s+anticipo|prima)",
    r"(?:one|1)\s+year\s+in\s+advance",
)
# Words that pages glue together.
_GLUED = r"(dauer)(?=ab)|(monat|monate|monaten)(?=programmleitung|voraussetzungen|kontakt|stellen)"


def any_of(words) -> str:
    """A pattern of one of the wordings, longest first, with any white space between their words."""
    return "(?:" + "|".join(w.replace(" ", r"\s+") for w in sorted(words, key=len, reverse=True)) + ")"


def says(text: Column, words) -> Column:
    """Whether one of the wordings stands in the text, as words."""
    return text.rlike(rf"\b(?=[{''.join(sorted({w[0] for w in words}))}]){any_of(words)}\b")


def date_text(phrase: Column) -> Column:
    """Folded, with a blank between letters and digits and within glued words, single blanks, trimmed."""

    def parted(text: Column) -> Column:
        text = F.regexp_replace(F.regexp_replace(text, r"(\d)[-\u2013]?(?=[a-z])", "$1 "), r"([a-z])(?=\d)", "$1 ")
        text = F.regexp_replace(text, _GLUED, "$1$2 ")
        return F.trim(F.regexp_replace(text, r"\s{2,}|[^\S ]", " "))

    return parted(F.replace(fold(phrase), F.lit("\u2019"), F.lit("'")))


def month_index(date: Column) -> Column:
    """Months since year 0; days do not matter."""
    return F.year(date) * 12 + F.month(date)


def months_ahead(observed: Column, target: Column) -> Column:
    """Whole months from one month to another; null if negative."""
    n = month_index(target) - month_index(observed)
    return F.when(n >= 0, n)


def text_month_index(month: Column) -> Column:
    """Months since year 0 of YYYY-MM or YYYY-MM-DD; null for anything else."""
    part = [F.regexp_extract(month, r"^(\d{4})-(0[1-9]|1[0-2])(?:-\d{2})?$", i) for i in (1, 2)]
    return F.when(part[0] != "", part[0].cast("int") * 12 + part[1].cast("int"))


def months_until(observed: Column, target: Column) -> Column:
    """Months from a time to a month or date in text, negative ones too."""
    return text_month_index(target) - month_index(observed)


def target_month(available_from: Column, booked_until: Column) -> Column:
    return F.substring(F.coalesce(available_from, booked_until), 1, 7)


def months_observed(checked: Column, available_from: Column, booked_until: Column) -> Column:
    """Months ahead at which a record was seen; null if it lies in the past or has no date."""
    n = months_until(checked, target_month(available_from, booked_until))
    return F.when(n >= 0, n)


#: Date, year end, or month with its year, in text that went through ``date_text``.
DAY, YEAR_END = r"\b\d{1,2}\.\d{1,2}\.\d{4}\b", r"\b(?:ende|fin|fine) (\d{4})\b"
_NAMES = sorted((n for group in MONTHS.values() for n in group), key=len, reverse=True)
_NUMBER = {n: f"{m:02d}" for m, group in MONTHS.items() for n in group}
# a look ahead for the year saves trying all names at each word
NAMED = rf"\b(?=[a-z]{{3,9}} \d)(?:{'|'.join(_NAMES)}) \d{{4}}\b"


def month_of(text: Column, language: Column | None = None) -> Column:
    """``parse_month`` of a text that went through ``date_text``."""
    date = let(F.regexp_extract(text, DAY, 0), lambda d: F.when(d != "", F.date_format(F.try_to_date(d, "d.M.yyyy"), "yyyy-MM-dd")))
    year_end = F.concat(full(F.regexp_extract(text, YEAR_END, 1)), F.lit("-12"))

    def named(found: Column) -> Column:
        name = F.substring_index(found, " ", 1)
        known = found != "" if language is None else (found != "") & ~(F.coalesce(language == "de", F.lit(False)) & name.isin("mars", "mai"))
        return F.when(known, F.concat_ws("-", F.substring_index(found, " ", -1), lookup(_NUMBER, name)))

    said = F.coalesce(date, year_end, let(F.regexp_extract(text, NAMED, 0), named))
    return F.when(text.rlike(r"\d{4}") & ~says(text, (*DEADLINE, *ARRANGED)), said)


def parse_month(phrase: Column, language: Column | None = None) -> Column:
    """A phrase's first date, year end or month name with year, as YYYY-MM-DD or YYYY-MM; null without any.

    Phrases about deadlines or mere arrangement have no month. In German, mars and mai are no months, as the survey says.
    """
    return let(date_text(phrase), lambda text: month_of(text, language))


#: Words of which a lead time has one.
_LEADING = r"\b(?:voraus|vorher|vorlauf|vor|avance|avant|anticipo|prima|advance)\b"


def lead_of(text: Column) -> Column:
    """``lead_months`` of a text that went through ``date_text``."""
    patterns = [rf"\b(\d{{1,2}})\s+{AHEAD[0]}\b", rf"\b{BEFORE_START}\b", *(rf"\b(\d{{1,2}})\s+{p}\b" for p in AHEAD[1:])]
    numbers = [let(full(F.regexp_extract(text, p, 1)).cast("int"), lambda n: F.when(n > 0, n)) for p in patterns]
    return F.when(text.rlike(_LEADING), F.coalesce(*numbers, F.when(text.rlike(rf"\b(?:{'|'.join(YEAR_AHEAD)})\b"), F.lit(12))))


def lead_months(phrase: Column) -> Column:
    """Months in advance that a phrase names; a year is twelve, zero is none."""
    return let(date_text(phrase), lead_of)
