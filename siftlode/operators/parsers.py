"""Placement records of pages, in one pass: a parser is chosen by host and words, its rules are column expressions, and sections explode to records.

A parser is a ``RuleSet``; ``PARSERS`` are those of the survey, in the order of choice. Others are added by handing ``parse`` a longer list.
Pages have ``source_id, url, title, visible_text, links (text, href), emails, expected_parser, source_language`` and may have ``region``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftlode.functions import lexicon as lex
from siftlode.functions import placement as pl
from siftlode.functions.availability import EXPLICIT, availability, explicit
from siftlode.functions.dates import date_text
from siftlode.functions.text import ascii_words, fold, full, let, lookup, squeeze, words_of
from siftlode.operators import keywords

SNIPPET = 700
# Wordings of training, of other jobs, and of what makes a sentence speak of a department's places.
TRAINING = ascii_words(r"\b(?:medizin|medizinisch|medizinstudium|arztliche|ärztliche|aerztliche|student|studentin|studierende|ausbildung|lehre|medecine|médecine|medicina|medicine)\b")
OTHER_JOBS = ascii_words(r"\b(?:pflegefachperson|fachfrau\s+gesundheit|fachmann\s+gesundheit|assistenzarzt|oberarzt|leitender\s+arzt|mpa|hr|recruiting|jobs?\s+und\s+karriere)\b")
PLACES = ascii_words(
    r"\b(?:unterassist\w*|famulatur\w*|wahlstudienjahr|praktisches\s+jahr|pj|stellen|ausbildungsplatze|ausbildungsplätze|praktikum|curriculum|bewerb\w*|candidature|candidatura|stage|tirocinio"
    r"|(?:ab|des|dès|da)\s+\w+\s+20\d{2})\b"
)
# Wordings that show a page of places to a hospital's own parser.
SIGNAL = r"\b(?:unterassist|famulatur|wahlstudienjahr|praktisches\s+jahr|pj\b|medizinstudium|blockstudent)"
APPLY_LINK = r"\b(?:bewerb\w*|freie\s+unterassistenzstellen|apply|application|job|anmeldung|formular)\b"
# Folded words by which links name a department.
LINK_WORDS = {
    "Anästhesiologie": ("anasthesie", "anaesthesie", "anir"), "Frauenheilkunde": ("frauenklinik", "gyn"), "Innere Medizin": ("innere medizin", "medizin"),
    "Pädiatrie": ("paediatrie", "padiatrie", "kinder"), "Orthopädie": ("orthopadie", "orthopaedie", "ortho"),
}
# Who may come, in the words of hospitals' pages.
ELIGIBLE = r"\b(?:ab dem 4\. Studienjahr|im Wahlstudienjahr|Deutschkenntnisse B2|Keine Famulaturen möglich|Studierende der Humanmedizin)[^.]*[.]?"


# Roles in the words of a page, in order; the last one only where no hospital is known.
ROLES = (("Unterassistenz", r"\bunterassist"), ("Wahlstudienjahr", r"\bwahlstudienjahr"), ("PJ", r"\bpraktisches\s+jahr\b|\bpj\b"), ("Famulatur", r"\bfamulatur"))
GENERIC_ROLES = (*ROLES, ("ClinicalPlacement", r"\b(?:stage|sous-assistant|etudiant\s+en\s+medecine|étudiant\s+en\s+médecine)\b"))


@dataclass(frozen=True)
class Profile:
    """A hospital's parser. departments: names with patterns over title and text; by_page: over address and title instead, the first one only.

    eligibility: wordings of the hospital's own, of which the first place of each is taken, joined by ``joined``; without any the common ones count.
    """

    id: str
    hosts: str
    institution: str
    canton: str
    city: str
    departments: tuple[tuple[str, str], ...] = ()
    role: str | None = None
    link: str = APPLY_LINK
    signal: str = SIGNAL
    by_page: bool = False
    by_heading: bool = False
    own_links_only: bool = False
    durations: bool = True
    open_words: str | None = None
    eligibility: tuple[str, ...] = ()
    joined: str = " "


# The hospitals with parsers of their own, in the order of choice.
PROFILES = (
    Profile(
        "usz", r"(?:^|\.)usz\.ch$", "Universitätsspital Zürich", "ZH", "Zürich", by_page=True,
        departments=(
            ("Neuroradiologie", "neuroradiologie"), ("Anästhesiologie", "an(?:ae|ä)sthesiologie"), ("Frauenheilkunde", "frauenheilkunde"),
            ("Chirurgie", r"/chirurgie/|unterassistenzen\s+chirurgie"), ("Radiologie", r"/radiologie/|unterassistenzen\s+radiologie"),
            ("Innere Medizin", r"/medizin/|unterassistenzen\s+medizin"),
        ),
        link=r"\b(?:bewerbung\s+für\s+das\s+jahr|job\.usz\.ch|e-recruiting)\b", open_words=r"verfügbarkeiten\s+nur\s+noch|bewerbung\s+für\s+das\s+jahr",
        eligibility=(r"Studierende der Humanmedizin ab dem 4\. Studienjahr oder im Wahlstudienjahr \(bzw\. PJ\)",),
    ),
    Profile(
        "ksw", r"(?:^|\.)ksw\.ch$", "Kantonsspital Winterthur", "ZH", "Winterthur", role="Wahlstudienjahr",
        departments=(
            ("Anästhesiologie", r"\bklinik für anästhesiologie\b"), ("Augenheilkunde", r"\baugenklinik\b"), ("Frauenheilkunde", r"\bfrauenklinik\b"),
            ("Chirurgie", r"\b(?:hand- und plastische chirurgie|viszeral- und thoraxchirurgie)\b"), ("Innere Medizin", r"\bklinik für innere medizin\b"),
            ("Radiologie", r"\b(?:radiologie|nuklearmedizin|interventionelle radiologie)\b"), ("Pädiatrie", r"\bkinder- und jugendmedizin\b"),
            ("Orthopädie", r"\borthopädie und traumatologie\b"),
        ),
        link=r"\b(?:zu den offenen stellen|offene-stellen|bewerb\w*)\b",
    ),
    Profile(
        "ksa", r"(?:^|\.)ksa\.ch$", "Kantonsspital Aarau", "AG", "Aarau", role="Unterassistenz", durations=False,
        link=r"\b(?:bewerb\w*|unterassistenz-stellen|angebot)\b",
        eligibility=(r"Frühestens ab dem 4\. Jahr des Medizin-Studiums[^.]*[.]", r"Benötigte Bewerbungsunterlagen\s*[^.]+"),
    ),
    Profile(
        "ksb", r"(?:^|\.)kantonsspitalbaden\.ch$", "Kantonsspital Baden", "AG", "Baden", role="Unterassistenz", by_heading=True,
        departments=(
            ("Innere Medizin", r"\binnere\s+medizin\b"), ("Chirurgie", r"\bchirurgie\b"), ("Anästhesiologie", r"\b(?:anasthesie|anästhesie|anaesthesie|anästhesiologie)\b"),
            ("Notfallmedizin", r"\b(?:notfallzentrum|notfallmedizin)\b"), ("Pädiatrie", r"\b(?:padiatrie|pädiatrie|kinder)\b"),
        ),
        link=r"\b(?:bewerb\w*|jetzt\s+bewerben|apply|application|jobs?)\b", signal=r"\bunterassistent(?:_in|in|en)?\b",
    ),
    Profile(
        "kssg", r"(?:^|\.)h-och\.ch$", "Kantonsspital St. Gallen", "SG", "St. Gallen", role="Unterassistenz", departments=(("Orthopädie", r"\borthopädie\b"),),
        link=r"\b(?:freie unterassistenzstellen|jobs\.h-och\.ch)\b", open_words="freie unterassistenzstellen",
        eligibility=("Deutschkenntnisse B2", "Keine Famulaturen möglich"), joined=". ",
    ),
    Profile(
        "ksgr", r"(?:^|\.)ksgr\.ch$", "Kantonsspital Graubünden", "GR", "Chur", role="Unterassistenz", own_links_only=True,
        departments=(
            ("Chirurgie", r"\bchirurgie\b"), ("Innere Medizin", r"\binnere medizin\b"), ("Pädiatrie", r"\b(?:kinder- und jugendmedizin|pädiatrie)\b"),
            ("Frauenheilkunde", r"\b(?:frauenklinik|gynäkologie)\b"), ("Radiologie", r"\bradiologie\b"), ("Anästhesiologie", r"\b(?:anästhesie|anir)\b"),
        ),
        link=r"\b(?:bewerbung|informationen für unterassistenten|unterassistenten-.*\.pdf)\b",
    ),
)
# Where a section of a page by headings begins, and what a title of one says.
HEADING = r"Unterassistent(?:_in|in)?\s+([A-ZÄÖÜ][A-Za-zÄÖÜäöüéèàÉÈÀ\s-]+?)(?:\s+100\s*%|\.|Dauer:|Profil|$)"
HEADED_TITLE = r"(?iu)Unterassistent(?:in)?\s+(.+?)\s+100\s*%"
_CUT = "\u0001"
_SECTION = "array<struct<department: string, normalized: string, text: string>>"


def _first(array: Column, test) -> Column:
    return F.get(F.filter(array, test), F.lit(0))


def _has(text: Column, pattern: str) -> Column:
    return text.rlike(ascii_words(pattern))


def _matches(pattern: str):
    return lambda x: x.rlike(pattern)


def _from(parts: Column, at: Column, count: int) -> Column:
    """``count`` sentences from a place on, numbered from 1; null without a place."""
    return F.when(at.isNotNull(), F.array_join(F.slice(parts, at, F.lit(count)), " "))


def _place(array: Column, test) -> Column:
    """The place, from 1 on, of the first element that passes; null without one."""
    return F.get(F.array_compact(F.transform(array, lambda x, i: F.when(test(x), i + 1))), F.lit(0))


def _section(department: Column, text: Column) -> Column:
    return F.struct(department.cast("string").alias("department"), F.lit(None).cast("string").alias("normalized"), text.alias("text"))


def _extract(text: Column, pattern: str, group: int = 0, case: bool = False) -> Column:
    """The squeezed part of the pattern's first place, null without one."""
    return full(squeeze(F.regexp_extract(text, pattern if case else ascii_words(pattern), group)))


def _role(roles, other: str) -> Column:
    """The first role that the page's text names."""
    out = F
    for name, pattern in roles:
        out = out.when(_has(F.col("text"), pattern), name)
    return out.otherwise(other)


def _joined(parts: Sequence[Column], by: str) -> Column:
    return full(F.concat_ws(by, *parts))


def _all_joined(text: Column, pattern: str) -> Column:
    return full(F.array_join(F.transform(F.regexp_extract_all(text, F.lit(ascii_words(pattern)), F.lit(0)), squeeze), " "))


#: What the rules of a parser say of a section, beside its department, with the types of the result.
FIELDS = {
    "institution": "string", "role_type": "string", "canton": "string", "city": "string", "status": "string", "available_from": "string", "booked_until": "string", "min_weeks": "int", "max_weeks": "int",
    "lead_months": "int", "method": "string", "application_url": "string", "email": "string", "contact": "string", "eligibility": "string", "language_requirement": "string", "compensation": "string",
    "housing": "string", "snippet": "string", "confidence": "string", "review_status": "string", "warnings": "array<string>", "record_language": "string", "record_source_language": "string",
    "record_region": "string", "extraction_language": "string", "extraction_method": "string",
}


@dataclass(frozen=True)
class RuleSet:
    """A parser as column expressions, each made when a plan is.

    matches reads a page; sections gives its ``section`` structs (department, normalized, text; without ``normalized`` the department's key counts) and may read ``text``, ``parts`` (sentences), ``folded`` and
    ``language`` besides; phrase is what is read for availability, and its language or None; fields reads a section, what the phrase ``said``, and names
    FIELDS, others are null. nothing is the page's warnings where no record is found, review those where some are, by their numbers ``records``, ``high``, ``medium``
    and ``low``; so is confidence.
    """

    id: str
    matches: Callable[[], Column]
    sections: Callable[[], Column]
    phrase: Callable[[], tuple[Column, Column | None]]
    fields: Callable[[], dict[str, Column]]
    nothing: Callable[[], Column]
    review: Callable[[], Column]
    confidence: Callable[[], Column]


def _texts(*said: Column) -> Column:
    """The texts that are not null."""
    return F.array_compact(F.array(*said)).cast("array<string>")


# Hospitals


def _title_and_text() -> Column:
    return F.concat(F.coalesce("title", F.lit("")), F.lit(" "), F.coalesce("visible_text", F.lit("")))


def matches(profile: Profile) -> Column:
    return F.coalesce(pl.host(F.col("url")).rlike(profile.hosts) & _has(_title_and_text(), profile.signal), F.lit(False))


def _headed(text: Column, named) -> Column:
    """Sections of a text from one heading to the next; what stands before the first is left out."""
    pieces = F.slice(F.split(F.regexp_replace(text, HEADING, f"{_CUT}$0"), _CUT), F.lit(2), F.lit(1 << 30))
    name = lambda x: squeeze(F.regexp_replace(F.regexp_extract(x, HEADING, 1), "[_|]", " "))
    return F.transform(pieces, lambda x: let(name(x), lambda n: _section(F.coalesce(named(n), F.regexp_replace(n, r"\s+100\s*%$", "")), squeeze(x)))).cast(_SECTION)


def profile_sections(profile: Profile) -> Column:
    """The departments of a page with the text that speaks of each."""
    text, title = F.col("text"), F.coalesce("title", F.lit(""))
    whole = F.array(_section(F.lit(None).cast("string"), text)).cast(_SECTION)
    nothing = F.array().cast(_SECTION)
    named = lambda where: F.coalesce(*(F.when(_has(where, pattern), F.lit(name)) for name, pattern in profile.departments))
    if profile.by_page:
        return let(named(F.concat_ws(" ", "url", title)), lambda name: F.when(name.isNotNull(), F.array(_section(name, text)).cast(_SECTION)).otherwise(nothing))
    if profile.by_heading:
        of_title = lambda t: F.coalesce(named(t), let(_extract(t, HEADED_TITLE, 1, True), lambda x: F.coalesce(named(x), x)))
        by_heading = let(_headed(text, named), lambda found: F.when(F.size(found) > 0, found).otherwise(whole))
        return let(of_title(squeeze(F.regexp_replace(title, "[_|]", " "))), lambda name: F.when(name.isNotNull(), F.array(_section(name, text)).cast(_SECTION)).otherwise(by_heading))
    if not profile.departments:
        return whole
    parts = F.col("parts")
    about = lambda name: F.coalesce(_from(parts, _place(parts, lambda x: F.contains(F.lower(x), F.lit(name.lower()))), 5), text)
    found = [F.when(_has(title, pattern) | _has(text, pattern), _section(F.lit(name), about(name))) for name, pattern in profile.departments]
    return F.array_compact(F.array(*found)).cast(_SECTION)


def _words_by(table: dict[str, tuple[str, ...]], key: Column) -> Column:
    return F.coalesce(*(F.when(key == name, words_of(words)) for name, words in table.items()))


def _link_text(link: Column) -> Column:
    return F.concat_ws(" ", link["text"], link["href"])


def profile_link(profile: Profile) -> Column:
    """The first link that speaks of applying, one that names the department before any other."""
    department = F.col("section.department")
    fitting = F.filter("links", lambda x: _has(_link_text(x), profile.link))
    if profile.by_heading:
        return F.get(fitting, F.lit(0))["href"]
    names = F.coalesce(_words_by(LINK_WORDS, department), F.array(fold(department)))

    def chosen(links: Column) -> Column:
        own = F.when(department.isNotNull(), let(names, lambda ns: _first(links, lambda x: let(fold(_link_text(x)), lambda said: F.exists(ns, lambda n: F.contains(said, n)))))["href"])
        other = F.get(links, F.lit(0))["href"]
        return F.coalesce(own, F.when(department.isNull(), other) if profile.own_links_only else other)

    return let(fitting, chosen)


# Sums, and in the expressions below the wordings of contacts, languages, pay and rooms, and what warnings say.
_MONEY = r"CHF\s*[\d'’.,-]+(?:\s*(?:pro|/)\s*Monat)?"


def contact_name(text: Column) -> Column:
    asked = F.coalesce(_extract(text, r"Für Fragen steht Ihnen\s+(\p{Lu}[\p{L}' -]+?)\s+zur Verfügung", 1, True), _extract(text, r"Programmleitung\s*(\p{Lu}[\p{L}.' -]+?)(?=Voraussetzungen|Deutsch|$)", 1, True))
    return let(asked, lambda name: F.when(~F.contains(name, F.lit("Programmdauer")) & (F.char_length(name) <= 80), name))


def _department_said(profile: Profile) -> dict[str, Column]:
    """What hospitals' sections say beside availability, by the common rules or by those of pages with headings."""
    text = F.col("section.text")
    b2 = _extract(text, r"\bDeutsch\s+auf\s+mindestens\s+B2-Niveau\b")
    if profile.by_heading:
        # Wordings of this hospital
        part = F.coalesce(full(F.regexp_extract(text, r"(?iu)Profil\s*(.+?)(?:Die Ausbildung|Dauer:|Monatslohn:|Noch Fragen\?|$)", 1)), text)
        may = r"Du\s+(?:machst aktuell ein Medizinstudium|sprichst Deutsch auf mindestens B2-Niveau|hast einen Pass eines EU-/EFTA-Staats)[.]"
        return {
            "contact": _extract(text, r"Fragen zum Bewerbungsablauf\s*(\p{Lu}[\p{L}' -]+?)(?=\+41|Hinweis|$)", 1, True), "eligibility": _all_joined(part, may), "language_requirement": b2,
            "compensation": _extract(text, rf"\b{_MONEY}(?=[^\d'’.,-]|$)"), "housing": F.when(_has(text, "Wohnen auf dem Gesundheitscampus|Wohnung auf dem KSB-Areal"), "yes"),
        }
    own = _joined([full(F.regexp_extract(text, ascii_words(p), 0)) for p in profile.eligibility], profile.joined) if profile.eligibility else F.lit(None)
    return {
        "contact": contact_name(text), "eligibility": F.coalesce(own, _all_joined(text, ELIGIBLE)), "language_requirement": F.coalesce(_extract(text, r"\bDeutschkenntnisse\s+B2\b"), b2),
        "compensation": _extract(text, rf"\b(?:Gehalt|Monatslohn|Lohn)[^C]{{0,120}}({_MONEY})(?=[^\d'’.,-]|$)", 1),
        "housing": F.when(_has(text, "personalzimmer|personalunterk|unterkunft|möblierten zimmer|wohnung"), "yes"),
    }


def _profile_fields(profile: Profile) -> dict[str, Column]:
    text, department, said = F.col("section.text"), F.col("section.department"), F.col("said")
    status = said["status"]
    if profile.open_words:
        shown = F.coalesce(_has(text, profile.open_words) | F.exists("links", lambda x: F.coalesce(_has(x["text"], profile.open_words), F.lit(False))), F.lit(False))
        status = F.when(shown, "available").otherwise(status)
    own = _department_said(profile)
    name = "KSB" if profile.by_heading else profile.id

    def told(status: Column, url: Column, contact: Column) -> Column:
        is_explicit = status.isin(*EXPLICIT)
        confidence = F.when(department.isNull(), "low").when(is_explicit, "high").otherwise("medium")
        no_link = F.when(url.isNull() & contact.isNull(), f"{name} parser found no application URL or application contact.") if profile.by_heading else F.when(url.isNull(), f"{name} parser found no application URL.")
        warnings = _texts(F.when(department.isNull(), f"{name} parser could not determine a department."), F.when(~is_explicit, f"{name} page does not state explicit availability; no date was inferred."), no_link)
        published = is_explicit & department.isNotNull() & (status != "fully-booked-until")
        return F.struct(
            status.alias("status"), url.alias("application_url"), contact.alias("contact"), confidence.alias("confidence"), warnings.alias("warnings"),
            F.when(published, "auto-published").otherwise("needs-human-review").alias("review_status"), pl.application_method(url, F.col("url")).alias("method"),
        )

    known = let(F.struct(status.alias("s"), profile_link(profile).alias("u"), own["contact"].alias("c")), lambda x: told(x["s"], x["u"], x["c"]))
    title = F.coalesce(F.concat("title", F.lit(". ")), F.lit(""))
    return {
        "__told": known, "institution": F.lit(profile.institution), "role_type": F.lit(profile.role) if profile.role else _role(ROLES, "ClinicalPlacement"), "canton": F.lit(profile.canton), "city": F.lit(profile.city),
        "available_from": said["available_from"], "booked_until": said["booked_until"], "min_weeks": said["min_weeks"] if profile.durations else F.lit(None), "max_weeks": said["max_weeks"] if profile.durations else F.lit(None),
        "lead_months": said["lead_months"], "email": F.get("emails", F.lit(0)), **{k: v for k, v in own.items() if k != "contact"}, "snippet": F.substring(squeeze(F.concat(title, text)), 1, SNIPPET),
        "record_language": F.lit("de"), "record_source_language": F.lit("unknown"), "record_region": F.lit("unknown"), "extraction_language": F.lit("unknown"), "extraction_method": F.lit("site-parser"),
    }


def _of_page(before: str, after: str) -> Column:
    return F.concat(F.lit(before), F.coalesce("url", F.lit("null")), F.lit(after))


def hospital(profile: Profile) -> RuleSet:
    name, what = ("KSB", "Unterassistenz") if profile.by_heading else (profile.id, "placement")
    return RuleSet(
        profile.id, lambda: matches(profile), lambda: profile_sections(profile), lambda: (F.col("section.text"), None), lambda: _profile_fields(profile),
        nothing=lambda: _texts(_of_page(f"{name} parser found no {what} section on ", ".")),
        review=lambda: _texts(F.when(F.col("high") < F.col("records"), _of_page(f"{name} parser output for ", " needs human review."))),
        confidence=lambda: F.when(F.col("low") > 0, "low").when(F.col("high") == F.col("records"), "high").otherwise("medium"),
    )


# The generic parser


def _by_language(table: dict) -> Column:
    return F.coalesce(*(F.when(F.col("language") == name, words_of(dict.fromkeys(table[name]))) for name in lex.LANGUAGES))


def _holds(where: Column, words: Column) -> Column:
    return F.exists(words, lambda w: F.contains(where, w))


def _held(table: dict) -> Column:
    """Whether the text holds one of the words of its language."""
    return F.coalesce(*(F.when(F.col("language") == name, keywords.any_of(F.col("hits"), dict.fromkeys(table[name]))) for name in lex.LANGUAGES))


def _skipped() -> Column:
    """Why the generic parser takes no record from a page; null where it does. Needs ``role``, whether a word of a role stands in the text."""
    text, role = F.col("text"), F.col("role")
    # what no sentence of the whole text holds, none need be read for
    trained = lambda words: _held(lex.APPLICATIONS) & F.exists("parts", lambda x: x.rlike(TRAINING) & _holds(fold(x), words))
    return F.when(~role & text.rlike(OTHER_JOBS), "other jobs").when(~role & ~let(_by_language(lex.APPLICATIONS), trained), "no signal")


def generic_sections() -> Column:
    """The departments that a title or a sentence about places names, or a section without any; none for other jobs and pages without a sign of places."""
    text, folded = F.col("text"), F.col("folded")
    title = fold(F.coalesce("title", F.lit("")))
    name_of = lambda names, t: _first(words_of(names), lambda n: let(fold(n), lambda x: F.contains(t, x) | F.contains(folded, x)))

    def found(title: Column, about: Column, held: Column) -> Column:
        out = []
        for key, by in lex.DEPARTMENTS.items():
            names = [n for language_names in by.values() for n in language_names]
            pattern = ascii_words(r"\b(?:" + "|".join(dict.fromkeys(pl.folded_name(n) for n in names)) + r")\b")
            told = title.rlike(pattern) | F.array_contains(held, key) & F.exists(about, _matches(pattern))
            section = F.struct(F.coalesce(name_of(names, title), F.lit(names[0])).alias("department"), F.lit(key).alias("normalized"), text.alias("text"))
            out.append(F.when(told, section))
        return F.array_compact(F.array(*out)).cast(_SECTION)

    about = F.transform(F.filter("parts", lambda x: x.rlike(PLACES)), fold)
    # a name that a sentence holds as words, the whole text holds so too
    departments = let(F.struct(title.alias("t"), about.alias("a"), keywords.departments(F.col("hits")).alias("h")), lambda x: found(x["t"], x["a"], x["h"]))
    nobody = F.array(F.struct(F.lit(None).cast("string").alias("department"), F.lit(None).cast("string").alias("normalized"), text.alias("text"))).cast(_SECTION)
    return F.when(F.col("skipped").isNull(), let(departments, lambda d: F.when(F.size(d) > 0, d).otherwise(nobody))).otherwise(F.array().cast(_SECTION))


def generic_snippet() -> Column:
    """The sentences about the department, else the first that says when, how to apply or what for; else all."""
    text, department, parts, language = F.col("section.text"), F.col("section.department"), F.col("parts"), F.col("language")
    every = lambda table: list(dict.fromkeys(w for ws in table.values() for w in ws))

    def chosen(folded: Column) -> Column:
        about = F.when(department.isNotNull(), let(fold(department), lambda d: _from(parts, _place(folded, lambda x: F.contains(x, d)), 3)))
        dated = _from(parts, _place(parts, lambda x: let(date_text(x), lambda t: explicit(t, language))), 1)
        apply = _from(parts, _place(folded, lambda x: pl.has_any(x, every(lex.APPLICATIONS))), 1)
        role = _from(parts, _place(folded, lambda x: pl.has_any(x, every(lex.ROLES))), 1)
        return F.coalesce(about, dated, apply, role, text)

    return F.substring(squeeze(let(F.transform(parts, fold), chosen)), 1, SNIPPET)


REGIONS = {"de": "de-CH", "fr": "fr-CH", "it": "it-CH", "mixed": "mixed"}


def _generic_fields() -> dict[str, Column]:
    department, said, snippet, email = F.col("section.department"), F.col("said"), F.col("phrase"), F.get("emails", F.lit(0))
    words = _by_language({n: (*lex.APPLICATIONS[n], "job") for n in lex.LANGUAGES})
    link = let(words, lambda ws: _first(F.col("links"), lambda x: _holds(fold(_link_text(x)), ws)))["href"]

    def told(url: Column) -> Column:
        reachable = url.isNotNull() | email.isNotNull()
        confidence = F.when(department.isNotNull() & (said["status"].isin(*EXPLICIT) | reachable), "medium").otherwise("low")
        vague = said["status"].isin("not-specified", "application-only")
        warnings = _texts(
            F.lit("Generic parser output requires human review."), F.when(department.isNull(), "No department was detected."), F.when(vague, "No explicit availability status was detected."),
            F.when(~reachable, "No application URL or contact email was detected."),
        )
        return F.struct(url.alias("application_url"), confidence.alias("confidence"), warnings.alias("warnings"), pl.application_method(url, F.col("url"), email, "external-platform").alias("method"))

    language = F.col("language")
    source_language = F.coalesce("source_language", language)
    return {
        "__told": let(link, told), "institution": pl.institution_of_title(F.col("title"), F.col("source_id")), "role_type": _role(GENERIC_ROLES, "Unknown"), "status": said["status"], "available_from": said["available_from"],
        "booked_until": said["booked_until"], "min_weeks": said["min_weeks"], "max_weeks": said["max_weeks"], "lead_months": said["lead_months"], "email": email,
        "language_requirement": _extract(snippet, r"\b(?:deutschkenntnisse|deutsch|franzosisch|français|italiano)\s*[A-C][12]\b"), "compensation": _extract(snippet, rf"\b{_MONEY}\b"), "snippet": snippet,
        "review_status": F.lit("needs-human-review"), "record_language": language, "record_source_language": source_language,
        "record_region": F.coalesce("page_region", F.coalesce(lookup(REGIONS, source_language), F.lit("unknown"))), "extraction_language": language, "extraction_method": F.lit("generic-parser"),
    }


GENERIC = RuleSet(
    "generic", lambda: F.lit(True), generic_sections, lambda: (generic_snippet(), F.col("language")), _generic_fields,
    nothing=lambda: _texts(F.when(F.col("skipped") == "other jobs", _of_page("Generic parser skipped likely irrelevant job page ", ".")).otherwise(_of_page("Generic parser found no medical placement signal on ", "."))),
    review=lambda: _texts(_of_page("Generic parser output for ", " needs human review."), F.when(F.col("medium") == 0, "No medium-confidence record was extracted.")),
    confidence=lambda: F.when(F.col("medium") > 0, "medium").otherwise("low"),
)
PARSERS = (*map(hospital, PROFILES), GENERIC)


def selected(parsers: Sequence[RuleSet] = PARSERS) -> Column:
    """The first parser that matches, other than the expected one and the generic one; else the expected one if there is such a parser; else the generic one."""
    expected = F.col("expected_parser")
    other = [F.when(p.matches() & ~F.coalesce(expected == p.id, F.lit(False)), F.lit(p.id)) for p in parsers if p.id != "generic"]
    return F.coalesce(*other, F.when(expected.isin(*(p.id for p in parsers), "generic"), expected), F.lit("generic"))


def _settled(df: DataFrame, **columns: Column) -> DataFrame:
    """The frame with more columns, computed once: what follows reads them instead of repeating their long expressions."""
    one = F.explode(F.array(F.struct(*(c.alias(n) for n, c in columns.items())))).alias("__settled")
    return df.select("*", one).select(*df.columns, *(F.col(f"__settled.{n}").alias(n) for n in columns))


def _case(parsers: Sequence[RuleSet], value) -> Column:
    other, out = value(next((p for p in parsers if p.id == "generic"), GENERIC)), F
    for p in parsers:
        if p.id != "generic":
            out = out.when(F.col("parser") == p.id, value(p))
    return other if out is F else out.otherwise(other)


def _prepared(pages: DataFrame, parsers: Sequence[RuleSet]) -> DataFrame:
    """Pages in one column, with their parser and what all parsers read."""
    page = F.struct(*pages.columns)
    region = F.col("region") if "region" in pages.columns else F.lit(None).cast("string")
    needed = ("source_id", "url", "title", "visible_text", "links", "emails", "expected_parser", "source_language")
    rows = pages.select(page.alias("page"), *needed, region.alias("page_region"))
    rows = _settled(rows, parser=selected(parsers), text=squeeze(F.coalesce("visible_text", F.lit(""))))
    # the text has single blanks, and so have its sentences
    parts = F.filter(F.transform(F.split(F.regexp_replace("text", r"([.!?]) ", "$1\n"), "\n"), F.trim), lambda x: x != "")
    rows = _settled(rows, parts=parts, folded=fold(F.col("text")))
    known = F.col("source_language").isin(*lex.LANGUAGES)
    # one reading for the words of all languages and the names of all departments
    rows = rows.withColumn("hits", keywords.hits(F.col("folded")))
    rows = _settled(rows, language=F.when(known, F.col("source_language")).otherwise(keywords.language(F.col("hits"))))
    rows = _settled(rows, role=_held(lex.ROLES))
    return _settled(rows, skipped=F.when(F.col("parser") == "generic", _skipped()))


@lru_cache(maxsize=8)
def _columns(parsers: tuple[RuleSet, ...]) -> dict[str, Column]:
    """What the parsers say, by the page's parser; made once for a list of parsers, as there are thousands of expressions."""

    def record(p: RuleSet) -> Column:
        fields = p.fields()
        told = fields.pop("__told", None)
        grouped = {"application_url", "method", "confidence", "warnings", *(("status", "contact", "review_status") if "status" not in fields else ())} if told is not None else set()
        one = lambda t: F.struct(*((t[n] if n in grouped else fields.get(n, F.lit(None))).cast(kind).alias(n) for n, kind in FIELDS.items()))
        return one(None) if told is None else let(told, one)

    def phrase(p: RuleSet) -> Column:
        text, language = p.phrase()
        return F.struct(text.alias("text"), (F.lit(None).cast("string") if language is None else language).alias("hint"))

    return {
        "sections": _case(parsers, lambda p: p.sections()), "phrase": _case(parsers, phrase), "said": availability(F.col("phrase"), F.col("hint")), "record": _case(parsers, record),
        "normalized": F.coalesce("section.normalized", pl.department_key(F.col("section.department"))), "nothing": _case(parsers, lambda p: p.nothing()),
        "review": _case(parsers, lambda p: p.review()), "confidence": _case(parsers, lambda p: p.confidence()),
    }


def parse(pages: DataFrame, parsers: Sequence[RuleSet] = PARSERS) -> DataFrame:
    """A row per record: the page's columns, ``parser``, ``nth`` (the record's place in its page) and the record's fields. Pages without a record have none here; see ``page_results``."""
    made = _columns(tuple(parsers))
    rows = _prepared(pages, parsers).select("*", F.posexplode(made["sections"]).alias("nth", "section"))
    rows = _settled(rows, read=made["phrase"]).withColumns({"phrase": F.col("read.text"), "hint": F.col("read.hint")})
    rows = _settled(rows, said=made["said"])
    rows = _settled(rows, record=made["record"], normalized=made["normalized"])
    r = {n: F.col(f"record.{n}") for n in FIELDS}
    department, normalized = F.col("section.department"), F.col("normalized")
    return rows.select(
        "page.*", "parser", "nth", pl.placement_id(r["institution"], F.coalesce(normalized, department), r["role_type"], F.col("source_id"), F.col("url")).alias("placement_id"),
        department.alias("department"), normalized.alias("department_normalized"), pl.original_role(F.col("text")).alias("role_original"), *(c.alias(n) for n, c in r.items()),
    )


def page_results(pages: DataFrame, records: DataFrame, key: str = "url", parsers: Sequence[RuleSet] = PARSERS, **also: Column) -> DataFrame:
    """``(key, parser, records, confidence, warnings)`` per page, pages without any of the parsed records included. Warnings are those of the page's parser.

    ``also`` names aggregates of a page's records, which are read once for all; null where there is none.
    """
    made = _columns(tuple(parsers))
    number = lambda c: F.count_if(F.col("confidence") == c).alias(c)
    counts = records.groupBy(F.col(key).alias("__key")).agg(F.count("*").alias("records"), *map(number, ("high", "medium", "low")), *(c.alias(n) for n, c in also.items()))
    rows = _prepared(pages, parsers).withColumn("__key", F.col(f"page.{key}"))
    both = rows.join(counts, "__key", "left").fillna(0, ["records", "high", "medium", "low"])
    none = F.col("records") == 0
    own = F.when(none, made["nothing"]).otherwise(made["review"])
    silent = _texts(F.concat(F.lit("Parser "), F.col("parser"), _of_page(" returned no placement records for ", "; human review is needed.")))
    told = let(own, lambda said: F.when(none & (F.size(said) == 0), silent).otherwise(said))
    confidence = F.when(none, "low").otherwise(made["confidence"])
    return both.select(F.col("__key").alias(key), "parser", "records", confidence.alias("confidence"), told.alias("warnings"), *also)
