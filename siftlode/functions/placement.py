"""What a placement record says: roles, departments, labels, ids and predicates, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from siftlode.functions import lexicon as lex
from siftlode.functions.dates import date_text, says, text_month_index
from siftlode.functions.text import ascii_words, fold, full, let, lookup, slug, squeeze, title_case, words_of

# Wordings of a full house that a record's own text may have.
BOOKED_IN_TEXT = ("ausgebucht", "keine freien platze", "keine freien stellen", "complet", "aucune place disponible", "occupato", "nessun posto disponibile", "fully booked")
# The words by which pages name roles.
ROLE_WORDS = ascii_words(r"\b(unterassistenz|unterassistent(?:in)?|wahlstudienjahr|praktisches\s+jahr|pj|famulatur|sous-assistant(?:e)?|stage|tirocinio|clinical placement|elective)\b")


def has_any(folded: Column, words) -> Column:
    return F.exists(words_of(words), lambda w: F.contains(folded, w))


def counted(folded: Column, words) -> Column:
    return F.size(F.filter(words_of(words), lambda w: F.contains(folded, w)))


def language_words(language: str) -> list[str]:
    """The folded words that speak for a language; a word that stands twice counts twice."""
    names = [folded_name(n) for by in lex.DEPARTMENTS.values() for n in by[language]]
    return [*lex.ROLES[language], *lex.APPLICATIONS[language], *lex.AVAILABLE[language], *lex.UNAVAILABLE[language], *names]


def folded_language(folded: Column) -> Column:
    """The language of a folded text: that with the most words in it, the earlier in order on a tie."""
    scores = F.array(*(counted(folded, language_words(language)) for language in lex.LANGUAGES))
    return let(scores, lambda n: F.element_at(F.array(*map(F.lit, lex.LANGUAGES)), F.array_position(n, F.array_max(n)).cast("int")))


def detected_language(text: Column) -> Column:
    """The language with the most words, the earlier in order on a tie."""
    return let(fold(text), folded_language)


def folded_name(name: str) -> str:
    import unicodedata

    return "".join(c for c in unicodedata.normalize("NFD", name) if not unicodedata.combining(c)).lower()


def department_key(name: Column) -> Column:
    """The normalised department of an exact alias, else a slug; null for null or empty names."""
    aliases = {folded_name(n): key for key, by in reversed(lex.DEPARTMENTS.items()) for names in by.values() for n in names}
    folded = fold(name)
    return F.when(name != "", F.coalesce(lookup(aliases, folded), slug(name)))


def original_role(text: Column) -> Column:
    return full(F.regexp_extract(text, ROLE_WORDS, 1))


def display_label(value: Column) -> Column:
    return F.coalesce(lookup(lex.LABELS, value), value)


def words_label(value: Column) -> Column:
    """Hyphens to blanks, each word capitalised."""
    return title_case(value)


def canonical_role(role: Column, original: Column) -> Column:
    """``(value, label)``."""
    elective = role.isin("Unterassistenz", "Wahlstudienjahr", "ClinicalPlacement") | F.coalesce(original, F.lit("")).rlike(r"(?i)\b(?:stage|sous-assistant|tirocinio)\b")
    value = F.when(elective, "clinical-elective").when(role == "Unknown", "not-specified").otherwise(role)
    return F.struct(value.alias("value"), display_label(value).alias("label"))


def canonical_availability(status: Column) -> Column:
    value = F.when(status.isin("unclear", "not-specified"), "not-specified").otherwise(status)
    return F.struct(value.alias("value"), display_label(value).alias("label"))


def canonical_department(normalized: Column, name: Column, original: Column) -> Column:
    """``(value, label)`` of the first of three names; those that the table lacks keep a slug, and their own words as a label."""
    raw = F.coalesce(normalized, name, original, F.lit("not-specified"))
    key = F.regexp_replace(F.regexp_replace(F.replace(fold(raw), F.lit("&"), F.lit(" and ")), "[^a-z0-9]+", "-"), "^-+|-+$", "")
    known = lookup({k: value for value, keys in lex.DEPARTMENT_KEYS.items() for k in keys}, key)
    value = F.coalesce(known, F.when(raw == "not-specified", raw), F.coalesce(F.nullif(key, F.lit("")), F.lit("not-specified")))
    words = F.when(F.contains(raw, F.lit("-")), F.initcap(F.replace(raw, F.lit("-"), F.lit(" ")))).otherwise(raw)
    label = F.coalesce(lookup(lex.DEPARTMENT_LABELS, known), F.when(raw == "not-specified", "Not specified"), words)
    return F.struct(value.alias("value"), label.alias("label"))


def contradictory(status: Column, start: Column, until: Column) -> Column:
    """Whether the dates do not belong to the status."""
    return F.when(status == "available-from", start.isNull() | until.isNotNull()).when(status == "fully-booked-until", until.isNull() | start.isNotNull()).otherwise(start.isNotNull() | until.isNotNull())


def past_day(start: Column, until: Column, now: Column) -> Column:
    """The record's date, the first of its month if it has no day, lies before now."""
    date = F.coalesce(start, until)
    day = F.try_to_timestamp(F.when(F.length(date) == 7, F.concat(date, F.lit("-01"))).otherwise(date), F.lit("yyyy-MM-dd"))
    return F.coalesce(day < now, F.lit(False))


def past_month(start: Column, until: Column, checked: Column) -> Column:
    """The record's month lies before the month of its check."""
    return F.coalesce(text_month_index(F.coalesce(start, until)) < F.year(checked) * 12 + F.month(checked), F.lit(False))


def says_booked(snippet: Column) -> Column:
    return F.coalesce(says(date_text(snippet), BOOKED_IN_TEXT), F.lit(False))


def institution_name(name: Column) -> Column:
    """A key of an institution's name: umlauts spelt out, words for university and hospital unified, letters and digits only."""
    spelt = name
    for a, b in (("ä", "ae"), ("ö", "oe"), ("ü", "ue"), ("Ä", "Ae"), ("Ö", "Oe"), ("Ü", "Ue")):
        spelt = F.replace(spelt, F.lit(a), F.lit(b))
    text = F.replace(fold(spelt), F.lit("&"), F.lit(" and "))
    text = F.regexp_replace(text, r"\b(?:universitaet|universitat|university|universite|universita)\b", "universitat")
    text = F.regexp_replace(text, r"\b(?:hopitaux|hopital|hospital|spital|ospedale|clinique|clinic|klinik)\b", "hospital")
    return F.trim(F.regexp_replace(text, "[^a-z0-9]+", " "))


def institution_alias(key: Column) -> Column:
    return F.coalesce(lookup({name: k for k, names in lex.INSTITUTIONS.items() for name in names}, key), key)


def meaningful_tokens(key: Column) -> Column:
    return F.filter(F.split(key, " "), lambda t: (F.char_length(t) > 1) & ~t.isin(*lex.COMMON_TOKENS))


def institution_of_title(title: Column, default: Column) -> Column:
    """The last part of a title; the default without one."""
    parts = F.filter(F.transform(F.split(title, r"\s+[|\u2013-]\s+"), squeeze), lambda x: x != "")
    return F.coalesce(F.try_element_at(parts, F.lit(-1)), title, default)


def host(url: Column) -> Column:
    """Lower-case host with its port, null for what is no URL."""
    return F.nullif(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#]+)", 1)), F.lit(""))


def application_method(url: Column, page: Column, email: Column | None = None, no_url: str = "unknown") -> Column:
    """How to apply; ``no_url`` where a link or the page's address is no URL."""
    other = F.lit("not-specified") if email is None else F.when(email.isNotNull(), "email").otherwise("not-specified")
    ours, theirs = host(page), host(url)
    return F.when(url.isNull(), other).when(ours.isNull() | theirs.isNull(), no_url).when(ours == theirs, "online-form").otherwise("external-platform")


def placement_id(institution: Column, department: Column, role: Column, source: Column, url: Column) -> Column:
    """Three slugs of 48 characters at most and the start of a hash over what identifies a record."""
    identity = F.concat_ws("|", source, institution, F.coalesce(department, F.lit("")), role, url)
    return F.concat_ws("-", *(slug(F.coalesce(c, F.lit("unknown")), 48) for c in (institution, department, role)), F.substring(F.sha2(identity, 256), 1, 12))


def lead_time_key(source: Column, institution: Column, department: Column, role: Column) -> Column:
    return F.concat_ws("|", *(slug(c, 64) for c in (source, institution, F.coalesce(department, F.lit("unknown")), role)))


def hashed_id(kind: str, *parts: Column, length: int = 12) -> Column:
    return F.concat(F.lit(f"{kind}-"), F.substring(F.sha2(F.concat_ws("|", *(F.coalesce(p.cast("string"), F.lit("")) for p in parts)), 256), 1, length))
