"""Many fixed words looked for at once: one automaton reads a folded text once and tells which of them it holds.

The words are those of the languages (roles, applications, openings, refusals) and the names of departments. ``hits`` gives the
numbers of the words found; everything else is an expression over these few numbers.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftlode.functions import lexicon as lex
from siftlode.functions.placement import folded_name, language_words
from siftlode.functions.text import fold

#: Names of departments, folded, by key.
NAMES = {key: tuple(dict.fromkeys(folded_name(n) for names in by.values() for n in names)) for key, by in lex.DEPARTMENTS.items()}


@lru_cache(maxsize=1)
def numbers() -> dict[str, int]:
    """The number of each word. A word at even numbers is found anywhere; the next odd number says that it stands as words of its own."""
    words = dict.fromkeys(w for language in lex.LANGUAGES for w in language_words(language))
    words |= dict.fromkeys(n for names in NAMES.values() for n in names)
    return {w: 2 * i for i, w in enumerate(words)}


@lru_cache(maxsize=1)
def _automaton():
    out = ahocorasick.Automaton()
    for word, number in numbers().items():
        out.add_word(word, (number, len(word)))
    out.make_automaton()
    return out


def _edge(text: str, at: int) -> bool:
    """Whether no ASCII letter, digit or underscore stands at a place."""
    return not 0 <= at < len(text) or not (text[at].isascii() and (text[at].isalnum() or text[at] == "_"))


def found(text: str | None) -> list[int]:
    """The numbers of a folded text's words, in order."""
    out: set[int] = set()
    for end, (number, length) in _automaton().iter(text or ""):
        if number + 1 not in out:
            out.add(number)
            if _edge(text, end - length) and _edge(text, end + 1):
                out.add(number + 1)
    return sorted(out)


def _each(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for texts in batches:
        yield texts.map(found)


def hits(folded: Column) -> Column:
    """The numbers of the words that a folded text holds."""
    return F.pandas_udf(_each, "array<int>")(folded)


def _all(words, whole: bool = False) -> Column:
    """The numbers of words as one literal; a word that stands twice is there twice."""
    return F.split(F.lit(",".join(str(numbers()[w] + whole) for w in words)), ",").cast("array<int>")


def any_of(hits: Column, words) -> Column:
    return F.arrays_overlap(hits, _all(words))


def counted(hits: Column, words) -> Column:
    return F.size(F.filter(_all(words), lambda n: F.array_contains(hits, n)))


def language(hits: Column) -> Column:
    """The language with the most words, the earlier in order on a tie."""
    scores = F.array(*(counted(hits, language_words(name)) for name in lex.LANGUAGES))
    return F.element_at(F.array(*map(F.lit, lex.LANGUAGES)), F.array_position(scores, F.array_max(scores)).cast("int"))


def departments(hits: Column) -> Column:
    """Keys of the departments whose names stand in the text as words, in the order of the table."""
    return F.array_compact(F.array(*(F.when(F.arrays_overlap(hits, _all(names, True)), F.lit(key)) for key, names in NAMES.items())))


def matched(df: DataFrame, text: str) -> DataFrame:
    """The rows with ``language``, ``roles`` and ``applications`` (numbers of that language's words in the text) and ``departments``. A null text has none."""
    rows = df.withColumn("__hits", hits(fold(F.coalesce(text, F.lit("")))))
    rows = rows.withColumn("language", language(F.col("__hits")))
    of = lambda table: F.coalesce(*(F.when(F.col("language") == n, counted(F.col("__hits"), dict.fromkeys(table[n]))) for n in lex.LANGUAGES))
    return rows.withColumns({"roles": of(lex.ROLES), "applications": of(lex.APPLICATIONS), "departments": departments(F.col("__hits"))}).drop("__hits")
