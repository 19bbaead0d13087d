"""Validation of a nested registry: one row for each broken rule, with the path of what breaks it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftlode.functions import lexicon as lex

#: What fields may be.
STATES = ("candidate", "verified", "inactive", "blocked", "needs-review")
FETCH_MODES = ("html", "playwright", "pdf", "manual")
SOURCE_LANGUAGES, SOURCE_REGIONS = ("de", "fr", "it", "en", "mixed", "unknown"), ("de-CH", "fr-CH", "it-CH", "mixed", "unknown")
KEBAB = "^[a-z0-9]+(?:-[a-z0-9]+)*$"
ADDRESS = r"^[A-Za-z][A-Za-z0-9+.-]*:[^\s]+$"


def _told(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit("")) != ""


def entry_rules() -> dict[str, dict[str, Column]]:
    """By field the rules that an entry must keep."""
    c = F.col
    required = lambda name: {f"{name} is required": _told(c(name))}
    return {
        "id": {"id is required": _told(c("id")), "id must use lowercase kebab-case": ~_told(c("id")) | c("id").rlike(KEBAB)},
        "institution": required("institution"),
        "canton": {"canton is known": c("canton").isin(*lex.CANTONS)},
        "city": required("city"),
        "language": {"language is known": c("language").isin(*lex.LANGUAGES)},
        "source_language": {"source language is known": F.coalesce("source_language", F.lit("unknown")).isin(*SOURCE_LANGUAGES)},
        "region": {"region is known": F.coalesce("region", F.lit("unknown")).isin(*SOURCE_REGIONS)},
        "notes": required("notes"),
        "priority": {"priority is a whole number of 1 to 5": c("priority").between(1, 5) & (c("priority") == F.floor(c("priority")))},
        "status": {"status is known": c("status").isin(*STATES)},
        "urls": {"urls must contain at least one URL": F.size(F.coalesce("urls", F.array())) > 0},
    }


def url_rules(u: Column) -> dict[str, dict[str, Column]]:
    """The same of an entry's address."""
    return {
        "url": {"url is an address": F.coalesce(u["url"], F.lit("")).rlike(ADDRESS)}, "page_type": {"page_type is required": _told(u["page_type"])},
        "parser": {"parser is required": _told(u["parser"])}, "fetch_mode": {"fetch mode is known": u["fetch_mode"].isin(*FETCH_MODES)},
    }


def _broken(rules: dict[str, dict[str, Column]]) -> Column:
    """(field, message) of the rules that do not hold; an unknown truth counts as broken."""
    rows = [F.when(~F.coalesce(holds, F.lit(False)), F.struct(F.lit(field).alias("field"), F.lit(message).alias("message"))) for field, by in rules.items() for message, holds in by.items()]
    return F.array_compact(F.array(*rows))


def violations(sources: DataFrame) -> DataFrame:
    """(entry, url, path, message) for each rule that ``sources`` breaks: fields of entries and of their addresses, and ids and addresses that stood before.

    sources: ``position`` (from 0), ``id, institution, canton, city, language, source_language, region, notes, priority, status`` and ``urls`` of structs (url, page_type, parser,
    fetch_mode). Entries and addresses are numbered from 1 in ``entry``, ``url`` and messages, from 0 in paths. Null ids and addresses are no repeats.
    """
    place = F.col("position")
    of_entry = sources.select(place, F.lit(None).cast("int").alias("nth"), F.inline(_broken(entry_rules())))
    urls = sources.select(place, F.posexplode("urls").alias("nth", "u"))
    of_url = urls.select(place, "nth", F.inline(_broken(url_rules(F.col("u")))))

    def repeats(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
        """The rows of a key but the first, with the first's place."""
        keys = rows.groupBy(key).agg(F.min(F.struct(*order)).alias("first"), F.count("*").alias("n")).filter("n > 1")
        return rows.filter(F.col(key).isNotNull()).join(keys, key).filter(F.struct(*order) > F.col("first"))

    ids = repeats(sources.select(place, "id"), "id", ["position"])
    of_id = ids.select(place, F.lit(None).cast("int").alias("nth"), F.lit("id").alias("field"), F.format_string('Duplicate source id "%s" also appears at entry %d.', "id", F.col("first.position") + 1).alias("message"))
    addresses = repeats(urls.select(place, "nth", F.col("u.url").alias("url")), "url", ["position", "nth"])
    again = F.format_string('Duplicate source URL "%s" also appears at entry %d, URL %d.', "url", F.col("first.position") + 1, F.col("first.nth") + 1)
    of_address = addresses.select(place, "nth", F.lit("url").alias("field"), again.alias("message"))
    rows = of_entry.unionByName(of_url).unionByName(of_id).unionByName(of_address)
    path = F.concat_ws(".", F.col("position").cast("string"), F.when(F.col("nth").isNotNull(), F.concat(F.lit("urls."), F.col("nth").cast("string"))), "field")
    return rows.select((place + 1).cast("long").alias("entry"), (F.col("nth") + 1).cast("long").alias("url"), path.alias("path"), "message")
