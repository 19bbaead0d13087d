"""The registry as a list of pages to read, and what became of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siftlode.functions.text import lookup
from siftlode.operators.changes import SEVERITY
from siftlode.operators.ordering import limit_unique, locale, places


def pages(sources: DataFrame) -> DataFrame:
    """A row per address of ``sources(id, position, urls)``: ``source_id, position, nth, url, fetch_mode, parser``."""
    rows = sources.select(F.col("id").alias("source_id"), "position", F.posexplode("urls").alias("nth", "u"))
    return rows.select("source_id", "position", "nth", F.col("u.url").alias("url"), F.col("u.fetch_mode").alias("fetch_mode"), F.col("u.parser").alias("parser"))


def plan(listed: DataFrame, limit: int, dry_run: bool = False) -> DataFrame:
    """``status`` of each page: later ones of an address are skipped and use up no limit, those beyond it wait; in a dry run nothing is read."""
    placed = listed.withColumn("place", F.col("position") * F.lit(1 << 20) + F.col("nth"))
    marked = limit_unique(placed, "url", "place", limit)
    kept = F.lit("skipped-dry-run" if dry_run else "pending")
    return marked.withColumn("status", F.when(F.col("status") == "duplicate", "skipped-duplicate").when(F.col("status") == "kept", kept).otherwise("skipped-limit")).drop("place")


def summary(entries: DataFrame) -> DataFrame:
    """One row of counts over ``entries(source_id, status)``."""
    status = F.col("status")
    return entries.agg(
        F.count_distinct("source_id").alias("sources"), F.count("*").alias("urls"), F.count_if(status == "success").alias("successes"), F.count_if(status == "failed").alias("failures"),
        F.count_if(status.startswith("skipped-")).alias("skipped"), F.count_if(status == "skipped-duplicate").alias("duplicates"),
    )


def parser_status(sources: DataFrame, records: DataFrame) -> DataFrame:
    """``(id, parser_status)`` per source: without records, with any that needs review, or parsed."""
    counts = records.groupBy(F.col("source_id").alias("id")).agg(F.bool_or(F.col("review_status") == "needs-human-review").alias("open"))
    both = sources.select("id").join(counts, "id", "left")
    return both.select("id", F.when(F.col("open").isNull(), "no-records").when(F.col("open"), "needs-human-review").otherwise("parsed").alias("parser_status"))


def source_rows(sources: DataFrame, records: DataFrame, changes: DataFrame) -> DataFrame:
    """What a source's own page shows: numbers of its records and changes, aggregated before they are joined."""
    r = records.groupBy(F.col("source_id").alias("id")).agg(F.count("*").alias("records"), F.max("checked").alias("last_checked"))
    c = changes.groupBy(F.col("source_id").alias("id")).agg(F.count("*").alias("changes"))
    both = sources.select("id").join(r, "id", "left").join(c, "id", "left")
    return both.select("id", F.coalesce("records", F.lit(0)).alias("records"), "last_checked", F.coalesce("changes", F.lit(0)).alias("changes"))


#: Rows of a part of a source's document, at most.
PART = 10_000


def source_documents(sources: DataFrame, records: DataFrame, changes: DataFrame, part: int = PART) -> DataFrame:
    """Each source with its records and changes in order: ``id``, ``part``, ``records`` and ``changes`` (arrays of structs).

    Records go by institution, department, role and id, changes by gravity, type and id. A source with more than ``part`` rows that follow one another in
    their order over all sources has several parts, numbered by that order, so that no row grows with the busiest source. A source without either has one empty part.
    """

    def parts(placed: DataFrame, name: str) -> DataFrame:
        rows = F.struct("place", *(c for c in placed.columns if c not in ("place", "source_id")))
        grouped = placed.groupBy(F.col("source_id").alias("id"), F.floor((F.col("place") - 1) / part).alias("part")).agg(F.array_sort(F.collect_list(rows)).alias(name))
        return grouped

    r = parts(places(records, ["institution", "department", "role_type"], [locale("id"), "id"]), "records")
    c = parts(places(changes.withColumn("gravity", (9 - lookup({k: str(n) for k, n in SEVERITY.items()}, F.col("severity")).cast("int")).cast("string")), ["gravity", "change_type"], [locale("change_id")]).drop("gravity"), "changes")
    both = r.join(c, ["id", "part"], "full_outer")
    return sources.select("id").join(both, "id", "left").select("id", F.coalesce("part", F.lit(0)).alias("part"), F.coalesce("records", F.array()).alias("records"), F.coalesce("changes", F.array()).alias("changes"))


def slices(text: str, starts: str, df: DataFrame, key: str) -> DataFrame:
    """The text from each start of a row to its next: rows ``(key, start, slice)`` of ``df(key, text, starts)``."""
    rows = df.select(key, text, F.explode(starts).alias("start"))
    following = F.lead("start").over(Window.partitionBy(key).orderBy("start"))
    end = F.coalesce(following, F.char_length(text) + 1)
    return rows.select(key, "start", F.trim(F.substring(F.col(text), F.col("start"), end - F.col("start"))).alias("slice"))
