"""From snapshots of pages to the records that are published: parsed, told apart by id, and enriched from the registry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftlode.functions.text import lookup
from siftlode.operators import parsers
from siftlode.operators.joins import enrich, with_fallback
from siftlode.operators.ordering import locale
from siftlode.operators.parsers import PARSERS
from siftlode.sources.json_files import failed

# The official snippet of a source whose document cannot be read.
SNIPPETS = {
    "spital-uster-chirurgie-unterassistenten-pdf": "Programm Unterassistenten Chirurgische Klinik. Programmtitel: Allgemeinchirurgie am Schwerpunktspital (Viszeralchirurgie und Traumatologie). "
    "Institution: Chirurgische Klinik, Spital Uster, 8610 Uster. Programmdauer: 1 - 3 Monate. Studenten pro Monat: 1 - 5.",
}
#: Addresses that are images.
ASSET = r"(?i)\.(?:avif|gif|jpe?g|png|svg|webp)$"


def known(value: Column, other: Column) -> Column:
    """The value, or where it is unknown the other."""
    return F.when(value.isNull() | (value == "unknown"), F.coalesce(other, F.lit("unknown"))).otherwise(value)


def failed_pages(snapshots: DataFrame) -> DataFrame:
    """The pages that failed, with what is said of them."""
    why = F.coalesce(F.nullif("error", F.lit("")), F.concat(F.lit("HTTP "), F.col("statusCode").cast("string")))
    return snapshots.filter(failed()).select("sourceId", "url", "statusCode", why.alias("error"))


def pages(snapshots: DataFrame, urls: DataFrame) -> DataFrame:
    """Snapshots that did not fail as pages for the parsers, with what the registry's ``urls(source_id, url, expected_parser, source_language, region)`` say of them."""
    told = F.struct("expected_parser", "source_language", "region")
    plain = snapshots.filter(~failed()).select(
        F.col("sourceId").alias("source_id"), "url", "title", F.col("visibleText").alias("visible_text"), F.col("extractedLinks").alias("links"), F.filter("extractedEmails", lambda x: ~x.rlike(ASSET)).alias("emails"),
        F.col("fetchedAt").alias("checked"), "file", F.col("textHash").alias("text_hash"),
    )
    found = with_fallback(plain, urls.select("source_id", "url", told.alias("told")), ["source_id", "url"], "source_id", "told")
    unknown = lambda c: F.coalesce(F.col(f"told.{c}"), F.lit("unknown")).alias(c)
    return found.select(*plain.columns, F.col("told.expected_parser").alias("expected_parser"), unknown("source_language"), unknown("region"))


def placements(snapshots: DataFrame, urls: DataFrame, sources: DataFrame, rules=PARSERS) -> DataFrame:
    """The records of all snapshots: of equal ids the first by file and place in its page, with what ``sources(id, institution, institution_type, canton, city)`` know.

    Records of little confidence need a review whatever their parser said; what is unknown of language and region comes from the registry; a hospital's canton and
    city fill those that are missing.
    """
    found = parsers.parse(pages(snapshots, urls), rules)
    found = found.withColumns({
        "record_source_language": known(F.col("record_source_language"), F.col("source_language")), "record_region": known(F.col("record_region"), F.col("region")),
        "review_status": F.when(F.col("confidence") == "low", "needs-human-review").otherwise(F.col("review_status")),
    })
    names = [c for c in found.columns if c not in ("visible_text", "links", "emails", "title")]
    first = found.groupBy("placement_id").agg(F.min_by(F.struct(*names), F.struct("file", "nth")).alias("r")).select("r.*")
    registry = sources.select(F.col("id").alias("source_id"), "institution", "canton", "city", (F.col("institution_type") == "hospital").alias("is_hospital"))
    out = first.withColumn("is_hospital", F.lit(None).cast("boolean"))
    out = enrich(out, registry, "source_id", replace=["institution", "is_hospital"], fill={"canton": F.col("is_hospital"), "city": F.col("is_hospital")}).drop("is_hospital")
    return out.withColumn("snippet", F.trim(F.coalesce(lookup(SNIPPETS, F.col("source_id")), F.col("snippet"))))


def order() -> list[Column]:
    """Institution, department, role and id, as a locale sorts them."""
    return [locale(c).asc() for c in ("institution", "department", "role_type", "placement_id")]
