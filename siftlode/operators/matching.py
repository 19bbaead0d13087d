"""Institutions of a registry, and baseline names matched to them: exact before alias before shared tokens."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftlode.functions import placement as pl
from siftlode.operators.search import sharing

#: Share of the smaller name's tokens that a match shares at least, and tokens of a name that need more than one.
SHARED, LEAST = 0.75, 2
EXCLUDED = r"(?i)\b(?:excluded|out[- ]of[- ]scope|not clinical placement)\b"


def institutions(sources: DataFrame, records: DataFrame, failed: DataFrame) -> DataFrame:
    """One row per normalised name: the first source's name, place and city, all source ids, states, languages and regions, records, and whether a crawl failed.

    sources: ``id, position, institution, canton, city, status, language, region``; failed: ``source_id``.
    """
    keyed = sources.withColumn("key", pl.institution_name(F.col("institution")))
    first = lambda c, default=None: F.coalesce(F.min_by(c, "position"), F.lit(default)) if default else F.min_by(c, "position")
    every = lambda c: F.array_sort(F.collect_set(c))
    out = keyed.groupBy("key").agg(
        first("institution").alias("institution"), first("canton", "unknown").alias("canton"), first("city", "unknown").alias("city"), F.array_sort(F.collect_list("id")).alias("source_ids"),
        every("status").alias("states"), every("language").alias("languages"), every("region").alias("regions"),
    )
    counts = records.groupBy(pl.institution_name(F.col("institution")).alias("key")).agg(F.count("*").alias("records"))
    broken = keyed.join(failed.select(F.col("source_id").alias("id")), "id", "left_semi").select("key").distinct().withColumn("failed", F.lit(True))
    both = out.join(counts, "key", "left").join(broken, "key", "left")
    to_verify = F.exists("states", lambda s: s.isin("candidate", "needs-review"))
    return both.withColumns({"records": F.coalesce("records", F.lit(0)), "failed": F.coalesce("failed", F.lit(False)), "to_verify": to_verify})


def _named(df: DataFrame, name: str) -> DataFrame:
    key = pl.institution_name(F.col(name))
    return df.withColumns({"key": key, "alias": pl.institution_alias(key), "tokens": pl.meaningful_tokens(key)})


def candidates(baseline: DataFrame, known: DataFrame) -> DataFrame:
    """(id, key, tier) of the pairs that match, in the best tier of each pair; candidates meet on a key, an alias or one of their rarest tokens.

    A name of one token meets all that have it; two that share three quarters of the smaller one's tokens share one of its rarest ones already.
    """
    a = _named(baseline, "name").select("id", F.col("key").alias("a_key"), F.col("alias").alias("a_alias"), F.col("tokens").alias("a_tokens"))
    b = _named(known, "institution").select(F.col("key").alias("b_key"), F.col("alias").alias("b_alias"), F.col("tokens").alias("b_tokens"))
    met = sharing(a, b, "id", "b_key", "a_tokens", "b_tokens", SHARED)
    met = met.union(a.join(b, F.col("a_alias") == F.col("b_alias")).select("id", "b_key")).distinct()
    pairs = met.join(a, "id").join(b, "b_key")
    shared = F.size(F.filter("a_tokens", lambda t: F.array_contains("b_tokens", t)))
    small = F.least(F.size("a_tokens"), F.size("b_tokens"))
    fuzzy = ((small >= LEAST) & (shared >= SHARED * small)) | ((F.size("a_tokens") == 1) & (shared == 1))
    tier = F.when(F.col("a_key") == F.col("b_key"), "exact").when(F.col("a_alias") == F.col("b_alias"), "alias").when(fuzzy, "fuzzy")
    return pairs.select("id", F.col("b_key").alias("key"), tier.alias("tier")).filter("tier is not null")


def match(baseline: DataFrame, known: DataFrame) -> DataFrame:
    """Per row of ``baseline(id, name, notes)``: ``status``, ``tier`` and the ``keys`` of the institutions matched.

    Exact matches go before all others, and the first of them by name counts; several others are ambiguous. known: ``institutions``.
    """
    found = candidates(baseline, known).join(known.select("key", F.col("institution").alias("label"), "records"), "key")
    hit = F.struct("label", "key", "records", "tier")
    by_id = found.groupBy("id").agg(F.count_if(F.col("tier") == "exact").alias("exact"), F.count("*").alias("n"), F.min(F.when(F.col("tier") == "exact", hit)).alias("best"), F.min(hit).alias("one"), F.array_sort(F.collect_set("key")).alias("all"))
    both = baseline.select("id", F.coalesce("notes", F.lit("")).rlike(EXCLUDED).alias("out")).join(by_id, "id", "left")
    chosen = F.coalesce("best", "one")
    several = (F.col("n") > 1) & (F.col("exact") == 0)
    status = F.when(F.col("out"), "excluded").when(F.col("n").isNull(), "missing").when(several, "ambiguous").when(chosen["records"] > 0, "covered").otherwise("likely-covered")
    tier = F.when(F.col("out"), "excluded").when(F.col("n").isNull(), "none").when(several, "ambiguous").otherwise(chosen["tier"])
    nothing = F.array().cast("array<string>")
    keys = F.when(F.col("out") | F.col("n").isNull(), nothing).when(several, F.col("all")).otherwise(F.array(chosen["key"]))
    return both.select("id", status.alias("status"), tier.alias("tier"), keys.alias("keys"))


def unmatched(known: DataFrame, matches: DataFrame) -> DataFrame:
    """Institutions that no baseline name matches; ambiguous matches count."""
    return known.join(matches.select(F.explode("keys").alias("key")).distinct(), "key", "left_anti")
