"""Grouped counts, rates and evidence summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftlode.functions.text import let


def facet_counts(df: DataFrame, facets: list[str], default: str = "unknown") -> DataFrame:
    """(facet, key, n) of all facets in one pass; nulls count under ``default``."""
    pairs = F.array(*(F.struct(F.lit(c).alias("facet"), F.coalesce(F.col(c).cast("string"), F.lit(default)).alias("key")) for c in facets))
    return df.select(F.explode(pairs).alias("p")).groupBy("p.facet", "p.key").agg(F.count("*").alias("n"))


def rate(part: Column, whole: Column) -> Column:
    """0 where the whole is 0."""
    return F.coalesce(F.try_divide(part, whole), F.lit(0.0))


def drop_rate(before: Column, after: Column) -> Column:
    """Share lost since before, not below 0; null where there was nothing before."""
    return F.when(before > 0, F.greatest(F.lit(0.0), (before - after) / before))


def counted_median(pairs: Column) -> Column:
    """The median of ``array<struct<value, n>>``, each value with its number; null values do not count. Counts are mergeable: nobody needs all values of a group."""
    there = F.array_sort(F.filter(pairs, lambda p: p["value"].isNotNull()))
    total = lambda ps: F.aggregate(ps, F.lit(0).cast("long"), lambda n, p: n + p["n"])

    def at(ps: Column, k: Column) -> Column:
        """The value at a place, from 1 on."""
        start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(None).cast("double").alias("value"))
        go = lambda seen, p: F.struct((seen["n"] + p["n"]).alias("n"), F.when((seen["n"] < k) & (seen["n"] + p["n"] >= k), p["value"].cast("double")).otherwise(seen["value"]).alias("value"))
        return F.aggregate(ps, start, go)["value"]

    half = lambda ps, n: (at(ps, F.floor((n + 1) / 2)) + at(ps, F.floor(n / 2) + 1)) / 2
    return let(there, lambda ps: let(total(ps), lambda n: half(ps, n)))


def rounded(median: Column) -> Column:
    """Halves rounded up."""
    return F.floor(median + 0.5)
