"""Lookups and existence joins. Small sides are left to Spark's own size estimates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def enrich(df: DataFrame, lookup: DataFrame, on: str | list[str], replace: Sequence[str] = (), fill: dict[str, Column] | None = None) -> DataFrame:
    """Left join that replaces columns where the lookup has a row, and fills those in ``fill`` where null and its condition holds."""
    fill, keys = fill or {}, [on] if isinstance(on, str) else on
    other = lookup.select(*keys, *(F.col(c).alias(f"__{c}") for c in [*replace, *fill]))
    out = df.join(other, keys, "left")
    for c in replace:
        out = out.withColumn(c, F.coalesce(f"__{c}", c))
    for c, when in fill.items():
        out = out.withColumn(c, F.coalesce(F.col(c), F.when(when, F.col(f"__{c}"))))
    return out.drop(*(f"__{c}" for c in [*replace, *fill]))


def with_fallback(df: DataFrame, lookup: DataFrame, exact: list[str], loose: str, value: str) -> DataFrame:
    """``value`` by all of ``exact``, or by ``loose`` alone where the lookup has one row for it."""
    single = lookup.groupBy(loose).agg(F.count("*").alias("__n"), F.max(value).alias("__loose")).filter("__n = 1").drop("__n")
    out = df.join(lookup.select(*exact, F.col(value).alias("__exact")), exact, "left").join(single, loose, "left")
    return out.withColumn(value, F.coalesce("__exact", "__loose")).drop("__exact", "__loose")


def without(df: DataFrame, other: DataFrame, on) -> DataFrame:
    return df.join(other, on, "left_anti")


def having(df: DataFrame, other: DataFrame, on) -> DataFrame:
    return df.join(other, on, "left_semi")
