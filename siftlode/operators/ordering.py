"""Order-dependent operators: first wins, previous occurrence, limits, ranks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_wins(df: DataFrame, key: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """Of the rows with equal keys, the first."""
    n = F.row_number().over(Window.partitionBy(*key).orderBy(*order))
    return df.withColumn("__n", n).filter("__n = 1").drop("__n")


def first_index(df: DataFrame, key: Sequence[str], position: str) -> DataFrame:
    """``first_position`` of the row's key, null for the first row itself."""
    first = F.first(position).over(Window.partitionBy(*key).orderBy(position))
    return df.withColumn("first_position", F.when(F.col(position) != first, first))


def limit_unique(df: DataFrame, key: str, position: str, limit: int) -> DataFrame:
    """Status per row: ``duplicate`` for later rows of a key, ``kept`` for the first ``limit`` others, ``beyond-limit``.

    Duplicates do not consume the limit; the limit is found by a top-k, not by a window over all rows.
    """
    nth = F.row_number().over(Window.partitionBy(key).orderBy(position))
    marked = df.withColumn("__nth", nth)
    kept = marked.filter("__nth = 1").orderBy(position).limit(limit).agg(F.max(position).alias("__last"))
    status = F.when(F.col("__nth") > 1, "duplicate").when(F.col(position) <= F.col("__last"), "kept").otherwise("beyond-limit")
    return marked.join(F.broadcast(kept), F.lit(True)).withColumn("status", status).drop("__nth", "__last")


def locale(column: str) -> Column:
    """A sort key by which texts, null as the empty one, go as a locale sorts them: letters before accents, accents before case, lower case first."""
    return F.collate(F.coalesce(F.col(column), F.lit("")), "UNICODE")


def places(df: DataFrame, groups: Sequence[str], within: Sequence[Column | str], name: str = "place") -> DataFrame:
    """The row's place, from 1 on, in the order of the groups' columns as a locale sorts them, and within a group in that of others.

    Only the groups' sizes are summed over all; rows are numbered within their groups.
    """
    keys = [F.coalesce(F.col(g), F.lit("")).alias(f"__{g}") for g in groups]
    rows = df.select("*", *keys)
    named = [f"__{g}" for g in groups]
    sizes = rows.groupBy(*named).agg(F.count("*").alias("__n"))
    before = sizes.withColumn("__before", F.sum("__n").over(Window.orderBy(*(F.collate(F.col(c), "UNICODE") for c in named), *named)) - F.col("__n"))
    nth = F.row_number().over(Window.partitionBy(*named).orderBy(*within))
    return rows.join(before, named).withColumn(name, (F.col("__before") + nth).cast("long")).drop(*named, "__n", "__before")
