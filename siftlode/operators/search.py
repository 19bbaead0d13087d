"""Faceted search and token matching."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def faceted(df: DataFrame, facets: dict[str, str | None], query: str = "", fields: list[str] = ()) -> DataFrame:
    """Rows that equal every facet given and hold the query in the joined fields; empty facets and queries do not filter."""
    tests = [F.col(c) == v for c, v in facets.items() if v]
    if query.strip():
        joined = F.concat_ws(" ", *(F.nullif(F.col(c).cast("string"), F.lit("")) for c in fields))
        tests.append(F.contains(F.lower(joined), F.lit(query.strip().lower())))
    return df.filter(reduce(lambda a, b: a & b, tests)) if tests else df


def overlap(a: Column, b: Column) -> Column:
    """Share of the smaller token list's length that ``a`` has in ``b``, repeats counted."""
    return F.size(F.filter(a, lambda t: F.array_contains(b, t))) / F.least(F.size(a), F.size(b))


def _rarest(df: DataFrame, key: str, tokens: str, often: DataFrame, share: float) -> DataFrame:
    """(key, token): of each name as many of its rarest tokens that any name sharing ``share`` of its tokens has one of them; all where tokens repeat."""
    rows = df.select(key, F.size(tokens).alias("size"), F.size(F.array_distinct(tokens)).alias("distinct"), F.explode(F.array_distinct(tokens)).alias("token")).join(often, "token")
    by_name = rows.groupBy(key, "size", "distinct").agg(F.sort_array(F.collect_list(F.struct("n", "token"))).alias("all"))
    keep = F.when(F.col("size") > F.col("distinct"), F.col("distinct")).otherwise(F.col("distinct") - F.ceil(F.col("distinct") * F.lit(share)) + 1)
    return by_name.select(key, F.explode(F.slice("all", F.lit(1), F.greatest(keep, F.lit(1)).cast("int"))["token"]).alias("token"))


def sharing(left: DataFrame, right: DataFrame, left_key: str, right_key: str, left_tokens: str, right_tokens: str, share: float) -> DataFrame:
    """The pairs of keys that may share ``share`` of the smaller name's tokens: one of the smaller name's rarest is among the other's.

    Frequent tokens make no pairs, unless a name has no others.
    """
    every = lambda df, key, tokens: df.select(key, F.explode(F.array_distinct(tokens)).alias("token"))
    a, b = every(left, left_key, left_tokens), every(right, right_key, right_tokens)
    often = a.select("token").union(b.select("token")).groupBy("token").agg(F.count("*").alias("n"))
    pairs = _rarest(left, left_key, left_tokens, often, share).join(b, "token").select(left_key, right_key)
    return pairs.union(a.join(_rarest(right, right_key, right_tokens, often, share), "token").select(left_key, right_key)).distinct()


def token_matches(left: DataFrame, right: DataFrame, bound: float = 0.75, least: int = 2) -> DataFrame:
    """Pairs (left_name, right_name, score) of names whose tokens overlap."""
    tokens = lambda df, side: df.select(F.col("name").alias(f"{side}_name"), F.split("name", " ").alias(f"{side}_tokens"))
    a, b = tokens(left, "left"), tokens(right, "right")
    pairs = sharing(a, b, "left_name", "right_name", "left_tokens", "right_tokens", bound).join(a, "left_name").join(b, "right_name")
    scored = pairs.withColumn("score", overlap(F.col("left_tokens"), F.col("right_tokens")))
    enough = F.least(F.size("left_tokens"), F.size("right_tokens")) >= least
    return scored.filter(enough & (F.col("score") >= bound)).select("left_name", "right_name", "score")
