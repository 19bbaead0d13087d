"""Rules as data: each a name and a condition, exploded to issues or joined to reasons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fired(rules: dict[str, Column]) -> Column:
    """Names of the rules whose conditions hold, in order."""
    return F.array_compact(F.array(*(F.when(c, F.lit(n)) for n, c in rules.items())))


def issues(df: DataFrame, key: str, rules: dict[str, Column]) -> DataFrame:
    """(key, rule) for each rule that a row breaks."""
    return df.select(key, F.explode(fired(rules)).alias("rule"))


def reasons(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """``reasons`` in one text and their number as ``priority``."""
    return df.withColumn("__fired", fired(rules)).withColumns({"reasons": F.array_join("__fired", ";"), "priority": F.size("__fired").cast("long")}).drop("__fired")
