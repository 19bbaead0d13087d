"""The flagship query: enriched records with their review reasons, by source type and region."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftlode.plans import catalogue


def placement_overview(spark: SparkSession, folder: str) -> DataFrame:
    records = catalogue.enrich_left_join(spark, folder).join(catalogue.review_reasons(spark, folder), "o_orderkey")
    return records.groupBy("institution_type", "canton").agg(F.count("*").alias("records"), F.sum("priority").alias("reasons"), F.count_if(F.col("priority") == 0).alias("clean"))
