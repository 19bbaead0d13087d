"""Lead-time evidence over runs: each build appends its observations to a table, which is read as a stream with ``availableNow``.

An observation that came before, by its id, is dropped in the stream's state, so that a build that runs again adds nothing. What is kept goes to a table of
distinct evidence and is summarised over all runs, so that a place seen in three runs has its three observations.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftlode.operators.evidence import summaries

SCHEMA = "record_id string, place string, source_id string, target string, observed_at timestamp, kind string, months int, confidence string, label string, id string"


def append(evidence: DataFrame, folder: str, run: str) -> None:
    """A build's evidence to the table of observations, partitioned by run; a run that is written again replaces itself."""
    columns = [c.strip().split(" ")[0] for c in SCHEMA.split(",")]
    evidence.select(*columns).write.mode("overwrite").parquet(f"{folder}/run={run}")


def collect(spark: SparkSession, folder: str, distinct: str, checkpoint: str, delay: str | None = None) -> None:
    """Everything new in the table of observations to that of distinct evidence, then stop.

    checkpoint: a folder that all executors share; the stream's state and place are there, so a stopped stream goes on. With a ``delay``, such as ``90 days``, ids are
    forgotten that long after the latest observation, and the state stays bounded; without one, all ids are known for ever.
    """
    rows = spark.readStream.schema(SCHEMA).option("recursiveFileLookup", "true").parquet(folder).filter("id is not null")
    once = rows.withWatermark("observed_at", delay).dropDuplicatesWithinWatermark(["id"]) if delay else rows.dropDuplicates(["id"])
    stream = once.writeStream.format("parquet").option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start(distinct)
    stream.awaitTermination()


def summarised(spark: SparkSession, distinct: str) -> DataFrame:
    """The summaries of all evidence so far, and ``first_seen``, when a place was observed first."""
    rows = spark.read.schema(SCHEMA).parquet(distinct)
    first = rows.groupBy("place").agg(F.min("observed_at").alias("first_seen"))
    return summaries(rows, "id").join(first, "place", "left")
