"""Bounded, reproducible samples of labelled documents for fitting small models."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Labelled rows that a model is fitted on at most, chosen by a hash of their id.
SAMPLE = 20_000


def id_crc(column="doc_id"):
    """crc32 of the id written as text."""
    return F.crc32(F.col(column).cast("string").cast("binary"))


def labelled_sample(labels: DataFrame, label: str, folds: int, held: int, limit: int = SAMPLE) -> DataFrame:
    """(doc_id, label) of at most ``limit`` documents outside the held-out fold.

    Rows without id or label are left out; of several labels of a document the larger counts.
    """
    known = labels.select("doc_id", F.col(label).cast("int").alias("label")).filter("doc_id is not null and label in (0, 1)")
    known = known.filter(id_crc() % folds != held).groupBy("doc_id").agg(F.max("label").alias("label"))
    return known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)


def sampled_texts(docs: DataFrame, sample: DataFrame) -> DataFrame:
    """(label, text) of the sample's documents; the sample is bounded, so it is broadcast."""
    return docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("label", "text")
