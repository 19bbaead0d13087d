"""From raw documents to packed sequences, one operator a stage.

toxicity (7): documents with a toxic verdict go. line_dedup (8): repeated and near-repeated lines go, and
documents that lose all their words by it. ngram_join (10): of each group of near-duplicates one document stays.
mixing (4): documents are repeated or left out towards their source's target. packing (6): the words left, as token ids,
in sequences of 1024.

Every stage takes rows with nulls in any column, repeated rows and texts of any length, ignores columns beyond those
of documents, and gives an empty result for an empty table.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftlode.llm.line_dedup import dedup_lines
from siftlode.llm.mixing import mixed_documents
from siftlode.llm.ngram_join import one_of_each
from siftlode.llm.packing import pack_documents
from siftlode.llm.toxicity import fit, score
from siftlode.llm.workspace import Workspace, small_batches

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Verdicts at and above this score are toxic.
TOXIC = 0.7


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows that score below the bound, unchanged; null and empty texts score like texts without a toxic word, and stay."""
    small_batches(spark)
    model = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score(docs.select(*COLUMNS), model, passages=False).filter(F.col("score") < TOXIC).select(*COLUMNS)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows without their repeated lines, ``n_chars`` counted anew where some went. Rows that lose all words go; those that had none, or a null text, stay."""
    kept = dedup_lines(docs.select(*COLUMNS)).filter((F.col("n_dropped") == 0) | F.col("text").rlike(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"))
    n_chars = F.when(F.col("n_dropped") > 0, F.char_length("text").cast("long")).otherwise(F.col("n_chars"))
    return kept.withColumn("n_chars", n_chars).select(*COLUMNS)


def ngram_join_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the row with the smallest id, a null id last; rows without words are no duplicates, and stay."""
    return one_of_each(docs.select(*COLUMNS))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row as often as the mix takes it; a null source is one of its own, and rows without words may be left out."""
    return mixed_documents(docs.select(*COLUMNS))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all rows; a null or empty text is the end id alone."""
    small_batches(spark)
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", toxicity_stage),
    ("line_dedup", line_dedup_stage),
    ("ngram_join", ngram_join_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

#: SQL expresses neither the stages' models nor their joins; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each stage's result written and read again as the next one's."""
    ws = Workspace(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = ws.write(stage(spark, docs, sf_dir), name)
    return docs
