"""Queries of the corpus operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftlode.llm.bm25_wand import search
from siftlode.llm.language_id import languages
from siftlode.llm.license_scan import scan_licenses
from siftlode.llm.line_dedup import dedup_lines
from siftlode.llm.media_jpeg import media_columns
from siftlode.llm.mixing import mix
from siftlode.llm.ngram_join import near_duplicates
from siftlode.llm.packing import pack_documents
from siftlode.llm.periodic_runs import periodic_runs
from siftlode.llm.quality_gam import quality
from siftlode.llm.toxicity import toxicity
from siftlode.llm.turn_repair import damaged, repair
from siftlode.llm.warc import archived


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_media_jpeg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media_columns(table(spark, sf_dir, "documents"))


def op2_quality_gam(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_bm25_wand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every twentieth document's text as a query against all documents."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return search(docs, docs.filter("doc_id % 20 = 0").select(F.col("doc_id").alias("query_id"), "text"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).drop("source", "copies")


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(table(spark, sf_dir, "documents")).select("doc_id", "text", "n_lines", "n_dropped", "n_left")


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archived(table(spark, sf_dir, "pages"))


def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op11_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair(damaged(table(spark, sf_dir, "conversations")))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs(table(spark, sf_dir, "documents"), looped=True)


def op13_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return languages(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_media_jpeg, op2_quality_gam, op3_bm25_wand, op4_mixing, op5_license_scan, op6_packing, op7_toxicity, op8_line_dedup, op9_warc, op10_ngram_join, op11_turn_repair, op12_periodic_runs, op13_language_id)}


#: Base32 from the bits of the hexadecimal digest.
_OP9 = """with h as (select page_id, strlen(coalesce(html, '')) as n, sha1(coalesce(html, '')) as x, min(page_id) over (partition by coalesce(html, '')) as first from pages),
b as (select *, array_to_string(list_transform(range(1, 41), lambda j: right('000' || bin(instr('0123456789abcdef', x[j]) - 1), 4)), '') as bits from h)
select page_id, n as payload_bytes, array_to_string(list_transform(range(32), lambda i: 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[1 + list_sum(list_transform(range(1, 6), lambda k: bits[i * 5 + k]::int << (5 - k)))::int]), '') as payload_digest,
  case when page_id = first then 'response' else 'revisit' end as record_type, case when page_id <> first then first end as refers_to from b"""

#: All pairs that share a shingle, and the closure of their links; for tables of the size that tests have.
_OP10 = r"""with recursive w as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents),
s as (select distinct doc_id, unnest(case when len(w) >= 4 then list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) when len(w) > 0 then [array_to_string(w, ' ')] else [] end) as g from w),
n as (select doc_id, count(*) as n from s group by 1),
p as (select a.doc_id as x, b.doc_id as y, count(*) as c from s a join s b on a.g = b.g and a.doc_id < b.doc_id group by 1, 2),
l as (select x, y from p join n a on a.doc_id = x join n b on b.doc_id = y where 100 * c >= 85 * (a.n + b.n - c)),
e as (select x, y from l union all select y, x from l),
r as (select x as doc_id, x as root from e union select r.doc_id, e.y from r join e on r.root = e.x)
select d.doc_id, coalesce(n.n, 0) as n_shingles, coalesce(min(root), d.doc_id) as component_id from documents d left join n on n.doc_id = d.doc_id left join r on r.doc_id = d.doc_id group by d.doc_id, n.n"""


def oracle_sql() -> dict[str, str]:
    """SQL of the queries that it can express; models, codecs, tokenizers, samples and fuzzy lines are tested against brute force."""
    return {"op9_warc": _OP9, "op10_ngram_join": _OP10}
