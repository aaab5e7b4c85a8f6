"""Registered queries of the operators, over their whole tables, and their
SQL for DuckDB where SQL can express the operator."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import ann, collocations, mixing, neardup, packing, prefix_counts, quality, sharding, suffix_dedup, token_files, toxicity, turn_repair, warc
from .common import table

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Re-Pair token files of all documents, read back."""
    return token_files.token_files(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


@query
def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 4096 tokens."""
    return packing.pack_documents(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


@query
def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 24 shards of near equal bytes, by virtual slots."""
    return sharding.shard_documents(table(spark, sf_dir, "documents"), 24)


@query
def op4_prefix_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of all documents from their stored prefix counts."""
    return prefix_counts.token_counts(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), 512)


@query
def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measurements, failure bits and the current policy's verdict."""
    return quality.judge(table(spark, sf_dir, "documents"))


ORACLE["op5_quality_rules"] = quality.oracle()


@query
def op10_warc_packages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as WARC records in ZIP packages and read back."""
    return warc.archived(table(spark, sf_dir, "pages"))


ORACLE["op10_warc_packages"] = """
WITH payloads AS (
  SELECT page_id, coalesce(html, '') AS payload FROM pages),
digests AS (
  SELECT page_id, CAST(strlen(payload) AS BIGINT) AS payload_bytes, sha256(payload) AS payload_digest FROM payloads),
firsts AS (
  SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS first_id FROM digests)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN first_id IS DISTINCT FROM page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first_id IS DISTINCT FROM page_id THEN first_id END AS refers_to
FROM firsts"""


@query
def op9_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to the sources' target weights."""
    return mixing.assign(table(spark, sf_dir, "documents"))


ORACLE["op9_source_mix"] = mixing.ORACLE


@query
def op8_toxic_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity scores and spans of all documents."""
    docs = table(spark, sf_dir, "documents")
    return toxicity.judge(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


@query
def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents."""
    return neardup.digest(table(spark, sf_dir, "documents"))


@query
def op6_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of every 20th vector, from the prefix forest."""
    return ann.nearest(table(spark, sf_dir, "embeddings"), k=20, every=20)


@query
def op13_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the bytes of passages that repeat."""
    return suffix_dedup.digest(table(spark, sf_dir, "documents"))


@query
def op11_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults and cheapest repairs of all conversations after damage."""
    return turn_repair.digest(table(spark, sf_dir, "conversations"))


@query
def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best phrases of every language of the documents."""
    return collocations.best(table(spark, sf_dir, "documents"))


ORACLE["op12_collocations"] = collocations.ORACLE
