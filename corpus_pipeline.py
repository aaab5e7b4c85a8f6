"""A training corpus from the table ``documents``: quality rules, toxicity,
near-duplicates, mixing to target weights, packing.

An empty table goes through all stages and gives no pieces.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next stage's docs.  All but the last return
the columns of ``documents``; the last returns the packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tripwise.llm import mixing, neardup, packing, quality, toxicity
from tripwise.llm.common import table, written
from tripwise.llm.queries import vocabulary
from tripwise.session import apply_sql_conf


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the current quality policy keeps: null and empty texts
    go, repeated rows are judged each, other columns stay as they are."""
    apply_sql_conf(spark)
    return quality.keep(docs)


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents not predicted toxic; the model learns from the tables.  Null
    texts and ids are scored like any, repeated rows each; without labels every
    document stays."""
    apply_sql_conf(spark)
    model = toxicity.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return toxicity.keep(docs, model)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component, the one of the smallest
    doc_id (null ids last); of equal rows one; rows without words all stay."""
    apply_sql_conf(spark)
    return neardup.keep(docs)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per copy that the mix takes, in training order; null sources
    are one source, texts without words are not taken."""
    apply_sql_conf(spark)
    return mixing.training_order(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all rows in sequences of at most 4096 tokens; a null text is
    its end id, repeated rows are packed each."""
    apply_sql_conf(spark)
    return packing.pack_documents(docs, vocabulary("word_bpe_49k.json"))


STAGES = [
    ("quality rules", quality_rules),
    ("toxicity", without_toxic),
    ("near-duplicates", without_near_duplicates),
    ("mixing", mixed_sources),
    ("packing", packed),
]

#: Toxicity, near-duplicates and packing are beyond SQL; tests compare with
#: brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    apply_sql_conf(spark)
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{number}")
    return docs
