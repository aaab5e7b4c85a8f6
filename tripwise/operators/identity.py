"""Whole-row identity by 128-bit fingerprints."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .joins import bounded_broadcast

HIGH, LOW, COUNT = "__row_high", "__row_low", "__row_count"


def fingerprints(columns: list[str]) -> list[Column]:
    """Two 64-bit hashes of a row; which columns are null is hashed as well,
    as the hash itself passes nulls over."""
    nulls = F.concat(*[F.when(F.col(f"`{c}`").isNull(), "1").otherwise("0") for c in columns])
    return [F.xxhash64(F.lit(seed), nulls, *[F.col(f"`{c}`") for c in columns]).alias(name) for seed, name in ((1, HIGH), (2, LOW))]


def repeated(df: DataFrame) -> DataFrame:
    """Fingerprints that more than one row has, and how many: the only
    exchange carries 16 bytes and a count for each distinct row of a task."""
    return df.select(*fingerprints(df.columns)).groupBy(HIGH, LOW).agg(F.count(F.lit(1)).alias(COUNT)).filter(F.col(COUNT) > 1)


def distinct_rows(df: DataFrame) -> DataFrame:
    """``df.distinct()`` for wide rows that seldom repeat.

    Rows whose fingerprint is alone are passed on where they are.  Only rows
    that share one are exchanged whole and compared column by column, so two
    rows that collide both stay."""
    path = scratch_path(df.sparkSession, "fingerprints")
    repeated(df).write.parquet(path)
    found = df.sparkSession.read.parquet(path)
    marked = df.select("*", *fingerprints(df.columns)).join(bounded_broadcast(found), [HIGH, LOW], "left")
    alone = marked.filter(F.col(COUNT).isNull()).select(*df.columns)
    return alone.unionByName(marked.filter(F.col(COUNT).isNotNull()).select(*df.columns).distinct())
