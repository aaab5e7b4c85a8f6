"""Joins whose output is meant to multiply, on keys that may be hot."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TIMES_LEFT, TIMES_RIGHT, BLOCKS, BLOCK = "__times_left", "__times_right", "__blocks", "__block"


def fan_out(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """keys, distinct rows of both sides, and the rows their join has: to look
    at before the join is written.  Null keys meet nothing."""
    sides = []
    for df, name in ((left, "left"), (right, "right")):
        rows = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("m"))
        sides.append(rows.groupBy(*keys).agg(F.count(F.lit(1)).alias(f"{name}_distinct"), F.sum("m").alias(f"{name}_rows")))
    return sides[0].join(sides[1], keys).withColumn("joined_rows", F.col("left_rows") * F.col("right_rows"))


def fan_out_join(left: DataFrame, right: DataFrame, keys: list[str], cell_pairs: int = 1_000_000) -> DataFrame:
    """Inner join on ``keys``, every pair of rows kept.

    Both sides are reduced to distinct rows with multiplicities before they
    are exchanged.  A key whose distinct rows make more than ``cell_pairs``
    pairs is cut into blocks: its left rows are dealt to them by a hash, its
    right rows go to each.  Pairs are repeated last, by a narrow step."""
    a = left.groupBy(*left.columns).agg(F.count(F.lit(1)).alias(TIMES_LEFT))
    b = right.groupBy(*right.columns).agg(F.count(F.lit(1)).alias(TIMES_RIGHT))
    sizes = a.groupBy(*keys).agg(F.count(F.lit(1)).alias("l")).join(b.groupBy(*keys).agg(F.count(F.lit(1)).alias("r")), keys)
    hot = sizes.select(*keys, F.ceil(F.col("l") * F.col("r") / F.lit(cell_pairs)).cast("int").alias(BLOCKS)).filter(F.col(BLOCKS) > 1)
    blocks = F.coalesce(BLOCKS, F.lit(1))
    a = a.join(hot, keys, "left").withColumn(BLOCK, F.pmod(F.xxhash64(*left.columns), blocks).cast("int")).drop(BLOCKS)
    b = b.join(hot, keys, "left").withColumn(BLOCK, F.explode(F.sequence(F.lit(0), blocks - 1))).drop(BLOCKS)
    pairs = a.join(b, [*keys, BLOCK])
    copies = F.sequence(F.lit(1).cast("long"), F.col(TIMES_LEFT) * F.col(TIMES_RIGHT))
    return pairs.withColumn("__copy", F.explode(copies)).drop(BLOCK, TIMES_LEFT, TIMES_RIGHT, "__copy")
