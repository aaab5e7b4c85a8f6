"""Exact distinct counts that merge.

Ids get dense numbers from a dictionary that only grows.  The ids of a group are
then bitmaps of 32,768 numbers each, built and joined by Spark's own bitmap
aggregates.  Bitmaps of weeks merge by OR, so a distinct count over any set of
weeks reads their bitmaps and no rows, and several distinct counts in one job
need no expanded rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path
from ..sources.sinks import WEEK, file_system, list_folders

ID, DENSE, BUCKET, BITS = "ID", "DENSE", "BUCKET", "BITS"
DICTIONARY = T.StructType([T.StructField(ID, T.StringType()), T.StructField(DENSE, T.LongType())])


def dictionary(spark: SparkSession, path: str) -> DataFrame:
    """ID, DENSE of all finished generations; numbers begin at 0."""
    done = generations(spark, path)
    return spark.read.schema(DICTIONARY).parquet(*[f"{path}/{g}" for g in done]) if done else spark.createDataFrame([], DICTIONARY)


def generations(spark: SparkSession, path: str) -> list[str]:
    """Folders that were written to the end; a broken one is written anew."""
    fs, _, jvm = file_system(spark, path)
    names = [n for n in list_folders(spark, path) if n.startswith("gen=")]
    return sorted(n for n in names if fs.exists(jvm.org.apache.hadoop.fs.Path(f"{path}/{n}/_SUCCESS")))


def grow(spark: SparkSession, ids: DataFrame, path: str) -> DataFrame:
    """Give numbers to the ids (column ID) that have none, as one further
    generation; numbers given before stay.  Null ids get none.

    The new ids are written once, so their place in their partition is fixed;
    a partition's numbers begin where the one before ends, and only one count
    per partition is put in order."""
    known = dictionary(spark, path)
    fresh = ids.select(F.col(ID).cast("string").alias(ID)).filter(F.col(ID).isNotNull()).distinct().join(known, ID, "left_anti")
    staged_at = scratch_path(spark, "dictionary")
    mask = (1 << 33) - 1
    (fresh.select(ID, F.spark_partition_id().alias("part"), F.monotonically_increasing_id().bitwiseAND(F.lit(mask)).alias("place"))
     .write.parquet(staged_at))
    staged = spark.read.parquet(staged_at)
    first = known.agg(F.coalesce(F.max(DENSE) + 1, F.lit(0))).first()[0]
    sizes = staged.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    before = sizes.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n") + F.lit(first)).alias("start"))
    numbered = staged.join(F.broadcast(before), "part").select(ID, (F.col("start") + F.col("place")).alias(DENSE))
    numbered.write.mode("overwrite").parquet(f"{path}/gen={len(generations(spark, path)):06d}")
    return dictionary(spark, path)


def numbered(rows: DataFrame, column: str, numbers: DataFrame, name: str) -> DataFrame:
    """``rows`` with the dense number of an id column (null: none)."""
    return rows.join(numbers.select(F.col(ID).alias(column), F.col(DENSE).alias(name)), column, "left")


def bitmaps(rows: DataFrame, groups: list[str], number: str) -> DataFrame:
    """groups, BUCKET, BITS: the numbers that each group has."""
    return (rows.filter(F.col(number).isNotNull()).groupBy(*groups, F.bitmap_bucket_number(number).alias(BUCKET))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias(BITS)))


def replace_weeks(rows: DataFrame, groups: list[str], number: str, path: str) -> None:
    """Write the bitmaps of the weeks in ``rows``, replacing theirs."""
    (bitmaps(rows, [WEEK, *groups], number).hint("rebalance", WEEK).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(WEEK).parquet(path))


def counts(states: DataFrame, groups: list[str], name: str) -> DataFrame:
    """groups and the distinct count over all weeks of the states."""
    return (states.groupBy(*groups, BUCKET).agg(F.bitmap_or_agg(BITS).alias(BITS))
            .groupBy(*groups).agg(F.sum(F.bitmap_count(BITS)).alias(name)))
