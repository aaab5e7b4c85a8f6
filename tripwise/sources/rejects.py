"""Typed loads that keep what they reject.

A continue-on-error load skips rows with a value that does not fit its column.
Here such rows are not lost: one pass tags every row, and one write puts the
good rows and the rejected ones side by side as two partitions.  A rejected
row keeps its file, its columns as far as they fit, and the name and text of
each value that does not.  The write itself counts both kinds.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.cleanse import observed
from .load import _cast, align_schema
from .sinks import WEEK, delete_path, file_system

STATUS, GOOD, REJECTED = "LOAD_STATUS", "good", "rejected"
FILE, FAULTS = "SOURCE_FILE", "FAULTS"
FAULT_TYPE = T.ArrayType(T.StructType([T.StructField("COLUMN_NAME", T.StringType()), T.StructField("VALUE", T.StringType())]))


@dataclass(frozen=True)
class Load:
    """A finished load: its tables and the rows that were read, loaded and
    rejected, counted by the job that wrote them."""

    good: DataFrame
    rejects: DataFrame
    read: int
    loaded: int
    rejected: int


def faults(df: DataFrame, schema: T.StructType) -> Column:
    """Names and texts of a row's values that can't be cast to their column."""
    by_lower = {f.name.lower(): f for f in df.schema.fields}
    found = []
    for f in schema.fields:
        src = by_lower.get(f.name.lower())
        if src is None or src.dataType == f.dataType:
            continue
        raw = F.col(f"`{src.name}`")
        bad = raw.isNotNull() & _cast(raw, src.dataType, f.dataType).isNull()
        found.append(F.when(bad, F.struct(F.lit(f.name).alias("COLUMN_NAME"), raw.cast("string").alias("VALUE"))))
    return F.array_compact(F.array(*found)).cast(FAULT_TYPE) if found else F.array().cast(FAULT_TYPE)


def tagged(df: DataFrame, schema: T.StructType, file: Column) -> DataFrame:
    """The typed columns (values that do not fit are NULL), the source file,
    the faults, the row's status, and the load week if there is one."""
    marked = df.withColumns({FILE: file, FAULTS: faults(df, schema)})
    typed = align_schema(marked, T.StructType(schema.fields + [T.StructField(FILE, T.StringType()), T.StructField(FAULTS, FAULT_TYPE)]
                                              + ([T.StructField(WEEK, T.StringType())] if WEEK in df.columns else [])))
    return typed.withColumn(STATUS, F.when(F.size(FAULTS) == 0, GOOD).otherwise(REJECTED))


def load_with_rejects(df: DataFrame, schema: T.StructType, target: str, file: Column | None = None) -> Load:
    """Load ``df`` (read from files) into ``target``: weeks it holds are
    replaced there, or without a week the whole table.

    Layout: ``[week=<w>/]LOAD_STATUS=<good|rejected>/``.  A null or missing
    value is no fault.  A load without rows empties an undated target."""
    spark = df.sparkSession
    rows = tagged(df, schema, F.col("_metadata.file_path") if file is None else file)
    dated = WEEK in df.columns
    keys = [WEEK, STATUS] if dated else [STATUS]
    counts, is_good = Observation(), F.col(STATUS) == GOOD
    # The folders written are few: two for each week of the load.
    rows = rows.observe(counts, F.count(F.lit(1)).alias("read"), F.count_if(is_good).alias("loaded"), F.count_if(~is_good).alias("rejected"),
                        F.collect_set(F.concat_ws("|", *[F.col(k) for k in keys])).alias("folders"))
    (rows.hint("rebalance", *keys).write.mode("overwrite").option("partitionOverwriteMode", "dynamic" if dated else "static")
     .partitionBy(*keys).parquet(target))
    seen = observed(counts)
    if dated:
        # Overwriting by partition leaves a status alone that got no rows.
        folders = {tuple(f.rsplit("|", 1)) for f in seen.get("folders") or [] if "|" in f}
        for week in {w for w, _ in folders}:
            for status in {GOOD, REJECTED} - {s for w, s in folders if w == week}:
                delete_path(spark, f"{target}/{WEEK}={week}/{STATUS}={status}")
    return Load(loaded(spark, schema, target, dated), rejects(spark, target, dated), *[int(seen.get(n, 0)) for n in ("read", "loaded", "rejected")])


def _part(spark: SparkSession, schema: T.StructType, target: str, dated: bool, status: str) -> DataFrame:
    """One status of a target; the other one's files are not read."""
    keys = ([T.StructField(WEEK, T.StringType())] if dated else []) + [T.StructField(STATUS, T.StringType())]
    fs, path, _ = file_system(spark, target)
    full = T.StructType(schema.fields + keys)
    if not fs.exists(path):
        return spark.createDataFrame([], full).drop(STATUS)
    return spark.read.schema(full).parquet(target).filter(F.col(STATUS) == status).drop(STATUS)


def loaded(spark: SparkSession, schema: T.StructType, target: str, dated: bool = True) -> DataFrame:
    """The good rows of a target."""
    return _part(spark, schema, target, dated, GOOD)


def rejects(spark: SparkSession, target: str, dated: bool = True) -> DataFrame:
    """The ledger of rejected values: [week,] SOURCE_FILE, COLUMN_NAME, VALUE,
    one row for each value."""
    kept = _part(spark, T.StructType([T.StructField(FILE, T.StringType()), T.StructField(FAULTS, FAULT_TYPE)]), target, dated, REJECTED)
    return kept.select(*([WEEK] if dated else []), FILE, F.inline(FAULTS))
