"""Typed loads into the raw warehouse tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import RAW_SCHEMAS
from .sinks import delete_path, list_weeks


def typed_empty(spark: SparkSession, table: str) -> DataFrame:
    return spark.createDataFrame([], RAW_SCHEMAS[table])


def _cast(c: Column, src: T.DataType, dst: T.DataType) -> Column:
    if src == dst:
        return c
    if isinstance(dst, T.DateType):
        return F.try_to_date(c.cast("string")) if not isinstance(src, (T.TimestampType, T.TimestampNTZType)) else c.cast("date")
    if isinstance(src, T.BinaryType) and isinstance(dst, T.StringType):
        return c.cast("string")
    return c.try_cast(dst)


def align_schema(df: DataFrame, schema: T.StructType, keep_extra: bool = False) -> DataFrame:
    """Load by column name, ignoring letter case: every target column is
    taken from the matching source column and cast to its type (bad values
    become NULL); missing columns load as NULL; extra source columns are
    dropped unless ``keep_extra``."""
    by_lower = {f.name.lower(): f for f in df.schema.fields}
    cols = []
    for f in schema.fields:
        src = by_lower.get(f.name.lower())
        if src is None:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
        else:
            cols.append(_cast(F.col(f"`{src.name}`"), src.dataType, f.dataType).alias(f.name))
    if keep_extra:
        wanted = {f.name.lower() for f in schema.fields}
        cols += [F.col(f"`{f.name}`") for f in df.schema.fields if f.name.lower() not in wanted]
    return df.select(*cols)


def load_skip_bad_rows(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Like ``align_schema`` but a row with any value that cannot be cast
    to its column type is skipped (continue-on-error load)."""
    by_lower = {f.name.lower(): f for f in df.schema.fields}
    ok = F.lit(True)
    for f in schema.fields:
        src = by_lower.get(f.name.lower())
        if src is None or src.dataType == f.dataType:
            continue
        raw = F.col(f"`{src.name}`")
        ok = ok & (raw.isNull() | _cast(raw, src.dataType, f.dataType).isNotNull())
    return align_schema(df.filter(ok), schema)


def read_matching(spark: SparkSession, root: str, pattern: str,
                  schema: T.StructType | None = None) -> DataFrame:
    """Raw files below ``root`` whose full path matches a regex (the
    source system's COPY ... PATTERN).  The predicate is on the file-path
    metadata column, so non-matching files are pruned at listing time.
    Columns are the union over all files; a column's types must agree."""
    reader = spark.read.option("recursiveFileLookup", "true").option("mergeSchema", "true")
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.parquet(root)
    return df.filter(F.col("_metadata.file_path").rlike(pattern))


def bulk_load(spark: SparkSession, raw_root: str, table: str, target: str,
              pattern: str | None = None, skip_bad_rows: bool = True) -> DataFrame:
    """Initial load of one typed table from every raw file of that table
    (replaces the table: truncate + load)."""
    src = read_matching(spark, f"{raw_root}/{table}", pattern or ".*\\.parquet$")
    typed = (load_skip_bad_rows(src, RAW_SCHEMAS[table]) if skip_bad_rows
             else align_schema(src, RAW_SCHEMAS[table]))
    typed.write.mode("overwrite").parquet(target)
    return spark.read.schema(RAW_SCHEMAS[table]).parquet(target)


def read_weeks(spark: SparkSession, table_dir: str, weeks: list[str]) -> DataFrame:
    """The named week partitions of a raw table; only their folders are
    listed, and columns are the union over their files."""
    return (spark.read.option("basePath", table_dir).option("mergeSchema", "true")
            .parquet(*[f"{table_dir}/week={w}" for w in weeks]))


def write_typed_weeks(df: DataFrame, target: str) -> None:
    """Typed table stored by load week: a week written again replaces that
    week only (dynamic partition overwrite), so re-running a load is
    exactly-once."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("week").parquet(target))


def read_typed_weeks(spark: SparkSession, table: str, target: str) -> DataFrame:
    schema = T.StructType(RAW_SCHEMAS[table].fields + [T.StructField("week", T.StringType(), True)])
    if not list_weeks(spark, target):  # no week has had rows yet
        return typed_empty(spark, table)
    return spark.read.schema(schema).parquet(target).drop("week")


def weekly_append(spark: SparkSession, raw_root: str, table: str, week: str, target: str) -> DataFrame:
    """Load one week: only the ``week=<week>`` partition of the raw zone is
    listed and read, aligned to the typed schema and written as that week of
    the typed table.  A week that has no rows (any more) is emptied there."""
    raw_dir, stale = f"{raw_root}/{table}", f"{target}/week={week}"
    if week not in list_weeks(spark, raw_dir):
        delete_path(spark, stale)
        return read_typed_weeks(spark, table, target)
    typed = load_skip_bad_rows(read_weeks(spark, raw_dir, [week]).drop("week"), RAW_SCHEMAS[table])
    if typed.isEmpty():
        delete_path(spark, stale)
    else:
        write_typed_weeks(typed.withColumn("week", F.lit(week)), target)
    return read_typed_weeks(spark, table, target)


def truncate(spark: SparkSession, table: str, path: str) -> DataFrame:
    """TRUNCATE: replace a typed table's data with no rows, keeping its schema."""
    typed_empty(spark, table).write.mode("overwrite").parquet(path)
    return spark.read.schema(RAW_SCHEMAS[table]).parquet(path)


def ensure_database(spark: SparkSession, database: str, location: str) -> str:
    """A catalog namespace (schema) whose files live under ``location``."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}` LOCATION '{location}'")
    return database


def ctas(df: DataFrame, name: str, path: str, database: str | None = None) -> DataFrame:
    """CREATE OR REPLACE TABLE ... AS SELECT: an external catalog table
    whose data lives at ``path``; ``database`` qualifies the name instead of
    switching the session's current namespace."""
    full = f"`{database}`.`{name}`" if database else name
    df.write.mode("overwrite").option("path", path).format("parquet").saveAsTable(full)
    return df.sparkSession.table(full)


def insert_select(df: DataFrame, name: str) -> DataFrame:
    """INSERT INTO name SELECT ...: columns are matched by name."""
    target = df.sparkSession.table(name)
    df.select(*target.columns).write.insertInto(name)
    return df.sparkSession.table(name)
