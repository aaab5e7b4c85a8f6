"""Sinks for the raw and processed zones.

Layout: ``<root>/<table>/week=<yyyy-MM-dd>/part-*.parquet`` for dated tables,
``<root>/metadata/<table>/`` for reference tables.  Weekly writes use
dynamic partition overwrite, so rewriting one week replaces exactly that
week and leaves every other week and table untouched.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import METADATA_MARKERS

WEEK = "week"
YEAR = "year"
# Upper bound of rows per output file: bounds task memory and output file
# size whatever the skew of a week.
MAX_RECORDS_PER_FILE = 2_000_000
# Rows of a bucket of a bucketed table, in expectation.
BUCKET_ROWS = 1_000_000


def is_metadata_table(name: str) -> bool:
    return any(m in name for m in METADATA_MARKERS)


def table_path(root: str, name: str) -> str:
    return f"{root}/metadata/{name}" if is_metadata_table(name) else f"{root}/{name}"


def _millis(df: DataFrame) -> DataFrame:
    """Timestamps are stored at millisecond precision."""
    ts = [f.name for f in df.schema.fields
          if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType))]
    return df.withColumns({c: F.date_trunc("millisecond", F.col(c)) for c in ts}) if ts else df


def _balanced(df: DataFrame, *cols: str) -> DataFrame:
    """Cluster rows by the partition columns before writing; adaptive
    execution splits oversized (skewed) partitions and merges small ones,
    so each week ends up in a few evenly sized files."""
    return df.hint("rebalance", *cols) if cols else df.hint("rebalance")


def write_weekly(df: DataFrame, root: str, name: str, mode: str = "overwrite",
                 replace_week: str | None = None) -> str:
    """Raw sink: dated tables partitioned by ``week``; reference tables
    routed to the un-dated metadata folder.  Dynamic overwrite leaves a week
    alone that gets no rows, so the week ``replace_week`` names is removed
    if ``df`` has none."""
    path = table_path(root, name)
    out = _millis(df)
    if is_metadata_table(name):
        return write_reference(out, root, name, if_exists="overwrite")
    if replace_week is not None and out.isEmpty():
        delete_path(df.sparkSession, f"{path}/{WEEK}={replace_week}")
        return path
    (_balanced(out, WEEK).write.mode(mode).partitionBy(WEEK)
     .option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
     .option("partitionOverwriteMode", "dynamic").parquet(path))
    return path


def write_reference(df: DataFrame, root: str, name: str, if_exists: str = "ignore") -> str:
    """Reference (metadata) table.  ``if_exists='ignore'`` keeps a table
    that is already there (first writer wins)."""
    path = f"{root}/metadata/{name}"
    df.write.mode(if_exists).parquet(path)
    return path


def write_yearly(df: DataFrame, root: str, name: str, date_col: str) -> str:
    path = f"{root}/{name}"
    out = df.withColumn(YEAR, F.year(F.col(date_col)).cast("string"))
    (_balanced(out, YEAR).write.mode("overwrite").partitionBy(YEAR)
     .option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
     .option("partitionOverwriteMode", "dynamic").parquet(path))
    return path


def write_processed(df: DataFrame, root: str, name: str, week: str | None = None) -> str:
    """Processed sink: snappy Parquet for one week (or the whole table).
    Output is balanced rather than forced into one file, so a large week
    is not funnelled through a single task."""
    path = f"{root}/{name}"
    out = df if week is None else df.withColumn(WEEK, F.lit(week))
    writer = (_balanced(out).write.mode("overwrite").option("compression", "snappy")
              .option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
              .option("partitionOverwriteMode", "dynamic"))
    if week is not None:
        writer = writer.partitionBy(WEEK)
    writer.parquet(path)
    return path


def file_system(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath, jvm


def list_folders(spark: SparkSession, root: str) -> list[str]:
    """Names of the folders directly under ``root`` (none: no such root)."""
    fs, hpath, _ = file_system(spark, root)
    if not fs.exists(hpath):
        return []
    return sorted(st.getPath().getName() for st in fs.listStatus(hpath)
                  if st.isDirectory() and not st.getPath().getName().startswith(("_", ".")))


def list_names(spark: SparkSession, root: str) -> list[tuple[str, ...]] | None:
    """Folder and file names below ``root`` of every file at any depth, apart
    from those hidden as in Spark's own listings (``None``: no such root)."""
    fs, hpath, _ = file_system(spark, root)
    if not fs.exists(hpath):
        return None
    base = fs.makeQualified(hpath).toUri().getPath().rstrip("/")
    found, files = [], fs.listFiles(hpath, True)
    while files.hasNext():
        parts = tuple(files.next().getPath().toUri().getPath()[len(base):].strip("/").split("/"))
        if not any(n.startswith(".") or (n.startswith("_") and "=" not in n) for n in parts):
            found.append(parts)
    return sorted(found)


def list_weeks(spark: SparkSession, table_root: str) -> list[str]:
    """Week partition values present under a table folder (a metadata
    listing of directory names only)."""
    return [n.split("=", 1)[1] for n in list_folders(spark, table_root) if n.startswith(WEEK + "=")]


def drop_from_week(spark: SparkSession, table_root: str, start_week: str) -> list[str]:
    """Delete every week partition on or after ``start_week`` (ISO dates);
    other folders (metadata, non-date names) are left alone.  Only
    directory entries are touched; no data is read or rewritten."""
    fs, hpath, jvm = file_system(spark, table_root)
    dropped = []
    for w in list_weeks(spark, table_root):
        if len(w) == 10 and w[4] == "-" and w >= start_week:
            fs.delete(jvm.org.apache.hadoop.fs.Path(f"{table_root}/{WEEK}={w}"), True)
            dropped.append(w)
    return dropped


def delete_path(spark: SparkSession, path: str) -> bool:
    """Remove a folder (e.g. a stream checkpoint being reset)."""
    fs, hpath, _ = file_system(spark, path)
    return bool(fs.delete(hpath, True)) if fs.exists(hpath) else False


def bucket_count(spark: SparkSession, *rows: int, bucket_rows: int = BUCKET_ROWS) -> int:
    """Buckets for tables of so many rows: one task reads (and one writes and
    sorts) a whole bucket, so their number grows with the largest table and a
    bucket does not; small tables get one bucket for each core."""
    return max(spark.sparkContext.defaultParallelism, -(-max(rows) // bucket_rows))


def write_bucketed(df: DataFrame, database: str, name: str, path: str, key: str,
                   buckets: int) -> DataFrame:
    """Catalog table hash-bucketed (and sorted) on ``key``.  Tables joined
    on the same key with the same bucket count are read already
    co-partitioned, so the weekly marts that join them skip the shuffle of
    both sides.  Rows are rebalanced on the bucket hash (the same placement
    as the bucket id), so each write task holds whole buckets, except that
    adaptive execution splits an oversized (hot) bucket over several tasks,
    each writing its own file of that bucket."""
    full = f"`{database}`.`{name}`"
    (df.hint("rebalance", buckets, key).write.mode("overwrite").format("parquet")
     .option("path", path).bucketBy(buckets, key).sortBy(key).saveAsTable(full))
    return df.sparkSession.table(full)


def reset_to_date(spark: SparkSession, table_root: str, date_column: str, cutoff: str, schema: T.StructType) -> None:
    """Keep only rows dated before ``cutoff`` (ISO date), also inside a week.

    Weeks that begin on or after it are dropped as folders.  The one week that
    begins before and may reach beyond is rewritten: its rows before the date
    are staged, and the staged folder takes the old one's place by renames.  A
    run that died between them is repaired by the next one.  Rows of a dated
    week whose own date is missing go with the cut-off, as in a filter."""
    fs, _, jvm = file_system(spark, table_root)
    path = jvm.org.apache.hadoop.fs.Path
    replaced, staging = ".replaced-", ".staged-"  # hidden from readers
    for name in [s.getPath().getName() for s in fs.listStatus(path(table_root))]:
        if name.startswith(replaced):
            old, place = path(f"{table_root}/{name}"), path(f"{table_root}/{name.removeprefix(replaced)}")
            if fs.exists(place):
                fs.delete(old, True)
            else:
                fs.rename(old, place)
    drop_from_week(spark, table_root, cutoff)
    weeks = [w for w in list_weeks(spark, table_root) if len(w) == 10 and w < cutoff]
    if not weeks:
        return
    folder = f"{WEEK}={max(weeks)}"
    rows = spark.read.schema(schema).parquet(f"{table_root}/{folder}").filter(F.col(date_column) < F.to_date(F.lit(cutoff)))
    staged = f"{table_root}/{staging}{folder}"
    rows.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(staged)
    old = path(f"{table_root}/{replaced}{folder}")
    fs.rename(path(f"{table_root}/{folder}"), old)
    fs.rename(path(staged), path(f"{table_root}/{folder}"))
    fs.delete(old, True)
