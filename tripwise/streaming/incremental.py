"""Weekly increments as Structured Streaming jobs.

The raw zone holds one folder per week.  A file-source stream over a raw
table tells which weeks have received files since the last run; its
checkpoint records what was seen, so a run with nothing new does nothing.
Every week that changed is then read whole, as it stands now, and replaces
its own partition of the target.  So a week landed again replaces its rows, a
replayed micro-batch writes the same partition again, and a week whose files
come in several batches or drop out ends up as its folder says.
``trigger(availableNow=True)`` drains what is there and stops, which fits a
weekly batch schedule.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.cleanse import observed
from ..plans.processed import normalize_table
from ..schemas import PROCESSED_SCHEMAS, RAW_SCHEMAS
from ..sources.load import load_skip_bad_rows, read_weeks
from ..sources.sinks import WEEK, delete_path, list_weeks

WEEK_FIELD = T.StructField(WEEK, T.StringType(), True)
SEED = "seed"
# The file source ignores files older than this against the newest one it has
# seen; weeks may arrive late by any time, so practically none is too old.
MAX_FILE_AGE = "36500d"


def changed_weeks(spark: SparkSession, raw_table_dir: str, table: str, since_week: str | None = None,
                  max_files_per_trigger: int | None = None) -> DataFrame:
    """Stream of the weeks that newly landed files belong to.  Only the
    partition value is read, so drifted column types do not matter here.

    ``since_week`` keeps only partitions on/after that week: weeks before
    it are owned by the seeded snapshot, so a stream started after a reset
    never adds them twice."""
    schema = T.StructType(RAW_SCHEMAS[table].fields + [WEEK_FIELD])
    reader = (spark.readStream.schema(schema).option("basePath", raw_table_dir)
              .option("maxFileAge", MAX_FILE_AGE))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    df = reader.parquet(raw_table_dir).select(WEEK)
    return df if since_week is None else df.filter(F.col(WEEK) >= F.lit(since_week))


def run_available(spark: SparkSession, raw_table_dir: str, table: str,
                  transform: Callable[[DataFrame], DataFrame], sink_dir: str, checkpoint_dir: str,
                  since_week: str | None = None, max_files_per_trigger: int | None = None) -> int:
    """Bring the sink's weeks up to date with the raw zone and stop.  Returns
    the rows written by this run, counted by the writes themselves.

    Weeks that have left the raw zone leave the sink as well; the seed stays."""
    written: list[int] = []

    def replace_weeks(batch: DataFrame, epoch_id: int) -> None:
        weeks = sorted(r[WEEK] for r in batch.select(WEEK).distinct().collect())  # one row per week
        present = set(list_weeks(spark, raw_table_dir))
        weeks = [w for w in weeks if w in present]
        if not weeks:
            return
        raw = read_weeks(spark, raw_table_dir, weeks)
        rows = transform(load_skip_bad_rows(raw, T.StructType(RAW_SCHEMAS[table].fields + [WEEK_FIELD])))
        count = Observation()
        (rows.observe(count, F.count(F.lit(1)).alias("n")).hint("rebalance", WEEK)
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(WEEK).parquet(sink_dir))
        written.append(int(observed(count).get("n", 0)))
        drop_weeks(spark, sink_dir, set(weeks) - weeks_with_rows(spark, sink_dir, weeks, rows))

    q = (changed_weeks(spark, raw_table_dir, table, since_week, max_files_per_trigger)
         .writeStream.foreachBatch(replace_weeks)
         .option("checkpointLocation", checkpoint_dir)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    kept = set(list_weeks(spark, raw_table_dir))
    drop_weeks(spark, sink_dir, {w for w in list_weeks(spark, sink_dir) if w != SEED and w not in kept})
    return sum(written)


def weeks_with_rows(spark: SparkSession, sink_dir: str, weeks: list[str], rows: DataFrame) -> set[str]:
    """Weeks that the transformed rows still have.  Dynamic overwrite leaves
    a partition alone that gets no rows, so the others must be dropped."""
    stale = [w for w in weeks if w in set(list_weeks(spark, sink_dir))]
    if not stale:
        return set(weeks)
    return {r[WEEK] for r in rows.select(WEEK).distinct().collect()}


def drop_weeks(spark: SparkSession, sink_dir: str, weeks: set[str]) -> None:
    for w in weeks:
        delete_path(spark, f"{sink_dir}/{WEEK}={w}")


def read_loaded(spark: SparkSession, sink_dir: str, schema: T.StructType) -> DataFrame:
    """All weeks of a table written by ``run_available`` / seeds."""
    full = T.StructType(schema.fields + [WEEK_FIELD])
    if not list_weeks(spark, sink_dir):  # no week has had rows yet
        return spark.createDataFrame([], schema)
    return spark.read.schema(full).parquet(sink_dir).drop(WEEK)


def write_seed(df: DataFrame, sink_dir: str) -> None:
    """Initial rows of a table fed by ``run_available`` (replaces all weeks)."""
    (df.withColumn(WEEK, F.lit(SEED)).write.mode("overwrite")
     .option("partitionOverwriteMode", "static").partitionBy(WEEK).parquet(sink_dir))


def load_once(spark: SparkSession, raw_table_dir: str, table: str, typed_dir: str, checkpoint_dir: str,
              since_week: str | None = None) -> int:
    """Typed raw load: weeks without new files are not loaded again."""
    return run_available(spark, raw_table_dir, table, lambda rows: rows, typed_dir, checkpoint_dir, since_week)


def append_week_changes(spark: SparkSession, raw_table_dir: str, table: str,
                        processed_dir: str, checkpoint_dir: str,
                        since_week: str | None = None) -> int:
    """Weekly processed-zone step for one table (lodge or visit): changed
    weeks, region-normalised and filtered row by row."""
    columns = [f.name for f in PROCESSED_SCHEMAS[table].fields]
    return run_available(spark, raw_table_dir, table,
                         lambda rows: normalize_table(rows, table).select(*columns, WEEK),
                         processed_dir, checkpoint_dir, since_week)
