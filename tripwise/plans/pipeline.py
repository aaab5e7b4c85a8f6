"""Run modes of the weekly job (what the source system's scheduler chose).

``reset``       drop raw weeks on/after the cut-off, reseed the processed
                table from raw rows before the cut-off, then the weekly step;
``initial``     reseed the processed table, then the weekly step.  Every
                reseed clears the stream's checkpoint, so all raw weeks on or
                after the cut-off are loaded again next to the new seed;
``incremental`` the weekly step only.
The weekly step slices one week from the source, writes it into the
week-partitioned raw zone (replacing that week only) and streams the newly
landed files into the processed table.  Every step is a DataFrame job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.slicing import week_slice
from ..schemas import PROCESSED_SCHEMAS
from ..sources.sinks import delete_path, drop_from_week, write_weekly
from ..streaming.incremental import append_week_changes, read_loaded, write_seed
from .processed import normalize_table, seed_processed
from pyspark.sql import functions as F

MODES = ("reset", "initial", "incremental")


def seed(raw: DataFrame, table: str, cutoff: str, processed_dir: str) -> None:
    """Seed one processed table: raw rows before the cut-off, normalised."""
    seeded = normalize_table(seed_processed(raw, table, cutoff), table)
    write_seed(seeded.select(*[f.name for f in PROCESSED_SCHEMAS[table].fields]), processed_dir)


def land_week(source: DataFrame, table: str, week_start: str, week_end: str, raw_root: str) -> str:
    """Slice one week of a source table and write it as that week's raw
    partition (other weeks untouched; an empty slice empties the week)."""
    sliced = week_slice(source, table, week_start, week_end).withColumn("week", F.lit(week_start))
    return write_weekly(sliced, raw_root, table, replace_week=week_start)


def run(spark: SparkSession, mode: str, table: str, source: DataFrame, raw_root: str,
        processed_dir: str, checkpoint_dir: str, cutoff: str,
        week_start: str, week_end: str) -> DataFrame:
    """Bring one processed table up to date for one week and return it."""
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    raw_dir = f"{raw_root}/{table}"
    if mode == "reset":
        drop_from_week(spark, raw_dir, cutoff)
    if mode in ("reset", "initial"):
        delete_path(spark, checkpoint_dir)
        seed(source, table, cutoff, processed_dir)
    land_week(source, table, week_start, week_end, raw_root)
    append_week_changes(spark, raw_dir, table, processed_dir, checkpoint_dir, since_week=cutoff)
    return read_loaded(spark, processed_dir, PROCESSED_SCHEMAS[table])

