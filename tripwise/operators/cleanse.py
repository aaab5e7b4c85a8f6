"""Cleansing of raw source files (column pruning, null rows, binary text)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import KEEP_COLUMNS, UNUSED_TABLES

TRAVEL_KEY = "tn_travel_travel"


def table_key(file_name: Column) -> Column:
    """Table key of a source file: its first three '_'-separated tokens; any
    travel file ('tn_travel_...') resolves to the travel table.  Traveller
    files keep their own three-token key."""
    base = F.substring_index(file_name, "_", 3)
    return F.when(base.contains("tn_travel_"), F.lit(TRAVEL_KEY)).otherwise(base)


def is_unused_table(key: Column) -> Column:
    return key.isin(*UNUSED_TABLES)


def is_reference_key(key: str) -> bool:
    """Code tables ('tc...') pass through cleansing untouched."""
    return key.startswith("tc")


def prune_columns(df: DataFrame, key: str) -> DataFrame | None:
    """Keep-list of the table intersected with the columns present; None
    when nothing is left (table skipped)."""
    keep = [c for c in KEEP_COLUMNS.get(key, []) if c in df.columns]
    return df.select(*keep) if keep else None


def drop_null_rows(df: DataFrame) -> DataFrame:
    """Drop rows with a NULL (or NaN) in any column."""
    return df.na.drop(how="any")


def binary_to_string(df: DataFrame) -> DataFrame:
    """Binary columns (text stored without a string annotation) -> string."""
    bins = [f.name for f in df.schema.fields if isinstance(f.dataType, T.BinaryType)]
    return df.withColumns({c: F.col(c).cast("string") for c in bins}) if bins else df


def observe_counts(df: DataFrame, name: str, label: str = "rows"):
    """Attach a row counter that is filled by the job that consumes ``df``
    (no extra scan).  Returns (df, observation)."""
    from pyspark.sql import Observation
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias(label)), obs


def observed(observation) -> dict:
    """The metrics of a finished observation.  A result that adaptive
    execution finds empty is replaced as a whole, its counter too: then there
    are no metrics, and the counts are zero."""
    return observation.get if observation._jo.getRow().length() else {}


def cleanse(df: DataFrame, key: str) -> DataFrame | None:
    """One source table through the cleansing step."""
    if key in UNUSED_TABLES:
        return None
    if is_reference_key(key):
        return binary_to_string(df)
    pruned = prune_columns(df, key)
    if pruned is None:
        return None
    return binary_to_string(drop_null_rows(pruned))
