"""Weekly slicing of source tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import as_date, as_timestamp, slice_week_start

UNSLICED_PREFIX = "tn_traveller_master"


def slice_column(df: DataFrame, first: bool = True) -> str | None:
    """Date column that places a row in a week: the first (or last) column
    whose name ends with 'YMD' and does not contain 'START'."""
    cands = [f.name for f in df.schema.fields if f.name.endswith("YMD") and "START" not in f.name]
    if not cands:
        return None
    return cands[0] if first else cands[-1]


def typed_dates(df: DataFrame) -> DataFrame:
    """Text columns named ``*YMD`` (but not START ones) as dates and ``*MIN``
    as millisecond timestamps; what cannot be read becomes NULL."""
    out = {}
    for f in df.schema.fields:
        if f.name.endswith("YMD") and "START" not in f.name:
            out[f.name] = as_date(df, f.name)
        elif f.name.endswith("MIN"):
            out[f.name] = F.date_trunc("millisecond", as_timestamp(df, f.name)).cast("timestamp_ntz")
    return df.withColumns(out) if out else df


def week_slice(df: DataFrame, table: str, start: str, end: str, first: bool = True) -> DataFrame:
    """Rows whose slice date lies in [start, end] (inclusive), with typed
    date and time columns; unparsable dates fall out.  Traveller master and
    tables without a date column are returned whole."""
    df = typed_dates(df)
    if table.startswith(UNSLICED_PREFIX):
        return df
    col = slice_column(df, first)
    if col is None:
        return df
    d = as_date(df, col)
    return df.filter(d.between(F.to_date(F.lit(start)), F.to_date(F.lit(end))))


def gps_week_slice(df: DataFrame, start: str, end: str, col: str = "DT_YMD") -> DataFrame:
    return df.filter(as_date(df, col).between(F.to_date(F.lit(start)), F.to_date(F.lit(end))))


def with_week(df: DataFrame, base_date: str, first: bool = True, col: str | None = None) -> DataFrame:
    """Tag every row with its load week (ISO date of the week start) so a
    whole backfill is written by one job partitioned on ``week`` instead of
    one job per week."""
    col = col or slice_column(df, first)
    if col is None:
        return df.withColumn("week", F.lit(None).cast("string"))
    wk = slice_week_start(as_date(df, col), base_date)
    return df.withColumn("week", F.date_format(wk, "yyyy-MM-dd"))
