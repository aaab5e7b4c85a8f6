"""Date and calendar expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def lenient_date(c: Column) -> Column:
    """Text/timestamp/date -> DATE, unparsable -> NULL."""
    return F.try_to_date(c.cast("string"))


def as_date(df: DataFrame, col: str) -> Column:
    """Column ``col`` of ``df`` as a DATE: used as it is when already a date,
    otherwise parsed leniently (no per-row format-and-parse round trip for
    typed columns)."""
    if isinstance(df.schema[col].dataType, T.DateType):
        return F.col(col)
    return lenient_date(F.col(col))


def lenient_timestamp(c: Column) -> Column:
    """Text -> TIMESTAMP_NTZ, unparsable -> NULL."""
    return F.try_to_timestamp(c.cast("string")).cast("timestamp_ntz")


def as_timestamp(df: DataFrame, col: str) -> Column:
    """Column ``col`` of ``df`` as a TIMESTAMP_NTZ: cast directly when it
    already holds timestamps, otherwise parsed leniently from text."""
    if isinstance(df.schema[col].dataType, (T.TimestampType, T.TimestampNTZType)):
        return F.col(f"`{col}`").cast("timestamp_ntz")
    return lenient_timestamp(F.col(f"`{col}`"))


def month_start(d: Column) -> Column:
    return F.trunc(d, "MM")


def iso_week_start(d: Column) -> Column:
    """Monday of the week (analysis weeks)."""
    return F.trunc(d, "WEEK")


def slice_week_start(d: Column, base_date: str) -> Column:
    """Start of the 7-day load slice containing ``d``; slices are anchored on
    ``base_date`` (a Sunday in the source calendar), so weeks run
    Sunday..Saturday."""
    base = F.to_date(F.lit(base_date))
    k = F.floor(F.datediff(d, base) / F.lit(7)).cast("int")
    return F.date_add(base, k * F.lit(7))


def week_key(d: Column) -> Column:
    """yyMMdd partition key of a week start."""
    return F.date_format(d, "yyMMdd")


def time_of_day(ts: Column) -> Column:
    return F.date_format(ts, "HH:mm:ss")
