"""Load calendar: weekly slices, the weekly cursor and backfills."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import slice_week_start, week_key


def week_calendar(dates: DataFrame, date_col: str, base_date: str) -> DataFrame:
    """All load weeks spanned by a date column: (WEEK_NO, WEEK_START,
    WEEK_END, WEEK_KEY).  One tiny aggregate for the bounds, then a sequence
    of week starts exploded on executors."""
    bounds = dates.agg(F.min(date_col).alias("lo"), F.max(date_col).alias("hi"))
    first = slice_week_start(F.col("lo"), base_date)
    last = slice_week_start(F.col("hi"), base_date)
    weeks = bounds.select(F.posexplode(F.sequence(first, last, F.expr("INTERVAL 7 DAYS")))
                          .alias("i", "WEEK_START"))
    return weeks.select((F.col("i") + 1).alias("WEEK_NO"), "WEEK_START",
                        F.date_add("WEEK_START", 6).alias("WEEK_END"),
                        week_key(F.col("WEEK_START")).alias("WEEK_KEY"))


def week_cursor(today: Column, base_date: str) -> dict[str, Column]:
    """Week to load when running on ``today``: the last complete slice
    before the slice containing today, plus the next run date."""
    base = F.to_date(F.lit(base_date))
    k = F.floor(F.datediff(today, base) / F.lit(7)).cast("int") - F.lit(1)
    start = F.date_add(base, k * F.lit(7))
    return {"START_DATE": start, "END_DATE": F.date_add(start, 6),
            "NEXT_DATE": F.date_add(today, 7)}
