"""Column profiles as mergeable states: one scan per table and week."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.sinks import WEEK


def profiled(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c != WEEK]


def states(df: DataFrame) -> DataFrame:
    """One row per week of ``df``: its rows, and for every column the nulls,
    the least and greatest value, and of text columns how many read as
    numbers.  One scan and one exchange of a row per week and task."""
    aggs = [F.count(F.lit(1)).alias("rows")]
    for f in df.schema.fields:
        if f.name == WEEK:
            continue
        c = F.col(f"`{f.name}`")
        numeric = F.count(c.try_cast("double")) if isinstance(f.dataType, T.StringType) else F.count(c)
        number = numeric if isinstance(f.dataType, (T.StringType, T.NumericType)) else F.lit(0).cast("long")
        aggs += [F.count_if(c.isNull()).alias(f"{f.name}.nulls"), F.min(c).alias(f"{f.name}.least"),
                 F.max(c).alias(f"{f.name}.most"), number.alias(f"{f.name}.numbers")]
    return df.groupBy(WEEK).agg(*aggs)


def merged(found: DataFrame, columns: list[str]) -> DataFrame:
    """COLUMN_NAME, N_ROWS, N_NULL, N_NUMBERS, LEAST, MOST over all weeks of
    the states; values are given as text, doubles to six decimals."""
    totals = [F.sum("rows").alias("rows")]
    for c in columns:
        totals += [F.sum(f"`{c}.nulls`").alias(f"{c}.nulls"), F.min(f"`{c}.least`").alias(f"{c}.least"),
                   F.max(f"`{c}.most`").alias(f"{c}.most"), F.sum(f"`{c}.numbers`").alias(f"{c}.numbers")]
    one = found.agg(*totals)
    kinds = {f.name: f.dataType for f in one.schema.fields}

    def text(name):
        c = F.col(f"`{name}`")
        return (c.cast("decimal(24,6)") if isinstance(kinds[name], (T.DoubleType, T.FloatType)) else c).cast("string")

    rows = [F.struct(F.lit(c).alias("COLUMN_NAME"), F.coalesce("rows", F.lit(0)).alias("N_ROWS"),
                     F.coalesce(F.col(f"`{c}.nulls`"), F.lit(0)).alias("N_NULL"), F.coalesce(F.col(f"`{c}.numbers`"), F.lit(0)).alias("N_NUMBERS"),
                     text(f"{c}.least").alias("LEAST"), text(f"{c}.most").alias("MOST")) for c in columns]
    return one.select(F.inline(F.array(*rows)))
