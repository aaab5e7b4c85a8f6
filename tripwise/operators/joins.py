"""Join helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Upper bounds on what we are willing to ship to every executor.  Code and
# reference tables hold tens to thousands of rows; the byte bound matches the
# session's adaptive broadcast threshold.
MAX_BROADCAST_ROWS = 200_000
MAX_BROADCAST_BYTES = 32 << 20


# Proven bounds per application, plan and set of input files.  A rewritten
# table has new files, so its size is proven again.
_PROVEN: dict[tuple, bool] = {}


def _value_bytes(field: T.StructField) -> Column:
    """Size of one value: its encoded length for text and bytes, eight
    bytes for fixed-width values, the JSON text length for nested values."""
    c = F.col(f"`{field.name}`")
    t = field.dataType
    if isinstance(t, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(c), F.lit(0))
    if isinstance(t, (T.ArrayType, T.MapType, T.StructType)):
        return F.coalesce(F.octet_length(F.to_json(c)), F.lit(0))
    return F.lit(8)


def size_probe(df: DataFrame, max_rows: int) -> tuple[int, int]:
    """(rows, bytes) of at most ``max_rows + 1`` rows of ``df`` in one job;
    a frame beyond the row bound is never read further."""
    row_bytes = sum((_value_bytes(f) for f in df.schema.fields), F.lit(0))
    r = (df.limit(max_rows + 1)
         .agg(F.count(F.lit(1)).alias("n"), F.sum(row_bytes.cast("bigint")).alias("b"))
         .first())
    return int(r["n"]), int(r["b"] or 0)


def bounded_broadcast(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS,
                      max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Broadcast-hint ``df`` only after proving it holds at most ``max_rows``
    rows and ``max_bytes`` of values.  The probe reads at most
    ``max_rows + 1`` rows and its outcome is remembered for the same plan
    over the same files.  Beyond either bound the frame is returned
    unhinted, so the planner keeps a shuffle join (and AQE may still convert
    it at run time from measured sizes)."""
    plan = df._jdf.queryExecution().analyzed().canonicalized().toString()
    key = (df.sparkSession.sparkContext.applicationId, plan, tuple(sorted(df.inputFiles())), max_rows, max_bytes)
    small = _PROVEN.get(key)
    if small is None:
        rows, size = size_probe(df, max_rows)
        small = rows <= max_rows and size <= max_bytes
        if key[2]:  # rows that come from no file have no version to go by
            _PROVEN[key] = small
    return F.broadcast(df) if small else df
