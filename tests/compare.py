"""Order-insensitive comparison of a Spark result with a DuckDB oracle,
mirroring the driver's check (row count, column names and types, value
multiset)."""

from __future__ import annotations

import datetime as _dt
import math

import os

import duckdb

EXACT = os.environ.get("TRIPWISE_EXACT_FLOATS", "1") == "1"

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations"]


def duck_connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return repr(v) if EXACT else repr(round(v, 9))
    if isinstance(v, _dt.datetime):
        return v.isoformat()
    if isinstance(v, _dt.date):
        return v.isoformat()
    if isinstance(v, (bytes, bytearray)):
        return v.hex()
    return str(v)


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [tuple(cols[i] for i in order)], sorted(
        tuple(_norm(r[i]) for i in order) for r in rows)


# Spark type -> DuckDB type name of the same values.
DUCK_TYPE = {"StringType": "VARCHAR", "LongType": "BIGINT", "IntegerType": "INTEGER",
             "ShortType": "SMALLINT", "DoubleType": "DOUBLE", "FloatType": "FLOAT",
             "DateType": "DATE", "TimestampNTZType": "TIMESTAMP", "BooleanType": "BOOLEAN",
             "BinaryType": "BLOB"}


def compare(spark_df, sql: str, con) -> tuple[bool, str]:
    s_cols = spark_df.columns
    s_types = {f.name: DUCK_TYPE.get(type(f.dataType).__name__, type(f.dataType).__name__)
               for f in spark_df.schema.fields}
    s_rows = [tuple(r) for r in spark_df.collect()]
    rel = con.sql(sql)
    d_cols = rel.columns
    d_types = {c: str(t) for c, t in zip(d_cols, rel.types)}
    d_rows = rel.fetchall()
    sc, sr = rows_of(s_cols, s_rows)
    dc, dr = rows_of(d_cols, d_rows)
    if sc != dc:
        return False, f"columns differ: spark={sorted(s_cols)} duck={sorted(d_cols)}"
    if s_types != d_types:
        diff = {c: (s_types[c], d_types[c]) for c in s_types if s_types[c] != d_types[c]}
        return False, f"column types differ (spark, duck): {diff}"
    if len(sr) != len(dr):
        return False, f"row count differs: spark={len(sr)} duck={len(dr)}"
    if sr != dr:
        diff = [(a, b) for a, b in zip(sr, dr) if a != b][:3]
        return False, f"values differ (first): {diff}"
    return True, f"{len(sr)} rows"
