"""Registered queries of the operators made for large tables: a reset inside a
week, whole-row identity, joins that multiply, profiles by week."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import fanout as FO
from ..operators import identity as ID
from ..operators import profile as PF
from ..functions.codes import activity_label
from ..schemas import CUTOFF_COLUMN, RAW_SCHEMAS
from ..session import scratch_path
from ..sources import load as L
from ..sources import sinks as SK
from .catalog import Tables, register
from .catalog_tables import _columns, _content, _content_sql, _union
from .catalog_weekly import _batched
from .oracle import MARTS, with_ctes

#: A day inside a load batch.
INSIDE = "1998-06-10"


@register("reset_inside_week", with_ctes(" UNION ALL ".join(
    _content_sql(t, t, _columns(t), f"WHERE {c} < DATE '{INSIDE}'") for t, c in CUTOFF_COLUMN.items()), *CUTOFF_COLUMN))
def q_reset_inside_week(spark, sf_dir):
    """Six raw tables reset, twice, to a day in the middle of a load batch."""
    root, t, out = scratch_path(spark, "reset-inside"), Tables(spark, sf_dir), []
    for table, column in CUTOFF_COLUMN.items():
        path = SK.write_weekly(_batched(t.raw(table), column).filter(F.col("week").isNotNull()), root, table)
        schema = t.raw(table).schema
        for _ in range(2):
            SK.reset_to_date(spark, path, column, INSIDE, schema)
        weeks = SK.list_weeks(spark, path)
        kept = L.align_schema(L.read_weeks(spark, path, weeks), RAW_SCHEMAS[table]) if weeks else L.typed_empty(spark, table)
        out.append(_content(kept, table, _columns(table)))
    return _union(out)


@register("dedup_fingerprint", with_ctes("SELECT DISTINCT * FROM visit_area_info", "visit_area_info"))
def q_dedup_fingerprint(spark, sf_dir):
    """All visits, a fifth of them delivered twice, each row once."""
    visits = Tables(spark, sf_dir).raw("visit_area_info")
    return ID.distinct_rows(visits.unionByName(visits.filter("VISIT_AREA_ID % 5 = 0")))


@register("consume_by_area_blocks", MARTS["mart_consume_by_area"])
def q_consume_by_area_blocks(spark, sf_dir):
    """Activity spend with visit coordinates by the block-wise fan-out join."""
    t = Tables(spark, sf_dir)
    places = t.processed_visit.select("VISIT_AREA_ID", F.col("VISIT_AREA_NM").alias("STORE_NM"), "X_COORD", "Y_COORD")
    paid = t.raw("activity_consume").select("VISIT_AREA_ID", "STORE_NM", activity_label(F.col("ACTIVITY_TYPE_CD")).alias("ACTIVITY_TYPE"), "PAYMENT_AMT_WON")
    joined = FO.fan_out_join(paid, places, ["VISIT_AREA_ID", "STORE_NM"])
    return joined.select("STORE_NM", "ACTIVITY_TYPE", "PAYMENT_AMT_WON", "X_COORD", "Y_COORD")


def _profile_sql(table: str) -> str:
    parts = []
    for f in RAW_SCHEMAS[table].fields:
        kind, c = f.dataType.simpleString(), f.name
        text = (lambda v: f"CAST(CAST({v} AS DECIMAL(24,6)) AS VARCHAR)") if kind == "double" else (lambda v: f"CAST({v} AS VARCHAR)")
        numbers = {"string": f"COUNT(TRY_CAST({c} AS DOUBLE))", "date": "0"}.get(kind, f"COUNT({c})")
        parts.append(f"SELECT '{table}' AS TABLE_NAME, '{c}' AS COLUMN_NAME, COUNT(*) AS N_ROWS, COUNT(*) - COUNT({c}) AS N_NULL, "
                     f"CAST({numbers} AS BIGINT) AS N_NUMBERS, {text(f'MIN({c})')} AS LEAST, {text(f'MAX({c})')} AS MOST FROM {table}")
    return " UNION ALL ".join(parts)


@register("profile_all", with_ctes(" UNION ALL ".join(_profile_sql(t) for t in CUTOFF_COLUMN), *CUTOFF_COLUMN))
def q_profile_all(spark, sf_dir):
    """Every column of six tables, from states stored by load batch."""
    root, t, out = scratch_path(spark, "profiles"), Tables(spark, sf_dir), []
    for table, column in CUTOFF_COLUMN.items():
        rows = _batched(L.align_schema(t.raw(table), RAW_SCHEMAS[table]), column)
        PF.states(rows).write.parquet(f"{root}/{table}")
        found = spark.read.parquet(f"{root}/{table}")
        out.append(PF.merged(found, PF.profiled(rows)).select(F.lit(table).alias("TABLE_NAME"), "*"))
    return _union(out)
