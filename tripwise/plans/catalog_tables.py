"""Queries that apply one operator to every table it is meant for.

Each returns the tables' contents as a tagged union: TABLE_NAME and CONTENT,
the text of a row's columns (doubles to six decimals), so that a wrong table,
column, cast or row shows, not only a wrong count.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import fixtures as fx
from ..fixtures import FIXTURE_CUTOFF_DATE as CUTOFF, FIXTURE_WEEK_END as WEEK_END, FIXTURE_WEEK_START as WEEK_START
from ..operators import cleanse as C
from ..schemas import CUTOFF_COLUMN, KEEP_COLUMNS, RAW_SCHEMAS
from ..session import scratch_path
from ..sources import load as L
from ..sources import sinks as SK
from ..streaming import incremental as INC
from .catalog import Tables, register
from .catalog_ops import _weekly, duck_week
from .oracle import with_ctes
from .weekly import together

#: Fixture that stands for a table, where the names differ.
SOURCE = {"meta_traveller_master": "traveller_master"}
#: Fixture for each keep-list of the cleansing step.
PRUNED = {"tn_activity_consume": "activity_consume", "tn_activity_his": "meta_activity", "tn_lodge_consume": "lodge_consume",
          "tn_move_his": "move", "tn_mvmn_consume": "mvmn_consume", "tn_travel_travel": "travel",
          "tn_traveller_master": "traveller_master", "tn_visit_area": "visit_area_info"}
NONE = "(none)"


def _kinds(table: str) -> dict[str, str]:
    return {f.name: f.dataType.simpleString() for f in RAW_SCHEMAS[table].fields}


def _fixture_columns(name: str) -> list[str]:
    dropped = set(fx.FIXTURES[name].drop or ())
    return [c for c in (e.rsplit(" AS ", 1)[1].strip('`" ') for e in fx.fixture_exprs(name, "duckdb")) if c not in dropped]


def _doubles(source: str) -> set[str]:
    """The double columns of a fixture or typed table."""
    table = next((t for t, s in SOURCE.items() if s == source), source)
    return {c for c, kind in _kinds(table).items() if kind == "double"} if table in RAW_SCHEMAS else set()


def _content(df: DataFrame, table: str, columns: list[str], source: str | None = None) -> DataFrame:
    doubles = _doubles(source or table)
    text = lambda c: F.col(c).cast("decimal(24,6)").cast("string") if c in doubles else F.col(c).cast("string")
    return df.select(F.lit(table).alias("TABLE_NAME"), F.concat_ws("|", *[F.coalesce(text(c), F.lit(NONE)) for c in columns]).alias("CONTENT"))


def _content_sql(table: str, source: str, columns: list[str], where: str = "") -> str:
    have, doubles = set(_fixture_columns(source)), _doubles(source)
    value = lambda c: f"CAST({c} AS DECIMAL(24,6))" if c in doubles else c
    parts = ", ".join(f"COALESCE(CAST({value(c)} AS VARCHAR), '{NONE}')" if c in have else f"'{NONE}'" for c in columns)
    return f"SELECT '{table}' AS TABLE_NAME, concat_ws('|', {parts}) AS CONTENT FROM {source} {where}"


def _columns(table: str) -> list[str]:
    return list(_kinds(table))


def _union(frames) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _sql(tables, where=lambda t: "", source=lambda t: SOURCE.get(t, t), columns=_columns) -> str:
    return with_ctes(" UNION ALL ".join(_content_sql(t, source(t), columns(t), where(t)) for t in tables),
                     *dict.fromkeys(source(t) for t in tables))


DATED = list(CUTOFF_COLUMN)


@register("bulk_load_all", _sql(RAW_SCHEMAS))
def q_bulk_load_all(spark, sf_dir):
    """All typed tables loaded from text files with other letter case.  The
    tables do not depend on each other and are loaded side by side."""
    root, t = scratch_path(spark, "bulk-all"), Tables(spark, sf_dir)

    def load(table):
        raw = t.raw(SOURCE.get(table, table))
        text = raw.select(*[F.col(c).cast("string").alias(c.lower()) for c in raw.columns])
        text.write.parquet(f"{root}/raw/{table}")
        loaded = L.bulk_load(spark, f"{root}/raw", table, f"{root}/typed/{table}")
        return _content(loaded, table, _columns(table))

    return _union(together([lambda table=table: load(table) for table in RAW_SCHEMAS]))


@register("weekly_append_all", _sql(DATED, lambda t: f"WHERE {CUTOFF_COLUMN[t]} <= DATE '{WEEK_END}'"))
def q_weekly_append_all(spark, sf_dir):
    """One week appended to each dated table, twice with the same result."""
    root, t, out = scratch_path(spark, "append-all"), Tables(spark, sf_dir), []
    for table in DATED:
        rows = _weekly(t.raw(table), CUTOFF_COLUMN[table]).filter(F.col("week").isNotNull())
        SK.write_weekly(rows, f"{root}/raw", table)
        L.write_typed_weeks(L.align_schema(rows.filter(F.col("week") < WEEK_START), RAW_SCHEMAS[table], keep_extra=True)
                            .select(*[f.name for f in RAW_SCHEMAS[table].fields], "week"), f"{root}/typed/{table}")
        L.weekly_append(spark, f"{root}/raw", table, WEEK_START, f"{root}/typed/{table}")
        again = L.weekly_append(spark, f"{root}/raw", table, WEEK_START, f"{root}/typed/{table}")
        out.append(_content(again, table, _columns(table)))
    return _union(out)


@register("stream_all", _sql(DATED, lambda t: f"WHERE {duck_week(CUTOFF_COLUMN[t])} >= '{CUTOFF}'"))
def q_stream_all(spark, sf_dir):
    """Weeks from the cut-off on, streamed into each dated table."""
    root, t, out = scratch_path(spark, "stream-all"), Tables(spark, sf_dir), []
    for table in DATED:
        rows = _weekly(t.raw(table), CUTOFF_COLUMN[table]).filter(F.col("week").isNotNull())
        raw_dir = SK.write_weekly(rows, f"{root}/raw", table)
        INC.load_once(spark, raw_dir, table, f"{root}/typed/{table}", f"{root}/ckpt/{table}", since_week=CUTOFF)
        out.append(_content(INC.read_loaded(spark, f"{root}/typed/{table}", RAW_SCHEMAS[table]), table, _columns(table)))
    return _union(out)


@register("reset_all", _sql(DATED, lambda t: f"WHERE {duck_week(CUTOFF_COLUMN[t])} < '{CUTOFF}'"))
def q_reset_all(spark, sf_dir):
    """Each dated raw table reset to the weeks before the cut-off."""
    root, t, out = scratch_path(spark, "reset-all"), Tables(spark, sf_dir), []
    for table in DATED:
        rows = _weekly(t.raw(table), CUTOFF_COLUMN[table]).filter(F.col("week").isNotNull())
        path = SK.write_weekly(rows, root, table)
        SK.drop_from_week(spark, path, CUTOFF)
        weeks = SK.list_weeks(spark, path)
        kept = (L.align_schema(L.read_weeks(spark, path, weeks), RAW_SCHEMAS[table]) if weeks
                else L.typed_empty(spark, table))
        out.append(_content(kept, table, _columns(table)))
    return _union(out)


def _kept_columns(key: str) -> list[str]:
    have = set(_fixture_columns(PRUNED[key]))
    return [c for c in KEEP_COLUMNS[key] if c in have]


@register("prune_columns_all", _sql(KEEP_COLUMNS, source=PRUNED.get, columns=_kept_columns))
def q_prune_columns_all(spark, sf_dir):
    """Every keep-list, applied to its table with unwanted columns added."""
    t, out = Tables(spark, sf_dir), []
    for key in KEEP_COLUMNS:
        wide = t.raw(PRUNED[key]).withColumns({"UNWANTED": F.lit("x"), "PHOTO_FILE_ID": F.lit(1)})
        pruned = C.prune_columns(wide, key)
        assert "UNWANTED" not in pruned.columns and "PHOTO_FILE_ID" not in pruned.columns
        out.append(_content(pruned, key, _kept_columns(key), PRUNED[key]))
    return _union(out)
