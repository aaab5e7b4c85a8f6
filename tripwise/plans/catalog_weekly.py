"""Registered queries of the weekly machinery: loads with a reject ledger,
weekly partial states, mergeable distinct counts, published marts and the
whole weekly run."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..fixtures import FIXTURE_CUTOFF_DATE as CUTOFF, FIXTURE_WEEK_END as WEEK_END, FIXTURE_WEEK_START as WEEK_START
from ..functions.dates import lenient_date, month_start
from ..operators import distinct as DC
from ..schemas import CUTOFF_COLUMN, KEEP_COLUMNS, RAW_SCHEMAS
from ..session import scratch_path
from ..sources import load as L
from ..sources import rejects as RJ
from ..sources import sinks as SK
from . import partials as PT
from . import publish as PB
from . import weekly as W
from . import weekly_run as WR
from .catalog import Tables, register
from .catalog_ops import _REFRESH_SQL, BASE
from .catalog_tables import _union
from .oracle import MARTS, over, with_ctes

NONE = "(none)"
#: Days of a load batch: the fixture spans seven years, which these queries
#: land in quarters; only the weekly run loads a single week.
BATCH = 91


def batch_of(column: str) -> Column:
    base = F.to_date(F.lit(BASE))
    return F.date_format(F.date_add(base, (F.floor(F.datediff(F.col(column), base) / BATCH) * BATCH).cast("int")), "yyyy-MM-dd")


def duck_batch(column: str) -> str:
    return (f"strftime(DATE '{BASE}' + CAST(floor(date_diff('day', DATE '{BASE}', {column}) / {BATCH}) * {BATCH} AS INTEGER), '%Y-%m-%d')")


def _batched(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn("week", batch_of(column))


#: Columns of each mart; a star marks doubles, compared to six decimals.
MART_COLUMNS = {
    "cumulative_travel_stats": "MONTH UNIQUE_TRAVELERS UNIQUE_TRAVELS",
    "traveler_gender_age_distribution": "GENDER AGE_GROUP TRAVELER_COUNT",
    "traveler_job_distribution": "JOB_NAME TRAVEL_FREQUENCY",
    "region_visit_dataset": "SIDO REGION VISIT_COUNT",
    "region_visit_map": "SIDO REGION VISIT_COUNT ISO_3166_2_CODE",
    "mvmn_price": "MVMN_SE_NM PAYMENT_AMT_WON* TRAVEL_START_YMD",
    "region_activity_distribution": "REGION SIDO SGG ACTIVITY_TYPE ACTIVITY_COUNT",
    "region_activity_consumption": "REGION SIDO SGG ACTIVITY_TYPE TOTAL_CONSUMPTION* TOTAL_PAYMENT_COUNT",
    "activity_consume_by_area": "STORE_NM ACTIVITY_TYPE PAYMENT_AMT_WON* X_COORD* Y_COORD*",
    "lodging_type_distribution_with_cost": "SIDO SGG REGION LODGING_TYPE LODGING_COUNT TOTAL_COST",
    "weekly_spending": "WEEK_START_DATE CATEGORY TOTAL_SPENDING* SPENDING_SHARE*",
    "region_visit_count": "TRAVEL_START_YMD TRAVEL_END_YMD SIDO_SGG SIDO SGG",
    "region_visitarea_analysis": "SIDO SGG REGION AVG_SATISFACTION* AVG_REVISIT_INTENTION* VISIT_COUNT",
    "region_spatial_analysis": "LONGITUDE* LATITUDE* SIDO SGG REGION WEIGHT* SATISFACTION*",
}


def _doubles(table: str) -> str:
    """A typed table's columns in the notation of MART_COLUMNS."""
    return " ".join(f.name + "*" * (f.dataType.simpleString() == "double") for f in RAW_SCHEMAS[table].fields)


def text_of(columns: str) -> Column:
    """The text of a row's columns."""
    text = lambda c: F.col(c[:-1]).cast("decimal(24,6)").cast("string") if c.endswith("*") else F.col(c).cast("string")
    return F.concat_ws("|", *[F.coalesce(text(c), F.lit(NONE)) for c in columns.split()])


def text_sql(columns: str) -> str:
    text = lambda c: f"CAST({c[:-1]} AS DECIMAL(24,6))" if c.endswith("*") else c
    return "concat_ws('|', " + ", ".join(f"COALESCE(CAST({text(c)} AS VARCHAR), '{NONE}')" for c in columns.split()) + ")"


def content(df: DataFrame, name: str, columns: str) -> DataFrame:
    return df.select(F.lit(name).alias("NAME"), text_of(columns).alias("CONTENT"))


def content_sql(sql: str, name: str, columns: str) -> str:
    return f"SELECT '{name}' AS NAME, {text_sql(columns)} AS CONTENT FROM ({sql})"


def marts_content(marts: dict[str, DataFrame]) -> DataFrame:
    return _union([content(df, name, MART_COLUMNS[name]) for name, df in marts.items()])


def marts_sql(names, where: dict[str, str]) -> str:
    return " UNION ALL ".join(content_sql(over(MARTS[_REFRESH_SQL[n]], where), n, MART_COLUMNS[n]) for n in names)


# --------------------------------------------------------------------------
# Loads with a ledger of rejected values
# --------------------------------------------------------------------------
_BAD = "VISIT_AREA_ID % 37 = 0", "VISIT_AREA_ID % 41 = 0 AND VISIT_END_YMD IS NOT NULL"


@register("load_rejects", with_ctes(f"""
    SELECT 'good' AS STATUS, {duck_batch('VISIT_END_YMD')} AS WEEK, '{NONE}' AS COLUMN_NAME, {text_sql(_doubles('visit_area_info'))} AS CONTENT
    FROM visit_area_info WHERE (({_BAD[0]}) OR ({_BAD[1]})) IS NOT TRUE
    UNION ALL SELECT 'rejected', {duck_batch('VISIT_END_YMD')}, 'X_COORD', 'n/a' FROM visit_area_info WHERE {_BAD[0]}
    UNION ALL SELECT 'rejected', {duck_batch('VISIT_END_YMD')}, 'VISIT_END_YMD', 'soon' FROM visit_area_info WHERE {_BAD[1]}""", "visit_area_info"))
def q_load_rejects(spark, sf_dir):
    """All visits loaded from weekly text files: the good rows, and every
    rejected value with its column and the week folder of its file."""
    root, visits = scratch_path(spark, "rejects"), _batched(Tables(spark, sf_dir).raw("visit_area_info"), "VISIT_END_YMD")
    text = visits.select(*[F.col(c).cast("string").alias(c if c == "week" else c.lower()) for c in visits.columns])
    text = text.withColumns({"x_coord": F.when(F.expr(_BAD[0]), "n/a").otherwise(F.col("x_coord")),
                             "visit_end_ymd": F.when(F.expr(_BAD[1]), "soon").otherwise(F.col("visit_end_ymd"))})
    SK.write_weekly(text, f"{root}/raw", "visit_area_info")
    done = RJ.load_with_rejects(spark.read.parquet(f"{root}/raw/visit_area_info"), RAW_SCHEMAS["visit_area_info"], f"{root}/typed")
    assert done.read == done.loaded + done.rejected, done
    folder = F.nullif(F.regexp_extract("SOURCE_FILE", "/week=([^/]+)/", 1), F.lit("__HIVE_DEFAULT_PARTITION__"))
    good = done.good.select(F.lit("good").alias("STATUS"), F.col("week").alias("WEEK"), F.lit(NONE).alias("COLUMN_NAME"),
                            text_of(_doubles("visit_area_info")).alias("CONTENT"))
    return good.unionByName(done.rejects.select(F.lit("rejected").alias("STATUS"), folder.alias("WEEK"), "COLUMN_NAME", F.col("VALUE").alias("CONTENT")))


# --------------------------------------------------------------------------
# Weekly partial states
# --------------------------------------------------------------------------
_PARTIAL_MARTS = ["lodging_type_distribution_with_cost", "region_visitarea_analysis", "region_activity_distribution", "region_activity_consumption"]
_KEPT = {t: f"({duck_batch(CUTOFF_COLUMN[t])}) < '{CUTOFF}'" for t in ("lodge_consume", "visit_area_info", "activity_consume")}


@register("mart_partials_refresh", marts_sql(_PARTIAL_MARTS, _KEPT))
def q_mart_partials_refresh(spark, sf_dir):
    """Four marts from weekly states, after one week was delivered twice
    (wrong, then right) and the weeks from the cut-off on were dropped."""
    root, t = scratch_path(spark, "partials"), Tables(spark, sf_dir)
    tables = {"lodge_consume": t.processed_lodge, "visit_area_info": t.processed_visit, "activity_consume": t.raw("activity_consume")}
    wrong = {"lodge_consume": "PAYMENT_AMT_WON", "visit_area_info": "DGSTFN", "activity_consume": "PAYMENT_AMT_WON"}

    def deliver(table):
        df = tables[table]
        # Read three times below, so addresses are normalised once.
        rows = W.materialize(_batched(df, CUTOFF_COLUMN[table]).filter(F.col("week").isNotNull()), f"{root}/rows/{table}")
        again = rows.agg(F.max(F.when(F.col("week") < CUTOFF, F.col("week")))).first()[0]
        first = rows.withColumn(wrong[table], F.when(F.col("week") == again, F.lit(0)).otherwise(F.col(wrong[table])).cast(df.schema[wrong[table]].dataType))
        path = SK.write_weekly(first, f"{root}/zone", table)
        PT.refresh_states(spark, table, path, SK.list_weeks(spark, path), f"{root}/states", df.schema)
        SK.write_weekly(rows.filter(F.col("week") == again), f"{root}/zone", table)
        dropped = SK.drop_from_week(spark, path, CUTOFF)
        PT.refresh_states(spark, table, path, [again, *dropped], f"{root}/states", df.schema)

    W.together([lambda table=table: deliver(table) for table in tables])
    return marts_content(PT.marts(spark, f"{root}/states", tables, t.codes, f"{root}/tmp"))


# --------------------------------------------------------------------------
# Mergeable distinct counts
# --------------------------------------------------------------------------
@register("distinct_counts_merged", MARTS["mart_travel_stats"])
def q_distinct_counts_merged(spark, sf_dir):
    """Travellers and travels per month from weekly bitmaps over dictionaries
    that grew twice."""
    root = scratch_path(spark, "distinct")
    travel = _batched(Tables(spark, sf_dir).raw("travel"), "TRAVEL_END_YMD").filter(F.col("TRAVEL_START_YMD").isNotNull())
    travel = travel.withColumn("MONTH", month_start(lenient_date(F.col("TRAVEL_START_YMD"))))
    measures = {"UNIQUE_TRAVELERS": "TRAVELER_ID", "UNIQUE_TRAVELS": "TRAVEL_ID"}
    early = F.coalesce(F.col("week") < CUTOFF, F.lit(False))
    for rows in (travel.filter(early), travel.filter(~early)):
        for name, column in measures.items():
            numbers = DC.grow(spark, rows.select(F.col(column).alias(DC.ID)), f"{root}/{column}")
            DC.replace_weeks(DC.numbered(rows, column, numbers, "NUMBER"), ["MONTH"], "NUMBER", f"{root}/{name}")
    found = [DC.counts(spark.read.parquet(f"{root}/{name}"), ["MONTH"], name) for name in measures]
    months = travel.select("MONTH").distinct()
    for f in found:
        key = f.withColumnRenamed("MONTH", "M")
        months = months.join(key, F.col("MONTH").eqNullSafe(F.col("M")), "left").drop("M")
    return months.select("MONTH", *[F.coalesce(n, F.lit(0)).cast("long").alias(n) for n in measures])


# --------------------------------------------------------------------------
# Published marts and the weekly run
# --------------------------------------------------------------------------
def _inputs(t: Tables) -> dict[str, DataFrame]:
    names = ("travel", "traveller_master", "mvmn_consume", "activity_consume", "lodge_consume")
    return {n: t.raw(n) for n in names} | {"processed_visit": t.processed_visit, "processed_lodge": t.processed_lodge, "codes": t.codes}


@register("published_marts", marts_sql(_REFRESH_SQL, {}))
def q_published_marts(spark, sf_dir):
    """The content of all fourteen marts, published twice and read through
    their table names."""
    root, t = scratch_path(spark, "published"), Tables(spark, sf_dir)
    database = f"tripwise_marts_{uuid.uuid4().hex[:8]}"
    frames = W.mart_frames(spark, _inputs(t), f"{root}/tmp")
    L.ensure_database(spark, database, f"{root}/database")
    try:
        PB.publish(spark, {name: df.limit(0) for name, df in frames.items()}, f"{root}/marts", database)
        PB.publish(spark, frames, f"{root}/marts", database)
        return marts_content({name: spark.table(f"{database}.{name}") for name in frames})
    finally:
        spark.sql(f"DROP DATABASE {database} CASCADE")  # the tables' files stay


def _whole(table: str, where: str) -> str:
    kept = " AND ".join(f"{c} IS NOT NULL" for c in KEEP_COLUMNS[WR.KEYS[table]])
    return f"{kept} AND {where}"


_RUN = {t: _whole(t, f"{c} <= DATE '{WEEK_END}'") for t, c in CUTOFF_COLUMN.items()}


def _kept_columns(table: str) -> str:
    return " ".join(c for c in _doubles(table).split() if c.rstrip("*") in KEEP_COLUMNS[WR.KEYS[table]])


@register("weekly_run", " UNION ALL ".join(
    [content_sql(over(with_ctes(f"SELECT * FROM {t}", t), _RUN), t, _kept_columns(t)) for t in CUTOFF_COLUMN] + [marts_sql(_REFRESH_SQL, _RUN)]))
def q_weekly_run(spark, sf_dir):
    """Six typed tables and fourteen marts after the seed and one weekly run
    that broke off at a step and was started again."""
    root, t = scratch_path(spark, "weekly-run"), Tables(spark, sf_dir)
    sources = {table: t.raw(table) for table in CUTOFF_COLUMN}
    reference = {n: t.raw(n) for n in ("traveller_master", "meta_codeb")}
    WR.seed_zone(sources, root, batch_of, WEEK_START)

    def broken(name):
        if name == "load-mvmn_consume":
            raise InterruptedError(name)

    try:
        WR.run_week(spark, sources, reference, root, WEEK_START, WEEK_END, before_step=broken)
    except InterruptedError:
        done = WR.run_week(spark, sources, reference, root, WEEK_START, WEEK_END)
        assert done[0] == "load-mvmn_consume" and "slice-travel" in done and "load-activity_consume" not in done, done
    typed = [content(df, table, _kept_columns(table)) for table, df in WR.typed_zone(spark, root).items()]
    return _union([*typed, marts_content(PB.open_marts(spark, f"{root}/analysis"))])
