"""Registered queries for the sources/sinks, cleansing, slicing,
consolidation, profiling, streaming and calendar operators.

Sink and stream queries write under a fresh folder below the session's
checkpoint root (shared storage on a cluster) and return what they read
back, so the round trip itself is what gets checked.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..fixtures import (FIXTURE_BASE_DATE as BASE, FIXTURE_CUTOFF_DATE as CUTOFF,
                        FIXTURE_WEEK_END as WEEK_END, FIXTURE_WEEK_START as WEEK_START)
from ..functions import address as A
from ..functions.dates import lenient_date, slice_week_start, week_key
from ..operators import cleanse as C
from ..operators import consolidate as K
from ..operators import quality as Q
from ..operators import slicing as S
from ..schemas import CANONICAL_DATASETS, CUTOFF_COLUMN, PROCESSED_SCHEMAS, RAW_SCHEMAS, REGIONS
from ..session import scratch_path
from ..sources import load as L
from ..sources import scan as SC
from ..sources import sinks as SK
from ..streaming import incremental as INC
from . import calendar as CAL
from . import marts as M
from . import pipeline as PL
from . import processed as P
from . import weekly as W
from .catalog import Tables, register
from .oracle import MARTS, with_ctes

def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def duck_week(col: str, base: str = BASE) -> str:
    return (f"strftime(DATE '{base}' + CAST(floor(date_diff('day', DATE '{base}', {col}) / 7) * 7 "
            f"AS INTEGER), '%Y-%m-%d')")


def _weekly(df, col):
    return df.withColumn("week", F.date_format(slice_week_start(F.col(col), BASE), "yyyy-MM-dd"))


def _schema_with(table: str, *extra: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType(RAW_SCHEMAS[table].fields + [T.StructField(n, t, True) for n, t in extra])


# --------------------------------------------------------------------------
# Scans
# --------------------------------------------------------------------------
@register("scan_parquet", with_ctes(
    "SELECT *, TRAVEL_NM = '1-URGENT' AS IS_URGENT FROM travel", "travel"))
def q_scan_parquet(spark, sf_dir):
    path = scratch_path(spark, "scan") + "/travel"
    Tables(spark, sf_dir).raw("travel").write.parquet(path)
    df = SC.read_table(spark, path, RAW_SCHEMAS["travel"])
    return df.withColumn("IS_URGENT", F.col("TRAVEL_NM") == "1-URGENT")


@register("scan_prefix", with_ctes("SELECT * FROM mvmn_consume", "mvmn_consume"))
def q_scan_prefix(spark, sf_dir):
    root = scratch_path(spark, "prefix")
    mv = Tables(spark, sf_dir).raw("mvmn_consume")
    SK.write_weekly(_weekly(mv, "PAYMENT_DT_YMD"), root, "mvmn_consume")
    df = SC.scan_prefix(spark, f"{root}/mvmn_consume", RAW_SCHEMAS["mvmn_consume"])
    missing = SC.scan_prefix(spark, f"{root}/no_such_prefix", RAW_SCHEMAS["mvmn_consume"])
    assert missing is None
    return df.drop(SC.FILE_PATH, SC.FILE_NAME)


@register("scan_dir_skip_empty", with_ctes("""
    SELECT 'travel' AS TABLE_NAME, COUNT(*) AS ROW_COUNT FROM travel
    UNION ALL SELECT 'move', COUNT(*) FROM move""", "travel", "move"))
def q_scan_dir_skip_empty(spark, sf_dir):
    root = scratch_path(spark, "dir")
    t = Tables(spark, sf_dir)
    t.raw("travel").write.parquet(f"{root}/travel")
    t.raw("move").write.parquet(f"{root}/move")
    L.typed_empty(spark, "lodge_consume").write.parquet(f"{root}/lodge_consume")
    found = SC.scan_tables(spark, root, ["travel", "move", "lodge_consume", "not_there"])
    tagged = None
    for name, df in found.items():
        part = df.select(F.lit(name).alias("TABLE_NAME"))
        tagged = part if tagged is None else tagged.unionByName(part)
    return tagged.groupBy("TABLE_NAME").agg(F.count(F.lit(1)).alias("ROW_COUNT"))


@register("scan_csv", with_ctes("SELECT * FROM travel", "travel"))
def q_scan_csv(spark, sf_dir):
    root = scratch_path(spark, "csv")
    t = Tables(spark, sf_dir)
    t.raw("travel").write.option("header", "true").csv(f"{root}/tn_travel_여행")
    t.raw("poi").write.option("header", "true").csv(f"{root}/tn_poi_master")
    df = SC.scan_csv(spark, root, RAW_SCHEMAS["travel"])
    return df.filter(~SC.is_gps_file(F.col(SC.FILE_NAME))).drop(SC.FILE_PATH, SC.FILE_NAME)


@register("merge_gps_parts", with_ctes("SELECT * FROM gps", "gps"))
def q_merge_gps_parts(spark, sf_dir):
    root = scratch_path(spark, "gps")
    gps = Tables(spark, sf_dir).raw("gps")
    gps.write.partitionBy("REGION").parquet(f"{root}/parts")
    merged = spark.read.parquet(f"{root}/parts")
    merged.write.parquet(f"{root}/merged")
    return spark.read.parquet(f"{root}/merged")


# --------------------------------------------------------------------------
# Sinks
# --------------------------------------------------------------------------
@register("sink_weekly_raw", with_ctes(
    f"SELECT *, {duck_week('VISIT_END_YMD')} AS week FROM visit_area_info", "visit_area_info"))
def q_sink_weekly_raw(spark, sf_dir):
    root = scratch_path(spark, "weekly")
    visit = Tables(spark, sf_dir).raw("visit_area_info")
    path = SK.write_weekly(S.with_week(visit, BASE), root, "visit_area_info")
    return spark.read.schema(_schema_with("visit_area_info", ("week", T.StringType()))).parquet(path)


@register("sink_yearly", with_ctes(
    "SELECT *, CAST(year(VISIT_END_YMD) AS VARCHAR) AS year FROM visit_area_info", "visit_area_info"))
def q_sink_yearly(spark, sf_dir):
    root = scratch_path(spark, "yearly")
    path = SK.write_yearly(Tables(spark, sf_dir).raw("visit_area_info"), root, "visit_area_info",
                           "VISIT_END_YMD")
    return spark.read.schema(_schema_with("visit_area_info", ("year", T.StringType()))).parquet(path)


@register("sink_processed", with_ctes(f"SELECT *, '{WEEK_START}' AS week FROM processed_lodge",
                                      "processed_lodge"))
def q_sink_processed(spark, sf_dir):
    root = scratch_path(spark, "processed")
    path = SK.write_processed(Tables(spark, sf_dir).processed_lodge, root, "lodge_consume", WEEK_START)
    return spark.read.parquet(path)


@register("sink_ignore_existing", with_ctes("SELECT * FROM codeb_distinct", "codeb_distinct"))
def q_sink_ignore_existing(spark, sf_dir):
    root = scratch_path(spark, "ignore")
    t = Tables(spark, sf_dir)
    path = SK.write_reference(t.codes, root, "tc_codeb", if_exists="ignore")
    SK.write_reference(t.raw("meta_codeb"), root, "tc_codeb", if_exists="ignore")  # no effect
    return spark.read.parquet(path)


@register("sink_dynamic_overwrite", with_ctes(f"""
    SELECT *, {duck_week('PAYMENT_DT_YMD')} AS week FROM lodge_consume
    WHERE {duck_week('PAYMENT_DT_YMD')} <> '{WEEK_START}' OR PAYMENT_AMT_WON IS NOT NULL""",
    "lodge_consume"))
def q_sink_dynamic_overwrite(spark, sf_dir):
    root = scratch_path(spark, "dynamic")
    lodge = _weekly(Tables(spark, sf_dir).raw("lodge_consume"), "PAYMENT_DT_YMD")
    path = SK.write_weekly(lodge, root, "lodge_consume")
    week = lodge.filter((F.col("week") == WEEK_START) & F.col("PAYMENT_AMT_WON").isNotNull())
    SK.write_weekly(week, root, "lodge_consume")   # replaces that week only
    return spark.read.schema(_schema_with("lodge_consume", ("week", T.StringType()))).parquet(path)


@register("drop_from_week", with_ctes(f"""
    SELECT *, {duck_week('PAYMENT_DT_YMD')} AS week FROM lodge_consume
    WHERE {duck_week('PAYMENT_DT_YMD')} < '{CUTOFF}'""", "lodge_consume"))
def q_drop_from_week(spark, sf_dir):
    root = scratch_path(spark, "drop")
    lodge = _weekly(Tables(spark, sf_dir).raw("lodge_consume"), "PAYMENT_DT_YMD")
    path = SK.write_weekly(lodge, root, "lodge_consume")
    SK.drop_from_week(spark, path, CUTOFF)
    return spark.read.schema(_schema_with("lodge_consume", ("week", T.StringType()))).parquet(path)


@register("mart_region_visit_copy", with_ctes("SELECT * FROM region_visit_dataset",
                                              "region_visit_dataset"))
def q_region_visit_copy(spark, sf_dir):
    path = scratch_path(spark, "copy") + "/region_visit_dataset"
    t = Tables(spark, sf_dir)
    P.region_visit(t.raw("travel"), t.processed_visit).write.parquet(path)
    return spark.read.parquet(path)


@register("poi_to_parquet", with_ctes(
    "SELECT CAST(SGG_CD AS VARCHAR) AS SGG_CD, CAST(LOTNO_CD AS VARCHAR) AS LOTNO_CD, POI_NM, POI_TYPE "
    "FROM poi", "poi"))
def q_poi_to_parquet(spark, sf_dir):
    root = scratch_path(spark, "poi")
    Tables(spark, sf_dir).raw("poi").write.option("header", "true").csv(f"{root}/csv")
    schema = "SGG_CD INT, LOTNO_CD BIGINT, POI_NM STRING, POI_TYPE STRING"
    src = spark.read.option("header", "true").schema(schema).csv(f"{root}/csv")
    K.code_columns_as_text(src).write.parquet(f"{root}/parquet")
    return spark.read.parquet(f"{root}/parquet")


# --------------------------------------------------------------------------
# Typed loads
# --------------------------------------------------------------------------
def _raw_text_travel(t: Tables):
    """Travel as a source file would carry it: lower-case names, all text."""
    return t.raw("travel").select(*[F.col(c).cast("string").alias(c.lower()) for c in
                                    t.raw("travel").columns])


@register("bulk_load", with_ctes("SELECT * FROM travel", "travel"))
def q_bulk_load(spark, sf_dir):
    root = scratch_path(spark, "bulk")
    t = Tables(spark, sf_dir)
    src = _raw_text_travel(t).withColumn(
        "week", F.date_format(slice_week_start(F.to_date("travel_end_ymd"), BASE), "yyyy-MM-dd"))
    SK.write_weekly(src, f"{root}/raw", "travel")
    return L.bulk_load(spark, f"{root}/raw", "travel", f"{root}/typed/travel",
                       pattern=r".*/week=[0-9-]+/part-.*\.parquet$")


@register("weekly_append", with_ctes(
    f"SELECT * FROM travel WHERE TRAVEL_END_YMD <= DATE '{WEEK_END}'", "travel"))
def q_weekly_append(spark, sf_dir):
    root = scratch_path(spark, "append")
    t = Tables(spark, sf_dir)
    travel = _weekly(t.raw("travel"), "TRAVEL_END_YMD")
    SK.write_weekly(travel, f"{root}/raw", "travel")
    target = f"{root}/typed/travel"
    L.write_typed_weeks(travel.filter(F.col("TRAVEL_END_YMD") < F.to_date(F.lit(CUTOFF))), target)
    L.weekly_append(spark, f"{root}/raw", "travel", WEEK_START, target)
    return L.weekly_append(spark, f"{root}/raw", "travel", WEEK_START, target)   # re-run: no change


@register("align_schema", with_ctes("SELECT * FROM move", "move"))
def q_align_schema(spark, sf_dir):
    mv = Tables(spark, sf_dir).raw("move")
    src = mv.select(F.col("TRAVEL_ID").alias("travel_id"), F.col("TRIP_ID").cast("string").alias("Trip_Id"),
                    F.col("END_VISIT_AREA_ID").alias("end_visit_area_id"),
                    F.col("END_DT_YMD").alias("END_DT_YMD"), F.col("MVMN_CD_1").alias("mvmn_cd_1"),
                    F.lit("x").alias("UNEXPECTED"))
    return L.align_schema(src, RAW_SCHEMAS["move"])


def _visit_text_coords(t: Tables):
    v = t.raw("visit_area_info")
    bad = (F.col("VISIT_AREA_ID") % 37) == 0
    return v.withColumns({
        "X_COORD": F.when(bad, F.lit("n/a")).otherwise(F.col("X_COORD").cast("string")),
        "Y_COORD": F.col("Y_COORD").cast("string")})


@register("load_skip_bad_rows", with_ctes(
    "SELECT * FROM visit_area_info WHERE VISIT_AREA_ID % 37 <> 0", "visit_area_info"))
def q_load_skip_bad_rows(spark, sf_dir):
    return L.load_skip_bad_rows(_visit_text_coords(Tables(spark, sf_dir)), RAW_SCHEMAS["visit_area_info"])


@register("load_once", with_ctes("SELECT * FROM travel", "travel"))
def q_load_once(spark, sf_dir):
    root = scratch_path(spark, "once")
    SK.write_weekly(_weekly(Tables(spark, sf_dir).raw("travel"), "TRAVEL_END_YMD"), f"{root}/raw", "travel")
    INC.load_once(spark, f"{root}/raw/travel", "travel", f"{root}/typed", f"{root}/ckpt")
    again = INC.load_once(spark, f"{root}/raw/travel", "travel", f"{root}/typed", f"{root}/ckpt")
    assert again == 0, again
    return INC.read_loaded(spark, f"{root}/typed", RAW_SCHEMAS["travel"])


@register("ctas", MARTS["mart_gender_age"])
def q_ctas(spark, sf_dir):
    path = scratch_path(spark, "ctas")
    name = "traveler_gender_age_" + path.rsplit("-", 1)[-1]
    db = L.ensure_database(spark, "tripwise_analysis", scratch_path(spark, "analysis-db"))
    return L.ctas(M.gender_age(Tables(spark, sf_dir).raw("traveller_master")), name, path, database=db)


@register("insert_select", with_ctes("SELECT * FROM processed_lodge", "processed_lodge"))
def q_insert_select(spark, sf_dir):
    path = scratch_path(spark, "insert")
    name = "tripwise_insert_" + path.rsplit("-", 1)[-1]
    lodge = Tables(spark, sf_dir).processed_lodge
    early = F.col("PAYMENT_DT_YMD") < F.to_date(F.lit(CUTOFF))
    L.ctas(lodge.filter(early), name, path)
    return L.insert_select(lodge.filter(~early), name)


@register("add_null_columns", with_ctes(
    "SELECT *, CAST(NULL AS VARCHAR) AS SIDO, CAST(NULL AS VARCHAR) AS SGG, "
    "CAST(NULL AS VARCHAR) AS SIDO_SGG FROM lodge_consume", "lodge_consume"))
def q_add_null_columns(spark, sf_dir):
    return P.add_null_columns(Tables(spark, sf_dir).raw("lodge_consume"))


# --------------------------------------------------------------------------
# Cleansing
# --------------------------------------------------------------------------
@register("prune_columns", with_ctes("SELECT * FROM activity_consume", "activity_consume"))
def q_prune_columns(spark, sf_dir):
    wide = Tables(spark, sf_dir).raw("activity_consume").withColumns({
        "PAYMENT_DT_MIN": F.lit("12:00"), "SGG_CD": F.lit(0)})
    return C.prune_columns(wide, "tn_activity_consume")


SOURCE_FILES = [  # (dataset name, fixture table)
    ("tn_travel_여행", "travel"),
    ("tn_visit_area_info_방문지정보", "visit_area_info"),
    ("tn_traveller_master_여행객 Master", "traveller_master"),
    ("tn_activity_consume_his_활동소비내역", "activity_consume"),
    ("tn_tour_photo_관광사진", "move"),
    ("tc_codeb_코드B", "meta_codeb"),
]


def _source_listing(spark, sf_dir, suffix: str):
    """Write fixture tables under source-style dataset names and read them
    back: the rows of each file, with the dataset name taken from its folder.
    Rows are counted by the stored path first and the counts written, so that
    names are worked out once per file: a filter on a name would otherwise be
    pushed below the count and spell the name of every row."""
    root = scratch_path(spark, "names")
    t = Tables(spark, sf_dir)
    for ds, table in SOURCE_FILES:
        t.raw(table).select(F.lit(1).alias("ONE")).write.parquet(f"{root}/{ds}{suffix}")
    df = spark.read.option("recursiveFileLookup", "true").parquet(root)
    files = df.groupBy(F.col("_metadata.file_path").alias(SC.FILE_PATH)).agg(F.count(F.lit(1)).alias("ROWS"))
    files = W.materialize(files, f"{root}-files")
    return files.select(F.regexp_extract(SC.decoded(F.col(SC.FILE_PATH)), r"/([^/]+)/part-[^/]*$", 1).alias("SOURCE_NAME"), "ROWS")


def _listing_oracle(suffix: str, select: str, where: str = "") -> str:
    parts = [f"SELECT {_q(ds + suffix)} AS SOURCE_NAME FROM {table}" for ds, table in SOURCE_FILES]
    body = f"SELECT {select} FROM ({' UNION ALL '.join(parts)}) {where} GROUP BY ALL"
    return with_ctes(body, *{t for _, t in SOURCE_FILES})


_KEY_SQL = ("CASE WHEN strpos(array_to_string((string_split(SOURCE_NAME, '_'))[1:3], '_'), 'tn_travel_') > 0 "
            "THEN 'tn_travel_travel' ELSE array_to_string((string_split(SOURCE_NAME, '_'))[1:3], '_') END")


@register("resolve_table", _listing_oracle(
    "_980607.parquet", f"SOURCE_NAME, {_KEY_SQL} AS TABLE_KEY, COUNT(*) AS ROWS"))
def q_resolve_table(spark, sf_dir):
    names = _source_listing(spark, sf_dir, "_980607.parquet")
    return (names.groupBy("SOURCE_NAME").agg(F.sum("ROWS").alias("ROWS"))
            .withColumn("TABLE_KEY", C.table_key(F.col("SOURCE_NAME"))))


@register("skip_unused_tables", _listing_oracle(
    "_980607.parquet", f"{_KEY_SQL} AS TABLE_KEY, COUNT(*) AS ROWS",
    "WHERE " + _KEY_SQL + " NOT IN ('tn_adv_consume', 'tn_companion_info', 'tn_tour_photo')"))
def q_skip_unused_tables(spark, sf_dir):
    names = _source_listing(spark, sf_dir, "_980607.parquet").withColumn(
        "TABLE_KEY", C.table_key(F.col("SOURCE_NAME")))
    return (names.filter(~C.is_unused_table(F.col("TABLE_KEY")))
            .groupBy("TABLE_KEY").agg(F.sum("ROWS").alias("ROWS")))


@register("canonical_name", _listing_oracle(
    "_combine", "regexp_replace(SOURCE_NAME, '_combine$', '') AS CANONICAL, COUNT(*) AS ROWS",
    "WHERE regexp_replace(SOURCE_NAME, '_combine$', '') IN ("
    + ", ".join(_q(c) for c in CANONICAL_DATASETS) + ")"))
def q_canonical_name(spark, sf_dir):
    names = _source_listing(spark, sf_dir, "_combine")
    return (names.select(K.canonical_name(F.col("SOURCE_NAME")).alias("CANONICAL"), "ROWS")
            .filter(F.col("CANONICAL").isNotNull())
            .groupBy("CANONICAL").agg(F.sum("ROWS").alias("ROWS")))


_VISIT_COLS = [f.name for f in RAW_SCHEMAS["visit_area_info"].fields]
_VISIT_DOUBLES = [f.name for f in RAW_SCHEMAS["visit_area_info"].fields
                  if isinstance(f.dataType, T.DoubleType)]


@register("drop_null_rows", with_ctes(
    "SELECT * FROM visit_area_info WHERE " + " AND ".join(f"{c} IS NOT NULL" for c in _VISIT_COLS)
    + " AND " + " AND ".join(f"NOT isnan({c})" for c in _VISIT_DOUBLES), "visit_area_info"))
def q_drop_null_rows(spark, sf_dir):
    return C.drop_null_rows(Tables(spark, sf_dir).raw("visit_area_info"))


@register("binary_to_string", with_ctes("SELECT * FROM lodge_consume", "lodge_consume"))
def q_binary_to_string(spark, sf_dir):
    lodge = Tables(spark, sf_dir).raw("lodge_consume")
    as_bytes = lodge.withColumn("LODGING_NM", F.col("LODGING_NM").cast("binary"))
    return C.binary_to_string(as_bytes)


@register("observe_counts", with_ctes("""
    SELECT COUNT(*) AS ROWS_BEFORE,
           COUNT(*) FILTER (WHERE TRAVEL_ID IS NOT NULL AND VISIT_AREA_ID IS NOT NULL
               AND ACTIVITY_TYPE_CD IS NOT NULL AND PAYMENT_AMT_WON IS NOT NULL
               AND PAYMENT_DT_YMD IS NOT NULL AND STORE_NM IS NOT NULL) AS ROWS_AFTER
    FROM activity_consume""", "activity_consume"))
def q_observe_counts(spark, sf_dir):
    path = scratch_path(spark, "observe")
    src = Tables(spark, sf_dir).raw("activity_consume")
    before, ob = C.observe_counts(src, "before")
    after, oa = C.observe_counts(C.cleanse(before, "tn_activity_consume"), "after")
    after.write.parquet(path)          # one job fills both counters
    row = [(int(ob.get["rows"]), int(oa.get["rows"]))]
    return spark.createDataFrame(row, "ROWS_BEFORE bigint, ROWS_AFTER bigint")


# --------------------------------------------------------------------------
# Slicing and cut-off
# --------------------------------------------------------------------------
@register("week_slice", with_ctes(
    f"SELECT * FROM visit_area_info WHERE VISIT_END_YMD BETWEEN DATE '{WEEK_START}' AND DATE '{WEEK_END}'",
    "visit_area_info"))
def q_week_slice(spark, sf_dir):
    return S.week_slice(Tables(spark, sf_dir).raw("visit_area_info"), "tn_visit_area_info",
                        WEEK_START, WEEK_END)


@register("week_slice_last", with_ctes(
    f"SELECT *, PAYMENT_DT_YMD + 1 AS CHECKOUT_YMD FROM lodge_consume "
    f"WHERE PAYMENT_DT_YMD + 1 BETWEEN DATE '{WEEK_START}' AND DATE '{WEEK_END}'", "lodge_consume"))
def q_week_slice_last(spark, sf_dir):
    lodge = Tables(spark, sf_dir).raw("lodge_consume").withColumn(
        "CHECKOUT_YMD", F.date_add("PAYMENT_DT_YMD", 1))
    return S.week_slice(lodge, "tn_lodge_consume", WEEK_START, WEEK_END, first=False)


@register("gps_week_slice", with_ctes(
    "SELECT * FROM gps WHERE DT_YMD BETWEEN DATE '2024-01-07' AND DATE '2024-01-13'", "gps"))
def q_gps_week_slice(spark, sf_dir):
    return S.gps_week_slice(Tables(spark, sf_dir).raw("gps"), "2024-01-07", "2024-01-13")


_CUT_TABLES = ["activity_consume", "lodge_consume", "move", "mvmn_consume", "travel", "visit_area_info"]


@register("reset_to_cutoff", with_ctes(" UNION ALL ".join(
    f"SELECT '{t}' AS TABLE_NAME, COUNT(*) AS ROW_COUNT FROM {t} "
    f"WHERE {c} < DATE '{CUTOFF}'" for t, c in
    [(t, CUTOFF_COLUMN[t]) for t in _CUT_TABLES]),
    *_CUT_TABLES))
def q_reset_to_cutoff(spark, sf_dir):
    t = Tables(spark, sf_dir)
    out = None
    for name in _CUT_TABLES:
        kept = F.col(CUTOFF_COLUMN[name]) < F.to_date(F.lit(CUTOFF))
        part = t.raw(name).select(F.lit(name).alias("TABLE_NAME"), kept.alias("KEPT"))
        out = part if out is None else out.unionByName(part)
    # conditional count: a table with nothing before the cut-off reports 0
    return out.groupBy("TABLE_NAME").agg(F.count(F.when(F.col("KEPT"), 1)).alias("ROW_COUNT"))


@register("seed_processed", with_ctes(
    f"SELECT *, CAST(NULL AS VARCHAR) AS SIDO, CAST(NULL AS VARCHAR) AS SGG, "
    f"CAST(NULL AS VARCHAR) AS SIDO_SGG FROM visit_area_info WHERE VISIT_END_YMD < DATE '{CUTOFF}'",
    "visit_area_info"))
def q_seed_processed(spark, sf_dir):
    return P.seed_processed(Tables(spark, sf_dir).raw("visit_area_info"), "visit_area_info", CUTOFF)


@register("seed_processed_lodge", with_ctes(
    f"SELECT *, CAST(NULL AS VARCHAR) AS SIDO, CAST(NULL AS VARCHAR) AS SGG, "
    f"CAST(NULL AS VARCHAR) AS SIDO_SGG FROM lodge_consume WHERE {CUTOFF_COLUMN['lodge_consume']} < DATE '{CUTOFF}'",
    "lodge_consume"))
def q_seed_processed_lodge(spark, sf_dir):
    return P.seed_processed(Tables(spark, sf_dir).raw("lodge_consume"), "lodge_consume", CUTOFF)


@register("code_tables_capital", with_ctes("SELECT * FROM codeb_distinct", "codeb_distinct"))
def q_code_tables_capital(spark, sf_dir):
    return P.codeb_capital(Tables(spark, sf_dir).raw("meta_codeb"))


@register("code_tables_capital_codea", with_ctes("SELECT * FROM codea_distinct", "codea_distinct"))
def q_code_tables_capital_codea(spark, sf_dir):
    return P.codea_capital(Tables(spark, sf_dir).raw("meta_codea"))


@register("code_lookup", with_ctes(
    "SELECT CD_A, CD_B, CD_NM FROM codeb_distinct WHERE CD_A = 'ACT'", "codeb_distinct"))
def q_code_lookup(spark, sf_dir):
    return P.code_lookup(Tables(spark, sf_dir).codes, "ACT")


@register("sgg_distinct", with_ctes("SELECT DISTINCT * FROM meta_sgg", "meta_sgg"))
def q_sgg_distinct(spark, sf_dir):
    return P.sgg_distinct(Tables(spark, sf_dir).raw("meta_sgg"))


@register("valid_region_filter", with_ctes("SELECT * FROM processed_visit", "processed_visit"))
def q_valid_region_filter(spark, sf_dir):
    return P.valid_rows(P.annotate_table(Tables(spark, sf_dir).raw("visit_area_info"), "visit_area_info"))


# --------------------------------------------------------------------------
# Address functions
# --------------------------------------------------------------------------
@register("addr_split", with_ctes(
    "SELECT TRAVEL_ID, VISIT_AREA_ID, LOTNO_ADDR, split_part(LOTNO_ADDR, ' ', 1) AS FIRST_TOKEN, "
    "split_part(LOTNO_ADDR, ' ', 2) AS SECOND_TOKEN FROM visit_area_info", "visit_area_info"))
def q_addr_split(spark, sf_dir):
    v = Tables(spark, sf_dir).raw("visit_area_info")
    a = F.col("LOTNO_ADDR")
    return v.select("TRAVEL_ID", "VISIT_AREA_ID", "LOTNO_ADDR", A.first_token(a).alias("FIRST_TOKEN"),
                    A.second_token(a).alias("SECOND_TOKEN"))


@register("normalize_sido_lodge", with_ctes("SELECT * FROM annotated_lodge", "annotated_lodge"))
def q_normalize_sido_lodge(spark, sf_dir):
    return P.annotate_table(Tables(spark, sf_dir).raw("lodge_consume"), "lodge_consume")


@register("normalize_sido_visit", with_ctes("SELECT * FROM annotated_visit", "annotated_visit"))
def q_normalize_sido_visit(spark, sf_dir):
    return P.annotate_table(Tables(spark, sf_dir).raw("visit_area_info"), "visit_area_info")


@register("sido_sgg", with_ctes(
    "SELECT TRAVEL_ID, ROAD_NM_ADDR, TRIM(s || ' ' || g) AS SIDO_SGG FROM ("
    "SELECT TRAVEL_ID, ROAD_NM_ADDR, split_part(ROAD_NM_ADDR, ' ', 1) AS s, "
    "split_part(ROAD_NM_ADDR, ' ', 2) AS g FROM lodge_consume)", "lodge_consume"))
def q_sido_sgg(spark, sf_dir):
    lodge = Tables(spark, sf_dir).raw("lodge_consume")
    a = F.col("ROAD_NM_ADDR")
    return lodge.select("TRAVEL_ID", "ROAD_NM_ADDR",
                        A.sido_sgg(A.first_token(a), A.second_token(a)).alias("SIDO_SGG"))


@register("sejong_unify", with_ctes("SELECT * FROM annotated_visit", "annotated_visit"))
def q_sejong_unify(spark, sf_dir):
    """Sejong rows get their one district; all other rows stay untouched."""
    return P.annotate_table(Tables(spark, sf_dir).raw("visit_area_info"), "visit_area_info")


# --------------------------------------------------------------------------
# Consolidation (L0)
# --------------------------------------------------------------------------
@register("tag_region", with_ctes("SELECT * FROM gps", "gps"))
def q_tag_region(spark, sf_dir):
    root = scratch_path(spark, "regions")
    gps = Tables(spark, sf_dir).raw("gps")
    for r in REGIONS:   # one source folder per region, as delivered
        gps.filter(F.col("REGION") == r).drop("REGION").write.parquet(f"{root}/{r}/gps")
    df = spark.read.option("recursiveFileLookup", "true").parquet(root)
    below = SC.relative_path(spark, F.col("_metadata.file_path"), root)
    return K.tag_region(df, K.region_from_path(below))


@register("drop_datetime_columns", with_ctes(
    "SELECT TRAVEL_ID, MOBILE_NUM_ID, DT_YMD, REGION FROM gps", "gps"))
def q_drop_datetime_columns(spark, sf_dir):
    return K.drop_datetime_columns(Tables(spark, sf_dir).raw("gps"))


def _split(t: Tables):
    v = t.raw("visit_area_info")
    is_val = (F.col("VISIT_AREA_ID") % 5) == 0
    return v.filter(~is_val), v.filter(is_val).withColumn("SPLIT", F.lit("val"))


@register("union_train_val", with_ctes(
    "SELECT *, CASE WHEN VISIT_AREA_ID % 5 = 0 THEN 'val' END AS SPLIT FROM visit_area_info",
    "visit_area_info"))
def q_union_train_val(spark, sf_dir):
    train, val = _split(Tables(spark, sf_dir))
    return K.union_train_val(train, val)


@register("reconcile_counts", with_ctes("""
    SELECT COUNT(*) FILTER (WHERE VISIT_AREA_ID % 5 <> 0) AS TRAIN_ROWS,
           COUNT(*) FILTER (WHERE VISIT_AREA_ID % 5 = 0) AS VAL_ROWS,
           COUNT(*) AS COMBINED_ROWS, TRUE AS MATCHES FROM visit_area_info""", "visit_area_info"))
def q_reconcile_counts(spark, sf_dir):
    train, val = _split(Tables(spark, sf_dir))
    return Q.reconcile_counts({"train": train, "val": val}, K.union_train_val(train, val))


_REGION_OF = "CASE VISIT_AREA_ID % 4 " + " ".join(f"WHEN {k} THEN '{r}'" for k, r in enumerate(REGIONS)) + " END"


@register("union_regions_dedup", with_ctes(
    f"SELECT DISTINCT *, {_REGION_OF} AS REGION FROM visit_area_info", "visit_area_info"))
def q_union_regions_dedup(spark, sf_dir):
    """Region extracts of a table, each delivered twice in part."""
    visit = K.drop_datetime_columns(Tables(spark, sf_dir).raw("visit_area_info"))
    frames = []
    for k, region in enumerate(REGIONS):
        own = K.tag_region(visit.filter(F.col("VISIT_AREA_ID") % 4 == k), region)
        frames += [own, own.filter(F.col("VISIT_AREA_ID") % 3 == 0)]
    return K.union_regions(frames, dedup=True)


@register("union_gps", with_ctes("SELECT * FROM gps", "gps"))
def q_union_gps(spark, sf_dir):
    gps = Tables(spark, sf_dir).raw("gps")
    return K.union_regions([gps.filter(F.col("REGION") == r) for r in REGIONS], dedup=False)


@register("parse_dates_lenient", with_ctes(
    "SELECT TRAVEL_ID, TRAVEL_START_YMD, TRY_CAST(TRAVEL_START_YMD AS DATE) AS START_DATE FROM travel",
    "travel"))
def q_parse_dates_lenient(spark, sf_dir):
    tr = Tables(spark, sf_dir).raw("travel")
    return tr.select("TRAVEL_ID", "TRAVEL_START_YMD",
                     lenient_date(F.col("TRAVEL_START_YMD")).alias("START_DATE"))


@register("split_datetime", with_ctes("""
    SELECT TRAVEL_ID, CAST(DT_MIN AS DATE) AS DT_YMD, strftime(DT_MIN, '%H:%M:%S') AS DT_MIN,
           CAST(DT_MIN AS TIMESTAMP) AS CHK_OUT_DT, CAST(DT_MIN AS DATE) AS CHK_OUT_DT_YMD,
           strftime(DT_MIN, '%H:%M:%S') AS CHK_OUT_DT_MIN
    FROM gps""", "gps"))
def q_split_datetime(spark, sf_dir):
    g = Tables(spark, sf_dir).raw("gps")
    src = g.select("TRAVEL_ID", "DT_MIN", F.col("DT_MIN").cast("string").alias("CHK_OUT_DT"))
    return K.split_datetime(src)


@register("split_date_range", with_ctes("""
    SELECT TRAVELER_ID, TRAVEL_STATUS_YMD,
           split_part(TRAVEL_STATUS_YMD, '~', 1) AS TRAVEL_STATUS_START_YMD,
           CASE WHEN strpos(TRAVEL_STATUS_YMD, '~') > 0 THEN split_part(TRAVEL_STATUS_YMD, '~', 2) END
               AS TRAVEL_STATUS_END_YMD,
           TRY_CAST(split_part(TRAVEL_STATUS_YMD, '~', 1) AS DATE) AS START_DATE,
           TRY_CAST(CASE WHEN strpos(TRAVEL_STATUS_YMD, '~') > 0
                         THEN split_part(TRAVEL_STATUS_YMD, '~', 2) END AS DATE) AS END_DATE
    FROM traveller_status_text""", "traveller_status_text"))
def q_split_date_range(spark, sf_dir):
    df = K.split_date_range(Tables(spark, sf_dir).raw("traveller_status_text"))
    return df.withColumns({"START_DATE": lenient_date(F.col("TRAVEL_STATUS_START_YMD")),
                           "END_DATE": lenient_date(F.col("TRAVEL_STATUS_END_YMD"))})


@register("coerce_coordinates", with_ctes(
    "SELECT * REPLACE (CASE WHEN VISIT_AREA_ID % 37 = 0 THEN NULL ELSE X_COORD END AS X_COORD) "
    "FROM visit_area_info", "visit_area_info"))
def q_coerce_coordinates(spark, sf_dir):
    return K.coerce_numeric(_visit_text_coords(Tables(spark, sf_dir)), ["X_COORD", "Y_COORD"])


@register("fill_missing", with_ctes(
    "SELECT * REPLACE (COALESCE(MOBILE_NUM_ID, 'MISSING') AS MOBILE_NUM_ID) FROM gps", "gps"))
def q_fill_missing(spark, sf_dir):
    return K.fill_missing_text(Tables(spark, sf_dir).raw("gps"), "MOBILE_NUM_ID")


_GPS_LETTERS = {2022: "abcd", 2023: "efgh"}   # one letter per region


def _letter_sql(year: int) -> str:
    return "CASE REGION " + " ".join(f"WHEN '{r}' THEN '{x}'" for r, x in zip(REGIONS, _GPS_LETTERS[year])) + " ELSE 'x' END"


@register("extract_travel_id", with_ctes(" UNION ALL ".join(f"""
    SELECT NAME, {year} AS SOURCE_YEAR, NULLIF(regexp_extract(NAME, '{K.TRAVEL_ID_PATTERNS[year]}', 1), '') AS TRAVEL_KEY
    FROM (SELECT DISTINCT 'tn_gps_coord_' || L || '_' || L || lpad(TRAVEL_ID, 6, '0') || '.csv' AS NAME
          FROM (SELECT TRAVEL_ID, {_letter_sql(year)} AS L FROM gps))""" for year in (2022, 2023)), "gps"))
def q_extract_travel_id(spark, sf_dir):
    """File names of both source years, each with its year's id pattern."""
    g = Tables(spark, sf_dir).raw("gps")
    out = None
    for year in (2022, 2023):
        letter = F.expr(_letter_sql(year))
        name = F.concat(F.lit("tn_gps_coord_"), letter, F.lit("_"), letter, F.lpad(F.col("TRAVEL_ID"), 6, "0"), F.lit(".csv"))
        part = (g.select(name.alias("NAME")).distinct().withColumn("SOURCE_YEAR", F.lit(year))
                .withColumn("TRAVEL_KEY", K.extract_travel_id(F.col("NAME"), year)))
        out = part if out is None else out.unionByName(part)
    return out


@register("week_key", with_ctes(
    f"SELECT TRAVEL_ID, VISIT_AREA_ID, VISIT_END_YMD, "
    f"CAST({duck_week('VISIT_END_YMD')} AS DATE) AS WEEK_START, "
    f"strftime(CAST({duck_week('VISIT_END_YMD')} AS DATE), '%y%m%d') AS WEEK_KEY FROM visit_area_info",
    "visit_area_info"))
def q_week_key(spark, sf_dir):
    v = Tables(spark, sf_dir).raw("visit_area_info")
    ws = slice_week_start(F.col("VISIT_END_YMD"), BASE)
    return v.select("TRAVEL_ID", "VISIT_AREA_ID", "VISIT_END_YMD", ws.alias("WEEK_START"),
                    week_key(ws).alias("WEEK_KEY"))


# --------------------------------------------------------------------------
# Profiles and reconciliations
# --------------------------------------------------------------------------
@register("profile_nulls", with_ctes(" UNION ALL ".join(
    f"SELECT '{c}' AS COLUMN_NAME, COUNT(*) - COUNT({c}) AS NULL_COUNT FROM visit_area_info"
    for c in _VISIT_COLS), "visit_area_info"))
def q_profile_nulls(spark, sf_dir):
    return Q.profile_nulls(Tables(spark, sf_dir).raw("visit_area_info"))


@register("profile_date_range", with_ctes("""
    SELECT 'travel' AS TABLE_NAME, 'TRAVEL_START_YMD' AS COLUMN_NAME,
           MIN(TRY_CAST(TRAVEL_START_YMD AS DATE)) AS MIN_DATE, MAX(TRY_CAST(TRAVEL_START_YMD AS DATE)) AS MAX_DATE
    FROM travel
    UNION ALL
    SELECT 'travel', 'TRAVEL_END_YMD', MIN(TRAVEL_END_YMD), MAX(TRAVEL_END_YMD) FROM travel""", "travel"))
def q_profile_date_range(spark, sf_dir):
    return Q.profile_date_range(Tables(spark, sf_dir).raw("travel"), "travel")


@register("profile_distinct_by_region", with_ctes(
    "SELECT REGION, COUNT(DISTINCT TRAVEL_ID) AS DISTINCT_IDS FROM gps GROUP BY REGION", "gps"))
def q_profile_distinct_by_region(spark, sf_dir):
    return Q.profile_distinct_by_region(Tables(spark, sf_dir).raw("gps"))


_X_TEXT = "CASE WHEN VISIT_AREA_ID % 37 = 0 THEN 'n/a' ELSE CAST(X_COORD AS VARCHAR) END"


@register("profile_value_types", with_ctes(f"""
    SELECT CASE WHEN X IS NULL THEN 'null' WHEN TRY_CAST(X AS DOUBLE) IS NOT NULL THEN 'number'
                ELSE 'text' END AS VALUE_KIND, COUNT(*) AS N
    FROM (SELECT {_X_TEXT} AS X FROM visit_area_info) GROUP BY 1""", "visit_area_info"))
def q_profile_value_types(spark, sf_dir):
    return Q.profile_value_types(_visit_text_coords(Tables(spark, sf_dir)), "X_COORD")


@register("coercion_audit", with_ctes(
    "SELECT TRAVEL_ID, VISIT_AREA_ID, 'n/a' AS X_COORD FROM visit_area_info WHERE VISIT_AREA_ID % 37 = 0",
    "visit_area_info"))
def q_coercion_audit(spark, sf_dir):
    df = _visit_text_coords(Tables(spark, sf_dir)).select("TRAVEL_ID", "VISIT_AREA_ID", "X_COORD")
    return Q.coercion_audit(df, "X_COORD")


@register("coercion_summary", with_ctes(f"""
    SELECT CAST(SUM(CASE WHEN X IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS NULLS_BEFORE,
           CAST(SUM(CASE WHEN TRY_CAST(X AS DOUBLE) IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS NULLS_AFTER
    FROM (SELECT {_X_TEXT} AS X FROM visit_area_info)""", "visit_area_info"))
def q_coercion_summary(spark, sf_dir):
    return Q.coercion_summary(_visit_text_coords(Tables(spark, sf_dir)), "X_COORD")


@register("profile_duplicates", with_ctes("""
    SELECT TRAVEL_ID, MOBILE_NUM_ID, DT_YMD, REGION, COUNT(*) AS DUP_COUNT
    FROM gps GROUP BY ALL HAVING COUNT(*) > 1""", "gps"))
def q_profile_duplicates(spark, sf_dir):
    return Q.profile_duplicates(K.drop_datetime_columns(Tables(spark, sf_dir).raw("gps")))


@register("gps_missing_ids", with_ctes("""
    SELECT DISTINCT TRAVEL_ID FROM travel t
    WHERE NOT EXISTS (SELECT 1 FROM gps g WHERE g.TRAVEL_ID = t.TRAVEL_ID)""", "travel", "gps"))
def q_gps_missing_ids(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return Q.missing_ids(t.raw("travel"), t.raw("gps"))


_PAIRS = [(a, b) for i, a in enumerate(REGIONS) for b in REGIONS[i + 1:]]


@register("region_key_symdiff", with_ctes(
    "SELECT p.A AS REGION_A, p.B AS REGION_B, s.DAY_KEY, any_value(s.REGION) AS ONLY_IN "
    "FROM (SELECT DISTINCT TRAVEL_ID || '@' || CAST(DT_YMD AS VARCHAR) AS DAY_KEY, REGION FROM gps) s "
    "JOIN (VALUES " + ", ".join(f"('{a}', '{b}')" for a, b in _PAIRS)
    + ") p(A, B) ON s.REGION = p.A OR s.REGION = p.B GROUP BY p.A, p.B, s.DAY_KEY HAVING COUNT(*) = 1",
    "gps"))
def q_region_key_symdiff(spark, sf_dir):
    """Traveller-day keys seen in one region of a pair but not the other."""
    g = Tables(spark, sf_dir).raw("gps")
    keyed = g.select(F.concat_ws("@", "TRAVEL_ID", F.col("DT_YMD").cast("string")).alias("DAY_KEY"), "REGION")
    return Q.region_key_symdiff(keyed, key="DAY_KEY")


@register("source_file_audit", with_ctes("""
    SELECT 'move' AS TABLE_NAME, COUNT(*) = 0 AS HEADER_ONLY FROM move
    UNION ALL SELECT 'travel', COUNT(*) = 0 FROM travel
    UNION ALL SELECT 'lodge_consume', TRUE""", "move", "travel"))
def q_source_file_audit(spark, sf_dir):
    """Which tables were delivered as header-only files.  Sizes depend on the
    writer; that every file of a table is tiny does not."""
    root = scratch_path(spark, "audit")
    t = Tables(spark, sf_dir)
    for name in ("move", "travel"):
        t.raw(name).write.option("header", "true").csv(f"{root}/{name}")
    L.typed_empty(spark, "lodge_consume").write.option("header", "true").csv(f"{root}/lodge_consume")
    files = Q.source_file_audit(SC.list_files(spark, root, "*.csv"))
    below = SC.relative_path(spark, SC.decoded(F.col(SC.FILE_PATH)), root)
    tables = spark.createDataFrame([("move",), ("travel",), ("lodge_consume",)], "TABLE_NAME string")
    found = files.select(F.substring_index(below, "/", 1).alias("TABLE_NAME"), "IS_SMALL")
    return (tables.join(found, "TABLE_NAME", "left").groupBy("TABLE_NAME")
            .agg(F.coalesce(F.bool_and("IS_SMALL"), F.lit(True)).alias("HEADER_ONLY")))


@register("preview_limit", with_ctes(
    "SELECT * FROM region_visit_dataset ORDER BY VISIT_COUNT DESC, SIDO, REGION LIMIT 5",
    "region_visit_dataset"))
def q_preview_limit(spark, sf_dir):
    t = Tables(spark, sf_dir)
    rv = P.region_visit(t.raw("travel"), t.processed_visit)
    return rv.orderBy(F.col("VISIT_COUNT").desc(), "SIDO", "REGION").limit(5)


# --------------------------------------------------------------------------
# Streams, calendar and run modes
# --------------------------------------------------------------------------
def _land_after_cutoff(t: Tables, table: str, col: str, root: str) -> str:
    raw = t.raw(table).filter(F.col(col) >= F.to_date(F.lit(CUTOFF)))
    return SK.write_weekly(_weekly(raw, col), root, table)


@register("stream_inserts", with_ctes(
    f"SELECT * FROM lodge_consume WHERE PAYMENT_DT_YMD >= DATE '{CUTOFF}'", "lodge_consume"))
def q_stream_inserts(spark, sf_dir):
    root = scratch_path(spark, "inserts")
    raw_dir = _land_after_cutoff(Tables(spark, sf_dir), "lodge_consume", "PAYMENT_DT_YMD", f"{root}/raw")
    INC.load_once(spark, raw_dir, "lodge_consume", f"{root}/out", f"{root}/ckpt")
    return INC.read_loaded(spark, f"{root}/out", RAW_SCHEMAS["lodge_consume"])


def _stream_processed(spark, sf_dir, table, col):
    root = scratch_path(spark, "stream")
    raw_dir = _land_after_cutoff(Tables(spark, sf_dir), table, col, f"{root}/raw")
    INC.append_week_changes(spark, raw_dir, table, f"{root}/processed", f"{root}/ckpt")
    return INC.read_loaded(spark, f"{root}/processed", PROCESSED_SCHEMAS[table])


@register("stream_lodge", with_ctes(
    f"SELECT * FROM processed_lodge WHERE PAYMENT_DT_YMD >= DATE '{CUTOFF}'", "processed_lodge"))
def q_stream_lodge(spark, sf_dir):
    return _stream_processed(spark, sf_dir, "lodge_consume", "PAYMENT_DT_YMD")


@register("stream_visit", with_ctes(
    f"SELECT * FROM processed_visit WHERE VISIT_END_YMD >= DATE '{CUTOFF}'", "processed_visit"))
def q_stream_visit(spark, sf_dir):
    return _stream_processed(spark, sf_dir, "visit_area_info", "VISIT_END_YMD")


@register("incremental_equals_full", with_ctes("SELECT * FROM processed_visit", "processed_visit"))
def q_incremental_equals_full(spark, sf_dir):
    """Seed before the cut-off, then two incremental runs (weeks up to one
    year after the cut-off, then the rest): the end state must equal the
    full rebuild."""
    root = scratch_path(spark, "incr")
    t = Tables(spark, sf_dir)
    raw = t.raw("visit_area_info")
    PL.seed(raw, "visit_area_info", CUTOFF, f"{root}/processed")
    later = _weekly(raw.filter(F.col("VISIT_END_YMD") >= F.to_date(F.lit(CUTOFF))), "VISIT_END_YMD")
    split = F.col("week") < F.lit("1999-06-06")
    SK.write_weekly(later.filter(split), f"{root}/raw", "visit_area_info")
    INC.append_week_changes(spark, f"{root}/raw/visit_area_info", "visit_area_info",
                            f"{root}/processed", f"{root}/ckpt")
    SK.write_weekly(later.filter(~split), f"{root}/raw", "visit_area_info")
    INC.append_week_changes(spark, f"{root}/raw/visit_area_info", "visit_area_info",
                            f"{root}/processed", f"{root}/ckpt")
    return INC.read_loaded(spark, f"{root}/processed", PROCESSED_SCHEMAS["visit_area_info"])


@register("pipeline_reset_then_week", with_ctes(
    f"SELECT * FROM processed_visit WHERE VISIT_END_YMD <= DATE '{WEEK_END}'", "processed_visit"))
def q_pipeline_reset_then_week(spark, sf_dir):
    root = scratch_path(spark, "pipeline")
    raw = Tables(spark, sf_dir).raw("visit_area_info")
    # a previous run left later weeks in the raw zone; reset removes them
    SK.write_weekly(_weekly(raw, "VISIT_END_YMD"), f"{root}/raw", "visit_area_info")
    return PL.run(spark, "reset", "visit_area_info", raw, f"{root}/raw", f"{root}/processed",
                  f"{root}/ckpt", CUTOFF, WEEK_START, WEEK_END)


@register("pipeline_incremental_week", with_ctes(
    "SELECT * FROM processed_visit WHERE VISIT_END_YMD <= DATE '1998-06-20'", "processed_visit"))
def q_pipeline_incremental_week(spark, sf_dir):
    """Reset run for the first week after the cut-off, then an incremental
    run for the next week: the checkpoint carries over, so only the new
    week's files are read."""
    root = scratch_path(spark, "pipeline-incr")
    raw = Tables(spark, sf_dir).raw("visit_area_info")
    args = (f"{root}/raw", f"{root}/processed", f"{root}/ckpt", CUTOFF)
    PL.run(spark, "reset", "visit_area_info", raw, *args, WEEK_START, WEEK_END)
    return PL.run(spark, "incremental", "visit_area_info", raw, *args, "1998-06-14", "1998-06-20")


@register("pipeline_rerun_week", with_ctes(
    f"SELECT * FROM processed_visit WHERE VISIT_END_YMD <= DATE '{WEEK_END}'", "processed_visit"))
def q_pipeline_rerun_week(spark, sf_dir):
    """The same week run twice is in the table once."""
    root = scratch_path(spark, "pipeline-rerun")
    raw = Tables(spark, sf_dir).raw("visit_area_info")
    args = (raw, f"{root}/raw", f"{root}/processed", f"{root}/ckpt", CUTOFF, WEEK_START, WEEK_END)
    PL.run(spark, "reset", "visit_area_info", *args)
    return PL.run(spark, "incremental", "visit_area_info", *args)


@register("pipeline_initial_after_incremental", with_ctes(
    "SELECT * FROM processed_visit WHERE VISIT_END_YMD <= DATE '1998-06-20'", "processed_visit"))
def q_pipeline_initial_after_incremental(spark, sf_dir):
    """Reseeding keeps the weeks that the raw zone holds."""
    root = scratch_path(spark, "pipeline-initial")
    raw = Tables(spark, sf_dir).raw("visit_area_info")
    args = (f"{root}/raw", f"{root}/processed", f"{root}/ckpt", CUTOFF)
    PL.run(spark, "reset", "visit_area_info", raw, *args, WEEK_START, WEEK_END)
    PL.run(spark, "incremental", "visit_area_info", raw, *args, "1998-06-14", "1998-06-20")
    return PL.run(spark, "initial", "visit_area_info", raw, *args, WEEK_START, WEEK_END)


@register("backfill_weeks", with_ctes(
    f"SELECT *, {duck_week('PAYMENT_DT_YMD')} AS week FROM mvmn_consume WHERE PAYMENT_DT_YMD IS NOT NULL",
    "mvmn_consume"))
def q_backfill_weeks(spark, sf_dir):
    """All weeks of a table in one job: tag rows with their week, write
    partitioned by week.  Rows without a usable date belong to no week."""
    root = scratch_path(spark, "backfill")
    tagged = S.with_week(Tables(spark, sf_dir).raw("mvmn_consume"), BASE).filter(F.col("week").isNotNull())
    path = SK.write_weekly(tagged, root, "mvmn_consume")
    return spark.read.schema(_schema_with("mvmn_consume", ("week", T.StringType()))).parquet(path)


@register("week_calendar", with_ctes(f"""
    SELECT CAST(ROW_NUMBER() OVER (ORDER BY ws) AS INTEGER) AS WEEK_NO, CAST(ws AS DATE) AS WEEK_START,
           CAST(ws AS DATE) + 6 AS WEEK_END, strftime(ws, '%y%m%d') AS WEEK_KEY
    FROM (SELECT unnest(generate_series(CAST({duck_week('lo')} AS DATE), CAST({duck_week('hi')} AS DATE),
                                        INTERVAL 7 DAY)) AS ws
          FROM (SELECT MIN(VISIT_END_YMD) AS lo, MAX(VISIT_END_YMD) AS hi FROM visit_area_info))""",
    "visit_area_info"))
def q_week_calendar(spark, sf_dir):
    return CAL.week_calendar(Tables(spark, sf_dir).raw("visit_area_info"), "VISIT_END_YMD", BASE)


@register("week_cursor", with_ctes(f"""
    SELECT today AS TODAY, CAST(s AS DATE) AS START_DATE, CAST(s AS DATE) + 6 AS END_DATE,
           today + 7 AS NEXT_DATE
    FROM (SELECT today, DATE '{BASE}' + CAST((floor(date_diff('day', DATE '{BASE}', today) / 7) - 1) * 7
                                             AS INTEGER) AS s
          FROM (SELECT MAX(VISIT_END_YMD) AS today FROM visit_area_info))""", "visit_area_info"))
def q_week_cursor(spark, sf_dir):
    today = Tables(spark, sf_dir).raw("visit_area_info").agg(F.max("VISIT_END_YMD").alias("TODAY"))
    return today.select("TODAY", *[c.alias(n) for n, c in CAL.week_cursor(F.col("TODAY"), BASE).items()])



_REFRESH_SQL = {
    "cumulative_travel_stats": "mart_travel_stats",
    "traveler_gender_age_distribution": "mart_gender_age",
    "traveler_job_distribution": "mart_job_distribution",
    "region_visit_dataset": "mart_region_visit",
    "region_visit_map": "mart_visit_map",
    "mvmn_price": "mart_mvmn_price",
    "region_activity_distribution": "mart_activity_distribution",
    "region_activity_consumption": "mart_activity_consumption",
    "activity_consume_by_area": "mart_consume_by_area",
    "lodging_type_distribution_with_cost": "mart_lodging_cost",
    "weekly_spending": "mart_weekly_spending",
    "region_visit_count": "mart_visit_count",
    "region_visitarea_analysis": "mart_satisfaction",
    "region_spatial_analysis": "mart_spatial",
}


def _refresh_oracle() -> str:
    """Row count of every mart, each computed by its own oracle statement."""
    parts = []
    for mart, key in _REFRESH_SQL.items():
        sql = MARTS[key]
        parts.append(f"SELECT '{mart}' AS MART, (SELECT COUNT(*) FROM ({sql})) AS ROW_COUNT")
    return " UNION ALL ".join(parts)


@register("analysis_refresh", _refresh_oracle())
def q_analysis_refresh(spark, sf_dir):
    """Whole weekly analysis step: all fourteen marts written, then their row
    counts read back in one job."""
    root = scratch_path(spark, "refresh")
    t = Tables(spark, sf_dir)
    inputs = {n: t.raw(n) for n in ("travel", "traveller_master", "mvmn_consume",
                                    "activity_consume", "lodge_consume")}
    # the processed step has written its tables before the analysis step runs
    inputs.update(processed_visit=W.materialize(t.processed_visit, f"{root}/processed/visit_area_info"),
                  processed_lodge=W.materialize(t.processed_lodge, f"{root}/processed/lodge_consume"),
                  codes=t.codes)
    paths = W.refresh_analysis(spark, inputs, f"{root}/analysis", f"{root}/tmp")
    out = None
    for mart, path in paths.items():
        part = spark.read.parquet(path).select(F.lit(mart).alias("MART"))
        out = part if out is None else out.unionByName(part)
    return out.groupBy("MART").agg(F.count(F.lit(1)).alias("ROW_COUNT"))


@register("bucketed_region_visit", with_ctes("SELECT * FROM region_visit_dataset", "region_visit_dataset"))
def q_bucketed_region_visit(spark, sf_dir):
    """Region visits over the production layout: travel and processed visits
    stored bucketed on TRAVEL_ID, so the de-duplication and the existence
    join run on co-partitioned inputs (no shuffle of either table)."""
    t = Tables(spark, sf_dir)
    db = L.ensure_database(spark, "tripwise_processed", scratch_path(spark, "processed-db"))
    tag = scratch_path(spark, "bucketed").rsplit("-", 1)[-1]
    # Both tables need the same number of buckets, so the larger one decides.
    n = SK.bucket_count(spark, t.raw("travel").count(), t.raw("visit_area_info").count())
    travel = SK.write_bucketed(t.raw("travel"), db, f"travel_{tag}", scratch_path(spark, "b-travel"),
                               "TRAVEL_ID", n)
    visit = SK.write_bucketed(t.processed_visit, db, f"visit_area_info_{tag}",
                              scratch_path(spark, "b-visit"), "TRAVEL_ID", n)
    return P.region_visit(travel, visit)
