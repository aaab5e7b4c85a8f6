"""Cleansing, loading, consolidation and calendar operators."""

import datetime as dt

from pyspark.sql import functions as F

from tripwise.operators import cleanse as C
from tripwise.operators import consolidate as K
from tripwise.plans import calendar as CAL
from tripwise.schemas import RAW_SCHEMAS
from tripwise.sources import load as L


def test_table_key_rules(spark):
    names = ["tn_travel_여행_230604.parquet", "tn_traveller_master_여행객 Master_230604.parquet",
             "tn_visit_area_info_방문지정보_230604.parquet", "tc_codeb_코드B.parquet",
             "tn_tour_photo_관광사진_230604.parquet"]
    df = spark.createDataFrame([(n,) for n in names], "N string")
    keys = [r.K for r in df.select(C.table_key(F.col("N")).alias("K")).collect()]
    assert keys == ["tn_travel_travel", "tn_traveller_master", "tn_visit_area", "tc_codeb_코드B.parquet",
                    "tn_tour_photo"]
    assert C.cleanse(df, "tn_tour_photo") is None


def test_drop_null_rows_drops_nan(spark):
    df = spark.createDataFrame([(1.0, "a"), (float("nan"), "b"), (None, "c"), (2.0, None)], "X double, Y string")
    assert [r.Y for r in C.drop_null_rows(df).collect()] == ["a"]


def test_prune_keeps_intersection_or_skips(spark):
    df = spark.createDataFrame([(1, 2)], "TRAVEL_ID int, OTHER int")
    assert C.prune_columns(df, "tn_mvmn_consume").columns == ["TRAVEL_ID"]
    assert C.prune_columns(df.select("OTHER"), "tn_mvmn_consume") is None


def test_align_schema_by_name_ignoring_case(spark):
    df = spark.createDataFrame([("t1", "5", "x")], "travel_id string, Trip_Id string, extra string")
    out = L.align_schema(df, RAW_SCHEMAS["move"])
    assert out.columns == [f.name for f in RAW_SCHEMAS["move"].fields]
    r = out.collect()[0]
    assert (r.TRAVEL_ID, r.TRIP_ID, r.START_DT_YMD) == ("t1", 5, None)


def test_skip_bad_rows(spark):
    df = spark.createDataFrame([("a", "1"), ("b", "oops"), ("c", None)], "TRAVEL_ID string, TRIP_ID string")
    out = L.load_skip_bad_rows(df, RAW_SCHEMAS["move"])
    assert sorted(r.TRAVEL_ID for r in out.collect()) == ["a", "c"]


def test_split_datetime_naming():
    assert K._split_names("DT_MIN") == ("DT_YMD", "DT_MIN")
    assert K._split_names("PAYMENT_DT_MIN") == ("PAYMENT_YMD", "PAYMENT_DT_MIN")
    assert K._split_names("START_DT_MIN") == ("START_DT_YMD", "START_DT_MIN")
    assert K._split_names("CHK_IN_DT") == ("CHK_IN_DT_YMD", "CHK_IN_DT_MIN")
    assert K._split_names("CHK_IN_DT_MIN") == ("CHK_YMD", "CHK_IN_DT_MIN")
    assert K._split_names("CHK_OUT_DT") == ("CHK_OUT_DT_YMD", "CHK_OUT_DT_MIN")
    assert K._split_names("PAYMENT_DT") == ("PAYMENT_DT_YMD", "PAYMENT_DT_MIN")


def test_split_datetime_order_and_values(spark):
    df = spark.createDataFrame([("1", "2023-06-04 10:20:30", "bad")], "ID string, PAYMENT_DT string, END_DT string")
    out = K.split_datetime(df)
    assert out.columns == ["ID", "PAYMENT_DT", "END_DT", "PAYMENT_DT_YMD", "PAYMENT_DT_MIN",
                           "END_DT_YMD", "END_DT_MIN"]
    r = out.collect()[0]
    assert r.PAYMENT_DT_YMD == dt.date(2023, 6, 4) and r.PAYMENT_DT_MIN == "10:20:30"
    assert r.END_DT is None and r.END_DT_YMD is None


def test_split_date_range(spark):
    df = spark.createDataFrame([("2023-07-16~2023-07-18",), ("2023-07-16",), (None,)], "TRAVEL_STATUS_YMD string")
    rows = K.split_date_range(df).collect()
    assert [(r.TRAVEL_STATUS_START_YMD, r.TRAVEL_STATUS_END_YMD) for r in rows] == [
        ("2023-07-16", "2023-07-18"), ("2023-07-16", None), (None, None)]


def test_initial_calendar_has_74_weeks(spark):
    df = spark.createDataFrame([(dt.date(2022, 1, 2),), (dt.date(2023, 6, 3),)], "D date")
    cal = CAL.week_calendar(df, "D", "2022-01-02").orderBy("WEEK_NO").collect()
    assert len(cal) == 74
    assert cal[-1].WEEK_START == dt.date(2023, 5, 28) and cal[0].WEEK_KEY == "220102"


def test_week_cursor(spark):
    df = spark.createDataFrame([(dt.date(2023, 6, 17),)], "T date")
    r = df.select(*[c.alias(n) for n, c in CAL.week_cursor(F.col("T"), "2022-01-02").items()]).collect()[0]
    assert (r.START_DATE, r.END_DATE, r.NEXT_DATE) == (dt.date(2023, 6, 4), dt.date(2023, 6, 10),
                                                        dt.date(2023, 6, 24))


def test_typed_empty(spark):
    for name, schema in RAW_SCHEMAS.items():
        df = L.typed_empty(spark, name)
        assert df.schema == schema and df.count() == 0


def test_truncate_keeps_schema(spark):
    from tripwise.schemas import RAW_SCHEMAS as R
    from tripwise.session import scratch_path
    path = scratch_path(spark, "t-truncate") + "/travel"
    spark.createDataFrame([("1", "2", "2020-01-01", None, "x")], R["travel"]).write.parquet(path)
    out = L.truncate(spark, "travel", path)
    assert out.count() == 0 and out.schema == R["travel"]


def test_raw_sink_routing():
    from tripwise.sources.sinks import is_metadata_table, table_path
    assert is_metadata_table("tc_codea_코드A") and is_metadata_table("tn_traveller_master_여행객 Master")
    assert is_metadata_table("tn_activity_his_활동내역")
    assert not is_metadata_table("tn_activity_consume_his_활동소비내역")
    assert table_path("r", "tc_sgg") == "r/metadata/tc_sgg" and table_path("r", "travel") == "r/travel"


def test_region_key_symdiff_against_set_logic(spark):
    from itertools import combinations

    from tripwise.operators import quality as Q
    from tripwise.schemas import REGIONS
    rows = ([("hot", "capital")] * 50 + [("hot", "east")] * 5       # hot key in two regions
            + [("k1", "west"), ("k1", "west"), ("k2", "jeju"), ("k3", "mars"),
               (None, "capital"), ("k4", None)])
    df = spark.createDataFrame(rows, "TRAVEL_ID string, REGION string")
    order = lambda t: tuple("" if v is None else v for v in t)
    got = sorted((tuple(r) for r in Q.region_key_symdiff(df).collect()), key=order)
    held = {}
    for k, reg in rows:
        if reg in REGIONS:
            held.setdefault(k, set()).add(reg)
    want = list((a, b, k, a if a in s else b) for k, s in held.items()
                  for a, b in combinations(REGIONS, 2) if (a in s) != (b in s))
    assert got == sorted(want, key=order)


def test_bounded_broadcast_checks_rows_and_bytes(spark):
    from tripwise.operators.joins import bounded_broadcast, size_probe

    big = spark.range(5000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    small = spark.range(10).select(F.col("id").alias("k"), F.lit("abc").alias("name"))
    wide = spark.range(10).select(F.col("id").alias("k"), F.repeat(F.lit("x"), 1000).alias("name"))

    def strategy(side, **bounds):
        plan = big.join(bounded_broadcast(side, **bounds), "k")._jdf.queryExecution().executedPlan()
        return "BroadcastHashJoin" if "BroadcastHashJoin" in plan.toString() else "shuffle"

    assert size_probe(small, 100) == (10, 10 * (8 + 3))
    assert strategy(small) == "BroadcastHashJoin"
    assert strategy(small, max_rows=5) == "shuffle"              # row bound
    assert strategy(wide, max_bytes=4096) == "shuffle"           # byte bound
    assert strategy(wide, max_bytes=1 << 20) == "BroadcastHashJoin"


def test_cluster_conf_bounds_reducers_by_shuffle_and_cores():
    from tripwise.session import cluster_conf

    def reducers(shuffle_bytes, cores):
        return int(cluster_conf(shuffle_bytes, cores)["spark.sql.shuffle.partitions"])

    assert reducers(1 << 20, 100) == 200                      # small: two waves of cores
    assert reducers(1000 * (256 << 20), 100) == 400           # large: capped at four waves
    assert reducers(300 * (256 << 20), 100) == 300            # between: one per target size
    conf = cluster_conf(25 << 40, 8000)
    assert conf["spark.sql.adaptive.coalescePartitions.parallelismFirst"] == "false"
    assert int(conf["spark.sql.shuffle.partitions"]) == 32000


def test_file_name_filter_prunes_files_before_reading(spark):
    """A file excluded by its name (relative to the scan root) is never
    opened: a corrupt file there does not fail the read."""
    import os

    from tripwise.session import local_path, scratch_path
    from tripwise.sources.scan import relative_path

    root = scratch_path(spark, "t-prune")
    spark.range(100).write.parquet(f"{root}/keep")
    os.makedirs(local_path(f"{root}/poi_master"))
    with open(local_path(f"{root}/poi_master/part-00000-bad.parquet"), "wb") as fh:
        fh.write(b"not parquet" * 64)
    df = spark.read.schema("id bigint").option("recursiveFileLookup", "true").parquet(root)
    name = relative_path(spark, F.col("_metadata.file_path"), root)
    assert df.filter(~name.contains("poi")).count() == 100
