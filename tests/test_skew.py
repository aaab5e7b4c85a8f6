"""A key holding a third of all rows: results stay whole and the shuffled
join is split by adaptive skew handling instead of landing in one task."""

from datetime import date
from decimal import Decimal

from pyspark.sql import functions as F

from tripwise import fixtures as fx
from tripwise.operators import quality as Q
from tripwise.plans import marts as M
from tripwise.plans import processed as P

SKEW_CONF = {
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


def _with_conf(spark, conf):
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    return old


def _restore(spark, old):
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def _hot(df, col="TRAVEL_ID", hot="1"):
    """Reassign every third row to one hot key.  The rows are spread over 8
    map tasks first: skew handling splits a hot reducer partition along
    map-output boundaries, and a real input has many map tasks (the test
    file is a single row group, i.e. one)."""
    spread = df.repartition(8)
    return spread.withColumn(col, F.when(F.hash(*df.columns) % 3 == 0, F.lit(hot)).otherwise(F.col(col)))


def test_hot_travel_id(spark):
    sf = "/root/testdata/sf0.01"
    travel = fx.load(spark, sf, "travel")
    mvmn = _hot(fx.load(spark, sf, "mvmn_consume"))
    visit = _hot(P.normalize_table(fx.load(spark, sf, "visit_area_info"), "visit_area_info"))
    hot_rows = mvmn.filter(F.col("TRAVEL_ID") == "1").count()
    assert hot_rows * 4 > mvmn.count()          # roughly a third

    old = _with_conf(spark, SKEW_CONF)
    try:
        joined = M.mvmn_price(mvmn, travel)
        rows = len(joined.collect())        # runs this DataFrame's own adaptive plan
        plan = joined._jdf.queryExecution().executedPlan().toString()
        visits = {(r.SIDO, r.REGION): r.VISIT_COUNT for r in P.region_visit(travel, visit).collect()}
        missing = Q.missing_ids(travel, mvmn).count()
    finally:
        _restore(spark, old)

    expect_rows = mvmn.join(travel.select("TRAVEL_ID"), "TRAVEL_ID").count()
    assert rows == expect_rows
    assert "isSkewJoin=true" in plan or "skew=true" in plan.lower(), plan[:2000]
    # Same answers as a plain recomputation without the adaptive settings.
    plain = {(r.SIDO, r.REGION): r.VISIT_COUNT for r in P.region_visit(travel, visit).collect()}
    assert visits == plain
    ids = travel.select("TRAVEL_ID").distinct().subtract(mvmn.select("TRAVEL_ID").distinct()).count()
    assert missing == ids


def test_activity_totals_with_key_hot_on_both_sides(spark):
    """One (travel, place) holds most visit rows and most payments: the
    totals equal the brute-force sum over all (visit, payment) pairs, and
    the join sees at most one payment row per activity name for that key."""
    visits = ([("1", 7, "서울 중구", "서울", "중구")] * 40 + [("1", 7, "부산 남구", "부산", "남구")] * 10
              + [("2", 8, "서울 중구", "서울", "중구")])
    pays = ([("1", 7, 1, 100.0)] * 60 + [("1", 7, 1, None)] * 5 + [("1", 7, 2, 7.0)] * 30
            + [("2", 8, 2, 3.0), ("2", 9, 1, 1.0)])
    visit_p = spark.createDataFrame(
        visits, "TRAVEL_ID string, VISIT_AREA_ID bigint, SIDO_SGG string, SIDO string, SGG string")
    activity = spark.createDataFrame(
        pays, "TRAVEL_ID string, VISIT_AREA_ID bigint, ACTIVITY_TYPE_CD bigint, PAYMENT_AMT_WON double")
    codes = spark.createDataFrame([("ACT", "1", "walk"), ("ACT", "2", "meal"), ("JOB", "1", "x")],
                                  "CD_A string, CD_B string, CD_NM string")
    got = {(r.REGION, r.ACTIVITY_TYPE): (r.ACTIVITY_COUNT, r.TOTAL_CONSUMPTION, r.TOTAL_PAYMENT_COUNT)
           for r in M.activity_by_region(visit_p, activity, codes).collect()}
    names = {1: "walk", 2: "meal"}
    want = {}
    for tv, pv, region, _, _ in visits:
        for ta, pa, code, amt in pays:
            if (tv, pv) == (ta, pa):
                n, s, k = want.get((region, names[code]), (0, None, 0))
                s = s if amt is None else (amt if s is None else s + amt)
                want[(region, names[code])] = (n + 1, s, k + (amt is not None))
    assert got == want
    assert sum(v[0] for v in want.values()) > len(visits) + len(pays)   # pairs, not rows


def test_fractional_sums_do_not_depend_on_row_order(spark):
    """Amounts whose double sums differ by order: every order and number of
    partitions gives the exact total, cast once."""
    amounts = [0.1, 1e12, -1e12 + 0.7, 0.2, 3.3, 1e9 + 0.05, 0.3] * 40 + [None]
    total = float(sum(Decimal(repr(a)) for a in amounts if a is not None))
    assert sum(a for a in amounts if a is not None) != total
    schema = "TRAVEL_ID string, VISIT_AREA_ID bigint, ACTIVITY_TYPE_CD bigint, PAYMENT_AMT_WON double, PAYMENT_DT_YMD date"
    day = date(2023, 1, 4)
    codes = spark.createDataFrame([("ACT", "1", "walk")], "CD_A string, CD_B string, CD_NM string")
    visit_p = spark.createDataFrame([("1", k, "서울 중구", "서울", "중구") for k in range(7)],
                                    "TRAVEL_ID string, VISIT_AREA_ID bigint, SIDO_SGG string, SIDO string, SGG string")
    none = spark.createDataFrame([], schema)
    for turn, parts in ((0, 1), (1, 3), (2, 8)):
        rows = [("1", k % 7, 1, a, day) for k, a in enumerate(amounts)]
        rows = [rows, rows[::-1], sorted(rows, key=lambda r: r[3] or 0)][turn]
        paid = spark.createDataFrame(rows, schema).repartition(parts)
        [region] = M.activity_by_region(visit_p, paid, codes).collect()
        assert (region.ACTIVITY_COUNT, region.TOTAL_CONSUMPTION, region.TOTAL_PAYMENT_COUNT) == (281, total, 280)
        [week] = M.weekly_spending(none, none.select("PAYMENT_AMT_WON", "PAYMENT_DT_YMD"), paid).collect()
        assert (week.CATEGORY, week.TOTAL_SPENDING, week.SPENDING_SHARE) == ("ACTIVITY", total, 1.0)


def test_job_frequency_with_repeated_and_hot_traveller(spark):
    """A traveller listed many times in the master table and owning most
    travels: the distinct travel count per job equals a brute-force count."""
    master = [("t1", 1.0)] * 30 + [("t1", 2.0)] * 3 + [("t2", 1.0), ("t3", None), ("t4", 7.0)]
    travels = [("t1", f"v{i}") for i in range(200)] + [("t1", "v0")] * 20 + [("t2", "w1"), ("t4", "z1")]
    traveller = spark.createDataFrame(master, "TRAVELER_ID string, JOB_NM double")
    travel = spark.createDataFrame(travels, "TRAVELER_ID string, TRAVEL_ID string")
    codes = spark.createDataFrame([("JOB", "1", "farmer"), ("JOB", "2", "clerk"), ("JOB", "x", "bad"),
                                   ("ACT", "7", "walk")], "CD_A string, CD_B string, CD_NM string")
    got = {r.JOB_NAME: r.TRAVEL_FREQUENCY for r in M.job_distribution(traveller, travel, codes).collect()}
    names = {1.0: "farmer", 2.0: "clerk"}
    want = {}
    for who, job in master:
        if job in names:
            want.setdefault(names[job], set()).update(t for w, t in travels if w == who)
    assert got == {k: len(v) for k, v in want.items()}


def test_hot_week_is_written_as_several_files(spark, sf_dir):
    """Most rows fall into one week: the weekly sink splits that week over
    several write tasks (files), keeps each small week in one file instead
    of one file per input task, and keeps every row once."""
    import glob
    import os

    from tripwise.session import local_path, scratch_path
    from tripwise.sources import sinks as SK

    lines = fx.load(spark, sf_dir, "visit_area_info").repartition(8)
    small = F.concat(F.lit("1998-0"), (F.col("VISIT_AREA_ID") % 5 + 1).cast("string"), F.lit("-01"))
    weekly = lines.withColumn("week", F.when(F.hash(*lines.columns) % 4 != 0, F.lit("1998-06-07"))
                              .otherwise(small))
    root = scratch_path(spark, "t-hot-week")
    old = _with_conf(spark, {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
                             "spark.sql.adaptive.coalescePartitions.enabled": "true"})
    try:
        path = SK.write_weekly(weekly, root, "visit_area_info")
    finally:
        _restore(spark, old)

    def files(week):
        return glob.glob(os.path.join(local_path(path), f"week={week}", "*.parquet"))

    assert len(files("1998-06-07")) > 1
    # a plain partitioned write gives every week one file per input task (8 here);
    # clustered by week, small weeks stay whole (one may share the hot week's
    # hash partition and be split along with it)
    small_files = [len(files(f"1998-0{i}-01")) for i in range(1, 6)]
    assert sum(n == 1 for n in small_files) >= 3, small_files
    assert len(files("1998-06-07")) + sum(small_files) < 8 * 6 // 2, small_files
    back = spark.read.parquet(path)
    assert back.count() == weekly.count()
    assert back.filter(F.col("week") == "1998-06-07").count() == weekly.filter(F.col("week") == "1998-06-07").count()
