"""Nothing is lost or doubled without a word: weeks, scans, loads, bounds."""

import os

import pytest
from pyspark.sql import functions as F

from tripwise import fixtures as fx
from tripwise.operators import consolidate as K
from tripwise.operators import joins
from tripwise.operators.cleanse import is_reference_key, prune_columns
from tripwise.operators.slicing import week_slice
from tripwise.plans import pipeline as PL
from tripwise.schemas import ACTIVITY_LABELS, ISO_3166_2, PROVINCE_ALIASES, RAW_SCHEMAS, VALID_SGG_SUFFIXES
from tripwise.session import ensure_checkpoint_dir, local_path, scratch_path
from tripwise.sources import load as L
from tripwise.sources import scan as SC
from tripwise.sources import sinks as SK
from tripwise.streaming import incremental as INC

WEEK_1, WEEK_2 = "1998-06-07", "1998-06-14"


def landed(spark, sf_dir, root, week, keep=None):
    travel = fx.load(spark, sf_dir, "travel").filter(keep if keep is not None else F.lit(True))
    SK.write_weekly(travel.withColumn("week", F.lit(week)), f"{root}/raw", "travel")
    return travel.count()


def load(spark, root):
    return INC.load_once(spark, f"{root}/raw/travel", "travel", f"{root}/typed", f"{root}/ckpt")


def loaded(spark, root):
    return INC.read_loaded(spark, f"{root}/typed", RAW_SCHEMAS["travel"]).count()


def test_late_file_older_than_a_week_is_loaded(spark, sf_dir):
    root = scratch_path(spark, "t-late")
    n = landed(spark, sf_dir, root, WEEK_1)
    assert load(spark, root) == n
    landed(spark, sf_dir, root, WEEK_2)
    folder = local_path(f"{root}/raw/travel/week={WEEK_2}")
    for f in os.listdir(folder):
        old = os.stat(os.path.join(folder, f)).st_mtime - 30 * 86400
        os.utime(os.path.join(folder, f), (old, old))
    assert load(spark, root) == n and loaded(spark, root) == 2 * n


def test_rewritten_week_replaces_its_rows(spark, sf_dir):
    root = scratch_path(spark, "t-rewrite")
    n = landed(spark, sf_dir, root, WEEK_1)
    load(spark, root)
    landed(spark, sf_dir, root, WEEK_1)
    load(spark, root)
    assert loaded(spark, root) == n
    fewer = landed(spark, sf_dir, root, WEEK_1, F.col("TRAVEL_NM") == "1-URGENT")
    load(spark, root)
    assert loaded(spark, root) == fewer < n


def test_emptied_week_leaves_raw_zone_and_target(spark, sf_dir):
    root = scratch_path(spark, "t-empty")
    visit = fx.load(spark, sf_dir, "visit_area_info")
    args = (f"{root}/raw", f"{root}/p", f"{root}/ck", WEEK_1, WEEK_1, "1998-06-13")
    before = PL.run(spark, "reset", "visit_area_info", visit, *args).count()
    seeded = PL.run(spark, "incremental", "visit_area_info", visit.limit(0), *args).count()
    assert seeded < before and SK.list_weeks(spark, f"{root}/raw/visit_area_info") == []


def test_typed_week_append_empties_a_week(spark, sf_dir):
    root = scratch_path(spark, "t-append")
    n = landed(spark, sf_dir, root, WEEK_1)
    assert L.weekly_append(spark, f"{root}/raw", "travel", WEEK_1, f"{root}/typed").count() == n
    SK.write_weekly(fx.load(spark, sf_dir, "travel").limit(0).withColumn("week", F.lit(WEEK_1)), f"{root}/raw", "travel", replace_week=WEEK_1)
    landed(spark, sf_dir, root, WEEK_2)
    assert L.weekly_append(spark, f"{root}/raw", "travel", WEEK_1, f"{root}/typed").count() == 0


def test_columns_of_later_files_are_loaded(spark, sf_dir):
    root = scratch_path(spark, "t-drift")
    travel = fx.load(spark, sf_dir, "travel")
    SK.write_weekly(travel.drop("TRAVEL_END_YMD").withColumn("week", F.lit(WEEK_1)), f"{root}/raw", "travel")
    SK.write_weekly(travel.withColumn("week", F.lit(WEEK_2)), f"{root}/raw", "travel")
    n = travel.filter("TRAVEL_END_YMD IS NOT NULL").count()
    assert L.bulk_load(spark, f"{root}/raw", "travel", f"{root}/all").filter("TRAVEL_END_YMD IS NOT NULL").count() == n
    assert L.weekly_append(spark, f"{root}/raw", "travel", WEEK_2, f"{root}/typed").filter("TRAVEL_END_YMD IS NOT NULL").count() == n


def test_stream_tolerates_drifted_types(spark, sf_dir):
    root = scratch_path(spark, "t-types")
    travel = fx.load(spark, sf_dir, "travel")
    text = travel.select(*[F.col(c).cast("string").alias(c) for c in travel.columns])
    SK.write_weekly(text.withColumn("week", F.lit(WEEK_1)), f"{root}/raw", "travel")
    assert load(spark, root) == travel.count()
    back = INC.read_loaded(spark, f"{root}/typed", RAW_SCHEMAS["travel"])
    assert back.exceptAll(travel).count() == 0


def test_damaged_file_fails_the_scan(spark, sf_dir):
    root = scratch_path(spark, "t-damaged")
    fx.load(spark, sf_dir, "travel").write.parquet(f"{root}/travel")
    with open(local_path(f"{root}/travel/part-bad.parquet"), "wb") as f:
        f.write(b"not parquet" * 64)
    with pytest.raises(Exception):
        SC.scan_tables(spark, root, ["travel"])["travel"].count()
    assert SC.scan_prefix(spark, f"{root}/no_such") is None and SC.scan_tables(spark, root, ["no_such"]) == {}


def test_csv_columns_go_by_header(spark):
    root = scratch_path(spark, "t-header")
    spark.createDataFrame([("y", "2")], "NAME string, ID string").write.option("header", "true").csv(f"{root}/a")
    spark.createDataFrame([("3", "z")], "ID string, NAME string").write.option("header", "true").csv(f"{root}/b")
    spark.createDataFrame([("4", "q")], "ID string, NAME string").write.option("header", "true").csv(f"{root}/poi")
    schema = spark.createDataFrame([], "ID int, NAME string").schema
    assert sorted(tuple(r) for r in SC.scan_csv(spark, root, schema).select("ID", "NAME").collect()) == [(2, "y"), (3, "z")]


def test_csv_files_at_any_depth_are_read(spark):
    root = scratch_path(spark, "t-depth")
    schema = spark.createDataFrame([], "ID int, NAME string, PART string").schema
    scan = lambda: sorted((r.ID, r.NAME, r.PART) for r in SC.scan_csv(spark, root, schema).collect())
    assert scan() == []
    files = {"top [1].csv": "ID,NAME\n1,a\n", "top+2%20.csv": "ID,NAME\n2,b\n", "d/x.csv": "NAME,ID\nc,3\n", "d/below/y.csv": "ID,NAME\n4,d\n",
             "e/deep/deeper/z.csv": "ID\n5\n", "w/PART=01/p.csv": "ID,NAME\n6,f\n", "w/PART=02/p.csv": "ID,NAME\n7,g\n",
             "poi.csv": "X\n8\n", "d/my_poi/q.csv": "ID\n9\n", "old.zip": "zip", "_SUCCESS": "", ".hidden/h.csv": "ID\n10\n"}
    left_out = ("poi.csv", "d/my_poi/q.csv", "old.zip", "_SUCCESS", ".hidden/h.csv")
    for name in sorted(files, key=lambda n: n not in left_out):
        path = os.path.join(local_path(root), name)
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "w") as f:
            f.write(files[name])
        if name == left_out[0]:
            with pytest.raises(FileNotFoundError):
                scan()
    assert scan() == [(1, "a", None), (2, "b", None), (3, "c", None), (4, "d", None), (5, None, None), (6, "f", "01"), (7, "g", "02")]
    assert {r[0] for r in SC.scan_csv(spark, root, schema).select(SC.FILE_NAME).collect()} == {
        os.path.basename(n) for n in files if n not in left_out}


def test_region_tag_and_names_below_the_root(spark, sf_dir):
    root = scratch_path(spark, "t-region") + "/east/a+b"
    spark.range(3).write.parquet(f"{root}/capital/gps")
    df = spark.read.option("recursiveFileLookup", "true").parquet(root)
    path = F.col("_metadata.file_path")
    assert {r[0] for r in df.select(K.region_from_path(SC.relative_path(spark, SC.decoded(path), root))).collect()} == {"capital"}
    found = SC.with_source(df).select(SC.relative_path(spark, F.col(SC.FILE_PATH), "file:" + local_path(root)).alias("p")).first().p
    assert found.startswith("capital/gps/part-")


def test_broadcast_bound_is_proven_again_after_a_rewrite(spark):
    path = scratch_path(spark, "t-bound")

    def hinted(n):
        spark.range(n).write.mode("overwrite").parquet(path)
        spark.catalog.refreshByPath(path)
        plan = joins.bounded_broadcast(spark.read.parquet(path), max_rows=5)._jdf.queryExecution().analyzed().toString()
        return "broadcast" in plan.lower()

    assert hinted(1) and not hinted(1000)


def test_cluster_without_shared_folder_is_an_error(spark):
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        def __init__(self, master):
            self.master, self.dir = master, None

        def getConf(self):
            return Conf()

        def getCheckpointDir(self):
            return self.dir

        def setCheckpointDir(self, path):
            self.dir = path

    class Session:
        conf = Conf()

        def __init__(self, master):
            self.sparkContext = Context(master)

    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]"):
        with pytest.raises(RuntimeError):
            ensure_checkpoint_dir(Session(master))
    assert os.path.isdir(ensure_checkpoint_dir(Session("local[4]")))


def test_slices_are_typed(spark):
    rows = [("1998-06-09", "1998-06-08", "10:30", "x"), ("oops", "1998-06-08", None, "y")]
    df = spark.createDataFrame([(a, b, f"1998-06-09 {c}:00.123456" if c else "?", d) for a, b, c, d in rows],
                               "END_YMD string, START_YMD string, DT_MIN string, NAME string")
    got = week_slice(df, "t", WEEK_1, "1998-06-13")
    assert dict(got.dtypes) == {"END_YMD": "date", "START_YMD": "string", "DT_MIN": "timestamp_ntz", "NAME": "string"}
    assert [(str(r.END_YMD), r.DT_MIN.microsecond, r.NAME) for r in got.collect()] == [("1998-06-09", 123000, "x")]


def test_datetimes_lost_by_the_split_are_reported(spark):
    df = spark.createDataFrame([("1998-06-09 10:00:00", None), ("bad", "1998-01-01 00:00:00")], "PAY_DT string, START_DT_MIN string")
    assert {r.COLUMN_NAME: r.NOT_PARSED for r in K.unparsed_datetimes(df).collect()} == {"PAY_DT": 1, "START_DT_MIN": 0}


def test_reference_tables_bypass_the_keep_lists(spark):
    assert is_reference_key("tc_codeb") and not is_reference_key("tn_travel_travel")
    assert prune_columns(spark.createDataFrame([(1, 2)], "A int, B int"), "tn_travel_travel") is None


def test_fixed_values():
    """Constants against values written down here, not taken from the code."""
    aliases = dict(PROVINCE_ALIASES)
    assert "서울특별시" in aliases["서울"] and "세종특별자치시" in aliases["세종"] and "제주특별자치도" in aliases["제주"]
    assert ISO_3166_2["서울"] == "KR-11" and ISO_3166_2["부산"] == "KR-26" and ISO_3166_2["제주"] == "KR-49"
    assert set(VALID_SGG_SUFFIXES) == {"시", "군", "구"}
    assert len(ISO_3166_2) == 17 and len(ACTIVITY_LABELS) > 3
