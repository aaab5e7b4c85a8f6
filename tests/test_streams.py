"""Insert-only change capture: exactly-once loads and incremental == full."""

from pyspark.sql import functions as F

from tripwise import fixtures as fx
from tripwise.plans import processed as P
from tripwise.schemas import PROCESSED_SCHEMAS, RAW_SCHEMAS
from tripwise.session import scratch_path
from tripwise.sources import sinks as SK
from tripwise.streaming import incremental as INC
from tripwise.operators.slicing import with_week


def test_load_once_and_week_rewrite(spark, sf_dir):
    root = scratch_path(spark, "t-once")
    travel = fx.load(spark, sf_dir, "travel")
    weekly = with_week(travel, "1995-01-01")
    SK.write_weekly(weekly, f"{root}/raw", "travel")
    n1 = INC.load_once(spark, f"{root}/raw/travel", "travel", f"{root}/typed", f"{root}/ckpt")
    n2 = INC.load_once(spark, f"{root}/raw/travel", "travel", f"{root}/typed", f"{root}/ckpt")
    assert n1 == travel.count() and n2 == 0
    loaded = INC.read_loaded(spark, f"{root}/typed", RAW_SCHEMAS["travel"])
    assert loaded.count() == travel.count()


def test_incremental_equals_full(spark, sf_dir):
    root = scratch_path(spark, "t-incr")
    raw = fx.load(spark, sf_dir, "visit_area_info")
    cutoff = "1998-06-07"
    from tripwise.plans.pipeline import seed
    seed(raw, "visit_area_info", cutoff, f"{root}/p")
    later = with_week(raw.filter(F.col("VISIT_END_YMD") >= F.to_date(F.lit(cutoff))), "1998-01-04")
    weeks = [r.week for r in later.select("week").distinct().orderBy("week").limit(3).collect()]
    for w in weeks:            # three weekly increments, one stream run each
        SK.write_weekly(later.filter(F.col("week") == w), f"{root}/raw", "visit_area_info")
        INC.append_week_changes(spark, f"{root}/raw/visit_area_info", "visit_area_info", f"{root}/p",
                                f"{root}/ck", since_week=cutoff)
    SK.write_weekly(later.filter(~F.col("week").isin(*weeks)), f"{root}/raw", "visit_area_info")
    INC.append_week_changes(spark, f"{root}/raw/visit_area_info", "visit_area_info", f"{root}/p",
                            f"{root}/ck", since_week=cutoff)
    inc = INC.read_loaded(spark, f"{root}/p", PROCESSED_SCHEMAS["visit_area_info"])
    full = P.normalize_table(raw, "visit_area_info")
    assert inc.exceptAll(full).count() == 0 and full.exceptAll(inc).count() == 0


def test_replayed_epoch_after_lost_commit_writes_rows_once(spark, sf_dir):
    """The job dies after the sink wrote a micro-batch but before the
    checkpoint recorded it: the next run replays that epoch, and its
    partition is replaced instead of appended to."""
    import os

    from tripwise.session import local_path
    root = scratch_path(spark, "t-replay")
    travel = fx.load(spark, sf_dir, "travel")
    SK.write_weekly(with_week(travel, "1995-01-01"), f"{root}/raw", "travel")
    ckpt = f"{root}/ckpt"
    n1 = INC.load_once(spark, f"{root}/raw/travel", "travel", f"{root}/typed", ckpt)
    commits = local_path(f"{ckpt}/commits")
    last = max((f for f in os.listdir(commits) if f.isdigit()), key=int)
    os.remove(os.path.join(commits, last))              # the commit never happened
    crc = os.path.join(commits, f".{last}.crc")
    if os.path.exists(crc):
        os.remove(crc)
    n2 = INC.load_once(spark, f"{root}/raw/travel", "travel", f"{root}/typed", ckpt)
    loaded = INC.read_loaded(spark, f"{root}/typed", RAW_SCHEMAS["travel"])
    assert n1 == travel.count() and n2 == n1           # the epoch was replayed in full
    assert loaded.count() == travel.count()              # ...and its rows are there once
    assert loaded.exceptAll(travel).count() == 0
