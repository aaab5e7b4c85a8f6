"""Steps whose time or memory must not grow faster than their input."""

import pytest

from tripwise.plans import catalog_ops as CO
from tripwise.plans import catalog_tables as CT
from tripwise.plans import catalog_weekly as CW
from tripwise.plans import partials as PT
from tripwise.plans import weekly_run as WR
from tripwise.plans.catalog import QUERIES, Tables
from tripwise.schemas import CUTOFF_COLUMN, RAW_SCHEMAS
from tripwise.session import scratch_path
from tripwise.sources import sinks as SK


def test_source_names_are_worked_out_per_file(spark, sf_dir):
    names = CO._source_listing(spark, sf_dir, "_combine")
    files = names.count()
    assert files < 500 < names.agg({"ROWS": "sum"}).first()[0]
    assert all("-files/" in f for f in names.inputFiles())


@pytest.mark.parametrize("name", ["canonical_name", "skip_unused_tables", "resolve_table"])
def test_names_are_not_pushed_below_the_count_of_rows(spark, sf_dir, name):
    assert all("-files/" in f for f in QUERIES[name](spark, sf_dir).inputFiles())


def test_partials_share_the_activity_join(spark, sf_dir, monkeypatch):
    made = []
    marts = PT.marts
    monkeypatch.setattr(CW.PT, "marts", lambda *a: made.append(marts(*a)) or made[-1])
    QUERIES["mart_partials_refresh"](spark, sf_dir)
    for name in ("region_activity_distribution", "region_activity_consumption"):
        assert made[0][name].inputFiles() and not [f for f in made[0][name].inputFiles() if "/states/" in f]


def test_tables_are_seeded_and_loaded_side_by_side(spark, sf_dir, monkeypatch):
    ran = []
    together = WR.together
    monkeypatch.setattr(WR, "together", lambda jobs, *a: ran.append(len(jobs)) or together(jobs, *a))
    monkeypatch.setattr(CT, "together", lambda jobs, *a: ran.append(len(jobs)) or together(jobs, *a))
    t = Tables(spark, sf_dir)
    WR.seed_zone({n: t.raw(n).limit(50) for n in CUTOFF_COLUMN}, scratch_path(spark, "seed"), CW.batch_of, "1998-06-07")
    assert ran == [len(CUTOFF_COLUMN)]
    QUERIES["bulk_load_all"](spark, sf_dir)
    assert ran[1:] == [len(RAW_SCHEMAS)]


def test_a_job_that_fails_beside_others_raises():
    with pytest.raises(ZeroDivisionError):
        CW.W.together([lambda: 1, lambda: 1 // 0])


def test_buckets_grow_with_the_largest_table(spark):
    cores = spark.sparkContext.defaultParallelism
    assert SK.bucket_count(spark, 0, 5) == cores
    assert SK.bucket_count(spark, 10, 3_000, bucket_rows=100) == max(30, cores)
    assert SK.bucket_count(spark, 6_001, 10, bucket_rows=100) == max(61, cores)
