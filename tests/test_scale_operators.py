"""Reset inside a week, whole-row identity, fan-out joins, profile states."""

import datetime as dt
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tripwise.operators import fanout as FO
from tripwise.operators import identity as ID
from tripwise.operators import profile as PF
from tripwise.session import scratch_path
from tripwise.sources import sinks as SK


def dated(spark, days):
    rows = [(k, dt.date(2020, 1, d) if d else None, f"2020-01-{5 + 7 * ((d - 5) // 7):02d}" if d else "2020-01-05") for k, d in enumerate(days)]
    return spark.createDataFrame(rows, "id long, day date, week string")


@pytest.mark.parametrize("cutoff, kept", [("2020-01-15", [5, 11, 12, 14]), ("2020-01-12", [5, 11]), ("2020-01-01", []), ("2020-02-20", [5, 11, 12, 14, 15, 18, 19, 25])])
def test_reset_to_date(spark, cutoff, kept):
    root = scratch_path(spark, "reset-test")
    df = dated(spark, [5, 11, 12, 14, 15, 18, 19, 25])
    path = SK.write_weekly(df, root, "moves")
    untouched = {f for f in spark.read.parquet(path).inputFiles() if "week=2020-01-05" in f}
    for _ in range(2):
        SK.reset_to_date(spark, path, "day", cutoff, df.drop("week").schema)
    weeks = SK.list_weeks(spark, path)
    left = spark.read.schema(df.schema).parquet(path) if weeks else df.limit(0)
    assert sorted(r.day.day for r in left.collect()) == kept
    if cutoff == "2020-01-15":
        assert untouched <= set(left.inputFiles())  # a whole week before is not rewritten


def test_reset_that_died_is_repaired(spark):
    root = scratch_path(spark, "reset-test")
    df = dated(spark, [5, 6, 12])
    path = SK.write_weekly(df, root, "moves")
    fs, _, jvm = SK.file_system(spark, path)
    at = lambda name: jvm.org.apache.hadoop.fs.Path(f"{path}/{name}")
    assert fs.rename(at("week=2020-01-05"), at(".replaced-week=2020-01-05"))
    SK.reset_to_date(spark, path, "day", "2020-01-06", df.drop("week").schema)
    assert [r.day.day for r in spark.read.schema(df.schema).parquet(path).collect()] == [5]


ROWS = [(1, "a", None), (1, "a", None), (1, None, "a"), (None, "a", None), (None, None, None), (None, None, None), (2, "b" * 100_000, "c"), (2, "b" * 100_000, "c")]


def test_distinct_rows(spark):
    df = spark.createDataFrame(ROWS * 3 + [(k, "x", "y") for k in range(500)], "n long, s string, t string")
    assert Counter(map(tuple, ID.distinct_rows(df).collect())) == Counter(map(tuple, df.distinct().collect()))
    assert ID.distinct_rows(df.limit(0)).collect() == []


def test_colliding_rows_both_stay(spark, monkeypatch):
    monkeypatch.setattr(ID, "fingerprints", lambda columns: [F.lit(1).cast("long").alias(ID.HIGH), F.lit(1).cast("long").alias(ID.LOW)])
    df = spark.createDataFrame(ROWS, "n long, s string, t string")
    assert Counter(map(tuple, ID.distinct_rows(df).collect())) == Counter(map(tuple, df.distinct().collect()))


def test_fingerprints_are_all_that_is_exchanged(spark):
    df = spark.createDataFrame(ROWS, "n long, s string, t string")
    plan = ID.repeated(df.repartition(2))._jdf.queryExecution().executedPlan().toString()
    assert f"hashpartitioning({ID.HIGH}" in plan
    fields = ID.repeated(df).schema.fields
    assert {f.name for f in fields} == {ID.HIGH, ID.LOW, ID.COUNT} and {f.dataType.simpleString() for f in fields} == {"bigint"}


@pytest.mark.parametrize("cell_pairs", [1_000_000, 50])
def test_fan_out_join(spark, cell_pairs):
    """A key that a third of both sides share, repeats, and null keys."""
    left = [("hot", k % 40) for k in range(100)] + [(f"k{k}", k) for k in range(200)] + [(None, 1)]
    right = [("hot", -(k % 30)) for k in range(60)] + [(f"k{k % 150}", -k) for k in range(200)] + [(None, 2)]
    a, b = spark.createDataFrame(left, "k string, x long"), spark.createDataFrame(right, "k string, y long")
    got = FO.fan_out_join(a, b, ["k"], cell_pairs)
    want = Counter((k, x, y) for k, x in left for j, y in right if k == j and k is not None)
    assert Counter((r.k, r.x, r.y) for r in got.collect()) == want
    counted = {r.k: r.joined_rows for r in FO.fan_out(a, b, ["k"]).collect()}
    assert counted["hot"] == 6000 and sum(counted.values()) == sum(want.values())


def test_hot_key_is_spread(spark):
    a = spark.range(2000).select(F.lit("hot").alias("k"), F.col("id").alias("x"))
    b = spark.range(200).select(F.lit("hot").alias("k"), F.col("id").alias("y"))
    got = FO.fan_out_join(a, b, ["k"], 10_000)
    blocks = got.select(F.pmod(F.xxhash64("k", "x"), F.lit(40)).alias("block")).groupBy("block").count().collect()
    assert len(blocks) == 40 and max(r["count"] for r in blocks) < 2 * min(r["count"] for r in blocks)


def test_profiles_merge(spark):
    rows = [("w1", 1, "5", 2.5), ("w1", None, "x", -1.0), ("w2", 9, None, None), (None, 3, "1e3", 0.0)]
    df = spark.createDataFrame(rows, "week string, n long, s string, d double")
    whole = {tuple(r) for r in PF.merged(PF.states(df), ["n", "s", "d"]).collect()}
    apart = PF.states(df.filter("week = 'w1'")).unionByName(PF.states(df.filter("week IS DISTINCT FROM 'w1'")))
    assert whole == {tuple(r) for r in PF.merged(apart, ["n", "s", "d"]).collect()} == {
        ("n", 4, 1, 3, "1", "9"), ("s", 4, 1, 2, "1e3", "x"), ("d", 4, 1, 3, "-1.000000", "2.500000")}
    plan = PF.states(df)._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan
    empty = PF.merged(PF.states(df.limit(0)), ["n"]).collect()
    assert [tuple(r) for r in empty] == [("n", 0, 0, 0, None, None)]
