"""Plan shapes the scale design relies on, checked on the physical plans so a
later change cannot silently add a shuffle, a pair-emitting join or a wide
scan."""

import re

import pytest

import __spark_entry__ as entry
from bench import HEADLINE

QUERIES = entry.queries()
VISIT_SOURCE = ["l_linenumber", "l_orderkey", "l_partkey", "l_suppkey"]


def _plan(spark, sf_dir, name) -> str:
    df = QUERIES[name](spark, sf_dir)
    return df._jdf.queryExecution().executedPlan().toString()


def _read_schemas(plan: str) -> list[str]:
    return re.findall(r"ReadSchema: struct<([^>]*)>", plan)


@pytest.mark.parametrize("name", HEADLINE)
def test_no_pairwise_or_nested_loop_join(spark, sf_dir, name):
    plan = _plan(spark, sf_dir, name)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, plan


@pytest.mark.parametrize("name", ["processed_visit", "processed_lodge", "mart_spatial"])
def test_row_level_tables_are_map_only(spark, sf_dir, name):
    plan = _plan(spark, sf_dir, name)
    assert "Exchange" not in plan, plan


def test_scans_read_only_needed_columns(spark, sf_dir):
    plan = _plan(spark, sf_dir, "mart_satisfaction")
    schemas = _read_schemas(plan)
    # Exactly the columns that the address, the satisfaction scores and the
    # row filter of the visits are made from.
    assert schemas and all(sorted(c.split(":")[0] for c in s.split(",")) == VISIT_SOURCE for s in schemas), schemas


def test_symdiff_is_one_fixed_width_shuffle(spark, sf_dir):
    plan = _plan(spark, sf_dir, "region_key_symdiff")
    assert plan.count("Exchange hashpartitioning") == 1, plan
    assert "ObjectHashAggregate" not in plan and "SortAggregate" not in plan, plan


def test_activity_marts_collapse_payments_before_the_join(spark, sf_dir):
    plan = _plan(spark, sf_dir, "mart_activity_distribution")
    # only the size-checked code table is broadcast
    assert plan.count("BroadcastExchange") == 1, plan
    join = plan.index("SortMergeJoin")
    # the payment side aggregates (partial + final) below the join
    assert plan.count("HashAggregate", join) >= 2, plan


def test_region_visit_dedups_before_the_existence_join(spark, sf_dir):
    plan = _plan(spark, sf_dir, "mart_region_visit")
    assert "LeftSemi" in plan, plan
    join = plan.index("LeftSemi")
    assert plan.count("HashAggregate", join) >= 4, plan   # triples and travel ids, partial + final


def test_bucketed_layout_joins_without_shuffling_either_side(spark, sf_dir):
    plan = _plan(spark, sf_dir, "bucketed_region_visit")
    join = plan.index("LeftSemi")
    assert "Exchange" not in plan[join:], plan


@pytest.mark.parametrize("name", ["profile_nulls", "profile_date_range", "profile_value_types"])
def test_profiles_read_their_table_once(spark, sf_dir, name):
    plan = _plan(spark, sf_dir, name)
    assert len(re.findall(r"FileScan parquet|Scan parquet", plan)) == 1, plan
