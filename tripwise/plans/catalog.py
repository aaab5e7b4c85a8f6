"""Registry of named queries: Spark builder + oracle SQL (when expressible).

Every query reads the driver tables under ``sf_dir`` (through the fixture
rules) so its work grows with the data.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from .. import fixtures as fx
from . import marts as M
from . import oracle as O
from . import processed as P

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn
    return deco


class Tables:
    """Lazily built travel tables for one (session, data folder)."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._raw: dict[str, DataFrame] = {}

    def raw(self, name: str) -> DataFrame:
        if name not in self._raw:
            self._raw[name] = fx.load(self.spark, self.sf_dir, name)
        return self._raw[name]

    @cached_property
    def processed_visit(self) -> DataFrame:
        return P.normalize_table(self.raw("visit_area_info"), "visit_area_info")

    @cached_property
    def processed_lodge(self) -> DataFrame:
        return P.normalize_table(self.raw("lodge_consume"), "lodge_consume")

    @cached_property
    def codes(self) -> DataFrame:
        return P.codeb_capital(self.raw("meta_codeb"))


def _t(spark, sf_dir) -> Tables:
    return Tables(spark, sf_dir)


# --------------------------------------------------------------------------
# Processed zone and marts
# --------------------------------------------------------------------------
@register("processed_visit", O.MARTS["processed_visit"])
def q_processed_visit(spark, sf_dir):
    return _t(spark, sf_dir).processed_visit


@register("processed_lodge", O.MARTS["processed_lodge"])
def q_processed_lodge(spark, sf_dir):
    return _t(spark, sf_dir).processed_lodge


@register("mart_travel_stats", O.MARTS["mart_travel_stats"])
def q_travel_stats(spark, sf_dir):
    return M.travel_stats(_t(spark, sf_dir).raw("travel"))


@register("mart_gender_age", O.MARTS["mart_gender_age"])
def q_gender_age(spark, sf_dir):
    return M.gender_age(_t(spark, sf_dir).raw("traveller_master"))


@register("mart_job_distribution", O.MARTS["mart_job_distribution"])
def q_job_distribution(spark, sf_dir):
    t = _t(spark, sf_dir)
    return M.job_distribution(t.raw("traveller_master"), t.raw("travel"), t.codes)


@register("mart_region_visit", O.MARTS["mart_region_visit"])
def q_region_visit(spark, sf_dir):
    t = _t(spark, sf_dir)
    return P.region_visit(t.raw("travel"), t.processed_visit)


@register("mart_visit_map", O.MARTS["mart_visit_map"])
def q_visit_map(spark, sf_dir):
    t = _t(spark, sf_dir)
    return M.visit_map(P.region_visit(t.raw("travel"), t.processed_visit))


@register("mart_mvmn_price", O.MARTS["mart_mvmn_price"])
def q_mvmn_price(spark, sf_dir):
    t = _t(spark, sf_dir)
    return M.mvmn_price(t.raw("mvmn_consume"), t.raw("travel"))


@register("mart_activity_distribution", O.MARTS["mart_activity_distribution"])
def q_activity_distribution(spark, sf_dir):
    t = _t(spark, sf_dir)
    return M.activity_distribution(
        M.activity_by_region(t.processed_visit, t.raw("activity_consume"), t.codes))


@register("mart_activity_consumption", O.MARTS["mart_activity_consumption"])
def q_activity_consumption(spark, sf_dir):
    t = _t(spark, sf_dir)
    return M.activity_consumption(
        M.activity_by_region(t.processed_visit, t.raw("activity_consume"), t.codes))


@register("mart_consume_by_area", O.MARTS["mart_consume_by_area"])
def q_consume_by_area(spark, sf_dir):
    t = _t(spark, sf_dir)
    return M.consume_by_area(t.raw("activity_consume"), t.processed_visit)


@register("mart_lodging_cost", O.MARTS["mart_lodging_cost"])
def q_lodging_cost(spark, sf_dir):
    t = _t(spark, sf_dir)
    return M.lodging_cost(t.processed_lodge, t.codes)


@register("mart_weekly_spending", O.MARTS["mart_weekly_spending"])
def q_weekly_spending(spark, sf_dir):
    t = _t(spark, sf_dir)
    return M.weekly_spending(t.raw("mvmn_consume"), t.raw("lodge_consume"), t.raw("activity_consume"))


@register("mart_visit_count", O.MARTS["mart_visit_count"])
def q_visit_count(spark, sf_dir):
    t = _t(spark, sf_dir)
    return M.visit_count(t.raw("travel"), t.processed_visit)


@register("mart_satisfaction", O.MARTS["mart_satisfaction"])
def q_satisfaction(spark, sf_dir):
    return M.satisfaction(_t(spark, sf_dir).processed_visit)


@register("mart_spatial", O.MARTS["mart_spatial"])
def q_spatial(spark, sf_dir):
    return M.spatial(_t(spark, sf_dir).processed_visit)


@register("spatial_highlight", O.MARTS["spatial_highlight"])
def q_spatial_highlight(spark, sf_dir):
    return M.spatial_highlight(M.spatial(_t(spark, sf_dir).processed_visit))
