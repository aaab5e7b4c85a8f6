"""Additive marts from stored weekly partial aggregates.

For each source table a state folder holds one partition per week with that
week's sums and counts by group.  A week that lands again replaces its own
partition, a week that is dropped loses it, and a mart merges the states of all
weeks.  So a weekly refresh reads one week of rows, however long the history.

Sums are kept as decimals, so they do not depend on the order of rows or on
how weeks are cut.  The lookup of code labels happens when states are merged:
a changed code table needs no state rebuilt.

The activity marts join visits and payments that may lie in different weeks.
Their states are the two sides by join key, and the merged sides are joined.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.coerce import exact_sum
from ..operators.joins import bounded_broadcast
from ..schemas import CODE_ACTIVITY, CODE_LODGING
from ..sources.sinks import WEEK, list_weeks
from ..streaming.incremental import drop_weeks, weeks_with_rows
from .marts import _numeric_codes
from .processed import code_lookup
from .weekly import materialize

@dataclass(frozen=True)
class Partial:
    """A state: its source table, group columns and sums."""

    source: str
    keys: tuple[str, ...]
    build: Callable[[DataFrame], DataFrame]
    sums: tuple[str, ...]

    def of(self, rows: DataFrame) -> DataFrame:
        """The state rows of ``rows`` (with their week)."""
        return self.build(rows)

    def merged(self, states: DataFrame) -> DataFrame:
        """One row per group over all weeks."""
        return states.groupBy(*self.keys).agg(*[F.sum(c).alias(c) for c in self.sums])


def _lodging(rows: DataFrame) -> DataFrame:
    paid = rows.filter(F.col("LODGING_TYPE_CD").isNotNull() & F.col("PAYMENT_AMT_WON").isNotNull())
    return (paid.groupBy(WEEK, "SIDO", "SGG", F.col("SIDO_SGG").alias("REGION"), "LODGING_TYPE_CD")
            .agg(F.count(F.lit(1)).alias("N"), exact_sum("PAYMENT_AMT_WON").alias("AMOUNT")))


def _satisfaction(rows: DataFrame) -> DataFrame:
    rated = rows.filter(F.col("DGSTFN").isNotNull() & F.col("REVISIT_INTENTION").isNotNull())
    return (rated.groupBy(WEEK, "SIDO", "SGG", F.col("SIDO_SGG").alias("REGION"))
            .agg(F.count(F.lit(1)).alias("N"), exact_sum("DGSTFN").alias("SATISFACTION"), exact_sum("REVISIT_INTENTION").alias("INTENTION")))


def _visits(rows: DataFrame) -> DataFrame:
    return (rows.filter(F.col("SIDO").isNotNull() & F.col("TRAVEL_ID").isNotNull() & F.col("VISIT_AREA_ID").isNotNull())
            .groupBy(WEEK, "TRAVEL_ID", "VISIT_AREA_ID", "SIDO", "SGG", F.col("SIDO_SGG").alias("REGION"))
            .agg(F.count(F.lit(1)).alias("VISITS")))


def _payments(rows: DataFrame) -> DataFrame:
    return (rows.filter(F.col("ACTIVITY_TYPE_CD").isNotNull() & F.col("TRAVEL_ID").isNotNull() & F.col("VISIT_AREA_ID").isNotNull())
            .groupBy(WEEK, "TRAVEL_ID", "VISIT_AREA_ID", "ACTIVITY_TYPE_CD")
            .agg(F.count(F.lit(1)).alias("N"), exact_sum("PAYMENT_AMT_WON").alias("AMOUNT"), F.count("PAYMENT_AMT_WON").alias("N_PAID")))


PARTIALS = {
    "lodging": Partial("lodge_consume", ("SIDO", "SGG", "REGION", "LODGING_TYPE_CD"), _lodging, ("N", "AMOUNT")),
    "satisfaction": Partial("visit_area_info", ("SIDO", "SGG", "REGION"), _satisfaction, ("N", "SATISFACTION", "INTENTION")),
    "visits": Partial("visit_area_info", ("TRAVEL_ID", "VISIT_AREA_ID", "SIDO", "SGG", "REGION"), _visits, ("VISITS",)),
    "payments": Partial("activity_consume", ("TRAVEL_ID", "VISIT_AREA_ID", "ACTIVITY_TYPE_CD"), _payments, ("N", "AMOUNT", "N_PAID")),
}


def week_rows(spark: SparkSession, table_dir: str, weeks: list[str], schema: T.StructType) -> DataFrame:
    """The rows of the named weeks; no other folder is listed, and no footer
    read for the schema."""
    full = T.StructType([f for f in schema.fields if f.name != WEEK] + [T.StructField(WEEK, T.StringType())])
    reader = spark.read.schema(full).option("basePath", table_dir)
    if set(weeks) >= set(list_weeks(spark, table_dir)):
        return reader.parquet(table_dir)  # the first build takes the whole folder
    return reader.parquet(*[f"{table_dir}/{WEEK}={w}" for w in weeks])


def refresh_states(spark: SparkSession, table: str, table_dir: str, weeks: list[str], state_root: str, schema: T.StructType) -> None:
    """Bring the states of ``table`` (rows of ``schema``) up to date with the
    named weeks as they stand now; weeks that are gone, or have no rows, lose
    their states."""
    present = set(list_weeks(spark, table_dir))
    here, gone = [w for w in weeks if w in present], {w for w in weeks if w not in present}
    for name, partial in PARTIALS.items():
        if partial.source != table:
            continue
        state_dir = f"{state_root}/{name}"
        drop_weeks(spark, state_dir, gone)
        if here:
            rows = partial.of(week_rows(spark, table_dir, here, schema))
            (rows.hint("rebalance", WEEK).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy(WEEK).parquet(state_dir))
            drop_weeks(spark, state_dir, set(here) - weeks_with_rows(spark, state_dir, here, rows))


def states(spark: SparkSession, name: str, state_root: str, like: DataFrame) -> DataFrame:
    """All weeks of a state; ``like`` gives the schema of its source rows."""
    empty = PARTIALS[name].of(like.limit(0).withColumn(WEEK, F.lit(None).cast("string")))
    if not list_weeks(spark, f"{state_root}/{name}"):
        return empty
    return spark.read.schema(empty.schema).parquet(f"{state_root}/{name}")


def merged(spark: SparkSession, name: str, state_root: str, like: DataFrame) -> DataFrame:
    return PARTIALS[name].merged(states(spark, name, state_root, like))


def lodging_cost(state: DataFrame, codes: DataFrame) -> DataFrame:
    """The lodging mart from its merged state."""
    kinds = bounded_broadcast(code_lookup(codes, CODE_LODGING).select("CD_B", "CD_NM"))
    return (state.join(kinds, F.col("LODGING_TYPE_CD") == F.col("CD_B"))
            .groupBy("SIDO", "SGG", "REGION", F.col("CD_NM").alias("LODGING_TYPE"))
            .agg(F.sum("N").alias("LODGING_COUNT"), F.sum("AMOUNT").cast("long").alias("TOTAL_COST")))


def satisfaction(state: DataFrame) -> DataFrame:
    mean = lambda c: (F.col(c).cast("double") / F.col("N"))
    return state.select("SIDO", "SGG", "REGION", mean("SATISFACTION").alias("AVG_SATISFACTION"),
                        mean("INTENTION").alias("AVG_REVISIT_INTENTION"), F.col("N").alias("VISIT_COUNT"))


def activity_by_region(visits: DataFrame, payments: DataFrame, codes: DataFrame) -> DataFrame:
    """Both activity marts' measures from the two merged sides: a place's
    visits multiply what was paid there."""
    acts = _numeric_codes(codes, CODE_ACTIVITY)
    paid = (payments.join(acts, F.col("ACTIVITY_TYPE_CD").cast("double") == F.col("CODE_KEY"))
            .groupBy("TRAVEL_ID", "VISIT_AREA_ID", "CD_NM").agg(F.sum("N").alias("N"), F.sum("AMOUNT").alias("AMOUNT"), F.sum("N_PAID").alias("N_PAID")))
    times = F.col("VISITS").cast("decimal(10,0)")
    return (visits.join(paid, ["VISIT_AREA_ID", "TRAVEL_ID"])
            .groupBy("REGION", "SIDO", "SGG", F.col("CD_NM").alias("ACTIVITY_TYPE"))
            .agg(F.sum(F.col("N") * F.col("VISITS")).alias("ACTIVITY_COUNT"),
                 F.sum(F.col("AMOUNT").cast("decimal(26,6)") * times).cast("double").alias("TOTAL_CONSUMPTION"),
                 F.sum(F.col("N_PAID") * F.col("VISITS")).alias("TOTAL_PAYMENT_COUNT")))


def marts(spark: SparkSession, state_root: str, like: dict[str, DataFrame], codes: DataFrame, scratch_root: str | None = None) -> dict[str, DataFrame]:
    """The four marts from the states; ``like`` has the three source tables'
    schemas by name (no rows are read).  With a ``scratch_root`` the join that
    both activity marts share is written there and done once."""
    side = lambda name: merged(spark, name, state_root, like[PARTIALS[name].source])
    activity = activity_by_region(side("visits"), side("payments"), codes)
    if scratch_root is not None:
        activity = materialize(activity, f"{scratch_root}/activity_by_region")
    return {
        "lodging_type_distribution_with_cost": lodging_cost(side("lodging"), codes),
        "region_visitarea_analysis": satisfaction(side("satisfaction")),
        "region_activity_distribution": activity.select("REGION", "SIDO", "SGG", "ACTIVITY_TYPE", "ACTIVITY_COUNT"),
        "region_activity_consumption": activity.select("REGION", "SIDO", "SGG", "ACTIVITY_TYPE", "TOTAL_CONSUMPTION", "TOTAL_PAYMENT_COUNT"),
    }
