"""The analysis marts (weekly rebuild of the analysis schema)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.codes import activity_label, iso_code, numeric_code
from ..functions.coerce import exact_sum
from ..functions.dates import as_date, iso_week_start, lenient_date, month_start
from ..operators.joins import bounded_broadcast
from ..schemas import CODE_ACTIVITY, CODE_JOB, CODE_LODGING
from .processed import code_lookup, region_visit


def travel_stats(travel: DataFrame) -> DataFrame:
    """Distinct travellers and travels per start month (not a running total)."""
    return (travel.filter(F.col("TRAVEL_START_YMD").isNotNull())
            .withColumn("MONTH", month_start(lenient_date(F.col("TRAVEL_START_YMD"))))
            .groupBy("MONTH")
            .agg(F.count_distinct("TRAVELER_ID").alias("UNIQUE_TRAVELERS"),
                 F.count_distinct("TRAVEL_ID").alias("UNIQUE_TRAVELS"))
            .orderBy("MONTH"))


def gender_age(traveller: DataFrame) -> DataFrame:
    return (traveller.filter(F.col("GENDER").isNotNull() & F.col("AGE_GRP").isNotNull())
            .groupBy("GENDER", F.col("AGE_GRP").alias("AGE_GROUP"))
            .agg(F.count(F.lit(1)).alias("TRAVELER_COUNT"))
            .orderBy(F.col("TRAVELER_COUNT").desc()))


def _numeric_codes(codes: DataFrame, domain: str) -> DataFrame:
    """Code domain keyed by the numeric value of its text code; broadcast
    after a size check."""
    small = (code_lookup(codes, domain)
             .select(numeric_code(F.col("CD_B")).alias("CODE_KEY"), "CD_NM")
             .filter(F.col("CODE_KEY").isNotNull()))
    return bounded_broadcast(small)


def job_distribution(traveller: DataFrame, travel: DataFrame, codes: DataFrame) -> DataFrame:
    """Distinct travels per job name.  Traveller rows are reduced to
    distinct (traveller, job name) before meeting travel, so a traveller
    repeated in the master table cannot multiply its travels (the distinct
    count is unchanged by that reduction)."""
    jobs = _numeric_codes(codes, CODE_JOB)
    named = (traveller.filter(F.col("JOB_NM").isNotNull())
             .select("TRAVELER_ID", "JOB_NM")
             .join(jobs, F.col("JOB_NM") == F.col("CODE_KEY"))
             .select("TRAVELER_ID", "CD_NM")
             .distinct())
    trips = travel.select("TRAVELER_ID", "TRAVEL_ID")
    return (named.join(trips, "TRAVELER_ID")
            .groupBy(F.col("CD_NM").alias("JOB_NAME"))
            .agg(F.count_distinct("TRAVEL_ID").alias("TRAVEL_FREQUENCY"))
            .orderBy(F.col("TRAVEL_FREQUENCY").desc()))


def visit_map(region_visits: DataFrame) -> DataFrame:
    return (region_visits.select("SIDO", "REGION", "VISIT_COUNT",
                                 iso_code(F.col("SIDO")).alias("ISO_3166_2_CODE"))
            .orderBy(F.col("VISIT_COUNT").desc()))


def mvmn_price(mvmn: DataFrame, travel: DataFrame) -> DataFrame:
    return (mvmn.select("TRAVEL_ID", "MVMN_SE_NM", "PAYMENT_AMT_WON")
            .join(travel.select("TRAVEL_ID", "TRAVEL_START_YMD"), "TRAVEL_ID")
            .select("MVMN_SE_NM", "PAYMENT_AMT_WON", "TRAVEL_START_YMD"))


def activity_by_region(visit_p: DataFrame, activity: DataFrame, codes: DataFrame) -> DataFrame:
    """One aggregation feeding both activity marts: row count, amount sum
    and non-null amount count per (region, activity type) over the
    (visit, activity) pairs that share travel and place.

    Payments are first reduced to one row per (travel, place, activity
    name) with their count, sum and non-null count; map-side partial
    aggregation collapses a hot key before any shuffle.  Each visit row
    then meets at most one row per activity name, so a key that is hot on
    both sides never multiplies into |visits| x |payments| pairs; the pair
    totals are recovered as sums of (visit rows x payment totals).

    Amounts are added as decimals and cast once at the end, so neither the
    order of rows nor the partitions change a total."""
    acts = _numeric_codes(codes, CODE_ACTIVITY)
    paid = (activity.select("TRAVEL_ID", "VISIT_AREA_ID", "ACTIVITY_TYPE_CD", "PAYMENT_AMT_WON")
            .join(acts, F.col("ACTIVITY_TYPE_CD").cast("double") == F.col("CODE_KEY"))
            .groupBy("TRAVEL_ID", "VISIT_AREA_ID", "CD_NM")
            .agg(F.count(F.lit(1)).alias("N_ROWS"),
                 exact_sum("PAYMENT_AMT_WON").alias("AMT_SUM"),
                 F.count("PAYMENT_AMT_WON").alias("N_PAID")))
    places = (visit_p.filter(F.col("SIDO").isNotNull())
              .select("TRAVEL_ID", "VISIT_AREA_ID", "SIDO_SGG", "SIDO", "SGG"))
    return (places.join(paid, ["VISIT_AREA_ID", "TRAVEL_ID"])
            .groupBy(F.col("SIDO_SGG").alias("REGION"), "SIDO", "SGG",
                     F.col("CD_NM").alias("ACTIVITY_TYPE"))
            .agg(F.sum("N_ROWS").alias("ACTIVITY_COUNT"),
                 F.sum("AMT_SUM").cast("double").alias("TOTAL_CONSUMPTION"),
                 F.sum("N_PAID").alias("TOTAL_PAYMENT_COUNT")))


def activity_distribution(by_region: DataFrame) -> DataFrame:
    return (by_region.select("REGION", "SIDO", "SGG", "ACTIVITY_TYPE", "ACTIVITY_COUNT")
            .orderBy("SIDO", F.col("ACTIVITY_COUNT").desc()))


def activity_consumption(by_region: DataFrame) -> DataFrame:
    return (by_region.select("REGION", "SIDO", "SGG", "ACTIVITY_TYPE", "TOTAL_CONSUMPTION",
                             "TOTAL_PAYMENT_COUNT")
            .orderBy("SIDO", F.col("TOTAL_CONSUMPTION").desc()))


def consume_by_area(activity: DataFrame, visit_p: DataFrame) -> DataFrame:
    """Row-level activity spend with visit coordinates.  Matched on visit id
    and store/visit name only (not travel id), so one payment can meet many
    visits; the fan-out is part of the mart's definition."""
    places = visit_p.select("VISIT_AREA_ID", F.col("VISIT_AREA_NM").alias("STORE_NM"),
                            "X_COORD", "Y_COORD")
    return (activity.select("VISIT_AREA_ID", "STORE_NM", "ACTIVITY_TYPE_CD", "PAYMENT_AMT_WON")
            .join(places, ["VISIT_AREA_ID", "STORE_NM"])
            .select("STORE_NM", activity_label(F.col("ACTIVITY_TYPE_CD")).alias("ACTIVITY_TYPE"),
                    "PAYMENT_AMT_WON", "X_COORD", "Y_COORD"))


def lodging_cost(lodge_p: DataFrame, codes: DataFrame) -> DataFrame:
    kinds = bounded_broadcast(code_lookup(codes, CODE_LODGING).select("CD_B", "CD_NM"))
    return (lodge_p.filter(F.col("LODGING_TYPE_CD").isNotNull() & F.col("PAYMENT_AMT_WON").isNotNull())
            .select("SIDO", "SGG", "SIDO_SGG", "LODGING_TYPE_CD", "PAYMENT_AMT_WON")
            .join(kinds, F.col("LODGING_TYPE_CD") == F.col("CD_B"))
            .groupBy("SIDO", "SGG", F.col("SIDO_SGG").alias("REGION"),
                     F.col("CD_NM").alias("LODGING_TYPE"))
            .agg(F.count(F.lit(1)).alias("LODGING_COUNT"),
                 F.sum("PAYMENT_AMT_WON").alias("TOTAL_COST"))
            .orderBy(F.col("TOTAL_COST").desc()))


def _weekly_total(df: DataFrame, category: str) -> DataFrame:
    return (df.filter(F.col("PAYMENT_DT_YMD").isNotNull())
            .groupBy(iso_week_start(as_date(df, "PAYMENT_DT_YMD")).alias("WEEK_START_DATE"))
            .agg(exact_sum("PAYMENT_AMT_WON").alias("TOTAL_SPENDING"))
            .select("WEEK_START_DATE", F.lit(category).alias("CATEGORY"), "TOTAL_SPENDING"))


def weekly_spending(mvmn: DataFrame, lodge_raw: DataFrame, activity: DataFrame) -> DataFrame:
    """Monday-week spend per category and its share of the week's total.
    Each source is reduced to one row per week before the union, so the
    window only sees (#weeks x 3) rows.  Totals stay decimals until the
    last addition, so no order of rows changes a share."""
    trend = (_weekly_total(mvmn, "MOVEMENT")
             .unionByName(_weekly_total(lodge_raw, "LODGING"))
             .unionByName(_weekly_total(activity, "ACTIVITY")))
    week_total = F.sum("TOTAL_SPENDING").over(Window.partitionBy("WEEK_START_DATE"))
    total = F.col("TOTAL_SPENDING").cast("double")
    return (trend.select("WEEK_START_DATE", "CATEGORY", total.alias("TOTAL_SPENDING"),
                         F.try_divide(total, week_total.cast("double")).alias("SPENDING_SHARE"))
            .orderBy("WEEK_START_DATE", "CATEGORY"))


def visit_count(travel: DataFrame, visit_p: DataFrame) -> DataFrame:
    return (travel.select("TRAVEL_ID", "TRAVEL_START_YMD", "TRAVEL_END_YMD")
            .join(visit_p.select("TRAVEL_ID", "SIDO_SGG", "SIDO", "SGG"), "TRAVEL_ID")
            .select("TRAVEL_START_YMD", "TRAVEL_END_YMD", "SIDO_SGG", "SIDO", "SGG"))


def satisfaction(visit_p: DataFrame) -> DataFrame:
    return (visit_p.filter(F.col("DGSTFN").isNotNull() & F.col("REVISIT_INTENTION").isNotNull())
            .groupBy("SIDO", "SGG", F.col("SIDO_SGG").alias("REGION"))
            .agg(F.avg("DGSTFN").alias("AVG_SATISFACTION"),
                 F.avg("REVISIT_INTENTION").alias("AVG_REVISIT_INTENTION"),
                 F.count(F.lit(1)).alias("VISIT_COUNT"))
            .orderBy(F.col("VISIT_COUNT").desc()))


def spatial(visit_p: DataFrame) -> DataFrame:
    return (visit_p.filter(F.col("X_COORD").isNotNull() & F.col("Y_COORD").isNotNull()
                           & F.col("SIDO").isNotNull())
            .select(F.col("X_COORD").alias("LONGITUDE"), F.col("Y_COORD").alias("LATITUDE"),
                    "SIDO", "SGG", F.col("SIDO_SGG").alias("REGION"),
                    F.col("REVISIT_INTENTION").alias("WEIGHT"),
                    F.col("DGSTFN").alias("SATISFACTION")))


def spatial_highlight(spatial_mart: DataFrame, threshold: float = 4.0) -> DataFrame:
    """Places with satisfaction and revisit intention both above threshold."""
    return spatial_mart.filter((F.col("SATISFACTION") > threshold) & (F.col("WEIGHT") > threshold))


__all__ = ["travel_stats", "gender_age", "job_distribution", "region_visit", "visit_map",
           "mvmn_price", "activity_by_region", "activity_distribution", "activity_consumption",
           "consume_by_area", "lodging_cost", "weekly_spending", "visit_count", "satisfaction",
           "spatial", "spatial_highlight"]
