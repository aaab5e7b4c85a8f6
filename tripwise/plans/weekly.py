"""The weekly analysis refresh: rebuild every mart from the current raw and
processed tables.

Intermediates used by more than one mart are computed once and written as
tables under the shared scratch root (this also cuts their lineage, so a
lost executor re-reads the table instead of recomputing the joins):
the region visit dataset (D4 -> D4 copy, D5) and the activity aggregate
(D7, D8).  Each mart is then one job writing its own folder; the jobs
are submitted together.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from . import marts as M
from .processed import region_visit


def materialize(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def together(jobs: list[Callable[[], object]], most: int = 4) -> list:
    """Run independent jobs, ``most`` at a time: the scheduler packs the small
    ones into the slots that the last tasks of large ones leave free.  A job
    that fails raises here."""
    with ThreadPoolExecutor(max_workers=max(1, min(most, len(jobs)))) as pool:
        return [done.result() for done in [pool.submit(job) for job in jobs]]


def mart_frames(spark: SparkSession, t: dict[str, DataFrame], scratch_root: str) -> dict[str, DataFrame]:
    """All fourteen marts by name.  ``t`` holds travel, traveller_master,
    mvmn_consume, activity_consume, lodge_consume (raw), processed_visit,
    processed_lodge, codes; shared intermediates are written below
    ``scratch_root``."""
    rv, act = together([
        lambda: materialize(region_visit(t["travel"], t["processed_visit"]), f"{scratch_root}/region_visit"),
        lambda: materialize(M.activity_by_region(t["processed_visit"], t["activity_consume"], t["codes"]),
                            f"{scratch_root}/activity_by_region")])
    spatial = M.spatial(t["processed_visit"])
    return {
        "cumulative_travel_stats": M.travel_stats(t["travel"]),
        "traveler_gender_age_distribution": M.gender_age(t["traveller_master"]),
        "traveler_job_distribution": M.job_distribution(t["traveller_master"], t["travel"], t["codes"]),
        "region_visit_dataset": rv,
        "region_visit_map": M.visit_map(rv),
        "mvmn_price": M.mvmn_price(t["mvmn_consume"], t["travel"]),
        "region_activity_distribution": M.activity_distribution(act),
        "region_activity_consumption": M.activity_consumption(act),
        "activity_consume_by_area": M.consume_by_area(t["activity_consume"], t["processed_visit"]),
        "lodging_type_distribution_with_cost": M.lodging_cost(t["processed_lodge"], t["codes"]),
        "weekly_spending": M.weekly_spending(t["mvmn_consume"], t["lodge_consume"], t["activity_consume"]),
        "region_visit_count": M.visit_count(t["travel"], t["processed_visit"]),
        "region_visitarea_analysis": M.satisfaction(t["processed_visit"]),
        "region_spatial_analysis": spatial,
    }


def refresh_analysis(spark: SparkSession, t: dict[str, DataFrame], out_root: str,
                     scratch_root: str, max_parallel_writes: int = 4) -> dict[str, str]:
    """Write every mart below ``out_root``; ``t`` as for ``mart_frames``."""
    marts = mart_frames(spark, t, scratch_root)
    paths = {name: f"{out_root}/{name}" for name in marts}
    together([lambda name=name, df=df: df.write.mode("overwrite").parquet(paths[name]) for name, df in marts.items()], max_parallel_writes)
    return paths
