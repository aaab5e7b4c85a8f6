"""Data-quality profiles and reconciliations (one distributed pass each)."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.coerce import human_size, to_double, value_kind
from ..functions.dates import as_date
from ..schemas import REGIONS


def profile_nulls(df: DataFrame) -> DataFrame:
    """NULL count per column: one aggregation pass, then one row per column."""
    cols = df.columns
    wide = df.agg(*[F.sum(F.when(F.col(f"`{c}`").isNull(), 1).otherwise(0)).cast("bigint").alias(c)
                    for c in cols])
    return wide.unpivot([], cols, "COLUMN_NAME", "NULL_COUNT")


def profile_date_range(df: DataFrame, table: str) -> DataFrame:
    """Min and max date of every column whose name contains 'YMD'; text
    that is not a date is ignored."""
    cols = [c for c in df.columns if "YMD" in c]
    aggs = []
    for c in cols:
        d = as_date(df, c)
        aggs += [F.min(d).alias(f"{c}__min"), F.max(d).alias(f"{c}__max")]
    wide = df.agg(*aggs)
    rows = [F.struct(F.lit(c).alias("COLUMN_NAME"), F.col(f"{c}__min").alias("MIN_DATE"),
                     F.col(f"{c}__max").alias("MAX_DATE")) for c in cols]
    return (wide.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
            .withColumn("TABLE_NAME", F.lit(table))
            .select("TABLE_NAME", "COLUMN_NAME", "MIN_DATE", "MAX_DATE"))


def profile_distinct_by_region(df: DataFrame, key: str = "TRAVEL_ID", region: str = "REGION") -> DataFrame:
    return df.groupBy(region).agg(F.count_distinct(key).alias("DISTINCT_IDS"))


def profile_value_types(df: DataFrame, col: str) -> DataFrame:
    return df.groupBy(value_kind(F.col(col)).alias("VALUE_KIND")).agg(F.count(F.lit(1)).alias("N"))


def coercion_audit(df: DataFrame, col: str) -> DataFrame:
    """Rows whose value is present but not numeric (lost by coercion)."""
    return df.filter(F.col(col).isNotNull() & to_double(F.col(col)).isNull())


def coercion_summary(df: DataFrame, col: str) -> DataFrame:
    return df.agg(F.sum(F.col(col).isNull().cast("bigint")).alias("NULLS_BEFORE"),
                  F.sum(to_double(F.col(col)).isNull().cast("bigint")).alias("NULLS_AFTER"))


def reconcile_counts(parts: dict[str, DataFrame], combined: DataFrame) -> DataFrame:
    """Row counts of each part and of the combined table in one pass over a
    tagged union, plus whether the parts add up."""
    tagged = None
    for tag, part in {**parts, "__combined": combined}.items():
        t = part.select(F.lit(tag).alias("PART"))
        tagged = t if tagged is None else tagged.unionByName(t)
    counts = tagged.agg(*[F.count(F.when(F.col("PART") == tag, 1)).alias(tag)
                          for tag in [*parts, "__combined"]])
    total = sum((F.col(t) for t in parts), F.lit(0))
    return counts.select(*[F.col(t).alias(f"{t.upper()}_ROWS") for t in parts],
                         F.col("__combined").alias("COMBINED_ROWS"),
                         (total == F.col("__combined")).alias("MATCHES"))


def profile_duplicates(df: DataFrame) -> DataFrame:
    """Full-row duplicates and how often each occurs (detection only)."""
    cols = df.columns
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("DUP_COUNT")).filter(F.col("DUP_COUNT") > 1)


def missing_ids(expected: DataFrame, present: DataFrame, key: str = "TRAVEL_ID") -> DataFrame:
    """Keys listed in ``expected`` that never occur in ``present``.  Both
    key sets are de-duplicated first: map-side partial aggregation collapses
    a hot key before the shuffle (the build side of an anti join cannot be
    split by skew handling), and the distinct's partitioning already
    satisfies the join."""
    return expected.select(key).distinct().join(present.select(key).distinct(), key, "left_anti")


def region_key_symdiff(df: DataFrame, key: str = "TRAVEL_ID", region: str = "REGION",
                       regions: list[str] = REGIONS) -> DataFrame:
    """For every pair of regions, the keys held by exactly one of the two.

    Each row contributes its region's bit, and one grouped ``bit_or`` per
    key yields the set of regions holding it: a fixed-width aggregate that
    combines map-side (a hot key leaves each map task as one row) and needs
    a single shuffle.  Each key is then checked against the fixed list of
    region pairs, so no pairwise join of key sets is needed.  Rows of a
    region outside ``regions`` take part in no pair."""
    if len(regions) > 62:
        raise ValueError("region bit mask holds at most 62 regions")
    pairs = [F.struct(F.lit(a).alias("REGION_A"), F.lit(b).alias("REGION_B"),
                      F.lit(1 << i).alias("BIT_A"), F.lit(1 << j).alias("BIT_B"))
             for (i, a), (j, b) in combinations(enumerate(regions), 2)]
    bits = F.create_map(*[x for i, r in enumerate(regions) for x in (F.lit(r), F.lit(1 << i))])
    bit = F.try_element_at(bits, F.col(region))
    holders = (df.select(key, bit.alias("BIT")).filter(F.col("BIT").isNotNull())
               .groupBy(key).agg(F.bit_or("BIT").alias("HOLDERS")))
    per_pair = holders.select(key, "HOLDERS", F.explode(F.array(*pairs)).alias("P"))
    in_a = (F.col("HOLDERS").bitwiseAND(F.col("P.BIT_A"))) != 0
    in_b = (F.col("HOLDERS").bitwiseAND(F.col("P.BIT_B"))) != 0
    return (per_pair.filter(in_a != in_b)
            .select(F.col("P.REGION_A").alias("REGION_A"), F.col("P.REGION_B").alias("REGION_B"),
                    key, F.when(in_a, F.col("P.REGION_A")).otherwise(F.col("P.REGION_B")).alias("ONLY_IN")))


def source_file_audit(files: DataFrame, small_bytes: int = 1024) -> DataFrame:
    """Per-file size, readable size text and a flag for near-empty
    (header-only) files."""
    return files.select("SOURCE_FILE", "SOURCE_SIZE",
                        human_size(F.col("SOURCE_SIZE")).alias("SIZE_TEXT"),
                        (F.col("SOURCE_SIZE") < small_bytes).alias("IS_SMALL"))
