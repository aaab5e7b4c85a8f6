"""Processed zone: region-normalised lodge/visit tables, code tables and the
region visit dataset."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.address import normalize_and_filter, with_region_columns, is_valid_region
from ..schemas import (ADDRESS_COLUMN, CODE_REGION, CUTOFF_COLUMN, REGION_COLUMNS)

CODEB_COLUMNS = ["IDX", "CD_NM", "CD_A", "CD_B", "CD_MEMO", "DEL_FLAG", "ORDER_NUM",
                 "INS_DT", "EDIT_DT"]
CODEA_COLUMNS = ["IDX", "CD_NM", "CD_A", "CD_MEMO", "CD_MEMO2", "DEL_FLAG", "ORDER_NUM",
                 "PERM_WRITE", "PERM_EDIT", "PERM_DELETE", "INS_DT", "EDIT_DT"]


def add_null_columns(df: DataFrame, cols=REGION_COLUMNS) -> DataFrame:
    """Schema evolution: new nullable text columns, NULL for existing rows."""
    return df.withColumns({c: F.lit(None).cast("string") for c in cols if c not in df.columns})


def normalize_table(raw: DataFrame, table: str) -> DataFrame:
    """Raw lodge/visit rows -> processed rows (region columns, invalid dropped).

    A pure per-row function, so applying it to each new week gives the same
    table as re-running it over everything (the source system re-ran its
    UPDATE/DELETE over the whole table every week)."""
    base = raw.drop(*[c for c in REGION_COLUMNS if c in raw.columns])
    return normalize_and_filter(base, ADDRESS_COLUMN[table])


def annotate_table(raw: DataFrame, table: str) -> DataFrame:
    """Region columns without the validity filter (for inspection)."""
    base = raw.drop(*[c for c in REGION_COLUMNS if c in raw.columns])
    return with_region_columns(base, ADDRESS_COLUMN[table])


def valid_rows(annotated: DataFrame) -> DataFrame:
    return annotated.filter(is_valid_region(F.col("SIDO"), F.col("SGG")))


def before_cutoff(raw: DataFrame, table: str, cutoff: str) -> DataFrame:
    col = CUTOFF_COLUMN[table]
    return raw.filter(F.col(col) < F.to_date(F.lit(cutoff)))


def seed_processed(raw: DataFrame, table: str, cutoff: str) -> DataFrame:
    """Initial processed table: raw rows before the cut-off, region columns
    added as NULL (filled by the normalisation step)."""
    return add_null_columns(before_cutoff(raw, table, cutoff))


def codeb_capital(codeb: DataFrame) -> DataFrame:
    """Code table B, one region copy, fixed projection."""
    return codeb.filter(F.col("REGION") == CODE_REGION).select(*CODEB_COLUMNS)


def codea_capital(codea: DataFrame) -> DataFrame:
    return codea.filter(F.col("REGION") == CODE_REGION).select(*CODEA_COLUMNS)


def sgg_distinct(sgg: DataFrame) -> DataFrame:
    return sgg.distinct()


def code_lookup(codes: DataFrame, domain: str) -> DataFrame:
    """(CD_B, CD_NM) of one code domain; the filter reaches the scan."""
    return codes.filter(F.col("CD_A") == domain).select("CD_A", "CD_B", "CD_NM")


def region_visit(travel: DataFrame, visit_p: DataFrame) -> DataFrame:
    """Visits per (SIDO, SIDO_SGG): distinct (travel, sido, region) triples of
    visits whose travel exists.

    The triple is de-duplicated before the join (map-side partial
    aggregation collapses repeated visits, including a hot travel id), and
    the join only tests existence against de-duplicated travel ids, so
    neither side can fan rows out or concentrate a hot key in one task."""
    triples = (visit_p.filter(F.col("SIDO").isNotNull())
               .select("TRAVEL_ID", "SIDO", F.col("SIDO_SGG").alias("REGION"))
               .distinct())
    known = triples.join(travel.select("TRAVEL_ID").distinct(), "TRAVEL_ID", "left_semi")
    return (known.groupBy("SIDO", "REGION").agg(F.count(F.lit(1)).alias("VISIT_COUNT"))
            .orderBy(F.col("VISIT_COUNT").desc()))
