"""Travel-log tables derived from the driver's TPC-H-ish tables.

The same rule set produces the tables in Spark (``DataFrame.selectExpr`` over
``spark.read.parquet``) and as DuckDB CTE text for the oracle, so both engines
see identical rows.  Rules use only integer arithmetic, CASE, ``||`` and
1-based array picks; NULLs, unknown codes and bad text are injected on
purpose so that NULL predicates and lenient casts are exercised.

Every table grows with its source table (orders, customer, lineitem, events,
nation, region, part), so work scales with the scale factor.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from .schemas import PROVINCE_ALIASES, REGIONS, VALID_SIDO

# Address pool: edge rows first, then every province alias with a district.
EDGE_ADDRESSES = [
    "서울특별시 종로구 세종로",   # kept
    "제주도 제주시",              # kept
    "경기 가평군",                # kept
    "세종특별자치시 한솔동",      # kept (Sejong district unified)
    "세종",                       # kept (Sejong, no district)
    "전북특별자치도 전주시",      # dropped: unknown province alias
    "강원 춘천읍",                # dropped: bad district suffix
    "서울시",                     # dropped: no district
    " 서울 종로구",               # dropped: leading blank
    "",                           # dropped
    None,                         # dropped
]
DISTRICTS = ["중구", "남시", "북군"]


def address_pool() -> list[str | None]:
    aliases = [a for _, al in PROVINCE_ALIASES for a in al]
    return EDGE_ADDRESSES + [f"{a} {DISTRICTS[i % len(DISTRICTS)]}" for i, a in enumerate(aliases)]


ADDRESSES = address_pool()
N_ADDR = len(ADDRESSES)
TRAVEL_MODES = ["자가용", "버스", "지하철", "택시", "기차"]

# Calendar parameters of the fixture world (lineitem dates span 1995..2001).
FIXTURE_BASE_DATE = "1998-01-04"     # a Sunday: first weekly slice
FIXTURE_CUTOFF_DATE = "1998-06-07"   # a Sunday: initial load ends before it
FIXTURE_WEEK_START = "1998-06-07"
FIXTURE_WEEK_END = "1998-06-13"


def _lit(v) -> str:
    if v is None:
        return "CAST(NULL AS STRING)"
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    return str(v)


def pick(list_name: str, idx: str):
    """1-based pick from a named literal list."""
    def r(d):
        items = ", ".join(_lit(v) for v in LISTS[list_name])
        if d == "spark":
            return f"element_at(array({items}), CAST({idx} AS INT))"
        return f"([{items}])[{idx}]"
    return r


def explode(list_name: str):
    """One output row per element of a named literal list."""
    def r(d):
        items = ", ".join(_lit(v) for v in LISTS[list_name])
        return f"explode(array({items}))" if d == "spark" else f"unnest([{items}])"
    return r


def dplus(date_expr: str, days: str, d: str) -> str:
    if d == "spark":
        return f"date_add({date_expr}, CAST({days} AS INT))"
    return f"({date_expr} + CAST({days} AS INTEGER))"


def idiv(a: str, b: str, d: str) -> str:
    return f"({a} div {b})" if d == "spark" else f"CAST(({a}) // ({b}) AS BIGINT)"


def _render(expr, dialect: str) -> str:
    return expr(dialect) if callable(expr) else expr


LISTS: dict[str, list] = {
    "ADDR": ADDRESSES,
    "REGIONS": REGIONS,
    "MODES": TRAVEL_MODES,
    "DOMAINS": ["JOB", "ACT", "HTY"],
    "GROUPS": ["JOB", "ACT", "HTY", "MVMN", "SGG"],
    "SIDO": VALID_SIDO,
    "YN": ["Y", "N"],
    "COPIES": [1, 2],
}


_D0 = "DATE '2023-01-01'"


@dataclass(frozen=True)
class Fixture:
    source: str
    columns: list[tuple[str, object]]   # rule text, or a function of the dialect
    where: str | None = None
    drop: list[str] = field(default_factory=list)


FIXTURES: dict[str, Fixture] = {
    "travel": Fixture("orders", [
        ("TRAVEL_ID", "CAST(o_orderkey AS STRING)"),
        ("TRAVELER_ID", "CAST(o_custkey AS STRING)"),
        ("TRAVEL_START_YMD", "CASE WHEN o_orderkey % 37 = 0 THEN CAST(NULL AS STRING) "
                             "WHEN o_orderkey % 41 = 0 THEN 'unknown' "
                             "ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) END"),
        ("TRAVEL_END_YMD", lambda d: dplus("CAST(o_orderdate AS DATE)", "o_orderkey % 4", d)),
        ("TRAVEL_NM", "o_orderpriority"),
    ]),
    "traveller_master": Fixture("customer", [
        ("TRAVELER_ID", "CAST(c_custkey AS STRING)"),
        ("RESIDENCE_SGG_CD", "CAST(c_nationkey AS BIGINT) * 1000 + c_custkey % 7"),
        ("TRAVEL_COMPANIONS_NUM", "c_custkey % 5"),
        ("GENDER", "CASE WHEN c_custkey % 17 = 0 THEN CAST(NULL AS STRING) "
                   "WHEN c_custkey % 2 = 0 THEN '여' ELSE '남' END"),
        ("AGE_GRP", "CASE WHEN c_custkey % 19 = 0 THEN CAST(NULL AS BIGINT) "
                    "ELSE (c_custkey % 6 + 1) * 10 END"),
        ("EDU_NM", "c_custkey % 4 + 1"),
        ("JOB_NM", "CASE WHEN c_custkey % 23 = 0 THEN CAST(NULL AS DOUBLE) "
                   "ELSE CAST(c_nationkey % 13 AS DOUBLE) END"),
        ("TRAVEL_TERM", "c_custkey % 3 + 1"),
        ("TRAVEL_NUM", "c_custkey % 10"),
        ("INCOME", "c_custkey % 12 + 1"),
        ("HOUSE_INCOME", "CASE WHEN c_custkey % 29 = 0 THEN CAST(NULL AS DOUBLE) "
                         "ELSE CAST(c_custkey % 12 AS DOUBLE) END"),
        ("TRAVEL_STYL_1", "c_custkey % 7 + 1"),
        ("TRAVEL_STYL_2", "c_custkey % 5 + 1"),
        ("TRAVEL_STYL_3", "c_custkey % 3 + 1"),
        ("TRAVEL_STATUS_START_YMD", lambda d: dplus("DATE '2023-01-01'", "c_custkey % 180", d)),
        ("TRAVEL_STATUS_END_YMD", lambda d: dplus("DATE '2023-01-01'", "c_custkey % 180 + c_custkey % 5", d)),
    ]),
    # Raw, pre-split traveller text: 'start~end', start only, or NULL.
    "traveller_status_text": Fixture("customer", [
        ("TRAVELER_ID", "CAST(c_custkey AS STRING)"),
        ("TRAVEL_STATUS_YMD", lambda d: (
            "CASE WHEN c_custkey % 13 = 0 THEN CAST(NULL AS STRING) "
            f"WHEN c_custkey % 11 = 0 THEN CAST({dplus(_D0, 'c_custkey % 180', d)} AS STRING) "
            f"WHEN c_custkey % 7 = 0 THEN 'n/a~' || CAST({dplus(_D0, 'c_custkey % 180', d)} AS STRING) "
            f"ELSE CAST({dplus(_D0, 'c_custkey % 180', d)} AS STRING) || '~' || "
            f"CAST({dplus(_D0, 'c_custkey % 180 + c_custkey % 5', d)} AS STRING) END")),
    ]),
    "visit_area_info": Fixture("lineitem", [
        ("TRAVEL_ID", "CAST(l_orderkey AS STRING)"),
        ("VISIT_AREA_ID", "l_partkey"),
        ("VISIT_AREA_NM", "'S' || CAST(l_suppkey AS STRING)"),
        ("ROAD_NM_ADDR", pick("ADDR", f"l_suppkey % {N_ADDR} + 1")),
        ("LOTNO_ADDR", pick("ADDR", f"l_partkey % {N_ADDR} + 1")),
        ("X_COORD", "CASE WHEN l_suppkey % 29 = 0 THEN CAST(NULL AS DOUBLE) "
                    "ELSE 126 + CAST(l_suppkey % 100 AS DOUBLE) / 100 END"),
        ("Y_COORD", "CASE WHEN l_partkey % 29 = 0 THEN CAST(NULL AS DOUBLE) "
                    "ELSE 33 + CAST(l_partkey % 500 AS DOUBLE) / 100 END"),
        ("RCMDTN_INTENTION", "CAST((l_partkey + l_suppkey) % 5 + 1 AS DOUBLE)"),
        ("REVISIT_INTENTION", "CASE WHEN l_partkey % 31 = 0 THEN CAST(NULL AS DOUBLE) "
                              "ELSE CAST((l_suppkey + l_linenumber) % 5 + 1 AS DOUBLE) END"),
        ("DGSTFN", "CASE WHEN l_orderkey % 31 = 0 THEN CAST(NULL AS DOUBLE) "
                   "ELSE CAST((l_partkey + l_linenumber) % 5 + 1 AS DOUBLE) END"),
        ("VISIT_END_YMD", "CAST(l_shipdate AS DATE)"),
    ]),
    "activity_consume": Fixture("lineitem", [
        ("TRAVEL_ID", "CAST(l_orderkey AS STRING)"),
        ("VISIT_AREA_ID", "l_partkey"),
        ("ACTIVITY_TYPE_CD", "CASE WHEN l_partkey % 43 = 0 THEN CAST(NULL AS BIGINT) "
                             "ELSE CAST(l_linenumber AS BIGINT) END"),
        ("PAYMENT_AMT_WON", "CASE WHEN l_orderkey % 47 = 0 THEN CAST(NULL AS DOUBLE) "
                            "ELSE CAST(floor(l_extendedprice) AS DOUBLE) END"),
        ("PAYMENT_DT_YMD", "CAST(l_shipdate AS DATE)"),
        ("STORE_NM", "'S' || CAST(l_suppkey AS STRING)"),
    ], where="l_returnflag = 'A'"),
    "meta_activity": Fixture("lineitem", [
        ("ACTIVITY_TYPE_CD", "CAST(l_linenumber AS BIGINT)"),
        ("ACTIVITY_DTL", "CASE WHEN l_suppkey % 7 = 0 THEN CAST(NULL AS STRING) "
                         "ELSE 'D' || CAST(l_suppkey % 20 AS STRING) END"),
        ("EXPND_SE", pick("YN", "l_partkey % 2 + 1")),
        ("TRAVEL_ID", "CAST(l_orderkey AS STRING)"),
        ("VISIT_AREA_ID", "l_partkey"),
    ], where="l_returnflag = 'A'"),
    "lodge_consume": Fixture("lineitem", [
        ("TRAVEL_ID", "CAST(l_orderkey AS STRING)"),
        ("LODGING_NM", "'L' || CAST(l_partkey AS STRING)"),
        ("LODGING_TYPE_CD", "CASE WHEN l_partkey % 41 = 0 THEN CAST(NULL AS STRING) "
                            "ELSE CAST(l_linenumber AS STRING) END"),
        ("ROAD_NM_ADDR", pick("ADDR", f"l_orderkey % {N_ADDR} + 1")),
        ("PAYMENT_AMT_WON", "CASE WHEN l_orderkey % 53 = 0 THEN CAST(NULL AS BIGINT) "
                            "ELSE CAST(floor(l_extendedprice) AS BIGINT) END"),
        ("PAYMENT_DT_YMD", "CAST(l_shipdate AS DATE)"),
    ], where="l_returnflag = 'R'"),
    "mvmn_consume": Fixture("lineitem", [
        ("TRAVEL_ID", "CAST(l_orderkey AS STRING)"),
        ("MVMN_SE_NM", pick("MODES", "l_partkey % 5 + 1")),
        ("PAYMENT_AMT_WON", "CASE WHEN l_orderkey % 59 = 0 THEN CAST(NULL AS DOUBLE) "
                            "ELSE CAST(floor(l_extendedprice) AS DOUBLE) END"),
        ("PAYMENT_DT_YMD", "CASE WHEN l_partkey % 61 = 0 THEN CAST(NULL AS DATE) "
                           "ELSE CAST(l_shipdate AS DATE) END"),
    ], where="l_returnflag = 'N'"),
    "move": Fixture("events", [
        ("TRAVEL_ID", "CAST(user_id AS STRING)"),
        ("TRIP_ID", "event_id"),
        ("START_DT_YMD", "CAST(NULL AS DATE)"),
        ("END_VISIT_AREA_ID", "CAST(user_id % 100 AS DOUBLE)"),
        ("END_DT_YMD", "CAST(ts AS DATE)"),
        ("MVMN_CD_1", "CASE WHEN event_id % 13 = 0 THEN CAST(NULL AS DOUBLE) "
                      "ELSE CAST(event_id % 10 AS DOUBLE) END"),
    ]),
    "gps": Fixture("events", [
        ("TRAVEL_ID", "CAST(user_id AS STRING)"),
        ("MOBILE_NUM_ID", "CASE WHEN event_id % 11 = 0 THEN CAST(NULL AS STRING) "
                          "ELSE 'M' || CAST(user_id % 50 AS STRING) END"),
        ("DT_MIN", "ts"),
        ("DT_YMD", "CAST(ts AS DATE)"),
        ("REGION", pick("REGIONS", "event_id % 4 + 1")),
    ]),
    "meta_codea": Fixture("region", [
        ("IDX", "CAST(r_regionkey AS BIGINT)"),
        ("CD_NM", "r_name"),
        ("CD_A", pick("GROUPS", "r_regionkey + 1")),
        ("CD_MEMO", "'memo ' || r_name"),
        ("CD_MEMO2", "CAST(NULL AS DOUBLE)"),
        ("DEL_FLAG", "'N'"),
        ("ORDER_NUM", "CAST(r_regionkey AS BIGINT)"),
        ("PERM_WRITE", "'Y'"),
        ("PERM_EDIT", "'Y'"),
        ("PERM_DELETE", "'N'"),
        ("INS_DT", "'2022-01-01'"),
        ("EDIT_DT", "CAST(NULL AS DOUBLE)"),
        ("REGION", explode("REGIONS")),
    ]),
    "meta_codeb": Fixture("nation", [
        ("IDX", "CAST(n_nationkey AS BIGINT)"),
        ("CD_NM", "n_name"),
        ("CD_A", pick("DOMAINS", "n_nationkey % 3 + 1")),
        ("CD_B", lambda d: "CASE WHEN n_nationkey = 24 THEN 'N/A' "
                 f"ELSE CAST({idiv('n_nationkey', '3', d)} AS STRING) END"),
        ("CD_MEMO", "'memo ' || n_name"),
        ("CD_MEMO2", "CAST(n_regionkey AS DOUBLE)"),
        ("DEL_FLAG", "'N'"),
        ("ORDER_NUM", lambda d: f"CAST({idiv('n_nationkey', '3', d)} AS BIGINT)"),
        ("INS_DT", "'2022-01-01'"),
        ("EDIT_DT", "CAST(NULL AS STRING)"),
        ("REGION", explode("REGIONS")),
    ]),
    "meta_sgg": Fixture("nation", [
        ("SGG_CD", "CAST(n_nationkey AS BIGINT) * 1000 + n_regionkey"),
        ("SGG_CD1", "CAST(n_regionkey AS BIGINT)"),
        ("SGG_CD2", "CAST(n_nationkey % 7 AS DOUBLE)"),
        ("SGG_CD3", "CAST(NULL AS DOUBLE)"),
        ("SGG_CD4", "CAST(NULL AS DOUBLE)"),
        ("SIDO_NM", pick("SIDO", "n_nationkey % 17 + 1")),
        ("SGG_NM", "n_name"),
        ("DONG_NM", "CAST(NULL AS STRING)"),
        ("RI_NM", "CAST(NULL AS STRING)"),
        ("_COPY", explode("COPIES")),
    ], drop=["_COPY"]),
    "poi": Fixture("part", [
        ("SGG_CD", "p_size"),
        ("LOTNO_CD", "p_partkey"),
        ("POI_NM", "p_name"),
        ("POI_TYPE", "p_type"),
    ]),
}


def fixture_exprs(name: str, dialect: str) -> list[str]:
    fx = FIXTURES[name]
    return [f"{_render(e, dialect)} AS {c}" for c, e in fx.columns]


# One scan DataFrame per (session, source file): the driver tables are
# read-only, so their listing and footer schema are read once per session and
# every query builds on the same lazy scan (holding the DataFrame also keeps
# its session alive, so the id in the key cannot be reused).
_SOURCES: dict[tuple[int, str], DataFrame] = {}


def source(spark: SparkSession, path: str) -> DataFrame:
    key = (id(spark), path)
    df = _SOURCES.get(key)
    if df is None:
        df = _SOURCES[key] = spark.read.parquet(path)
    return df


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Build one fixture table as a lazy DataFrame over the driver parquet."""
    fx = FIXTURES[name]
    src = source(spark, f"{sf_dir}/{fx.source}.parquet")
    if fx.where:
        src = src.where(fx.where)
    out = src.selectExpr(*fixture_exprs(name, "spark"))
    return out.drop(*fx.drop) if fx.drop else out


def duck_cte(name: str) -> str:
    fx = FIXTURES[name]
    body = f"SELECT {', '.join(fixture_exprs(name, 'duckdb'))} FROM {fx.source}"
    if fx.where:
        body += f" WHERE {fx.where}"
    if fx.drop:
        body = f"SELECT * EXCLUDE ({', '.join(fx.drop)}) FROM ({body})"
    return f"{name} AS ({body})"
