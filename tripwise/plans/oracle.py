"""Reference SQL for the correctness gate (DuckDB dialect).

Each statement states a result over CTEs that rebuild the travel tables from
the driver tables (``fixtures.duck_cte``).  The normalisation is a CASE over
the first address token, the Sejong rule and the validity delete negated with
``IS NOT TRUE``: an independent check of the Spark keep-form filter.
"""

from __future__ import annotations

from .. import fixtures as fx
from ..schemas import (ACTIVITY_LABEL_OTHER, ACTIVITY_LABELS, ISO_3166_2, PROVINCE_ALIASES,
                       SEJONG_SGG, SEJONG_SIDO, VALID_SGG_SUFFIXES, VALID_SIDO)


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _sido_case(tok: str) -> str:
    arms = " ".join(f"WHEN {tok} IN ({', '.join(_q(a) for a in aliases)}) THEN {_q(canon)}"
                    for canon, aliases in PROVINCE_ALIASES)
    return f"CASE {arms} ELSE {tok} END"


def _delete_condition() -> str:
    sido_list = ", ".join(_q(s) for s in VALID_SIDO)
    not_like = " AND ".join(f"SGG NOT LIKE {_q('%' + s)}" for s in VALID_SGG_SUFFIXES)
    return (f"SIDO IS NULL OR SIDO = '' OR SIDO NOT IN ({sido_list}) "
            f"OR SGG IS NULL OR SGG = '' OR {not_like}")


def _annotated(raw: str, addr: str) -> str:
    """Raw rows plus SIDO, SGG, SIDO_SGG (before the validity delete)."""
    step1 = (f"SELECT *, {_sido_case(f'split_part({addr}, {_q(chr(32))}, 1)')} AS SIDO, "
             f"split_part({addr}, ' ', 2) AS SGG FROM {raw}")
    step2 = f"SELECT *, TRIM(SIDO || ' ' || SGG) AS SIDO_SGG FROM ({step1})"
    step3 = (f"SELECT * REPLACE ("
             f"CASE WHEN SIDO = {_q(SEJONG_SIDO)} THEN {_q(SEJONG_SGG)} ELSE SGG END AS SGG, "
             f"CASE WHEN SIDO = {_q(SEJONG_SIDO)} THEN SIDO || {_q(' ' + SEJONG_SGG)} "
             f"ELSE SIDO_SGG END AS SIDO_SGG) FROM ({step2})")
    return step3


def _processed(raw: str, addr: str) -> str:
    return f"SELECT * FROM ({_annotated(raw, addr)}) WHERE ({_delete_condition()}) IS NOT TRUE"


ISO_CASE = "CASE " + " ".join(f"WHEN SIDO = {_q(k)} THEN {_q(v)}" for k, v in ISO_3166_2.items()) + " ELSE NULL END"
ACTIVITY_CASE = ("CASE " + " ".join(f"WHEN ACTIVITY_TYPE_CD = {k} THEN {_q(v)}"
                                    for k, v in ACTIVITY_LABELS.items())
                 + f" ELSE {_q(ACTIVITY_LABEL_OTHER)} END")

# Derived CTEs: name -> (dependencies, body)
DERIVED: dict[str, tuple[list[str], str]] = {
    "annotated_visit": (["visit_area_info"], _annotated("visit_area_info", "LOTNO_ADDR")),
    "annotated_lodge": (["lodge_consume"], _annotated("lodge_consume", "ROAD_NM_ADDR")),
    "processed_visit": (["visit_area_info"], _processed("visit_area_info", "LOTNO_ADDR")),
    "processed_lodge": (["lodge_consume"], _processed("lodge_consume", "ROAD_NM_ADDR")),
    "codeb_distinct": (["meta_codeb"],
                       "SELECT IDX, CD_NM, CD_A, CD_B, CD_MEMO, DEL_FLAG, ORDER_NUM, INS_DT, EDIT_DT "
                       "FROM meta_codeb WHERE REGION = 'capital'"),
    "codea_distinct": (["meta_codea"],
                       "SELECT IDX, CD_NM, CD_A, CD_MEMO, CD_MEMO2, DEL_FLAG, ORDER_NUM, PERM_WRITE, "
                       "PERM_EDIT, PERM_DELETE, INS_DT, EDIT_DT FROM meta_codea WHERE REGION = 'capital'"),
    "region_visit_dataset": (["travel", "processed_visit"], """
        SELECT SIDO, SIDO_SGG AS REGION, COUNT(DISTINCT TRAVEL_ID) AS VISIT_COUNT
        FROM processed_visit SEMI JOIN travel USING (TRAVEL_ID)
        WHERE SIDO IS NOT NULL GROUP BY ALL"""),
    "spatial_mart": (["processed_visit"], """
        SELECT X_COORD AS LONGITUDE, Y_COORD AS LATITUDE, SIDO, SGG, SIDO_SGG AS REGION,
               REVISIT_INTENTION AS WEIGHT, DGSTFN AS SATISFACTION
        FROM processed_visit
        WHERE X_COORD IS NOT NULL AND Y_COORD IS NOT NULL AND SIDO IS NOT NULL"""),
}


def with_ctes(body: str, *needed: str) -> str:
    """Prefix ``body`` with the CTEs it needs, dependencies first."""
    order: list[str] = []

    def visit(name: str):
        if name in order:
            return
        if name in DERIVED:
            for dep in DERIVED[name][0]:
                visit(dep)
        order.append(name)

    for n in needed:
        visit(n)
    parts = []
    for n in order:
        if n in fx.FIXTURES:
            parts.append(fx.duck_cte(n))
        else:
            parts.append(f"{n} AS ({DERIVED[n][1]})")
    return ("WITH " + ",\n".join(parts) + "\n" + body) if parts else body


def over(sql: str, where: dict[str, str]) -> str:
    """``sql`` with some of the fixture tables it rests on cut to the rows that
    a condition holds for."""
    for name, condition in where.items():
        table = fx.duck_cte(name)
        sql = sql.replace(table, f"{name} AS (SELECT * FROM (WITH {table} SELECT * FROM {name}) WHERE {condition})")
    return sql


# ---------------------------------------------------------------------------
# The analysis marts, each stated from its contract: the rows it takes part,
# the key it groups by, and the measures.  Payments and visits are first brought
# to one row per key with multiplicities, so the statements do not follow the
# shape of the Spark plans.
# ---------------------------------------------------------------------------
def _code_names(domain: str, key: str = "TRY_CAST(CD_B AS DOUBLE)") -> str:
    """(code, label, times listed) of one code domain."""
    return (f"SELECT {key} AS code, CD_NM AS label, COUNT(*) AS listed FROM codeb_distinct "
            f"WHERE CD_A = {_q(domain)} GROUP BY ALL")


def _monday(col: str) -> str:
    """The Monday of the week that a date, or text that is one, falls in."""
    return f"TRY_CAST({col} AS DATE) - CAST(isodow(TRY_CAST({col} AS DATE)) - 1 AS INTEGER)"


# Payments per (travel, place, activity label), joined to visits counted per
# (travel, place, region): counts multiply, sums scale by the visits.
_ACTIVITY = f""",
    labels AS ({_code_names('ACT')}),
    paid AS (
        SELECT TRAVEL_ID, VISIT_AREA_ID, label, SUM(listed) AS rows_paid,
               SUM(PAYMENT_AMT_WON * listed) AS amount, SUM(listed) FILTER (PAYMENT_AMT_WON IS NOT NULL) AS amounts
        FROM activity_consume, labels WHERE ACTIVITY_TYPE_CD = code GROUP BY ALL),
    places AS (
        SELECT TRAVEL_ID, VISIT_AREA_ID, SIDO, SGG, SIDO_SGG, COUNT(*) AS visits
        FROM processed_visit WHERE SIDO IS NOT NULL GROUP BY ALL)
"""


def _activity(measures: str) -> str:
    base = with_ctes("", "processed_visit", "activity_consume", "codeb_distinct").rstrip()
    return base + _ACTIVITY + f"""SELECT SIDO_SGG AS REGION, SIDO, SGG, label AS ACTIVITY_TYPE, {measures}
        FROM places JOIN paid USING (TRAVEL_ID, VISIT_AREA_ID) GROUP BY ALL"""


_SPENDING = " UNION ALL ".join(
    f"SELECT {_q(category)} AS CATEGORY, {_monday('PAYMENT_DT_YMD')} AS WEEK_START_DATE, PAYMENT_AMT_WON AS amount FROM {table} "
    "WHERE PAYMENT_DT_YMD IS NOT NULL"
    for category, table in (("ACTIVITY", "activity_consume"), ("LODGING", "lodge_consume"), ("MOVEMENT", "mvmn_consume")))

MARTS: dict[str, str] = {
    "mart_travel_stats": with_ctes("""
        SELECT CAST(date_trunc('month', day) AS DATE) AS MONTH, COUNT(DISTINCT TRAVELER_ID) AS UNIQUE_TRAVELERS,
               COUNT(DISTINCT TRAVEL_ID) AS UNIQUE_TRAVELS
        FROM (SELECT *, TRY_CAST(TRAVEL_START_YMD AS DATE) AS day FROM travel WHERE TRAVEL_START_YMD IS NOT NULL)
        GROUP BY ALL""", "travel"),
    "mart_gender_age": with_ctes("""
        SELECT GENDER, AGE_GRP AS AGE_GROUP, COUNT(*) AS TRAVELER_COUNT FROM traveller_master
        GROUP BY ALL HAVING GENDER IS NOT NULL AND AGE_GROUP IS NOT NULL""", "traveller_master"),
    "mart_job_distribution": with_ctes("", "traveller_master", "travel", "codeb_distinct").rstrip() + f""",
        labels AS ({_code_names('JOB')}),
        jobs AS (SELECT DISTINCT TRAVELER_ID, label FROM traveller_master JOIN labels ON JOB_NM = code),
        trips AS (SELECT DISTINCT TRAVEL_ID, label FROM travel NATURAL JOIN jobs)
        SELECT label AS JOB_NAME, COUNT(TRAVEL_ID) AS TRAVEL_FREQUENCY FROM trips GROUP BY ALL""",
    "mart_region_visit": with_ctes("SELECT * FROM region_visit_dataset", "region_visit_dataset"),
    "mart_visit_map": with_ctes(f"SELECT *, {ISO_CASE} AS ISO_3166_2_CODE FROM region_visit_dataset", "region_visit_dataset"),
    "mart_mvmn_price": with_ctes("""
        SELECT MVMN_SE_NM, PAYMENT_AMT_WON, TRAVEL_START_YMD
        FROM (SELECT TRAVEL_ID, TRAVEL_START_YMD FROM travel) JOIN mvmn_consume USING (TRAVEL_ID)""",
        "mvmn_consume", "travel"),
    "mart_activity_distribution": _activity("CAST(SUM(visits * rows_paid) AS BIGINT) AS ACTIVITY_COUNT"),
    "mart_activity_consumption": _activity(
        "SUM(visits * amount) AS TOTAL_CONSUMPTION, CAST(COALESCE(SUM(visits * amounts), 0) AS BIGINT) AS TOTAL_PAYMENT_COUNT"),
    "mart_consume_by_area": with_ctes(f"""
        SELECT STORE_NM, {ACTIVITY_CASE} AS ACTIVITY_TYPE, PAYMENT_AMT_WON, X_COORD, Y_COORD
        FROM (SELECT VISIT_AREA_ID, VISIT_AREA_NM AS STORE_NM, X_COORD, Y_COORD FROM processed_visit)
        JOIN (SELECT VISIT_AREA_ID, STORE_NM, ACTIVITY_TYPE_CD, PAYMENT_AMT_WON FROM activity_consume)
        USING (VISIT_AREA_ID, STORE_NM)""", "activity_consume", "processed_visit"),
    "mart_lodging_cost": with_ctes("", "processed_lodge", "codeb_distinct").rstrip() + f""",
        labels AS ({_code_names('HTY', 'CD_B')}),
        stays AS (SELECT * FROM processed_lodge WHERE PAYMENT_AMT_WON IS NOT NULL)
        SELECT SIDO, SGG, SIDO_SGG AS REGION, label AS LODGING_TYPE, CAST(SUM(listed) AS BIGINT) AS LODGING_COUNT,
               CAST(SUM(PAYMENT_AMT_WON * listed) AS BIGINT) AS TOTAL_COST
        FROM stays JOIN labels ON code = LODGING_TYPE_CD GROUP BY ALL""",
    "mart_weekly_spending": with_ctes(f"""
        SELECT *, TOTAL_SPENDING / NULLIF(SUM(TOTAL_SPENDING) OVER (PARTITION BY WEEK_START_DATE), 0) AS SPENDING_SHARE
        FROM (SELECT WEEK_START_DATE, CATEGORY, CAST(SUM(amount) AS DOUBLE) AS TOTAL_SPENDING FROM ({_SPENDING}) GROUP BY ALL)""",
        "mvmn_consume", "lodge_consume", "activity_consume"),
    "mart_visit_count": with_ctes("""
        SELECT TRAVEL_START_YMD, TRAVEL_END_YMD, SIDO_SGG, SIDO, SGG
        FROM (SELECT TRAVEL_ID, SIDO_SGG, SIDO, SGG FROM processed_visit) JOIN travel USING (TRAVEL_ID)""",
        "travel", "processed_visit"),
    "mart_satisfaction": with_ctes("""
        SELECT SIDO, SGG, SIDO_SGG AS REGION, SUM(DGSTFN) / COUNT(*) AS AVG_SATISFACTION,
               SUM(REVISIT_INTENTION) / COUNT(*) AS AVG_REVISIT_INTENTION, COUNT(*) AS VISIT_COUNT
        FROM (SELECT * FROM processed_visit WHERE DGSTFN + REVISIT_INTENTION IS NOT NULL) GROUP BY ALL""", "processed_visit"),
    "mart_spatial": with_ctes("SELECT * FROM spatial_mart", "spatial_mart"),
    "spatial_highlight": with_ctes(
        "SELECT * FROM spatial_mart WHERE SATISFACTION > 4 INTERSECT ALL SELECT * FROM spatial_mart WHERE WEIGHT > 4", "spatial_mart"),
    "processed_visit": with_ctes("SELECT * FROM processed_visit", "processed_visit"),
    "processed_lodge": with_ctes("SELECT * FROM processed_lodge", "processed_lodge"),
}
