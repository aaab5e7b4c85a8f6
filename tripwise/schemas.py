"""Typed table definitions, keep-lists and the fixed lookup values.

Everything in the "fixed values" blocks must equal the source system's
values for results to match; they are stated here once, in natural order.
"""

from __future__ import annotations

from pyspark.sql import types as T

S, L, D, DT = T.StringType(), T.LongType(), T.DoubleType(), T.DateType()


def _schema(*cols: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in cols])


# --------------------------------------------------------------------------
# Raw warehouse tables (typed load targets).  TEXT -> string,
# NUMBER(38,0) -> bigint, REAL -> double, DATE -> date.
# --------------------------------------------------------------------------
RAW_SCHEMAS: dict[str, T.StructType] = {
    "meta_codea": _schema(
        ("IDX", L), ("CD_NM", S), ("CD_A", S), ("CD_MEMO", S), ("CD_MEMO2", D),
        ("DEL_FLAG", S), ("ORDER_NUM", L), ("PERM_WRITE", S), ("PERM_EDIT", S),
        ("PERM_DELETE", S), ("INS_DT", S), ("EDIT_DT", D), ("REGION", S)),
    "meta_codeb": _schema(
        ("IDX", L), ("CD_NM", S), ("CD_A", S), ("CD_B", S), ("CD_MEMO", S),
        ("CD_MEMO2", D), ("DEL_FLAG", S), ("ORDER_NUM", L), ("INS_DT", S),
        ("EDIT_DT", S), ("REGION", S)),
    "meta_sgg": _schema(
        ("SGG_CD", L), ("SGG_CD1", L), ("SGG_CD2", D), ("SGG_CD3", D), ("SGG_CD4", D),
        ("SIDO_NM", S), ("SGG_NM", S), ("DONG_NM", S), ("RI_NM", S)),
    "meta_activity": _schema(
        ("ACTIVITY_TYPE_CD", L), ("ACTIVITY_DTL", S), ("EXPND_SE", S),
        ("TRAVEL_ID", S), ("VISIT_AREA_ID", L)),
    "meta_traveller_master": _schema(
        ("TRAVELER_ID", S), ("RESIDENCE_SGG_CD", L), ("TRAVEL_COMPANIONS_NUM", L),
        ("GENDER", S), ("AGE_GRP", L), ("EDU_NM", L), ("JOB_NM", D),
        ("TRAVEL_TERM", L), ("TRAVEL_NUM", L), ("INCOME", L), ("HOUSE_INCOME", D),
        ("TRAVEL_STYL_1", L), ("TRAVEL_STYL_2", L), ("TRAVEL_STYL_3", L),
        ("TRAVEL_STATUS_START_YMD", DT), ("TRAVEL_STATUS_END_YMD", DT)),
    "activity_consume": _schema(
        ("TRAVEL_ID", S), ("VISIT_AREA_ID", L), ("ACTIVITY_TYPE_CD", L),
        ("PAYMENT_AMT_WON", D), ("PAYMENT_DT_YMD", DT), ("STORE_NM", S)),
    "lodge_consume": _schema(
        ("TRAVEL_ID", S), ("LODGING_NM", S), ("LODGING_TYPE_CD", S),
        ("ROAD_NM_ADDR", S), ("PAYMENT_AMT_WON", L), ("PAYMENT_DT_YMD", DT)),
    "move": _schema(
        ("TRAVEL_ID", S), ("TRIP_ID", L), ("START_DT_YMD", DT),
        ("END_VISIT_AREA_ID", D), ("END_DT_YMD", DT), ("MVMN_CD_1", D)),
    "mvmn_consume": _schema(
        ("TRAVEL_ID", S), ("MVMN_SE_NM", S), ("PAYMENT_AMT_WON", D),
        ("PAYMENT_DT_YMD", DT)),
    "travel": _schema(
        ("TRAVEL_ID", S), ("TRAVELER_ID", S), ("TRAVEL_START_YMD", S),
        ("TRAVEL_END_YMD", DT), ("TRAVEL_NM", S)),
    "visit_area_info": _schema(
        ("TRAVEL_ID", S), ("VISIT_AREA_ID", L), ("VISIT_AREA_NM", S),
        ("ROAD_NM_ADDR", S), ("LOTNO_ADDR", S), ("X_COORD", D), ("Y_COORD", D),
        ("RCMDTN_INTENTION", D), ("REVISIT_INTENTION", D), ("DGSTFN", D),
        ("VISIT_END_YMD", DT)),
}

# Region columns added in the processed zone.
REGION_COLUMNS = ("SIDO", "SGG", "SIDO_SGG")

PROCESSED_SCHEMAS: dict[str, T.StructType] = {
    name: T.StructType(RAW_SCHEMAS[name].fields + [T.StructField(c, S, True) for c in REGION_COLUMNS])
    for name in ("lodge_consume", "visit_area_info")
}

# Date column that bounds each raw table for the cut-off reset.
CUTOFF_COLUMN = {
    "activity_consume": "PAYMENT_DT_YMD",
    "lodge_consume": "PAYMENT_DT_YMD",
    "move": "END_DT_YMD",
    "mvmn_consume": "PAYMENT_DT_YMD",
    "travel": "TRAVEL_END_YMD",
    "visit_area_info": "VISIT_END_YMD",
}

# Address column each processed table is normalised from.
ADDRESS_COLUMN = {"lodge_consume": "ROAD_NM_ADDR", "visit_area_info": "LOTNO_ADDR"}

# --------------------------------------------------------------------------
# Source-file table keys and their keep-lists (cleansing step).
# --------------------------------------------------------------------------
KEEP_COLUMNS: dict[str, list[str]] = {
    "tn_activity_consume": ["TRAVEL_ID", "VISIT_AREA_ID", "ACTIVITY_TYPE_CD",
                            "PAYMENT_AMT_WON", "PAYMENT_DT_YMD", "STORE_NM"],
    "tn_activity_his": ["ACTIVITY_TYPE_CD", "ACTIVITY_DTL", "EXPND_SE",
                        "TRAVEL_ID", "VISIT_AREA_ID"],
    "tn_lodge_consume": ["TRAVEL_ID", "LODGING_NM", "LODGING_TYPE_CD", "ROAD_NM_ADDR",
                         "PAYMENT_AMT_WON", "PAYMENT_DT_YMD"],
    "tn_move_his": ["TRAVEL_ID", "TRIP_ID", "END_VISIT_AREA_ID", "END_DT_YMD", "MVMN_CD_1"],
    "tn_mvmn_consume": ["TRAVEL_ID", "MVMN_SE_NM", "PAYMENT_AMT_WON", "PAYMENT_DT_YMD"],
    "tn_travel_travel": ["TRAVEL_ID", "TRAVELER_ID", "TRAVEL_START_YMD", "TRAVEL_END_YMD",
                         "TRAVEL_NM"],
    "tn_traveller_master": ["TRAVELER_ID", "RESIDENCE_SGG_CD", "TRAVEL_COMPANIONS_NUM",
                            "GENDER", "AGE_GRP", "EDU_NM", "JOB_NM", "TRAVEL_TERM",
                            "TRAVEL_NUM", "INCOME", "HOUSE_INCOME", "TRAVEL_STYL_1",
                            "TRAVEL_STYL_2", "TRAVEL_STYL_3", "TRAVEL_STATUS_START_YMD",
                            "TRAVEL_STATUS_END_YMD"],
    "tn_visit_area": ["TRAVEL_ID", "VISIT_AREA_ID", "VISIT_AREA_NM", "ROAD_NM_ADDR",
                      "LOTNO_ADDR", "X_COORD", "Y_COORD", "RCMDTN_INTENTION",
                      "REVISIT_INTENTION", "DGSTFN", "VISIT_END_YMD"],
}

# Source tables that are never loaded.
UNUSED_TABLES = ["tn_adv_consume", "tn_companion_info", "tn_tour_photo"]

# Name fragments that route a file to the un-dated metadata zone.
METADATA_MARKERS = ["tc_", "tn_activity_his_", "tn_traveller_master_"]

# The fourteen consolidated source datasets.
CANONICAL_DATASETS = [
    "tc_codea_코드A",
    "tc_codeb_코드B",
    "tc_sgg_시군구코드",
    "tn_activity_consume_his_활동소비내역",
    "tn_activity_his_활동내역",
    "tn_adv_consume_his_사전소비내역",
    "tn_companion_info_동반자정보",
    "tn_lodge_consume_his_숙박소비내역",
    "tn_move_his_이동내역",
    "tn_mvmn_consume_his_이동수단소비내역",
    "tn_tour_photo_관광사진",
    "tn_travel_여행",
    "tn_traveller_master_여행객 Master",
    "tn_visit_area_info_방문지정보",
]

# Region tags of the four source regions.
REGIONS = ["capital", "east", "west", "jeju"]

# --------------------------------------------------------------------------
# Province (SIDO) normalisation.  Canonical name followed by the
# first address tokens that map to it, in the source system's order.
# --------------------------------------------------------------------------
PROVINCE_ALIASES: list[tuple[str, list[str]]] = [
    ("서울", ["서울특별시", "서울시", "서울"]),
    ("제주", ["제주특별자치도", "제주도", "제주"]),
    ("경기", ["경기도", "경기"]),
    ("강원", ["강원특별자치도", "강원도", "강원"]),
    ("충남", ["충청남도", "충남"]),
    ("충북", ["충청북도", "충북"]),
    ("전남", ["전라남도", "전남"]),
    ("전북", ["전라북도", "전북"]),
    ("경남", ["경상남도", "경남"]),
    ("경북", ["경상북도", "경북"]),
    ("광주", ["광주광역시", "광주시", "광주"]),
    ("대구", ["대구광역시", "대구시", "대구"]),
    ("대전", ["대전광역시", "대전시", "대전"]),
    ("부산", ["부산광역시", "부산시", "부산"]),
    ("인천", ["인천광역시", "인천시", "인천"]),
    ("울산", ["울산광역시", "울산시", "울산"]),
    ("세종", ["세종특별자치시", "세종시", "세종"]),
]

# The seventeen accepted provinces (validity filter).
VALID_SIDO = ["서울", "제주", "경기", "강원", "충남", "충북", "전남", "전북", "경남",
              "경북", "광주", "대구", "대전", "부산", "인천", "울산", "세종"]

# Accepted district (SGG) suffixes.
VALID_SGG_SUFFIXES = ["구", "시", "군"]

# The single-district province and its unified district name.
SEJONG_SIDO = "세종"
SEJONG_SGG = "세종시"

# ISO 3166-2 code per canonical province.
ISO_3166_2 = {
    "부산": "KR-26", "충북": "KR-43", "충남": "KR-44", "대구": "KR-27", "대전": "KR-30",
    "강원": "KR-42", "광주": "KR-29", "경기": "KR-41", "경북": "KR-47", "경남": "KR-48",
    "인천": "KR-28", "제주": "KR-49", "전북": "KR-45", "전남": "KR-46", "세종": "KR-50",
    "서울": "KR-11", "울산": "KR-31",
}

# Activity labels by activity type code; anything else
# (including NULL) is the fallback label.
ACTIVITY_LABELS = {
    1: "취식",
    2: "쇼핑/구매",
    3: "체험 활동/입장 및 관람",
    4: "단순 구경/산책/걷기",
    5: "휴식",
}
ACTIVITY_LABEL_OTHER = "기타 활동"

# Code-table domains used by the marts.
CODE_JOB, CODE_ACTIVITY, CODE_LODGING = "JOB", "ACT", "HTY"
CODE_REGION = "capital"

# Default calendar of the source system.
DEFAULT_BASE_DATE = "2022-01-02"     # first weekly slice (a Sunday)
DEFAULT_CUTOFF_DATE = "2023-06-04"   # initial load ends before this day
DEFAULT_INITIAL_END = "2023-06-03"


def alias_pairs() -> list[tuple[str, str]]:
    """(first token, canonical province) pairs derived from PROVINCE_ALIASES."""
    return [(alias, canon) for canon, aliases in PROVINCE_ALIASES for alias in aliases]
