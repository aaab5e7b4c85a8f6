"""Address normalisation edge rows and the validity filter."""

import itertools

import pytest
from pyspark.sql import functions as F

from tripwise.functions import address as A
from tripwise.plans import processed as P

# (address, SIDO, SGG, SIDO_SGG, kept)
EDGE = [
    ("서울특별시 종로구 세종로", "서울", "종로구", "서울 종로구", True),
    ("제주도 제주시", "제주", "제주시", "제주 제주시", True),
    ("경기 가평군", "경기", "가평군", "경기 가평군", True),
    ("세종특별자치시 한솔동", "세종", "세종시", "세종 세종시", True),
    ("세종", "세종", "세종시", "세종 세종시", True),
    ("전북특별자치도 전주시", "전북특별자치도", "전주시", "전북특별자치도 전주시", False),
    ("강원 춘천읍", "강원", "춘천읍", "강원 춘천읍", False),
    ("서울시", "서울", "", "서울", False),
    (" 서울 종로구", "", "서울", "서울", False),
    ("", "", "", "", False),
    (None, None, None, None, False),
]


@pytest.fixture(scope="module")
def edge_df(spark):
    return spark.createDataFrame([(i, e[0]) for i, e in enumerate(EDGE)], "ID int, ADDR string")


def test_annotation_matches_edge_table(edge_df):
    got = {r.ID: (r.SIDO, r.SGG, r.SIDO_SGG)
           for r in A.with_region_columns(edge_df, "ADDR").collect()}
    for i, (_, sido, sgg, joined, _) in enumerate(EDGE):
        assert got[i] == (sido, sgg, joined), EDGE[i]


def test_filter_keeps_exactly_the_valid_rows(edge_df):
    kept = {r.ID for r in A.normalize_and_filter(edge_df, "ADDR").collect()}
    assert kept == {i for i, e in enumerate(EDGE) if e[4]}


def test_tokens_equal_split_part(edge_df):
    rows = edge_df.select(
        A.first_token(F.col("ADDR")).alias("a"), F.split_part("ADDR", F.lit(" "), F.lit(1)).alias("b"),
        A.second_token(F.col("ADDR")).alias("c"), F.split_part("ADDR", F.lit(" "), F.lit(2)).alias("d"),
    ).collect()
    for r in rows:
        assert (r.a, r.c) == (r.b, r.d)


def test_keep_form_equals_negated_delete_form(spark):
    """Token-level keep filter == column-level keep form == NOT(delete) with
    SQL three-valued logic, over every combination of edge tokens."""
    firsts = ["서울특별시", "서울", "세종", "세종시", "전북특별자치도", "", None, "x"]
    seconds = ["종로구", "제주시", "가평군", "춘천읍", "", None]
    rows = [(a, b) for a, b in itertools.product(firsts, seconds)]
    df = spark.createDataFrame(rows, "T1 string, T2 string")
    ann = df.withColumn("SIDO", A.canonical_sido(F.col("T1"))).withColumn(
        "SGG", F.when(F.col("SIDO") == "세종", F.lit("세종시")).otherwise(F.col("T2")))
    delete = F.expr(
        "SIDO IS NULL OR SIDO = '' OR SIDO NOT IN ('서울','제주','경기','강원','충남','충북','전남','전북',"
        "'경남','경북','광주','대구','대전','부산','인천','울산','세종') OR SGG IS NULL OR SGG = '' "
        "OR SGG NOT LIKE '%구' AND SGG NOT LIKE '%시' AND SGG NOT LIKE '%군'")
    out = ann.select(
        F.coalesce(A.is_valid_tokens(F.col("T1"), F.col("T2")), F.lit(False)).alias("tok"),
        F.coalesce(A.is_valid_region(F.col("SIDO"), F.col("SGG")), F.lit(False)).alias("col"),
        F.coalesce(~delete, F.lit(False)).alias("neg")).collect()
    for r in out:
        assert r.tok == r.col == r.neg


def test_processed_table_is_idempotent(spark, sf_dir):
    from tripwise import fixtures as fx
    raw = fx.load(spark, sf_dir, "lodge_consume")
    once = P.normalize_table(raw, "lodge_consume")
    twice = P.normalize_table(once, "lodge_consume")
    assert once.exceptAll(twice).count() == 0 and twice.exceptAll(once).count() == 0


from hypothesis import given, settings, strategies as st  # noqa: E402

_TOKENS = st.one_of(st.none(), st.sampled_from(["서울특별시", "서울", "세종", "세종시", "제주도", "경기",
                                                "전북특별자치도", "", " ", "x"]),
                    st.text(alphabet="구시군읍 서울세종", max_size=4))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(_TOKENS, _TOKENS), min_size=1, max_size=20))
def test_property_token_filter_equals_column_filter(spark, rows):
    """Property: for arbitrary addresses, the cheap token-level filter keeps
    exactly the rows the column-level keep form keeps."""
    addrs = [(i, None if a is None else (a if b is None else f"{a} {b}")) for i, (a, b) in enumerate(rows)]
    df = spark.createDataFrame(addrs, "ID int, ADDR string")
    fast = {r.ID for r in A.normalize_and_filter(df, "ADDR").collect()}
    slow = {r.ID for r in P.valid_rows(A.with_region_columns(df, "ADDR")).collect()}
    assert fast == slow
