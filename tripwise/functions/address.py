"""Address -> (SIDO, SGG, SIDO_SGG) normalisation as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import (SEJONG_SGG, SEJONG_SIDO, VALID_SGG_SUFFIXES, VALID_SIDO,
                       alias_pairs)


def _sql_text(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


# The alias table as one SQL map literal: built in a single call instead of
# one call per key and value, and folded into the plan as a constant.
_ALIAS_MAP_SQL = "map(" + ", ".join(f"{_sql_text(a)}, {_sql_text(c)}" for a, c in alias_pairs()) + ")"


def _alias_map() -> Column:
    return F.expr(_ALIAS_MAP_SQL)


def first_token(addr: Column) -> Column:
    """split_part(addr, ' ', 1): text before the first blank ('' when the
    address starts with a blank, the whole text when it has none).
    substring_index gives the same value without building a split array."""
    return F.substring_index(addr, " ", 1)


def second_token(addr: Column) -> Column:
    """split_part(addr, ' ', 2): text between the first and second blank;
    '' when there is no blank, NULL for NULL input."""
    two = F.substring_index(F.substring_index(addr, " ", 2), " ", -1)
    return F.when(F.instr(addr, " ") == 0, F.lit("")).otherwise(two)


def canonical_sido(token: Column) -> Column:
    """Alias -> canonical province; unknown tokens pass through unchanged."""
    return F.coalesce(F.try_element_at(_alias_map(), token), token)


def sido_sgg(sido: Column, sgg: Column) -> Column:
    """TRIM(sido || ' ' || sgg), NULL when either side is NULL."""
    return F.trim(F.concat(sido, F.lit(" "), sgg))


def _token_sets() -> tuple[list[str], list[str]]:
    """First tokens that yield an accepted province, and those that yield
    the Sejong province, derived from the alias table: a token maps through
    the table when listed, otherwise it passes through unchanged."""
    amap = dict(alias_pairs())
    valid = set(VALID_SIDO)
    good = [a for a, c in amap.items() if c in valid] + [v for v in VALID_SIDO if v not in amap]
    sejong = [a for a, c in amap.items() if c == SEJONG_SIDO]
    if SEJONG_SIDO not in amap:
        sejong.append(SEJONG_SIDO)
    return good, sejong


def _ends_with_suffix(c: Column) -> Column:
    cond = None
    for suffix in VALID_SGG_SUFFIXES:
        e = c.endswith(suffix)
        cond = e if cond is None else (cond | e)
    return cond


def is_valid_tokens(t1: Column, t2: Column) -> Column:
    """Validity judged on the raw address tokens (same outcome as judging the
    normalised columns): the first token must map to an accepted province,
    and the district must end in an accepted suffix - always true for
    Sejong, whose district is forced to a fixed name.  Hash-set membership
    and a suffix test, so the filter stays cheap when pushed to the scan."""
    good, sejong = _token_sets()
    return t1.isin(*good) & (t1.isin(*sejong) | _ends_with_suffix(t2))


def is_valid_region(sido: Column, sgg: Column) -> Column:
    """Keep-form of the validity delete on normalised columns.

    The delete removes rows whose SIDO is NULL/''/unknown, or whose SGG is
    NULL/'' or ends in none of the accepted suffixes.  Its negation is
    "SIDO is a known province AND SGG ends in an accepted suffix"; both
    conjuncts are NULL (row dropped) when their input is NULL, and '' is
    neither a province nor suffix-terminated.
    """
    return sido.isin(*VALID_SIDO) & _ends_with_suffix(sgg)


_T1, _T2 = "__addr_t1", "__addr_t2"


def _with_tokens(df: DataFrame, addr_col: str) -> DataFrame:
    a = F.col(addr_col)
    return df.withColumns({_T1: first_token(a), _T2: second_token(a)})


def _region_from_tokens(df: DataFrame) -> DataFrame:
    """SIDO, SGG, SIDO_SGG from the token columns; each step is its own
    projection so the alias lookup runs once per row.

    The Sejong province has no districts, so its SGG is forced to one name
    (and SIDO_SGG rebuilt) before validity is judged."""
    out = df.withColumn("SIDO", canonical_sido(F.col(_T1)))
    is_sejong = F.col("SIDO") == F.lit(SEJONG_SIDO)
    out = out.withColumns({
        "SGG": F.when(is_sejong, F.lit(SEJONG_SGG)).otherwise(F.col(_T2)),
        "SIDO_SGG": F.when(is_sejong, F.concat(F.col("SIDO"), F.lit(" " + SEJONG_SGG)))
                     .otherwise(sido_sgg(F.col("SIDO"), F.col(_T2))),
    })
    return out.drop(_T1, _T2)


def with_region_columns(df: DataFrame, addr_col: str) -> DataFrame:
    """Add SIDO/SGG/SIDO_SGG (no filtering)."""
    return _region_from_tokens(_with_tokens(df, addr_col))


def normalize_and_filter(df: DataFrame, addr_col: str) -> DataFrame:
    """Add SIDO/SGG/SIDO_SGG from ``addr_col`` and drop invalid regions.
    Rows are filtered on the tokens first, so the region columns are only
    built for rows that are kept."""
    tok = _with_tokens(df, addr_col)
    kept = tok.filter(is_valid_tokens(F.col(_T1), F.col(_T2)))
    return _region_from_tokens(kept)
