"""Lenient coercions (bad input -> NULL, never an exception)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_double(c: Column) -> Column:
    return c.cast("string").try_cast("double")


def value_kind(c: Column) -> Column:
    """'null' / 'number' / 'text' class of a mixed text column."""
    return (F.when(c.isNull(), F.lit("null"))
            .when(c.cast("string").try_cast("double").isNotNull(), F.lit("number"))
            .otherwise(F.lit("text")))


def fill_missing(c: Column, token: str = "MISSING") -> Column:
    return F.coalesce(c.cast("string"), F.lit(token))


def split_range(c: Column, sep: str = "~") -> tuple[Column, Column]:
    """'a~b' -> (a, b).  Without a separator the whole text is the start and
    the end is NULL; NULL gives (NULL, NULL)."""
    start = F.split_part(c, F.lit(sep), F.lit(1))
    end = F.when(F.instr(c, sep) > 0, F.split_part(c, F.lit(sep), F.lit(2)))
    return start, end


#: Amounts are summed with so many digits.
EXACT = "decimal(24,6)"


def exact_sum(value: str | Column) -> Column:
    """A sum that is the same in any order of rows and under any cut into
    parts: six decimals are kept.  A value that is not finite, or has more
    than 18 digits before the point, counts as missing.  It stays a decimal;
    cast it once, after the last addition."""
    c = F.col(value) if isinstance(value, str) else value
    return F.sum(c.try_cast(EXACT))


def human_size(nbytes: Column) -> Column:
    kb, mb, gb = 1024, 1024 ** 2, 1024 ** 3
    return (F.when(nbytes < kb, F.format_string("%d Bytes", nbytes))
            .when(nbytes < mb, F.format_string("%.2f KB", nbytes / F.lit(kb)))
            .when(nbytes < gb, F.format_string("%.2f MB", nbytes / F.lit(mb)))
            .otherwise(F.format_string("%.2f GB", nbytes / F.lit(gb))))
