"""Code labels and lookups expressed as Column expressions."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import ACTIVITY_LABEL_OTHER, ACTIVITY_LABELS, ISO_3166_2


def activity_label(code: Column) -> Column:
    expr = None
    for k, label in ACTIVITY_LABELS.items():
        expr = (F.when(code == F.lit(k), F.lit(label)) if expr is None
                else expr.when(code == F.lit(k), F.lit(label)))
    return expr.otherwise(F.lit(ACTIVITY_LABEL_OTHER))


def iso_code(sido: Column) -> Column:
    m = F.create_map(*chain.from_iterable((F.lit(k), F.lit(v)) for k, v in ISO_3166_2.items()))
    return F.try_element_at(m, sido)


def numeric_code(c: Column) -> Column:
    """Code text compared against a numeric column: numeric value, or NULL
    when the text is not a number (never raises under ANSI)."""
    return c.try_cast("double")
