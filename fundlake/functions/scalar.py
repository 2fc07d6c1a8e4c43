"""Scalar functions used across the engine, as Column builders.

All are built-in Spark expressions, evaluated inside whole-stage codegen:
no Python runs per row.  ANSI mode is on in Spark 4, so every operation
that can fail on bad input uses its ``try_`` form and yields NULL instead.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MEAN_YEAR_DAYS = 365.2425


def word(col: Column, n: int, sep: str = " ") -> Column:
    """n-th word (1-based); NULL when there are fewer words."""
    return F.try_element_at(F.split(col, sep), F.lit(n))


def last_char(col: Column) -> Column:
    return F.substring(col, -1, 1)


def prefix(col: Column, n: int) -> Column:
    return F.substring(col, 1, n)


def parse_compact_date(col: Column) -> Column:
    """'yyyyMMdd' text -> date (NULL when malformed)."""
    return F.try_to_timestamp(col, F.lit("yyyyMMdd")).cast("date")


def span_years(end: Column, start: Column) -> Column:
    """Distance in mean years of 365.2425 days."""
    return F.datediff(end, start) / F.lit(MEAN_YEAR_DAYS)


def ratio(num: Column, den: Column) -> Column:
    """Division that gives NULL for a zero or missing divisor."""
    return F.try_divide(num.cast("double"), den.cast("double"))
