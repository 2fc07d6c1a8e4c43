"""Column expressions for dates and periods (start period, look-back, fiscal quarter)."""

from __future__ import annotations

import datetime as _dt

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

ALL_BEGIN = _dt.date(1900, 1, 1)

# 'last' is resolved per company/ticker: newest price date for these
# functions, newest income-statement date for every other one.
PRICE_FUNCTIONS = ("prices", "total_shares", "market_value")


def parse_start(start_period) -> _dt.date | str:
    """'all' -> 1900-01-01; 'last' stays symbolic; text or datetime -> date.

    Bad text raises ``ValueError``.
    """
    if isinstance(start_period, str) and start_period in ("all", "last"):
        return ALL_BEGIN if start_period == "all" else "last"
    if isinstance(start_period, _dt.datetime):
        return start_period.date()
    if isinstance(start_period, _dt.date):
        return start_period
    try:
        return pd.Timestamp(start_period).date()
    except (ValueError, TypeError) as exc:
        raise ValueError("start_period must be 'last', 'all', or a date formatted as 'YYYY-MM-DD'.") from exc


def begin_column(start_period, function: str = "statement",
                 last_price: str = "last_price_date", last_statement: str = "last_statement_date") -> Column:
    """The begin date of a measure as a column of the scope table.

    A Column is taken as it is (a begin already derived per company).
    """
    if isinstance(start_period, Column):
        return start_period
    p = parse_start(start_period)
    if p == "last":
        return F.col(last_price if function in PRICE_FUNCTIONS else last_statement)
    return F.lit(p)


def shift_start(start_period, months: int):
    """A dated start moved by ``months``; 'all' and 'last' are kept as they are."""
    if isinstance(start_period, Column):
        return F.add_months(start_period, months)
    p = parse_start(start_period)
    if p == "last" or (isinstance(start_period, str) and start_period == "all"):
        return start_period
    return (pd.Timestamp(p) + pd.DateOffset(months=months)).date()


def fiscal_quarter(end: Column, begin: Column) -> Column:
    """Months covered by a year-to-date report, divided by 3 (may be fractional)."""
    months = (F.year(end) - F.year(begin)) * 12 + (F.month(end) - F.month(begin))
    return (months + 1) / F.lit(3).cast("double")


def currency_scale(value: Column, scale: Column) -> Column:
    """Reports in units are divided by 1000 so every value is in thousands."""
    return F.when(scale == "UNIDADE", value / F.lit(1000).cast("double")).otherwise(value.cast("double"))
