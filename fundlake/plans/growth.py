"""Compound annual growth of ttm net income and revenue.

The window starts ``n_years`` before the company's newest income-statement
date; growth is taken between the first and the last ttm value of that
window, whatever their true distance (the exponent is 1 / n_years).  A
negative or zero ratio, an annual-only reporter or a zero first value
gives NULL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fundlake.operators.flows import K
from fundlake.plans import income
from fundlake.plans.scope import companies as companies_of
from fundlake.sources.catalog import Tables


def yearly_rate(first: Column, last: Column, n_years: int) -> Column:
    """Growth per year in percent between two values; NULL where it is no real number."""
    ratio = F.try_divide(last.cast("double"), first.cast("double"))
    rate = (F.pow(ratio, F.lit(1.0 / n_years)) - F.lit(1).cast("double")) * F.lit(100).cast("double")
    return F.when(~F.isnan(rate), rate)


def cagr(series: DataFrame, value: str, n_years: int, name: str) -> DataFrame:
    """First and last value per company by date, then the yearly rate."""
    ends = series.groupBy(*K).agg(F.min_by(value, "date").alias("_first"), F.max_by(value, "date").alias("_last"))
    return ends.select(*K, yearly_rate(F.col("_first"), F.col("_last"), n_years).alias(name))


def _cagr(tables, measure, col, name, n_years, group, companies):
    co = companies if companies is not None else companies_of(tables, group)
    start = F.add_months(F.col("last_statement_date"), -12 * n_years)
    s = measure(tables, quarter=False, ytd=False, ttm=True, start_period=start, companies=co)
    return cagr(s, col, n_years, name)


def cagr_net_income(tables: Tables, n_years: int = 5, group="consolidated", companies=None) -> DataFrame:
    return _cagr(tables, income.net_income, "ttm_net_income", "cagr_net_income", n_years, group, companies)


def cagr_revenue(tables: Tables, n_years: int = 5, group="consolidated", companies=None) -> DataFrame:
    return _cagr(tables, income.revenue, "ttm_revenue", "cagr_revenue", n_years, group, companies)
