"""Balance-sheet measures.

Balances are point-in-time, so there is no look-back and no window: each
measure is a filter pushed to the Parquet scan, a join to the companies
in scope and, where accounts are added up, an aggregation per company and
date (partial aggregation happens before the shuffle).  Measures of two
balances stack them and meet by an aggregation per company and date; over tables
bucketed by company that needs no exchange at all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fundlake.functions.periods import begin_column
from fundlake.operators.asof import beside
from fundlake.operators.flows import K
from fundlake.plans.scope import companies as companies_of
from fundlake.sources.catalog import Tables

# Fixed account labels and codes.
CASH_LABELS = ("Caixa e Equivalentes de Caixa", "Aplicações Financeiras")
CASH_EXCLUDED_CODE = "1.02.01.03.01"
DEBT_LABEL = "Empréstimos e Financiamentos"
DEBT_CODES = ("2.01.04", "2.02.01")
EQUITY_LABELS = ("Patrimônio Líquido", "Patrimônio Líquido Consolidado")
TOTAL_ASSETS_CODE = "1"
CURRENT_ASSETS_LABEL = "Ativo Circulante"
CURRENT_LIABILITIES_LABEL = "Passivo Circulante"


def _co(tables, group, companies):
    return companies if companies is not None else companies_of(tables, group)


def balance_rows(source: DataFrame, predicate: Column, companies: DataFrame, start_period) -> DataFrame:
    rows = source.filter(predicate).select(*K, F.col("dt_fim_exerc").alias("date"), "cd_conta", "ds_conta", "vl_conta")
    co = companies.select(*K, begin_column(start_period).alias("begin"))
    return rows.join(co, K).filter(F.col("date") >= F.col("begin"))


def _summed(tables, table, predicate, name, start_period, group, companies) -> DataFrame:
    rows = balance_rows(tables.get(table), predicate, _co(tables, group, companies), start_period)
    return rows.groupBy(*K, "date").agg(F.sum("vl_conta").alias(name))


def cash_equi(tables: Tables, start_period="all", group="consolidated", companies=None) -> DataFrame:
    pred = F.col("ds_conta").isin(*CASH_LABELS) & (F.col("cd_conta") != CASH_EXCLUDED_CODE)
    return _summed(tables, "bpa", pred, "cash_equi", start_period, group, companies)


def total_debt(tables: Tables, start_period="all", group="consolidated", companies=None) -> DataFrame:
    pred = (F.col("ds_conta") == DEBT_LABEL) & F.col("cd_conta").isin(*DEBT_CODES)
    return _summed(tables, "bpp", pred, "total_debt", start_period, group, companies)


def total_equity(tables: Tables, start_period="all", group="consolidated", companies=None) -> DataFrame:
    rows = balance_rows(tables.bpp, F.col("ds_conta").isin(*EQUITY_LABELS), _co(tables, group, companies),
                        start_period)
    return rows.select(*K, "date", F.col("vl_conta").alias("total_equity"))


def total_assets(tables: Tables, start_period="all", group="consolidated", companies=None) -> DataFrame:
    rows = balance_rows(tables.bpa, F.col("cd_conta") == TOTAL_ASSETS_CODE, _co(tables, group, companies),
                        start_period)
    return rows.select(*K, "date", F.col("vl_conta").alias("total_assets"))


def net_debt(tables: Tables, start_period="all", group="consolidated", companies=None) -> DataFrame:
    """Debt minus cash on the union of their dates; NULL where one is missing."""
    co = _co(tables, group, companies)
    return beside(total_debt(tables, start_period, companies=co), cash_equi(tables, start_period, companies=co), K, "net_debt",
                  lambda d, c: d - c)


def debt_to_equity(tables: Tables, start_period="all", group="consolidated", companies=None) -> DataFrame:
    co = _co(tables, group, companies)
    debt, eq = total_debt(tables, start_period, companies=co), total_equity(tables, start_period, companies=co)
    return beside(debt, eq, K, "debt_to_equity", lambda d, e: F.try_divide(d.cast("double"), e))


def financial_leverage(tables: Tables, start_period="all", group="consolidated", companies=None) -> DataFrame:
    co = _co(tables, group, companies)
    assets, eq = total_assets(tables, start_period, companies=co), total_equity(tables, start_period, companies=co)
    return beside(assets, eq, K, "financial_leverage", lambda a, e: F.try_divide(a.cast("double"), e))


def current_ratio(tables: Tables, start_period="all", group="consolidated", companies=None) -> DataFrame:
    """Current assets / current liabilities on the dates both exist."""
    co = _co(tables, group, companies)
    lines = [balance_rows(tables.get(table), F.col("ds_conta") == label, co, start_period)
             .select(*K, "date", F.col("vl_conta").cast("double").alias(name))
             for table, label, name in (("bpa", CURRENT_ASSETS_LABEL, "assets"), ("bpp", CURRENT_LIABILITIES_LABEL, "liabilities"))]
    return beside(*lines, K, "current_ratio", F.try_divide, both=True)
