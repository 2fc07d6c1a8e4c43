"""Returns and margins.

Margins put two or three statement lines side by side on the same report
date.  The lines of one or two tables are put into one frame, which is hash
partitioned on the company key once; a conditional aggregation or a window
per date brings them side by side inside that partitioning, without a
further exchange.  Returns (roe, roa) meet the balance of a date in the same way.

Ratios are percentages.  A zero divisor gives NULL (``try_divide``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fundlake.operators.flows import (K, company_window, lines_beside, not_annual, prefer_label, quarter_value,
                                      statement_rows, trailing_sum, trim_to_begin)
from fundlake.plans import balances, income
from fundlake.plans.scope import companies as companies_of
from fundlake.sources.catalog import Tables

def _hundred():
    return F.lit(100).cast("double")


def pct(num, den):
    return F.try_divide(num.cast("double"), den.cast("double")) * _hundred()


def _co(tables, group, companies):
    return companies if companies is not None else companies_of(tables, group)


def _return_on(tables, table: str, balance, name: str, start_period, group, companies) -> DataFrame:
    """TTM net income over a balance of the same date, on the dates both exist.

    Income and balance lines are one frame; the balances of a date are put beside its income
    lines by a window inside the partitioning on the company key.
    """
    co = _co(tables, group, companies)
    cols = [*K, "dt_fim_exerc", "cd_conta", "ds_conta", "vl_conta"]
    lines = (tables.dre.filter(F.col("ds_conta").isin(*income.NET_INCOME_LABELS)).select(*cols, "fiscal_quarter", F.lit("dre").alias("line"))
             .unionByName(tables.get(table).filter(balance)
                          .select(*cols, F.lit(None).cast("int").alias("fiscal_quarter"), F.lit("balance").alias("line"))))
    rows = statement_rows(lines, F.lit(True), co, start_period, bucketed=tables.bucketed,
                          columns=("line", "fiscal_quarter", "cd_conta", "ds_conta", F.col("vl_conta").alias("ytd")))
    below = F.when((F.col("line") == "balance") & (F.col("date") >= F.col("begin")), F.struct(F.col("ytd").alias("v")))
    rows = rows.withColumn("_below", F.collect_list(below).over(Window.partitionBy(*K, "date")))
    rows = prefer_label(rows.filter(F.col("line") == "dre"), *income.NET_INCOME_LABELS)
    w = company_window(["date", "cd_conta"])
    rows = rows.withColumn("_q", quarter_value(F.col("ytd"), F.col("fiscal_quarter"), w))
    rows = rows.withColumn("_t", not_annual(trailing_sum("_q", w)))
    out = trim_to_begin(rows).withColumn("_b", F.explode("_below"))
    return out.select(*K, "date", pct(F.col("_t"), F.col("_b.v")).alias(name)).dropna(subset=[name])


def roe(tables: Tables, start_period="all", group="consolidated", companies=None) -> DataFrame:
    """TTM net income / equity x 100 on the dates both exist."""
    return _return_on(tables, "bpp", F.col("ds_conta").isin(*balances.EQUITY_LABELS), "roe", start_period, group, companies)


def roa(tables: Tables, start_period="all", group="consolidated", companies=None) -> DataFrame:
    """TTM net income / total assets x 100 on the dates both exist."""
    return _return_on(tables, "bpa", F.col("cd_conta") == balances.TOTAL_ASSETS_CODE, "roa", start_period, group, companies)


def _select(df, name, quarter, ytd, ttm):
    cols = [*K, "date"]
    if ytd:
        cols.append(f"ytd_{name}")
    if quarter:
        cols.append(name)
    if ttm:
        cols.append(f"ttm_{name}")
    return df.select(*cols)


def _two_line_margin(rows: DataFrame, name: str, quarter, ytd, ttm, order=("date",)) -> DataFrame:
    """rows: K, date, fiscal_quarter, freq, begin, num (ytd), den (ytd revenue)."""
    w = company_window(list(order))
    fq = F.col("fiscal_quarter")
    rows = (rows.withColumn("_qn", quarter_value(F.col("num"), fq, w))
                .withColumn("_qd", quarter_value(F.col("den"), fq, w)))
    rows = rows.withColumn("_tn", trailing_sum("_qn", w)).withColumn("_td", trailing_sum("_qd", w))
    out = trim_to_begin(rows).select(
        *K, "date",
        pct(F.col("num"), F.col("den")).alias(f"ytd_{name}"),
        not_annual(pct(F.col("_qn"), F.col("_qd"))).alias(name),
        not_annual(pct(F.col("_tn"), F.col("_td"))).alias(f"ttm_{name}"),
    )
    return _select(out, name, quarter, ytd, ttm)


def gross_profit_margin(tables: Tables, quarter=True, ytd=True, ttm=True, start_period="all",
                        group="consolidated", companies=None) -> DataFrame:
    """Gross profit (3.03) over revenue (3.01) as ytd, quarter and ttm ratios."""
    co = _co(tables, group, companies)
    rows = statement_rows(tables.dre, F.col("cd_conta").isin(income.GROSS_PROFIT_CODE, income.REVENUE_CODE), co,
                          start_period, columns=("fiscal_quarter", "cd_conta", "vl_conta"), bucketed=tables.bucketed)
    cd = F.col("cd_conta")
    side = (rows.groupBy(*K, "date", "freq", "begin").agg(
        F.max(F.when(cd == income.GROSS_PROFIT_CODE, F.col("fiscal_quarter"))).alias("fiscal_quarter"),
        F.max(F.when(cd == income.GROSS_PROFIT_CODE, F.col("vl_conta"))).alias("num"),
        F.max(F.when(cd == income.REVENUE_CODE, F.col("vl_conta"))).alias("den"))
        .filter(F.col("num").isNotNull() & F.col("den").isNotNull()))
    return _two_line_margin(side, "gross_profit_margin", quarter, ytd, ttm)


def net_profit_margin(tables: Tables, quarter=True, ytd=True, ttm=True, start_period="all",
                      group="consolidated", companies=None) -> DataFrame:
    """Net income over revenue (3.01) as ytd, quarter and ttm ratios.

    Net income follows the label rule of ``net_income`` (continuing
    operations, else profit for the period), decided on the rows that have
    a revenue line on the same date.
    """
    co = _co(tables, group, companies)
    ni, revenue = F.col("ds_conta").isin(*income.NET_INCOME_LABELS), F.col("cd_conta") == income.REVENUE_CODE
    rows = statement_rows(tables.dre, ni | revenue, co, start_period,
                          columns=("fiscal_quarter", "cd_conta", "ds_conta", F.col("vl_conta").alias("num")),
                          bucketed=tables.bucketed)
    rows = prefer_label(lines_beside(rows, ni, den=(revenue, F.col("num"))), *income.NET_INCOME_LABELS)
    return _two_line_margin(rows, "net_profit_margin", quarter, ytd, ttm, order=("date", "cd_conta"))


def ebitda_margin(tables: Tables, quarter=True, ytd=True, ttm=True, start_period="all",
                  group="consolidated", companies=None) -> DataFrame:
    """EBITDA (EBIT - D&A) over revenue as ytd, quarter and ttm ratios."""
    co = _co(tables, group, companies)
    ebit, revenue = F.col("ds_conta").isin(*income.EBIT_LABELS), F.col("cd_conta") == income.REVENUE_CODE
    lines = income.two_tables(tables, ebit | revenue)
    rows = statement_rows(lines, F.lit(True), co, start_period,
                          columns=("line", "fiscal_quarter", "cd_conta", "ds_conta", F.col("vl_conta").alias("ytd_ebit")),
                          bucketed=tables.bucketed)
    dre = F.col("line") == "dre"
    rows = lines_beside(rows, dre & ebit, ytd_d_a=(~dre, F.col("ytd_ebit")), ytd_revenue=(dre & revenue, F.col("ytd_ebit")))
    rows = prefer_label(rows, *income.EBIT_LABELS)
    w = company_window(["date", "cd_conta"])
    fq = F.col("fiscal_quarter")
    rows = (rows.withColumn("_qr", quarter_value(F.col("ytd_revenue"), fq, w))
                .withColumn("_qe", quarter_value(F.col("ytd_ebit"), fq, w))
                .withColumn("_qd", quarter_value(F.col("ytd_d_a"), fq, w)))
    rows = rows.withColumn("_q", F.col("_qe") - F.col("_qd"))
    rows = rows.withColumn("_tq", trailing_sum("_q", w)).withColumn("_tr", trailing_sum("_qr", w))
    out = trim_to_begin(rows).select(
        *K, "date",
        pct(F.col("ytd_ebit") - F.col("ytd_d_a"), F.col("ytd_revenue")).alias("ytd_ebitda_margin"),
        not_annual(pct(F.col("_q"), F.col("_qr"))).alias("ebitda_margin"),
        not_annual(pct(F.col("_tq"), F.col("_tr"))).alias("ttm_ebitda_margin"),
    )
    return _select(out, "ebitda_margin", quarter, ytd, ttm)
