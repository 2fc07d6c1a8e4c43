"""The tables behind the source tool's charts (H1-H3); drawing is not built.

* ``bs_composition``: balance-sheet accounts at the third level (7-character
  codes) that are not zero on every date, split into assets (code starting
  with 1) and liabilities and equity (2).
* ``account_seasonality``: one income-statement account by value type,
  year and month (the chart is a month x year grid per value type).
* ``series_summary``: a daily series with its mean and median, taken
  before gaps are carried forward.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fundlake.operators.asof import forward_fill
from fundlake.operators.flows import K
from fundlake.plans import market, statements
from fundlake.sources.catalog import Tables


def bs_composition(tables: Tables, start_period="all", **kw) -> DataFrame:
    bs = statements.balance_sheet(tables, start_period, **kw)
    acct = Window.partitionBy(*K, "cd_conta")
    kept = (bs.filter(F.length("cd_conta") == 7)
              .withColumn("_nz", F.max(F.abs(F.col("vl_conta"))).over(acct))
              .filter(F.col("_nz") > 0))
    side = F.when(F.substring("cd_conta", 1, 1) == "1", "assets") \
            .when(F.substring("cd_conta", 1, 1) == "2", "liabilities_equity")
    return (kept.select(*K, "cd_conta", "ds_conta", "date", "vl_conta", side.alias("side"))
                .filter(F.col("side").isNotNull()))


def account_seasonality(tables: Tables, cd_conta: str, start_period="all", **kw) -> DataFrame:
    ist = statements.income_statement(tables, start_period=start_period, **kw).filter(F.col("cd_conta") == cd_conta)
    types = ["ytd", "quarter_value", "ttm_value"]
    acct = Window.partitionBy(*K, "cd_conta")
    nz = F.greatest(*[F.max(F.abs(F.coalesce(F.col(t), F.lit(0)))).over(acct) for t in types])
    ist = ist.withColumn("_nz", nz).filter(F.col("_nz") > 0)
    melted = ist.select(*K, "cd_conta", "ds_conta", "date",
                        F.inline(F.array(*[F.struct(F.lit(t).alias("value_type"), F.col(t).alias("value"))
                                           for t in types])))
    return melted.filter(F.col("value").isNotNull()).select(
        *K, "cd_conta", "ds_conta", "value_type",
        F.year("date").alias("year"), F.month("date").alias("month"), "value")


def series_summary(tables: Tables, start_period="all", **kw) -> DataFrame:
    """Market value per ticker with mean and median of the unfilled series."""
    mv = market.market_value(tables, start_period, **kw)
    stats = mv.groupBy("ticker").agg(F.avg("market_value").alias("mean"),
                                     F.median("market_value").alias("median"))
    filled = forward_fill(mv, ["ticker"], ["market_value"])
    return filled.join(stats, "ticker")
