"""Cross-company comparison of one measure (M39, H4-H6); the report of all measures is
``fundlake.plans.statistics``.

``compare_measure`` calls any measure by name for all tickers in scope and
returns it in long form keyed by ticker and date; ``compare_groups`` fills the series of every peer
group on the group's own dates; ``compare_wide`` pivots a given list of tickers to one column per ticker and value.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fundlake.functions.frequency import frequency_table
from fundlake.operators.flows import K
from fundlake.plans import balances, income, margins, market
from fundlake.plans.scope import companies as companies_of
from fundlake.plans.scope import scope as scope_of
from fundlake.sources.catalog import Tables

# Measures callable by name (the source tool looks them up as methods).
COMPANY_MEASURES = {
    "net_income": income.net_income, "ebit": income.ebit, "depre_amort": income.depre_amort,
    "ebitda": income.ebitda, "revenue": income.revenue, "cfo": income.cfo,
    "cash_equi": balances.cash_equi, "total_debt": balances.total_debt, "net_debt": balances.net_debt,
    "total_equity": balances.total_equity, "total_assets": balances.total_assets,
    "debt_to_equity": balances.debt_to_equity, "financial_leverage": balances.financial_leverage,
    "current_ratio": balances.current_ratio, "roe": margins.roe, "roa": margins.roa,
    "gross_profit_margin": margins.gross_profit_margin, "net_profit_margin": margins.net_profit_margin,
    "ebitda_margin": margins.ebitda_margin, "eps": market.eps,
}
TICKER_MEASURES = {
    "prices": market.prices, "total_shares": market.total_shares, "market_value": market.market_value,
    "price_earnings": market.price_earnings, "enterprise_value": market.enterprise_value,
    "ev_ebitda": market.ev_ebitda, "ev_ebit": market.ev_ebit, "bv_share": market.bv_share,
    "price_bv": market.price_bv,
}


#: Groups whose dates are sent to every task, at most.
FEW_GROUPS = 1_000


def _ticker_view(company_df: DataFrame, sc: DataFrame) -> DataFrame:
    return company_df.join(sc.select("ticker", *K), K).drop(*K)


def compare_measure(tables: Tables, measure: str, kwargs: dict | None = None, group="consolidated",
                    scope_df=None) -> DataFrame:
    """One measure for every ticker in scope: ticker, date, value columns."""
    kwargs = dict(kwargs or {})
    sc = scope_df if scope_df is not None else scope_of(tables, group)
    if measure in TICKER_MEASURES:
        return TICKER_MEASURES[measure](tables, scope_df=sc, **kwargs)
    if measure in COMPANY_MEASURES:
        co = companies_of(tables, group) if scope_df is None else \
            sc.select(*K, "freq", "last_statement_date").distinct()
        return _ticker_view(COMPANY_MEASURES[measure](tables, companies=co, **kwargs), sc)
    raise ValueError(f"unknown measure: {measure}")


def compare_common(long_df: DataFrame, n_tickers: int) -> DataFrame:
    """H5: rows on the dates where every compared ticker has every value."""
    values = [c for c in long_df.columns if c not in ("ticker", "date")]
    complete = F.lit(True)
    for c in values:
        complete = complete & F.col(c).isNotNull()
    ok = long_df.filter(complete)
    common = ok.groupBy("date").agg(F.countDistinct("ticker").alias("_n")).filter(F.col("_n") == n_tickers)
    return long_df.join(common.select("date"), "date", "left_semi")


def compare_filled(long_df: DataFrame, tickers: list[str]) -> DataFrame:
    """H4: the given tickers' series on the dates of all of them, gaps carried forward."""
    names = [(t.upper(),) for t in tickers]
    members = long_df.sparkSession.createDataFrame(names, "ticker string").withColumn("_all", F.lit(1))
    return compare_groups(long_df, members, ["_all"])


def compare_groups(long_df: DataFrame, members: DataFrame, by: list[str], parts: int | None = None) -> DataFrame:
    """H4 for many comparisons at once: every group's tickers on the dates of any of them, gaps carried forward.

    ``members`` holds tickers and the columns ``by``.  The dates of a group are one sorted list, bounded by the
    calendar.  Each row of a series gives the group's dates from its own to the next row's, so the filled rows, several
    times as many as the series', are made in place: no grid of dates x tickers is exchanged, joined or sorted.
    ``long_df`` is read twice.  ``parts`` is the number of tasks its rows are dealt to; without it Spark chooses.
    """
    values = [c for c in long_df.columns if c not in ("ticker", "date")]
    own = members.dropna(subset=by).groupBy("ticker", *by).agg(F.count(F.lit(1)).cast("int").alias("_copies"))
    dates = long_df.select("ticker", "date").join(own, "ticker").select(*by, "date").distinct()
    calendar = dates.groupBy(*by).agg(F.array_sort(F.collect_list("date")).alias("_dates"))
    if own.select(*by).distinct().limit(FEW_GROUPS + 1).count() <= FEW_GROUPS:
        calendar = F.broadcast(calendar)
    # a ticker without a row has its group's dates too, without values
    dealt = long_df if parts is None else long_df.repartition(parts, "ticker")
    rows = own.join(dealt, "ticker", "left").join(calendar, by)
    rows = rows.withColumn("_at", F.array_position("_dates", F.col("date"))).drop("_dates")
    in_order = Window.partitionBy("ticker", *by).orderBy("date")
    so_far = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.select("ticker", *by, "_copies", F.col("date").alias("_own"), "_at", F.lead("_at").over(in_order).alias("_next"),
                       (F.row_number().over(in_order) == 1).alias("_first"),
                       *[F.last(v, ignorenulls=True).over(so_far).alias(v) for v in values])
    begin = F.when(F.col("_first"), 1).otherwise(F.col("_at"))
    end = F.greatest(F.coalesce("_next", F.size("_dates") + 1), F.col("_at") + 1)  # rows of one date give it once each
    held = F.slice("_dates", begin.cast("int"), (end - begin).cast("int"))
    held = F.when(F.col("_copies") == 1, held).otherwise(F.flatten(F.array_repeat(held, F.col("_copies"))))
    filled = rows.join(calendar, by).select("ticker", F.explode(held).alias("date"), "_own", *values)
    return filled.select("ticker", "date", *[F.when(F.col("date") >= F.col("_own"), F.col(v)).alias(v) for v in values])


def is_regular(long_df: DataFrame, name: str) -> DataFrame:
    """H6: does the union of dates have a regular frequency (bar chart) or not (line)?"""
    dates = long_df.select(F.lit(name).alias("measure"), "date").distinct()
    # distinct dates are bounded by the calendar, whatever the number of tickers
    return frequency_table(dates, ["measure"]).select("measure", "n_dates", "is_regular")


def compare_wide(long_df: DataFrame, tickers: list[str]) -> DataFrame:
    """One row per date, one column ``"<value> <TICKER>"`` per given ticker and value."""
    tickers = [t.upper() for t in tickers]
    return _wide(long_df.filter(F.col("ticker").isin(*tickers)).withColumn("_label", F.col("ticker")), tickers)


def compare_wide_by(long_df: DataFrame, members: DataFrame, by: str) -> DataFrame:
    """One row per date, one column ``"<value> <group>"`` per group and value, each group shown by the one ticker that
    ``members`` (ticker, by) names.  The driver reads the groups' names to name the columns."""
    labels = sorted(r[0] for r in members.select(by).distinct().collect())
    return _wide(long_df.join(members.select("ticker", F.col(by).alias("_label")), "ticker"), labels)


def _wide(rows: DataFrame, labels: list[str]) -> DataFrame:
    values = [c for c in rows.columns if c not in ("ticker", "date", "_label")]
    wide = rows.groupBy("date").pivot("_label", labels).agg(*[F.first(v).alias(v) for v in values])
    name = {(f"{t}_{v}" if len(values) > 1 else t): f"{v} {t}" for t in labels for v in values}
    return wide.select("date", *[F.col(f"`{s}`").alias(d) for s, d in name.items()])


def compare_common_all(tables: Tables, measure: str, kwargs: dict | None = None, group="consolidated") -> DataFrame:
    """H5 over every ticker in scope (the ticker count is one number on the driver)."""
    sc = scope_of(tables, group)
    return compare_common(compare_measure(tables, measure, kwargs, scope_df=sc), sc.count())
