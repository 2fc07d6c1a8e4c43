"""Price-based measures.

Daily prices are keyed by ticker; statement measures by company.  Company
series (shares outstanding, market value) are built once per company from
the prices of its ON and PN tickers and joined to the tickers in scope.
Statement values are carried forward onto trading days by ``asof_merge``.

Units: statements are in thousands, prices and share counts in units, so
EPS and book value per share are multiplied by 1000, EV adds net debt
times 1000 and EV multiples are divided by 1000.

'last' resolves per ticker to its newest price date for prices, total
shares and market value, and to the company's newest income-statement
date for everything else.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fundlake.functions.periods import begin_column, parse_start, shift_start
from fundlake.operators.asof import aligned, asof_merge
from fundlake.operators.flows import K
from fundlake.plans import balances, income
from fundlake.plans.scope import companies as companies_of
from fundlake.plans.scope import scope as scope_of
from fundlake.plans.scope import share_classes
from fundlake.sources.catalog import Tables

def _thousand():
    return F.lit(1000).cast("double")


def _scope(tables, group, scope_df):
    return scope_df if scope_df is not None else scope_of(tables, group)


def _companies(tables, group, scope_df):
    """The companies of the given scope, so a scope and its companies can never be of different groups."""
    if scope_df is None:
        return companies_of(tables, group)
    return scope_df.select(*K, "freq", "last_statement_date").distinct()


def _is_last(start_period) -> bool:
    return isinstance(start_period, str) and start_period == "last"


def from_least(rows: DataFrame, begins: DataFrame, column: str) -> DataFrame:
    """Rows from the least begin on.  That one date is read from the small scope table and
    given as a literal, so it reaches the scan and skips the files of earlier years."""
    least = begins.agg(F.min(column)).first()[0]
    return rows if least is None else rows.filter(F.col("date") >= F.lit(least))


def prices(tables: Tables, start_period="all", group="consolidated", scope_df=None) -> DataFrame:
    """Closing price of every ticker in scope from its begin date."""
    sc = _scope(tables, group, scope_df).select(
        "ticker", begin_column(start_period, "prices").alias("begin"))
    p = tables.prices.select("ticker", "date", F.col("preult").alias("price"))
    if _is_last(start_period):
        p = from_least(p, sc, "begin")
    return p.join(sc, "ticker").filter(F.col("date") >= F.col("begin")).select("ticker", "date", "price")


def share_members(tables: Tables) -> DataFrame:
    """ticker -> company, share class and whether the company has a PN class (small)."""
    cls = share_classes(tables)
    has_pn = F.col("pn_ticker").isNotNull()
    on = cls.select(F.col("on_ticker").alias("ticker"), "cnpj", F.lit("ON").alias("cls"), has_pn.alias("has_pn"))
    pn = cls.filter(has_pn).select(F.col("pn_ticker").alias("ticker"), "cnpj", F.lit("PN").alias("cls"),
                                   F.lit(True).alias("has_pn"))
    return on.unionByName(pn)


def company_daily(tables: Tables, since: DataFrame | None = None) -> DataFrame:
    """Per company and day, in one aggregation over the prices of its ON and PN tickers.

    ``since`` (cnpj, since) drops earlier days before the aggregation, so a
    measure that starts late does not aggregate the whole history.

    * ``total_shares``: ON shares plus PN shares (0 when PN has no row that
      day; ON only when the company has no PN class); only days with an ON
      row carry shares (``_has_on``);
    * ``market_value``: sum of price x shares over both classes.
    """
    p = tables.prices.select("ticker", "date", "preult", "number_shares")
    if since is not None:
        p = from_least(p, since, "since")
    p = p.join(share_members(tables), "ticker")
    if since is not None:
        p = p.join(since, "cnpj").filter(F.col("date") >= F.col("since")).drop("since")
    on = F.col("cls") == "ON"
    agg = p.groupBy("cnpj", "date").agg(
        F.max(on.cast("int")).alias("_has_on"),
        F.max(F.when(on, F.col("number_shares"))).alias("_on"),
        F.max(F.when(~on, F.col("number_shares"))).alias("_pn"),
        F.max("has_pn").alias("_has_pn"),
        F.sum(F.col("preult") * F.col("number_shares")).alias("market_value"))
    total = F.when(F.col("_has_pn"), F.col("_on") + F.coalesce(F.col("_pn"), F.lit(0))).otherwise(F.col("_on"))
    return agg.select("cnpj", "date", "_has_on", total.alias("total_shares"), "market_value")


def company_shares(tables: Tables, since: DataFrame | None = None) -> DataFrame:
    """Per company and day with an ON quote: shares outstanding over both classes."""
    return company_daily(tables, since).filter(F.col("_has_on") == 1).select("cnpj", "date", "total_shares")


def _since(start_period, sc_begin: DataFrame) -> DataFrame | None:
    """Per company, the earliest begin over its tickers; None when nothing is cut ('all')."""
    if isinstance(start_period, str) and start_period == "all":
        return None
    return sc_begin.groupBy("cnpj").agg(F.min("begin").alias("since"))


def total_shares(tables: Tables, start_period="all", group="consolidated", scope_df=None) -> DataFrame:
    sc = _scope(tables, group, scope_df).select(
        "ticker", "cnpj", begin_column(start_period, "total_shares").alias("begin"))
    return (company_shares(tables, _since(start_period, sc)).join(sc, "cnpj").filter(F.col("date") >= F.col("begin"))
            .select("ticker", "date", "total_shares"))


def company_market_value(tables: Tables, since: DataFrame | None = None) -> DataFrame:
    """Per company and day: sum of price x shares over its ON and PN tickers."""
    return company_daily(tables, since).select("cnpj", "date", "market_value")


def market_value(tables: Tables, start_period="all", group="consolidated", scope_df=None) -> DataFrame:
    sc = _scope(tables, group, scope_df).select(
        "ticker", "cnpj", begin_column(start_period, "market_value").alias("begin"))
    return (company_market_value(tables, _since(start_period, sc)).join(sc, "cnpj")
            .filter(F.col("date") >= F.col("begin"))
            .select("ticker", "date", "market_value"))


def eps(tables: Tables, start_period="all", group="consolidated", companies=None) -> DataFrame:
    """TTM net income x 1000 / total shares, statement values carried onto trading days.

    Reads from begin - 7 months so the first days after begin already have
    a statement; with 'last' only the newest row per company is kept.
    """
    co = companies if companies is not None else companies_of(tables, group)
    co = co.withColumn("_b", begin_column(start_period, "eps")).withColumn("_b7", F.add_months(F.col("_b"), -7))
    ni = income.net_income(tables, quarter=False, ytd=False, start_period=F.col("_b7"), companies=co)
    since = None if (isinstance(start_period, str) and start_period == "all") else \
        co.select("cnpj", F.col("_b7").alias("since"))
    sh = (company_shares(tables, since).join(co.select("cnpj", "grupo_dfp", "_b7"), "cnpj")
          .filter(F.col("date") >= F.col("_b7")).select(*K, "date", "total_shares"))
    m = asof_merge(sh, ni, keys=K, parts=tables.parts)
    m = m.withColumn("eps", F.try_divide((F.col("ttm_net_income") * 1000).cast("double"), F.col("total_shares")))
    m = m.join(co.select(*K, "_b"), K)
    if _is_last(start_period):
        w = Window.partitionBy(*K).orderBy(F.col("date").desc())
        m = m.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1)
    else:
        m = m.filter(F.col("date") >= F.col("_b"))
    return m.select(*K, "date", "eps").dropna(subset=["eps"])


def _per_ticker(company_df: DataFrame, sc: DataFrame) -> DataFrame:
    """Attach company-level series to every ticker of the company."""
    return company_df.join(sc.select("ticker", *K), K).drop(*K)


def price_earnings(tables: Tables, start_period="all", group="consolidated", scope_df=None) -> DataFrame:
    """Price / EPS on the union of price and EPS dates; NULL where one is missing."""
    sc = _scope(tables, group, scope_df)
    co = _companies(tables, group, scope_df)
    p = prices(tables, start_period, scope_df=sc)
    e = _per_ticker(eps(tables, start_period, companies=co), sc)
    return aligned(p, e, ["ticker"], "p_e", lambda a, b: F.try_divide(a, b))


def enterprise_value(tables: Tables, start_period="all", group="consolidated", scope_df=None) -> DataFrame:
    """Market value + net debt x 1000, net debt (from begin - 7 months) carried onto trading days."""
    sc = _scope(tables, group, scope_df)
    co = _companies(tables, group, scope_df)
    mv = market_value(tables, start_period, scope_df=sc)
    nd = _per_ticker(balances.net_debt(tables, shift_start(start_period, -7), companies=co), sc)
    m = asof_merge(mv, nd, keys=["ticker"], parts=tables.parts)
    return (m.select("ticker", "date", (F.col("market_value") + F.col("net_debt") * 1000).alias("ev"))
            .dropna(subset=["ev"]))


def _ev_multiple(tables, start_period, group, scope_df, measure, col, name):
    """EV / ttm flow / 1000, the flow carried onto trading days.

    One three-way as-of merge of market value, net debt and the flow: at every date the
    carried market value and net debt give the same EV as carrying the EV series itself.
    """
    sc = _scope(tables, group, scope_df)
    co = _companies(tables, group, scope_df)
    early = shift_start(start_period, -7)
    f = _per_ticker(measure(tables, quarter=False, ytd=False, start_period=early, companies=co), sc)
    mv = market_value(tables, start_period, scope_df=sc)
    nd = _per_ticker(balances.net_debt(tables, early, companies=co), sc)
    m = asof_merge(mv, nd, f, keys=["ticker"], parts=tables.parts)
    ev = F.col("market_value") + F.col("net_debt") * 1000
    return (m.select("ticker", "date", (F.try_divide(ev, F.col(col)) / _thousand()).alias(name))
            .dropna(subset=[name]))


def ev_ebitda(tables: Tables, start_period="all", group="consolidated", scope_df=None) -> DataFrame:
    return _ev_multiple(tables, start_period, group, scope_df, income.ebitda, "ttm_ebitda", "ev_ebitda")


def ev_ebit(tables: Tables, start_period="all", group="consolidated", scope_df=None) -> DataFrame:
    return _ev_multiple(tables, start_period, group, scope_df, income.ebit, "ttm_ebit", "ev_ebit")


def bv_share(tables: Tables, start_period="all", group="consolidated", scope_df=None) -> DataFrame:
    """Equity x 1000 / total shares, equity carried onto trading days."""
    sc = _scope(tables, group, scope_df)
    co = _companies(tables, group, scope_df)
    sh = total_shares(tables, start_period, scope_df=sc)
    eq = _per_ticker(balances.total_equity(tables, shift_start(start_period, -7), companies=co), sc)
    m = asof_merge(sh, eq, keys=["ticker"], parts=tables.parts)
    return (m.select("ticker", "date",
                     (F.try_divide(F.col("total_equity").cast("double"), F.col("total_shares")) * _thousand())
                     .alias("bv_share"))
            .dropna(subset=["bv_share"]))


def price_bv(tables: Tables, start_period="all", group="consolidated", scope_df=None) -> DataFrame:
    """Price / book value per share on the union of dates; NULL where one is missing."""
    sc = _scope(tables, group, scope_df)
    p = prices(tables, start_period, scope_df=sc)
    bv = bv_share(tables, start_period, scope_df=sc)
    return aligned(p, bv, ["ticker"], "p_bv", lambda a, b: F.try_divide(a, b))


__all__ = ["prices", "total_shares", "market_value", "eps", "price_earnings", "enterprise_value",
           "ev_ebitda", "ev_ebit", "bv_share", "price_bv", "parse_start"]
