"""The 27-measure report at 'last' for every ticker (M38, J10), one scan per stored table.

Every statement line a measure needs is named once in the account rules: which rows of which table
(by label or code), for which measure, in which place (the value, what is taken off it, what it is
divided by) and how far back the measure starts.  The five statement tables are read once each with
the rules as pushed predicate, their rows are expanded to (measure, place) and stacked; one exchange on the company
brings all lines of all measures together.  Windows per (company, measure) then give every ttm value
at once, with the steps of the single measures: lines side by side, label preference, quarter
value, sum of four quarters, look-back rows dropped.

The prices are read once: per company and day both share classes and the quotes of its tickers.
Report days and trading days of a company meet in one frame; carrying values forward, joining equal
dates and collapsing to one row per ticker happen inside its partitioning.  The report starts at the
newest report, so a company holds at most a few hundred rows (months of days, years of reports).
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fundlake.operators.flows import K, company_window, not_annual, quarter_value, trailing_sum
from fundlake.plans import balances, growth, income, market
from fundlake.plans.margins import pct
from fundlake.plans.scope import companies as companies_of
from fundlake.plans.scope import scope as scope_of
from fundlake.sources.catalog import Tables

# Output columns, in the order of the source tool.
STAT_COLUMNS = [
    "p_e", "ev_ebitda", "p_bv", "ev_ebit", "bv_share", "eps", "ttm_gross_profit_margin",
    "ttm_net_profit_margin", "roe", "roa", "debt_to_equity", "total_equity", "total_assets", "total_debt",
    "cash_equi", "net_debt", "market_value", "ev", "ttm_ebitda", "ttm_ebitda_margin", "financial_leverage",
    "ttm_d_a", "ttm_ebit", "ttm_revenue", "ttm_net_income", "ttm_cfo", "current_ratio",
]
# Places of a line in a measure.
VALUE, MINUS, DIVISOR, BALANCE = "value", "minus", "divisor", "balance"
LOOK_BACK = 12
EPS_BACK = 7  # earnings per share reads reports from seven months before


class Use(NamedTuple):
    """A line's place in a measure; ``label`` is 1 for the preferred label, 0 for the fallback;
    the measure starts ``back`` months before the newest report."""

    measure: str
    place: str = VALUE
    label: int | None = None
    back: int = 0


def account_rules(n_years: int) -> list[tuple[str, Column, list[Use]]]:
    """(table, rows, uses): the account-rule table."""
    ds, cd = F.col("ds_conta"), F.col("cd_conta")
    rules = []
    for labels, measures in (
            (income.NET_INCOME_LABELS, [("net_income", 0), ("eps_income", EPS_BACK), ("net_profit_margin", 0),
                                        ("cagr_net_income", 12 * n_years)]),
            (income.EBIT_LABELS, [("ebit", 0), ("ebitda", 0), ("ebitda_margin", 0)])):
        for preferred, label in zip((1, 0), labels):
            rules.append(("dre", ds == label, [Use(m, VALUE, preferred, back) for m, back in measures]))
    rules += [
        ("dre", cd == income.REVENUE_CODE, [
            Use("revenue"), Use("gross_profit_margin", DIVISOR), Use("net_profit_margin", DIVISOR),
            Use("ebitda_margin", DIVISOR), Use("cagr_revenue", back=12 * n_years)]),
        ("dre", cd == income.GROSS_PROFIT_CODE, [Use("gross_profit_margin")]),
        ("dva", ds == income.D_A_LABEL, [Use("d_a"), Use("ebitda", MINUS), Use("ebitda_margin", MINUS)]),
        ("dfc", cd == income.CFO_CODE, [Use("cfo")]),
        ("bpa", ds.isin(*balances.CASH_LABELS) & (cd != balances.CASH_EXCLUDED_CODE), [Use("cash_equi", BALANCE)]),
        ("bpa", cd == balances.TOTAL_ASSETS_CODE, [Use("total_assets", BALANCE)]),
        ("bpa", ds == balances.CURRENT_ASSETS_LABEL, [Use("current_assets", BALANCE)]),
        ("bpp", (ds == balances.DEBT_LABEL) & cd.isin(*balances.DEBT_CODES), [Use("total_debt", BALANCE)]),
        ("bpp", ds.isin(*balances.EQUITY_LABELS), [Use("total_equity", BALANCE)]),
        ("bpp", ds == balances.CURRENT_LIABILITIES_LABEL, [Use("current_liabilities", BALANCE)]),
    ]
    return rules


def having(rules, place: str) -> list[str]:
    return sorted({u.measure for _, _, uses in rules for u in uses if u.place == place})


def ruled_lines(tables: Tables, rules) -> DataFrame:
    """The rows of all statement tables that a rule names, once per use."""
    out = None
    for table in dict.fromkeys(t for t, _, _ in rules):
        own = [(rows, uses) for t, rows, uses in rules if t == table]
        wanted = own[0][0]
        for rows, _ in own[1:]:
            wanted = wanted | rows
        used = [F.when(rows, F.array(*[F.struct(F.lit(u.measure).alias("measure"), F.lit(u.place).alias("place"),
                                                F.lit(u.label).cast("int").alias("label"), F.lit(u.back).alias("back"))
                                       for u in uses])) for rows, uses in own]
        source = tables.get(table)
        quarter = F.col("fiscal_quarter") if "fiscal_quarter" in source.columns else F.lit(None)
        part = source.filter(wanted).select(
            *K, F.col("dt_fim_exerc").alias("date"), quarter.cast("double").alias("fiscal_quarter"), "cd_conta", "vl_conta",
            F.inline(F.flatten(F.filter(F.array(*used), lambda u: u.isNotNull()))))
        out = part if out is None else out.unionByName(part)
    return out


def measured_lines(tables: Tables, companies: DataFrame, rules) -> DataFrame:
    """(K, measure, date, amount, ttm, ratio): the ttm value of every flow measure, in ``ratio`` if it is
    divided, and the amount of every balance line, from each measure's start."""
    begin = F.add_months("last_statement_date", -F.col("back"))
    first = F.when(F.col("place") == BALANCE, begin).otherwise(F.add_months(begin, -LOOK_BACK))
    rows = (ruled_lines(tables, rules).join(companies.select(*K, "freq", "last_statement_date"), K)
            .filter(F.col("date") >= first))
    if not tables.bucketed:
        rows = rows.repartition(*K)
    day = Window.partitionBy(*K, "measure", "date")
    at = lambda place: F.collect_list(F.when(F.col("place") == place, F.struct(F.col("vl_conta").alias("v"), F.col("cd_conta").alias("cd")))).over(day)
    rows = rows.withColumns({"_minus": at(MINUS), "_divisor": at(DIVISOR)}).filter(F.col("place").isin(VALUE, BALANCE))
    less, divided = F.col("measure").isin(having(rules, MINUS)), F.col("measure").isin(having(rules, DIVISOR))
    nothing = F.array(F.lit(None).cast("struct<v:bigint,cd:string>"))
    rows = rows.withColumn("_m", F.explode(F.when(less, F.col("_minus")).otherwise(nothing)))
    rows = rows.withColumn("_d", F.explode(F.when(divided, F.col("_divisor")).otherwise(nothing)))
    rows = rows.withColumn("_best", F.max("label").over(Window.partitionBy(*K, "measure")))
    rows = rows.filter(F.col("label").isNull() | (F.col("label") == F.col("_best")))
    w = company_window(["date", "cd_conta", "_m.cd"], [*K, "measure"])
    q = lambda c: quarter_value(F.col(c), F.col("fiscal_quarter"), w)
    rows = rows.withColumns({"_qv": q("vl_conta"), "_qm": q("_m.v"), "_qd": q("_d.v")})
    rows = rows.withColumn("_q", F.when(less, F.col("_qv") - F.col("_qm")).otherwise(F.col("_qv")))
    rows = rows.withColumns({"_t": trailing_sum("_q", w), "_td": trailing_sum("_qd", w)})
    begin_again = F.when(F.col("place") == BALANCE, begin).otherwise(F.add_months(F.add_months(begin, -LOOK_BACK), LOOK_BACK))
    return rows.filter(F.col("date") >= begin_again).select(
        *K, "measure", "date", F.col("vl_conta").alias("amount"), not_annual(F.col("_t")).alias("ttm"),
        F.when(divided, not_annual(pct(F.col("_t"), F.col("_td")))).alias("ratio"))


def report_days(tables: Tables, companies: DataFrame, n_years: int) -> DataFrame:
    """One row per company and report date with the values of all measures."""
    rules = account_rules(n_years)
    m = lambda name: F.col("measure") == name
    flows = ["net_income", "eps_income", "ebit", "ebitda", "d_a", "revenue", "cfo", "cagr_net_income", "cagr_revenue"]
    ratios = ["gross_profit_margin", "net_profit_margin", "ebitda_margin"]
    summed = ["cash_equi", "total_debt"]
    listed = ["total_assets", "total_equity", "current_assets", "current_liabilities"]
    apart = ["eps_income", "cagr_net_income", "cagr_revenue"]
    return measured_lines(tables, companies, rules).groupBy(*K, "date").agg(
        *[F.max(F.when(m(n), F.col("ttm"))).alias(n) for n in flows],
        *[F.max(F.when(m(n), F.col("ratio"))).alias(n) for n in ratios],
        *[F.sum(F.when(m(n), F.col("amount"))).alias(n) for n in summed],
        *[F.collect_list(F.when(m(n), F.col("amount"))).alias(n) for n in listed],
        *[F.max(F.when(m(n), F.lit(True))).alias(f"has_{n}") for n in [*apart, "total_equity"]],
        F.max(F.when(~F.col("measure").isin(apart), F.lit(True))).alias("has_report")).drop("grupo_dfp")


def trading_days(tables: Tables, scope: DataFrame) -> DataFrame:
    """One row per company and trading day: shares, market value, and the newest quotes of its tickers."""
    back = F.add_months("last_statement_date", -EPS_BACK)
    since = F.least(back, F.min("last_price_date").over(Window.partitionBy("cnpj")))
    t = F.col("ticker")
    cls = F.when(t == F.col("on_ticker"), "ON").when(t == F.col("pn_ticker"), "PN")
    members = scope.select("ticker", "cnpj", "last_price_date", cls.alias("cls"), F.col("pn_ticker").isNotNull().alias("has_pn"),
                           since.alias("since"))
    p = market.from_least(tables.prices.select("ticker", "date", "preult", "number_shares"), members, "since")
    p = p.join(members, "ticker").filter(F.col("date") >= F.col("since"))
    on, of_class = F.col("cls") == "ON", F.col("cls").isNotNull()
    quoted = F.when(F.col("date") >= F.col("last_price_date"), F.struct("ticker", "preult"))
    days = p.groupBy("cnpj", "date").agg(
        F.max(F.when(on, F.lit(True))).alias("has_on"), F.max(F.when(on, F.col("number_shares"))).alias("_on"),
        F.max(F.when(F.col("cls") == "PN", F.col("number_shares"))).alias("_pn"), F.max("has_pn").alias("_has_pn"),
        F.max(F.when(of_class, F.lit(True))).alias("has_day"),
        F.sum(F.when(of_class, F.col("preult") * F.col("number_shares"))).alias("market_value"),
        F.collect_list(quoted).alias("quotes"))
    shares = F.when(F.col("_has_pn"), F.col("_on") + F.coalesce(F.col("_pn"), F.lit(0))).otherwise(F.col("_on"))
    return days.select("cnpj", "date", "has_on", "has_day", "market_value", "quotes",
                       F.when(F.col("has_on"), shares).alias("shares"))


def largest(values: Column, of=lambda x: x) -> Column:
    """The largest of a list's values, each put through a function."""
    return F.array_max(F.transform(values, of))


def statistics(tables: Tables, group="consolidated", n_years: int = 5) -> DataFrame:
    sc = scope_of(tables, group)
    co = companies_of(tables, group)
    reports = report_days(tables, co, n_years)
    days = reports.unionByName(trading_days(tables, sc), allowMissingColumns=True).repartition("cnpj")
    days = days.groupBy("cnpj", "date").agg(
        *[F.first(c, ignorenulls=True).alias(c) for c in days.columns if c not in ("cnpj", "date")])
    net_debt = F.col("total_debt") - F.col("cash_equi")
    days = days.withColumns({"net_debt": net_debt, "equity": F.array_max("total_equity")})

    attrs = ["sector", "subsector", "segment"]
    rows = days.join(sc.select("ticker", "cnpj", "last_price_date", "last_statement_date", *attrs), "cnpj")
    traded = F.col("date") >= F.col("last_price_date")
    quote = F.filter("quotes", lambda q: q["ticker"] == F.col("ticker"))
    rows = rows.withColumns({
        "price": F.try_element_at(quote, F.lit(1))["preult"], "has_price": F.size(quote) > 0,
        "mv": F.when(traded, F.col("market_value")), "has_mv": traded & F.col("has_day"),
        "sh": F.when(traded, F.col("shares")), "has_sh": traded & F.col("has_on"),
        "eps_sh": F.when(F.col("date") >= F.add_months("last_statement_date", -EPS_BACK), F.col("shares")),
        "has_eps": F.coalesce(F.col("has_eps_income"), F.lit(False)) | F.coalesce(
            F.col("has_on") & (F.col("date") >= F.add_months("last_statement_date", -EPS_BACK)), F.lit(False))})
    of_ticker = Window.partitionBy("cnpj", "ticker").orderBy("date")
    so_far = of_ticker.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ever = of_ticker.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    carried = lambda c: F.last(c, ignorenulls=True).over(so_far)
    newest = lambda c: F.last(c, ignorenulls=True).over(ever)
    thousand = F.lit(1000).cast("double")
    rows = rows.withColumns({
        "ev": carried("mv") + carried("net_debt") * 1000, "c_ebitda": carried("ebitda"), "c_ebit": carried("ebit"),
        "bv_share": F.try_divide(carried("equity").cast("double"), carried("sh")) * thousand,
        # the newest row of shares and reports carries the newest value of both
        "eps": F.try_divide((newest("eps_income") * 1000).cast("double"), newest("eps_sh")),
        "eps_date": F.max(F.when(F.col("has_eps"), F.col("date"))).over(ever)})
    value = {
        "p_e": F.when(F.col("date") == F.col("eps_date"), F.try_divide("price", "eps")),
        "ev_ebitda": F.try_divide("ev", "c_ebitda") / thousand,
        "p_bv": F.when(F.col("has_sh") | F.col("has_total_equity"), F.try_divide("price", "bv_share")),
        "ev_ebit": F.try_divide("ev", "c_ebit") / thousand,
        "ttm_gross_profit_margin": F.col("gross_profit_margin"), "ttm_net_profit_margin": F.col("net_profit_margin"),
        "roe": largest(F.col("total_equity"), lambda e: pct(F.col("net_income"), e)),
        "roa": largest(F.col("total_assets"), lambda a: pct(F.col("net_income"), a)),
        "debt_to_equity": largest(F.col("total_equity"), lambda e: F.try_divide(F.col("total_debt").cast("double"), e)),
        "total_equity": F.col("equity"), "total_assets": F.array_max("total_assets"),
        "market_value": F.col("mv"), "ttm_ebitda": F.col("ebitda"), "ttm_ebitda_margin": F.col("ebitda_margin"),
        "financial_leverage": largest(F.col("total_assets"), lambda a: largest(
            F.col("total_equity"), lambda e: F.try_divide(a.cast("double"), e))),
        "ttm_d_a": F.col("d_a"), "ttm_ebit": F.col("ebit"), "ttm_revenue": F.col("revenue"),
        "ttm_net_income": F.col("net_income"), "ttm_cfo": F.col("cfo"),
        "current_ratio": largest(F.col("current_assets"), lambda a: largest(
            F.col("current_liabilities"), lambda b: F.try_divide(a.cast("double"), b.cast("double")))),
    }
    rows = rows.withColumns({f"s_{n}": value.get(n, F.col(n)).cast("double") for n in STAT_COLUMNS})
    counted = F.col("has_report") | F.col("has_price") | F.col("has_mv")
    ends = lambda name, pick: pick(name, F.when(F.col(f"has_{name}"), F.col("date")))
    out = rows.groupBy("cnpj", "ticker", *attrs).agg(
        F.max(F.when(counted, F.col("date"))).alias("_date"),
        F.max(F.when(F.col("eps").isNotNull(), F.col("eps_date"))).alias("_eps_date"),
        *[F.max(f"s_{n}").alias(n) for n in STAT_COLUMNS],
        *[ends(n, pick).alias(f"_{end}_{n}") for n in ("cagr_net_income", "cagr_revenue")
          for end, pick in (("first", F.min_by), ("last", F.max_by))])
    date = F.greatest("_date", "_eps_date")
    return out.filter(date.isNotNull()).select(
        "ticker", date.alias("date"), *STAT_COLUMNS,
        *[growth.yearly_rate(F.col(f"_first_{n}"), F.col(f"_last_{n}"), n_years).alias(n)
          for n in ("cagr_net_income", "cagr_revenue")], *attrs)
