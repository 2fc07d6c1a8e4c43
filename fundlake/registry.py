"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Every query reads the stored tables derived from the input folder, so its
work grows with the data; one company or ticker is just a filter on the
result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from fundlake.plans import income, scope
from fundlake.sources.catalog import load_tables, written_once

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

def T(spark: SparkSession, sf_dir: str):
    return load_tables(spark, sf_dir)


# --- scope (M1, M2, B11) -------------------------------------------------
QUERIES["scope"] = lambda s, d: scope.scope(T(s, d))
QUERIES["report_frequency"] = lambda s, d: scope.companies(T(s, d))
QUERIES["statement_dates"] = lambda s, d: scope.statement_dates(T(s, d))
QUERIES["latest_date"] = lambda s, d: scope.last_price_dates(T(s, d))

# --- flows (M9-M13, M37) -------------------------------------------------
QUERIES["net_income"] = lambda s, d: income.net_income(T(s, d))
QUERIES["net_income_since_1998"] = lambda s, d: income.net_income(T(s, d), start_period="1998-01-01")
QUERIES["net_income_last"] = lambda s, d: income.net_income(T(s, d), start_period="last")
QUERIES["ebit"] = lambda s, d: income.ebit(T(s, d))
QUERIES["depre_amort"] = lambda s, d: income.depre_amort(T(s, d))
QUERIES["ebitda"] = lambda s, d: income.ebitda(T(s, d))
QUERIES["ebitda_ttm_since_1999"] = lambda s, d: income.ebitda(T(s, d), quarter=False, ytd=False,
                                                               start_period="1999-06-30")
QUERIES["revenue"] = lambda s, d: income.revenue(T(s, d))
QUERIES["cfo"] = lambda s, d: income.cfo(T(s, d))

# --- balances (M14, M15, M17, M20, M21, M24-M26) ---------------------------
from fundlake.plans import balances, margins, market  # noqa: E402

QUERIES["cash_equi"] = lambda s, d: balances.cash_equi(T(s, d))
QUERIES["total_debt"] = lambda s, d: balances.total_debt(T(s, d))
QUERIES["net_debt"] = lambda s, d: balances.net_debt(T(s, d))
QUERIES["total_equity"] = lambda s, d: balances.total_equity(T(s, d))
QUERIES["total_assets"] = lambda s, d: balances.total_assets(T(s, d))
QUERIES["total_assets_since_1999"] = lambda s, d: balances.total_assets(T(s, d), start_period="1999-01-01")
QUERIES["debt_to_equity"] = lambda s, d: balances.debt_to_equity(T(s, d))
QUERIES["financial_leverage"] = lambda s, d: balances.financial_leverage(T(s, d))
QUERIES["current_ratio"] = lambda s, d: balances.current_ratio(T(s, d))

# --- returns and margins (M22, M23, M27-M29) -------------------------------
QUERIES["roe"] = lambda s, d: margins.roe(T(s, d))
QUERIES["roa"] = lambda s, d: margins.roa(T(s, d))
QUERIES["roa_last"] = lambda s, d: margins.roa(T(s, d), start_period="last")
QUERIES["gross_profit_margin"] = lambda s, d: margins.gross_profit_margin(T(s, d))
QUERIES["net_profit_margin"] = lambda s, d: margins.net_profit_margin(T(s, d))
QUERIES["ebitda_margin"] = lambda s, d: margins.ebitda_margin(T(s, d))

# --- market (M7, M8, M16, M18, M19, M30-M34) -------------------------------
QUERIES["prices"] = lambda s, d: market.prices(T(s, d))
QUERIES["prices_since_2000"] = lambda s, d: market.prices(T(s, d), start_period="2000-01-01")
QUERIES["total_shares"] = lambda s, d: market.total_shares(T(s, d))
QUERIES["market_value"] = lambda s, d: market.market_value(T(s, d))
QUERIES["market_value_last"] = lambda s, d: market.market_value(T(s, d), start_period="last")
QUERIES["eps"] = lambda s, d: market.eps(T(s, d))
QUERIES["eps_last"] = lambda s, d: market.eps(T(s, d), start_period="last")
QUERIES["eps_since_2000"] = lambda s, d: market.eps(T(s, d), start_period="2000-01-01")
QUERIES["price_earnings"] = lambda s, d: market.price_earnings(T(s, d))
QUERIES["enterprise_value"] = lambda s, d: market.enterprise_value(T(s, d))
QUERIES["enterprise_value_since_2000"] = lambda s, d: market.enterprise_value(T(s, d), start_period="2000-01-01")
QUERIES["ev_ebitda"] = lambda s, d: market.ev_ebitda(T(s, d))
QUERIES["ev_ebit"] = lambda s, d: market.ev_ebit(T(s, d))
QUERIES["ev_ebit_since_2000"] = lambda s, d: market.ev_ebit(T(s, d), start_period="2000-01-01")
QUERIES["bv_share"] = lambda s, d: market.bv_share(T(s, d))
QUERIES["price_bv"] = lambda s, d: market.price_bv(T(s, d))
QUERIES["price_bv_last"] = lambda s, d: market.price_bv(T(s, d), start_period="last")

# --- statements, growth, peers (M3-M6, M35, M36, M40) -----------------------
from fundlake.plans import charts, compare, growth, peers, statements, statistics  # noqa: E402

QUERIES["income_statement"] = lambda s, d: statements.income_statement(T(s, d))
QUERIES["cash_flow"] = lambda s, d: statements.cash_flow(T(s, d))
QUERIES["cash_flow_since_1999"] = lambda s, d: statements.cash_flow(T(s, d), start_period="1999-01-01")
QUERIES["balance_sheet"] = lambda s, d: statements.balance_sheet(T(s, d))
QUERIES["cagr_net_income"] = lambda s, d: growth.cagr_net_income(T(s, d))
QUERIES["cagr_revenue"] = lambda s, d: growth.cagr_revenue(T(s, d))
QUERIES["peers"] = lambda s, d: peers.peer_groups(T(s, d))
QUERIES["get_peers"] = lambda s, d: peers.get_peers(T(s, d), peers.leaders(T(s, d)))

# --- reports (M38, M39, H5, H6) ----------------------------------------------
QUERIES["statistics"] = lambda s, d: statistics.statistics(T(s, d))
QUERIES["statistics_individual"] = lambda s, d: statistics.statistics(T(s, d), group="individual")
QUERIES["compare_measure"] = lambda s, d: compare.compare_measure(T(s, d), "net_income")
QUERIES["compare_measure_since_2000"] = lambda s, d: compare.compare_measure(
    T(s, d), "net_income", {"start_period": "2000-01-01"})
QUERIES["compare_bv_share_individual"] = lambda s, d: compare.compare_measure(T(s, d), "bv_share", group="individual")
QUERIES["compare_common_individual"] = lambda s, d: compare.compare_common_all(
    T(s, d), "total_assets", group="individual")
QUERIES["compare_common"] = lambda s, d: compare.compare_common_all(T(s, d), "total_assets")
QUERIES["is_regular_net_income"] = lambda s, d: compare.is_regular(
    compare.compare_measure(T(s, d), "net_income"), "net_income")
QUERIES["is_regular_prices"] = lambda s, d: compare.is_regular(compare.compare_measure(T(s, d), "prices"), "prices")

QUERIES["frequency_classes"] = lambda s, d: scope.frequency_classes(T(s, d))

# --- chart data (H1-H3) --------------------------------------------------------
QUERIES["bs_composition"] = lambda s, d: charts.bs_composition(T(s, d))
QUERIES["account_seasonality"] = lambda s, d: charts.account_seasonality(T(s, d), "3.01")
QUERIES["series_summary"] = lambda s, d: charts.series_summary(T(s, d))

# --- ingest (A1-A12, B1-B10, B17, J1, P1, P2) ------------------------------------
from fundlake.plans import ingest  # noqa: E402
from fundlake.sources import sinks  # noqa: E402


def _listing(s, d):
    return ingest.archive_listing(s.read.parquet(f"{d}/supplier.parquet"))


QUERIES["ingest_fixed_width"] = lambda s, d: ingest.quotes(T(s, d))
QUERIES["ingest_instrument_xml"] = lambda s, d: ingest.instruments(T(s, d))
QUERIES["merge_shares"] = lambda s, d: ingest.merged_quotes(T(s, d))
QUERIES["ingest_statements"] = lambda s, d: ingest.statement(T(s, d), "dre")
QUERIES["cash_flow_union"] = lambda s, d: ingest.statement(T(s, d), "dfc")
QUERIES["ingest_balance_sheet"] = lambda s, d: ingest.statement(T(s, d), "bpa")
QUERIES["file_name_fields"] = lambda s, d: ingest.file_fields(T(s, d))
QUERIES["changed_files"] = lambda s, d: sinks.changed_files(*_listing(s, d))
QUERIES["registry_upsert"] = lambda s, d: sinks.registry_upsert(
    _listing(s, d)[1], sinks.changed_files(*_listing(s, d)))
QUERIES["replace_slice"] = lambda s, d: ingest.replace_slice(T(s, d))
QUERIES["seed_prices"] = lambda s, d: ingest.seed_prices(T(s, d))
QUERIES["reload_tickers"] = lambda s, d: ingest.reload_tickers(T(s, d))
QUERIES["missing_price_dates"] = lambda s, d: ingest.missing_price_dates(T(s, d))
QUERIES["price_load"] = lambda s, d: ingest.price_load_table(T(s, d))
QUERIES["statement_load"] = lambda s, d: ingest.statement_load_table(T(s, d))
QUERIES["statement_reload"] = lambda s, d: ingest.side_by_side(T(s, d), ingest.loaded_lake(T(s, d)))
QUERIES["registry_after_load"] = lambda s, d: ingest.registry_after_load(T(s, d))
QUERIES["pending_archives"] = lambda s, d: ingest.pending_archives(T(s, d))
QUERIES["scope_after_load"] = lambda s, d: scope.scope(ingest.lake_tables(T(s, d)))
QUERIES["refreshed_net_income"] = lambda s, d: ingest.refreshed_net_income(T(s, d))
QUERIES["price_earnings_after_load"] = lambda s, d: market.price_earnings(ingest.lake_tables(T(s, d)))
QUERIES["rejected_records"] = lambda s, d: ingest.rejected_records(T(s, d))
QUERIES["price_filters"] = lambda s, d: ingest.price_filters(T(s, d))
QUERIES["share_filters"] = lambda s, d: ingest.share_filters(T(s, d))
QUERIES["statement_pivot"] = lambda s, d: statements.balance_sheet_wide(T(s, d))

# --- operators exposed on their own (W1-W4, O1/O2, H4, scalar functions) ---------
from pyspark.sql import functions as F  # noqa: E402

from fundlake.functions import scalar  # noqa: E402

QUERIES["quarter_values"] = lambda s, d: statements.account_flows(T(s, d), "dre").select(
    "cnpj", "grupo_dfp", "cd_conta", "ds_conta", "date", "ytd", "quarter_value", "ttm_value")


def _latest_rows(s, d):
    """Newest price row per ticker: max_by aggregates partially, so a long history is no hot spot."""
    p = T(s, d).prices
    last = p.groupBy("ticker").agg(F.max_by(F.struct("date", "preult", "totneg", "quatot", "number_shares"),
                                            "date").alias("r"))
    return last.select("ticker", "r.*")


QUERIES["latest_rows"] = _latest_rows
QUERIES["compare_wide"] = lambda s, d: compare.compare_wide_by(
    compare.compare_measure(T(s, d), "net_income"), peers.leaders(T(s, d)), "sector")


def _compare_filled(s, d):
    t = T(s, d)
    series = written_once(compare.compare_measure(t, "price_earnings"), t.root)
    return compare.compare_groups(series, t.tickers, peers.GROUP, t.parts)


QUERIES["compare_filled"] = _compare_filled


def _scalar_strings(s, d):
    t = T(s, d).tickers
    return t.select(
        "ticker", F.upper(F.lower("ticker")).alias("ticker_upper"), scalar.last_char(F.col("ticker")).alias("last_char"),
        scalar.prefix(F.col("ticker"), 3).alias("prefix3"), scalar.word(F.col("sector"), 2).alias("second_word"),
        F.length("denom_social").alias("name_length"), scalar.prefix(F.col("denom_social"), 1).alias("first_char"),
        F.concat(F.col("ticker"), F.lit(" "), F.col("segment")).alias("labelled"))


def _scalar_dates(s, d):
    r = T(s, d).dre.select("cnpj", "grupo_dfp", "cd_conta", "dt_ini_exerc", "dt_fim_exerc")
    e = F.col("dt_fim_exerc")
    return r.select(
        "cnpj", "grupo_dfp", "cd_conta", "dt_fim_exerc",
        scalar.parse_compact_date(F.date_format(e, "yyyyMMdd")).alias("parsed"),
        F.add_months(e, 12).alias("plus_year"), F.add_months(e, -7).alias("minus_7m"),
        F.date_add(e, 1).alias("next_day"), F.year(e).alias("yr"), F.month(e).alias("mo"),
        scalar.span_years(e, F.col("dt_ini_exerc")).alias("span_years"))


def _scalar_math(s, d):
    p = T(s, d).prices
    zero = F.col("totneg") - F.col("totneg")
    return p.select(
        "ticker", "date", scalar.ratio(F.col("quatot"), F.col("totneg")).alias("per_trade"),
        scalar.ratio(F.col("preult"), zero).alias("zero_div"), F.pow(F.col("preult"), F.lit(0.5)).alias("root_price"),
        F.col("quatot").cast("string").try_cast("int").alias("quatot_int"),
        F.coalesce(scalar.ratio(F.col("preult"), zero), F.lit(0.0)).alias("filled"))


QUERIES["scalar_strings"] = _scalar_strings
QUERIES["scalar_dates"] = _scalar_dates
QUERIES["scalar_math_cast_null"] = _scalar_math
QUERIES["stream_quote_load"] = lambda s, d: ingest.stream_quote_load(T(s, d))
QUERIES["ingest_dmpl"] = lambda s, d: ingest.statement(T(s, d), "dmpl")
