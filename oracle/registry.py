"""Oracle SQL per registered query name."""

from __future__ import annotations

from oracle import measures as m
from oracle.fixtures import with_ctes

ORACLE: dict[str, str] = {}

# --- scope ---------------------------------------------------------------
ORACLE["scope"] = with_ctes() + "SELECT * FROM sc"
ORACLE["report_frequency"] = with_ctes() + "SELECT cnpj, grupo_dfp, freq, last_statement_date FROM co"
ORACLE["statement_dates"] = with_ctes() + "SELECT cnpj, grupo_dfp, date FROM sdates"
ORACLE["latest_date"] = with_ctes() + "SELECT ticker, last_price_date FROM lp"

# --- flows ---------------------------------------------------------------
ORACLE["net_income"] = m.net_income_sql()
ORACLE["net_income_since_1998"] = m.net_income_sql("1998-01-01")
ORACLE["net_income_last"] = m.net_income_sql("last")
ORACLE["ebit"] = m.ebit_sql()
ORACLE["depre_amort"] = m.depre_amort_sql()
ORACLE["ebitda"] = m.ebitda_sql()
ORACLE["ebitda_ttm_since_1999"] = m.ebitda_sql("1999-06-30", quarter=False, ytd=False)
ORACLE["revenue"] = m.revenue_sql()
ORACLE["cfo"] = m.cfo_sql()

# --- balances --------------------------------------------------------------
ORACLE["cash_equi"] = with_ctes(m.balance_ctes()) + "SELECT cnpj, grupo_dfp, date, cash_equi FROM cash"
ORACLE["total_debt"] = with_ctes(m.balance_ctes()) + "SELECT cnpj, grupo_dfp, date, total_debt FROM debt"
ORACLE["net_debt"] = with_ctes(m.balance_ctes()) + "SELECT cnpj, grupo_dfp, date, net_debt FROM nd"
ORACLE["total_equity"] = with_ctes(m.balance_ctes()) + "SELECT cnpj, grupo_dfp, date, total_equity FROM equity"
ORACLE["total_assets"] = with_ctes(m.balance_ctes()) + "SELECT cnpj, grupo_dfp, date, total_assets FROM assets"
ORACLE["total_assets_since_1999"] = with_ctes(m.balance_ctes("1999-01-01")) + "SELECT cnpj, grupo_dfp, date, total_assets FROM assets"
ORACLE["debt_to_equity"] = with_ctes(m.balance_ctes()) + m.ratio_stacked("debt", "equity", "total_debt", "total_equity", "debt_to_equity")
ORACLE["financial_leverage"] = with_ctes(m.balance_ctes()) + m.ratio_full("assets", "equity", "total_assets", "total_equity",
                                                                         "financial_leverage")
ORACLE["current_ratio"] = m.current_ratio_sql()

# --- returns and margins -----------------------------------------------------
ORACLE["roe"] = m.return_sql("roe")
ORACLE["roa"] = m.return_sql("roa")
ORACLE["roa_last"] = m.return_sql("roa", "last")
ORACLE["gross_profit_margin"] = m.gross_profit_margin_sql()
ORACLE["net_profit_margin"] = m.net_profit_margin_sql()
ORACLE["ebitda_margin"] = m.ebitda_margin_sql()

# --- market ----------------------------------------------------------------
ORACLE["prices"] = m.prices_sql()
ORACLE["prices_since_2000"] = m.prices_sql("2000-01-01")
ORACLE["total_shares"] = m.total_shares_sql()
ORACLE["market_value"] = m.market_value_sql()
ORACLE["market_value_last"] = m.market_value_sql("last")
ORACLE["eps"] = m.eps_sql()
ORACLE["eps_last"] = m.eps_sql("last")
ORACLE["eps_since_2000"] = m.eps_sql("2000-01-01")
ORACLE["price_earnings"] = m.price_earnings_sql()
ORACLE["enterprise_value"] = m.enterprise_value_sql()
ORACLE["enterprise_value_since_2000"] = m.enterprise_value_sql("2000-01-01")
ORACLE["ev_ebitda"] = m.ev_multiple_sql("ebitda")
ORACLE["ev_ebit"] = m.ev_multiple_sql("ebit")
ORACLE["ev_ebit_since_2000"] = m.ev_multiple_sql("ebit", "2000-01-01")
ORACLE["bv_share"] = m.bv_share_sql()
ORACLE["price_bv"] = m.price_bv_sql()
ORACLE["price_bv_last"] = m.price_bv_sql("last")

# --- statements, growth, peers ----------------------------------------------
ORACLE["income_statement"] = with_ctes(m.flow_statement_ctes("dre")) + "SELECT * FROM stm"
ORACLE["cash_flow"] = with_ctes(m.flow_statement_ctes("dfc")) + "SELECT * FROM stm"
ORACLE["cash_flow_since_1999"] = with_ctes(m.flow_statement_ctes("dfc", "1999-01-01")) + "SELECT * FROM stm"
ORACLE["balance_sheet"] = with_ctes(m.balance_sheet_ctes()) + "SELECT * FROM bs"
ORACLE["cagr_net_income"] = m.cagr_sql("net_income")
ORACLE["cagr_revenue"] = m.cagr_sql("revenue")
ORACLE["peers"] = m.PEERS_SQL
ORACLE["get_peers"] = m.get_peers_sql()

# --- reports ------------------------------------------------------------------
ORACLE["statistics"] = m.statistics_sql()
ORACLE["statistics_individual"] = m.individual(m.statistics_sql())
ORACLE["compare_measure"] = m.compare_net_income_sql()
ORACLE["compare_measure_since_2000"] = m.compare_net_income_sql("2000-01-01")
ORACLE["compare_bv_share_individual"] = m.individual(m.bv_share_sql())
ORACLE["compare_common"] = m.compare_common_sql()
ORACLE["compare_common_individual"] = m.individual(m.compare_common_sql())
ORACLE["compare_wide"] = m.compare_wide_sql()
ORACLE["is_regular_net_income"] = m.is_regular_sql("net_income", m.net_income_sql())
ORACLE["is_regular_prices"] = m.is_regular_sql("prices", m.prices_sql("all"))

ORACLE["frequency_classes"] = m.frequency_classes_sql()

# --- chart data ---------------------------------------------------------------
ORACLE["bs_composition"] = m.bs_composition_sql()
ORACLE["account_seasonality"] = m.account_seasonality_sql("3.01")
ORACLE["series_summary"] = m.series_summary_sql()

# --- ingest ---------------------------------------------------------------------
from oracle import ingest as ig  # noqa: E402

ORACLE["ingest_fixed_width"] = ig.QUOTES
ORACLE["ingest_instrument_xml"] = ig.INSTRUMENTS
ORACLE["merge_shares"] = ig.MERGE
ORACLE["ingest_statements"] = ig.statement_sql("dre")
ORACLE["cash_flow_union"] = ig.statement_sql("dfc")
ORACLE["ingest_balance_sheet"] = ig.statement_sql("bpa", flow=False)
ORACLE["file_name_fields"] = ig.FILE_FIELDS
ORACLE["changed_files"] = ig.CHANGED_FILES
ORACLE["registry_upsert"] = ig.REGISTRY_UPSERT
ORACLE["replace_slice"] = ig.replace_slice_sql()
ORACLE["seed_prices"] = ig.SEED_PRICES
ORACLE["reload_tickers"] = ig.RELOAD_TICKERS
ORACLE["missing_price_dates"] = ig.MISSING_PRICE_DATES
ORACLE["price_load"] = ig.PRICE_LOAD
ORACLE["statement_load"] = ig.statement_load_sql()
ORACLE["statement_reload"] = ig.loaded(ig.statement_load_sql())
ORACLE["registry_after_load"] = ig.REGISTRY_AFTER_LOAD
ORACLE["pending_archives"] = ig.PENDING_ARCHIVES
ORACLE["scope_after_load"] = ig.loaded(with_ctes() + "SELECT * FROM sc")
ORACLE["refreshed_net_income"] = ig.refreshed_sql(m.net_income_sql(), "net_income")
ORACLE["price_earnings_after_load"] = ig.loaded(m.price_earnings_sql())
ORACLE["rejected_records"] = ig.rejected_sql()
ORACLE["price_filters"] = ig.PRICE_FILTERS
ORACLE["share_filters"] = ig.SHARE_FILTERS
ORACLE["statement_pivot"] = m.statement_pivot_sql()
ORACLE["quarter_values"] = m.QUARTER_VALUES_SQL
ORACLE["latest_rows"] = m.LATEST_ROWS_SQL
ORACLE["compare_filled"] = m.compare_filled_sql()
ORACLE["scalar_strings"] = m.SCALAR_STRINGS_SQL
ORACLE["scalar_dates"] = m.SCALAR_DATES_SQL
ORACLE["scalar_math_cast_null"] = m.SCALAR_MATH_SQL
ORACLE["stream_quote_load"] = ig.MERGE
ORACLE["ingest_dmpl"] = ig.DMPL
