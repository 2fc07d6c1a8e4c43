"""The report of 27 measures against the single measures, and the shape of its plan."""

import datetime as dt
import math
import random

import pytest
from conftest import NI, NI_B, qend, ticker_row

from fundlake.plans import balances, compare, growth, income, statistics
from fundlake.plans.scope import build_companies, build_scope
from fundlake.sources.catalog import tables_from_frames

TTM = dict(quarter=False, ytd=False, ttm=True)
BY_NAME = {"p_e": ("price_earnings", {}), "ttm_gross_profit_margin": ("gross_profit_margin", TTM),
           "ttm_net_profit_margin": ("net_profit_margin", TTM), "ev": ("enterprise_value", {}), "p_bv": ("price_bv", {}),
           "ttm_ebitda": ("ebitda", TTM), "ttm_ebitda_margin": ("ebitda_margin", TTM), "ttm_d_a": ("depre_amort", TTM),
           "ttm_ebit": ("ebit", TTM), "ttm_revenue": ("revenue", TTM), "ttm_net_income": ("net_income", TTM),
           "ttm_cfo": ("cfo", TTM)}


def one_by_one(tables, group="consolidated", n_years=5):
    """ticker -> report row, every measure computed on its own at 'last' and collapsed by max."""
    out, dates = {}, {}
    for name in statistics.STAT_COLUMNS:
        measure, flags = BY_NAME.get(name, (name, {}))
        for r in compare.compare_measure(tables, measure, {"start_period": "last", **flags}, group).collect():
            row = r.asDict()
            value = row.get(name, next(v for k, v in row.items() if k not in ("ticker", "date")))
            dates[r.ticker] = max(dates.get(r.ticker, r.date), r.date)
            held = out.setdefault(r.ticker, {})
            if value is not None:
                held[name] = max(held.get(name, -math.inf), float(value))
    rates = {}
    for measure in (growth.cagr_net_income, growth.cagr_revenue):
        for r in measure(tables, n_years, group=group).collect():
            rates.setdefault(r.cnpj, {})[measure.__name__] = r[measure.__name__]
    owner = {r.ticker: r.cnpj for r in build_scope(tables, group).collect()}
    return {t: {"date": dates[t], **{n: held.get(n) for n in statistics.STAT_COLUMNS},
                **{n: rates.get(owner[t], {}).get(n) for n in ("cagr_net_income", "cagr_revenue")}} for t, held in out.items()}


def same(a, b):
    return a == b or (isinstance(a, float) and isinstance(b, float) and math.isclose(a, b, rel_tol=1e-12))


def check(tables, group="consolidated"):
    want = one_by_one(tables, group)
    got = {r.ticker: r.asDict() for r in statistics.statistics(tables, group).collect()}
    assert got.keys() == want.keys()
    for ticker, row in want.items():
        assert {n: (got[ticker][n], v) for n, v in row.items() if not same(got[ticker][n], v)} == {}, ticker
    return got


def random_tables(make_tables, seed):
    """Companies with missing reports and lines, one share class or two, zeros, tickers that stopped trading."""
    rng = random.Random(seed)
    dre, dva, dfc, bpa, bpp, prices, tickers = [], [], [], [], [], [], []
    for k in range(6):
        c = f"C{k}"
        tickers.append(ticker_row(f"CC{k}A3", c))
        if k % 2:
            tickers.append(ticker_row(f"CC{k}A4", c, "PN"))
        if k == 4:
            tickers.append(ticker_row(f"CC{k}A5", c, "PNA"))
        gaps = rng.choice([0, 0.1, 0.3])
        for year in range(1994, 2001):
            for q in (4,) if k == 5 else (1, 2, 3, 4):
                if rng.random() < gaps:
                    continue
                end, first = qend(year, q), dt.date(year, 1, 1)
                line = lambda cd, ds, low=-50, high=200: (c, "Consolidado", first, end, q, cd, ds, rng.randrange(low, high))
                lines = [line("3.01", "Receita", 0), line("3.03", "Resultado Bruto"),
                         line("3.09", NI if k % 3 else NI_B), line("3.05", "Resultado Antes do Resultado Financeiro e dos Tributos")]
                if k == 2:
                    lines.append(line("3.11", NI_B))
                dre += [x for x in lines if rng.random() > gaps / 2]
                if rng.random() > gaps:
                    dva.append(line("7.04.01", "Depreciação, Amortização e Exaustão", -40, 0))
                if rng.random() > gaps:
                    dfc.append(line("6.01", "Caixa Líquido"))
                for rows, cd, ds in ((bpa, "1", "Ativo Total"), (bpa, "1.01", "Ativo Circulante"),
                                     (bpa, "1.01.01", "Caixa e Equivalentes de Caixa"), (bpa, "1.01.02", "Aplicações Financeiras"),
                                     (bpp, "2.01", "Passivo Circulante"), (bpp, "2.01.04", "Empréstimos e Financiamentos"),
                                     (bpp, "2.02.01", "Empréstimos e Financiamentos"), (bpp, "2.03", "Patrimônio Líquido Consolidado")):
                    if rng.random() > gaps / 2:
                        rows.append((c, "Consolidado", end, cd, ds, rng.randrange(0, 300)))
        day = dt.date(2000, 1, 3)
        while day < dt.date(2001, 2, 10):
            for ticker in [t[0] for t in tickers if t[1] == c]:
                if rng.random() < 0.5 and not (k == 3 and ticker.endswith("4") and day > dt.date(2000, 11, 1)):
                    prices.append((day, ticker, rng.randrange(1, 900) / 10, 1, 1, rng.choice([1000, 2500, 0])))
            day += dt.timedelta(days=rng.randrange(1, 9))
    return make_tables(dre=dre, dva=dva, dfc=dfc, bpa=bpa, bpp=bpp, prices=prices, tickers=tickers)


@pytest.mark.parametrize("seed", [1])
def test_report_equals_the_single_measures(make_tables, seed):
    got = check(random_tables(make_tables, seed))
    assert len(got) >= 9 and any(r["p_e"] is not None for r in got.values())


def test_company_without_reports_or_prices(make_tables):
    tables = make_tables(tickers=[ticker_row("AAAA3", "A"), ticker_row("BBBB3", "B")],
                         prices=[(dt.date(2000, 1, 3), "AAAA3", 2.0, 1, 1, 10)])
    rows = statistics.statistics(tables).collect()
    assert [(r.ticker, r.date, r.market_value, r.ttm_net_income) for r in rows] == [("AAAA3", dt.date(2000, 1, 3), 20.0, None)]


def test_every_stored_table_is_scanned_once(make_tables, spark, tmp_path):
    base = random_tables(make_tables, 3)
    stored = {}
    for name in ("dre", "dva", "dfc", "bpa", "bpp", "prices", "tickers"):
        base.get(name).write.parquet(f"{tmp_path}/{name}")
        stored[name] = spark.read.parquet(f"{tmp_path}/{name}")
    tables = tables_from_frames(**stored)
    for name, df in (("companies", build_companies(tables)), ("scope", build_scope(tables))):
        df.write.parquet(f"{tmp_path}/{name}")
    sc, co = (spark.read.parquet(f"{tmp_path}/{n}") for n in ("scope", "companies"))
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")  # else long paths are cut off
    days = statistics.report_days(tables, co, 5)
    plan = days._jdf.queryExecution().executedPlan().toString()
    for name in ("dre", "dva", "dfc", "bpa", "bpp"):
        assert plan.count(f"{tmp_path}/{name}]") == 1, name
    assert plan.count("Exchange hashpartitioning(cnpj") == 1  # all lines of all measures
    assert plan.count("PushedFilters: [Or(") + plan.count("PushedFilters: [IsNotNull") + plan.count("PushedFilters: [In(") >= 5
    trading = statistics.trading_days(tables, sc)._jdf.queryExecution().executedPlan().toString()
    assert trading.count(f"{tmp_path}/prices]") == 1


def test_rules_name_the_lines_of_the_single_measures():
    rules = statistics.account_rules(5)
    assert statistics.having(rules, statistics.MINUS) == ["ebitda", "ebitda_margin"]
    assert statistics.having(rules, statistics.DIVISOR) == ["ebitda_margin", "gross_profit_margin", "net_profit_margin"]
    assert {t for t, _, _ in rules} == {"dre", "dva", "dfc", "bpa", "bpp"}
    assert income.CFO_CODE and balances.DEBT_CODES
