"""Hand-worked cases for balances, margins, market measures, growth, statements and peers."""

import datetime as dt

import pytest
from conftest import NI, d, flow_row, qend, ticker_row

from fundlake.plans import balances, compare, growth, margins, market, peers, statements


def _co_tables(make_tables, **kw):
    return make_tables(tickers=[ticker_row("AAAA3", "A"), ticker_row("AAAA4", "A", "PN")], **kw)


def test_zero_divisor_gives_null(make_tables):
    bpa = [("A", "Consolidado", qend(2000, q), "1.01", "Ativo Circulante", 10) for q in (1, 2, 3)]
    bpp = [("A", "Consolidado", qend(2000, q), "2.01", "Passivo Circulante", 0 if q == 2 else 5) for q in (1, 2, 3)]
    dre = [flow_row("A", 2000, q, "3.01", "Receita", q) for q in (1, 2, 3)]
    t = _co_tables(make_tables, bpa=bpa, bpp=bpp, dre=dre)
    out = [r.current_ratio for r in balances.current_ratio(t).orderBy("date").collect()]
    assert out == [2.0, None, 2.0]


def test_net_debt_keeps_dates_of_either_side(make_tables):
    bpa = [("A", "Consolidado", qend(2000, 1), "1.01.01", "Caixa e Equivalentes de Caixa", 3),
           ("A", "Consolidado", qend(2000, 1), "1.01.02", "Aplicações Financeiras", 2),
           ("A", "Consolidado", qend(2000, 1), "1.02.01.03.01", "Aplicações Financeiras", 100)]
    bpp = [("A", "Consolidado", qend(2000, 1), "2.01.04", "Empréstimos e Financiamentos", 20),
           ("A", "Consolidado", qend(2000, 2), "2.02.01", "Empréstimos e Financiamentos", 30)]
    dre = [flow_row("A", 2000, q, "3.01", "Receita", q) for q in (1, 2)]
    t = _co_tables(make_tables, bpa=bpa, bpp=bpp, dre=dre)
    out = [(r.date, r.net_debt) for r in balances.net_debt(t).orderBy("date").collect()]
    assert out == [(qend(2000, 1), 15), (qend(2000, 2), None)]


def test_gross_margin_ratios(make_tables):
    dre = []
    for q, (rev, gp) in enumerate([(100, 40), (250, 100), (400, 150), (600, 240)], start=1):
        dre += [flow_row("A", 2000, q, "3.01", "Receita", rev), flow_row("A", 2000, q, "3.03", "Resultado Bruto", gp)]
    t = _co_tables(make_tables, dre=dre)
    out = margins.gross_profit_margin(t).orderBy("date").collect()
    assert [r.ytd_gross_profit_margin for r in out] == [40.0, 40.0, 37.5, 40.0]
    assert [r.gross_profit_margin for r in out] == [40.0, 40.0, 50.0 / 150 * 100, 45.0]
    assert [r.ttm_gross_profit_margin for r in out] == [None, None, None, 40.0]


def test_eps_on_statement_date_off_the_trading_calendar(make_tables):
    # 2000-12-31 is a Sunday: the EPS row there uses the shares of Friday
    dre = [flow_row("A", 2000, q, "3.09", NI, 10 * q) for q in (1, 2, 3, 4)]
    prices = [(d("2000-12-29"), "AAAA3", 5.0, 1, 1, 1000), (d("2000-12-29"), "AAAA4", 4.0, 1, 1, 1000),
              (d("2001-01-02"), "AAAA3", 6.0, 1, 1, 2000)]
    t = _co_tables(make_tables, dre=dre, prices=prices)
    out = [(r.date, r.eps) for r in market.eps(t).orderBy("date").collect()]
    # ttm at Q4 = 40 (thousands); shares = 1000 + 1000 on 12-29, 2000 + 0 (no PN row) on 01-02
    assert out == [(d("2000-12-31"), 40 * 1000 / 2000), (d("2001-01-02"), 40 * 1000 / 2000)]


def test_market_value_sums_share_classes(make_tables):
    dre = [flow_row("A", 2000, 4, "3.01", "Receita", 1)]
    prices = [(d("2001-01-02"), "AAAA3", 2.0, 1, 1, 10), (d("2001-01-02"), "AAAA4", 3.0, 1, 1, 100),
              (d("2001-01-03"), "AAAA3", 2.5, 1, 1, 10)]
    t = _co_tables(make_tables, dre=dre, prices=prices)
    out = market.market_value(t).filter("ticker = 'AAAA4'").orderBy("date").collect()
    assert [(r.date, r.market_value) for r in out] == [(d("2001-01-02"), 320.0), (d("2001-01-03"), 25.0)]
    last = market.market_value(t, start_period="last")
    # 'last' is the ticker's own newest price date
    assert [(r.ticker, r.date) for r in last.orderBy("ticker", "date").collect()] == [
        ("AAAA3", d("2001-01-03")), ("AAAA4", d("2001-01-02")), ("AAAA4", d("2001-01-03"))]


def test_cagr_negative_base_and_zero_first_are_null(make_tables):
    def series(cnpj, ytd):
        return [flow_row(cnpj, y, q, "3.01", "Receita", ytd(y, q)) for y in range(1995, 2002) for q in (1, 2, 3, 4)]
    pos = series("A", lambda y, q: (y - 1990) * 10 * q)                 # growing ttm
    neg = series("B", lambda y, q: 10 * q if y < 2000 else -10 * q)     # ttm turns negative
    t = make_tables(dre=pos + neg, tickers=[ticker_row("AAAA3", "A"), ticker_row("BBBB3", "B")])
    out = {r.cnpj: r.cagr_revenue for r in growth.cagr_revenue(t).collect()}
    assert out["A"] is not None and out["A"] > 0
    assert out["B"] is None


def test_income_statement_changes_and_merged_descriptions(make_tables):
    dre = [flow_row("A", 1999, 4, "3.01", "Receita B", 80), flow_row("A", 2000, 1, "3.01", "Receita A", 30),
           flow_row("A", 2000, 2, "3.01", "Receita A", 50), flow_row("A", 2000, 4, "3.01", "Receita B", 100)]
    t = _co_tables(make_tables, dre=dre)
    out = statements.income_statement(t, ttm=False).orderBy("date").collect()
    assert {r.ds_conta for r in out} == {"Receita A"}             # first description in code-point order
    assert [r.ytd_pct_change for r in out] == [0.0, 0.0, 0.0, 25.0]  # vs the same date a year before
    assert [r.quarter_value_pct_change for r in out] == pytest.approx([0.0, 0.0, -100 / 3, 150.0])


def test_peers_membership(make_tables):
    tick = [ticker_row("AAAA3", "A", sector="X"), ticker_row("BBBB3", "B", sector="X"),
            ticker_row("CCCC3", "C", sector="Y")]
    dre = [flow_row(c, 2000, 1, "3.01", "Receita", 1) for c in "ABC"]
    t = make_tables(dre=dre, tickers=tick)
    got = sorted(r.ticker for r in peers.get_peers(t, ["bbbb3"]).collect())
    assert got == ["AAAA3", "BBBB3"]


def test_compare_wide_and_common(make_tables, spark):
    long = spark.createDataFrame([("A", d("2000-01-01"), 1.0), ("B", d("2000-01-01"), 2.0),
                                  ("A", d("2000-01-02"), 3.0)], "ticker string, date date, v double")
    wide = compare.compare_wide(long, ["a", "b"]).orderBy("date").collect()
    assert [tuple(r) for r in wide] == [(d("2000-01-01"), 1.0, 2.0), (d("2000-01-02"), 3.0, None)]
    assert compare.compare_wide(long, ["a", "b"]).columns == ["date", "v A", "v B"]
    common = compare.compare_common(long, 2).collect()
    assert {r.date for r in common} == {d("2000-01-01")}


def test_unknown_measure_and_bad_start(make_tables):
    import pytest
    t = _co_tables(make_tables, dre=[flow_row("A", 2000, 1, "3.01", "Receita", 1)])
    with pytest.raises(ValueError):
        compare.compare_measure(t, "nope")
    with pytest.raises(ValueError):
        balances.total_assets(t, start_period="not a date")
    assert dt.date(2000, 1, 1)


def test_filled_per_peer_group(spark):
    day = [d(f"2000-01-0{k}") for k in range(1, 6)]
    long = spark.createDataFrame([("A1", day[0], 1.0), ("A2", day[1], 5.0), ("A1", day[3], 2.0), ("B1", day[4], 9.0)],
                                 "ticker string, date date, v double")
    members = spark.createDataFrame([("A1", "a"), ("A2", "a"), ("A3", "a"), ("B1", "b"), ("B2", "b")], "ticker string, g string")
    got = sorted((r.ticker, r.date.day, r.v) for r in compare.compare_groups(long, members, ["g"]).collect())
    assert got == [("A1", 1, 1.0), ("A1", 2, 1.0), ("A1", 4, 2.0), ("A2", 1, None), ("A2", 2, 5.0), ("A2", 4, 5.0),
                   ("A3", 1, None), ("A3", 2, None), ("A3", 4, None), ("B1", 5, 9.0), ("B2", 5, None)]
    assert sorted((r.ticker, r.date.day) for r in compare.compare_filled(long, ["a1", "b1"]).collect()) == [
        ("A1", 1), ("A1", 4), ("A1", 5), ("B1", 1), ("B1", 4), ("B1", 5)]


def test_wide_by_group_leader(make_tables, spark):
    t = make_tables(tickers=[ticker_row("BB3", "B", sector="x"), ticker_row("AA3", "A", sector="x"), ticker_row("CC3", "C", sector="y")])
    lead = peers.leaders(t)
    assert {(r.ticker, r.sector) for r in lead.collect()} == {("AA3", "x"), ("CC3", "y")}
    long = spark.createDataFrame([("AA3", d("2000-01-01"), 1.0), ("BB3", d("2000-01-01"), 2.0), ("CC3", d("2000-01-02"), 3.0)],
                                 "ticker string, date date, v double")
    wide = compare.compare_wide_by(long, lead, "sector")
    assert wide.columns == ["date", "v x", "v y"]
    assert sorted(map(tuple, wide.collect())) == [(d("2000-01-01"), 1.0, None), (d("2000-01-02"), None, 3.0)]
    assert {r.ticker for r in peers.get_peers(t, lead).collect()} == {"AA3", "BB3", "CC3"}


def test_filled_rows_are_made_in_place(spark):
    """Repeated tickers and repeated rows give every copy, a missing value is carried; filled rows meet no exchange."""
    day = [d(f"2000-01-0{k}") for k in range(1, 7)]
    long = spark.createDataFrame([("A1", day[1], 1.0), ("A1", day[1], 1.0), ("A1", day[3], None), ("A2", day[0], 5.0), ("A2", day[2], 6.0),
                                  ("C1", day[5], 7.0)], "ticker string, date date, v double")
    members = spark.createDataFrame([("A1", "a"), ("A1", "a"), ("A2", "a"), ("C1", None)], "ticker string, g string")
    out = compare.compare_groups(long, members, ["g"], parts=3)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Generate explode" in plan.split("Exchange")[0] and "Generate" not in plan.split("Exchange", 1)[1]
    got = sorted(((r.ticker, r.date.day, r.v) for r in out.collect()), key=repr)
    a1 = [("A1", 1, None), ("A1", 2, 1.0), ("A1", 2, 1.0), ("A1", 3, 1.0), ("A1", 4, 1.0)]
    assert got == sorted([*a1, *a1, ("A2", 1, 5.0), ("A2", 2, 5.0), ("A2", 3, 6.0), ("A2", 4, 6.0)], key=repr)
