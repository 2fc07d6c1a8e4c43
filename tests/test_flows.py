"""Hand-worked cases for the year-to-date flow windows."""

from conftest import NI, NI_B, flow_row, qend, ticker_row

from fundlake.plans import income, scope


def _rows(df, *cols):
    return [tuple(r[c] for c in cols) for r in df.orderBy("cnpj", "grupo_dfp", "date").collect()]


def test_first_quarter_reset_and_ttm(make_tables):
    ytd = {(2000, 1): 10, (2000, 2): 25, (2000, 3): 45, (2000, 4): 70, (2001, 1): 12}
    dre = [flow_row("A", y, q, "3.09", NI, v) for (y, q), v in ytd.items()]
    t = make_tables(dre=dre, tickers=[ticker_row("AAAA3", "A")])
    out = _rows(income.net_income(t), "ytd_net_income", "quarter_net_income", "ttm_net_income")
    assert out == [(10, 10, None), (25, 15, None), (45, 20, None), (70, 25, 70), (12, 12, 72)]


def test_missing_quarter_is_row_based(make_tables):
    # Q3 missing: the Q4 "quarter" is ytd(Q4) - ytd(Q2), as in the source tool
    ytd = {(2000, 1): 10, (2000, 2): 25, (2000, 4): 70, (2001, 1): 5, (2001, 2): 11}
    dre = [flow_row("A", y, q, "3.01", "Receita", v) for (y, q), v in ytd.items()]
    t = make_tables(dre=dre, tickers=[ticker_row("AAAA3", "A")])
    out = _rows(income.revenue(t), "quarter_revenue", "ttm_revenue")
    assert out == [(10, None), (15, None), (45, None), (5, 75), (6, 71)]


def test_label_fallback_per_company(make_tables):
    dre = []
    for q, v in [(1, 1), (2, 3), (3, 6), (4, 10)]:
        dre.append(flow_row("A", 2000, q, "3.09", NI, v))
        dre.append(flow_row("A", 2000, q, "3.11", NI_B, 100 * v))   # ignored: A has the preferred label
        dre.append(flow_row("B", 2000, q, "3.11", NI_B, 7 * v))     # B only has the fallback label
    t = make_tables(dre=dre, tickers=[ticker_row("AAAA3", "A"), ticker_row("BBBB3", "B")])
    out = income.net_income(t, quarter=False, ttm=False).orderBy("cnpj", "date").collect()
    assert [(r.cnpj, r.ytd_net_income) for r in out] == [
        ("A", 1), ("A", 3), ("A", 6), ("A", 10), ("B", 7), ("B", 21), ("B", 42), ("B", 70)]


def test_annual_only_company_has_no_quarter_or_ttm(make_tables):
    dre = [flow_row("A", y, 4, "3.01", "Receita", 100 * (y - 1990)) for y in range(1995, 2001)]
    t = make_tables(dre=dre, tickers=[ticker_row("AAAA3", "A")])
    co = scope.companies(t).collect()
    assert co[0].freq == "A"
    out = _rows(income.revenue(t), "ytd_revenue", "quarter_revenue", "ttm_revenue")
    assert all(q is None and tt is None for _, q, tt in out)
    assert [y for y, _, _ in out] == [500, 600, 700, 800, 900, 1000]


def test_group_falls_back_to_individual(make_tables):
    dre = [flow_row("A", 2000, q, "3.01", "Receita", q, grupo="Individual") for q in (1, 2, 3, 4)]
    t = make_tables(dre=dre, tickers=[ticker_row("AAAA3", "A")])
    assert scope.companies(t).collect()[0].grupo_dfp == "Individual"
    assert income.revenue(t).count() == 4


def test_start_period_lookback_and_trim(make_tables):
    ytd = {(1999, 1): 1, (1999, 2): 2, (1999, 3): 3, (1999, 4): 4, (2000, 1): 1, (2000, 2): 2}
    dre = [flow_row("A", y, q, "3.01", "Receita", v) for (y, q), v in ytd.items()]
    t = make_tables(dre=dre, tickers=[ticker_row("AAAA3", "A")])
    out = income.revenue(t, start_period="2000-01-01").orderBy("date").collect()
    # rows before the start are read for the windows, then dropped
    assert [(r.date, r.ttm_revenue) for r in out] == [(qend(2000, 1), 4), (qend(2000, 2), 4)]


def test_last_keeps_newest_report(make_tables):
    dre = [flow_row("A", 2000, q, "3.01", "Receita", q * 10) for q in (1, 2, 3, 4)]
    t = make_tables(dre=dre, tickers=[ticker_row("AAAA3", "A")])
    out = income.revenue(t, start_period="last").collect()
    assert [(r.date, r.ytd_revenue, r.ttm_revenue) for r in out] == [(qend(2000, 4), 40, 40)]


def test_ebitda_subtracts_negative_d_a(make_tables):
    ebit = "Resultado Antes do Resultado Financeiro e dos Tributos"
    dre = [flow_row("A", 2000, q, "3.05", ebit, 10 * q) for q in (1, 2, 3, 4)]
    dva = [flow_row("A", 2000, q, "7.04.01", income.D_A_LABEL, -q) for q in (1, 2, 3, 4)]
    t = make_tables(dre=dre, dva=dva, tickers=[ticker_row("AAAA3", "A")])
    out = _rows(income.ebitda(t), "ytd_ebitda", "quarter_ebitda", "ttm_ebitda")
    assert out == [(11, 11, None), (22, 11, None), (33, 11, None), (44, 11, 44)]
