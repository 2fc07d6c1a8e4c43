"""Properties of the flow windows on random year-to-date series."""

from conftest import flow_row, ticker_row
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from fundlake.plans import income

quarter_values = st.lists(st.integers(-1000, 1000), min_size=8, max_size=8)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(quarter_values)
def test_four_quarters_add_up_to_q4_ytd(make_tables, qs):
    dre, ytd = [], 0
    for i, q in enumerate(qs):
        year, fq = 1999 + i // 4, i % 4 + 1
        ytd = q if fq == 1 else ytd + q
        dre.append(flow_row("A", year, fq, "3.01", "Receita", ytd))
    t = make_tables(dre=dre, tickers=[ticker_row("AAAA3", "A")])
    rows = income.revenue(t).orderBy("date").collect()
    assert [r.quarter_revenue for r in rows] == qs
    for r in rows:
        if r.date.month == 12:
            year_rows = [x for x in rows if x.date.year == r.date.year]
            assert sum(x.quarter_revenue for x in year_rows) == r.ytd_revenue
            assert r.ttm_revenue == r.ytd_revenue      # ttm at Q4 = ytd at Q4
