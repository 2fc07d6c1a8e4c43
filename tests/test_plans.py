"""Plan shape: one exchange per flow measure, predicates pushed to the Parquet scan."""

import datetime as dt

from conftest import FLOW, NI, flow_row, ticker_row

from fundlake.plans import income
from fundlake.sources.catalog import tables_from_frames


def _companies(spark, tmp_path):
    """The companies dimension as stored Parquet (with size statistics), as in real runs."""
    path = str(tmp_path / "companies")
    spark.createDataFrame([("A", "Consolidado", "Q", dt.date(2000, 12, 31))],
                          "cnpj string, grupo_dfp string, freq string, last_statement_date date").write.parquet(path)
    return spark.read.parquet(path)


def test_flow_measure_has_one_exchange(make_tables, spark, tmp_path):
    dre = [flow_row("A", 2000, q, "3.09", NI, 10 * q) for q in (1, 2, 3, 4)]
    path = str(tmp_path / "dre")
    spark.createDataFrame(dre, FLOW).write.parquet(path)
    base = make_tables(tickers=[ticker_row("AAAA3", "A")])
    t = tables_from_frames(**{**base.__dict__, "dre": spark.read.parquet(path)})
    plan = income.net_income(t, companies=_companies(spark, tmp_path))._jdf.queryExecution().executedPlan().toString()
    # label preference, lag and the rolling sum all reuse one hash partitioning on the company key
    assert plan.count("Exchange hashpartitioning") == 1
    assert "hashpartitioning(cnpj" in plan


def _fact_exchanges(df) -> int:
    """Hash exchanges of an executed plan without broadcasts, the companies dimension's own left out."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in plan.split("\n") if "Exchange hashpartitioning" in line]
    return len(exchanges) - 1


def test_two_table_measures_have_one_exchange_on_fact_rows(make_tables, spark, tmp_path):
    """Beside the exchanges of the join with the companies (no broadcast), only the one on the company key."""
    from fundlake.plans import margins, statements

    dre = [flow_row("A", 2000, q, "3.09", NI, 10 * q) for q in (1, 2, 3, 4)]
    paths = {n: str(tmp_path / n) for n in ("dre", "dva")}
    for p in paths.values():
        spark.createDataFrame(dre, FLOW).write.parquet(p)
    base = make_tables(tickers=[ticker_row("AAAA3", "A")])
    t = tables_from_frames(**{**base.__dict__, **{n: spark.read.parquet(p) for n, p in paths.items()}})
    co = _companies(spark, tmp_path)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for fn in (income.net_income, income.ebitda, margins.net_profit_margin, margins.ebitda_margin):
            assert _fact_exchanges(fn(t, companies=co)) == 1, fn.__name__
        plan = statements.income_statement(t, companies=co)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan parquet") == 2  # the statement once, and the companies
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_label_predicate_reaches_the_scan(make_tables, spark, tmp_path):
    dre = [flow_row("A", 2000, q, "3.09", NI, 10 * q) for q in (1, 2, 3, 4)]
    path = str(tmp_path / "dre")
    spark.createDataFrame(dre, FLOW).write.partitionBy("grupo_dfp").parquet(path)
    base = make_tables(tickers=[ticker_row("AAAA3", "A")])
    t = tables_from_frames(**{**base.__dict__, "dre": spark.read.parquet(path)})
    plan = income.net_income(t, companies=_companies(spark, tmp_path))._jdf.queryExecution().executedPlan().toString()
    scan = [line for line in plan.split("\n") if "FileScan parquet" in line][0]
    assert "PushedFilters: [IsNotNull(dt_fim_exerc), In(ds_conta" in scan
    assert "dt_ini_exerc" not in scan.split("ReadSchema:")[1]       # unused columns are not read


def test_last_reaches_the_price_scan(spark):
    """'last' gives the price scan a literal date, and prices are stored by year, so older files are skipped."""
    import os

    import pytest

    from fundlake.plans import market
    from fundlake.sources.catalog import load_tables

    sf = "/root/testdata/sf0.001"
    if not os.path.exists(sf):
        pytest.skip("test data not present")
    t = load_tables(spark, sf)
    assert any("year=" in f for f in t.prices.inputFiles())
    for df in (market.market_value(t, "last"), market.prices(t, "last"), market.total_shares(t, "last")):
        plan = df._jdf.queryExecution().executedPlan().toString()
        scan = [line for line in plan.split("\n") if "FileScan parquet" in line and "preult" in line or "number_shares" in line
                and "FileScan" in line][0]
        assert "GreaterThanOrEqual(date," in scan
