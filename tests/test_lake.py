"""The lake: loads by registry and by day, slices, states of the scope, measures refreshed by changed companies."""

import datetime as dt
import os
import random

import pytest
from conftest import NI, qend, ticker_row
from pyspark.sql import functions as F
from test_ingest import HEADER, quote_line

from fundlake.plans import income, lake, loads, market, scope
from fundlake.plans.loads import price_load, statement_load
from fundlake.sources import prices_file
from fundlake.sources.catalog import tables_from_frames

CON, IND = "DF Consolidado - Demonstração do Resultado", "DF Individual - Demonstração do Resultado"
ACTIVE = [ticker_row(f"C{k}XX3", f"C{k}") for k in range(1, 6)]
TICKERS = "ticker string, cnpj string, type string, sector string, subsector string, segment string, denom_social string, denom_comerc string"


def land_file(folder, name, lines, age_days=0):
    """A landed statement file; its time is that of the archive."""
    path = folder / name
    path.write_bytes(("\n".join([HEADER] + lines) + "\n").encode("latin-1"))
    then = 1_600_000_000 - age_days * 86_400
    os.utime(path, (then, then))


def report(company, year, quarters, group=CON, scale=1):
    """Year-to-date net income lines of a company."""
    return [f"{company};{group};MIL;ÚLTIMO;{year}-01-01;{qend(year, q)};3.09;{NI};{10 * q * scale + year % 10}" for q in quarters]


@pytest.fixture
def world(spark, tmp_path):
    land = tmp_path / "land"
    land.mkdir()
    for year in (1999, 2000, 2001):
        land_file(land, f"itr_cia_aberta_DRE_con_{year}.csv", [x for k in (1, 2, 3) for x in report(f"C{k}", year, (1, 2, 3), scale=k)], 9)
        land_file(land, f"dfp_cia_aberta_DRE_con_{year}.csv", [x for k in (1, 2, 3) for x in report(f"C{k}", year, (4,), scale=k)], 9)
    land_file(land, "itr_cia_aberta_2001.csv", report("C1", 2001, (1,)), 9)  # an index file, of no statement
    return land, str(tmp_path / "lake"), spark.createDataFrame(ACTIVE, TICKERS)


def rows_of(spark, root, kind="dre"):
    return sorted((r.cnpj, r.dt_refer, r.itr_dfp, r.grupo_dfp, str(r.dt_fim_exerc), r.vl_conta)
                  for r in lake.statements(spark, root, kind).collect())


def archives(spark, root):
    return {r.file_name for r in lake.registry(spark, root).collect()}


def fresh(spark, root, tickers):
    """The loaded tables with the scope derived from the rows, not from the kept states."""
    kept = lake.tables(spark, root, tickers)
    return tables_from_frames(**{**kept.__dict__, "report_dates": None, "price_ends": None})


def same_scope(spark, root, tickers):
    for build in (scope.companies, scope.scope):
        a, b = (sorted(map(tuple, build(t).collect()), key=repr) for t in (lake.tables(spark, root, tickers), fresh(spark, root, tickers)))
        assert a == b
    return a


def test_a_second_load_opens_no_file(spark, world, monkeypatch):
    land, root, tickers = world
    assert {r.cnpj for r in statement_load(spark, str(land), root, tickers).collect()} == {"C1", "C2", "C3"}
    before = rows_of(spark, root)
    assert len(before) == 36 and len(archives(spark, root)) == 6
    monkeypatch.setattr(loads, "load_statement", lambda *a, **k: pytest.fail("a file was opened"))
    assert statement_load(spark, str(land), root, tickers) is None
    assert rows_of(spark, root) == before and lake.generation(spark, root) == 1


def test_a_changed_archive_opens_only_its_own_files(spark, world, monkeypatch):
    land, root, tickers = world
    statement_load(spark, str(land), root, tickers)
    before = rows_of(spark, root)
    land_file(land, "itr_cia_aberta_DRE_con_2000.csv", report("C2", 2000, (1, 2), scale=50) + report("C4", 2000, (1,)))
    opened = []
    read = loads.load_statement
    monkeypatch.setattr(loads, "load_statement", lambda *a, **k: opened.append(k["only_paths"]) or read(*a, **k))
    touched = {r.cnpj for r in statement_load(spark, str(land), root, tickers).collect()}
    assert [[p.rsplit("/", 1)[1] for p in x["DRE"]] for x in opened] == [["itr_cia_aberta_DRE_con_2000.csv"]]
    assert touched == {"C1", "C2", "C3", "C4"}  # companies of the old copy and of the new one
    after = rows_of(spark, root)
    assert [r for r in after if r[1:3] != (2000, "itr")] == [r for r in before if r[1:3] != (2000, "itr")]
    assert [(r[0], r[5]) for r in after if r[1:3] == (2000, "itr")] == [("C2", 500.0), ("C2", 1000.0), ("C4", 10.0)]
    assert lake.generation(spark, root) == 2 and len(archives(spark, root)) == 6
    same_scope(spark, root, tickers)


def test_a_slice_restated_to_nothing_is_emptied(spark, world):
    land, root, tickers = world
    statement_load(spark, str(land), root, tickers)
    assert any(r[1:3] == (2001, "dfp") for r in rows_of(spark, root))
    land_file(land, "dfp_cia_aberta_DRE_con_2001.csv", [x.replace("ÚLTIMO", "PENÚLTIMO") for x in report("C1", 2001, (4,))])
    statement_load(spark, str(land), root, tickers)
    left = rows_of(spark, root)
    assert not any(r[1:3] == (2001, "dfp") for r in left) and len(left) == 33
    # the newest report date falls back with the rows
    ends = {r.cnpj: r.last_statement_date for r in scope.companies(lake.tables(spark, root, tickers)).collect()}
    assert ends["C1"] == qend(2001, 3) and ends["C5"] is None
    same_scope(spark, root, tickers)


def test_a_load_that_dies_is_repeated(spark, world, monkeypatch):
    land, root, tickers = world
    replace = lake.replace_slices

    def dies(*args):
        replace(*args)
        raise RuntimeError("lost")

    monkeypatch.setattr(lake, "replace_slices", dies)
    with pytest.raises(RuntimeError):
        statement_load(spark, str(land), root, tickers)
    assert archives(spark, root) == set()  # the registry has not moved
    monkeypatch.setattr(lake, "replace_slices", replace)
    assert {r.cnpj for r in statement_load(spark, str(land), root, tickers).collect()} == {"C1", "C2", "C3"}
    assert len(rows_of(spark, root)) == 36 and len(archives(spark, root)) == 6


def test_group_of_the_file_names_the_slice(spark, world):
    land, root, tickers = world
    land_file(land, "itr_cia_aberta_DRE_ind_2000.csv", report("C5", 2000, (1, 2, 3), IND))
    statement_load(spark, str(land), root, tickers)
    land_file(land, "itr_cia_aberta_DRE_ind_2000.csv", [], -1)
    statement_load(spark, str(land), root, tickers)
    assert {r[3] for r in rows_of(spark, root)} == {"Consolidado"} and len(rows_of(spark, root)) == 36


def test_refreshed_measure_equals_the_full_computation(spark, world):
    land, root, tickers = world
    early = F.col("file_name").rlike("(1999|2000)$")
    seen = []

    def compute(tables, companies):
        seen.append({r.cnpj for r in companies.collect()})
        return income.net_income(tables, companies=companies)

    def check():
        got = lake.refresh(spark, root, "net_income", compute, lake.tables(spark, root, tickers))
        want = income.net_income(fresh(spark, root, tickers))
        assert sorted(map(tuple, got.select(want.columns).collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)

    statement_load(spark, str(land), root, tickers, early)
    check()
    assert len(seen.pop()) == 5
    statement_load(spark, str(land), root, tickers)
    check()
    assert seen.pop() == {"C1", "C2", "C3"}
    land_file(land, "dfp_cia_aberta_DRE_con_2000.csv", report("C2", 2000, (4,), scale=7))
    land_file(land, "itr_cia_aberta_DRE_con_2001.csv", report("C4", 2001, (1, 2, 3)))
    statement_load(spark, str(land), root, tickers)
    check()
    assert seen.pop() == {"C1", "C2", "C3", "C4"}
    check()
    assert not seen  # nothing changed: nothing is computed


def test_changed_companies_limit_the_rows_below_the_windows(spark, world):
    land, root, tickers = world
    statement_load(spark, str(land), root, tickers)
    t = lake.tables(spark, root, tickers)
    changed = spark.createDataFrame([("C2",)], "cnpj string")
    df = income.net_income(t, companies=scope.companies(t).join(changed, "cnpj", "left_semi"))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Window") < plan.index("LeftSemi")  # the join stands below the first window
    assert {r.cnpj for r in df.collect()} == {"C2"}


# --- prices ------------------------------------------------------------------
def land_day(quotes, instruments, day, tickers, price=100):
    folder = quotes / f"dt={day:%Y%m%d}"
    folder.mkdir()
    base = dict(tipreg="01", codbdi="02", tpmerc="010", especi="ON", totneg=1, quatot=5, voltot=500)
    (folder / "q.txt").write_text("".join(quote_line(**base, preult=price + k, date=f"{day:%Y%m%d}", ticker=t) + "\n" for k, t in enumerate(tickers)))
    folder = instruments / f"dt={day:%Y%m%d}"
    folder.mkdir()
    one = ("<Instrm><RptParams><RptDtAndTm><Dt>{d}</Dt></RptDtAndTm></RptParams><FinInstrmAttrCmon><Mkt>10</Mkt></FinInstrmAttrCmon>"
           "<InstrmInf><EqtyInf><SctyCtgy>11</SctyCtgy><TckrSymb>{t}</TckrSymb><SpcfctnCd>ON NM</SpcfctnCd><CrpnNm>X</CrpnNm>"
           "<MktCptlstn>{n}</MktCptlstn></EqtyInf></InstrmInf></Instrm>")
    (folder / "i.xml").write_text("<BizGrp>" + "".join(one.format(d=day, t=t, n=1000 + k) for k, t in enumerate(tickers)) + "</BizGrp>")


@pytest.fixture
def market_world(spark, tmp_path):
    quotes, instruments = tmp_path / "quotes", tmp_path / "instruments"
    quotes.mkdir(), instruments.mkdir()
    root = str(tmp_path / "lake")
    seed = spark.createDataFrame([(dt.date(2001, 1, 2), "C1XX3", 1.0, 1, 5, 5.0, 900), (dt.date(2001, 1, 2), "C2XX3", 2.0, 1, 5, 5.0, 800)],
                                 "date date, ticker string, preult double, totneg bigint, quatot bigint, voltot double, number_shares bigint")
    lake.write_batch(seed, root, "seed")
    return quotes, instruments, root, spark.createDataFrame([(dt.date(2001, 1, 5),)], "date date")


def test_days_are_loaded_up_to_the_first_that_is_missing(spark, market_world):
    quotes, instruments, root, holidays = market_world
    for day in (3, 4, 8, 10):  # the 5th is a holiday, the 6th and 7th a weekend, the 9th has not landed
        land_day(quotes, instruments, dt.date(2001, 1, day), ["C1XX3"])
    assert price_load(spark, str(quotes), str(instruments), root, holidays) == [dt.date(2001, 1, d) for d in (3, 4, 8)]
    got = sorted((r.date.day, r.ticker, r.number_shares) for r in lake.prices(spark, root).collect())
    assert got == [(2, "C1XX3", 900), (2, "C2XX3", 800), (3, "C1XX3", 1000), (4, "C1XX3", 1000), (8, "C1XX3", 1000)]
    assert price_load(spark, str(quotes), str(instruments), root, holidays) == []
    land_day(quotes, instruments, dt.date(2001, 1, 9), ["C2XX3"])
    assert price_load(spark, str(quotes), str(instruments), root, holidays) == [dt.date(2001, 1, 9), dt.date(2001, 1, 10)]
    ends = {r.ticker: r.last_price_date.day for r in lake.price_ends(spark, root).collect()}
    assert ends == {"C1XX3": 10, "C2XX3": 9}
    tickers = spark.createDataFrame(ACTIVE, TICKERS)
    assert {r[0] for r in same_scope(spark, root, tickers)} == {t[0] for t in ACTIVE}


def test_the_same_batch_replaces_itself(spark, market_world, monkeypatch):
    quotes, instruments, root, holidays = market_world
    for day in (3, 4):
        land_day(quotes, instruments, dt.date(2001, 1, day), ["C1XX3"])
    replace = lake._replace

    def dies(df, path, by):
        if path.endswith("price_ends"):
            raise RuntimeError("lost")
        replace(df, path, by)

    monkeypatch.setattr(lake, "_replace", dies)
    with pytest.raises(RuntimeError):
        price_load(spark, str(quotes), str(instruments), root, holidays)
    monkeypatch.setattr(lake, "_replace", replace)
    price_load(spark, str(quotes), str(instruments), root, holidays)
    assert lake.prices(spark, root).count() == 4


def test_only_the_folders_of_the_due_days_are_read(spark, market_world):
    quotes, instruments, _, _ = market_world
    for day in (3, 4, 8):
        land_day(quotes, instruments, dt.date(2001, 1, day), ["C1XX3"])
    assert prices_file.landed_days(spark, str(quotes)) == {dt.date(2001, 1, d) for d in (3, 4, 8)}
    first, last = dt.date(2001, 1, 4), dt.date(2001, 1, 8)
    for read, path in ((prices_file.read_quote_days, quotes), (prices_file.read_instrument_days, instruments)):
        df = read(spark, str(path), first, last)
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "dt#" in plan and "PartitionFilters: [isnotnull(dt" in plan and ">= 20010104" in plan and "<= 20010108" in plan
        assert plan.count("FileScan") == 1
        assert {r.date.day for r in df.collect()} == {4, 8}


def test_measures_see_what_was_loaded(spark, world, market_world):
    land, root, tickers = world
    quotes, instruments, _, holidays = market_world
    lake.write_batch(spark.createDataFrame([(dt.date(2001, 1, 2), "C1XX3", 1.0, 1, 5, 5.0, 900)],
                                           "date date, ticker string, preult double, totneg bigint, quatot bigint, voltot double, number_shares bigint"), root, "seed")
    statement_load(spark, str(land), root, tickers)
    last = lambda: {r.ticker: (r.date.day, r.price) for r in market.prices(lake.tables(spark, root, tickers), "last").collect()}
    assert last() == {"C1XX3": (2, 1.0)}
    land_day(quotes, instruments, dt.date(2001, 1, 3), ["C1XX3", "C2XX3"], price=700)
    price_load(spark, str(quotes), str(instruments), root, holidays)
    assert last() == {"C1XX3": (3, 7.0), "C2XX3": (3, 7.01)}


def test_an_empty_lake_reads_as_no_rows(spark, tmp_path):
    tickers = spark.createDataFrame(ACTIVE, TICKERS)
    t = lake.tables(spark, str(tmp_path / "none"), tickers)
    assert t.dre.count() == t.prices.count() == 0 and lake.generation(spark, str(tmp_path / "none")) == 0
    assert {r.last_statement_date for r in scope.companies(t).collect()} == {None}


def test_random_loads_keep_the_scope_exact(spark, world):
    land, root, tickers = world
    rng = random.Random(5)
    for step in range(3):
        for _ in range(2):
            year, kind, group = rng.choice((1999, 2000, 2001)), rng.choice(("itr", "dfp")), rng.choice(("con", "ind"))
            lines = [x for k in range(1, 6) if rng.random() < .6 for x in report(f"C{k}", year, (4,) if kind == "dfp" else (1, 2, 3), CON if group == "con" else IND)]
            land_file(land, f"{kind}_cia_aberta_DRE_{group}_{year}.csv", lines, -step)
        statement_load(spark, str(land), root, tickers)
        same_scope(spark, root, tickers)
