"""Ingest readers and sinks on small hand-written files."""

import datetime as dt
import uuid

from conftest import d

from fundlake.sources import sinks
from fundlake.sources.prices_file import QUOTE_FIELDS, merge_shares, parse_instruments, parse_quote_lines
from fundlake.sources.statements_csv import load_statement


def quote_line(**v):
    line = [" "] * 245
    for name, a, b in QUOTE_FIELDS:
        text = str(v.get(name, ""))
        text = text.rjust(b - a, "0") if name in ("preult", "totneg", "quatot", "voltot") else text.ljust(b - a)
        line[a:b] = list(text[: b - a])
    return "".join(line)


def test_quote_lines(spark):
    base = dict(tipreg="01", date="20010102", codbdi="02", ticker="ABCD3", tpmerc="010", especi="ON NM",
                preult=1234, totneg=7, quatot=100, voltot=123400)
    lines = [
        "00COTAHIST.2001" + " " * 230,
        quote_line(**base),
        quote_line(**{**base, "ticker": "ABCD4", "especi": ""}),          # blank spec: kept
        quote_line(**{**base, "ticker": "OPT1", "tpmerc": "070"}),        # option market: dropped
        quote_line(**{**base, "ticker": "FII11", "codbdi": "12"}),        # real-estate fund: dropped
        quote_line(**{**base, "ticker": "ABCD34", "especi": "DRN"}),      # depositary receipt: dropped
        "99COTAHIST.2001" + " " * 230,
    ]
    df = parse_quote_lines(spark.createDataFrame([(x,) for x in lines], "value string"))
    out = sorted((r.ticker, r.date, r.preult, r.totneg, r.quatot, r.voltot) for r in df.collect())
    assert out == [("ABCD3", d("2001-01-02"), 12.34, 7, 100, 1234.0), ("ABCD4", d("2001-01-02"), 12.34, 7, 100, 1234.0)]


def test_instruments_and_merge(spark):
    def inst(t, mkt="10", cat="11", spec="ON", shares="100", last="1.5", equity=True):
        eq = (cat, t, spec, "CO", shares, last) if equity else None
        return ((("2001-01-02",),), (mkt,), (eq,))
    schema = ("RptParams struct<RptDtAndTm: struct<Dt: string>>, FinInstrmAttrCmon struct<Mkt: string>, "
              "InstrmInf struct<EqtyInf: struct<SctyCtgy: string, TckrSymb: string, SpcfctnCd: string, "
              "CrpnNm: string, MktCptlstn: string, LastPric: string>>")
    raw = spark.createDataFrame([
        inst("A3"), inst("A3", shares="90"), inst("B3", last=None), inst("C3", mkt="20"), inst("D3", cat="9"),
        inst("E3", spec="CI X"), inst("F3", spec="DIAX"), inst("G3", equity=False), inst("H3", spec=None)], schema)
    shares = parse_instruments(raw)
    got = sorted((r.ticker, r.number_shares, r.lastpric) for r in shares.collect())
    assert got == [("A3", 90, 1.5), ("A3", 100, 1.5), ("B3", 100, 0.0), ("H3", 100, 1.5)]
    quotes = spark.createDataFrame([(d("2001-01-02"), "A3", 1.0, 1, 1, 1.0), (d("2001-01-02"), "Z3", 1.0, 1, 1, 1.0)],
                                   "date date, ticker string, preult double, totneg bigint, quatot bigint, voltot double")
    merged = {r.ticker: r.number_shares for r in merge_shares(quotes, shares).collect()}
    assert merged == {"A3": 100, "Z3": None}   # duplicate keeps the larger count; no instrument -> NULL


HEADER = "CNPJ_CIA;GRUPO_DFP;ESCALA_MOEDA;ORDEM_EXERC;DT_INI_EXERC;DT_FIM_EXERC;CD_CONTA;DS_CONTA;VL_CONTA"


def _write(folder, name, lines):
    p = folder / name
    p.write_bytes(("\n".join([HEADER] + lines) + "\n").encode("latin-1"))


def test_statement_files(spark, tmp_path):
    land = tmp_path / "land"
    land.mkdir()
    g = "DF Consolidado - Demonstração do Resultado"
    _write(land, "itr_cia_aberta_DRE_con_2001.csv", [
        f"C1;{g};MIL;ÚLTIMO;2001-01-01;2001-06-30;3.01;Receita;500",
        f"C1;{g};MIL;ÚLTIMO;2001-04-01;2001-06-30;3.01;Receita;300",        # quarter only: dropped
        f"C1;{g};MIL;PENÚLTIMO;2000-01-01;2000-06-30;3.01;Receita;400",     # previous period: dropped
        f"C1;{g};UNIDADE;ÚLTIMO;2001-01-01;2001-06-30;3.03;Resultado Bruto;250000",   # units -> thousands
        f"C9;{g};MIL;ÚLTIMO;2001-01-01;2001-06-30;3.01;Receita;1",          # not listed: dropped
    ])
    _write(land, "itr_cia_aberta_2001.csv", [f"C1;{g};MIL;ÚLTIMO;2001-01-01;2001-06-30;9;X;1"])  # index file
    _write(land, "itr_cia_aberta_DFC_MI_con_2001.csv", [f"C1;{g};MIL;ÚLTIMO;2001-01-01;2001-06-30;6.01;Op;70"])
    _write(land, "itr_cia_aberta_DFC_MD_con_2001.csv", [f"C1;{g};MIL;ÚLTIMO;2001-01-01;2001-06-30;6.01;Op;71",
                                                         f"C1;{g};MIL;ÚLTIMO;2001-01-01;2001-06-30;6.02;Inv;-5"])
    active = spark.createDataFrame([("C1",)], "cnpj string")
    dre = load_statement(spark, str(land), "dre", active).orderBy("cd_conta").collect()
    assert [(r.cd_conta, r.vl_conta, r.grupo_dfp, r.itr_dfp, r.dt_refer, r.fiscal_quarter) for r in dre] == [
        ("3.01", 500.0, "Consolidado", "itr", 2001, 2.0), ("3.03", 250.0, "Consolidado", "itr", 2001, 2.0)]
    dfc = load_statement(spark, str(land), "dfc", active).orderBy("cd_conta").collect()
    assert [(r.cd_conta, r.vl_conta) for r in dfc] == [("6.01", 70.0), ("6.02", -5.0)]   # indirect method wins


def test_replace_slices_twice_equals_once(spark, tmp_path):
    path = str(tmp_path / f"t{uuid.uuid4().hex}")
    rows = [(2000, "itr", "Consolidado", "3.01", 1.0), (2001, "itr", "Consolidado", "3.01", 2.0),
            (2001, "dfp", "Consolidado", "3.01", 3.0)]
    df = spark.createDataFrame(rows, "dt_refer int, itr_dfp string, grupo_dfp string, cd_conta string, vl_conta double")
    sinks.replace_slices(df, path)
    restated = spark.createDataFrame([(2001, "itr", "Consolidado", "3.01", 20.0)], df.schema)
    sinks.replace_slices(restated, path)
    once = sorted(tuple(r) for r in spark.read.parquet(path).select(*df.columns).collect())
    sinks.replace_slices(restated, path)
    twice = sorted(tuple(r) for r in spark.read.parquet(path).select(*df.columns).collect())
    assert once == twice == [(2000, "itr", "Consolidado", "3.01", 1.0), (2001, "dfp", "Consolidado", "3.01", 3.0),
                             (2001, "itr", "Consolidado", "3.01", 20.0)]


def test_changed_files_and_registry(spark):
    ts = dt.datetime(2001, 1, 1)
    available = spark.createDataFrame([("a", ts), ("b", ts), ("c", ts)], "file_name string, url_date timestamp_ntz")
    registered = spark.createDataFrame([("a", ts), ("b", ts - dt.timedelta(days=1)), ("z", ts)],
                                       "file_name string, last_modified timestamp_ntz")
    changed = sinks.changed_files(available, registered)
    assert sorted(r.file_name for r in changed.collect()) == ["b", "c"]
    reg = sorted((r.file_name, r.last_modified) for r in sinks.registry_upsert(registered, changed).collect())
    assert reg == [("a", ts), ("b", ts), ("c", ts), ("z", ts)]


def test_seed_only_when_empty(spark, tmp_path):
    path = str(tmp_path / f"s{uuid.uuid4().hex}")
    seed = spark.createDataFrame([(1,)], "x int")
    assert sinks.seed_if_empty(spark, path, seed) is True
    assert sinks.seed_if_empty(spark, path, seed) is False
    assert spark.read.parquet(path).count() == 1


def test_file_names_are_matched_per_file_not_per_row(spark, tmp_path):
    g = "DF Consolidado - Demonstração do Resultado"
    land = tmp_path / "land é 1"  # a path that is written otherwise as a URI
    (land / "x_DRE_x").mkdir(parents=True)
    line = f"C1;{g};MIL;ÚLTIMO;2001-01-01;2001-03-31;3.0{{}};Receita;5"
    _write(land, "dfp_cia_aberta_DRE_ind_2001.csv", [line.format(1)])
    _write(land, "xyz_cia_aberta_DRE_con_2001.csv", [line.format(2)])  # a name that does not match is left out
    _write(land / "x_DRE_x", "itr_cia_aberta_DRE_con_1999.csv", [line.format(3)])
    active = spark.createDataFrame([("C1",)], "cnpj string")
    for only in (None, {"DRE": sorted(str(p) for p in land.rglob("*.csv"))}):
        df = load_statement(spark, str(land), "dre", active, only)
        assert "regexp_extract" not in df._jdf.queryExecution().optimizedPlan().toString()
        assert sorted((r.itr_dfp, r.dt_refer, r.cd_conta) for r in df.collect()) == [("dfp", 2001, "3.01"), ("itr", 1999, "3.03")]
