"""Stand-in landed files rendered from the stored tables (test input only).

The driver ships no raw quote files, instrument XML or statement CSVs, so
they are rendered from the derived tables and written once to the shared
folder; the ingest readers then parse them back.  Rendering only writes
rows in the raw formats, with the kinds of noise the readers must remove:

* quote lines: a header (00) and trailer (99) record, copies in excluded
  markets, BDI codes and depositary-receipt specifications, and blank
  specifications that must be kept;
* quote lines that cannot be read (date, price, cut off, record type);
* instrument XML: two namespace versions, instruments without an equity
  block, a missing last price, excluded markets/categories/specifications
  and a duplicate (date, ticker) with a smaller share count; some quotes
  have no instrument at all, some have a second one with an unreadable date or share count;
* statement CSVs: previous-period copies, quarter-only rows with a later
  period start, values in units instead of thousands, companies that are
  not listed, and the direct cash-flow method beside the indirect one.
"""

from __future__ import annotations

import datetime as dt
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fundlake.sources.catalog import Tables
from fundlake.sources.sinks import table_is_empty


def _num(col: Column, width: int) -> Column:
    return F.lpad(col.cast("bigint").cast("string"), width, "0")


def _txt(col: Column, width: int) -> Column:
    return F.rpad(F.coalesce(col, F.lit("")), width, " ")


def _quote_line(tipreg, date, codbdi, ticker, tpmerc, especi, cents, totneg, quatot, voltot_cents) -> Column:
    return F.concat(
        F.lit(tipreg), F.date_format(date, "yyyyMMdd"), F.lit(codbdi), _txt(ticker, 12), F.lit(tpmerc),
        _txt(F.concat(F.lit("CO"), F.substring(ticker, 2, 10)), 12), _txt(especi, 10),
        F.lit("   "), F.lit("R$  "), F.lit("0" * 13 * 4),
        _num(cents, 13), F.lit("0" * 13 * 2), _num(totneg, 5), _num(quatot, 18), _num(voltot_cents, 18),
        F.lit("0" * 13), F.lit("0"), F.lit("99991231"), F.lit("0000001"), F.lit("0" * 13),
        F.lit("BRXXXXACNOR0"), F.lit("100"))


def rendered_quotes(prices: DataFrame) -> DataFrame:
    """Fixed-width quote lines (245 characters) for every price row, plus noise lines, in one pass over the rows:
    the day and kind of each line beside it."""
    p = prices.select(
        "date", "ticker", F.round(F.col("preult") * 100).cast("bigint").alias("cents"), "totneg", "quatot")
    especi = F.when(F.col("quatot") % 5 == 0, F.lit(None)).otherwise(
        F.when(F.substring("ticker", -1, 1) == "3", F.lit("ON NM")).otherwise(F.lit("PN N1")))
    # 0 the quote, 1 a forward market copy, 2 a real-estate fund BDI copy, 3 a depositary receipt copy, and lines that
    # cannot be read: 4 an impossible date, 5 a price of letters, 6 a line cut off, 7 an unknown record type
    every = {1: 3, 2: 4, 3: 7, 4: 19, 5: 29, 6: 31, 7: 37}
    x = p.select("*", especi.alias("especi"), F.explode(F.array(*[F.lit(i) for i in range(8)])).alias("v"))
    v = F.col("v")
    keep = v == 0
    for i, n in every.items():
        keep = keep | ((v == i) & (F.col("quatot") % n == 0))
    line = _quote_line(
        "01", F.col("date"), F.when(v == 2, F.lit("12")).otherwise(F.lit("02")), F.col("ticker"),
        F.when(v == 1, F.lit("030")).otherwise(F.lit("010")),
        F.when(v == 3, F.lit("DRN")).otherwise(F.col("especi")),
        F.col("cents"), F.col("totneg"), F.col("quatot"), F.col("quatot") * 100)
    x = x.filter(keep).select("date", "v", line.alias("line"))
    before = lambda n: F.substring("line", 1, n)
    after = lambda n: F.col("line").substr(F.lit(n + 1), F.lit(245))
    return x.select(
        "date", "v",
        F.when(v == 4, F.concat(before(2), F.lit("20019931"), after(10)))
        .when(v == 5, F.concat(before(108), F.lit("PRICE_UNKNOWN"), after(121)))
        .when(v == 6, before(60)).when(v == 7, F.concat(F.lit("42"), after(2)))
        .otherwise(F.col("line")).alias("value"))


def quote_lines(prices: DataFrame) -> DataFrame:
    """The quote lines of the price rows, and one header and one trailer record per trading day."""
    ends = prices.select("date").distinct().select("date", F.explode(F.array(F.lit("00"), F.lit("99"))).alias("tipreg"))
    return rendered_quotes(prices).select("value").unionByName(ends.select(
        F.concat("tipreg", F.lit("COTAHIST."), F.date_format("date", "yyyyMMdd"), F.lit(" " * 225)).alias("value")))


def instrument_rows(prices: DataFrame) -> DataFrame:
    """Nested rows for the XML writer (row tag ``Instrm``)."""
    p = prices.select("date", "ticker", "preult", "quatot", "number_shares")
    p = p.filter(F.col("quatot") % 11 != 0)  # these quotes get no instrument row
    kinds = F.array(*[F.lit(i) for i in range(9)])
    x = p.select("*", F.explode(kinds).alias("k"))
    k = F.col("k")
    keep = ((k == 0) | ((k == 1) & (F.col("quatot") % 6 == 0)) | ((k == 2) & (F.col("quatot") % 8 == 0))
            | ((k == 3) & (F.col("quatot") % 9 == 0)) | ((k == 4) & (F.col("quatot") % 10 == 0))
            | ((k == 7) & (F.col("quatot") % 19 == 0)) | ((k == 8) & (F.col("quatot") % 23 == 0))
            | ((k == 5) & (F.col("quatot") % 13 == 0)) | ((k == 6) & (F.col("quatot") % 17 == 0)))
    x = x.filter(keep)
    spec = (F.when(k == 3, F.lit("CI")).when(k == 4, F.lit("DIA"))
            .when(F.substring("ticker", -1, 1) == "3", F.lit("ON NM")).otherwise(F.lit("PN N1")))
    mkt = F.when(k == 1, F.lit("20")).otherwise(F.lit("10"))
    cat = F.when(k == 2, F.lit("9")).otherwise(F.lit("11"))
    shares = F.when(k == 6, F.col("number_shares") - 1).otherwise(F.col("number_shares"))
    last = F.when(F.col("quatot") % 4 == 0, F.lit(None).cast("string")).otherwise(F.col("preult").cast("string"))
    equity = F.struct(cat.alias("SctyCtgy"), F.col("ticker").alias("TckrSymb"), spec.alias("SpcfctnCd"),
                      F.concat(F.lit("CO "), F.col("ticker")).alias("CrpnNm"),
                      F.when(k == 8, F.lit("unknown")).otherwise(shares.cast("string")).alias("MktCptlstn"), last.alias("LastPric"))
    option = F.struct(F.concat(F.col("ticker"), F.lit("X")).alias("TckrSymb"))
    info = F.struct(F.when(k != 5, equity).alias("EqtyInf"), F.when(k == 5, option).alias("OptnOnEqtsInf"))
    ns = F.when(F.year("date") < 1998, F.lit("urn:bvmf.100.01.xsd")).otherwise(F.lit("urn:bvmf.100.02.xsd"))
    return x.select(
        ns.alias("_xmlns"),
        F.struct(F.struct(F.when(k == 7, F.lit("2001-99-31")).otherwise(F.col("date").cast("string")).alias("Dt")).alias("RptDtAndTm"))
        .alias("RptParams"),
        F.struct(F.when(k == 5, F.lit("70")).otherwise(mkt).alias("Mkt")).alias("FinInstrmAttrCmon"),
        info.alias("InstrmInf"))


def _file_name(kind_col: Column, stmt: str, grupo: Column, year: Column) -> Column:
    return F.concat(kind_col, F.lit(f"_cia_aberta_{stmt}_"),
                    F.when(grupo == "Consolidado", F.lit("con")).otherwise(F.lit("ind")),
                    F.lit("_"), year.cast("string"), F.lit(".csv"))


# Statement columns of the stand-in changes-in-equity statement and their value multipliers.
DMPL_COLUMNS = [("Capital Social Integralizado", 1), ("Lucros ou Prejuízos Acumulados", 2)]


def dmpl_source(dre: DataFrame) -> DataFrame:
    """Stand-in changes-in-equity rows: every income-statement row in two statement columns."""
    cols = F.array(*[F.struct(F.lit(c).alias("coluna_df"), F.lit(k).alias("k")) for c, k in DMPL_COLUMNS])
    x = dre.select("*", F.inline(cols))
    return x.withColumn("vl_conta", F.col("vl_conta") * F.col("k")).drop("k")


#: Stored rows of a statement per part of its files, about.
ROWS_PER_PART = 2_000_000


def dealt_by_file(rows: DataFrame) -> DataFrame:
    """The stored rows of a statement dealt by the file they are rendered to, large files in several parts by company.

    The rows are dealt before they are rendered: lines are several times as many and as wide.
    """
    parts = max(1, -(-rows.count() // ROWS_PER_PART))
    end = F.col("dt_fim_exerc")
    return rows.repartition(32 * parts, "grupo_dfp", F.year(end), F.month(end) == 12, F.pmod(F.xxhash64("cnpj"), F.lit(parts)))


def statement_rows(src: DataFrame, statement: str) -> DataFrame:
    """Raw CSV rows (upper-case headers) of the stored rows of one statement, plus the target file name."""
    src = dmpl_source(src) if statement == "dmpl" else src
    flow = "dt_ini_exerc" in src.columns
    kind = F.when(F.month("dt_fim_exerc") == 12, F.lit("dfp")).otherwise(F.lit("itr"))
    variants = F.array(*[F.lit(i) for i in range(7)])
    x = src.select("*", F.explode(variants).alias("_v"))
    v = F.col("_v")
    big = (F.abs(F.col("vl_conta")) % 7 == 0)
    # 0 the report row, 1 a previous-period copy, 2 a quarter-only copy (Q2-Q4 of flows),
    # 3 a copy for an unlisted company, 4 the direct cash-flow method (cash flow only),
    # 5 a copy with an impossible date, 6 a copy with a value of letters
    keep = ((v == 0) | (v == 1) | ((v == 3) & F.col("cnpj").endswith("1")) | ((v == 5) & (F.abs(F.col("vl_conta")) % 11 == 0))
            | ((v == 6) & (F.abs(F.col("vl_conta")) % 13 == 0)))
    if flow:
        keep = keep | ((v == 2) & (F.month("dt_fim_exerc") > 3))
    if statement == "dfc":
        keep = keep | ((v == 4) & big)
    x = x.filter(keep)
    ordem = F.when(v == 1, F.lit("PENÚLTIMO")).otherwise(F.lit("ÚLTIMO"))
    cnpj = F.when(v == 3, F.concat(F.lit("X"), F.col("cnpj"))).otherwise(F.col("cnpj"))
    units = (v == 0) & big
    value = (F.when(units, F.col("vl_conta") * 1000).when(v == 1, F.col("vl_conta") * 3)
             .when(v == 2, F.col("vl_conta") - 1).when(v == 4, F.col("vl_conta") + 1)
             .otherwise(F.col("vl_conta")))
    cols = [cnpj.alias("CNPJ_CIA"),
            F.concat(F.lit("DF "), F.col("grupo_dfp"), F.lit(" - Demonstração")).alias("GRUPO_DFP"),
            F.when(units, F.lit("UNIDADE")).otherwise(F.lit("MIL")).alias("ESCALA_MOEDA"),
            ordem.alias("ORDEM_EXERC")]
    if flow:
        ini = F.when(v == 2, F.trunc("dt_fim_exerc", "quarter")).otherwise(F.col("dt_ini_exerc"))
        cols.append(ini.cast("string").alias("DT_INI_EXERC"))
    cols += [F.when(v == 5, F.lit("2001-02-30")).otherwise(F.col("dt_fim_exerc").cast("string")).alias("DT_FIM_EXERC"), F.col("cd_conta").alias("CD_CONTA"),
             F.col("ds_conta").alias("DS_CONTA")]
    if statement == "dmpl":
        cols.append(F.col("coluna_df").alias("COLUNA_DF"))
    cols.append(F.when(v == 6, F.lit("n/d")).otherwise(value.cast("string")).alias("VL_CONTA"))
    stmt = statement.upper()
    # v == 4 rows are the direct cash-flow method (cash flow only); elsewhere they are dropped
    if statement == "dfc":
        fname = F.when(v == 4, _file_name(kind, "DFC_MD", F.col("grupo_dfp"), F.year("dt_fim_exerc"))) \
                 .otherwise(_file_name(kind, "DFC_MI", F.col("grupo_dfp"), F.year("dt_fim_exerc")))
    else:
        x = x.filter(v != 4)
        fname = _file_name(kind, stmt, F.col("grupo_dfp"), F.year("dt_fim_exerc"))
    return x.select(*cols, fname.alias("_file"))


# The load scenario of the stand-in input: what the price table holds already, the exchange's
# holidays, and the days whose files have not landed when the load runs.
STORED_UNTIL = dt.date(2001, 6, 1)
HOLIDAYS = [dt.date(2001, 6, 14), dt.date(2001, 9, 7), dt.date(2001, 10, 12), dt.date(2001, 11, 2), dt.date(2001, 11, 15)]
# Years of the annual archives that are restated: to no rows, and to twice their values.
EMPTIED, DOUBLED = 1996, 1997
LATE_DAYS = ["20010815", "20010915", "20011015", "20011115", "20011215"]


def stored_prices(tables: Tables) -> DataFrame:
    """The price table as it stands before the load, with the traded volume as the quote lines give it."""
    p = tables.prices.filter(F.col("date") < F.lit(STORED_UNTIL))
    return p.withColumn("voltot", F.col("quatot").cast("double"))


def restated(rows: DataFrame) -> DataFrame:
    """Two annual archives that land again later: one holds only previous-period lines, the other twice its values."""
    empty, doubled = (F.col("_file").contains("dfp_cia_aberta_") & F.col("_file").endswith(f"_{y}.csv") for y in (EMPTIED, DOUBLED))
    value = F.coalesce((F.col("VL_CONTA").try_cast("bigint") * F.when(doubled, 2).otherwise(1)).cast("string"), F.col("VL_CONTA"))
    return rows.filter(empty | doubled).withColumns({
        "ORDEM_EXERC": F.when(empty, "PENÚLTIMO").otherwise(F.col("ORDEM_EXERC")), "VL_CONTA": value})


def may_be_restated(rows: DataFrame) -> DataFrame:
    """The stored rows that ``restated`` may keep once they are rendered: those of the two annual archives."""
    end = F.col("dt_fim_exerc")
    return rows.filter((F.month(end) == 12) & F.year(end).isin(EMPTIED, DOUBLED))


#: Landed files are compressed, as archives are; a compressed file is read by one task, so its lines are limited.
PACKED = "gzip"
LINES_PER_FILE, INSTRUMENTS_PER_FILE = 1_000_000, 250_000
AT_ONCE = 4  # inputs rendered at a time
STATEMENT_NAMES = ("dmpl", "dre", "dfc", "bpa", "bpp", "dva")  # the largest first: they are rendered in this order
LANDED = ("quotes", "quotes_by_day", "instruments", "instruments_by_day",
          *[f"{folder}/{st}" for folder in ("statements", "statements_restated") for st in STATEMENT_NAMES])


def _write_csv(rows: DataFrame, path: str) -> None:
    """The CSVs of one statement by file name, as landed archives unpack; the other statements' files stay."""
    (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_file").option("header", "true")
     .option("sep", ";").option("encoding", "ISO-8859-1").option("compression", PACKED).csv(path))


def _write_lines(lines: DataFrame, path: str, *by: str) -> None:
    (lines.write.mode("overwrite").partitionBy(*by).option("compression", PACKED)
     .option("maxRecordsPerFile", LINES_PER_FILE).text(path))


def _write_xml(rows: DataFrame, path: str, *by: str) -> None:
    (rows.write.mode("overwrite").partitionBy(*by).format("xml").option("rowTag", "Instrm").option("rootTag", "BizGrp")
     .option("compression", PACKED).option("maxRecordsPerFile", INSTRUMENTS_PER_FILE).save(path))


def _source(name: str) -> str:
    """The stored table that a landed input is rendered from."""
    folder, _, st = name.partition("/")
    return "prices" if not st else "dre" if st == "dmpl" else st


def _due(tables: Tables) -> DataFrame:
    """The stored prices of the days since the last load, dealt by day before they are rendered."""
    return tables.prices.filter(F.col("date") >= F.lit(STORED_UNTIL)).repartition("date")


def _render(tables: Tables, root: str, name: str) -> None:
    if name == "quotes":
        _write_lines(quote_lines(tables.prices), f"{root}/{name}")
    elif name == "instruments":
        _write_xml(instrument_rows(tables.prices), f"{root}/{name}")
    # what the daily load finds: one folder per day since the last load, some days not there yet
    elif name == "quotes_by_day":
        # whole lines of quotes that name a day, chosen by what they are made of: a condition on a line renders it again
        day = F.date_format("date", "yyyyMMdd")
        due = _due(tables).filter(~day.isin(*LATE_DAYS)).dropna(subset=["preult", "totneg", "quatot"])
        lines = rendered_quotes(due).filter(~F.col("v").isin(4, 7))
        _write_lines(lines.select("value", day.alias("dt")), f"{root}/{name}", "dt")
    elif name == "instruments_by_day":
        day = F.regexp_replace("RptParams.RptDtAndTm.Dt", "-", "")
        day = F.when(F.try_to_date("RptParams.RptDtAndTm.Dt").isNotNull(), day)
        rows = instrument_rows(_due(tables)).withColumn("dt", day)
        _write_xml(rows.filter(F.col("dt") >= f"{STORED_UNTIL:%Y%m%d}"), f"{root}/{name}", "dt")
    else:
        folder, st = name.split("/")
        src = tables.get(_source(name))
        if folder == "statements_restated":
            _write_csv(restated(statement_rows(dealt_by_file(may_be_restated(src)), st)), f"{root}/{folder}")
        else:
            _write_csv(statement_rows(dealt_by_file(src), st), f"{root}/{folder}")


def write_landing(tables: Tables, root: str, names: tuple[str, ...] = LANDED) -> dict[str, str]:
    """Render and write the named landed inputs under ``root``, each once; returns the folders of all.

    A query names the inputs it reads, so no other is rendered for it.  Each input is marked when it is whole.  Several
    are rendered at a time, so the last tasks of one leave no core idle; the tables they need are stored before.
    """
    spark = tables.tickers.sparkSession
    done = {name: f"{root}/_landed/{name}" for name in names}
    missing = [name for name in names if table_is_empty(spark, done[name])]
    for name in missing:
        tables.get(_source(name))

    def render(name: str) -> None:
        _render(tables, root, name)
        spark.range(1).write.mode("overwrite").parquet(done[name])

    if missing:
        with ThreadPoolExecutor(AT_ONCE) as pool:
            list(pool.map(render, missing))
    return {name.split("/")[0]: f"{root}/{name.split('/')[0]}" for name in LANDED}
