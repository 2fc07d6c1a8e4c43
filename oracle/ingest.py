"""Oracle SQL for the ingest queries: what the readers must recover from
the rendered landed files, stated on the fixture views."""

from __future__ import annotations

from oracle.fixtures import after_loads, with_ctes

QUOTES = with_ctes() + """SELECT date, ticker, preult, totneg, quatot, CAST(quatot AS DOUBLE) AS voltot FROM prices"""

_INSTR_BASE = """
ib AS (SELECT date, ticker, preult, quatot, number_shares FROM prices WHERE quatot % 11 <> 0),
ir AS (
  SELECT date, CAST(10 AS INTEGER) AS mkt, CAST(11 AS INTEGER) AS sctyctgy, ticker,
    CASE WHEN RIGHT(ticker, 1) = '3' THEN 'ON NM' ELSE 'PN N1' END AS spcfctncd, 'CO ' || ticker AS crpnnm,
    number_shares, CASE WHEN quatot % 4 = 0 THEN CAST(0 AS DOUBLE) ELSE preult END AS lastpric, quatot
  FROM ib)"""

INSTRUMENTS = with_ctes(_INSTR_BASE) + """SELECT date, mkt, sctyctgy, ticker, spcfctncd, crpnnm, number_shares, lastpric FROM ir
UNION ALL
SELECT date, mkt, sctyctgy, ticker, spcfctncd, crpnnm, number_shares - 1, lastpric FROM ir WHERE quatot % 17 = 0"""

MERGE = with_ctes() + """SELECT date, ticker, preult, totneg, quatot, CAST(quatot AS DOUBLE) AS voltot,
  CASE WHEN quatot % 11 = 0 THEN NULL ELSE number_shares END AS number_shares FROM prices"""


def statement_sql(view: str, flow: bool = True) -> str:
    cols = ["cnpj", "CAST(YEAR(dt_fim_exerc) AS INTEGER) AS dt_refer", "grupo_dfp"]
    if flow:
        cols.append("dt_ini_exerc")
    cols += ["dt_fim_exerc", "cd_conta", "ds_conta", "CAST(vl_conta AS DOUBLE) AS vl_conta",
             "CASE WHEN MONTH(dt_fim_exerc) = 12 THEN 'dfp' ELSE 'itr' END AS itr_dfp"]
    if flow:
        cols.append("((YEAR(dt_fim_exerc) - YEAR(dt_ini_exerc)) * 12 + (MONTH(dt_fim_exerc) - MONTH(dt_ini_exerc)) + 1)"
                    " / CAST(3 AS DOUBLE) AS fiscal_quarter")
    return with_ctes() + f"SELECT {', '.join(cols)} FROM {view} WHERE cnpj IN (SELECT cnpj FROM tickers)"


FILE_FIELDS = with_ctes("""
ff AS (
  SELECT DISTINCT CASE WHEN MONTH(dt_fim_exerc) = 12 THEN 'dfp' ELSE 'itr' END AS k, 'DRE' AS st, grupo_dfp, YEAR(dt_fim_exerc) AS y FROM dre
  UNION SELECT DISTINCT CASE WHEN MONTH(dt_fim_exerc) = 12 THEN 'dfp' ELSE 'itr' END, 'DFC_MI', grupo_dfp, YEAR(dt_fim_exerc) FROM dfc
  UNION SELECT DISTINCT CASE WHEN MONTH(dt_fim_exerc) = 12 THEN 'dfp' ELSE 'itr' END, 'DFC_MD', grupo_dfp, YEAR(dt_fim_exerc) FROM dfc
        WHERE ABS(vl_conta) % 7 = 0
  UNION SELECT DISTINCT CASE WHEN MONTH(dt_fim_exerc) = 12 THEN 'dfp' ELSE 'itr' END, 'BPA', grupo_dfp, YEAR(dt_fim_exerc) FROM bpa
  UNION SELECT DISTINCT CASE WHEN MONTH(dt_fim_exerc) = 12 THEN 'dfp' ELSE 'itr' END, 'BPP', grupo_dfp, YEAR(dt_fim_exerc) FROM bpp
  UNION SELECT DISTINCT CASE WHEN MONTH(dt_fim_exerc) = 12 THEN 'dfp' ELSE 'itr' END, 'DVA', grupo_dfp, YEAR(dt_fim_exerc) FROM dva
  UNION SELECT DISTINCT CASE WHEN MONTH(dt_fim_exerc) = 12 THEN 'dfp' ELSE 'itr' END, 'DMPL', grupo_dfp, YEAR(dt_fim_exerc) FROM dre)""") + """
SELECT k || '_cia_aberta_' || st || '_' || CASE WHEN grupo_dfp = 'Consolidado' THEN 'con' ELSE 'ind' END || '_'
       || CAST(y AS VARCHAR) || '.csv' AS file_name,
  k AS itr_dfp, LOWER(st) AS statement, CASE WHEN grupo_dfp = 'Consolidado' THEN 'con' ELSE 'ind' END AS con_ind,
  CAST(y AS INTEGER) AS dt_refer
FROM ff"""

_LISTING = r"""
lst AS (
  SELECT s_suppkey,
    CASE WHEN s_suppkey % 9 = 0 THEN 'readme_' || CAST(s_suppkey AS VARCHAR)
         ELSE CASE WHEN s_suppkey % 2 = 1 THEN 'itr' ELSE 'dfp' END || '_cia_aberta_' || LPAD(CAST(s_suppkey AS VARCHAR), 6, '0')
    END AS file_name,
    TIMESTAMP '2001-01-01 00:00:00' + s_suppkey * INTERVAL 1 HOUR AS url_date
  FROM supplier),
listed AS (SELECT file_name, url_date FROM lst WHERE regexp_matches(file_name, '^(itr|dfp)_cia_aberta_\d+$')),
reg AS (SELECT file_name, CASE WHEN s_suppkey % 4 = 0 THEN url_date - INTERVAL 1 DAY ELSE url_date END AS last_modified
        FROM lst WHERE s_suppkey % 2 = 0),
changed AS (
  SELECT l.file_name, l.url_date FROM listed l LEFT JOIN reg r ON l.file_name = r.file_name
  WHERE l.url_date > COALESCE(r.last_modified, TIMESTAMP '1900-01-01 00:00:00'))"""

CHANGED_FILES = "WITH " + _LISTING.strip() + "\nSELECT file_name, url_date FROM changed"
REGISTRY_UPSERT = "WITH " + _LISTING.strip() + """
SELECT file_name, last_modified FROM reg WHERE file_name NOT IN (SELECT file_name FROM changed)
UNION ALL SELECT file_name, url_date AS last_modified FROM changed"""


def replace_slice_sql() -> str:
    base = statement_sql("dre")
    return f"""WITH s AS ({base})
SELECT * FROM s WHERE itr_dfp = 'itr'
UNION ALL
SELECT cnpj, dt_refer, grupo_dfp, dt_ini_exerc, dt_fim_exerc, cd_conta, ds_conta, vl_conta + 1, itr_dfp, fiscal_quarter
FROM s WHERE itr_dfp = 'dfp' AND cd_conta <> '3.02'"""


SEED_PRICES = with_ctes() + "SELECT date, ticker, preult, totneg, quatot, number_shares FROM prices"
RELOAD_TICKERS = with_ctes() + "SELECT * FROM tickers"

_EXPECTED = """
lastd AS (SELECT MAX(date) AS d FROM prices WHERE date < DATE '2001-06-01'),
today AS (SELECT MAX(date) AS t FROM prices),
days AS (SELECT CAST(UNNEST(generate_series(CAST(d + 1 AS TIMESTAMP), CAST(t AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS date
         FROM lastd, today),
closed AS (
  SELECT UNNEST([DATE '2001-06-14', DATE '2001-09-07', DATE '2001-10-12', DATE '2001-11-02', DATE '2001-11-15']) AS date
  UNION ALL SELECT MAKE_DATE(YEAR(t), 12, 24) FROM today UNION ALL SELECT MAKE_DATE(YEAR(t), 12, 31) FROM today
  UNION ALL SELECT MAKE_DATE(YEAR(t) - 1, 12, 24) FROM today UNION ALL SELECT MAKE_DATE(YEAR(t) - 1, 12, 31) FROM today),
expd AS (SELECT date FROM days WHERE DAYOFWEEK(date) NOT IN (0, 6) AND date NOT IN (SELECT date FROM closed))"""

MISSING_PRICE_DATES = with_ctes(_EXPECTED) + "SELECT date FROM expd"

# Every income-statement row in two statement columns (the second at twice the value);
# the dedupe key includes the statement column, so both are kept.
DMPL = with_ctes() + """SELECT d.cnpj, CAST(YEAR(d.dt_fim_exerc) AS INTEGER) AS dt_refer, d.grupo_dfp, d.dt_ini_exerc,
  d.dt_fim_exerc, d.cd_conta, d.ds_conta, c.coluna_df, CAST(d.vl_conta * c.k AS DOUBLE) AS vl_conta,
  CASE WHEN MONTH(d.dt_fim_exerc) = 12 THEN 'dfp' ELSE 'itr' END AS itr_dfp,
  ((YEAR(d.dt_fim_exerc) - YEAR(d.dt_ini_exerc)) * 12 + (MONTH(d.dt_fim_exerc) - MONTH(d.dt_ini_exerc)) + 1)
    / CAST(3 AS DOUBLE) AS fiscal_quarter
FROM dre d CROSS JOIN (SELECT * FROM (VALUES ('Capital Social Integralizado', 1), ('Lucros ou Prejuízos Acumulados', 2))
  v(coluna_df, k)) c
WHERE d.cnpj IN (SELECT cnpj FROM tickers)"""

_LOADED = """
landed AS (SELECT DISTINCT date FROM prices WHERE NOT (DAY(date) = 15 AND MONTH(date) >= 8 AND YEAR(date) = 2001)),
gap AS (SELECT MIN(date) AS g FROM expd WHERE date NOT IN (SELECT date FROM landed)),
todo AS (SELECT date FROM expd WHERE (SELECT g FROM gap) IS NULL OR date < (SELECT g FROM gap))"""
_LOADED_ROWS = """SELECT date, ticker, preult, totneg, quatot, CAST(quatot AS DOUBLE) AS voltot,
  CASE WHEN quatot % 11 = 0 THEN NULL ELSE number_shares END AS number_shares
FROM prices WHERE date IN (SELECT date FROM todo) AND NOT (DAY(date) = 15 AND MONTH(date) >= 8 AND YEAR(date) = 2001)
UNION ALL
SELECT date, ticker, preult, totneg, quatot, CAST(quatot AS DOUBLE) AS voltot, number_shares FROM prices
WHERE date < DATE '2001-06-01'"""
PRICE_LOAD = with_ctes(_EXPECTED, _LOADED) + _LOADED_ROWS
# the loaded prices as a subquery on the view ``prices_0``
LOADED_PRICES = f"WITH {_EXPECTED.strip()},\n{_LOADED.strip()}\n{_LOADED_ROWS}".replace("FROM prices", "FROM prices_0")


def loaded(sql: str) -> str:
    return after_loads(sql, LOADED_PRICES)


_ARCHIVES = """SELECT DISTINCT CASE WHEN MONTH(dt_fim_exerc) = 12 THEN 'dfp' ELSE 'itr' END || '_cia_aberta_'
  || CAST(YEAR(dt_fim_exerc) AS VARCHAR) AS file_name FROM dre"""
REGISTRY_AFTER_LOAD = with_ctes() + _ARCHIVES
PENDING_ARCHIVES = with_ctes() + _ARCHIVES + " WHERE YEAR(dt_fim_exerc) >= 1998"


def refreshed_sql(sql: str, name: str) -> str:
    """A flow measure on the loaded tables; loaded values are doubles."""
    cols = ", ".join(f"CAST({v}_{name} AS DOUBLE) AS {v}_{name}" for v in ("ytd", "quarter", "ttm"))
    return f"SELECT cnpj, grupo_dfp, date, {cols} FROM ({loaded(sql)}) q"


def statement_load_sql() -> str:
    """All six statements as loaded, side by side; the changes in equity from two columns per income row."""
    parts = [f"SELECT '{k}' AS kind, cnpj, dt_refer, grupo_dfp, itr_dfp, dt_fim_exerc, cd_conta, ds_conta, vl_conta FROM ({sql}) q"
             for k, sql in (("dre", statement_sql("dre")), ("dva", statement_sql("dva")), ("dfc", statement_sql("dfc")),
                            ("dmpl", DMPL), ("bpa", statement_sql("bpa", flow=False)), ("bpp", statement_sql("bpp", flow=False)))]
    return " UNION ALL ".join(parts)


_ESPECI = "CASE WHEN quatot % 5 = 0 THEN NULL WHEN RIGHT(ticker, 1) = '3' THEN 'ON NM' ELSE 'PN N1' END"
PRICE_FILTERS = with_ctes(f"""
rec AS (
  SELECT 10 AS tpmerc, 2 AS codbdi, {_ESPECI} AS especi, TRUE AS kept FROM prices
  UNION ALL SELECT 30, 2, {_ESPECI}, FALSE FROM prices WHERE quatot % 3 = 0
  UNION ALL SELECT 10, 12, {_ESPECI}, FALSE FROM prices WHERE quatot % 4 = 0
  UNION ALL SELECT 10, 2, 'DRN', FALSE FROM prices WHERE quatot % 7 = 0)""") + """SELECT tpmerc, codbdi, especi, kept,
  COUNT(*) AS n_records FROM rec GROUP BY tpmerc, codbdi, especi, kept"""

_SPEC = "CASE WHEN RIGHT(ticker, 1) = '3' THEN 'ON NM' ELSE 'PN N1' END"
SHARE_FILTERS = with_ctes(f"""
src AS (SELECT ticker, quatot FROM prices WHERE quatot % 11 <> 0),
rec AS (
  SELECT 10 AS mkt, 11 AS sctyctgy, {_SPEC} AS spcfctncd, TRUE AS kept FROM src
  UNION ALL SELECT 20, 11, {_SPEC}, FALSE FROM src WHERE quatot % 6 = 0
  UNION ALL SELECT 10, 9, {_SPEC}, FALSE FROM src WHERE quatot % 8 = 0
  UNION ALL SELECT 10, 11, 'CI', FALSE FROM src WHERE quatot % 9 = 0
  UNION ALL SELECT 10, 11, 'DIA', FALSE FROM src WHERE quatot % 10 = 0
  UNION ALL SELECT 10, 11, {_SPEC}, TRUE FROM src WHERE quatot % 17 = 0)""") + """SELECT mkt, sctyctgy, spcfctncd, kept,
  COUNT(*) AS n_records FROM rec GROUP BY mkt, sctyctgy, spcfctncd, kept"""



def rejected_sql() -> str:
    """The spoilt records of the landed files, by the rule that made them."""
    parts = [f"SELECT 'quotes' AS source, NULL AS file, '{why}' AS reason FROM prices WHERE quatot % {n} = 0"
             for why, n in (("date", 19), ("number", 29), ("short line", 31), ("record type", 37))]
    parts += [f"SELECT 'instruments', NULL, '{why}' FROM prices WHERE quatot % 11 <> 0 AND quatot % {n} = 0"
              for why, n in (("date", 19), ("number", 23))]
    twice = "(SELECT dt_fim_exerc, grupo_dfp, vl_conta * k AS vl_conta FROM dre CROSS JOIN (VALUES (1), (2)) v(k))"
    for kind, name, table in (("dre", "DRE", "dre"), ("dva", "DVA", "dva"), ("dfc", "DFC_MI", "dfc"), ("bpa", "BPA", "bpa"),
                              ("bpp", "BPP", "bpp"), ("dmpl", "DMPL", twice)):
        file = (f"CASE WHEN MONTH(dt_fim_exerc) = 12 THEN 'dfp' ELSE 'itr' END || '_{name}_' || "
                "CASE WHEN grupo_dfp = 'Consolidado' THEN 'con' ELSE 'ind' END || '_' || CAST(YEAR(dt_fim_exerc) AS VARCHAR)")
        parts += [f"SELECT '{kind}', {file}, '{why}' FROM {table} t WHERE ABS(vl_conta) % {n} = 0" for why, n in (("date", 11), ("number", 13))]
    return with_ctes() + f"""SELECT source, file, reason, COUNT(*) AS n_records FROM ({" UNION ALL ".join(parts)}) r
GROUP BY source, file, reason"""
