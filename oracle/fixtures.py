"""Fixture views as DuckDB CTEs (the SQL of FIXTURES.md section 2) plus the
scope prelude every oracle query starts from.  Plain SQL, written apart
from the Spark code."""

FIXTURE_CTES = """
fx_q AS (
SELECT suppkey, yr, fq, LAST_DAY(MAKE_DATE(yr, fq*3, 1)) AS dt_fim_exerc, MAKE_DATE(yr,1,1) AS dt_ini_exerc,
  CAST(SUM(ec*(100-dp)) AS BIGINT) AS rev, CAST(SUM(ec*60) AS BIGINT) AS cost,
  CAST(SUM(ec*5) AS BIGINT) AS opex, CAST(SUM(ec*tp) AS BIGINT) AS tax, CAST(SUM(ec*3) AS BIGINT) AS da
FROM (SELECT l_suppkey AS suppkey, YEAR(l_shipdate) AS yr, QUARTER(l_shipdate) AS fq,
   CAST(ROUND(l_extendedprice*100) AS BIGINT) AS ec, CAST(ROUND(l_discount*100) AS BIGINT) AS dp, CAST(ROUND(l_tax*100) AS BIGINT) AS tp
   FROM lineitem WHERE l_shipdate < TIMESTAMP '2001-10-01 00:00:00') t
GROUP BY suppkey, yr, fq),
fx_cum AS (
SELECT suppkey, yr, CAST(fq AS INT) AS fiscal_quarter, dt_ini_exerc, dt_fim_exerc,
  CAST(SUM(rev) OVER y AS BIGINT) AS rev, CAST(SUM(cost) OVER y AS BIGINT) AS cost, CAST(SUM(opex) OVER y AS BIGINT) AS opex,
  CAST(SUM(tax) OVER y AS BIGINT) AS tax, CAST(SUM(da) OVER y AS BIGINT) AS da, CAST(SUM(rev) OVER a AS BIGINT) AS stock
FROM fx_q
WINDOW y AS (PARTITION BY suppkey, yr ORDER BY fq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
       a AS (PARTITION BY suppkey ORDER BY yr, fq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
dre AS (
SELECT CONCAT('C', CAST(suppkey AS STRING)) AS cnpj, g.grupo_dfp, dt_ini_exerc, dt_fim_exerc, fiscal_quarter, a.cd_conta,
  CASE WHEN a.cd_conta='3.05' AND suppkey % 10 = 7 THEN 'Resultado Operacional' ELSE a.ds_conta END AS ds_conta,
  CASE a.cd_conta WHEN '3.01' THEN rev WHEN '3.02' THEN -cost WHEN '3.03' THEN rev-cost
     WHEN '3.05' THEN rev-cost-opex ELSE rev-cost-opex-tax END * g.m AS vl_conta
FROM fx_cum CROSS JOIN (SELECT * FROM (VALUES ('Consolidado',2),('Individual',1)) v(grupo_dfp,m)) g
CROSS JOIN (SELECT * FROM (VALUES ('3.01','Receita de Venda de Bens e/ou Serviços'),('3.02','Custo dos Bens e/ou Serviços Vendidos'),('3.03','Resultado Bruto'),
 ('3.05','Resultado Antes do Resultado Financeiro e dos Tributos'),('3.09','Resultado Líquido das Operações Continuadas'),('3.11','Lucro/Prejuízo do Período')) w(cd_conta,ds_conta)) a
WHERE NOT (suppkey % 10 = 3 AND a.cd_conta='3.09') AND NOT (suppkey % 10 = 9 AND g.grupo_dfp='Consolidado') AND NOT (suppkey % 10 = 8 AND fiscal_quarter < 4)),
bpp AS (
SELECT CONCAT('C', CAST(suppkey AS STRING)) AS cnpj, g.grupo_dfp, dt_fim_exerc, a.cd_conta, a.ds_conta, stock * a.w * g.m AS vl_conta
FROM fx_cum CROSS JOIN (SELECT * FROM (VALUES ('Consolidado',2),('Individual',1)) v(grupo_dfp,m)) g
CROSS JOIN (SELECT * FROM (VALUES ('2','Passivo Total',20),('2.01','Passivo Circulante',4),('2.01.04','Empréstimos e Financiamentos',1),('2.02.01','Empréstimos e Financiamentos',3),('2.03','Patrimônio Líquido Consolidado',9)) w(cd_conta,ds_conta,w)) a
WHERE NOT (suppkey % 10 = 9 AND g.grupo_dfp='Consolidado') AND NOT (suppkey % 10 = 8 AND fiscal_quarter < 4)),
prices AS (
SELECT CAST(l_shipdate AS DATE) AS date, CONCAT('S', CAST(l_suppkey AS STRING), k.sfx) AS ticker,
  CAST(CASE k.sfx WHEN '3' THEN MAX(CAST(ROUND(l_extendedprice*100) AS BIGINT)) ELSE MIN(CAST(ROUND(l_extendedprice*100) AS BIGINT)) END AS DOUBLE)/CAST(100 AS DOUBLE) AS preult,
  COUNT(*) AS totneg, CAST(SUM(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quatot,
  CAST(1000000 + l_suppkey*1000 + YEAR(CAST(l_shipdate AS DATE)) AS BIGINT) AS number_shares
FROM lineitem CROSS JOIN (SELECT * FROM (VALUES ('3'),('4')) v(sfx)) k
WHERE k.sfx='3' OR l_suppkey % 2 = 0
GROUP BY CAST(l_shipdate AS DATE), l_suppkey, k.sfx),
dva AS (
SELECT CONCAT('C', CAST(suppkey AS STRING)) AS cnpj, g.grupo_dfp, dt_ini_exerc, dt_fim_exerc, fiscal_quarter,
  '7.04.01' AS cd_conta, 'Depreciação, Amortização e Exaustão' AS ds_conta, -da * g.m AS vl_conta
FROM fx_cum CROSS JOIN (SELECT * FROM (VALUES ('Consolidado',2),('Individual',1)) v(grupo_dfp,m)) g
WHERE NOT (suppkey % 10 = 9 AND g.grupo_dfp='Consolidado') AND NOT (suppkey % 10 = 8 AND fiscal_quarter < 4)),
dfc AS (
SELECT CONCAT('C', CAST(suppkey AS STRING)) AS cnpj, g.grupo_dfp, dt_ini_exerc, dt_fim_exerc, fiscal_quarter, a.cd_conta, a.ds_conta,
  CASE a.cd_conta WHEN '6.01' THEN rev-cost-opex-tax+da WHEN '6.02' THEN -da*2 ELSE -tax END * g.m AS vl_conta
FROM fx_cum CROSS JOIN (SELECT * FROM (VALUES ('Consolidado',2),('Individual',1)) v(grupo_dfp,m)) g
CROSS JOIN (SELECT * FROM (VALUES ('6.01','Caixa Líquido Atividades Operacionais'),('6.02','Caixa Líquido Atividades de Investimento'),('6.03','Caixa Líquido Atividades de Financiamento')) w(cd_conta,ds_conta)) a
WHERE NOT (suppkey % 10 = 9 AND g.grupo_dfp='Consolidado') AND NOT (suppkey % 10 = 8 AND fiscal_quarter < 4)),
bpa AS (
SELECT CONCAT('C', CAST(suppkey AS STRING)) AS cnpj, g.grupo_dfp, dt_fim_exerc, a.cd_conta, a.ds_conta, stock * a.w * g.m AS vl_conta
FROM fx_cum CROSS JOIN (SELECT * FROM (VALUES ('Consolidado',2),('Individual',1)) v(grupo_dfp,m)) g
CROSS JOIN (SELECT * FROM (VALUES ('1','Ativo Total',20),('1.01','Ativo Circulante',7),('1.01.01','Caixa e Equivalentes de Caixa',2),('1.01.02','Aplicações Financeiras',1),('1.02.01.03.01','Aplicações Financeiras',5)) w(cd_conta,ds_conta,w)) a
WHERE NOT (suppkey % 10 = 9 AND g.grupo_dfp='Consolidado') AND NOT (suppkey % 10 = 8 AND fiscal_quarter < 4)),
tickers AS (
SELECT CONCAT('S', CAST(s_suppkey AS STRING), k.sfx) AS ticker, CONCAT('C', CAST(s_suppkey AS STRING)) AS cnpj, k.type,
  r_name AS sector, n_name AS subsector, CONCAT('SEG', CAST(s_suppkey % 2 AS STRING)) AS segment, s_name AS denom_social, s_name AS denom_comerc
FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
CROSS JOIN (SELECT * FROM (VALUES ('3','ON'),('4','PN')) v(sfx,type)) k
WHERE k.sfx='3' OR s_suppkey % 2 = 0)
"""

# Scope: share classes, chosen group (Consolidado, else Individual), report
# frequency and newest dates.  co = one row per company, sc = one per ticker.
SCOPE_CTES = """
cls AS (
  SELECT cnpj, MIN(CASE WHEN type = 'ON' AND RIGHT(ticker, 1) = '3' THEN ticker END) AS on_ticker,
         MIN(CASE WHEN type = 'PN' THEN ticker END) AS pn_ticker
  FROM tickers GROUP BY cnpj),
cls_ok AS (SELECT * FROM cls WHERE on_ticker IS NOT NULL),
sdates AS (SELECT DISTINCT cnpj, grupo_dfp, dt_fim_exerc AS date FROM dre),
chosen AS (
  SELECT c.cnpj, CASE WHEN h.cnpj IS NOT NULL THEN 'Consolidado' ELSE 'Individual' END AS grupo_dfp
  FROM cls_ok c LEFT JOIN (SELECT DISTINCT cnpj FROM sdates WHERE grupo_dfp = 'Consolidado') h ON c.cnpj = h.cnpj),
gaps AS (
  SELECT s.cnpj, s.grupo_dfp, s.date,
    (YEAR(s.date) * 12 + MONTH(s.date)) - LAG(YEAR(s.date) * 12 + MONTH(s.date)) OVER (PARTITION BY s.cnpj, s.grupo_dfp ORDER BY s.date) AS gm,
    DATE_DIFF('day', LAG(s.date) OVER (PARTITION BY s.cnpj, s.grupo_dfp ORDER BY s.date), s.date) AS gd,
    CASE WHEN s.date = LAST_DAY(s.date) THEN 1 ELSE 0 END AS me,
    CASE WHEN DAY(s.date) = 1 THEN 1 ELSE 0 END AS ms
  FROM sdates s JOIN chosen c ON s.cnpj = c.cnpj AND s.grupo_dfp = c.grupo_dfp),
fr AS (
  SELECT cnpj, grupo_dfp, COUNT(*) AS n, MIN(date) AS d0, MAX(date) AS d1, MIN(gm) AS gm_lo, MAX(gm) AS gm_hi,
         MIN(gd) AS gd_lo, MAX(gd) AS gd_hi, MIN(me) AS all_me, MIN(ms) AS all_ms
  FROM gaps GROUP BY cnpj, grupo_dfp),
co AS (
  SELECT c.cnpj, c.grupo_dfp,
    CASE WHEN fr.n IS NULL OR fr.n < 3 THEN 'Q'
         WHEN (fr.all_me = 1 OR fr.all_ms = 1) AND fr.gm_lo = fr.gm_hi THEN CASE WHEN fr.gm_hi = 12 THEN 'A' ELSE 'Q' END
         WHEN fr.gd_lo = fr.gd_hi THEN 'Q'
         WHEN fr.n / (DATE_DIFF('day', fr.d0, fr.d1) / 365.2425) > 1 THEN 'Q'
         ELSE 'A' END AS freq,
    fr.d1 AS last_statement_date
  FROM chosen c LEFT JOIN fr ON c.cnpj = fr.cnpj AND c.grupo_dfp = fr.grupo_dfp),
lp AS (SELECT ticker, MAX(date) AS last_price_date FROM prices GROUP BY ticker),
sc AS (
  SELECT t.ticker, t.cnpj, t.type, t.sector, t.subsector, t.segment, t.denom_comerc, co.grupo_dfp, co.freq,
         k.on_ticker, k.pn_ticker, lp.last_price_date, co.last_statement_date
  FROM tickers t JOIN cls_ok k ON t.cnpj = k.cnpj JOIN co ON t.cnpj = co.cnpj LEFT JOIN lp ON t.ticker = lp.ticker)
"""


def with_ctes(*more: str) -> str:
    """``WITH`` clause holding the fixture views, the scope and extra CTEs."""
    parts = [FIXTURE_CTES.strip(), SCOPE_CTES.strip(), *[m.strip().rstrip(",") for m in more if m.strip()]]
    return "WITH " + ",\n".join(parts) + "\n"


# The tables after the loads: the annual archives of 1996 are restated to no rows, those of 1997 to twice their
# values; prices are those stored before 2001-06-01 and the days loaded since.
STATEMENT_TABLES = ("dre", "dva", "dfc", "bpa", "bpp")


def after_loads(sql: str, price_rows: str) -> str:
    """The same query on the loaded tables (``price_rows``: SELECT of the loaded prices from ``prices_0``)."""
    for t in (*STATEMENT_TABLES, "prices"):
        assert f"\n{t} AS (" in sql or sql.startswith(f"WITH {t} AS ("), t
        sql = sql.replace(f"WITH {t} AS (", f"WITH {t}_0 AS (").replace(f"\n{t} AS (", f"\n{t}_0 AS (")
    annual = "MONTH(dt_fim_exerc) = 12 AND YEAR(dt_fim_exerc)"
    views = [f"""{t} AS (SELECT * REPLACE (CAST(CASE WHEN {annual} = 1997 THEN vl_conta * 2 ELSE vl_conta END AS DOUBLE) AS vl_conta)
FROM {t}_0 WHERE NOT ({annual} = 1996) AND cnpj IN (SELECT cnpj FROM tickers))""" for t in STATEMENT_TABLES]
    views.append(f"prices AS ({price_rows})")
    return sql.replace(SCOPE_CTES.strip(), ",\n".join(views) + ",\n" + SCOPE_CTES.strip())
