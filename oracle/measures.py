"""DuckDB oracle SQL for the measures, written by hand against the fixture views."""

from __future__ import annotations

from oracle.fixtures import with_ctes

NI_A, NI_B = "Resultado Líquido das Operações Continuadas", "Lucro/Prejuízo do Período"
EBIT_A, EBIT_B = "Resultado Antes do Resultado Financeiro e dos Tributos", "Resultado Operacional"
DA = "Depreciação, Amortização e Exaustão"


def begin_sql(start: str, price: bool = False) -> str:
    if start.startswith("expr:"):
        return start[5:]
    if start == "all":
        return "DATE '1900-01-01'"
    if start == "last":
        return "last_price_date" if price else "co.last_statement_date"
    return f"DATE '{start}'"


def flow_ctes(table: str, where: str, labels: tuple[str, str] | None, start: str = "all", tag: str = "") -> str:
    """CTEs r{tag} .. tv{tag}: ytd rows, label choice, quarter value q, ttm t."""
    b = begin_sql(start)
    label_cte = ""
    src = f"r{tag}"
    if labels:
        a, f = labels
        label_cte = f"""
l{tag} AS (SELECT *, MAX(CASE WHEN ds_conta = '{a}' THEN 1 ELSE 0 END) OVER (PARTITION BY cnpj, grupo_dfp) AS has_a FROM r{tag}),
s{tag} AS (SELECT * FROM l{tag} WHERE CASE WHEN has_a = 1 THEN ds_conta = '{a}' ELSE ds_conta = '{f}' END),"""
        src = f"s{tag}"
    return f"""
r{tag} AS (
  SELECT d.cnpj, d.grupo_dfp, d.dt_fim_exerc AS date, d.fiscal_quarter, d.cd_conta, d.ds_conta, d.vl_conta AS ytd,
         co.freq, {b} AS b
  FROM {table} d JOIN co ON d.cnpj = co.cnpj AND d.grupo_dfp = co.grupo_dfp
  WHERE ({where}) AND d.dt_fim_exerc >= {b} - INTERVAL 12 MONTH),{label_cte}
qv{tag} AS (
  SELECT *, CASE WHEN fiscal_quarter = 1 THEN ytd
                 ELSE ytd - LAG(ytd) OVER (PARTITION BY cnpj, grupo_dfp ORDER BY date, cd_conta) END AS q
  FROM {src}),
tv{tag} AS (
  SELECT *, CASE WHEN COUNT(q) OVER w4 = 4 THEN CAST(SUM(q) OVER w4 AS BIGINT) END AS t
  FROM qv{tag}
  WINDOW w4 AS (PARTITION BY cnpj, grupo_dfp ORDER BY date, cd_conta ROWS BETWEEN 3 PRECEDING AND CURRENT ROW))"""


def flow_sql(table: str, name: str, where: str, labels=None, start: str = "all",
             quarter: bool = True, ytd: bool = True, ttm: bool = True) -> str:
    cols = ["cnpj", "grupo_dfp", "date"]
    if ytd:
        cols.append(f"ytd AS ytd_{name}")
    if quarter:
        cols.append(f"CASE WHEN freq <> 'A' THEN q END AS quarter_{name}")
    if ttm:
        cols.append(f"CASE WHEN freq <> 'A' THEN t END AS ttm_{name}")
    return (with_ctes(flow_ctes(table, where, labels, start))
            + f"SELECT {', '.join(cols)} FROM tv WHERE date >= (b - INTERVAL 12 MONTH) + INTERVAL 12 MONTH")


def net_income_sql(start="all", **flags) -> str:
    return flow_sql("dre", "net_income", f"d.ds_conta IN ('{NI_A}', '{NI_B}')", (NI_A, NI_B), start, **flags)


def ebit_sql(start="all", **flags) -> str:
    return flow_sql("dre", "ebit", f"d.ds_conta IN ('{EBIT_A}', '{EBIT_B}')", (EBIT_A, EBIT_B), start, **flags)


def depre_amort_sql(start="all", **flags) -> str:
    return flow_sql("dva", "d_a", f"d.ds_conta = '{DA}'", None, start, **flags)


def revenue_sql(start="all", **flags) -> str:
    return flow_sql("dre", "revenue", "d.cd_conta = '3.01'", None, start, **flags)


def cfo_sql(start="all", **flags) -> str:
    return flow_sql("dfc", "cfo", "d.cd_conta = '6.01'", None, start, **flags)


def ebitda_ctes(start: str = "all", tag: str = "") -> str:
    b = begin_sql(start)
    return f"""
er{tag} AS (
  SELECT e.cnpj, e.grupo_dfp, e.dt_fim_exerc AS date, e.fiscal_quarter, e.cd_conta, e.ds_conta,
         e.vl_conta AS ytd_ebit, v.vl_conta AS ytd_d_a, v.cd_conta AS da_cd, co.freq, {b} AS b
  FROM dre e JOIN co ON e.cnpj = co.cnpj AND e.grupo_dfp = co.grupo_dfp
  JOIN dva v ON e.dt_fim_exerc = v.dt_fim_exerc AND e.grupo_dfp = v.grupo_dfp AND e.cnpj = v.cnpj
  WHERE e.ds_conta IN ('{EBIT_A}', '{EBIT_B}') AND v.ds_conta = '{DA}'
    AND e.dt_fim_exerc >= {b} - INTERVAL 12 MONTH),
el{tag} AS (SELECT *, MAX(CASE WHEN ds_conta = '{EBIT_A}' THEN 1 ELSE 0 END) OVER (PARTITION BY cnpj, grupo_dfp) AS has_a FROM er{tag}),
es{tag} AS (SELECT * FROM el{tag} WHERE CASE WHEN has_a = 1 THEN ds_conta = '{EBIT_A}' ELSE ds_conta = '{EBIT_B}' END),
eq{tag} AS (
  SELECT *,
    (CASE WHEN fiscal_quarter = 1 THEN ytd_ebit ELSE ytd_ebit - LAG(ytd_ebit) OVER wo END)
    - (CASE WHEN fiscal_quarter = 1 THEN ytd_d_a ELSE ytd_d_a - LAG(ytd_d_a) OVER wo END) AS q
  FROM es{tag} WINDOW wo AS (PARTITION BY cnpj, grupo_dfp ORDER BY date, cd_conta, da_cd)),
et{tag} AS (
  SELECT *, CASE WHEN COUNT(q) OVER w4 = 4 THEN CAST(SUM(q) OVER w4 AS BIGINT) END AS t
  FROM eq{tag}
  WINDOW w4 AS (PARTITION BY cnpj, grupo_dfp ORDER BY date, cd_conta, da_cd ROWS BETWEEN 3 PRECEDING AND CURRENT ROW))"""


def ebitda_sql(start="all", quarter=True, ytd=True, ttm=True) -> str:
    cols = ["cnpj", "grupo_dfp", "date"]
    if ytd:
        cols.append("ytd_ebit - ytd_d_a AS ytd_ebitda")
    if quarter:
        cols.append("CASE WHEN freq <> 'A' THEN q END AS quarter_ebitda")
    if ttm:
        cols.append("CASE WHEN freq <> 'A' THEN t END AS ttm_ebitda")
    return (with_ctes(ebitda_ctes(start))
            + f"SELECT {', '.join(cols)} FROM et WHERE date >= (b - INTERVAL 12 MONTH) + INTERVAL 12 MONTH")


# ---------------------------------------------------------------- balances
def bexpr(start: str) -> str:
    """Begin of a balance measure (no look-back)."""
    if start.startswith("expr:"):
        return start[5:]
    return begin_sql(start)


def balance_ctes(start: str = "all", tag: str = "") -> str:
    b = bexpr(start)
    return f"""
cash{tag} AS (
  SELECT x.cnpj, x.grupo_dfp, x.dt_fim_exerc AS date, CAST(SUM(x.vl_conta) AS BIGINT) AS cash_equi
  FROM bpa x JOIN co ON x.cnpj = co.cnpj AND x.grupo_dfp = co.grupo_dfp
  WHERE x.ds_conta IN ('Caixa e Equivalentes de Caixa', 'Aplicações Financeiras') AND x.cd_conta <> '1.02.01.03.01'
    AND x.dt_fim_exerc >= {b}
  GROUP BY x.cnpj, x.grupo_dfp, x.dt_fim_exerc),
debt{tag} AS (
  SELECT x.cnpj, x.grupo_dfp, x.dt_fim_exerc AS date, CAST(SUM(x.vl_conta) AS BIGINT) AS total_debt
  FROM bpp x JOIN co ON x.cnpj = co.cnpj AND x.grupo_dfp = co.grupo_dfp
  WHERE x.ds_conta = 'Empréstimos e Financiamentos' AND x.cd_conta IN ('2.01.04', '2.02.01') AND x.dt_fim_exerc >= {b}
  GROUP BY x.cnpj, x.grupo_dfp, x.dt_fim_exerc),
equity{tag} AS (
  SELECT x.cnpj, x.grupo_dfp, x.dt_fim_exerc AS date, x.vl_conta AS total_equity
  FROM bpp x JOIN co ON x.cnpj = co.cnpj AND x.grupo_dfp = co.grupo_dfp
  WHERE x.ds_conta IN ('Patrimônio Líquido', 'Patrimônio Líquido Consolidado') AND x.dt_fim_exerc >= {b}),
assets{tag} AS (
  SELECT x.cnpj, x.grupo_dfp, x.dt_fim_exerc AS date, x.vl_conta AS total_assets
  FROM bpa x JOIN co ON x.cnpj = co.cnpj AND x.grupo_dfp = co.grupo_dfp
  WHERE x.cd_conta = '1' AND x.dt_fim_exerc >= {b}),
nd{tag} AS (
  SELECT COALESCE(d.cnpj, c.cnpj) AS cnpj, COALESCE(d.grupo_dfp, c.grupo_dfp) AS grupo_dfp,
         COALESCE(d.date, c.date) AS date, d.total_debt - c.cash_equi AS net_debt
  FROM debt{tag} d FULL OUTER JOIN cash{tag} c ON d.cnpj = c.cnpj AND d.grupo_dfp = c.grupo_dfp AND d.date = c.date)"""


def ratio_full(left: str, right: str, lv: str, rv: str, out: str) -> str:
    return f"""SELECT COALESCE(a.cnpj, b.cnpj) AS cnpj, COALESCE(a.grupo_dfp, b.grupo_dfp) AS grupo_dfp,
  COALESCE(a.date, b.date) AS date, CAST(a.{lv} AS DOUBLE) / NULLIF(b.{rv}, 0) AS {out}
FROM {left} a FULL OUTER JOIN {right} b ON a.cnpj = b.cnpj AND a.grupo_dfp = b.grupo_dfp AND a.date = b.date"""


def ratio_stacked(left: str, right: str, lv: str, rv: str, out: str) -> str:
    """The same ratio without a join; each side has one row per company and date."""
    return f"""SELECT cnpj, grupo_dfp, date, CAST(MAX(l) AS DOUBLE) / NULLIF(MAX(r), 0) AS {out}
FROM (SELECT cnpj, grupo_dfp, date, {lv} AS l, NULL AS r FROM {left} UNION ALL SELECT cnpj, grupo_dfp, date, NULL, {rv} FROM {right}) s
GROUP BY cnpj, grupo_dfp, date"""


def current_ratio_sql(start="all") -> str:
    b = bexpr(start)
    return with_ctes() + f"""SELECT a.cnpj, a.grupo_dfp, a.dt_fim_exerc AS date,
  CAST(a.vl_conta AS DOUBLE) / NULLIF(CAST(l.vl_conta AS DOUBLE), 0) AS current_ratio
FROM bpa a JOIN co ON a.cnpj = co.cnpj AND a.grupo_dfp = co.grupo_dfp
JOIN bpp l ON a.dt_fim_exerc = l.dt_fim_exerc AND a.cnpj = l.cnpj AND a.grupo_dfp = l.grupo_dfp
WHERE a.ds_conta = 'Ativo Circulante' AND a.dt_fim_exerc >= {b} AND l.ds_conta = 'Passivo Circulante'"""


# ----------------------------------------------------------------- margins
def ni_ttm_ctes(start: str, tag: str) -> str:
    """ni{tag}: cnpj, grupo_dfp, date, ttm (trimmed, NULL for annual)."""
    return flow_ctes("dre", f"d.ds_conta IN ('{NI_A}', '{NI_B}')", (NI_A, NI_B), start, tag) + f""",
ni{tag} AS (SELECT cnpj, grupo_dfp, date, CASE WHEN freq <> 'A' THEN t END AS ttm
           FROM tv{tag} WHERE date >= (b - INTERVAL 12 MONTH) + INTERVAL 12 MONTH)"""


def return_sql(kind: str, start: str = "all") -> str:
    table, col = ("equity", "total_equity") if kind == "roe" else ("assets", "total_assets")
    return with_ctes(balance_ctes(start), ni_ttm_ctes(start, "n")) + f"""SELECT * FROM (
  SELECT n.cnpj, n.grupo_dfp, n.date, CAST(n.ttm AS DOUBLE) / NULLIF(CAST(x.{col} AS DOUBLE), 0) * CAST(100 AS DOUBLE) AS {kind}
  FROM nin n JOIN {table} x ON n.cnpj = x.cnpj AND n.grupo_dfp = x.grupo_dfp AND n.date = x.date) z
WHERE {kind} IS NOT NULL"""


def pct_sql(n: str, d: str) -> str:
    return f"CAST({n} AS DOUBLE) / NULLIF(CAST({d} AS DOUBLE), 0) * CAST(100 AS DOUBLE)"


def margin_tail(src: str, name: str, quarter=True, ytd=True, ttm=True, order="date") -> str:
    cols = ["cnpj", "grupo_dfp", "date"]
    if ytd:
        cols.append(f"{pct_sql('num', 'den')} AS ytd_{name}")
    if quarter:
        cols.append(f"CASE WHEN freq <> 'A' THEN {pct_sql('qn', 'qd')} END AS {name}")
    if ttm:
        cols.append(f"CASE WHEN freq <> 'A' THEN {pct_sql('tn', 'td')} END AS ttm_{name}")
    return f""",
mq AS (
  SELECT *, CASE WHEN fiscal_quarter = 1 THEN num ELSE num - LAG(num) OVER wo END AS qn,
            CASE WHEN fiscal_quarter = 1 THEN den ELSE den - LAG(den) OVER wo END AS qd
  FROM {src} WINDOW wo AS (PARTITION BY cnpj, grupo_dfp ORDER BY {order})),
mt AS (
  SELECT *, CASE WHEN COUNT(qn) OVER w4 = 4 THEN SUM(qn) OVER w4 END AS tn,
            CASE WHEN COUNT(qd) OVER w4 = 4 THEN SUM(qd) OVER w4 END AS td
  FROM mq WINDOW w4 AS (PARTITION BY cnpj, grupo_dfp ORDER BY {order} ROWS BETWEEN 3 PRECEDING AND CURRENT ROW))
SELECT {', '.join(cols)} FROM mt WHERE date >= (b - INTERVAL 12 MONTH) + INTERVAL 12 MONTH"""


def gross_profit_margin_sql(start="all", **flags) -> str:
    b = begin_sql(start)
    body = f"""
gm AS (
  SELECT a.cnpj, a.grupo_dfp, a.dt_fim_exerc AS date, a.fiscal_quarter, a.vl_conta AS num, r.vl_conta AS den,
         co.freq, {b} AS b
  FROM dre a JOIN co ON a.cnpj = co.cnpj AND a.grupo_dfp = co.grupo_dfp
  JOIN dre r ON a.dt_fim_exerc = r.dt_fim_exerc AND a.grupo_dfp = r.grupo_dfp AND a.cnpj = r.cnpj
  WHERE a.cd_conta = '3.03' AND r.cd_conta = '3.01' AND a.dt_fim_exerc >= {b} - INTERVAL 12 MONTH)"""
    sql = with_ctes(body)
    return sql.rstrip() + margin_tail("gm", "gross_profit_margin", **flags)


def net_profit_margin_sql(start="all", **flags) -> str:
    b = begin_sql(start)
    body = f"""
nr AS (
  SELECT a.cnpj, a.grupo_dfp, a.dt_fim_exerc AS date, a.fiscal_quarter, a.cd_conta, a.ds_conta,
         a.vl_conta AS num, r.vl_conta AS den, co.freq, {b} AS b
  FROM dre a JOIN co ON a.cnpj = co.cnpj AND a.grupo_dfp = co.grupo_dfp
  JOIN dre r ON a.dt_fim_exerc = r.dt_fim_exerc AND a.grupo_dfp = r.grupo_dfp AND a.cnpj = r.cnpj
  WHERE a.ds_conta IN ('{NI_A}', '{NI_B}') AND r.cd_conta = '3.01' AND a.dt_fim_exerc >= {b} - INTERVAL 12 MONTH),
nl AS (SELECT *, MAX(CASE WHEN ds_conta = '{NI_A}' THEN 1 ELSE 0 END) OVER (PARTITION BY cnpj, grupo_dfp) AS has_a FROM nr),
ns AS (SELECT * FROM nl WHERE CASE WHEN has_a = 1 THEN ds_conta = '{NI_A}' ELSE ds_conta = '{NI_B}' END)"""
    return with_ctes(body).rstrip() + margin_tail("ns", "net_profit_margin", order="date, cd_conta", **flags)


def ebitda_margin_sql(start="all", quarter=True, ytd=True, ttm=True) -> str:
    b = begin_sql(start)
    body = f"""
xr AS (
  SELECT e.cnpj, e.grupo_dfp, e.dt_fim_exerc AS date, e.fiscal_quarter, e.cd_conta, e.ds_conta,
         e.vl_conta AS ye, v.vl_conta AS yd, r.vl_conta AS yr, co.freq, {b} AS b
  FROM dre e JOIN co ON e.cnpj = co.cnpj AND e.grupo_dfp = co.grupo_dfp
  JOIN dva v ON e.dt_fim_exerc = v.dt_fim_exerc AND e.grupo_dfp = v.grupo_dfp AND e.cnpj = v.cnpj
  JOIN dre r ON e.dt_fim_exerc = r.dt_fim_exerc AND e.grupo_dfp = r.grupo_dfp AND e.cnpj = r.cnpj
  WHERE e.ds_conta IN ('{EBIT_A}', '{EBIT_B}') AND v.ds_conta = '{DA}' AND r.cd_conta = '3.01'
    AND e.dt_fim_exerc >= {b} - INTERVAL 12 MONTH),
xl AS (SELECT *, MAX(CASE WHEN ds_conta = '{EBIT_A}' THEN 1 ELSE 0 END) OVER (PARTITION BY cnpj, grupo_dfp) AS has_a FROM xr),
xs AS (SELECT * FROM xl WHERE CASE WHEN has_a = 1 THEN ds_conta = '{EBIT_A}' ELSE ds_conta = '{EBIT_B}' END),
xq AS (
  SELECT *, CASE WHEN fiscal_quarter = 1 THEN yr ELSE yr - LAG(yr) OVER wo END AS qr,
    (CASE WHEN fiscal_quarter = 1 THEN ye ELSE ye - LAG(ye) OVER wo END)
    - (CASE WHEN fiscal_quarter = 1 THEN yd ELSE yd - LAG(yd) OVER wo END) AS q
  FROM xs WINDOW wo AS (PARTITION BY cnpj, grupo_dfp ORDER BY date, cd_conta)),
xt AS (
  SELECT *, CASE WHEN COUNT(q) OVER w4 = 4 THEN SUM(q) OVER w4 END AS tq,
            CASE WHEN COUNT(qr) OVER w4 = 4 THEN SUM(qr) OVER w4 END AS tr
  FROM xq WINDOW w4 AS (PARTITION BY cnpj, grupo_dfp ORDER BY date, cd_conta ROWS BETWEEN 3 PRECEDING AND CURRENT ROW))"""
    cols = ["cnpj", "grupo_dfp", "date"]
    if ytd:
        cols.append(f"{pct_sql('ye - yd', 'yr')} AS ytd_ebitda_margin")
    if quarter:
        cols.append(f"CASE WHEN freq <> 'A' THEN {pct_sql('q', 'qr')} END AS ebitda_margin")
    if ttm:
        cols.append(f"CASE WHEN freq <> 'A' THEN {pct_sql('tq', 'tr')} END AS ttm_ebitda_margin")
    return with_ctes(body) + f"SELECT {', '.join(cols)} FROM xt WHERE date >= (b - INTERVAL 12 MONTH) + INTERVAL 12 MONTH"


# ------------------------------------------------------------------ market
def pbegin(start: str) -> str:
    """Begin of a price function: 'last' is the ticker's newest price date."""
    if start == "last":
        return "sc.last_price_date"
    return begin_sql(start)


def shift7(start: str) -> str:
    """A dated start moved back 7 months; 'all' and 'last' unchanged."""
    if start in ("all", "last"):
        return start
    return f"expr:(DATE '{start}' - INTERVAL 7 MONTH)"


SHARES_CTES = """
ons AS (SELECT k.cnpj, p.date, p.number_shares AS on_shares FROM prices p JOIN cls_ok k ON p.ticker = k.on_ticker),
pns AS (SELECT k.cnpj, p.date, p.number_shares AS pn_shares FROM prices p JOIN cls_ok k ON p.ticker = k.pn_ticker),
shc AS (
  SELECT o.cnpj, o.date,
    CASE WHEN k.pn_ticker IS NOT NULL THEN o.on_shares + COALESCE(n.pn_shares, 0) ELSE o.on_shares END AS total_shares
  FROM ons o LEFT JOIN pns n ON o.cnpj = n.cnpj AND o.date = n.date JOIN cls_ok k ON o.cnpj = k.cnpj),
mvc AS (
  SELECT k.cnpj, p.date, SUM(p.preult * p.number_shares) AS market_value
  FROM prices p JOIN cls_ok k ON p.ticker = k.on_ticker OR p.ticker = k.pn_ticker
  GROUP BY k.cnpj, p.date)"""


def prices_ctes(start: str) -> str:
    return f"""
pr AS (SELECT p.ticker, p.date, p.preult AS price FROM prices p JOIN sc ON p.ticker = sc.ticker
       WHERE p.date >= {pbegin(start)})"""


def prices_sql(start="all") -> str:
    return with_ctes(prices_ctes(start)) + "SELECT ticker, date, price FROM pr"


def total_shares_sql(start="all") -> str:
    return with_ctes(SHARES_CTES) + f"""SELECT sc.ticker, s.date, s.total_shares
FROM shc s JOIN sc ON s.cnpj = sc.cnpj WHERE s.date >= {pbegin(start)}"""


def market_value_sql(start="all") -> str:
    return with_ctes(SHARES_CTES) + f"""SELECT sc.ticker, m.date, m.market_value
FROM mvc m JOIN sc ON m.cnpj = sc.cnpj WHERE m.date >= {pbegin(start)}"""


def eps_ctes(start: str) -> str:
    """epsf: cnpj, grupo_dfp, date, eps (final rows)."""
    if start == "last":
        b, b7 = "co.last_statement_date", "co.last_statement_date - INTERVAL 7 MONTH"
    else:
        b = begin_sql(start)
        b7 = f"{b} - INTERVAL 7 MONTH"
    pick = "rn = 1" if start == "last" else f"date >= {b}"
    return ni_ttm_ctes(f"expr:({b7})", "e") + f""",
esh AS (SELECT co.cnpj, co.grupo_dfp, s.date, s.total_shares FROM shc s JOIN co ON s.cnpj = co.cnpj
        WHERE s.date >= {b7}),
em AS (
  SELECT COALESCE(s.cnpj, n.cnpj) AS cnpj, COALESCE(s.grupo_dfp, n.grupo_dfp) AS grupo_dfp,
         COALESCE(s.date, n.date) AS date, s.total_shares, n.ttm
  FROM esh s FULL OUTER JOIN nie n ON s.cnpj = n.cnpj AND s.grupo_dfp = n.grupo_dfp AND s.date = n.date),
ef AS (
  SELECT cnpj, grupo_dfp, date,
    LAST_VALUE(total_shares IGNORE NULLS) OVER w AS ts, LAST_VALUE(ttm IGNORE NULLS) OVER w AS tt,
    ROW_NUMBER() OVER (PARTITION BY cnpj, grupo_dfp ORDER BY date DESC) AS rn
  FROM em WINDOW w AS (PARTITION BY cnpj, grupo_dfp ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
epsf AS (
  SELECT ef.cnpj, ef.grupo_dfp, ef.date, CAST(ef.tt * 1000 AS DOUBLE) / NULLIF(ef.ts, 0) AS eps
  FROM ef JOIN co ON ef.cnpj = co.cnpj AND ef.grupo_dfp = co.grupo_dfp
  WHERE {pick.replace('date', 'ef.date') if start != 'last' else 'ef.rn = 1'}
    AND CAST(ef.tt * 1000 AS DOUBLE) / NULLIF(ef.ts, 0) IS NOT NULL)"""


def eps_sql(start="all") -> str:
    return with_ctes(SHARES_CTES, eps_ctes(start)) + "SELECT cnpj, grupo_dfp, date, eps FROM epsf"


def price_earnings_sql(start="all") -> str:
    return with_ctes(SHARES_CTES, eps_ctes(start), prices_ctes(start)) + """,
ept AS (SELECT sc.ticker, e.date, e.eps FROM epsf e JOIN sc ON e.cnpj = sc.cnpj AND e.grupo_dfp = sc.grupo_dfp)
SELECT COALESCE(p.ticker, e.ticker) AS ticker, COALESCE(p.date, e.date) AS date, p.price / NULLIF(e.eps, 0) AS p_e
FROM pr p FULL OUTER JOIN ept e ON p.ticker = e.ticker AND p.date = e.date"""


def ffill_merge(name: str, left: str, lcol: str, right: str, rcol: str) -> str:
    """Outer merge of two per-ticker series then forward fill of both columns."""
    return f"""
{name}m AS (
  SELECT COALESCE(a.ticker, b.ticker) AS ticker, COALESCE(a.date, b.date) AS date, a.{lcol} AS lv, b.{rcol} AS rv
  FROM {left} a FULL OUTER JOIN {right} b ON a.ticker = b.ticker AND a.date = b.date),
{name} AS (
  SELECT ticker, date, LAST_VALUE(lv IGNORE NULLS) OVER w AS lv, LAST_VALUE(rv IGNORE NULLS) OVER w AS rv
  FROM {name}m WINDOW w AS (PARTITION BY ticker ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"""


def ev_ctes(start: str) -> str:
    return balance_ctes(shift7(start), "v") + f""",
evmv AS (SELECT sc.ticker, m.date, m.market_value FROM mvc m JOIN sc ON m.cnpj = sc.cnpj WHERE m.date >= {pbegin(start)}),
evnd AS (SELECT sc.ticker, n.date, n.net_debt FROM ndv n JOIN sc ON n.cnpj = sc.cnpj AND n.grupo_dfp = sc.grupo_dfp),""" \
        + ffill_merge("evf", "evmv", "market_value", "evnd", "net_debt") + """,
evx AS (SELECT ticker, date, lv + rv * 1000 AS ev FROM evf WHERE lv + rv * 1000 IS NOT NULL)"""


def enterprise_value_sql(start="all") -> str:
    return with_ctes(SHARES_CTES, ev_ctes(start)) + "SELECT ticker, date, ev FROM evx"


def ev_multiple_sql(kind: str, start="all") -> str:
    s7 = shift7(start)
    if kind == "ebitda":
        ctes = ebitda_ctes(s7, "x") + """,
fm AS (SELECT cnpj, grupo_dfp, date, CASE WHEN freq <> 'A' THEN t END AS ttm
       FROM etx WHERE date >= (b - INTERVAL 12 MONTH) + INTERVAL 12 MONTH)"""
    else:
        ctes = flow_ctes("dre", f"d.ds_conta IN ('{EBIT_A}', '{EBIT_B}')", (EBIT_A, EBIT_B), s7, "x") + """,
fm AS (SELECT cnpj, grupo_dfp, date, CASE WHEN freq <> 'A' THEN t END AS ttm
       FROM tvx WHERE date >= (b - INTERVAL 12 MONTH) + INTERVAL 12 MONTH)"""
    ctes += """,
fmt AS (SELECT sc.ticker, f.date, f.ttm FROM fm f JOIN sc ON f.cnpj = sc.cnpj AND f.grupo_dfp = sc.grupo_dfp),""" \
        + ffill_merge("mf", "evx", "ev", "fmt", "ttm")
    name = f"ev_{kind}"
    return with_ctes(SHARES_CTES, ev_ctes(start), ctes) + f"""SELECT * FROM (
  SELECT ticker, date, lv / NULLIF(rv, 0) / CAST(1000 AS DOUBLE) AS {name} FROM mf) z WHERE {name} IS NOT NULL"""


def bv_ctes(start: str) -> str:
    return balance_ctes(shift7(start), "q") + f""",
bsh AS (SELECT sc.ticker, s.date, s.total_shares FROM shc s JOIN sc ON s.cnpj = sc.cnpj WHERE s.date >= {pbegin(start)}),
beq AS (SELECT sc.ticker, e.date, e.total_equity FROM equityq e JOIN sc ON e.cnpj = sc.cnpj AND e.grupo_dfp = sc.grupo_dfp),""" \
        + ffill_merge("bvf", "bsh", "total_shares", "beq", "total_equity") + """,
bvx AS (SELECT * FROM (SELECT ticker, date, CAST(rv AS DOUBLE) / NULLIF(lv, 0) * CAST(1000 AS DOUBLE) AS bv_share FROM bvf) z
        WHERE bv_share IS NOT NULL)"""


def bv_share_sql(start="all") -> str:
    return with_ctes(SHARES_CTES, bv_ctes(start)) + "SELECT ticker, date, bv_share FROM bvx"


def price_bv_sql(start="all") -> str:
    return with_ctes(SHARES_CTES, bv_ctes(start), prices_ctes(start)) + """SELECT COALESCE(p.ticker, b.ticker) AS ticker,
  COALESCE(p.date, b.date) AS date, p.price / NULLIF(b.bv_share, 0) AS p_bv
FROM pr p FULL OUTER JOIN bvx b ON p.ticker = b.ticker AND p.date = b.date"""


# -------------------------------------------------------------- statements
def flow_statement_ctes(table: str, start: str = "all", tag: str = "") -> str:
    """stm{tag}: cnpj, grupo_dfp, cd_conta, ds_conta, date, ytd, quarter_value, ttm_value + pct changes."""
    b = begin_sql(start)
    return f"""
isr{tag} AS (
  SELECT d.cnpj, d.grupo_dfp, d.cd_conta, d.ds_conta, d.dt_fim_exerc AS date, d.fiscal_quarter, d.vl_conta AS ytd,
         co.freq, {b} AS b
  FROM {table} d JOIN co ON d.cnpj = co.cnpj AND d.grupo_dfp = co.grupo_dfp
  WHERE d.dt_fim_exerc >= {b} - INTERVAL 12 MONTH),
isq{tag} AS (
  SELECT *, CASE WHEN freq <> 'A' THEN
              (CASE WHEN fiscal_quarter = 1 THEN ytd ELSE ytd - LAG(ytd) OVER wa END) END AS quarter_value
  FROM isr{tag} WINDOW wa AS (PARTITION BY cnpj, grupo_dfp, cd_conta ORDER BY date, ds_conta)),
ist{tag} AS (
  SELECT *, CASE WHEN freq <> 'A' AND COUNT(quarter_value) OVER w4 = 4 THEN CAST(SUM(quarter_value) OVER w4 AS BIGINT) END AS ttm_value
  FROM isq{tag} WINDOW w4 AS (PARTITION BY cnpj, grupo_dfp, cd_conta ORDER BY date, ds_conta ROWS BETWEEN 3 PRECEDING AND CURRENT ROW)),
ism{tag} AS (SELECT * FROM ist{tag} WHERE date >= (b - INTERVAL 12 MONTH) + INTERVAL 12 MONTH),
isy{tag} AS (SELECT cnpj, grupo_dfp, cd_conta, date + INTERVAL 12 MONTH AS d2, SUM(ytd) AS prev
             FROM ism{tag} GROUP BY cnpj, grupo_dfp, cd_conta, date),
isp{tag} AS (
  SELECT m.*, MIN(m.ds_conta) OVER (PARTITION BY m.cnpj, m.grupo_dfp, m.cd_conta) AS ds_first,
    (CAST(m.quarter_value AS DOUBLE) / NULLIF(LAG(m.quarter_value) OVER wa, 0) - 1) * CAST(100 AS DOUBLE) AS qp,
    (CAST(m.ttm_value AS DOUBLE) / NULLIF(LAG(m.ttm_value) OVER wa, 0) - 1) * CAST(100 AS DOUBLE) AS tp,
    (CAST(m.ytd AS DOUBLE) / NULLIF(y.prev, 0) - 1) * CAST(100 AS DOUBLE) AS yp
  FROM ism{tag} m LEFT JOIN isy{tag} y ON m.cnpj = y.cnpj AND m.grupo_dfp = y.grupo_dfp AND m.cd_conta = y.cd_conta AND m.date = y.d2
  WINDOW wa AS (PARTITION BY m.cnpj, m.grupo_dfp, m.cd_conta ORDER BY m.date, m.ds_conta)),
stm{tag} AS (
  SELECT cnpj, grupo_dfp, cd_conta, MIN(ds_first) AS ds_conta, date,
    COALESCE(CAST(SUM(ytd) AS BIGINT), 0) AS ytd, COALESCE(SUM(yp), 0) AS ytd_pct_change,
    CASE WHEN MAX(freq) <> 'A' THEN COALESCE(CAST(SUM(quarter_value) AS BIGINT), 0) END AS quarter_value,
    CASE WHEN MAX(freq) <> 'A' THEN COALESCE(SUM(qp), 0) END AS quarter_value_pct_change,
    CASE WHEN MAX(freq) <> 'A' THEN COALESCE(CAST(SUM(ttm_value) AS BIGINT), 0) END AS ttm_value,
    CASE WHEN MAX(freq) <> 'A' THEN COALESCE(SUM(tp), 0) END AS ttm_value_pct_change
  FROM isp{tag} GROUP BY cnpj, grupo_dfp, cd_conta, date)"""


def balance_sheet_ctes(start: str = "all", tag: str = "") -> str:
    b = bexpr(start)
    return f"""
bsr{tag} AS (
  SELECT x.cnpj, x.grupo_dfp, x.cd_conta, x.ds_conta, x.dt_fim_exerc AS date, x.vl_conta
  FROM (SELECT cnpj, grupo_dfp, dt_fim_exerc, cd_conta, ds_conta, vl_conta FROM bpa
        UNION ALL SELECT cnpj, grupo_dfp, dt_fim_exerc, cd_conta, ds_conta, vl_conta FROM bpp) x
  JOIN co ON x.cnpj = co.cnpj AND x.grupo_dfp = co.grupo_dfp
  WHERE x.dt_fim_exerc >= {b}),
bsp{tag} AS (
  SELECT *, MIN(ds_conta) OVER (PARTITION BY cnpj, grupo_dfp, cd_conta) AS ds_first,
    (CAST(vl_conta AS DOUBLE) / NULLIF(LAG(vl_conta) OVER (PARTITION BY cnpj, grupo_dfp, cd_conta ORDER BY date, ds_conta), 0) - 1)
      * CAST(100 AS DOUBLE) AS vp
  FROM bsr{tag}),
bs{tag} AS (
  SELECT cnpj, grupo_dfp, cd_conta, MIN(ds_first) AS ds_conta, date,
    COALESCE(CAST(SUM(vl_conta) AS BIGINT), 0) AS vl_conta, COALESCE(SUM(vp), 0) AS vl_conta_pct_change
  FROM bsp{tag} GROUP BY cnpj, grupo_dfp, cd_conta, date)"""


# ------------------------------------------------------------------ growth
def cagr_sql(kind: str, n_years: int = 5) -> str:
    start = f"expr:(co.last_statement_date - INTERVAL {12 * n_years} MONTH)"
    if kind == "net_income":
        ctes = ni_ttm_ctes(start, "g")
        src = "nig"
    else:
        ctes = flow_ctes("dre", "d.cd_conta = '3.01'", None, start, "g") + """,
nig2 AS (SELECT cnpj, grupo_dfp, date, CASE WHEN freq <> 'A' THEN t END AS ttm
         FROM tvg WHERE date >= (b - INTERVAL 12 MONTH) + INTERVAL 12 MONTH)"""
        src = "nig2"
    return with_ctes(ctes) + f""",
fe AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY cnpj, grupo_dfp ORDER BY date) AS r1,
                 ROW_NUMBER() OVER (PARTITION BY cnpj, grupo_dfp ORDER BY date DESC) AS r2 FROM {src}),
cg AS (
  SELECT a.cnpj, a.grupo_dfp,
    (POW(CAST(z.ttm AS DOUBLE) / NULLIF(CAST(a.ttm AS DOUBLE), 0), CAST(1 AS DOUBLE) / {n_years}) - 1) * CAST(100 AS DOUBLE) AS x
  FROM fe a JOIN fe z ON a.cnpj = z.cnpj AND a.grupo_dfp = z.grupo_dfp AND a.r1 = 1 AND z.r2 = 1)
SELECT cnpj, grupo_dfp, CASE WHEN isnan(x) THEN NULL ELSE x END AS cagr_{kind} FROM cg"""


# ------------------------------------------------------------------- peers
PEERS_SQL = with_ctes() + """SELECT t.ticker, t.sector, t.subsector, t.segment,
  COUNT(*) OVER (PARTITION BY t.sector, t.subsector, t.segment) AS n_peers
FROM tickers t"""

# The given tickers of the reports that compare a list.
# The tickers shown: the smallest one of each sector (the five regions).
SECTORS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]
_LEADERS = "SELECT MIN(ticker) FROM tickers GROUP BY sector"


def get_peers_sql() -> str:
    return with_ctes() + f"""SELECT t.ticker, t.sector, t.subsector, t.segment FROM tickers t
WHERE EXISTS (SELECT 1 FROM tickers g WHERE g.ticker IN ({_LEADERS}) AND g.sector = t.sector
              AND g.subsector = t.subsector AND g.segment = t.segment)"""


# -------------------------------------------------------------- statistics
def _sub(sql: str) -> str:
    return "(" + sql + ")"


def statistics_sql(n_years: int = 5) -> str:
    ttm = dict(quarter=False, ytd=False, ttm=True)
    per_ticker = {
        "p_e": price_earnings_sql("last"), "ev_ebitda": ev_multiple_sql("ebitda", "last"),
        "p_bv": price_bv_sql("last"), "ev_ebit": ev_multiple_sql("ebit", "last"),
        "bv_share": bv_share_sql("last"), "market_value": market_value_sql("last"),
        "ev": enterprise_value_sql("last"),
    }
    bal = with_ctes(balance_ctes("last"))
    per_company = {
        "eps": eps_sql("last"),
        "ttm_gross_profit_margin": gross_profit_margin_sql("last", **ttm),
        "ttm_net_profit_margin": net_profit_margin_sql("last", **ttm),
        "roe": return_sql("roe", "last"), "roa": return_sql("roa", "last"),
        "debt_to_equity": bal + ratio_full("debt", "equity", "total_debt", "total_equity", "debt_to_equity"),
        "total_equity": bal + "SELECT cnpj, grupo_dfp, date, total_equity FROM equity",
        "total_assets": bal + "SELECT cnpj, grupo_dfp, date, total_assets FROM assets",
        "total_debt": bal + "SELECT cnpj, grupo_dfp, date, total_debt FROM debt",
        "cash_equi": bal + "SELECT cnpj, grupo_dfp, date, cash_equi FROM cash",
        "net_debt": bal + "SELECT cnpj, grupo_dfp, date, net_debt FROM nd",
        "ttm_ebitda": ebitda_sql("last", **ttm),
        "ttm_ebitda_margin": ebitda_margin_sql("last", **ttm),
        "financial_leverage": bal + ratio_full("assets", "equity", "total_assets", "total_equity", "financial_leverage"),
        "ttm_d_a": depre_amort_sql("last", **ttm), "ttm_ebit": ebit_sql("last", **ttm),
        "ttm_revenue": revenue_sql("last", **ttm), "ttm_net_income": net_income_sql("last", **ttm),
        "ttm_cfo": cfo_sql("last", **ttm), "current_ratio": current_ratio_sql("last"),
    }
    parts = []
    for name, sql in per_ticker.items():
        parts.append(f"SELECT x.ticker, '{name}' AS measure, x.date, CAST(x.{name} AS DOUBLE) AS value FROM {_sub(sql)} x")
    for name, sql in per_company.items():
        parts.append(f"SELECT sc.ticker, '{name}' AS measure, x.date, CAST(x.{name} AS DOUBLE) AS value "
                     f"FROM {_sub(sql)} x JOIN sc ON x.cnpj = sc.cnpj AND x.grupo_dfp = sc.grupo_dfp")
    names = list(per_ticker) + list(per_company)
    order = ["p_e", "ev_ebitda", "p_bv", "ev_ebit", "bv_share", "eps", "ttm_gross_profit_margin",
             "ttm_net_profit_margin", "roe", "roa", "debt_to_equity", "total_equity", "total_assets", "total_debt",
             "cash_equi", "net_debt", "market_value", "ev", "ttm_ebitda", "ttm_ebitda_margin", "financial_leverage",
             "ttm_d_a", "ttm_ebit", "ttm_revenue", "ttm_net_income", "ttm_cfo", "current_ratio"]
    assert sorted(order) == sorted(names)
    aggs = ", ".join(f"MAX(CASE WHEN measure = '{n}' THEN value END) AS {n}" for n in order)
    return with_ctes(f"parts AS ({' UNION ALL '.join(parts)})") + f""",
wide AS (SELECT ticker, MAX(date) AS date, {aggs} FROM parts GROUP BY ticker),
cni AS (SELECT * FROM {_sub(cagr_sql('net_income', n_years))} q),
crv AS (SELECT * FROM {_sub(cagr_sql('revenue', n_years))} q)
SELECT w.*, cni.cagr_net_income, crv.cagr_revenue, sc.sector, sc.subsector, sc.segment
FROM wide w JOIN sc ON w.ticker = sc.ticker
LEFT JOIN cni ON sc.cnpj = cni.cnpj AND sc.grupo_dfp = cni.grupo_dfp
LEFT JOIN crv ON sc.cnpj = crv.cnpj AND sc.grupo_dfp = crv.grupo_dfp"""


# -------------------------------------------------------------- comparison
def individual(sql: str) -> str:
    """The same query for the Individual group: no company uses its consolidated statements."""
    both = "CASE WHEN h.cnpj IS NOT NULL THEN 'Consolidado' ELSE 'Individual' END AS grupo_dfp"
    assert both in sql
    return sql.replace(both, "'Individual' AS grupo_dfp")


def compare_wide_sql() -> str:
    cols = ", ".join(f"MAX(CASE WHEN t.sector = '{x}' THEN {v} END) AS \"{v} {x}\"" for x in SECTORS
                     for v in ("ytd_net_income", "quarter_net_income", "ttm_net_income"))
    return with_ctes() + f"""SELECT q.date, {cols} FROM {_sub(compare_net_income_sql())} q JOIN tickers t ON q.ticker = t.ticker
WHERE q.ticker IN ({_LEADERS}) GROUP BY q.date"""


def compare_net_income_sql(start: str = "all") -> str:
    return with_ctes() + f"""SELECT sc.ticker, x.date, x.ytd_net_income, x.quarter_net_income, x.ttm_net_income
FROM {_sub(net_income_sql(start))} x JOIN sc ON x.cnpj = sc.cnpj AND x.grupo_dfp = sc.grupo_dfp"""


def compare_common_sql() -> str:
    return with_ctes(balance_ctes()) + """,
ta AS (SELECT sc.ticker, a.date, a.total_assets FROM assets a JOIN sc ON a.cnpj = sc.cnpj AND a.grupo_dfp = sc.grupo_dfp),
common AS (SELECT date FROM ta WHERE total_assets IS NOT NULL GROUP BY date
           HAVING COUNT(DISTINCT ticker) = (SELECT COUNT(*) FROM sc))
SELECT ticker, date, total_assets FROM ta WHERE date IN (SELECT date FROM common)"""


def frequency_sql(dates_sql: str) -> str:
    """(series, n_dates, frequency, is_regular) of the distinct dates in (series, date)."""
    months = "['JAN','FEB','MAR','APR','MAY','JUN','JUL','AUG','SEP','OCT','NOV','DEC']"
    days = "['MON','TUE','WED','THU','FRI','SAT','SUN']"
    many = lambda n, name: f"CASE WHEN {n} > 1 THEN CAST({n} AS VARCHAR) ELSE '' END || {name}"
    return f"""WITH d AS (SELECT DISTINCT series, date FROM {_sub(dates_sql)} q),
g AS (SELECT series, date, ISODOW(date) - 1 AS wd, DAY(date) AS dd, DAY(LAST_DAY(date)) AS dm, (DAY(date) - 1) // 7 AS wk,
  (YEAR(date) * 12 + MONTH(date)) - LAG(YEAR(date) * 12 + MONTH(date)) OVER s AS gm, DATE_DIFF('day', LAG(date) OVER s, date) AS gd
  FROM d WINDOW s AS (PARTITION BY series ORDER BY date)),
h AS (SELECT series, COUNT(*) AS n_dates, MONTH(MIN(date)) AS mo, MIN(gm) AS gm, MAX(gm) AS gm_hi, MIN(gd) AS gd, MAX(gd) AS gd_hi,
  BOOL_AND(dd = dm) AS ce, BOOL_AND(dd = dm OR (dm - dd < 3 AND wd = 4)) AS be, BOOL_AND(dd = 1) AS cs,
  BOOL_AND(dd = 1 OR (dd <= 3 AND wd = 0)) AS bs,
  BOOL_AND(gd IS NULL OR (gd = 1 AND wd BETWEEN 1 AND 4) OR (gd = 3 AND wd = 0)) AS work,
  MIN(wd) AS wd, MAX(wd) AS wd_hi, MIN(wk) FILTER (wk < 4) AS wk, MAX(wk) FILTER (wk < 4) AS wk_hi FROM g GROUP BY series),
a AS (SELECT *, CASE WHEN ce OR cs OR be OR bs THEN gm = gm_hi AND gm > 0 ELSE FALSE END AS monthly,
  CASE WHEN ce THEN '' WHEN be THEN 'B' WHEN cs THEN '' ELSE 'B' END AS biz, CASE WHEN ce OR be THEN 'E' ELSE 'S' END AS fin FROM h),
f AS (SELECT series, n_dates, CASE WHEN n_dates < 3 THEN NULL
  WHEN monthly AND gm % 12 = 0 THEN {many("gm // 12", f"biz || 'Y' || fin || '-' || {months}[mo]")}
  WHEN monthly AND gm % 3 = 0 THEN {many("gm // 3", "biz || 'Q' || fin || '-' || ['DEC','OCT','NOV'][mo % 3 + 1]")}
  WHEN monthly THEN {many("gm", "biz || 'M' || fin")}
  WHEN gd = gd_hi AND gd % 7 = 0 THEN {many("gd // 7", f"'W-' || {days}[wd + 1]")}
  WHEN gd = gd_hi THEN {many("gd", "'D'")}
  WHEN work AND gd = 1 AND gd_hi = 3 THEN 'B'
  WHEN wd = wd_hi AND wk = wk_hi THEN 'WOM-' || CAST(wk + 1 AS VARCHAR) || {days}[wd + 1] END AS frequency FROM a)
SELECT series, n_dates, frequency, frequency IS NOT NULL AS is_regular FROM f"""


def is_regular_sql(name: str, dates_sql: str) -> str:
    return f"""SELECT series AS measure, n_dates, is_regular
FROM {_sub(frequency_sql(f"SELECT '{name}' AS series, date FROM {_sub(dates_sql)} x"))} y"""


def frequency_classes_sql() -> str:
    return frequency_sql(with_ctes() + """SELECT cnpj || ' ' || grupo_dfp AS series, date FROM sdates
UNION ALL SELECT ticker, date FROM prices""")


# ------------------------------------------------------------------ charts
def bs_composition_sql() -> str:
    return with_ctes(balance_sheet_ctes()) + """SELECT cnpj, grupo_dfp, cd_conta, ds_conta, date, vl_conta,
  CASE WHEN SUBSTRING(cd_conta, 1, 1) = '1' THEN 'assets' ELSE 'liabilities_equity' END AS side
FROM (SELECT *, MAX(ABS(vl_conta)) OVER (PARTITION BY cnpj, grupo_dfp, cd_conta) AS nz FROM bs) z
WHERE LENGTH(cd_conta) = 7 AND nz > 0 AND SUBSTRING(cd_conta, 1, 1) IN ('1', '2')"""


def account_seasonality_sql(cd: str = "3.01") -> str:
    return with_ctes(flow_statement_ctes("dre")) + f""",
a AS (SELECT *, GREATEST(MAX(ABS(COALESCE(ytd, 0))) OVER w, MAX(ABS(COALESCE(quarter_value, 0))) OVER w,
                         MAX(ABS(COALESCE(ttm_value, 0))) OVER w) AS nz
      FROM stm WHERE cd_conta = '{cd}' WINDOW w AS (PARTITION BY cnpj, grupo_dfp, cd_conta)),
m AS (SELECT cnpj, grupo_dfp, cd_conta, ds_conta, date, 'ytd' AS value_type, ytd AS value FROM a WHERE nz > 0
      UNION ALL SELECT cnpj, grupo_dfp, cd_conta, ds_conta, date, 'quarter_value', quarter_value FROM a WHERE nz > 0
      UNION ALL SELECT cnpj, grupo_dfp, cd_conta, ds_conta, date, 'ttm_value', ttm_value FROM a WHERE nz > 0)
SELECT cnpj, grupo_dfp, cd_conta, ds_conta, value_type, CAST(YEAR(date) AS INTEGER) AS year,
       CAST(MONTH(date) AS INTEGER) AS month, value
FROM m WHERE value IS NOT NULL"""


def series_summary_sql() -> str:
    return with_ctes(SHARES_CTES) + """,
mv AS (SELECT sc.ticker, m.date, m.market_value FROM mvc m JOIN sc ON m.cnpj = sc.cnpj),
st AS (SELECT ticker, AVG(market_value) AS mean, MEDIAN(market_value) AS median FROM mv GROUP BY ticker)
SELECT mv.ticker, mv.date,
  LAST_VALUE(mv.market_value IGNORE NULLS) OVER (PARTITION BY mv.ticker ORDER BY mv.date
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS market_value, st.mean, st.median
FROM mv JOIN st ON mv.ticker = st.ticker"""


def statement_pivot_sql() -> str:
    """Columns by name, as a view needs them: the report dates are the quarter ends from
    the input's first quarter to its last one before October 2001 (FIXTURES.md)."""
    ends = [f"{y}-{m}" for y in range(1995, 2002) for m in ("03-31", "06-30", "09-30", "12-31") if (y, m) < (2001, "12")]
    cols = ", ".join(f"COALESCE(SUM(CASE WHEN date = DATE '{d}' THEN CAST({v} AS DOUBLE) END), 0) AS \"{d} {v}\""
                     for d in ends for v in ("vl_conta", "vl_conta_pct_change"))
    return with_ctes(balance_sheet_ctes()) + f"""SELECT cnpj, grupo_dfp, cd_conta, ds_conta, {cols}
FROM bs GROUP BY cnpj, grupo_dfp, cd_conta, ds_conta"""


QUARTER_VALUES_SQL = with_ctes(flow_statement_ctes("dre")) + """SELECT cnpj, grupo_dfp, cd_conta, ds_conta, date, ytd,
  quarter_value, ttm_value FROM ism"""

LATEST_ROWS_SQL = with_ctes() + """SELECT ticker, date, preult, totneg, quatot, number_shares FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY ticker ORDER BY date DESC) AS rn FROM prices) z WHERE rn = 1"""


def compare_filled_sql() -> str:
    """Every ticker on every date of any ticker of its peer group."""
    return with_ctes(f"""
pe AS (SELECT * FROM {_sub(price_earnings_sql())} q),
pdays AS (SELECT DISTINCT t.sector, t.subsector, t.segment, pe.date FROM pe JOIN tickers t ON pe.ticker = t.ticker),
grid AS (SELECT t.ticker, d.date FROM pdays d JOIN tickers t ON d.sector = t.sector AND d.subsector = t.subsector
         AND d.segment = t.segment)""") + """SELECT g.ticker, g.date,
  LAST_VALUE(pe.p_e IGNORE NULLS) OVER (PARTITION BY g.ticker ORDER BY g.date
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS p_e
FROM grid g LEFT JOIN pe ON g.ticker = pe.ticker AND g.date = pe.date"""


SCALAR_STRINGS_SQL = with_ctes() + """SELECT ticker, UPPER(LOWER(ticker)) AS ticker_upper, RIGHT(ticker, 1) AS last_char,
  SUBSTRING(ticker, 1, 3) AS prefix3, NULLIF(SPLIT_PART(sector, ' ', 2), '') AS second_word,
  CAST(LENGTH(denom_social) AS INTEGER) AS name_length, SUBSTRING(denom_social, 1, 1) AS first_char,
  ticker || ' ' || segment AS labelled
FROM tickers"""

SCALAR_DATES_SQL = with_ctes() + """SELECT cnpj, grupo_dfp, cd_conta, dt_fim_exerc,
  CAST(STRPTIME(STRFTIME(dt_fim_exerc, '%Y%m%d'), '%Y%m%d') AS DATE) AS parsed,
  CAST(dt_fim_exerc + INTERVAL 12 MONTH AS DATE) AS plus_year, CAST(dt_fim_exerc - INTERVAL 7 MONTH AS DATE) AS minus_7m,
  CAST(dt_fim_exerc + 1 AS DATE) AS next_day, CAST(YEAR(dt_fim_exerc) AS INTEGER) AS yr,
  CAST(MONTH(dt_fim_exerc) AS INTEGER) AS mo,
  DATE_DIFF('day', dt_ini_exerc, dt_fim_exerc) / 365.2425 AS span_years
FROM dre"""

SCALAR_MATH_SQL = with_ctes() + """SELECT ticker, date, CAST(quatot AS DOUBLE) / NULLIF(CAST(totneg AS DOUBLE), 0) AS per_trade,
  preult / NULLIF(CAST(totneg - totneg AS DOUBLE), 0) AS zero_div, POW(preult, 0.5) AS root_price,
  TRY_CAST(CAST(quatot AS VARCHAR) AS INTEGER) AS quatot_int,
  COALESCE(preult / NULLIF(CAST(totneg - totneg AS DOUBLE), 0), CAST(0 AS DOUBLE)) AS filled
FROM prices"""
