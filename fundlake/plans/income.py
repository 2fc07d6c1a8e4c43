"""Flow measures: net income, EBIT, D&A, EBITDA, revenue, CFO.

Each returns one row per company, group and report date with the columns
``ytd_<name>``, ``quarter_<name>`` and ``ttm_<name>`` chosen by the flags.
Quarter and ttm values are NULL for annual-only reporters.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fundlake.operators.flows import (K, company_window, lines_beside, not_annual, prefer_label, quarter_value,
                                      statement_rows, trailing_sum, trim_to_begin)
from fundlake.plans.scope import companies as companies_of
from fundlake.sources.catalog import Tables

# Fixed account labels and codes of the statements.
NET_INCOME_LABELS = ("Resultado Líquido das Operações Continuadas", "Lucro/Prejuízo do Período")
EBIT_LABELS = ("Resultado Antes do Resultado Financeiro e dos Tributos", "Resultado Operacional")
D_A_LABEL = "Depreciação, Amortização e Exaustão"
REVENUE_CODE = "3.01"
GROSS_PROFIT_CODE = "3.03"
CFO_CODE = "6.01"


def _select(df: DataFrame, name: str, quarter: bool, ytd: bool, ttm: bool) -> DataFrame:
    cols = [*K, "date"]
    if ytd:
        cols.append(f"ytd_{name}")
    if quarter:
        cols.append(f"quarter_{name}")
    if ttm:
        cols.append(f"ttm_{name}")
    return df.select(*cols)


def flow(tables: Tables, table: str, name: str, predicate: Column, labels: tuple[str, str] | None = None,
         quarter: bool = True, ytd: bool = True, ttm: bool = True, start_period="all",
         group: str = "consolidated", companies: DataFrame | None = None) -> DataFrame:
    """Generic year-to-date flow -> ytd / quarter / ttm for every company at once."""
    co = companies if companies is not None else companies_of(tables, group)
    rows = statement_rows(tables.get(table), predicate, co, start_period,
                          columns=("fiscal_quarter", "cd_conta", "ds_conta", F.col("vl_conta").alias("ytd")),
                          bucketed=tables.bucketed)
    if labels is not None:
        rows = prefer_label(rows, *labels)
    w = company_window(["date", "cd_conta"])
    rows = rows.withColumn("_q", quarter_value(F.col("ytd"), F.col("fiscal_quarter"), w))
    rows = rows.withColumn("_t", trailing_sum("_q", w))
    out = trim_to_begin(rows).select(
        *K, "date",
        F.col("ytd").alias(f"ytd_{name}"),
        not_annual(F.col("_q")).alias(f"quarter_{name}"),
        not_annual(F.col("_t")).alias(f"ttm_{name}"),
    )
    return _select(out, name, quarter, ytd, ttm)


def net_income(tables: Tables, quarter=True, ytd=True, ttm=True, start_period="all", **kw) -> DataFrame:
    return flow(tables, "dre", "net_income", F.col("ds_conta").isin(*NET_INCOME_LABELS), NET_INCOME_LABELS,
                quarter, ytd, ttm, start_period, **kw)


def ebit(tables: Tables, quarter=True, ytd=True, ttm=True, start_period="all", **kw) -> DataFrame:
    return flow(tables, "dre", "ebit", F.col("ds_conta").isin(*EBIT_LABELS), EBIT_LABELS,
                quarter, ytd, ttm, start_period, **kw)


def depre_amort(tables: Tables, quarter=True, ytd=True, ttm=True, start_period="all", **kw) -> DataFrame:
    return flow(tables, "dva", "d_a", F.col("ds_conta") == D_A_LABEL, None, quarter, ytd, ttm, start_period, **kw)


def revenue(tables: Tables, quarter=True, ytd=True, ttm=True, start_period="all", **kw) -> DataFrame:
    return flow(tables, "dre", "revenue", F.col("cd_conta") == REVENUE_CODE, None,
                quarter, ytd, ttm, start_period, **kw)


def cfo(tables: Tables, quarter=True, ytd=True, ttm=True, start_period="all", **kw) -> DataFrame:
    return flow(tables, "dfc", "cfo", F.col("cd_conta") == CFO_CODE, None, quarter, ytd, ttm, start_period, **kw)


def two_tables(tables: Tables, income_lines: Column) -> DataFrame:
    """Income-statement lines and the D&A line of the value-added statement in one frame
    (``line`` names the table), so that one exchange on the company key brings them together."""
    cols = ["cnpj", "grupo_dfp", "dt_fim_exerc", "fiscal_quarter", "cd_conta", "ds_conta", "vl_conta"]
    return (tables.dre.filter(income_lines).select(*cols, F.lit("dre").alias("line"))
            .unionByName(tables.dva.filter(F.col("ds_conta") == D_A_LABEL).select(*cols, F.lit("dva").alias("line"))))


def ebitda(tables: Tables, quarter=True, ytd=True, ttm=True, start_period="all",
           group: str = "consolidated", companies: DataFrame | None = None) -> DataFrame:
    """EBIT minus D&A (D&A is negative in the value-added statement), on dates present in both.

    The EBIT label preference is decided on the joined rows, as the joined
    rows are what the source tool reads.
    """
    co = companies if companies is not None else companies_of(tables, group)
    lines = two_tables(tables, F.col("ds_conta").isin(*EBIT_LABELS))
    rows = statement_rows(lines, F.lit(True), co, start_period,
                          columns=("line", "fiscal_quarter", "cd_conta", "ds_conta", "vl_conta"), bucketed=tables.bucketed)
    both = F.struct(F.col("vl_conta"), F.col("cd_conta"))
    rows = lines_beside(rows, F.col("line") == "dre", da=(F.col("line") == "dva", both))
    rows = rows.select("*", F.col("vl_conta").alias("ytd_ebit"), F.col("da.vl_conta").alias("ytd_d_a"),
                       F.col("da.cd_conta").alias("_da_cd"))
    rows = prefer_label(rows, *EBIT_LABELS)
    w = company_window(["date", "cd_conta", "_da_cd"])
    fq = F.col("fiscal_quarter")
    rows = (rows.withColumn("_qe", quarter_value(F.col("ytd_ebit"), fq, w))
                .withColumn("_qd", quarter_value(F.col("ytd_d_a"), fq, w)))
    rows = rows.withColumn("_q", F.col("_qe") - F.col("_qd"))
    rows = rows.withColumn("_t", trailing_sum("_q", w))
    out = trim_to_begin(rows).select(
        *K, "date",
        (F.col("ytd_ebit") - F.col("ytd_d_a")).alias("ytd_ebitda"),
        not_annual(F.col("_q")).alias("quarter_ebitda"),
        not_annual(F.col("_t")).alias("ttm_ebitda"),
    )
    return _select(out, "ebitda", quarter, ytd, ttm)
