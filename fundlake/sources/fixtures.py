"""Stand-in statement and price tables derived from the driver's TPC-H-ish tables.

The driver ships no financial statements, so the landed tables that the
engine works on (income ``dre``, value added ``dva``, cash flow ``dfc``,
assets ``bpa``, liabilities ``bpp``, daily ``prices`` and the ``tickers``
register) are derived from ``lineitem``, ``supplier``, ``nation`` and
``region``: every supplier is a company, every ship date a trading day.
This module only produces rows in the stored schemas; none of the engine's
measures run here.

The small fixed lists (two statement groups, a handful of accounts, two
share classes) are expanded with ``inline`` over a literal array, which is
a per-row generator rather than a join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Fixed values that the derivation must reproduce exactly.
STATEMENT_CUTOFF = "2001-10-01 00:00:00"
GROUPS = [("Consolidado", 2), ("Individual", 1)]
DRE_ACCOUNTS = [
    ("3.01", "Receita de Venda de Bens e/ou Serviços"),
    ("3.02", "Custo dos Bens e/ou Serviços Vendidos"),
    ("3.03", "Resultado Bruto"),
    ("3.05", "Resultado Antes do Resultado Financeiro e dos Tributos"),
    ("3.09", "Resultado Líquido das Operações Continuadas"),
    ("3.11", "Lucro/Prejuízo do Período"),
]
BPP_ACCOUNTS = [
    ("2", "Passivo Total", 20),
    ("2.01", "Passivo Circulante", 4),
    ("2.01.04", "Empréstimos e Financiamentos", 1),
    ("2.02.01", "Empréstimos e Financiamentos", 3),
    ("2.03", "Patrimônio Líquido Consolidado", 9),
]
BPA_ACCOUNTS = [
    ("1", "Ativo Total", 20),
    ("1.01", "Ativo Circulante", 7),
    ("1.01.01", "Caixa e Equivalentes de Caixa", 2),
    ("1.01.02", "Aplicações Financeiras", 1),
    ("1.02.01.03.01", "Aplicações Financeiras", 5),
]
DFC_ACCOUNTS = [
    ("6.01", "Caixa Líquido Atividades Operacionais"),
    ("6.02", "Caixa Líquido Atividades de Investimento"),
    ("6.03", "Caixa Líquido Atividades de Financiamento"),
]
DVA_ACCOUNT = ("7.04.01", "Depreciação, Amortização e Exaustão")
SHARE_CLASSES = [("3", "ON"), ("4", "PN")]
OTHER_EBIT_LABEL = "Resultado Operacional"


def _rows(*tuples_of_cols) -> Column:
    """A literal array of structs, expanded per input row by ``inline``."""
    return F.array(*[F.struct(*cols) for cols in tuples_of_cols])


def _groups() -> Column:
    return _rows(*[(F.lit(g).alias("grupo_dfp"), F.lit(m).alias("m")) for g, m in GROUPS])


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _cnpj(col: str = "suppkey") -> Column:
    return F.concat(F.lit("C"), F.col(col).cast("string"))


def quarterly_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per supplier and calendar quarter: revenue, cost, opex, tax, D&A (BIGINT)."""
    li = _read(spark, sf_dir, "lineitem").select(
        "l_suppkey", "l_shipdate", "l_extendedprice", "l_discount", "l_tax")
    t = li.filter(F.col("l_shipdate") < F.lit(STATEMENT_CUTOFF).cast("timestamp_ntz")).select(
        F.col("l_suppkey").alias("suppkey"),
        F.year("l_shipdate").alias("yr"),
        F.quarter("l_shipdate").alias("fq"),
        F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("ec"),
        F.round(F.col("l_discount") * 100).cast("bigint").alias("dp"),
        F.round(F.col("l_tax") * 100).cast("bigint").alias("tp"),
    )
    return t.groupBy("suppkey", "yr", "fq").agg(
        F.sum(F.col("ec") * (100 - F.col("dp"))).cast("bigint").alias("rev"),
        F.sum(F.col("ec") * 60).cast("bigint").alias("cost"),
        F.sum(F.col("ec") * 5).cast("bigint").alias("opex"),
        F.sum(F.col("ec") * F.col("tp")).cast("bigint").alias("tax"),
        F.sum(F.col("ec") * 3).cast("bigint").alias("da"),
    ).select(
        "suppkey", "yr", "fq",
        F.last_day(F.make_date(F.col("yr"), F.col("fq") * 3, F.lit(1))).alias("dt_fim_exerc"),
        F.make_date(F.col("yr"), F.lit(1), F.lit(1)).alias("dt_ini_exerc"),
        "rev", "cost", "opex", "tax", "da",
    )


def cumulative_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Year-to-date flows per supplier plus an all-time running ``stock``."""
    q = quarterly_totals(spark, sf_dir)
    run = (Window.unboundedPreceding, Window.currentRow)
    # The all-time window (by supplier) comes first: its hash partitioning
    # also serves the per-year window, so only one exchange is planned.
    all_time = Window.partitionBy("suppkey").orderBy("yr", "fq").rowsBetween(*run)
    ytd = Window.partitionBy("suppkey", "yr").orderBy("fq").rowsBetween(*run)
    q = q.withColumn("stock", F.sum("rev").over(all_time).cast("bigint"))
    return q.select(
        "suppkey", "yr", F.col("fq").cast("int").alias("fiscal_quarter"),
        "dt_ini_exerc", "dt_fim_exerc",
        *[F.sum(c).over(ytd).cast("bigint").alias(c) for c in ("rev", "cost", "opex", "tax", "da")],
        "stock",
    )


def _not_excluded(with_quarter: bool = True) -> Column:
    s = F.col("suppkey") % 10
    cond = ~((s == 9) & (F.col("grupo_dfp") == "Consolidado"))
    if with_quarter:
        cond = cond & ~((s == 8) & (F.col("fiscal_quarter") < 4))
    return cond


def derive_dre(cum: DataFrame) -> DataFrame:
    x = cum.select("*", F.inline(_groups()))
    x = x.select("*", F.inline(_rows(*[(F.lit(c).alias("cd_conta"), F.lit(d).alias("ds_conta0"))
                                        for c, d in DRE_ACCOUNTS])))
    cd = F.col("cd_conta")
    base = (F.when(cd == "3.01", F.col("rev"))
            .when(cd == "3.02", -F.col("cost"))
            .when(cd == "3.03", F.col("rev") - F.col("cost"))
            .when(cd == "3.05", F.col("rev") - F.col("cost") - F.col("opex"))
            .otherwise(F.col("rev") - F.col("cost") - F.col("opex") - F.col("tax")))
    ds = F.when((cd == "3.05") & (F.col("suppkey") % 10 == 7), F.lit(OTHER_EBIT_LABEL)).otherwise(F.col("ds_conta0"))
    x = x.filter(~((F.col("suppkey") % 10 == 3) & (cd == "3.09")) & _not_excluded())
    return x.select(_cnpj().alias("cnpj"), "grupo_dfp", "dt_ini_exerc", "dt_fim_exerc", "fiscal_quarter",
                    "cd_conta", ds.alias("ds_conta"), (base * F.col("m")).alias("vl_conta"))


def _balance(cum: DataFrame, accounts) -> DataFrame:
    x = cum.select("*", F.inline(_groups()))
    x = x.select("*", F.inline(_rows(*[(F.lit(c).alias("cd_conta"), F.lit(d).alias("ds_conta"), F.lit(w).alias("w"))
                                        for c, d, w in accounts])))
    x = x.filter(_not_excluded())
    return x.select(_cnpj().alias("cnpj"), "grupo_dfp", "dt_fim_exerc", "cd_conta", "ds_conta",
                    (F.col("stock") * F.col("w") * F.col("m")).alias("vl_conta"))


def derive_bpa(cum: DataFrame) -> DataFrame:
    return _balance(cum, BPA_ACCOUNTS)


def derive_bpp(cum: DataFrame) -> DataFrame:
    return _balance(cum, BPP_ACCOUNTS)


def derive_dva(cum: DataFrame) -> DataFrame:
    x = cum.select("*", F.inline(_groups())).filter(_not_excluded())
    return x.select(_cnpj().alias("cnpj"), "grupo_dfp", "dt_ini_exerc", "dt_fim_exerc", "fiscal_quarter",
                    F.lit(DVA_ACCOUNT[0]).alias("cd_conta"), F.lit(DVA_ACCOUNT[1]).alias("ds_conta"),
                    (-F.col("da") * F.col("m")).alias("vl_conta"))


def derive_dfc(cum: DataFrame) -> DataFrame:
    x = cum.select("*", F.inline(_groups()))
    x = x.select("*", F.inline(_rows(*[(F.lit(c).alias("cd_conta"), F.lit(d).alias("ds_conta"))
                                        for c, d in DFC_ACCOUNTS])))
    x = x.filter(_not_excluded())
    cd = F.col("cd_conta")
    base = (F.when(cd == "6.01", F.col("rev") - F.col("cost") - F.col("opex") - F.col("tax") + F.col("da"))
            .when(cd == "6.02", -F.col("da") * 2)
            .otherwise(-F.col("tax")))
    return x.select(_cnpj().alias("cnpj"), "grupo_dfp", "dt_ini_exerc", "dt_fim_exerc", "fiscal_quarter",
                    "cd_conta", "ds_conta", (base * F.col("m")).alias("vl_conta"))


def derive_prices(spark: SparkSession, sf_dir: str, parts: int = 1) -> DataFrame:
    """One price row per (ship date, supplier, share class): ON always, PN for even suppliers.

    Each year is dealt in ``parts`` by supplier."""
    date = F.col("l_shipdate").cast("date")
    li = _read(spark, sf_dir, "lineitem").select(
        date.alias("date"),
        F.year(date).alias("year"),
        F.col("l_suppkey").alias("suppkey"),
        F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("ec"),
        F.col("l_quantity").cast("bigint").alias("q"),
        F.pmod(F.xxhash64("l_suppkey"), F.lit(parts)).alias("part"),
    )
    # The one exchange is of the narrow source rows, by year and part of its suppliers: a supplier has at most 366 days
    # a year, so the daily rows stay where they are, to be written as the table of prices by year.  The number of tasks
    # follows the input (AQE would size them by the narrow rows, which grow when they are aggregated and sorted).
    day = li.repartition(8 * parts, "year", "part").groupBy("year", "part", "date", "suppkey").agg(
        F.max("ec").alias("mx"), F.min("ec").alias("mn"),
        F.count(F.lit(1)).alias("n"), F.sum("q").cast("bigint").alias("qt"))
    x = day.select("*", F.inline(_rows((F.lit("3").alias("sfx"),), (F.lit("4").alias("sfx"),))))
    x = x.filter((F.col("sfx") == "3") | (F.col("suppkey") % 2 == 0))
    return x.select(
        "date",
        F.concat(F.lit("S"), F.col("suppkey").cast("string"), F.col("sfx")).alias("ticker"),
        (F.when(F.col("sfx") == "3", F.col("mx")).otherwise(F.col("mn")).cast("double")
         / F.lit(100).cast("double")).alias("preult"),
        F.col("n").alias("totneg"),
        F.col("qt").alias("quatot"),
        (F.lit(1000000) + F.col("suppkey") * 1000 + F.col("year")).cast("bigint").alias("number_shares"),
        "year",
    )


def derive_tickers(spark: SparkSession, sf_dir: str) -> DataFrame:
    sup = _read(spark, sf_dir, "supplier")
    # nation (25 rows) and region (5 rows) have a fixed size in this schema.
    nat = F.broadcast(_read(spark, sf_dir, "nation"))
    reg = F.broadcast(_read(spark, sf_dir, "region"))
    x = sup.join(nat, sup.s_nationkey == nat.n_nationkey).join(reg, nat.n_regionkey == reg.r_regionkey)
    x = x.select("*", F.inline(_rows(*[(F.lit(s).alias("sfx"), F.lit(t).alias("type")) for s, t in SHARE_CLASSES])))
    x = x.filter((F.col("sfx") == "3") | (F.col("s_suppkey") % 2 == 0))
    return x.select(
        F.concat(F.lit("S"), F.col("s_suppkey").cast("string"), F.col("sfx")).alias("ticker"),
        _cnpj("s_suppkey").alias("cnpj"),
        "type",
        F.col("r_name").alias("sector"),
        F.col("n_name").alias("subsector"),
        F.concat(F.lit("SEG"), (F.col("s_suppkey") % 2).cast("string")).alias("segment"),
        F.col("s_name").alias("denom_social"),
        F.col("s_name").alias("denom_comerc"),
    )


STATEMENTS = {"dre": derive_dre, "dva": derive_dva, "dfc": derive_dfc, "bpa": derive_bpa, "bpp": derive_bpp}
NAMES = (*STATEMENTS, "prices", "tickers")


def derive(spark: SparkSession, sf_dir: str, name: str, cum: DataFrame | None = None, buckets: int | None = None,
           parts: int = 1) -> DataFrame:
    """One stand-in table; a statement from the totals per quarter, prices in ``parts`` per year.

    With ``buckets`` the few rows per company are dealt by company before they become statement rows, so the
    much larger statement is in its buckets without an exchange of its own.
    """
    if name == "prices":
        return derive_prices(spark, sf_dir, parts)
    if name == "tickers":
        return derive_tickers(spark, sf_dir)
    cum = cumulative_totals(spark, sf_dir) if cum is None else cum
    return STATEMENTS[name](cum if buckets is None else cum.repartition(buckets, _cnpj()))


def derive_all(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All stand-in tables, nothing stored."""
    out = {name: derive(spark, sf_dir, name) for name in NAMES}
    return {**out, "prices": out["prices"].drop("year")}
