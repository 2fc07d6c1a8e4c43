"""Catalog tables: definitions, existence, bucketing, schema drift."""

import datetime as dt

import pytest
from conftest import NI, flow_row, qend, ticker_row
from pyspark.sql import functions as F

from fundlake.plans import balances, income, margins, statements, statistics
from fundlake.sources import tables as defined
from fundlake.sources.catalog import tables_from_frames

DEBT = "Empréstimos e Financiamentos"


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Tables bucketed by company, and the companies as plain Parquet."""
    root = str(tmp_path_factory.mktemp("bucketed"))
    dre, dva, dfc, bpa, bpp = [], [], [], [], []
    for k in range(30):
        c = f"C{k}"
        for q in (1, 2, 3, 4):
            dre += [flow_row(c, 2000, q, "3.01", "Receita", 100 * q + k), flow_row(c, 2000, q, "3.03", "Bruto", 40 * q),
                    flow_row(c, 2000, q, "3.05", income.EBIT_LABELS[0], 30 * q), flow_row(c, 2000, q, "3.09", NI, 10 * q + k)]
            dva.append(flow_row(c, 2000, q, "7.04.01", income.D_A_LABEL, -q))
            dfc.append(flow_row(c, 2000, q, "6.01", "Caixa", q))
            bpa += [(c, "Consolidado", qend(2000, q), "1", "Ativo Total", 500), (c, "Consolidado", qend(2000, q), "1.01", "Ativo Circulante", 70),
                    (c, "Consolidado", qend(2000, q), "1.01.01", "Caixa e Equivalentes de Caixa", 20 + q)]
            bpp += [(c, "Consolidado", qend(2000, q), "2.01", "Passivo Circulante", 35), (c, "Consolidado", qend(2000, q), "2.01.04", DEBT, 50),
                    (c, "Consolidado", qend(2000, q), "2.03", "Patrimônio Líquido", 200)]
    plain, out = {}, {}
    for name, rows in (("dre", dre), ("dva", dva), ("dfc", dfc), ("bpa", bpa), ("bpp", bpp)):
        definition = defined.DEFINITIONS[name]
        plain[name] = spark.createDataFrame(rows, definition.schema)
        defined.write_table(plain[name], f"{root}/{name}", definition, 8)
        out[name] = defined.open_table(spark, f"{root}/{name}", definition, 8)
    tickers = spark.createDataFrame([ticker_row(f"C{k}XX3", f"C{k}") for k in range(30)], defined.DEFINITIONS["tickers"].schema)
    prices = spark.createDataFrame([], defined.DEFINITIONS["prices"].schema).drop("year")
    spark.createDataFrame([(f"C{k}", "Consolidado", "Q", dt.date(2000, 12, 31)) for k in range(30)],
                          "cnpj string, grupo_dfp string, freq string, last_statement_date date").write.parquet(f"{root}/co")
    rest = {"tickers": tickers, "prices": prices}
    bucketed = tables_from_frames(**out, **rest, bucketed=True)
    return root, bucketed, tables_from_frames(**plain, **rest), spark.read.parquet(f"{root}/co")


MEASURES = {
    "net_income": income.net_income, "ebitda": income.ebitda, "gross_profit_margin": margins.gross_profit_margin,
    "net_profit_margin": margins.net_profit_margin, "ebitda_margin": margins.ebitda_margin, "roe": margins.roe, "roa": margins.roa,
    "cash_equi": balances.cash_equi, "net_debt": balances.net_debt, "debt_to_equity": balances.debt_to_equity,
    "financial_leverage": balances.financial_leverage, "current_ratio": balances.current_ratio,
    "income_statement": statements.income_statement, "balance_sheet": statements.balance_sheet,
}


@pytest.mark.parametrize("name", MEASURES)
def test_bucketed_tables_need_no_exchange(stored, name):
    _, bucketed, plain, co = stored
    df = MEASURES[name](bucketed, companies=co)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in plan and "Exchange hashpartitioning" not in plan
    order = [c for c in df.columns]
    assert sorted(map(tuple, df.select(order).collect()), key=repr) == sorted(
        map(tuple, MEASURES[name](plain, companies=co).select(order).collect()), key=repr)


def test_all_lines_of_the_report_need_no_exchange(stored):
    _, bucketed, _, co = stored
    plan = statistics.report_days(bucketed, co, 5)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Bucketed: true") == 5 and "Exchange hashpartitioning" not in plan


def test_a_company_reads_one_bucket_of_its_group(stored, spark):
    root, bucketed, _, _ = stored
    one = bucketed.dre.filter((F.col("cnpj") == "C7") & (F.col("grupo_dfp") == "Consolidado"))
    plan = one.groupBy("cnpj").count()._jdf.queryExecution().executedPlan().toString()
    assert "SelectedBucketsCount: 1 out of 8" in plan and "PartitionFilters: [isnotnull(grupo_dfp" in plan
    assert one.count() == 16


def test_a_new_catalog_defines_the_table_again(stored, spark):
    root, bucketed, _, _ = stored
    path, definition = f"{root}/dre", defined.DEFINITIONS["dre"]
    assert defined.exists(spark, path) and not defined.exists(spark, f"{root}/nothing")
    rows = bucketed.dre.count()
    spark.sql(f"DROP TABLE {defined.name_of(path)}")  # the files stay
    assert not defined.exists(spark, path)
    again = defined.open_table(spark, path, definition, 8)
    assert again.count() == rows and again.schema.fieldNames() == definition.schema.fieldNames()
    assert [f.dataType for f in again.schema] == [f.dataType for f in definition.schema]


def test_schema_drift_is_refused_before_anything_is_written(stored, spark):
    root, bucketed, plain, _ = stored
    path, definition = f"{root}/dre", defined.DEFINITIONS["dre"]
    rows = bucketed.dre.count()
    for df, fault in ((plain.dre.drop("vl_conta"), "vl_conta is missing"), (plain.dre.withColumn("moeda", F.lit("BRL")), "moeda is unknown"),
                      (plain.dre.withColumn("vl_conta", F.col("vl_conta").cast("string")), "vl_conta is string, not bigint"),
                      (plain.dre.withColumn("fiscal_quarter", F.lit(1).cast("bigint")), "fiscal_quarter is bigint, not int")):
        with pytest.raises(defined.SchemaDrift, match=fault):
            defined.write_table(df, path, definition, 8)
    spark.catalog.refreshTable(defined.name_of(path))
    assert defined.open_table(spark, path, definition, 8).count() == rows
    narrow = plain.dre.withColumn("vl_conta", F.col("vl_conta").cast("int"))  # a narrower number fits
    assert defined.conformed(narrow, definition.schema).schema["vl_conta"].dataType.simpleString() == "bigint"


def test_writing_again_replaces_the_rows(spark, tmp_path):
    definition = defined.DEFINITIONS["bpa"]
    rows = [(f"C{k}", g, dt.date(2000, 3, 31), "1", "Ativo Total", k) for k in range(20) for g in ("Consolidado", "Individual")]
    path = f"{tmp_path}/bpa"
    defined.write_table(spark.createDataFrame(rows, definition.schema), path, definition, 8)
    defined.write_table(spark.createDataFrame(rows[:5], definition.schema), path, definition, 8)
    assert sorted(map(tuple, defined.open_table(spark, path, definition, 8).collect())) == sorted(rows[:5])


def test_buckets_follow_the_input():
    assert defined.buckets_for(0) == 8 and defined.buckets_for(100 << 40) == 1 << 16
    assert defined.buckets_for(64 << 30) == 1024
