"""Statements with period-over-period change.

``statement_long`` is the statement builder in long form: one row per
company, group, account and report date with the value types and their
percentage changes:

* ``<v>_pct_change`` for every value type is the change against the
  previous report of the same account (row order within the account);
  for ``ytd`` it is the change against the same date one year earlier
  (a window frame of the month twelve months back), as year-to-date values are
  only comparable with the same period of the previous year;
* changes are computed on the rows from the start date only, so the first
  row of each account has no previous value;
* rows of one account whose descriptions differ on one date are added up,
  missing values count as 0, and the account keeps its first description
  in code-point order.  Quarter and ttm columns stay NULL for annual-only
  reporters, where the source tool has no such columns.

A zero previous value gives NULL and so 0 (the source tool gives inf).

``statement_wide`` pivots the long form to accounts x (date, value type)
for a known list of dates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fundlake.operators.flows import K, company_window, not_annual, quarter_value, statement_rows, trailing_sum, trim_to_begin
from fundlake.plans.scope import companies as companies_of
from fundlake.sources.catalog import Tables

ACCOUNT = [*K, "cd_conta"]


def _pct(v: str, prev) -> F.Column:
    return (F.try_divide(F.col(v).cast("double"), prev) - F.lit(1).cast("double")) * F.lit(100).cast("double")


def _finish(rows: DataFrame, value_types: list[str], annual_null: tuple[str, ...] = ()) -> DataFrame:
    """% changes (W5, J12), merge of duplicate descriptions."""
    w = Window.partitionBy(*ACCOUNT).orderBy("date", "ds_conta")
    for v in value_types:
        if v == "ytd":
            continue
        rows = rows.withColumn(f"{v}_pct_change", _pct(v, F.lag(v).over(w)))
    if "ytd" in value_types:
        month = F.year("date") * 12 + F.month("date")
        year_ago = Window.partitionBy(*ACCOUNT).orderBy(month).rangeBetween(-12, -12)
        rows = rows.withColumn("_ago", F.collect_list(F.struct("date", F.col("ytd").alias("v"))).over(year_ago))
        same = F.filter("_ago", lambda x: (F.add_months(x["date"], 12) == F.col("date")) & x["v"].isNotNull())
        kind = "double" if rows.schema["ytd"].dataType.typeName() == "double" else "long"
        before = F.when(F.size(same) > 0, F.aggregate(same, F.lit(0).cast(kind), lambda a, x: a + x["v"].cast(kind)))
        rows = rows.withColumn("ytd_pct_change", _pct("ytd", before)).drop("_ago")
    cols = []
    for v in value_types:
        cols += [v, f"{v}_pct_change"]
    first_desc = F.min("ds_conta").over(Window.partitionBy(*ACCOUNT))
    rows = rows.withColumn("_ds", first_desc)
    agg = rows.groupBy(*ACCOUNT, "date").agg(
        F.first("_ds").alias("ds_conta"), F.first("freq").alias("_freq"),
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in cols])
    out = []
    for c in cols:
        col = F.col(c)
        if c.split("_pct_change")[0] in annual_null:
            col = F.when(F.col("_freq") != "A", col)
        out.append(col.alias(c))
    return agg.select(*ACCOUNT, "ds_conta", "date", *out)


def account_flows(tables: Tables, table: str, start_period="all", group="consolidated",
                  companies=None) -> DataFrame:
    """W1-W4 per account: ytd, quarter and ttm values, NULL quarter/ttm for annual-only reporters.

    Rows are partitioned by (company, group, account): the windows need no
    more, and a company with many accounts is spread over many tasks.
    """
    co = companies if companies is not None else companies_of(tables, group)
    rows = statement_rows(tables.get(table), F.lit(True), co, start_period,
                          columns=("fiscal_quarter", "cd_conta", "ds_conta", F.col("vl_conta").alias("ytd")),
                          partition_keys=ACCOUNT, bucketed=tables.bucketed)
    w = company_window(["date", "ds_conta"], keys=ACCOUNT)
    rows = rows.withColumn("quarter_value", not_annual(quarter_value(F.col("ytd"), F.col("fiscal_quarter"), w)))
    rows = rows.withColumn("ttm_value", not_annual(trailing_sum("quarter_value", w)))
    return trim_to_begin(rows)


def flow_statement(tables: Tables, table: str, quarter=True, ytd=True, ttm=True, start_period="all",
                   group="consolidated", companies=None) -> DataFrame:
    """Income or cash-flow statement: ytd, quarter and ttm per account (W2-W4) + changes."""
    rows = account_flows(tables, table, start_period, group, companies)
    types = [t for t, on in (("ytd", ytd), ("quarter_value", quarter), ("ttm_value", ttm)) if on]
    return _finish(rows.select(*ACCOUNT, "ds_conta", "date", "freq", *types), types,
                   annual_null=("quarter_value", "ttm_value"))


def income_statement(tables: Tables, **kw) -> DataFrame:
    return flow_statement(tables, "dre", **kw)


def cash_flow(tables: Tables, **kw) -> DataFrame:
    return flow_statement(tables, "dfc", **kw)


def balance_sheet(tables: Tables, start_period="all", group="consolidated", companies=None) -> DataFrame:
    """Assets and liabilities together (U1), value ``vl_conta`` + change to the previous report."""
    co = companies if companies is not None else companies_of(tables, group)
    both = (tables.bpa.select(*K, "dt_fim_exerc", "cd_conta", "ds_conta", "vl_conta")
            .unionByName(tables.bpp.select(*K, "dt_fim_exerc", "cd_conta", "ds_conta", "vl_conta")))
    rows = statement_rows(both, F.lit(True), co, start_period, lookback_months=0,
                          columns=("cd_conta", "ds_conta", "vl_conta"), partition_keys=ACCOUNT, bucketed=tables.bucketed)
    return _finish(rows.select(*ACCOUNT, "ds_conta", "date", "freq", "vl_conta"), ["vl_conta"])


def statement_wide(long_df: DataFrame, dates: list, value_types: list[str]) -> DataFrame:
    """Accounts x (date, value type), for the given report dates (newest first)."""
    melted = long_df.select(*ACCOUNT, "ds_conta", "date",
                            F.explode(F.array(*[F.struct(F.lit(v).alias("value"), F.col(v).cast("double").alias("x"))
                                                for v in value_types])).alias("_v"))
    melted = melted.select(*ACCOUNT, "ds_conta",
                           F.concat_ws(" ", F.col("date").cast("string"), F.col("_v.value")).alias("_col"),
                           F.col("_v.x").alias("x"))
    labels = [f"{d} {v}" for d in sorted(dates, reverse=True) for v in value_types]
    return (melted.groupBy(*ACCOUNT, "ds_conta").pivot("_col", labels).agg(F.sum("x"))
            .fillna(0.0, subset=labels))


def balance_sheet_wide(tables: Tables, start_period="all", group="consolidated") -> DataFrame:
    """M5 in the wide layout: accounts x (report date, value) with NULL as 0.

    The list of report dates (bounded by the calendar, about four a year) is
    read on the driver to name the columns.
    """
    bs = balance_sheet(tables, start_period, group)
    dates = [r[0] for r in bs.select("date").distinct().collect()]
    return statement_wide(bs, dates, ["vl_conta", "vl_conta_pct_change"])
