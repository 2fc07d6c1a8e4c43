"""Window operators over year-to-date statement series.

Flows in the income, value-added and cash-flow statements are reported
year to date.  The quarter value is the difference to the previous report
(``lag``), reset to the reported value in the first fiscal quarter; the
trailing-twelve-month value is the sum of the last four quarter values and
exists only when all four are present.  Frames are row based, as in the
source tool, so a missing quarter shifts their meaning.

Every window here is partitioned by company and group and ordered by date,
so one hash exchange on ``(cnpj, grupo_dfp)`` serves all of them.  The rows
of one window partition are the reports of one company (about four a
year), so a partition stays small however large the table grows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fundlake.functions.periods import begin_column

K = ["cnpj", "grupo_dfp"]


def company_window(order: list[str] | None = None, keys: list[str] | None = None):
    return Window.partitionBy(*(keys or K)).orderBy(*(order or ["date"]))


def quarter_value(ytd: Column, fiscal_quarter: Column, w) -> Column:
    """W1 + W3: ``ytd - lag(ytd)``; the reported value itself in fiscal quarter 1."""
    return F.when(fiscal_quarter == 1, ytd).otherwise(ytd - F.lag(ytd).over(w))


def trailing_sum(value: str, w, periods: int = 4) -> Column:
    """Sum of the last ``periods`` rows, only when all of them are non-null."""
    frame = w.rowsBetween(-(periods - 1), Window.currentRow)
    return F.when(F.count(value).over(frame) == periods, F.sum(value).over(frame))


def prefer_label(df: DataFrame, preferred: str, fallback: str, label: str = "ds_conta",
                 keys: list[str] | None = None) -> DataFrame:
    """Keep rows of ``preferred`` when the company has any, else rows of ``fallback``."""
    has = F.max((F.col(label) == preferred).cast("int")).over(Window.partitionBy(*(keys or K)))
    return (df.withColumn("_has_pref", has)
              .filter(F.when(F.col("_has_pref") == 1, F.col(label) == preferred)
                      .otherwise(F.col(label) == fallback))
              .drop("_has_pref"))


def statement_rows(source: DataFrame, predicate: Column, companies: DataFrame, start_period,
                   lookback_months: int = 12, columns: tuple[str, ...] = (),
                   partition_keys: list[str] | None = None, bucketed: bool = False) -> DataFrame:
    """Rows of one statement table for the companies in scope, from begin - look-back.

    The predicate is applied first so it reaches the Parquet scan; the
    companies (a small dimension, broadcast when its measured size allows)
    and the look-back filter come next, and only the remaining rows are
    hash partitioned on the company key, which every later join and window
    of the measure reuses.
    """
    cols = ["cnpj", "grupo_dfp", F.col("dt_fim_exerc").alias("date"), *columns]
    rows = source.filter(predicate).select(*cols)
    co = companies.select(*K, "freq", begin_column(start_period).alias("begin"))
    rows = rows.join(co, K).filter(F.col("date") >= F.add_months(F.col("begin"), -lookback_months))
    return rows if bucketed else rows.repartition(*(partition_keys or K))


def lines_beside(rows: DataFrame, keep: Column, **others: tuple[Column, Column]) -> DataFrame:
    """Put other lines of the same company and date beside the rows that ``keep`` holds.

    Each of ``others`` is name=(condition, value): the rows meeting the
    condition give their value.  The result is that of an inner join on
    company, group and date, repeated lines included, but made by a window
    inside the partitioning on the company key that the rows already have.
    """
    day = Window.partitionBy(*K, "date")
    for name, (cond, value) in others.items():
        rows = rows.withColumn(f"_{name}s", F.collect_list(F.when(cond, F.struct(value.alias("v")))).over(day))
    rows = rows.filter(keep)
    for name in others:
        rows = rows.withColumn(f"_{name}s", F.explode(f"_{name}s")).withColumn(name, F.col(f"_{name}s.v")).drop(f"_{name}s")
    return rows


def trim_to_begin(df: DataFrame, lookback_months: int = 12) -> DataFrame:
    """Drop the look-back rows again once the windows are computed."""
    start = F.add_months(F.add_months(F.col("begin"), -lookback_months), lookback_months)
    return df.filter(F.col("date") >= start)


def not_annual(value: Column) -> Column:
    """Quarter and ttm values do not exist for annual-only reporters."""
    return F.when(F.col("freq") != "A", value)
