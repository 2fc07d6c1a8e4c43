"""Who is analysed and how: the ``companies`` and ``scope`` tables.

A single-company object of a desktop tool becomes two small tables that
every measure joins to:

* ``companies``: one row per company (cnpj) with the statement group in
  use (``grupo_dfp``), the report frequency (``freq``, 'A' or 'Q') and the
  newest income-statement date (``last_statement_date``);
* ``scope``: one row per listed ticker with its register attributes, its
  company's ON and PN tickers, the company's group/frequency and the
  ticker's newest price date (``last_price_date``).

A ticker is in scope only when its company has an ON ticker ending in '3'.
The requested group is used when the company has income rows in it,
otherwise the company falls back to 'Individual'.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundlake.functions.frequency import frequency_table
from fundlake.sources.catalog import Tables, stored_or_build


def resolve_group(group: str) -> str:
    if group == "individual":
        return "Individual"
    if group in ("consolidated", "consolidado"):
        return "Consolidado"
    raise ValueError("group needs to be 'consolidated' or 'individual'.")


def share_classes(tables: Tables) -> DataFrame:
    """Per company: ON ticker (type ON, ending in '3') and PN ticker, if any.

    Stored next to the tables (and read back) when they are stored.
    """
    if tables.root is not None:
        return stored_or_build(tables.tickers.sparkSession, f"{tables.root}/_classes",
                               lambda: build_share_classes(tables))
    return build_share_classes(tables)


def build_share_classes(tables: Tables) -> DataFrame:
    t = tables.tickers
    return (t.groupBy("cnpj").agg(
        F.min(F.when((F.col("type") == "ON") & (F.substring("ticker", -1, 1) == "3"), F.col("ticker"))).alias("on_ticker"),
        F.min(F.when(F.col("type") == "PN", F.col("ticker"))).alias("pn_ticker"))
        .filter(F.col("on_ticker").isNotNull()))


def statement_dates(tables: Tables) -> DataFrame:
    """Distinct (cnpj, grupo_dfp, date) of the income statement (G2), as kept by the loads if there are any."""
    if tables.report_dates is not None:
        return tables.report_dates
    return tables.dre.select("cnpj", "grupo_dfp", F.col("dt_fim_exerc").alias("date")).distinct()


def frequency_classes(tables: Tables) -> DataFrame:
    """The frequency class of every company's reports in each group (G8) and of every ticker's trading days (H6)."""
    of_reports = frequency_table(statement_dates(tables), ["cnpj", "grupo_dfp"]).select(
        F.concat_ws(" ", "cnpj", "grupo_dfp").alias("series"), "n_dates", "frequency", "is_regular")
    days = tables.prices.select("ticker", "date").distinct()
    of_trading = frequency_table(days, ["ticker"]).select(F.col("ticker").alias("series"), "n_dates", "frequency", "is_regular")
    return of_reports.unionByName(of_trading)


def companies(tables: Tables, group: str = "consolidated") -> DataFrame:
    if tables.root is not None:
        return stored_or_build(tables.tickers.sparkSession, f"{tables.root}/_companies_{resolve_group(group)}",
                               lambda: build_companies(tables, group))
    return build_companies(tables, group)


def build_companies(tables: Tables, group: str = "consolidated") -> DataFrame:
    wanted = resolve_group(group)
    classes = share_classes(tables).select("cnpj")
    dates = statement_dates(tables)
    has_wanted = dates.filter(F.col("grupo_dfp") == wanted).select("cnpj").distinct().withColumn("_has", F.lit(True))
    chosen = (classes.join(has_wanted, "cnpj", "left")
              .select("cnpj", F.when(F.col("_has"), F.lit(wanted)).otherwise(F.lit("Individual")).alias("grupo_dfp")))
    freq = frequency_table(dates.join(chosen, ["cnpj", "grupo_dfp"], "left_semi"), ["cnpj", "grupo_dfp"])
    return (chosen.join(freq, ["cnpj", "grupo_dfp"], "left")
            .select("cnpj", "grupo_dfp",
                    F.coalesce(F.col("freq"), F.lit("Q")).alias("freq"),
                    F.col("last_date").alias("last_statement_date")))


def last_price_dates(tables: Tables) -> DataFrame:
    """Newest price date per ticker (G3), as kept by the loads if there are any."""
    if tables.price_ends is not None:
        return tables.price_ends
    return tables.prices.groupBy("ticker").agg(F.max("date").alias("last_price_date"))


def scope(tables: Tables, group: str = "consolidated") -> DataFrame:
    """The scope table; stored next to the tables (and read back) when they are stored."""
    if tables.root is not None:
        spark = tables.tickers.sparkSession
        return stored_or_build(spark, f"{tables.root}/_scope_{resolve_group(group)}",
                               lambda: build_scope(tables, group))
    return build_scope(tables, group)


def build_scope(tables: Tables, group: str = "consolidated") -> DataFrame:
    co = companies(tables, group)
    classes = share_classes(tables)
    t = tables.tickers.select("ticker", "cnpj", "type", "sector", "subsector", "segment", "denom_comerc")
    return (t.join(classes, "cnpj").join(co, "cnpj").join(last_price_dates(tables), "ticker", "left")
            .select("ticker", "cnpj", "type", "sector", "subsector", "segment", "denom_comerc",
                    "grupo_dfp", "freq", "on_ticker", "pn_ticker", "last_price_date", "last_statement_date"))


def scope_of(scope_df: DataFrame, ticker: str) -> DataFrame:
    """One ticker's row (upper-cased lookup); raises when the ticker is unknown."""
    one = scope_df.filter(F.col("ticker") == ticker.upper())
    if one.limit(1).count() == 0:
        raise ValueError(f"unknown ticker: {ticker}")
    return one
