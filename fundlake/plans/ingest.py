"""Ingest queries over the landed stand-in files.

The landed files are rendered from the stored tables once (see
``fundlake.sources.landing``); every query here parses them back with the
library's readers, so its work grows with the tables.  Queries that write
(sinks, loads) write under the stored tables' folder in the shared
checkpoint location.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fundlake.plans import income, lake
from fundlake.plans.loads import STATEMENT_KINDS, price_load, statement_load
from fundlake.sources import quarantine, sinks
from fundlake.sources.catalog import Tables
from fundlake.sources.landing import HOLIDAYS, LANDED, stored_prices, write_landing
from fundlake.sources.prices_file import (filter_counts, instrument_kept, instrument_records, instrument_reject, landed_days,
                                          merge_shares, quote_kept, quote_records, quote_reject, read_instrument_files,
                                          read_instrument_xml, read_quote_files)
from fundlake.sources.statements_csv import archives_of, file_name_fields, landed_files, load_statement


def landing(tables: Tables, *names: str) -> dict[str, str]:
    """The folders of the landed inputs, the named ones (all without a name) rendered if they are not there.

    A folder of statements may be named whole, or one statement in it (``statements/dre``)."""
    wanted = tuple(n for n in LANDED if not names or n in names or n.split("/")[0] in names)
    return write_landing(tables, f"{tables.root}/_landing", wanted)


def spark_of(tables: Tables):
    return tables.tickers.sparkSession


def quotes(tables: Tables) -> DataFrame:
    return read_quote_files(spark_of(tables), landing(tables, "quotes")["quotes"])


def instruments(tables: Tables) -> DataFrame:
    return read_instrument_files(spark_of(tables), landing(tables, "instruments")["instruments"])


def merged_quotes(tables: Tables) -> DataFrame:
    return merge_shares(quotes(tables), instruments(tables))


def statement(tables: Tables, kind: str) -> DataFrame:
    return load_statement(spark_of(tables), landing(tables, f"statements/{kind}")["statements"], kind, tables.tickers)


def file_fields(tables: Tables) -> DataFrame:
    """A6 over every landed statement file."""
    spark = spark_of(tables)
    root = landing(tables, "statements")["statements"]
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
             .option("pathGlobFilter", "*.csv*").load(root).select("path"))
    meta = file_name_fields(F.col("path"))
    name = F.regexp_extract("path", r"((?:itr|dfp)_cia_aberta_[A-Za-z_]+_(?:con|ind)_\d{4}\.csv)", 1)
    return (files.select(name.alias("file_name"), *[c.alias(k) for k, c in meta.items()])
            .filter(F.col("statement").isNotNull()).distinct())


def _holidays(tables: Tables) -> DataFrame:
    return spark_of(tables).createDataFrame([(d,) for d in HOLIDAYS], "date date")


def _today(tables: Tables) -> _dt.date:
    """'Today' of the scenario: the newest day whose quotes have landed, from the names of the day folders."""
    return max(landed_days(spark_of(tables), landing(tables, "quotes_by_day")["quotes_by_day"]))


def missing_price_dates(tables: Tables) -> DataFrame:
    from fundlake.operators.calendar import expected_days
    return expected_days(stored_prices(tables).select("date"), _holidays(tables), _today(tables))


def price_load_table(tables: Tables) -> DataFrame:
    """The lake's price table after the days that were due were loaded."""
    spark = spark_of(tables)
    root = new_lake(tables)
    load_prices(tables, root)
    return lake.prices(spark, root).drop("year")


def new_lake(tables: Tables) -> str:
    return f"{tables.root}/_loads/lake_{uuid.uuid4().hex}"


def load_prices(tables: Tables, root: str) -> None:
    """The prices stored until now as the first batch (A7), then the days since."""
    land = landing(tables, "quotes_by_day", "instruments_by_day")
    lake.write_batch(stored_prices(tables), root, "seed")
    price_load(spark_of(tables), land["quotes_by_day"], land["instruments_by_day"], root, _holidays(tables), _today(tables))


def early_archives():
    """The archives that have landed when the first statement load runs: those of years before 1998."""
    return F.regexp_extract("file_name", r"(\d{4})$", 1).cast("int") < 1998


def side_by_side(tables: Tables, root: str) -> DataFrame:
    """The loaded rows of all six statements."""
    out = None
    for kind in STATEMENT_KINDS:
        part = lake.statements(spark_of(tables), root, kind).select(
            F.lit(kind).alias("kind"), "cnpj", "dt_refer", "grupo_dfp", "itr_dfp", "dt_fim_exerc", "cd_conta", "ds_conta", "vl_conta")
        out = part if out is None else out.unionByName(part)
    return out


def statement_load_table(tables: Tables) -> DataFrame:
    """P2 in two runs: the second one finds the registry of the first and loads only the archives landed since."""
    spark, root, land = spark_of(tables), new_lake(tables), landing(tables, "statements")["statements"]
    statement_load(spark, land, root, tables.tickers, early_archives())
    statement_load(spark, land, root, tables.tickers)
    return side_by_side(tables, root)


_LAKES: dict[tuple[str, str], str] = {}


def loaded_lake(tables: Tables) -> str:
    """A lake after a sequence of loads, made once per session: early archives, the net income stored, later archives,
    restated archives, the net income refreshed; seeded prices and the days due."""
    spark = spark_of(tables)
    key = (spark.sparkContext.applicationId, tables.root)
    if key not in _LAKES:
        root = new_lake(tables)
        land = landing(tables, "statements", "statements_restated", "quotes_by_day", "instruments_by_day")
        with ThreadPoolExecutor(1) as pool:  # the prices are loaded beside the first statements: neither reads the other
            priced = pool.submit(load_prices, tables, root)
            statement_load(spark, land["statements"], root, tables.tickers, early_archives())
            priced.result()
        refreshed_net_income(tables, root)
        for path in (land["statements"], land["statements_restated"]):
            statement_load(spark, path, root, tables.tickers)
            refreshed_net_income(tables, root)
        _LAKES[key] = root
    return _LAKES[key]


def lake_tables(tables: Tables) -> Tables:
    return lake.tables(spark_of(tables), loaded_lake(tables), tables.tickers)


def refreshed_net_income(tables: Tables, root: str | None = None) -> DataFrame:
    """Net income as stored in the lake, computed again only for the companies of each load."""
    spark, root = spark_of(tables), root or loaded_lake(tables)
    return lake.refresh(spark, root, "net_income", income.net_income, lake.tables(spark, root, tables.tickers))


def registry_after_load(tables: Tables) -> DataFrame:
    """The newest generation of the lake's registry."""
    return lake.registry(spark_of(tables), loaded_lake(tables)).select("file_name")


def pending_archives(tables: Tables) -> DataFrame:
    """A12 on the real listing: what a second run has to load after the first."""
    spark, root, land = spark_of(tables), new_lake(tables), landing(tables, "statements")["statements"]
    statement_load(spark, land, root, tables.tickers, early_archives())
    return sinks.changed_files(archives_of(landed_files(spark, land)), lake.registry(spark, root)).select("file_name")


def rejected_records(tables: Tables) -> DataFrame:
    """Refused records of all landed files by source, statement file (none for quotes and instruments) and reason."""
    spark, land = spark_of(tables), landing(tables, "quotes", "instruments", "statements")
    rows = (quarantine.quote_rejects(spark, land["quotes"]).unionByName(quarantine.instrument_rejects(spark, land["instruments"]))
            .unionByName(quarantine.statement_rejects(spark, land["statements"])))
    by_path = quarantine.counted(rows)  # file names are matched after the count: once per path and reason, not per record
    meta = file_name_fields(F.col("path"))
    file = F.concat_ws("_", meta["itr_dfp"], F.upper(meta["statement"]), meta["con_ind"], meta["dt_refer"].cast("string"))
    return (by_path.groupBy("source", F.when(meta["statement"].isNotNull(), file).alias("file"), "reason")
            .agg(F.sum("n_records").alias("n_records")))


def price_filters(tables: Tables) -> DataFrame:
    """Landed quote records by the fields the filters look at, and whether they are kept."""
    lines = spark_of(tables).read.option("recursiveFileLookup", "true").text(landing(tables, "quotes")["quotes"])
    return filter_counts(quote_records(lines.filter(quote_reject().isNull())), quote_kept(), ["tpmerc", "codbdi", "especi"])


def share_filters(tables: Tables) -> DataFrame:
    """Landed equity instruments by the fields the filters look at, and whether they are kept."""
    found = read_instrument_xml(spark_of(tables), landing(tables, "instruments")["instruments"])
    rows = instrument_records(found.filter(instrument_reject().isNull()))
    return filter_counts(rows, instrument_kept(), ["mkt", "sctyctgy", "spcfctncd"])


def seed_prices(tables: Tables) -> DataFrame:
    """A7 + A9: an empty price table is seeded from a CSV export."""
    spark = spark_of(tables)
    root = f"{tables.root}/_loads"
    seed_csv = f"{root}/prices_seed_csv"
    if sinks.table_is_empty(spark, f"{root}/prices_seed_csv_done"):
        tables.prices.write.mode("overwrite").option("header", "true").csv(seed_csv)
        spark.range(1).write.mode("overwrite").parquet(f"{root}/prices_seed_csv_done")
    schema = T.StructType([T.StructField("date", T.DateType()), T.StructField("ticker", T.StringType()),
                           T.StructField("preult", T.DoubleType()), T.StructField("totneg", T.LongType()),
                           T.StructField("quatot", T.LongType()), T.StructField("number_shares", T.LongType())])
    seed = spark.read.option("header", "true").schema(schema).csv(seed_csv)
    sinks.seed_if_empty(spark, f"{root}/prices_seeded", seed)
    return spark.read.parquet(f"{root}/prices_seeded")


def reload_tickers(tables: Tables) -> DataFrame:
    """The register is truncated and loaded from a CSV export."""
    spark = spark_of(tables)
    root = f"{tables.root}/_loads"
    tables.tickers.write.mode("overwrite").option("header", "true").csv(f"{root}/tickers_csv")
    schema = T.StructType([T.StructField(c, T.StringType()) for c in tables.tickers.columns])
    sinks.overwrite(spark.read.option("header", "true").schema(schema).csv(f"{root}/tickers_csv"),
                    f"{root}/tickers_table")
    return spark.read.parquet(f"{root}/tickers_table")


def replace_slice(tables: Tables) -> DataFrame:
    """A10: load all income-statement slices, then restated annual slices replace theirs.

    The restatement adds 1 to every value and no longer reports account 3.02.
    """
    spark = spark_of(tables)
    path = f"{tables.root}/_loads/dre_slices"
    rows = statement(tables, "dre")
    sinks.replace_slices(rows, path)
    restated = (rows.filter((F.col("itr_dfp") == "dfp") & (F.col("cd_conta") != "3.02"))
                .withColumn("vl_conta", F.col("vl_conta") + 1))
    sinks.replace_slices(restated, path)
    out = spark.read.parquet(path)
    return out.select(*rows.columns)


def archive_listing(supplier: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Stand-in archive listing and registry derived from ``supplier`` (test input).

    Listed: one archive per supplier (odd keys quarterly, even annual) with
    a modification time from its key; names that match no archive pattern
    (every ninth key) are not archives and are dropped from the listing.
    Registered: the even keys, every fourth one with an older date.
    """
    k = F.col("s_suppkey")
    kind = F.when(k % 2 == 1, F.lit("itr")).otherwise(F.lit("dfp"))
    name = F.when(k % 9 == 0, F.concat(F.lit("readme_"), k.cast("string"))).otherwise(
        F.concat(kind, F.lit("_cia_aberta_"), F.lpad(k.cast("string"), 6, "0")))
    ts = F.make_timestamp_ntz(F.lit(2001), F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0)) \
        + F.make_interval(hours=k.cast("int"))
    listed = supplier.select(name.alias("file_name"), ts.alias("url_date"))
    listed = listed.filter(F.col("file_name").rlike(r"^(itr|dfp)_cia_aberta_\d+$"))
    older = F.when(k % 4 == 0, ts - F.make_interval(days=F.lit(1))).otherwise(ts)
    registered = supplier.filter(k % 2 == 0).select(name.alias("file_name"), older.alias("last_modified"))
    return listed, registered


def stream_quote_load(tables: Tables) -> DataFrame:
    """The streaming incremental load over the landed quote files; returns the price table.

    A second run finds no new files and leaves the table as it is.
    """
    from fundlake.streaming.quotes import load_new_quotes
    spark = spark_of(tables)
    root = f"{tables.root}/_stream"
    load_new_quotes(spark, landing(tables, "quotes")["quotes"], instruments(tables), f"{root}/prices", f"{root}/checkpoint")
    return spark.read.parquet(f"{root}/prices")
