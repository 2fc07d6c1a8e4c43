"""What a query stores: the tables and landed inputs it reads and no others, without an exchange of the wide rows."""

import datetime as dt
import os
import threading

import pytest
from pyspark.sql import functions as F

from fundlake.plans import ingest
from fundlake.sources import fixtures, landing
from fundlake.sources.catalog import load_tables, tables_from_frames


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Input tables of three suppliers, one row without a supplier and one without an amount."""
    root = str(tmp_path_factory.mktemp("input"))
    days = [dt.datetime(1996, 1, 15) + dt.timedelta(days=29 * i) for i in range(72)]
    lines = [(k, day, 100.0 + 7 * k + i, 0.05, 0.02, 3.0 + i) for k in (1, 2, 9) for i, day in enumerate(days)]
    lines += [(2, days[0], 99.0, 0.1, 0.0, 5.0), (None, days[1], 50.0, 0.1, 0.0, 1.0), (1, days[2], 10.0, 0.1, 0.0, None)]
    tables = {
        "lineitem": (lines, "l_suppkey bigint, l_shipdate timestamp_ntz, l_extendedprice double, l_discount double, l_tax double, "
                            "l_quantity double"),
        "supplier": ([(k, f"Supplier {k}", 1) for k in (1, 2, 9)], "s_suppkey bigint, s_name string, s_nationkey int"),
        "nation": ([(1, "BRAZIL", 1)], "n_nationkey int, n_name string, n_regionkey int"),
        "region": ([(1, "AMERICA")], "r_regionkey int, r_name string"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{root}/{name}.parquet")
    return root


def stored(root):
    return {f for f in os.listdir(root) if not f.startswith(("_", "."))}


def test_a_query_stores_only_the_tables_it_reads(spark, folder, tmp_path):
    root = str(tmp_path)
    t = load_tables(spark, folder, root=root)
    assert stored(root) == set()
    assert t.tickers.count() == 4 and stored(root) == {"tickers"}
    assert t.dva.count() > 0 and stored(root) == {"tickers", "dva"}
    plain = load_tables(spark, folder, materialize=False)
    for name in fixtures.NAMES:
        assert sorted(map(repr, t.get(name).collect())) == sorted(map(repr, plain.get(name).select(*t.get(name).columns).collect()))


def test_only_the_named_inputs_are_landed_and_packed(spark, folder, tmp_path):
    t = load_tables(spark, folder, root=str(tmp_path))
    assert ingest.statement(t, "dva").count() > 0
    files = [os.path.join(d, f) for d, _, fs in os.walk(f"{tmp_path}/_landing") for f in fs if not f.startswith((".", "_"))]
    files = [f for f in files if "/_landed/" not in f]
    assert files and all("_DVA_" in f and f.endswith(".csv.gz") for f in files)
    assert ingest.statement(t, "bpa").count() > 0  # another statement in the same folder leaves the first alone
    assert ingest.statement(t, "dva").count() == t.dva.count()
    assert stored(f"{tmp_path}/_landing") == {"statements"}


def test_statement_rows_are_not_exchanged(spark, folder):
    """The only exchange above the totals per quarter is of those, not of the rows made from them."""
    cum = fixtures.cumulative_totals(spark, folder).localCheckpoint()
    plan = fixtures.derive(spark, folder, "dre", cum, 8)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.index("Generate") < plan.index("Exchange")
    days = fixtures.derive(spark, folder, "prices")._jdf.queryExecution().executedPlan().toString()
    assert days.count("Exchange") == 1


def test_files_are_dealt_before_they_are_rendered(spark, folder):
    dre = load_tables(spark, folder, materialize=False).dre.localCheckpoint()
    plan = landing.statement_rows(landing.dealt_by_file(dre), "dmpl")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.rindex("Generate") < plan.index("Exchange")


def test_large_files_land_in_parts(spark, folder, monkeypatch, tmp_path):
    dre = load_tables(spark, folder, materialize=False).dre
    monkeypatch.setattr(landing, "ROWS_PER_PART", 50)
    rows = landing.statement_rows(landing.dealt_by_file(dre), "dre")
    landing._write_csv(rows, str(tmp_path))
    parts = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(str(tmp_path)).select(
        F.regexp_extract("path", "_file=([^/]*)/", 1).alias("file"))
    assert parts.groupBy("file").count().agg(F.max("count")).first()[0] > 1
    assert spark.read.option("header", "true").option("sep", ";").csv(str(tmp_path)).count() == rows.count()


def test_quote_lines_read_the_prices_twice(spark, folder):
    """Once for all lines, read and refused, and once for the days."""
    lines = landing.quote_lines(load_tables(spark, folder, materialize=False).prices.localCheckpoint())
    assert lines._jdf.queryExecution().executedPlan().toString().count("Scan ExistingRDD") == 2
    kinds = {r[0] for r in lines.select(F.substring("value", 1, 2)).distinct().collect()}
    assert {"00", "01", "99"} <= kinds


def test_parts_of_prices_follow_the_input(spark, folder, monkeypatch, tmp_path):
    """More input bytes, more tasks: a task's rows do not grow with the table."""
    from fundlake.sources import catalog

    plain = load_tables(spark, folder, materialize=False).prices
    monkeypatch.setattr(catalog, "PART_BYTES", 2_000)
    t = load_tables(spark, folder, root=str(tmp_path))
    parts = spark.read.parquet(f"{tmp_path}/_manifest").first()["parts"]
    assert parts > 1 and t.parts == max(8, parts)
    assert fixtures.derive_prices(spark, folder, parts).rdd.getNumPartitions() == 8 * parts
    assert sorted(map(repr, t.prices.collect())) == sorted(map(repr, plain.select(*t.prices.columns).collect()))


def test_buckets_follow_the_input(spark, folder, monkeypatch, tmp_path):
    """A bucket holds about 16 MB of input, in powers of two."""
    from fundlake.sources import catalog

    monkeypatch.setattr(catalog, "_input_state", lambda *_: ("x", 291 << 20))
    load_tables(spark, folder, root=str(tmp_path))
    assert spark.read.parquet(f"{tmp_path}/_manifest").first()["buckets"] == 32


def test_inputs_are_rendered_side_by_side(spark, folder, monkeypatch, tmp_path):
    """The renderings of two inputs wait for each other: one after the other they would never end."""
    t, both = load_tables(spark, folder, root=str(tmp_path)), threading.Barrier(2)
    monkeypatch.setattr(landing, "_render", lambda *a: both.wait(60))
    landing.write_landing(t, f"{tmp_path}/land", ("statements/dva", "statements/bpa"))
    monkeypatch.setattr(landing, "_render", lambda *a: pytest.fail("rendered again"))
    landing.write_landing(t, f"{tmp_path}/land", ("statements/dva", "statements/bpa"))


def test_due_quotes_are_chosen_before_they_are_rendered(spark, monkeypatch):
    """No filter renders a line again; the lines are those of the days that landed, without headers and unreadable days."""
    day = dt.date(2001, 8, 14)
    rows = [(day + dt.timedelta(days=i - 80), f"S{i}3", None if i == 90 else 1.5 + i, 1, None if i == 95 else 29 * 31 * 37 * 19 * i, 5) for i in range(160)]
    rows.append((None, "S13", 1.0, 1, 1, 5))
    prices = spark.createDataFrame(rows, "date date, ticker string, preult double, totneg bigint, quatot bigint, number_shares bigint")
    written = []
    monkeypatch.setattr(landing, "_write_lines", lambda df, *a: written.append(df))
    landing._render(tables_from_frames(**{**{k: None for k in fixtures.STATEMENTS}, "prices": prices, "tickers": None}), "", "quotes_by_day")
    plan = written[0]._jdf.queryExecution().optimizedPlan().toString()
    assert not [x for x in plan.splitlines() if "Filter" in x and "lpad" in x]
    value, name = F.col("value"), F.substring("value", 3, 8)
    want = landing.quote_lines(prices).filter(
        (F.substring(value, 1, 2) == "01") & (name >= f"{landing.STORED_UNTIL:%Y%m%d}") & ~name.isin(*landing.LATE_DAYS)
        & F.try_to_date(name, "yyyyMMdd").isNotNull()).withColumn("dt", name)
    got = sorted(map(tuple, written[0].select("value", "dt").collect()))
    assert got == sorted(map(tuple, want.collect())) and len(got) > 300 and "20010815" not in {r[1] for r in got}
