"""Faults are raised, not read as "nothing there"; groups and noise are as the queries say."""

import os
from types import SimpleNamespace

import pytest

from fundlake.plans import compare, ingest
from fundlake.plans.loads import STATEMENT_KINDS, statement_load
from fundlake.plans.scope import scope
from fundlake.registry import QUERIES
from fundlake.session import checkpoint_root
from fundlake.sources import sinks
from fundlake.sources.catalog import load_tables
from fundlake.sources.statements_csv import read_raw

SF = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.exists(SF), reason="test data not present")


def test_missing_table_is_empty_but_a_broken_one_raises(spark, tmp_path):
    assert sinks.table_is_empty(spark, str(tmp_path / "none"))
    broken = tmp_path / "broken"
    broken.mkdir()
    (broken / "part-0.parquet").write_bytes(b"not parquet at all")
    with pytest.raises(Exception):
        sinks.table_is_empty(spark, str(broken))
    seed = spark.range(1)
    with pytest.raises(Exception):
        sinks.seed_if_empty(spark, str(broken), seed)
    assert os.listdir(broken) == ["part-0.parquet"]


def test_read_raw_only_misses_absent_files(spark, tmp_path):
    assert read_raw(spark, str(tmp_path), "DRE") is None


def test_load_fault_leaves_the_registry(spark, tmp_path, monkeypatch):
    """A read fault ends the load before a new registry is made."""
    from fundlake.plans import lake, loads

    def broken(*a, **k):
        raise OSError("unreadable")

    land = tmp_path / "land"
    land.mkdir()
    (land / "itr_cia_aberta_DRE_con_2001.csv").write_text("CNPJ_CIA\n")
    root = str(tmp_path / "lake")
    monkeypatch.setattr(loads, "load_statement", broken)
    with pytest.raises(OSError):
        statement_load(spark, str(land), root, spark.createDataFrame([("C",)], "cnpj string"))
    assert lake.generation(spark, root) == 0 and lake.registry(spark, root).count() == 0


def test_every_statement_kind_is_loaded():
    assert set(STATEMENT_KINDS) == {"dre", "dva", "dfc", "dmpl", "bpa", "bpp"}


def test_no_machine_local_folder_on_a_cluster():
    context = SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None)
    session = SimpleNamespace(conf=SimpleNamespace(get=lambda k, d=None: None), sparkContext=context)
    with pytest.raises(ValueError):
        checkpoint_root(session)


@needs_data
@pytest.mark.parametrize("measure", sorted(compare.TICKER_MEASURES))
def test_individual_group_equals_the_direct_call(spark, measure):
    t = load_tables(spark, SF)
    by_name = compare.compare_measure(t, measure, {"start_period": "last"}, group="individual")
    direct = compare.TICKER_MEASURES[measure](t, start_period="last", group="individual",
                                              scope_df=scope(t, "individual"))
    a, b = (sorted(map(str, df.select(*direct.columns).collect())) for df in (by_name, direct))
    assert a == b and a


@needs_data
def test_every_kind_of_noise_is_in_the_landed_files(spark):
    t = load_tables(spark, SF)
    quotes = {(r.tpmerc, r.codbdi, (r.especi or "")[:3]): r for r in ingest.price_filters(t).collect()}
    for key in ((30, 2, "ON "), (10, 12, "ON "), (10, 2, "DRN")):
        assert quotes[key].n_records > 0 and not quotes[key].kept
    assert quotes[10, 2, ""].kept
    shares = {(r.mkt, r.sctyctgy, r.spcfctncd): r for r in ingest.share_filters(t).collect()}
    for key in ((20, 11, "ON NM"), (10, 9, "ON NM"), (10, 11, "CI"), (10, 11, "DIA")):
        assert shares[key].n_records > 0 and not shares[key].kept
    merged = QUERIES["merge_shares"](spark, SF)
    assert merged.filter("number_shares is null").count() > 0


@needs_data
def test_price_load_moves_the_last_price_date(spark):
    from dataclasses import replace

    from pyspark.sql import functions as F

    from fundlake.plans.scope import last_price_dates
    from fundlake.sources.landing import stored_prices

    t = load_tables(spark, SF)
    before, after = stored_prices(t), ingest.price_load_table(t)
    newest = [last_price_dates(replace(t, prices=p, root=None)).agg(F.max("last_price_date")).first()[0] for p in (before, after)]
    assert newest[0] < newest[1] and after.count() > before.count()


def test_every_weekday_is_a_regular_series(spark):
    import datetime as dt

    from fundlake.functions.frequency import frequency_table

    days = [dt.date(2001, 1, 1) + dt.timedelta(days=i) for i in range(30)]
    work = [(d,) for d in days if d.weekday() < 5]
    regular = [frequency_table(spark.createDataFrame([("m", *r) for r in rows], "k string, date date"), ["k"]).first().is_regular
               for rows in (work, work[:7] + work[8:])]
    assert regular == [True, False]
