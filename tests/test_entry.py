"""Driver contract: entry() on sf0.001, matching query/oracle keys, a few oracle checks."""

import os

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="test data not present")


def test_keys_match():
    """Every query of the library proper has SQL; text operators only where SQL can express them."""
    from fundlake.registry import QUERIES

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(QUERIES) <= set(entry.oracle_sql())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["ticker", "date", "p_e"]
    assert df.count() > 0


@pytest.mark.parametrize("name", ["net_income", "ebitda_margin", "eps_last", "price_bv", "ingest_statements"])
def test_against_duckdb(spark, name):
    con = duckdb.connect()
    for t in ("lineitem", "supplier", "nation", "region"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    res = con.execute(entry.oracle_sql()[name])
    cols = [c[0] for c in res.description]
    want = sorted(tuple(str(v) for v in r) for r in res.fetchall())
    sdf = entry.queries()[name](spark, SF).select(*cols)
    got = sorted(tuple(str(v) for v in r) for r in sdf.collect())
    assert got == want
