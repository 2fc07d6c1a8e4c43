"""Frequency rule (M2), forward fill / as-of merge (J8, W6), calendar."""

import datetime as dt

import pandas as pd
from conftest import d
from hypothesis import given, settings
from hypothesis import strategies as st

from fundlake.functions.frequency import frequency_table
from fundlake.operators.asof import asof_merge, forward_fill
from fundlake.operators.calendar import expected_days


def _freq(spark, dates):
    df = spark.createDataFrame([("k", d(x)) for x in dates], "k string, date date")
    r = frequency_table(df, ["k"]).collect()[0]
    return r.freq, r.is_regular


def test_frequency_rule(spark):
    quarterly = ["2000-03-31", "2000-06-30", "2000-09-30", "2000-12-31"]
    annual = ["1998-12-31", "1999-12-31", "2000-12-31"]
    biennial = ["1996-12-31", "1998-12-31", "2000-12-31"]
    sparse = ["1990-12-31", "1995-06-30", "2000-03-31"]
    assert _freq(spark, quarterly) == ("Q", True)
    assert _freq(spark, annual) == ("A", True)
    assert _freq(spark, biennial) == ("Q", True)      # regular, but not yearly
    assert _freq(spark, annual[:2])[0] == "Q"           # fewer than 3 dates
    assert _freq(spark, sparse) == ("A", False)       # irregular, <= 1 report per year


def test_forward_fill_crosses_months(spark):
    rows = [("a", d("2000-01-30"), 1.0), ("a", d("2000-01-31"), None), ("a", d("2000-03-02"), None),
            ("a", d("2000-03-05"), 2.0), ("a", d("2000-04-01"), None), ("b", d("2000-03-01"), None)]
    df = spark.createDataFrame(rows, "k string, date date, v double")
    out = forward_fill(df, ["k"], ["v"]).orderBy("k", "date").collect()
    assert [r.v for r in out] == [1.0, 1.0, 1.0, 2.0, 2.0, None]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a", "b"]), st.integers(0, 400),
                          st.one_of(st.none(), st.integers(-5, 5))), min_size=1, max_size=40))
def test_forward_fill_matches_pandas(spark, rows):
    base = dt.date(2000, 1, 1)
    seen = {}
    for k, off, v in rows:
        seen[(k, off)] = v
    data = [(k, base + dt.timedelta(days=off), None if v is None else float(v)) for (k, off), v in seen.items()]
    df = spark.createDataFrame(data, "k string, date date, v double")
    got = {(r.k, r.date): r.v for r in forward_fill(df, ["k"], ["v"]).collect()}
    pdf = pd.DataFrame(data, columns=["k", "date", "v"]).sort_values(["k", "date"])
    pdf["v"] = pdf.groupby("k")["v"].ffill()
    want = {(r.k, r.date): (None if pd.isna(r.v) else r.v) for r in pdf.itertuples()}
    assert got == want


def test_asof_merge_adds_both_date_sets(spark):
    daily = spark.createDataFrame([("x", d("2000-03-30"), 10.0), ("x", d("2000-04-03"), 11.0)],
                                  "k string, date date, price double")
    quarterly = spark.createDataFrame([("x", d("2000-03-31"), 5.0)], "k string, date date, eps double")
    out = asof_merge(daily, quarterly, keys=["k"]).orderBy("date").collect()
    assert [(r.date, r.price, r.eps) for r in out] == [
        (d("2000-03-30"), 10.0, None), (d("2000-03-31"), 10.0, 5.0), (d("2000-04-03"), 11.0, 5.0)]


def test_expected_days_skip_weekends_holidays_and_fixed_days(spark):
    stored = spark.createDataFrame([(d("2001-12-20"),)], "date date")
    holidays = spark.createDataFrame([(d("2001-12-25"),)], "date date")
    out = [r.date for r in expected_days(stored, holidays, d("2002-01-02")).orderBy("date").collect()]
    # 22/23 and 29/30 Dec are a weekend; 24, 25 and 31 Dec are closed
    assert out == [d("2001-12-21"), d("2001-12-26"), d("2001-12-27"), d("2001-12-28"),
                   d("2002-01-01"), d("2002-01-02")]


def test_expected_days_empty_when_up_to_date(spark):
    stored = spark.createDataFrame([(d("2001-12-20"),)], "date date")
    holidays = spark.createDataFrame([], "date date")
    assert expected_days(stored, holidays, d("2001-12-20")).count() == 0


def test_frequency_classes_equal_those_of_pandas(spark):
    """Regular series of every kind, regular ones with a date missing or moved, random ones."""
    import random

    import pandas as pd

    rng = random.Random(3)
    series = []
    kinds = ["YE-DEC", "YE-MAR", "2YE-DEC", "YS-JAN", "BYE-DEC", "BYS-JAN", "QE-DEC", "QE-NOV", "QE-OCT", "2QE-DEC", "QS-OCT", "BQE-DEC",
             "BQS-OCT", "ME", "2ME", "MS", "BME", "BMS", "4ME", "W-FRI", "2W-MON", "D", "3D", "10D", "14D", "B", "WOM-3FRI", "WOM-1MON",
             "WOM-4SUN"]
    for kind in kinds:
        for n in (3, 4, 9, 24):
            dates = list(pd.date_range("1996-02-20", periods=n, freq=kind))
            series.append(dates)
            if n > 4:
                series.append(dates[:3] + dates[4:])
                moved = sorted({*dates[:5], dates[5] + pd.Timedelta(days=1), *dates[6:]})
                series.append(moved)
    series += [sorted({pd.Timestamp("2000-01-01") + pd.Timedelta(days=rng.randrange(40)) for _ in range(rng.randrange(3, 8))}) for _ in range(40)]
    series = [s for s in series if len(s) >= 3]
    rows = [(k, d.date()) for k, dates in enumerate(series) for d in dates]
    got = {r.k: r for r in frequency_table(spark.createDataFrame(rows, "k int, date date"), ["k"]).collect()}
    for k, dates in enumerate(series):
        want = pd.infer_freq(pd.DatetimeIndex(dates))
        assert got[k].frequency == want and got[k].is_regular == (want is not None), (k, dates[:6])


def test_annual_reporters_by_class(spark):
    import pandas as pd

    cases = {"YE-DEC": "A", "YS-JAN": "A", "2YE-DEC": "Q", "BYE-DEC": "Q", "2BYE-DEC": "Q", "QE-DEC": "Q", "ME": "Q"}
    rows = [(kind, d.date()) for kind in cases for d in pd.date_range("1996-02-20", periods=6, freq=kind)]
    got = {r.k: r.freq for r in frequency_table(spark.createDataFrame(rows, "k string, date date"), ["k"]).collect()}
    assert got == cases


def test_asof_merge_exchanges_its_rows_once(spark):
    """One exchange by key and no join: the fill does not read the merged rows a second time."""
    daily = spark.createDataFrame([("x", d("2000-03-30"), 10.0)], "k string, date date, price double")
    quarterly = spark.createDataFrame([("x", d("2000-03-31"), 5.0)], "k string, date date, eps double")
    plan = asof_merge(daily, quarterly, keys=["k"], parts=3)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(k") == 1 and "Join" not in plan
    assert "hashpartitioning(k#" in plan and ", 3)" in plan
