"""Expected trading days.

The days to fetch after the newest stored price date: weekdays up to
``today``, minus national holidays and the fixed non-trading days of the
exchange (24 and 31 December of this year and the previous one, relative
to ``today``).  The day range is bounded by the calendar, not by the data.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed non-trading days added to the holiday list: (month, day), for the
# year of ``today`` and the year before.
FIXED_CLOSED_DAYS = [(12, 24), (12, 31)]


def closed_days(holidays: DataFrame, today: _dt.date) -> DataFrame:
    """U4: holidays plus the fixed closed days."""
    spark = holidays.sparkSession
    fixed = [_dt.date(y, m, d) for y in (today.year, today.year - 1) for m, d in FIXED_CLOSED_DAYS]
    extra = spark.createDataFrame([(d,) for d in fixed], "date date")
    return holidays.select(F.col("date").cast("date").alias("date")).unionByName(extra)


def expected_days(stored_dates: DataFrame, holidays: DataFrame, today: _dt.date) -> DataFrame:
    """Weekdays after the newest stored date up to ``today``, minus closed days."""
    last = stored_dates.agg(F.max("date").alias("last"))
    start = F.date_add("last", 1)
    span = F.when(start <= F.lit(today), F.sequence(start, F.lit(today), F.expr("INTERVAL 1 DAY")))
    days = last.select(F.explode(span).alias("date"))
    weekdays = days.filter(~F.dayofweek("date").isin(1, 7))
    return weekdays.join(closed_days(holidays, today), "date", "left_anti")
