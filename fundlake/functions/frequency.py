"""The frequency class of a series of dates, and whether a company reports annually only.

``frequency_table`` names the class of every key's distinct, sorted dates, from three dates on:

* a constant gap in months with one anchor -- the last or first day of the month (``E``, ``S``), or the last or first business
  day (``BE``, ``BS``) -- is a year, quarter or month class (``YE-DEC``, ``BQS-OCT``, ``ME``), with the number of
  periods in front if it is more than one (``2YE-DEC``);
* a constant gap in days is a week or day class (``W-FRI``, ``10D``);
* every weekday from Monday to Friday without a gap is ``B``;
* the same weekday in the same week of the month is ``WOM-3FRI``;
* any other series has no class.

The classes come from a histogram of each key's dates (extremes of the gaps, and how many dates sit on each
anchor): one window for the gaps and one aggregation, merged by partial sums.

Annual reporters: a class of one year (``YE``, ``YS``) is annual, any other class is not; without a class, a series
of at least three dates is annual when the number of dates per mean year (365.2425 days) of span is at most 1.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MEAN_YEAR_DAYS = 365.2425
# Fixed names of months and weekdays in the classes.
MONTHS = ["JAN", "FEB", "MAR", "APR", "MAY", "JUN", "JUL", "AUG", "SEP", "OCT", "NOV", "DEC"]
WEEKDAYS = ["MON", "TUE", "WED", "THU", "FRI", "SAT", "SUN"]


def _named(names: list[str], place: Column) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in names]), (place + 1).cast("int"))


def _counted(n: Column, name: Column) -> Column:
    """The class with its number of periods in front, if more than one."""
    return F.when(n > 1, F.concat(n.cast("int").cast("string"), name)).otherwise(name)


def gap_histogram(dates: DataFrame, keys: list[str], date_col: str = "date") -> DataFrame:
    """Per key: number of dates, first and last, extremes of the gaps, and which anchors hold all dates."""
    d = F.col("_d")
    month = F.year(d) * 12 + F.month(d)
    weekday, day, days = F.weekday(d), F.dayofmonth(d), F.dayofmonth(F.last_day(d))
    rows = dates.select(*keys, F.col(date_col).alias("_d"))
    wd = Window.partitionBy(*keys).orderBy("_d")
    gap = F.datediff(d, F.lag(d).over(wd))
    rows = rows.withColumns({"_gm": month - F.lag(month).over(wd), "_gd": gap})
    step = F.col("_gd")
    all_ = lambda cond, name: F.min(cond.cast("int")).alias(name)
    week = F.floor((day - 1) / 7)
    return rows.groupBy(*keys).agg(
        F.count("_d").alias("n_dates"), F.min("_d").alias("first_date"), F.max("_d").alias("last_date"),
        F.min("_gm").alias("gm_lo"), F.max("_gm").alias("gm_hi"), F.min("_gd").alias("gd_lo"), F.max("_gd").alias("gd_hi"),
        all_(day == days, "month_end"), all_((day == days) | ((days - day < 3) & (weekday == 4)), "business_end"),
        all_(day == 1, "month_start"), all_((day == 1) | ((day <= 3) & (weekday == 0)), "business_start"),
        all_(step.isNull() | ((step == 1) & weekday.between(1, 4)) | ((step == 3) & (weekday == 0)), "workdays"),
        F.min(weekday).alias("wd_lo"), F.max(weekday).alias("wd_hi"),
        F.min(F.when(week < 4, week)).alias("week_lo"), F.max(F.when(week < 4, week)).alias("week_hi"))


def frequency_class(month_of: Column) -> Column:
    """The class name from the columns of ``gap_histogram``, NULL if the series has none."""
    anchor = (F.when(F.col("month_end") == 1, "E").when(F.col("business_end") == 1, "BE")
              .when(F.col("month_start") == 1, "S").when(F.col("business_start") == 1, "BS"))
    gm, gd = F.col("gm_lo"), F.col("gd_lo")
    monthly = anchor.isNotNull() & (gm == F.col("gm_hi")) & (gm > 0)
    name = lambda unit: F.when(F.length(anchor) == 2, F.concat(F.lit("B" + unit), F.substring(anchor, 2, 1))).otherwise(
        F.concat(F.lit(unit), anchor))
    year = F.concat(name("Y"), F.lit("-"), _named(MONTHS, month_of - 1))
    quarter_month = F.element_at(F.array(F.lit(11), F.lit(9), F.lit(10)), (month_of % 3 + 1).cast("int"))
    quarter = F.concat(name("Q"), F.lit("-"), _named(MONTHS, quarter_month))
    weekly = _counted(gd / 7, F.concat(F.lit("W-"), _named(WEEKDAYS, F.col("wd_lo"))))
    daily = F.when(gd % 7 == 0, weekly).otherwise(_counted(gd, F.lit("D")))
    weeks = F.concat(F.lit("WOM-"), (F.col("week_lo") + 1).cast("int").cast("string"), _named(WEEKDAYS, F.col("wd_lo")))
    return (F.when(F.col("n_dates") < 3, None)
            .when(monthly & (gm % 12 == 0), _counted(gm / 12, year)).when(monthly & (gm % 3 == 0), _counted(gm / 3, quarter))
            .when(monthly, _counted(gm, name("M"))).when(gd == F.col("gd_hi"), daily)
            .when((F.col("workdays") == 1) & (gd == 1) & (F.col("gd_hi") == 3), "B")
            .when((F.col("wd_lo") == F.col("wd_hi")) & (F.col("week_lo") == F.col("week_hi")), weeks))


def frequency_table(dates: DataFrame, keys: list[str], date_col: str = "date") -> DataFrame:
    """``dates`` holds distinct (keys, date) rows.

    Returns keys, freq ('A' for annual reporters, else 'Q'), n_dates, last_date, frequency (the class) and is_regular
    (is there one?).  The rows of one key are its report dates, about four a year.
    """
    found = gap_histogram(dates, keys, date_col).withColumn("frequency", frequency_class(F.month("first_date")))
    years = F.datediff("last_date", "first_date") / F.lit(MEAN_YEAR_DAYS)
    freq: Column = (
        F.when(F.col("n_dates") < 3, "Q")
        .when(F.col("frequency").isNotNull(), F.when(F.col("frequency").rlike("^Y[ES]-"), "A").otherwise("Q"))
        .when(F.col("n_dates") / years > 1, "Q")
        .otherwise("A")
    )
    return found.select(*keys, freq.alias("freq"), "n_dates", "last_date", "frequency", F.col("frequency").isNotNull().alias("is_regular"))
