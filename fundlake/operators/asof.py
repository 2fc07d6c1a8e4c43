"""As-of alignment of a daily series with a quarterly one (J8, W6) and
index-aligned arithmetic of two series (J9).

``asof_merge`` is the outer merge on date followed by a forward fill of
each column: every output row is a date of either side, and each column
carries its latest non-null value up to that date.  This is an as-of
(backward) join plus the rows at the other side's dates.

The forward fill is one running window over a key's rows, which are one per date, so
they are bounded by the calendar however large the table is.  The merge deals its rows by
key, so one exchange of the stacked rows serves the merge and the fill, and the rows are
neither read nor joined a second time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def forward_fill(df: DataFrame, keys: list[str], cols: list[str], date_col: str = "date") -> DataFrame:
    """Replace NULLs in ``cols`` by the latest earlier non-null value within ``keys``."""
    so_far = Window.partitionBy(*keys).orderBy(date_col).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    keep = [c for c in df.columns if c not in cols]
    return df.select(*keep, *[F.last(c, ignorenulls=True).over(so_far).alias(c) for c in cols])


def asof_merge(*frames: DataFrame, keys: list[str], date_col: str = "date", parts: int | None = None) -> DataFrame:
    """Outer merge of several series on (keys, date), then forward fill of every value column.

    Each input holds at most one row per key and date.  The merge is a
    union of the inputs (NULL for the others' columns) with one hash
    exchange on the keys; rows of the same date are collapsed there
    and the fill runs on the same partitioning, so no further exchange of
    the merged rows is needed (a full outer join would lose the
    partitioning).  Merging n series at once replaces n - 1 nested merges.
    ``parts`` is the number of tasks the rows are dealt to; without it Spark chooses.
    """
    on = [*keys, date_col]
    value_cols = [[c for c in f.columns if c not in on] for f in frames]
    types = {c: f.schema[c].dataType for f, cs in zip(frames, value_cols) for c in cs}
    every = [c for cs in value_cols for c in cs]
    stacked = [f.select(*on, *[F.col(c) if c in cs else F.lit(None).cast(types[c]).alias(c) for c in every])
               for f, cs in zip(frames, value_cols)]
    both = stacked[0]
    for s in stacked[1:]:
        both = both.unionByName(s)
    dealt = both.repartition(*keys) if parts is None else both.repartition(parts, *keys)
    merged = dealt.groupBy(*on).agg(*[F.max(c).alias(c) for c in every])
    return forward_fill(merged, keys, every, date_col)


def aligned(left: DataFrame, right: DataFrame, keys: list[str], out: str, expr, how: str = "full_outer",
            date_col: str = "date") -> DataFrame:
    """Combine two date-indexed series on the union (or intersection) of dates.

    ``expr`` maps (left column, right column) to the result; it is NULL
    where either side is missing.
    """
    lv = [c for c in left.columns if c not in (*keys, date_col)][0]
    rv = [c for c in right.columns if c not in (*keys, date_col)][0]
    j = left.join(right, [*keys, date_col], how)
    return j.select(*keys, date_col, expr(F.col(lv), F.col(rv)).alias(out))


def beside(left: DataFrame, right: DataFrame, keys: list[str], out: str, expr, both: bool = False,
           date_col: str = "date") -> DataFrame:
    """J9 for series of the same partitioning: as ``aligned``, but the two are stacked and meet by one
    aggregation per key and date, so an existing partitioning on the keys is kept.

    Repeated rows of a date give every pair, as a join does.  ``both`` keeps only dates of both sides.
    """
    sides = []
    for frame in (left, right):
        value = next(c for c in frame.columns if c not in (*keys, date_col))
        sides.append((frame, F.struct(F.col(value).alias("v"))))
    (a, av), (b, bv) = sides
    rows = (a.select(*keys, date_col, av.alias("_a"), F.lit(None).cast(b.select(bv.alias("x")).schema["x"].dataType).alias("_b"))
            .unionByName(b.select(*keys, date_col, F.lit(None).cast(a.select(av.alias("x")).schema["x"].dataType).alias("_a"), bv.alias("_b"))))
    met = rows.groupBy(*keys, date_col).agg(F.collect_list("_a").alias("_a"), F.collect_list("_b").alias("_b"))
    explode = F.explode if both else F.explode_outer
    met = met.withColumn("_a", explode("_a")).withColumn("_b", explode("_b"))
    return met.select(*keys, date_col, expr(F.col("_a.v"), F.col("_b.v")).alias(out))
