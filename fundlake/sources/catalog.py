"""The stored tables the measures read, and where they live.

``load_tables`` names the landed tables of an input folder.  Each is derived and written once, when a
query first asks for it, under the shared folder named by ``spark.checkpoint.dir``
(this also cuts the lineage back to the raw tables), and is then read
from those files as a catalog table (``fundlake.sources.tables``); a query stores no table it does not read.
Statement tables are partitioned by ``grupo_dfp``, bucketed by company and sorted by company
and date inside each file, so a filter on a group prunes directories, a filter on a company
reads one bucket and windows by company need no exchange; prices are partitioned by year.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property, partial

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundlake.session import checkpoint_root, path_missing
from fundlake.sources import fixtures
from fundlake.sources import tables as defined

# Bump when the derivation changes so stale copies are not reused.
LAYOUT_VERSION = "fx15"
STATEMENTS = ("dre", "dva", "dfc", "bpa", "bpp")
#: Input bytes per part: the tasks of steps over daily rows follow the input, as AQE would size them by narrow, well
#: packed rows that take many times their size in a sort or an aggregation.
PART_BYTES, LEAST_PARTS = 8 << 20, 8
#: A statement has several rows per group and account of each quarter's input, and a measure may stack two of them in a
#: task, so buckets are as many as an input of this many times the bytes would have.
ROWS_TIMES = 4
RAW_INPUTS = ("lineitem", "supplier", "nation", "region")


class Stored:
    """A table that is opened, and derived and written if need be, when it is first asked for."""

    def __init__(self, open_: Callable[[], DataFrame]):
        self._open = open_

    @cached_property
    def table(self) -> DataFrame:
        return self._open()


@dataclass(frozen=True)
class Tables:
    dre: DataFrame
    dva: DataFrame
    dfc: DataFrame
    bpa: DataFrame
    bpp: DataFrame
    prices: DataFrame
    tickers: DataFrame
    root: str | None = None  # folder of the stored tables, when they are stored
    bucketed: bool = False  # all rows of a company are in one bucket of each statement table
    parts: int | None = None  # tasks that steps over daily rows are dealt to, when the input's size is known
    report_dates: DataFrame | None = None  # (cnpj, grupo_dfp, date) kept by the loads
    price_ends: DataFrame | None = None  # (ticker, last_price_date) kept by the loads

    def __getattribute__(self, name: str):
        value = super().__getattribute__(name)
        return value.table if isinstance(value, Stored) else value

    def get(self, name: str) -> DataFrame:
        return getattr(self, name)


def _input_state(spark: SparkSession, sf_dir: str) -> tuple[str, int]:
    """A hash of names, sizes and times of the input files as Spark lists them (any file system; the
    files' content is not read), and their bytes."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
             .load([f"{sf_dir}/{name}.parquet" for name in RAW_INPUTS]))
    seen = F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)")
    state = files.agg(F.count(F.lit(1)).alias("n"), F.sum(seen).alias("s"), F.sum("length").alias("bytes")).first()
    name = f"{LAYOUT_VERSION}|{sf_dir}|{state['n']}|{state['s']}"
    return hashlib.sha1(name.encode()).hexdigest()[:16], state["bytes"] or 0


def stored_or_build(spark: SparkSession, path: str, build) -> DataFrame:
    """Read a derived table from ``path``; build and write it there first if missing.

    Used for small dimension tables (the scope) that many queries share:
    writing them once keeps every later plan short.
    """
    key = (spark.sparkContext.applicationId, path)
    if key not in _DERIVED:
        if not _exists(spark, f"{path}/_done"):
            build().write.mode("overwrite").parquet(f"{path}/data")
            spark.range(1).write.mode("overwrite").parquet(f"{path}/_done")
        _DERIVED[key] = spark.read.parquet(f"{path}/data")
    return _DERIVED[key]


def written_once(rows: DataFrame, root: str) -> DataFrame:
    """Rows that a query reads twice, written to a new folder under ``root`` and read back, so they are made once."""
    path = f"{root}/_series/{uuid.uuid4().hex}"
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


_DERIVED: dict[tuple[str, str], DataFrame] = {}


def _exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.parquet(path).limit(1).collect()
        return True
    except AnalysisException as e:
        if not path_missing(e):
            raise
        return False


_MEMO: dict[tuple[str, str], Tables] = {}


_ROOTS: dict[tuple[str, str], str] = {}


def table_root(spark: SparkSession, sf_dir: str) -> str:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _ROOTS:
        _ROOTS[key] = f"{checkpoint_root(spark)}/fundlake/tables/{_input_state(spark, sf_dir)[0]}"
    return _ROOTS[key]


def load_tables(spark: SparkSession, sf_dir: str, materialize: bool = True, root: str | None = None) -> Tables:
    """Stored tables for ``sf_dir``; each is derived and written when it is first asked for.

    With ``materialize=False`` the derivation stays lazy (no writes).
    ``root`` overrides the folder (by default one per input under the
    shared checkpoint folder).
    """
    if not materialize:
        return Tables(**fixtures.derive_all(spark, sf_dir))
    root = root or table_root(spark, sf_dir)
    key = (spark.sparkContext.applicationId, root)
    if key not in _MEMO:
        manifest = f"{root}/_manifest"
        if not _exists(spark, manifest):
            size = _input_state(spark, sf_dir)[1]
            (spark.range(1).select(F.lit(LAYOUT_VERSION).alias("version"), F.lit(defined.buckets_for(ROWS_TIMES * size)).alias("buckets"),
                                   F.lit(max(1, size // PART_BYTES)).alias("parts")).write.mode("overwrite").parquet(manifest))
        found = spark.read.parquet(manifest).first()
        buckets, parts = found["buckets"], found["parts"]
        stored = {name: Stored(partial(_open, spark, sf_dir, root, name, buckets, parts)) for name in defined.DEFINITIONS}
        _MEMO[key] = Tables(**stored, root=root, bucketed=True, parts=max(LEAST_PARTS, parts))
    return _MEMO[key]


def _open(spark: SparkSession, sf_dir: str, root: str, name: str, buckets: int, parts: int) -> DataFrame:
    """One stored table; derived and written first if it is not there, its mark last."""
    definition, path = defined.DEFINITIONS[name], f"{root}/{name}"
    done = f"{root}/_stored/{name}"
    if not _exists(spark, done):
        cum = None
        if name in fixtures.STATEMENTS:  # the totals per quarter, which five tables share, are made once
            cum = stored_or_build(spark, f"{root}/_quarterly", lambda: fixtures.cumulative_totals(spark, sf_dir))
        rows = fixtures.derive(spark, sf_dir, name, cum, buckets, parts)
        defined.write_table(rows, path, definition, buckets, dealt=True)
        spark.range(1).write.mode("overwrite").parquet(done)
    table = defined.open_table(spark, path, definition, buckets)
    return table.drop("year") if name == "prices" else table


def tables_from_frames(**frames: DataFrame) -> Tables:
    """Tables built from given DataFrames (hand-made test cases)."""
    return Tables(**frames)
