"""Writes of the stored tables (A7-A10) and the file registry.

* ``append``: add rows to a table (A9), optionally partitioned;
* ``overwrite``: truncate-and-load (A8), e.g. the ticker register;
* ``seed_if_empty``: load a seed file only when the table has no rows (A7);
* ``replace_slices``: restated files replace their slice
  (dt_refer, itr_dfp, grupo_dfp) and leave every other slice alone (A10),
  with a dynamic partition overwrite.  Plain Parquet is not transactional:
  a failed write can leave a slice half-written, so each statement type is
  written once per run and the registry is only updated afterwards;
* ``changed_files`` / ``registry_upsert``: which landed archives are new or
  newer than the registered copy (A12), and the registry after loading
  them (A11).  The new registry goes to a new folder: a table cannot be
  overwritten while it is being read.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundlake.session import path_missing

SLICE_KEYS = ("dt_refer", "itr_dfp", "grupo_dfp")
NEVER = _dt.datetime(1900, 1, 1)


def append(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> None:
    w = df.write.mode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def overwrite(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def table_is_empty(spark: SparkSession, path: str) -> bool:
    try:
        return spark.read.parquet(path).limit(1).count() == 0
    except AnalysisException as e:
        if not path_missing(e):
            raise
        return True


def seed_if_empty(spark: SparkSession, path: str, seed: DataFrame, partition_by: tuple[str, ...] = ()) -> bool:
    """Append ``seed`` when the table at ``path`` is missing or empty; True when seeded."""
    if table_is_empty(spark, path):
        append(seed, path, partition_by)
        return True
    return False


def replace_slices(df: DataFrame, path: str, keys: tuple[str, ...] = SLICE_KEYS) -> None:
    """A10: every slice present in ``df`` replaces the stored slice; others are kept."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy(*keys).parquet(path))


def changed_files(available: DataFrame, registered: DataFrame) -> DataFrame:
    """Archives not registered yet, or newer than the registered copy."""
    j = available.join(registered.select("file_name", "last_modified"), "file_name", "left")
    last = F.coalesce(F.col("last_modified"), F.lit(NEVER.isoformat(sep=" ")).cast("timestamp_ntz"))
    return j.filter(F.col("url_date") > last).select("file_name", "url_date")


def registry_upsert(registered: DataFrame, loaded: DataFrame) -> DataFrame:
    """Drop the loaded names from the registry, then add them with their new date."""
    kept = registered.join(loaded.select("file_name"), "file_name", "left_anti").select("file_name", "last_modified")
    new = loaded.select("file_name", F.col("url_date").alias("last_modified"))
    return kept.unionByName(new)
