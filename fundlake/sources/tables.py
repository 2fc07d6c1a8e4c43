"""The stored tables as catalog tables: definitions with types (A13), existence, writes, scans.

Every table has a definition: column types, the partition columns, and for the statements the bucket
column.  Statement tables are bucketed by company, so all rows of a company are in files of one bucket: windows and aggregations
by company, over one statement or several stacked ones, need no exchange of statement rows.  The number of buckets is fixed when
the tables are written, from the bytes of the input.

A catalog of a new session does not know the tables; ``open_table`` defines them again over the stored files.  Rows are
checked against the definition before they are written: a missing, an unknown or a differently typed
column raises ``SchemaDrift`` and nothing is written.
"""

from __future__ import annotations

import hashlib
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class SchemaDrift(ValueError):
    """Rows whose columns are not those of the table they are written to."""


class Definition(NamedTuple):
    schema: T.StructType
    partition: tuple[str, ...] = ()
    bucket: tuple[str, ...] = ()
    sort: tuple[str, ...] = ()


TYPES = {"STRING": T.StringType(), "DATE": T.DateType(), "INT": T.IntegerType(), "BIGINT": T.LongType(), "DOUBLE": T.DoubleType()}


def schema_of(text: str) -> T.StructType:
    """The schema of ``name TYPE, name TYPE, ...`` (no session is needed)."""
    return T.StructType([T.StructField(name, TYPES[kind]) for name, kind in (c.split() for c in text.split(","))])


_FLOW = ("cnpj STRING, grupo_dfp STRING, dt_ini_exerc DATE, dt_fim_exerc DATE, fiscal_quarter INT, "
         "cd_conta STRING, ds_conta STRING, vl_conta BIGINT")
_BALANCE = "cnpj STRING, grupo_dfp STRING, dt_fim_exerc DATE, cd_conta STRING, ds_conta STRING, vl_conta BIGINT"
_BY_COMPANY = dict(partition=("grupo_dfp",), bucket=("cnpj",), sort=("cnpj", "dt_fim_exerc"))

DEFINITIONS: dict[str, Definition] = {
    **{name: Definition(schema_of(_FLOW), **_BY_COMPANY) for name in ("dre", "dva", "dfc")},
    **{name: Definition(schema_of(_BALANCE), **_BY_COMPANY) for name in ("bpa", "bpp")},
    "prices": Definition(schema_of("date DATE, ticker STRING, preult DOUBLE, totneg BIGINT, quatot BIGINT, number_shares BIGINT, year INT"),
                         partition=("year",), sort=("ticker", "date")),
    "tickers": Definition(schema_of("ticker STRING, cnpj STRING, type STRING, sector STRING, subsector STRING, segment STRING, "
                                  "denom_social STRING, denom_comerc STRING")),
}
#: Input bytes per bucket, and the least and the greatest number of buckets (Spark allows 100,000).
BUCKET_BYTES, FEWEST, MOST = 64 << 20, 8, 1 << 16


def buckets_for(input_bytes: int) -> int:
    """A power of two, so tables written at different sizes have numbers that divide each other."""
    n = FEWEST
    while n < MOST and n * BUCKET_BYTES < input_bytes:
        n *= 2
    return n


def name_of(path: str) -> str:
    """The catalog name of the table stored at a path."""
    return f"fundlake_{hashlib.sha1(path.encode()).hexdigest()[:16]}"


def conformed(df: DataFrame, schema: T.StructType, what: str = "table") -> DataFrame:
    """df with exactly the schema's columns in its order; whole numbers may be narrower.  Raises ``SchemaDrift``."""
    have = {f.name: f.dataType for f in df.schema}
    want = {f.name: f.dataType for f in schema}
    faults = [f"{c} is missing" for c in want if c not in have] + [f"{c} is unknown" for c in have if c not in want]
    narrower = (T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType())
    for c in want:
        if c in have and have[c].simpleString() != want[c].simpleString() and not (
                have[c] in narrower and want[c] in narrower and narrower.index(have[c]) < narrower.index(want[c])):
            faults.append(f"{c} is {have[c].simpleString()}, not {want[c].simpleString()}")
    if faults:
        raise SchemaDrift(f"{what}: {'; '.join(faults)}")
    return df.select(*[F.col(c).cast(t) if have[c] != t else F.col(c) for c, t in want.items()])


def exists(spark: SparkSession, path: str) -> bool:
    """Does the session's catalog know the table stored at this path?"""
    return spark.catalog.tableExists(name_of(path))


def create(spark: SparkSession, path: str, definition: Definition, buckets: int) -> str:
    """Define the table in the catalog if it is not there; returns its name."""
    name = name_of(path)
    if not exists(spark, path):
        quoted = lambda cols: ", ".join(f"`{c}`" for c in cols)
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in definition.schema)
        text = f"CREATE TABLE {name} ({columns}) USING parquet"
        if definition.partition:
            text += f" PARTITIONED BY ({quoted(definition.partition)})"
        if definition.bucket:
            text += f" CLUSTERED BY ({quoted(definition.bucket)}) SORTED BY ({quoted(definition.sort)}) INTO {buckets} BUCKETS"
        spark.sql(f"{text} LOCATION '{path}'")
    return name


def write_table(df: DataFrame, path: str, definition: Definition, buckets: int, dealt: bool = False) -> None:
    """Replace the table's rows.  Rows are dealt by bucket (or partition and first sort) columns, in sizes that AQE
    chooses, so a company, ticker or year with very many rows is written by several tasks.

    ``dealt`` says that the rows are partitioned by those columns already and no key has many; they are not exchanged again."""
    spark = df.sparkSession
    rows = conformed(df, definition.schema, name_of(path))
    name = create(spark, path, definition, buckets)
    by = [*definition.bucket] or [*definition.partition, *definition.sort[:1]]
    if by:
        rows = rows if dealt else rows.hint("rebalance", *[F.col(c) for c in by])
        if not definition.bucket:  # bucketed writes sort by themselves
            rows = rows.sortWithinPartitions(*definition.partition, *definition.sort)
    last = [c for c in rows.columns if c not in definition.partition] + list(definition.partition)
    rows.select(*last).write.insertInto(name, overwrite=True)


def open_table(spark: SparkSession, path: str, definition: Definition, buckets: int) -> DataFrame:
    """The stored table, its columns in the order of the definition; defined again if this
    session's catalog does not know it."""
    known = exists(spark, path)
    name = create(spark, path, definition, buckets)
    if definition.partition and not known:
        spark.catalog.recoverPartitions(name)
    columns = definition.schema.fieldNames()
    # toDF names the columns anew, without the table's name before them: with it, a stack of two
    # projected tables does not see that both are bucketed by the same column
    return spark.table(name).select(*columns).toDF(*columns)
