"""Helpers shared by the operators: tokenizer files, scratch tables in the
shared folder, and dealing rows into partitions in global key order."""

from __future__ import annotations

import os
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundlake.session import checkpoint_root

BYTE_BPE = "byte_bpe_50k.json"
PIECE_BPE = "piece_bpe_32k.model"


def tokenizer_path(name: str = BYTE_BPE) -> str:
    """Place of a public tokenizer file on this machine (driver or executor)."""
    import public_tokenizers

    return public_tokenizers.path(name)


def make_importable(spark: SparkSession) -> None:
    """Let Python workers import this package from the place it was loaded from, for
    sessions started elsewhere (on a cluster ship it with --py-files instead)."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [root, env.get("PYTHONPATH", "")]))


def scratch_folder(spark: SparkSession, what: str) -> str:
    """A fresh folder under the shared checkpoint folder (a URI or a plain path)."""
    return f"{checkpoint_root(spark)}/fundlake-llm/{what}-{uuid.uuid4().hex}"


def cut(df: DataFrame, what: str) -> DataFrame:
    """Write to the shared folder and read back: cuts lineage, survives lost executors."""
    path = scratch_folder(df.sparkSession, what)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def in_key_order(df: DataFrame, key: str) -> tuple[DataFrame, int, str]:
    """Number the rows' range of a whole-number key, ascending, in a new column.

    The range limits are quantiles of the key column alone, one range per shuffle
    partition, so only that column is read for them and the driver gets one
    number per partition.  Returns the frame, the number of ranges and the new
    column's name.  Null keys go to range 0, before every other key.
    """
    n = shuffle_partitions(df.sparkSession)
    name = fresh_name(df.columns, "_range")
    limits: list[int] = []
    if n > 1:
        at = [i / n for i in range(1, n)]
        got = df.agg(F.percentile_approx(F.col(key), at, 100 * n).alias("q")).first()["q"]
        limits = sorted(set(got or []))
    return df.withColumn(name, F.expr(_search(quoted(key), limits, 0))), len(limits) + 1, name


def _search(key: str, limits: list[int], base: int) -> str:
    """SQL text of a binary search: how many limits lie below the key."""
    if not limits:
        return str(base)
    mid = len(limits) // 2
    low, high = _search(key, limits[:mid], base), _search(key, limits[mid + 1:], base + mid + 1)
    return f"CASE WHEN {key} > {limits[mid]}L THEN {high} ELSE {low} END"


def salted_join(left: DataFrame, right: DataFrame, on: list[str], slices: int = 1000) -> DataFrame:
    """Left join of many rows with a right side that has one row per key, hot keys dealt out.

    A key with more than one in ``slices`` of the left rows is dealt over as many parts as it
    has such shares, and its right row is copied to each.  At most ``slices`` keys are that
    hot, so their list is small whatever the size of the tables.
    """
    total = F.lit(max(1, left.count()))
    hot = (left.groupBy(*on).count().filter(F.col("count") * slices > total)
           .select(*on, F.ceil(F.col("count") * slices / total).cast("int").alias("_parts")))
    hot = F.broadcast(cut(hot, "hot-keys"))
    part = F.floor(F.rand(0) * F.coalesce("_parts", F.lit(1))).cast("int")
    dealt = left.join(hot, on, "left").withColumn("_part", part).drop("_parts")
    copied = right.join(hot, on, "left").withColumn("_part", F.explode(F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1)))
    return dealt.join(copied.drop("_parts"), [*on, "_part"], "left").drop("_part")


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def fresh_name(taken: list[str], name: str) -> str:
    have = {c.lower() for c in taken}
    while name.lower() in have:
        name = "_" + name
    return name


class Rows:
    """Collects output rows and hands them out as record batches of bounded size."""

    def __init__(self, schema: pa.Schema, most_bytes: int = 16 << 20, most_rows: int = 20_000):
        self.schema, self.most_bytes, self.most_rows = schema, most_bytes, most_rows
        self.clear()

    def clear(self) -> None:
        self.columns: list[list] = [[] for _ in self.schema]
        self.size = 0

    def add(self, *values, size: int = 64) -> None:
        for c, v in zip(self.columns, values):
            c.append(v)
        self.size += size

    def full(self) -> bool:
        return self.size >= self.most_bytes or len(self.columns[0]) >= self.most_rows

    def take(self) -> pa.RecordBatch:
        batch = pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(self.columns, self.schema)], schema=self.schema)
        self.clear()
        return batch
