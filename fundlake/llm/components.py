"""Connected components of an edge table, by alternating star contractions.

Every round rewrites the edges with two joins and writes them to the shared
folder, so lineage stays short and a lost executor costs one round.  Only a
row count and a hash of the edges come to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundlake.llm.common import cut


def _starred(edges: DataFrame) -> DataFrame:
    """One large-star and one small-star step; edges (u, v) with u > v."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    least = large.groupBy("u").agg(F.min("v").alias("m"))
    small = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return small.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def _state(edges: DataFrame) -> tuple:
    r = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(r)


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) for every node of an edge; root is the smallest node reachable.
    Self-edges and nulls are ignored; an empty table gives an empty result."""
    now = cut(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u > v").distinct(), "edges")
    state = _state(now)
    while state[0]:
        now = cut(_starred(now), "edges")
        new = _state(now)
        if new == state:
            break
        state = new
    roots = now.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
