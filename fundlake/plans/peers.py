"""Peer groups.

Peers are the tickers of the whole register that share sector, subsector
and segment, the ticker itself included.  The result is a membership table
-- one row per ticker with its group and the group's size, which is an
aggregation joined back -- instead of a self-join that would emit every
pair of a group (quadratic in the largest group).  The peers of given
tickers are a semi-join of the register on their groups.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundlake.sources.catalog import Tables

GROUP = ["sector", "subsector", "segment"]


def peer_groups(tables: Tables) -> DataFrame:
    t = tables.tickers.select("ticker", *GROUP)
    sizes = t.groupBy(*GROUP).agg(F.count(F.lit(1)).alias("n_peers"))
    return t.join(sizes, GROUP).select("ticker", *GROUP, "n_peers")


def leaders(tables: Tables, by: list[str] | None = None) -> DataFrame:
    """One ticker per sector (or other columns of the register): the smallest one."""
    by = by or ["sector"]
    return tables.tickers.groupBy(*by).agg(F.min("ticker").alias("ticker")).select("ticker", *by)


def get_peers(tables: Tables, tickers: list[str] | DataFrame) -> DataFrame:
    """The tickers that share a group with one of the given tickers (a list, or rows with a column
    ``ticker``), with that group."""
    t = tables.tickers.select("ticker", *GROUP)
    if isinstance(tickers, DataFrame):
        mine = t.join(tickers.select("ticker").distinct(), "ticker", "left_semi")
    else:
        mine = t.filter(F.col("ticker").isin(*[x.upper() for x in tickers]))
    return t.join(mine.select(*GROUP).distinct(), GROUP, "left_semi").select("ticker", *GROUP)
