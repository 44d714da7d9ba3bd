"""Connected components of a stored table of links, by alternating large and small stars.

Each round hangs the neighbours of a node from the smallest of them. Both kinds
of star are a minimum per node and a join, so no node's neighbours are gathered
in one place, and every round's links are stored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymart.llm.support import materialise


def _large_star(links: DataFrame) -> DataFrame:
    """Larger neighbours of each node hang from the smallest of its neighbours and itself."""
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
    hung = both.join(least, "a").filter("b > a")
    return hung.select(F.col("b").alias("a"), F.col("low").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    """Smaller neighbours of each node, and the node, hang from the smallest of them."""
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    least = down.groupBy("a").agg(F.min("b").alias("low"))
    others = down.join(least, "a").filter("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return others.union(least.select("a", F.col("low").alias("b")))


def _stamp(links: DataFrame) -> tuple:
    row = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(row)


def connected(links: DataFrame) -> DataFrame:
    """``node`` and ``component`` (its smallest node) for every node of the links (a, b).

    Links may repeat; those of a node to itself and those with nulls are ignored.
    """
    links = materialise(links.filter("a <> b").select("a", "b").distinct())
    stamp = _stamp(links)
    while stamp[0]:
        links = materialise(_small_star(_large_star(links)).distinct())
        before, stamp = stamp, _stamp(links)
        if stamp == before:
            break
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        links.select("b", "b").distinct()
    )
