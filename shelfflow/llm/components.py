"""Connected components of a link table by large-star and small-star rounds.

Both steps point every node at the smallest node it knows; after a few rounds each component is a star around its
smallest node. Smallest neighbours come from grouped minima (combined before the shuffle) and an
equi-join, so a node with very many links is no group of its own. Every round is written to the
shared folder, so a lost executor never repeats the earlier ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfflow.sources.staging import stage


def _to_lowest(links: DataFrame, keep_all: bool) -> DataFrame:
    """Of links ``(a, b)`` both ways round: the far ends of each ``a``, linked to the lowest node there."""
    lowest = links.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
    pointed = links.join(lowest, "a")
    ends = pointed.filter("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
    if keep_all:
        ends = pointed.filter("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
        ends = ends.union(lowest.filter("a <> low").select("a", F.col("low").alias("b")))
    return ends.filter("a <> b").distinct()


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """``node`` and ``root`` (smallest node reachable) for every node that isn't its own root.

    Links to itself and repeated links change nothing.
    """
    pairs = links.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).filter("a <> b").distinct()
    pairs, seen = stage(pairs), None
    while True:
        # Large star: larger neighbours go to the lowest neighbour; both directions count.
        both = pairs.union(pairs.select("b", "a"))
        pairs = stage(_to_lowest(both, keep_all=False))
        # Small star: smaller neighbours and the node itself go to the lowest of them.
        pairs = stage(_to_lowest(pairs, keep_all=True))
        state = pairs.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen:
            return pairs.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen = state
