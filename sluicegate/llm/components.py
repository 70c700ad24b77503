"""Connected components of links, as joins and minima that no hub can overload."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluicegate.llm.common import stored


def _minima(links: DataFrame) -> DataFrame:
    """Per node, the smallest of itself and its neighbours; combined before the shuffle."""
    return links.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))


def _larger_to_minimum(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's minimum instead."""
    both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    joined = both.join(_minima(both), "u").filter("v > u")
    return joined.select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v").distinct()


def _smaller_to_minimum(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to their minimum."""
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    joined = down.join(_minima(down), "u")
    moved = joined.select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(joined.select("u", F.col("m").alias("v"))).filter("u != v").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (u, v: bigint) that is not its own root.

    The root is the smallest node reachable.  Alternating the two steps turns each
    component into a star in about log(diameter) rounds; each round is stored, so a lost
    executor costs one round.  Empty links give no rows; self links and repeats are fine.
    """
    now, before = stored(links.select("u", "v").filter("u != v").distinct(), "links"), None
    while True:
        count, digest = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if not count or (count, digest) == before:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = (count, digest)
        now = stored(_smaller_to_minimum(_larger_to_minimum(now)), "links")
