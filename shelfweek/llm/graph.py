"""Connected components of a table of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfweek.llm.common import sized, staged

LINK_BYTES = 16


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the least node of its neighbourhood."""
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("least")).select("u", F.least("u", "least").alias("least"))
    return both.where(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), F.col("least").alias("v")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are linked to the least of them. Links point from larger to smaller."""
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v")
    least = down.groupBy("u").agg(F.min("v").alias("least"))
    moved = down.join(least, "u").where("v <> least").select(F.col("v").alias("u"), F.col("least").alias("v"))
    return moved.unionByName(least.select("u", F.col("least").alias("v"))).distinct()


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (u, v); the component is its least node.

    Each round is written to the shared folder, so lost executors repeat one round at most. A star is final after one
    round; long chains shrink geometrically.
    """
    distinct = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct()
    current = staged(sized(distinct, links.count(), LINK_BYTES), "links")
    before = _state(current)
    while before[0]:
        # Either star leaves at most one link for each link and node it has.
        current = staged(sized(_small_star(_large_star(current)), 4 * before[0], LINK_BYTES), "links")
        after = _state(current)
        if after == before:
            break
        before = after
    members = current.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return members.unionByName(current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
