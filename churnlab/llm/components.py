"""Connected components by alternating large and small stars.

Links are a table of (a, b); each round rewrites them so that they point to
smaller ids, with counts and minima aggregated before the shuffle. Rounds are
written out, which cuts lineage; nothing but a count and a checksum of the
links comes to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlab.session import cut_lineage


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's least neighbour."""
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return (both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .where("a != b").distinct())


def _small_star(links: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are linked to the least."""
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    up = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b")
    return up.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """(a, root): for every node with a link to a smaller one, the least node it
    can reach. ``links`` has two columns of one type, ``a`` and ``b``; loops and
    repeated links are allowed. Nodes that are their own root are not listed."""
    links = cut_lineage(links.select("a", "b").where("a != b").distinct(), "links")
    state = _state(links)
    while state[0]:
        links = cut_lineage(_small_star(_large_star(links)), "links")
        before, state = state, _state(links)
        if before == state:
            break
    return links.select("a", F.col("b").alias("root"))
