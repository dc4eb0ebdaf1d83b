"""Connected components of a list of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.session import settle


def _both_ways(links: DataFrame) -> DataFrame:
    return links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the least of the node and its neighbours."""
    near = _both_ways(links)
    least = near.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("_m"))
    return near.where("b > a").join(least, "a").where("b <> _m").select(F.col("_m").alias("a"), "b").distinct()


def _small(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the least of these (links have a < b)."""
    least = links.groupBy("b").agg(F.min("a").alias("_m"))
    moved = links.join(least, "b").where("a <> _m").select(F.col("_m").alias("a"), F.col("a").alias("b"))
    return moved.unionByName(least.select(F.col("_m").alias("a"), "b")).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node that a link (a long, b long) names; a component is its least node.

    Each round is two group-and-join steps over the links, stored in the shared folder; the number of
    rounds grows with the logarithm of the longest chain. Nothing but one checksum a round leaves the
    cluster. Self-links and repeated links are ignored; no links give no rows.
    """
    current = settle(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct())
    mark = None
    while True:
        seen = current.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
        if seen["n"] == 0 or (seen["n"], seen["s"]) == mark:
            break
        mark = (seen["n"], seen["s"])
        current = settle(_small(settle(_large(current))))
    return current.select(F.col("b").alias("node"), F.col("a").alias("component")).unionByName(
        current.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct()
    )
