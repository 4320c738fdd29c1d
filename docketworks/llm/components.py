"""Connected components by alternating large-star and small-star (Kiveris et al. 2014).

Each step links neighbours of a node to the smallest of them, so edges turn into stars in a
number of rounds that grows with the logarithm of the longest chain. A neighbourhood is never
collected: its minimum is an aggregate, and the links come from a join on the node, which
adaptive execution splits where a node is hot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketworks.sources.scratch import Scratch


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    return both.join(least, "u").filter("v > u").select(
        F.col("v").alias("u"), F.least("u", "m").alias("v")
    ).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """``edges`` point from the larger to the smaller node."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    others = edges.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return others.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """``node`` and ``component`` (its smallest node), for every node of ``edges`` (u, v) but the smallest.

    Links may repeat and point either way; links of a node to itself and null ends are left
    out. Every round is stored, so a lost executor repeats one round at most.
    """
    state = None
    edges = scratch.stage(
        edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(),
        "edges",
    )
    while True:
        found = edges.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
        if found == state or found[0] == 0:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
        state = found
        edges = scratch.stage(_small_star(scratch.stage(_large_star(edges), "large-star")), "small-star")
