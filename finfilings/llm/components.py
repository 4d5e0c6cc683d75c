"""Connected components over a table of links, without gathering any of them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finfilings.llm.common import dropped, stored


def _min_of_neighbours(both: DataFrame) -> DataFrame:
    return both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))


def _stars(edges: DataFrame) -> bool:
    """Does every node that hangs on another hang on one only, with nothing on itself?"""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("hangs"), F.lit(0).alias("holds")).unionByName(
        edges.select(F.col("b").alias("node"), F.lit(0).alias("hangs"), F.lit(1).alias("holds")))
    each = ends.groupBy("node").agg(F.sum("hangs").alias("hangs"), F.max("holds").alias("holds"))
    return not each.agg(F.coalesce(F.max((F.col("hangs") > 1) | ((F.col("hangs") == 1) & (F.col("holds") == 1))), F.lit(False))).first()[0]


def connected(links: DataFrame) -> DataFrame:
    """``node, root`` for all ends of the links ``a, b``; the root is the smallest node reachable.

    Large stars and small stars in turn: each round hangs every node on a smaller one, and
    the links become stars after a number of rounds that grows with the logarithm of the
    longest chain.  Only minima are taken over a node's links, so a node with very many is
    combined before the shuffle.  Links with a null end, and of a node to itself, do not count.
    """
    edges = stored(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a is not null and b is not null and a <> b").distinct())
    while True:
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
        large = both.join(_min_of_neighbours(both), "u").where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        # small: a node and its smaller neighbours hang on the smallest of them
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
        before, edges = edges, stored(small.distinct())
        dropped(before)
        if _stars(edges):
            break
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
