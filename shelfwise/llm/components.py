"""Connected components of a graph of links, by contraction to stars.

Each round points the larger neighbours of a node to its smallest one, then the smaller ones of a
node to their smallest, until every node hangs on the smallest of its component. Rounds grow with
the logarithm of the longest path. Nodes are numbers; a hub is one row per link, never one group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from shelfwise.llm.scratch import cut


def components(links: DataFrame) -> DataFrame:
    """id and component (its smallest id) for every node of the links (a, b)."""
    edges = cut(links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = None
    while before != (now := edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()) and now[0]:
        before = now
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        lowest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(lowest, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = cut(small.unionByName(lowest.select("a", F.col("m").alias("b"))).distinct())
    return edges.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(
        edges.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct())
