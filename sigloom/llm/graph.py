"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sigloom.llm.common import cut


def connected_components(links: DataFrame) -> DataFrame:
    """(a, b) long links -> (node, component): the smallest node reachable. Nodes without links
    have no row; null ends and loops are dropped.

    A large-star step hangs each node's greater neighbours on the smallest neighbour, a
    small-star step the smaller ones: the links end as stars around the smallest nodes, after
    rounds in the order of the logarithm of a component's width. Every round is an aggregate
    and a join on nodes, cut by a checkpoint in the shared folder. The driver sees two sums.
    """
    edges = links.where("a is not null and b is not null and a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = cut(edges)
    before = None
    while True:  # every round but the last moves a node to a smaller one, so there is a last
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        hung = large.join(least, "u")
        small = hung.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v"))).where("u <> v")
        edges = cut(small.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
        now = tuple(edges.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)"))).first())
        if now == before:
            return edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component")).union(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        before = now
