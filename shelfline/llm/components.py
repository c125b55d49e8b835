"""Connected components by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from shelfline.session import kept


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node of its component, for all nodes of links (a, b).

    Each round hangs every smaller neighbour of a node and the node itself on its smallest neighbour
    (small star), then every larger one (large star): about log(n) rounds. Links that have become stars
    need none: there a node has larger neighbours only or a single one. A round is two aggregates with
    map-side combining and two joins; one truth value reaches the driver. Links may repeat; null ends and
    loops are left out.
    """
    edges = links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    edges = kept(edges.distinct())
    while not _stars(edges):
        low = edges.groupBy("u").agg(F.min("v").alias("m"))
        small = edges.join(low, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.union(low.select("u", "m"))
        low = _both_ways(small).groupBy("u").agg(F.min("v").alias("m"))
        # Written, so that a small one is broadcast and else both sides come straight from a shuffle: Spark can split a hub.
        low = kept(low.select(F.col("u").alias("v"), F.least("u", "m").alias("m")))
        edges = kept(small.join(low, "v").select("u", F.col("m").alias("v")).distinct())
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _both_ways(edges: DataFrame) -> DataFrame:
    """Each edge (u, v) from both of its ends."""
    return edges.select(F.inline(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))))


def _stars(edges: DataFrame) -> bool:
    """Whether edges from larger to smaller nodes are stars around their smallest nodes."""
    ends = _both_ways(edges).groupBy("u").agg(F.min("v").alias("least"), F.max("v").alias("most"))
    return not ends.agg(F.expr("bool_or(least < u and least < most)")).first()[0]
