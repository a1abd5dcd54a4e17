"""Connected components of a table of links, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..sources.staging import stage


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest one (or to itself, if it is smaller)."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u > v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u > v")
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """(u, root) for every node of `links` (two columns) that is not itself the smallest of its component.

    Rounds grow with the logarithm of the nodes; each is written to the shared folder, so a lost executor
    costs a part of one round. A node with most links is an ordinary join key here, counted on the map side
    and split by adaptive execution. Links of a node to itself and repeated ones do no harm.
    """
    a, b = links.columns
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u > v").distinct()
    edges, seen = stage(edges), None
    while True:
        edges = stage(_small_star(_large_star(edges)))
        now = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()  # one row
        if now == seen:
            return edges.withColumnRenamed("v", "root")
        seen = now
