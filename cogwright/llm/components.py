"""Connected components by alternating large-star and small-star rounds; links never leave the executors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """edges: (a, b) with a > b. Each node's neighbours are linked to the least of them."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else edges
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    linked = both.join(least, "a")
    if large:
        return linked.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return linked.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))


def _is_stars(edges: DataFrame) -> bool:
    ends = edges.select(F.col("a").alias("v"), F.lit(1).alias("down"), F.lit(0).alias("up")).unionByName(edges.select(F.col("b").alias("v"), F.lit(0).alias("down"), F.lit(1).alias("up")))
    return ends.groupBy("v").agg(F.sum("down").alias("down"), F.max("up").alias("up")).filter("down > 1 or (down = 1 and up = 1)").isEmpty()


def connected_components(links: DataFrame) -> DataFrame:
    """(a, b) of long ids to (node, component), the component being its least id; nodes without a link don't appear.

    The number of rounds grows with the logarithm of the longest path; each round's links are written to shared scratch.
    """
    edges = materialize(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct(), "links")
    # Done when no node has two links towards lesser nodes and none is both a centre and linked to a lesser one.
    while not _is_stars(edges):
        edges = materialize(_star(_star(edges, True).filter("a <> b"), False).filter("a <> b").distinct(), "links")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct()
