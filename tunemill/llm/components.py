"""Connected components of a table of links, without gathering them anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunemill.llm.common import Shelf


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``component``, its smallest reachable node, for all nodes of ``links`` (``a``, ``b``).

    Each round, every node's neighbours are linked to the smallest among them:
    first the larger ones (which shortens paths), then the smaller ones (which
    gathers stars), until nothing changes.  Rounds grow with the logarithm of
    the longest path.  The minimum is aggregated before the shuffle and joined
    back, so a node with very many links is no single task.
    """
    shelf = Shelf(links.sparkSession)
    edges = shelf.put(_both_ways(links.where(F.col("a") != F.col("b"))))
    while True:
        large = shelf.put(_both_ways(_to_smallest(edges, larger=True)))
        edges_next = shelf.put(_both_ways(_to_smallest(large, larger=False)))
        same = (
            edges_next.count() == edges.count()
            and edges_next.join(edges, ["a", "b"], "left_anti").isEmpty()
        )
        shelf.drop(edges, large)
        edges = edges_next
        if same:
            break
    return edges.groupBy(F.col("a").alias("node")).agg(F.least(F.col("a"), F.min("b")).alias("component"))


def _both_ways(links: DataFrame) -> DataFrame:
    pairs = F.array(F.struct(F.col("a"), F.col("b")), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))
    return links.select(F.inline(pairs)).distinct()


def _to_smallest(edges: DataFrame, larger: bool) -> DataFrame:
    """Links from each node's neighbours to the smallest of the node and its neighbours."""
    least = edges.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("least"))
    joined = edges.join(least, "a")
    own = joined.select(F.col("a"), F.col("least").alias("b"))
    others = joined.where(F.col("b") > F.col("a") if larger else F.col("b") < F.col("a"))
    moved = others.select(F.col("b").alias("a"), F.col("least").alias("b"))
    return (moved if larger else moved.unionByName(own)).where(F.col("a") != F.col("b")).distinct()
