"""Connected components of a graph given as a table of edges, by large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citeloom.llm.common import drop_staged, stage


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Link each node's larger (or smaller) neighbours to the smallest node around it."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else edges
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    near = both.join(least, "a")
    if large:
        linked = near.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        linked = near.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
    return linked.filter("a != b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the smallest node it reaches) for every node of the edges (a, b)."""
    pair = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a != b")
    current = stage(pair.distinct(), "edges")
    while True:
        # Each edge points from the larger to the smaller node.
        after = stage(_star(_star(current, large=True), large=False), "edges")
        changed = current.exceptAll(after).isEmpty() and after.exceptAll(current).isEmpty()
        drop_staged(current)
        current = after
        if changed:
            break
    nodes = current.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return stage(nodes.unionByName(current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()), "components")
