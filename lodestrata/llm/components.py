"""Connected components by alternating large-star and small-star steps, each a shuffle on the node."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .storage import cut


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step over edges (u, v): each node's neighbours are tied to the least of them (and of the node itself)."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    tied = both.join(least, "u")
    if large:
        return tied.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
    own = least.select("u", F.col("m").alias("v"))
    return tied.select(F.col("v").alias("u"), F.col("m").alias("v")).union(own).where("u <> v").distinct()


def _tangled(edges: DataFrame) -> bool:
    """Whether any node has two edges up, or edges both up and down: else each component is a star around its least node."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(edges.select("v", F.lit(0), F.lit(1)))
    per_node = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return not per_node.where("up > 1 or up = 1 and down = 1").isEmpty()


def components(links: DataFrame, nodes: DataFrame) -> DataFrame:
    """(fp, component): for each fp of ``nodes`` (fp, least), the smallest ``least`` in its component under ``links`` (a, b).

    Edges stay at most as many as they were, and a hub's edges are tied to its least neighbour, so no node gathers
    its component. Runs until every component is a star.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    while _tangled(edges):
        edges = cut(_star(_star(edges, large=True), large=False))
    root = edges.select(F.col("u").alias("fp"), F.col("v").alias("root"))
    rooted = nodes.join(root, "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    best = rooted.join(root.select("root").distinct(), "root", "left_semi").groupBy("root").agg(F.min("least").alias("best"))
    return rooted.join(best, "root", "left").select("fp", F.coalesce("best", "least").alias("component"))
