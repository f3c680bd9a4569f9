"""Connected components by contraction of trees of smallest neighbours."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small, written


def _up(tree: DataFrame) -> DataFrame:
    return small(tree.select(F.col("node").alias("_n"), F.col("to").alias("_t")))


def _moved(edges: DataFrame, up: DataFrame) -> DataFrame:
    """The edges (a, b) between the nodes that ``up`` leads theirs to."""
    for c, other in (("a", "b"), ("b", "a")):
        edges = edges.join(up, F.col(c) == F.col("_n"), "left").select(F.coalesce("_t", c).alias(c), other)
    return edges.filter("a <> b").select("a", "b")


def _trees(e: DataFrame) -> DataFrame:
    """(node, to): every node of the edges and the smallest node of its tree.
    The trees are made of the edges to each node's smallest neighbour."""
    both = e.select(F.col("a").alias("node"), F.col("b").alias("to")).unionByName(
        e.select(F.col("b").alias("node"), F.col("a").alias("to")))
    least = written(both.groupBy("node").agg(F.min("to").alias("to")), "cc_least")
    # two nodes lead to each other at the end of all paths: every second node of
    # a path is not larger, so the smaller one of the two is the tree's smallest
    mutual = (F.col("_t") == F.col("node")) & (F.col("node") < F.col("to"))
    tree = written(least.join(_up(least), F.col("to") == F.col("_n"))
                   .select("node", F.when(mutual, F.col("node")).otherwise(F.col("to")).alias("to")), "cc_tree")
    while True:  # paths get half as long
        tree = written(tree.join(_up(tree), F.col("to") == F.col("_n"))
                       .select("node", F.col("_t").alias("to"), (F.col("_t") != F.col("to")).alias("moved")), "cc_tree")
        if not tree.filter("moved").limit(1).count():
            return tree.select("node", "to")


def components(links: DataFrame, told: DataFrame | None = None) -> DataFrame:
    """(node, root) of every node with a link ``(a, b)``; the root is the
    component's smallest node. ``told`` has the written components of earlier
    links, which then count as well. A round leaves at most half of the nodes
    that have an edge, and no star's edges meet in one task other than as
    partial minima; links may be repeated."""
    known = None if told is None else told.select("node", F.col("root").alias("to"))
    e = written(links.filter("a <> b").select("a", "b") if known is None else _moved(links, _up(known)), "cc")
    out = known
    while e.limit(1).count():
        tree = _trees(e)
        up = _up(tree)
        if out is None:
            out = tree
        else:
            new = out.join(up, F.col("to") == F.col("_n"), "left").select("node", F.coalesce("_t", "to").alias("to"))
            if known is not None:  # nodes of the new links alone
                new = new.unionByName(tree.join(_up(known), F.col("node") == F.col("_n"), "left_anti"))
                known = None
            out = written(new, "cc_told")
        e = written(_moved(e, up), "cc")
    if out is None:
        out = e.select(F.col("a").alias("node"), F.col("b").alias("to"))
    return out.select("node", F.col("to").alias("root"))
