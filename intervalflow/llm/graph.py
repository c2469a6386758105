"""Connected components of a large edge list by repeated hooking to the smallest neighbour.

Every step is a grouped minimum (which combines before the shuffle) or an equi-join (which
adaptive execution splits where a key is hot); no step gathers a node's neighbours.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import stage


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``edges(a, b)``: the smallest node reachable.

    Each round hooks the roots of both ends of an edge to the smaller root, then halves the paths
    until every node points at a root; edges inside one component go.  Rounds grow with the
    logarithm of the longest path.  Loops and repeated edges are allowed; nulls are dropped.  Each
    step is a table in the shared folder.
    """
    edges = (edges.where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
             .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    edges = stage(edges, "edges")
    parent = (edges.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("component"))
              .unionByName(edges.select(F.col("a").alias("node"), F.col("a").alias("component")))
              .groupBy("node").agg(F.min("component").alias("component")))
    parent = _flatten(parent)
    while True:
        edges = stage(_roots(edges, parent), "edges")
        if edges.isEmpty():
            return parent
        hook = edges.groupBy(F.col("b").alias("root")).agg(F.min("a").alias("to"))
        parent = _flatten(parent.join(stage(hook, "hooks"), F.col("component") == F.col("root"), "left")
                          .select("node", F.coalesce("to", "component").alias("component")))


def _roots(edges: DataFrame, parent: DataFrame) -> DataFrame:
    """Edges between the roots of their ends, without loops."""
    pa = parent.select(F.col("node").alias("a"), F.col("component").alias("ra"))
    pb = parent.select(F.col("node").alias("b"), F.col("component").alias("rb"))
    return (edges.join(pa, "a").join(pb, "b").where("ra <> rb")
            .select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct())


def _flatten(parent: DataFrame) -> DataFrame:
    """Point every node at its root.  Parents are never larger than their children, so there are no cycles."""
    while True:
        parent = stage(parent, "parents")
        up = (parent.select("component").distinct()
              .join(parent.select(F.col("node").alias("component"), F.col("component").alias("up")), "component")
              .where("up <> component"))
        up = stage(up, "parents")
        if up.isEmpty():
            return parent
        parent = (parent.join(up, "component", "left")
                  .select("node", F.coalesce("up", "component").alias("component")))
