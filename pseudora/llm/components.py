"""Connected components of an edge table, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pseudora.llm.store import dropped, stored


def _parents(edges: DataFrame) -> DataFrame:
    """(node, parent): the smallest neighbour, if smaller than the node, and its own one in turn."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    near = both.groupBy("u").agg(F.min("v").alias("near"))
    first = stored(near.select(F.col("u").alias("node"), F.least("u", "near").alias("parent")), "parents")
    above = first.select(F.col("node").alias("at"), F.col("parent").alias("above"))
    jumped = first.join(above, first["parent"] == above["at"]).select("node", F.least("parent", "above").alias("parent"))
    result = stored(jumped, "parents")
    dropped(first)
    return result


def connected(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (u, v); the component is its smallest node.

    Each round hangs every node on its smallest neighbour and replaces the edges by those between
    parents, so that they become fewer quickly. Rounds grow with the logarithm of a component's
    diameter and are stored: lineage stays short, and a lost executor costs one round. Minima and
    equal edges are combined before each shuffle.
    """
    least, most = F.least("u", "v"), F.greatest("u", "v")
    left = stored(edges.where("u <> v").select(least.alias("u"), most.alias("v")).distinct(), "edges")
    labels = None
    while True:
        parents = _parents(left)
        if labels is None:
            after = stored(parents.select("node", F.col("parent").alias("component")), "labels")
        else:
            up = parents.select(F.col("node").alias("component"), "parent")
            moved = labels.join(up, "component", "left")
            after = stored(moved.select("node", F.coalesce("parent", "component").alias("component")), "labels")
            dropped(labels)
        labels = after
        if not left.limit(1).count():
            return labels
        up_u = parents.select(F.col("node").alias("u"), F.col("parent").alias("a"))
        up_v = parents.select(F.col("node").alias("v"), F.col("parent").alias("b"))
        lifted = left.join(up_u, "u").join(up_v, "v").where("a <> b")
        lifted = lifted.select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")).distinct()
        fewer = stored(lifted, "edges")
        dropped(left)
        dropped(parents)
        left = fewer
