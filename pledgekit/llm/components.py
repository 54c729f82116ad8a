"""Connected components of an edge table by joins alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pledgekit.runtime import stage


def _roots(parents: DataFrame) -> DataFrame:
    """(node, label): the end of each node's path over ``parents`` (node, label), which always points to lesser nodes.

    Every round a node takes its label's label, so paths halve.
    """
    while True:
        above = parents.select(F.col("node").alias("up"), F.col("label").alias("top"))
        jumped = parents.join(above, F.col("label") == F.col("up"), "left").select(
            "node", F.coalesce("top", "label").alias("label"), (F.col("top") != F.col("label")).alias("moved")
        )
        held = stage(jumped, "components-paths")
        parents = held.select("node", "label")
        if held.filter("moved").isEmpty():
            return parents


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of ``edges`` (a, b): the least node that it reaches.

    Every round, a node points to its least neighbour if that is less, paths of such pointers end at one node each, and
    both ends of every edge are replaced by these; edges within one node and repeated ones go. So the edge table
    shrinks from round to round, nodes at least halve every two rounds, and a node without a lesser neighbour
    has one after the next round unless its neighbours joined it. Each round is written to the shared folder,
    which cuts the lineage. Nothing but emptiness tests come to the driver. Self-edges and repeated
    edges are harmless; null ends are ignored.
    """
    pairs = edges.select(F.col("a").alias("a"), F.col("b").alias("b")).filter(F.col("a").isNotNull() & F.col("b").isNotNull())
    # A node's least neighbour, itself included; summed up per task, so the center of a large star is one row of each.
    ends = F.inline(F.array(F.struct(F.col("a").alias("node"), F.col("b").alias("other")), F.struct(F.col("b").alias("node"), F.col("a").alias("other"))))

    def least(open_edges: DataFrame) -> DataFrame:
        near = open_edges.select(ends).groupBy("node").agg(F.min("other").alias("other"))
        return stage(near.select("node", F.least("node", "other").alias("label")), "components-least")

    left = stage(pairs.distinct(), "components-edges")
    labels = None
    while labels is None or not left.isEmpty():
        own = _roots(least(left))
        if labels is None:
            labels = own
        else:
            up = own.select(F.col("node").alias("up"), F.col("label").alias("top"))
            moved = labels.join(up, F.col("label") == F.col("up"), "left")
            labels = stage(moved.select("node", F.coalesce("top", "label").alias("label")), "components")
        of_a = own.select(F.col("node").alias("a"), F.col("label").alias("x"))
        of_b = own.select(F.col("node").alias("b"), F.col("label").alias("y"))
        met = left.join(of_a, "a").join(of_b, "b").filter(F.col("x") != F.col("y"))
        left = stage(met.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "components-edges")
    return labels
