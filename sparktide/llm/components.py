"""Connected components of an edge table by contraction.

A round hooks every node to its smallest neighbour, follows those pointers
twice, and replaces the ends of every edge by what they now point to. Edges
inside one node vanish, so the table shrinks with each round; no node's
neighbours are ever gathered, only their minimum.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparktide.workspace import materialise


def _jump(hooks: DataFrame) -> DataFrame:
    """Every pointer replaced by the pointer of what it points to."""
    over = hooks.select(F.col("node").alias("hook"), F.col("hook").alias("over"))
    jumped = hooks.join(over, "hook", "left")
    return materialise(jumped.select("node", F.coalesce("over", "hook").alias("hook")), "hooks")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a, b); root is the smallest node that can be reached."""
    edges = materialise(edges.where("a <> b").select("a", "b").distinct(), "edges")
    roots = None
    while not edges.isEmpty():
        both = edges.select(F.col("a").alias("node"), F.col("b").alias("other")).union(
            edges.select(F.col("b").alias("node"), F.col("a").alias("other"))
        )
        least = both.groupBy("node").agg(F.min("other").alias("other"))
        hooks = materialise(least.select("node", F.least("node", "other").alias("hook")), "hooks")
        hooks = _jump(_jump(hooks))
        if roots is None:
            roots = hooks.select("node", F.col("hook").alias("root"))
        else:
            after = hooks.select(F.col("node").alias("root"), "hook")
            roots = materialise(
                roots.join(after, "root", "left").select("node", F.coalesce("hook", "root").alias("root")), "roots"
            )
        first = hooks.select(F.col("node").alias("a"), F.col("hook").alias("new_a"))
        second = hooks.select(F.col("node").alias("b"), F.col("hook").alias("new_b"))
        moved = edges.join(first, "a").join(second, "b").where("new_a <> new_b")
        edges = materialise(
            moved.select(F.least("new_a", "new_b").alias("a"), F.greatest("new_a", "new_b").alias("b")).distinct(),
            "edges",
        )
    if roots is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots
