"""Connected components of an edge table by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textlab.llm.staging import staged


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``edges`` (``a``, ``b``, both long): the smallest node reachable.

    Each round hooks every node to the smallest of its neighbours, follows that pointer once more, and
    replaces the ends of the edges; nodes that are no local minimum vanish, so rounds grow with the
    logarithm of the nodes. Every round is written to the shared folder. Hooks are staged before they are
    joined, so that a node with very many edges is split by the planner. Self-loops and repeated edges add nothing;
    a null end drops the edge.
    """
    left = staged(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    reached = staged(left.select(F.explode(F.array("a", "b")).alias("node")).distinct().select("node", F.col("node").alias("component")), "nodes")
    while left.limit(1).count():
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hook = staged(both.groupBy("a").agg(F.least("a", F.min("b")).alias("to")), "hooks")
        once = hook.withColumnsRenamed({"a": "node", "to": "middle"})
        jump = staged(once.join(hook, once.middle == hook.a).select("node", "to"), "jumps")
        left = staged(
            left.join(jump.withColumnsRenamed({"node": "a", "to": "x"}), "a").join(jump.withColumnsRenamed({"node": "b", "to": "y"}), "b")
            .where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "edges",
        )
        reached = staged(
            reached.join(jump.withColumnRenamed("node", "component"), "component", "left")
            .select("node", F.coalesce("to", "component").alias("component")), "nodes",
        )
    return reached
