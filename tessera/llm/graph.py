"""Connected components of a graph too large for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import materialise


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of the edges ``(a, b)``; the root is the smallest node
    of the component.  Edges may repeat or be loops; nulls are left out.

    Contraction: each node hooks to its smallest neighbour, chains of hooks are shortened by
    joining them with themselves, and the edges between different ends are the next, smaller
    graph.  Every round is written out, so lineage stays short and a lost executor costs a
    part of one round."""
    edges = materialise(edges.where("a < b or a > b").select("a", "b"))
    rounds = []
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hooks = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("up"))
        for _ in range(2):
            next_ = hooks.select(F.col("a").alias("up"), F.col("up").alias("upper"))
            hooks = materialise(hooks.join(next_, "up").select("a", F.col("upper").alias("up")))
        rounds.append(hooks)
        near = edges.join(hooks, "a").select(F.col("up").alias("a"), "b")
        far = hooks.select(F.col("a").alias("b"), "up")
        edges = materialise(near.join(far, "b").select("a", F.col("up").alias("b")).where("a <> b")
                            .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    if not rounds:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    found = rounds[0].select(F.col("a").alias("node"), F.col("up").alias("root"))
    for hooks in rounds[1:]:
        step = hooks.select(F.col("a").alias("root"), "up")
        found = found.join(step, "root", "left").select("node", F.coalesce("up", "root").alias("root"))
    return found
