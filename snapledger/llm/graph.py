"""Connected components by contraction, wholly in joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapledger.llm.storage import discard, stored


def _parents(edges: DataFrame) -> DataFrame:
    """For each node the smallest of itself and its neighbours, followed to the end."""
    both = edges.select(F.col("a").alias("node"), F.col("b").alias("other")).unionByName(edges.select(F.col("b").alias("node"), F.col("a").alias("other")))
    parents = stored(both.groupBy("node").agg(F.min("other").alias("least")).select("node", F.least("node", "least").alias("parent")))
    while True:
        above = parents.select(F.col("node").alias("parent"), F.col("parent").alias("grand"))
        lifted = stored(parents.join(above, "parent").select("node", F.col("grand").alias("parent"), (F.col("grand") != F.col("parent")).alias("moved")))
        discard(parents)
        parents = lifted
        if lifted.where("moved").isEmpty():
            return lifted


def components(edges: DataFrame) -> DataFrame:
    """(node, component): for each node of ``edges`` (a, b; not null) the smallest node that it reaches.

    A round hooks each node to its smallest neighbour, follows these pointers to their ends and keeps the edges between
    different ends; each at least halves the nodes that are left. All of it stays in tables; a node with many edges is an
    aggregate and a join key that Spark may split.
    """
    def between(rows: DataFrame) -> DataFrame:
        return rows.where(F.col("a") != F.col("b")).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()

    left, found = stored(between(edges)), None
    while found is None or not left.isEmpty():
        parents = _parents(left)
        if found is None:
            found = stored(parents.select("node", F.col("parent").alias("component")))
        else:
            step, last = parents.select(F.col("node").alias("component"), "parent"), found
            found = stored(last.join(step, "component", "left").select("node", F.coalesce("parent", "component").alias("component")))
            discard(last)
        ends = left.join(parents.select(F.col("node").alias("a"), F.col("parent").alias("x")), "a").select("b", "x")
        ends = ends.join(parents.select(F.col("node").alias("b"), F.col("parent").alias("y")), "b")
        past, left = left, stored(between(ends.select(F.col("x").alias("a"), F.col("y").alias("b"))))
        discard(past, parents)
    return found
