"""Connected components of a pair table, as Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def components(edges: DataFrame) -> DataFrame:
    """Components of the graph of ``edges(a long, b long)``.

    Returns ``(node_key, component)``: ``node_key`` is ``xxhash64(node)``,
    which is one-to-one on longs, and ``component`` the key of one node of the
    component.  Nodes without an edge to another node do not appear.

    Each round maps every node to the smallest key among itself and its
    neighbours and rewrites the edges to those; edges inside a merged group
    vanish.  Keys are hashes, so also a long path shrinks by a constant factor
    a round.  The smallest neighbour is a partial aggregate (a hub costs one
    row a task), each round is a written table, and the rounds end when
    no edge is left.
    """
    key = F.xxhash64
    left = (edges.where(F.col("a") != F.col("b"))
            .select(key("a").alias("a"), key("b").alias("b"))
            .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    left = written(left)
    rounds: list[DataFrame] = []
    while not left.isEmpty():
        both = left.select(F.col("a").alias("node"), F.col("b").alias("other")).unionByName(
            left.select(F.col("b").alias("node"), F.col("a").alias("other")))
        step = written(both.groupBy("node").agg(F.min("other").alias("least_other"))
                           .select("node", F.least("node", "least_other").alias("parent")))
        rounds.append(step)
        for side in ("a", "b"):
            left = (left.join(step, left[side] == step["node"])
                    .drop(side, "node").withColumnRenamed("parent", side))
        left = written(left.where(F.col("a") != F.col("b"))
                           .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    if not rounds:
        return left.select(F.col("a").alias("node_key"), F.col("b").alias("component"))
    labels = rounds[-1].select(F.col("node").alias("node_key"), F.col("parent").alias("component"))
    for step in reversed(rounds[:-1]):
        above = labels.select(F.col("node_key").alias("parent"), F.col("component").alias("top"))
        labels = step.join(above, "parent", "left").select(
            F.col("node").alias("node_key"), F.coalesce("top", "parent").alias("component"))
    return labels
