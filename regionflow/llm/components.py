"""Connected components of an edge table, by rounds of contraction. Nothing is gathered on the driver."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regionflow.llm.common import cut


def connected_components(edges: DataFrame) -> DataFrame:
    """edges (a, b: long) -> (node, root): one row per node that has an edge to another, root the same within a component.

    Each round sends every node to the least of its neighbours and itself, then redraws the edges between what is
    left. Nodes are ordered by a one-to-one hash, so a long chain of ascending ids shrinks as fast as any other
    graph: by a constant factor a round, in expectation. Minima are combined before the shuffle; each round's tables
    are cut. Loops and repeated edges are ignored; no edges give an empty result.
    """
    h = edges.where("a <> b").select("a", "b", F.xxhash64("a").alias("x"), F.xxhash64("b").alias("y"))
    names = cut(h.select("a", "x").union(h.select("b", "y")).distinct())
    left = cut(h.select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).distinct())
    levels = []
    while not left.isEmpty():
        both = left.union(left.select("y", "x"))
        to = cut(both.groupBy("x").agg(F.min("y").alias("y")).select("x", F.least("x", "y").alias("to")))
        levels.append(to)
        moved = (
            left.join(to, "x")
            .select(F.col("to").alias("p"), F.col("y").alias("x"))
            .join(to, "x")
            .select("p", F.col("to").alias("q"))
            .where("p <> q")
        )
        left = cut(moved.select(F.least("p", "q").alias("x"), F.greatest("p", "q").alias("y")).distinct())
    if not levels:
        return names.select(F.col("a").alias("node"), F.col("x").alias("root"))

    def through(later: DataFrame, level: DataFrame) -> DataFrame:
        then = later.select(F.col("x").alias("to"), F.col("to").alias("end"))
        return level.join(then, "to", "left").select("x", F.coalesce("end", "to").alias("to"))

    return names.join(reduce(through, reversed(levels)), "x").select(F.col("a").alias("node"), F.col("to").alias("root"))
