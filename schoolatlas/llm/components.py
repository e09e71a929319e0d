"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from schoolatlas.llm.common import store


def _round(edges: DataFrame, small: bool) -> DataFrame:
    """One star step: every node's neighbours (its larger ones, or its others and itself) go to their least."""
    both = edges if small else edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    # small: edges point from a node a to a smaller b.
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
    joined = both.join(least, "a")
    if small:
        out = joined.select(F.col("b").alias("x"), "least").unionByName(least.select(F.col("a").alias("x"), "least"))
    else:
        out = joined.filter("b > a").select(F.col("b").alias("x"), "least")
        # A node whose neighbours are all smaller keeps its edge to the least of them.
        out = out.unionByName(least.filter("least < a").select(F.col("a").alias("x"), "least"))
    return out.filter("x > least").select(F.col("x").alias("a"), F.col("least").alias("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of the (a, b) edges; the component is its least node.

    The number of rounds grows with the logarithm of the longest path; each round's edges are stored.
    """
    state = store(
        edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )
    mark = None
    while True:
        state = store(_round(state, small=False))
        state = store(_round(state, small=True))
        row = state.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if tuple(row) == mark:
            break
        mark = tuple(row)
    roots = state.select(F.col("b").alias("node")).distinct()
    return state.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        roots.select("node", F.col("node").alias("component"))
    )
