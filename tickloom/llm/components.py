"""Connected components of a graph of long-valued nodes, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tickloom.session import stage


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the smallest of its neighbours and itself."""
    both = edges.union(edges.select("b", "a")).toDF("a", "b")
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
    return both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the smallest of them; ``a`` is the larger end."""
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    moved = edges.join(least, "a").filter("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return moved.union(least.select("a", "least")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``(node, label)`` of every node of ``edges (a, b)``; the label is the component's smallest node.

    Each round is a few joins and aggregations over the edges that are left, at most one per node and
    round beyond the first; its result is written, so a lost executor costs one round. Ends when a
    round changes nothing. No edges: an empty result.
    """
    ordered = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    current, seen = stage(ordered.distinct(), "edges"), None
    while True:
        mark = current.agg(F.count("*"), F.expr("bit_xor(xxhash64(a, b))")).first()
        if mark == seen:
            break
        seen = mark
        current = stage(_small_star(_large_star(current)), "edges")
    inner = current.select(F.col("a").alias("node"), F.col("b").alias("label"))
    return inner.union(current.select("b", "b")).distinct()
