"""Connected components by alternating star steps over an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waybill.llm.scratch import Scratch

MAX_ROUNDS = 100


def _both(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Every greater neighbour of a node is tied to the least node around it."""
    near = _both(edges)
    least = near.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return near.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its lesser neighbours are tied to the least of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").filter("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionAll(least.select("a", F.col("m").alias("b")))


def connected(links: DataFrame, scratch: Scratch) -> DataFrame:
    """`node`, `label` for every node of the links `a`, `b`; the label is the
    least node of the component. Nodes may have any type that has an order.

    A step costs two joins over the edges, and the number of steps grows with
    the logarithm of the longest path. Sums over a hub's edges are combined
    before the shuffle, and skewed joins are split by adaptive execution.
    """
    oriented = links.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges, state = scratch.store(oriented.distinct(), "edges"), None
    for _ in range(MAX_ROUNDS):
        step = scratch.store(_small_star(_large_star(edges).distinct()).distinct(), "edges")
        now = step.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        scratch.drop(edges)
        edges = step
        if now == state:
            break
        state = now
    else:
        raise RuntimeError("components have not settled")
    roots = edges.select(F.col("b").alias("a"), "b").distinct()
    return edges.unionAll(roots).select(F.col("a").alias("node"), F.col("b").alias("label"))
