"""Connected components of a link table by alternating stars, all on Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from odflow.sources.scratch import materialize


def _minimum_per(edges: DataFrame, node: str, other: str, label: str) -> DataFrame:
    """The smallest neighbour of every node, as a written table.

    Written, so that the join against it shuffles both sides on their own: a node with
    very many links can then be split.
    """
    least = edges.groupBy(node).agg(F.min(other).alias("least"))
    return materialize(least.withColumnRenamed(node, "_node"), label)


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the smallest of them all."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = _minimum_per(both, "a", "b", "large-star")
    return (
        both.filter(F.col("b") > F.col("a"))
        .join(least, F.col("a") == F.col("_node"))
        .select(F.col("b").alias("a"), F.least("least", "a").alias("b"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them."""
    least = _minimum_per(edges, "a", "b", "small-star")
    linked = edges.join(least, F.col("a") == F.col("_node")).select(
        F.col("b").alias("a"), F.col("least").alias("b")
    )
    own = least.select(F.col("_node").alias("a"), F.col("least").alias("b"))
    return linked.filter(F.col("a") != F.col("b")).union(own).distinct()


def _fingerprint(edges: DataFrame) -> tuple:
    """Number of links and a sum over their hashes: one row for the driver."""
    row = edges.agg(
        F.count("*"), F.sum((F.xxhash64("a", "b") % (1 << 40)).cast("decimal(38,0)"))
    ).first()
    return tuple(row)


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, component)`` of every node with a link to another node.

    The component is the smallest node that can be reached. The loop ends when the
    stars no longer change; their number of rounds grows with the logarithm of the
    longest path.
    """
    pair = links.filter(F.col(a) != F.col(b)).select(
        F.greatest(a, b).alias("a"), F.least(a, b).alias("b")
    )
    edges = materialize(pair.distinct(), "links")
    before = _fingerprint(edges)
    while before[0]:
        edges = materialize(_large_star(edges), "links")
        edges = materialize(_small_star(edges), "links")
        now = _fingerprint(edges)
        if now == before:
            break
        before = now
    stars = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component"))
    return stars.union(roots.distinct())
