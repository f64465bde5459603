"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framefold.llm.common import land


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges`` (columns ``a, b``, bigint): root is the smallest node reachable.

    Alternates the large star (every larger neighbour is linked to the smallest) and the small star
    (every smaller one is) until the edges stay the same; they then are stars around the roots.
    Each round is written, so lost executors cost one round at most. Minima are aggregated before
    they are shuffled; a node with very many edges only meets its own minimum in a join whose large
    side may be split. Self-links and repeats are allowed; no edges give no rows.
    """
    current = land(_oriented(edges), "edges")
    state = _state(current)
    while True:
        current = land(_small_star(_large_star(current)), "edges")
        following = _state(current)
        if following == state:
            return current.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            )
        state = following


def _oriented(edges: DataFrame) -> DataFrame:
    """Distinct edges from the larger to the smaller node."""
    return (
        edges.where("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("least")).select("a", F.least("a", "least").alias("least"))
    return _oriented(
        both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    )


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    moved = edges.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return _oriented(moved.union(least.select("a", F.col("least").alias("b"))))


def _state(edges: DataFrame) -> tuple:
    """Equal for equal sets of edges, but for the unlikely chance of equal sums of hashes."""
    row = edges.agg(
        F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))
    ).collect()[0]
    return tuple(row)
