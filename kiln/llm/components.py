"""Connected components of an edge table by alternating large-star and small-star steps.

Every step is a grouped minimum and a join.  The minimum is combined on the
map side, and a node with very many neighbours is a skewed join key that AQE
splits; no node's neighbours are ever gathered.  The edge table is written to
the shared checkpoint folder between rounds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.llm.common import stored


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Hang every larger neighbour of a node on the node's smallest neighbour (or itself)."""
    both = _both_ways(edges)
    low = both.groupBy("a").agg(F.least(F.min("b"), F.min("a")).alias("m"))
    return (both.filter("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .filter("a <> b").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """Hang a node and its smaller neighbours on the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    low = down.groupBy("a").agg(F.min("b").alias("m"))
    joined = down.join(low, "a")
    return (joined.select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionByName(low.select("a", F.col("m").alias("b")))
            .filter("a <> b").distinct())


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` of the nodes in ``edges(a, b)``; a component is named by its smallest node."""
    def total(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    edges = stored(edges.select("a", "b").filter("a <> b").distinct(), "edges")
    before = total(edges)
    while before[0]:
        edges = stored(_small_star(_large_star(edges)), "edges")
        now = total(edges)
        if now == before:
            break
        before = now
    stars = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return stars.unionByName(stars.select(F.col("component").alias("node"), "component").distinct())
