"""Connected components by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def _neighbour_minima(pairs: DataFrame, name: str) -> DataFrame:
    """(u, m): the smallest node among u and its neighbours. Stored, so that a
    hub's rows in the join that follows can be split at run time."""
    return stored(pairs.groupBy("u").agg(F.min("v").alias("m"))
                  .select(F.col("u").alias("c"), F.least("u", "m").alias("m")), name)


def _are_stars(edges: DataFrame) -> bool:
    """Whether every ``u`` has one edge and is no ``v``; counts are combined before the shuffle."""
    ends = edges.select("u", F.lit(1).alias("up"), F.lit(0).alias("down")).union(edges.select("v", F.lit(0), F.lit(1)))
    both = ends.groupBy("u").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return both.where("up > 1 OR (up = 1 AND down = 1)").agg(F.count("*")).first()[0] == 0


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Smallest reachable node of every node that has an edge.

    ``edges``: columns ``u``, ``v`` (any order, repeats and loops allowed; rows
    with a null end are ignored). Returns ``node``, ``component``. An empty
    input gives no rows. Every round reduces to stars; the loop ends when each
    node with a smaller neighbour has one alone, which has none itself, and raises
    if that is not so after ``max_rounds`` (rounds grow with the logarithm of the
    longest path). Edges that are stars from the start need no round.
    """
    now = stored(edges.where("u IS NOT NULL AND v IS NOT NULL AND u <> v")
                 .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    for _ in range(max_rounds + 1):
        if _are_stars(now):
            return (now.select(F.col("u").alias("node"), F.col("v").alias("component"))
                    .union(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()))
        # large star: every larger neighbour moves to the smallest one
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = _neighbour_minima(both, "large")
        large = (both.join(least, both.u == least.c).where("v > u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")))
        large = stored(large.where("u <> v").distinct(), "large-star")
        # small star: the smaller neighbours, and the node itself, join the smallest
        least = _neighbour_minima(large, "small")
        moved = (large.join(least, large.u == least.c).where("v <> m")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")))
        now = stored(moved.union(least.select(F.col("c").alias("u"), F.col("m").alias("v")))
                     .where("u <> v").distinct(), "small-star")
    raise RuntimeError(f"components have not settled after {max_rounds} rounds")
