"""Connected components of a table of links, by alternating star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheetloom.llm.common import settled


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour above a node is tied to the smallest node around it."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("least"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("least").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its neighbours below are tied to the smallest of them. Every edge points downwards here."""
    least = edges.groupBy("u").agg(F.min("v").alias("least"))
    joined = edges.join(least, "u")
    down = joined.where("v > least").select(F.col("v").alias("u"), F.col("least").alias("v"))
    return down.unionByName(least.select("u", F.col("least").alias("v"))).distinct()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """One row per linked node: ``node`` and ``root``, the smallest node it can reach.

    Links may repeat, point either way and tie a node to itself; a node without a link to another is
    not in the result. A round is two aggregations with map-side combine and two joins; the neighbours
    of a node are never gathered in one place, so a node with very many links is no special case. The
    number of rounds grows with the logarithm of the longest path. Each round is written to the shared
    checkpoint folder, so a lost executor costs one round at most.
    """
    low, high = F.least(a, b), F.greatest(a, b)
    edges = settled(links.where(F.col(a) != F.col(b)).select(high.alias("u"), low.alias("v")).distinct())
    state = _state(edges)
    while state[0]:
        edges = settled(_small_star(_large_star(edges)))
        before, state = state, _state(edges)
        if state == before:
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
