"""Connected components by alternating large and small stars, all in joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bedside_spark.llm.frames import checkpointed


def _least(edges: DataFrame) -> DataFrame:
    """Smallest ``v`` of each ``u``, cut off so that a join with it can split a hot ``u``."""
    return checkpointed(edges.groupBy("u").agg(F.min("v").alias("least")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Greater neighbours of every node move to the node's smallest neighbour or itself."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    root = F.least("u", "least")
    moved = both.join(_least(both), "u").where("v > u").select(F.col("v").alias("u"), root.alias("v"))
    return checkpointed(moved.distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """Smaller neighbours of every node, and the node, move to the smallest of them."""
    least = _least(edges)
    moved = edges.join(least, "u").where("v > least").select(F.col("v").alias("u"), F.col("least").alias("v"))
    return checkpointed(moved.unionByName(least.withColumnRenamed("least", "v")).distinct())


def _state(edges: DataFrame) -> tuple:
    mark = F.xxhash64("u", "v")
    return tuple(edges.agg(F.count("*"), F.bit_xor(mark), F.sum(mark % 1_000_003)).first())


def stars(links: DataFrame) -> DataFrame:
    """(u, v): every linked node but the smallest of its component, and that smallest node.

    ``links`` has columns u > v. Each round halves the depth of the trees at least; rounds end
    when nothing moves, so no component is left unfinished.
    """
    edges = checkpointed(links.select("u", "v").distinct())
    before = _state(edges)
    while before[0]:
        edges = _small_star(_large_star(edges))
        after = _state(edges)
        if after == before:
            break
        before = after
    return edges
