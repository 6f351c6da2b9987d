"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formlake.llm.written import written


def _with_least(edges: DataFrame, least: DataFrame) -> DataFrame:
    """``least`` is written first, so that a hub's edges can be split by the adaptive skew join."""
    return edges.join(written(least, "least-neighbours"), "u")


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the least of its neighbours and itself."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("least"))
    return _with_least(both, least).where("v > u").select(F.col("v").alias("u"), F.col("least").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the least of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("least"))
    met = _with_least(edges, least)
    moved = met.where("v > least").select(F.col("v").alias("u"), F.col("least").alias("v"))
    return moved.unionByName(met.select("u", F.col("least").alias("v"))).distinct()


def _print(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
    return row["n"], row["s"]


def connected(edges: DataFrame) -> DataFrame:
    """node and root, the least node of its component, for every node of edges u > v (bigint)."""
    edges = written(edges, "edges")
    before = _print(edges)
    while before[0]:
        edges = written(_small_star(_large_star(edges)), "edges")
        after = _print(edges)
        if after == before:
            break
        before = after
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return nodes.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
