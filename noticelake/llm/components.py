"""Connected components of a table of edges, as joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def connected_components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """``node, component`` for the nodes of edges ``a, b``; the component is its smallest node.

    Alternates large-star and small-star steps: each links the neighbours of a
    node with the smallest of them, first the larger ones, then the others, so
    the edges become stars in a number of rounds that grows with the logarithm
    of the nodes. Each round is written to the shared folder. Loops are dropped.
    """
    now = written(edges.select(F.least("a", "b").alias("low"), F.greatest("a", "b").alias("high")).where("low <> high").distinct(), "edges")
    before = None
    for _ in range(most_rounds):
        large = _star(now, True)
        now = written(_star(large, False), "edges")
        state = now.agg(F.count("*"), F.sum(F.xxhash64("low", "high").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    else:
        raise RuntimeError(f"components didn't settle in {most_rounds} rounds")
    return now.select(F.col("high").alias("node"), F.col("low").alias("component")).unionByName(now.select(F.col("low").alias("node"), F.col("low").alias("component")).distinct())


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Links each node's larger (or other) neighbours with the smallest of the node and its neighbours."""
    if large:
        both = edges.select(F.col("low").alias("u"), F.col("high").alias("v")).unionByName(edges.select(F.col("high").alias("u"), F.col("low").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        out = both.where("v > u").join(least, "u").select(F.col("m").alias("low"), F.col("v").alias("high"))
    else:
        least = edges.groupBy("high").agg(F.min("low").alias("m"))
        out = edges.join(least, "high").select(F.col("m").alias("low"), F.col("low").alias("high")).unionByName(least.select(F.col("m").alias("low"), "high"))
    return out.where("low <> high").distinct()
