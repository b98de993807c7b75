"""Connected components by alternating large-star and small-star steps (no driver-side graph)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import saved


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the undirected ``edges`` (a, b).

    The component is its smallest node. Loops, repeated edges and nulls are allowed and add
    nothing. Each step is two aggregates with a partial side and one join whose other side has one
    row per node, so a star with very many leaves is split by adaptive execution. Rounds grow with
    the logarithm of the longest path; each round is a written table.
    """
    pairs = edges.where(F.col("a") != F.col("b"))
    current = saved(
        pairs.select(
            F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
        ).distinct(),
        "edges",
    )  # u > v
    seen = _checksum(current)
    while True:
        both = current.union(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m"))
        low = low.select("u", F.least("u", "m").alias("m"))
        large = (
            both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        ).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(least, "u")
            .select(F.explode(F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m"))).alias("e"))
            .select(F.col("e.v").alias("u"), F.col("e.m").alias("v"))
            .where("u != v")
            .distinct()
        )
        current = saved(small, "edges")
        now = _checksum(current)
        if now == seen:
            break
        seen = now
    roots = current.select(F.col("v").alias("node")).distinct()
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        roots.select("node", F.col("node").alias("component"))
    )


def _checksum(edges: DataFrame):
    value = F.xxhash64("u", "v").cast("decimal(38,0)")
    return edges.agg(F.count("*"), F.sum(value)).first()
