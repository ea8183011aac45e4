"""Connected components of a graph given as a table of edges, by large-star and small-star steps.

Every step is a shuffle of the edges with a minimum per node that is combined before the shuffle.
Nothing is collected; the lineage is cut by a written table after each step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollbook.session import written


def _both_ways(edges: DataFrame) -> DataFrame:
    back = edges.select(F.col("b").alias("a"), F.col("a").alias("b"))
    return edges.select("a", "b").unionByName(back)


def _step(edges: DataFrame, large: bool) -> DataFrame:
    """Hang neighbours on the smallest one: all larger neighbours, or the smaller ones and itself."""
    pairs = _both_ways(edges) if large else edges.select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    low = pairs.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
    hung = pairs.join(low, "a").where(F.col("b") > F.col("a") if large else F.col("b") != F.col("low"))
    out = hung.select(F.col("b").alias("a"), F.col("low").alias("b"))
    if not large:
        out = out.unionByName(low.select("a", F.col("low").alias("b")))
    return out.where("a != b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges(a, b)``; the root is the smallest node reachable."""
    now = written(edges.select("a", "b").where("a != b").distinct(), "edges")
    before = None
    while True:
        now = written(_step(_step(now, large=True), large=False), "star")
        state = tuple(now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if state == before:
            break
        before = state
    leaves = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return leaves.unionByName(roots)
