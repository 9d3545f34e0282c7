"""Connected components of a large graph by alternating star joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablecraft.plans.lineage import materialize


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a, b); root is the smallest node that can be reached.

    Large and small stars alternate: each node hands its larger neighbours, then its smaller
    ones, to the smallest of them, until every node hangs from its root. The edges never leave
    the executors; a round is aggregated before it is shuffled, and written to the shared
    checkpoint folder. Loops (a = b), repeated edges and missing ends are ignored.
    """
    now = materialize(
        edges.where("a <> b").select(F.greatest("a", "b").alias("high"), F.least("a", "b").alias("low")).distinct())
    seen = _state(now)
    while seen[0]:
        both = now.select(F.col("high").alias("u"), F.col("low").alias("v")).union(
            now.select(F.col("low").alias("u"), F.col("high").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("high"), F.col("m").alias("low")).distinct()
        nearest = large.groupBy("high").agg(F.min("low").alias("m"))
        small = large.join(nearest, "high").where("low > m").select(F.col("low").alias("high"), F.col("m").alias("low"))
        now = materialize(small.union(nearest.select("high", F.col("m").alias("low"))).distinct())
        after = _state(now)
        if after == seen:
            break
        seen = after
    return now.select(F.col("high").alias("node"), F.col("low").alias("root")).union(
        now.select(F.col("low").alias("node"), F.col("low").alias("root")).distinct())


def _state(edges: DataFrame) -> tuple:
    """Number of edges and a sum of their hashes, which both stay the same once nothing moves."""
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("high", "low").cast("decimal(38,0)"))).first())
