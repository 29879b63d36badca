"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boreline.llm.rows import drop_stored
from boreline.session import stored


def _summary(edges: DataFrame) -> tuple:
    """One row that changes when the set of edges does."""
    code = F.xxhash64("u", "v").cast("decimal(38,0)")
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(code), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first())


def _nearest(edges: DataFrame, label: str) -> DataFrame:
    """The smallest neighbour of each u. Written, so that the join with a hub's edges can be split."""
    return stored(edges.groupBy("u").agg(F.min("v").alias("m")), label)


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Columns ``u`` and ``v`` (two ids of one ordered type) to ``node`` and ``component``.

    Every node of an edge gets the smallest id that it can reach. Loops,
    repeated edges and edges with a null are harmless; an empty input gives an
    empty result, and a node without an edge to another one is not listed.

    A large-star step ties the larger neighbours of each node to its smallest
    one, a small-star step ties the others to it; once neither changes
    anything, every node hangs on its component's smallest. Both are grouped
    minima and joins: no node's neighbours are ever gathered, and a hub's
    edges are split by AQE. Each step is a table in the shared work folder, so
    a lost executor costs one step.
    """
    spark = edges.sparkSession
    now = stored(edges.where(F.col("u") != F.col("v")).select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    before = None
    after = _summary(now)
    for _ in range(max_rounds):
        if after == before:
            break
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = _nearest(both, "large-nearest")
        tied = both.join(low, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
        large = stored(tied.distinct(), "large-star")
        least = _nearest(large, "small-nearest")
        tied = large.join(least, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = stored(tied.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "small-star")
        before, after = after, _summary(small)
        for used in (now, low, large, least):
            drop_stored(spark, used)
        now = small
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    node = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return node.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
