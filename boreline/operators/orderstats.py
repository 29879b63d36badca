"""Percent ranks of a population that changes a little at a time.

What a rank needs of a population is how many values lie below. The population
is kept as counts of its values, cut into ranges at quantiles, with a total for
each range. Members that change move a few counts; members that are asked for
need the totals, one row per range, and the counts of the ranges that they are
in. The rest of the population is not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored

RANGES = 256


def _long(members: DataFrame, parts: list[str], *more: str) -> DataFrame:
    """One row per member and part that has a value; NaN is no value."""
    cells = F.explode(F.array(*[F.struct(F.lit(p).alias("part"), F.col(p).cast("double").alias("value")) for p in parts]))
    return members.select(*more, cells.alias("_c")).select(*more, "_c.*").where(F.col("value").isNotNull() & ~F.isnan("value"))


def _placed(df: DataFrame, cuts: DataFrame) -> DataFrame:
    """Add ``range``: how many cuts lie below the value. Cuts are one row per part."""
    known = df.join(F.broadcast(cuts), "part", "left")
    return known.withColumn("range", F.coalesce(F.size(F.filter("cuts", lambda c: c < F.col("value"))), F.lit(0))).drop("cuts")


def range_cuts(population: DataFrame, parts: list[str], ranges: int = RANGES) -> DataFrame:
    """Where to cut each part's values: ``part``, ``cuts``. They stay as they are while the population changes."""
    shares = [k / ranges for k in range(1, ranges)]
    return stored(_long(population, parts).groupBy("part").agg(F.array_distinct(F.percentile_approx("value", shares, 10 * ranges)).alias("cuts")), "range-cuts")


def value_counts(population: DataFrame, parts: list[str], cuts: DataFrame) -> DataFrame:
    """``part, range, value, n`` of the distinct values; equal values are counted within tasks first."""
    counted = _long(population, parts).groupBy("part", "value").agg(F.count(F.lit(1)).alias("n"))
    return _placed(counted, cuts).select("part", "range", "value", "n")


def range_totals(counts: DataFrame) -> DataFrame:
    return counts.groupBy("part", "range").agg(F.sum("n").alias("n"))


def moved_counts(counts: DataFrame, before: DataFrame, after: DataFrame, parts: list[str], cuts: DataFrame) -> DataFrame:
    """The counts that change when members have other values: ``part, range, value, n``; 0 where none is left.

    ``before`` and ``after`` hold the members that change, without those that
    are new or gone. Of ``counts`` only their ranges are read.
    """
    signed = _long(before, parts).withColumn("d", F.lit(-1)).unionByName(_long(after, parts).withColumn("d", F.lit(1)))
    delta = _placed(signed.groupBy("part", "value").agg(F.sum("d").alias("d")).where("d <> 0"), cuts)
    own = counts.join(delta.select("part", "range").distinct(), ["part", "range"], "left_semi")
    return delta.join(own, ["part", "range", "value"], "left").select("part", "range", "value", (F.coalesce("n", F.lit(0)) + F.col("d")).alias("n"))


def with_moved(counts: DataFrame, moved: DataFrame) -> DataFrame:
    kept = counts.join(moved, ["part", "range", "value"], "left_anti")
    return kept.unionByName(moved.where("n > 0"))


def moved_totals(totals: DataFrame, counts: DataFrame, moved: DataFrame) -> DataFrame:
    """The totals after a move, from the differences of its counts."""
    old = counts.select("part", "range", "value", F.col("n").alias("was"))
    delta = moved.join(old, ["part", "range", "value"], "left").select("part", "range", (F.col("n") - F.coalesce("was", F.lit(0))).alias("n"))
    return totals.unionByName(delta).groupBy("part", "range").agg(F.sum("n").alias("n"))


def member_ranks(members: DataFrame, keys: list[str], parts: dict[str, bool], counts: DataFrame, totals: DataFrame, cuts: DataFrame) -> DataFrame:
    """The members with ``rank_<part>``: 100 x percent rank in the whole population; ties share it, no value ranks 0.

    ``parts`` tells whether higher values are better. Values that the
    population does not have are ranked where they would stand.
    """
    line = Window.partitionBy("part").orderBy("range")
    # One row per part and range.
    lower = totals.select(
        F.col("part").alias("_part"), F.col("range").alias("_range"), F.coalesce(F.sum("n").over(line.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("lower"), F.sum("n").over(Window.partitionBy("part")).alias("all")
    )
    asked = _placed(_long(members, list(parts)).distinct(), cuts)
    near = counts.join(asked.select("part", "range").distinct(), ["part", "range"], "left_semi")
    marks = near.select("part", "range", "value", "n").unionByName(asked.select("part", "range", "value", F.lit(0).cast("bigint").alias("n"))).groupBy("part", "range", "value").agg(F.sum("n").alias("n"))
    inside = Window.partitionBy("part", "range").orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
    placed = marks.withColumn("below", F.coalesce(F.sum("n").over(inside), F.lit(0)))
    ranked = placed.join(lower, (F.col("part") == F.col("_part")) & (F.col("range") == F.col("_range")))
    below = F.col("lower") + F.col("below")
    above = F.col("all") - below - F.col("n")
    up = F.col("part").isin([p for p, higher in parts.items() if higher])
    others = F.col("all") - 1
    score = F.when(others > 0, F.when(up, below).otherwise(above) * 100.0 / others).otherwise(0.0)
    scored = ranked.select(F.col("part").alias("_p"), F.col("value").alias("_v"), score.alias("_score"))
    cells = _long(members, list(parts), *keys).join(scored, (F.col("part") == F.col("_p")) & (F.col("value") == F.col("_v")))
    wide = cells.groupBy(*keys).agg(*[F.max(F.when(F.col("part") == p, F.col("_score"))).alias(f"rank_{p}") for p in parts])
    return members.join(wide, keys, "left").select(*members.columns, *[F.coalesce(f"rank_{p}", F.lit(0.0)).alias(f"rank_{p}") for p in parts])
