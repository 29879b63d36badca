"""Joins between points and time windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numbers import slot
from .ordered import SLOT, prefix_sums

BUCKET_SECONDS = 86_400.0
#: Nodes of the tree that a long window is cut into, less one.
NODES = 32


def window_nodes(windows: DataFrame, start: str, end: str, bucket_seconds: float = BUCKET_SECONDS) -> DataFrame:
    """The windows with the nodes of a binary tree over time that cover them: ``_level`` and ``_node``.

    A node of level k is 2^k buckets wide. Each window is cut on the lowest
    level on which it needs no more than ``NODES`` + 1 nodes, so a window that
    ends in the year 9999 costs no more rows than one of a month.
    """
    first, last = slot(start, bucket_seconds), slot(end, bucket_seconds)
    level = F.greatest(F.lit(0), F.ceil(F.log2((last - first + 1) / F.lit(float(NODES))))).cast("int")
    cut = windows.where(F.col(start) <= F.col(end)).select("*", first.alias("_first"), last.alias("_last"), level.alias("_level"))
    node = F.explode(F.sequence(F.call_function("shiftright", F.col("_first"), F.col("_level")), F.call_function("shiftright", F.col("_last"), F.col("_level"))))
    return cut.withColumn("_node", node).drop("_first", "_last")


def _join_on_nodes(points: DataFrame, windows: DataFrame, ts: str, start: str, end: str, how: str, bucket_seconds: float, on: str) -> DataFrame:
    nodes = window_nodes(windows.select("*", F.col(start).alias("_from"), F.col(end).alias("_to")), start, end, bucket_seconds).withColumnRenamed(on, "_on")
    # One row: the levels that any window is on, 64 at most.
    levels = nodes.agg(F.collect_set("_level").alias("_levels"))
    asked = points.crossJoin(F.broadcast(levels)).withColumn("_at", F.explode("_levels")).withColumn("_in", F.call_function("shiftright", slot(ts, bucket_seconds), F.col("_at")))
    match = (F.col(on) == F.col("_on")) & (F.col("_at") == F.col("_level")) & (F.col("_in") == F.col("_node")) & F.col(ts).between(F.col("_from"), F.col("_to"))
    found = asked.join(nodes, match).drop("_levels", "_at", "_in", "_level", "_node", "_on", "_from", "_to")
    if how == "inner":
        return found
    if how != "left":
        raise ValueError(f"no {how} join of intervals")
    # Points of one name and time lie in the same windows, so those without any are known by name and time.
    held = found.select(F.col(on).alias("_on"), F.col(ts).alias("_at")).distinct()
    alone = points.join(held, (F.col(on) == F.col("_on")) & (F.col(ts) == F.col("_at")), "left_anti")
    return found.unionByName(alone, allowMissingColumns=True)


def interval_join(
    points: DataFrame,
    windows: DataFrame,
    ts: str,
    start: str,
    end: str,
    how: str = "inner",
    bucket_seconds: float = BUCKET_SECONDS,
    on: str = "name",
    open_ended: bool = False,
) -> DataFrame:
    """Points with the windows that hold them; both ends are inclusive.

    Windows are repeated once per time bucket they touch and the join runs on
    (entity, bucket) with the range as residual, so a large entity is spread
    over many tasks and a point only meets windows of its own bucket. This is
    for windows cut from readings, which span what the readings span. Windows
    that may be as long as they like are ``open_ended``: they are cut into
    nodes of a tree instead, and a point asks one node of each level that
    windows are on, most often one or two.
    """
    if open_ended:
        return _join_on_nodes(points, windows, ts, start, end, how, bucket_seconds, on)
    touched = F.explode(F.sequence(slot(start, bucket_seconds), slot(end, bucket_seconds)))
    spread = windows.select("*", F.col(start).alias("_from"), F.col(end).alias("_to"), touched.alias("_bucket")).withColumnRenamed(on, "_on")
    placed = points.withColumn("_point_bucket", slot(ts, bucket_seconds))
    match = (F.col(on) == F.col("_on")) & (F.col("_point_bucket") == F.col("_bucket")) & F.col(ts).between(F.col("_from"), F.col("_to"))
    return placed.join(spread, match, how).drop("_bucket", "_point_bucket", "_on", "_from", "_to")


def windows_holding(points: DataFrame, windows: DataFrame, ts: str, start: str, end: str, value: str, slot_seconds: float = BUCKET_SECONDS) -> DataFrame:
    """Add ``matches``, how many windows hold each point, and ``matched_value`` where it is exactly one.

    Windows and points are merged into one time line and summed along it: a
    window adds one at its start and takes it away after its end. No point is
    paired with a window, so any amount of overlap costs the same.
    """
    keys = ["name"]
    edge = windows.where(F.col("name").isNotNull() & F.col(start).isNotNull() & F.col(end).isNotNull() & F.col(value).isNotNull())
    opened = edge.select("name", F.col(start).alias("_t"), F.lit(0).alias("_kind"), F.lit(1).alias("_d"), F.col(value).cast("bigint").alias("_v"))
    closed = edge.select("name", F.col(end).alias("_t"), F.lit(2).alias("_kind"), F.lit(-1).alias("_d"), (-F.col(value)).cast("bigint").alias("_v"))
    marks = opened.unionByName(closed).groupBy("name", "_t", "_kind").agg(F.sum("_d").alias("_d"), F.sum("_v").alias("_v"))
    times = points.select("name", F.col(ts).alias("_t")).distinct().select("name", "_t", F.lit(1).alias("_kind"), F.lit(0).alias("_d"), F.lit(0).cast("bigint").alias("_v"))
    line = marks.unionByName(times).withColumn(SLOT, slot("_t", slot_seconds))
    swept = prefix_sums(line, keys, ["_t", "_kind"], {"matches": F.col("_d"), "_sum": F.col("_v")}, SLOT)
    counted = swept.where(F.col("_kind") == 1).select(
        "name", F.col("_t").alias(ts), "matches", F.when(F.col("matches") == 1, F.col("_sum")).alias("matched_value")
    )
    return points.join(counted, ["name", ts])


def overlap_counts(windows: DataFrame, group: str, ident: str, start: str, end: str, slot_seconds: float = BUCKET_SECONDS) -> DataFrame:
    """For each window, how many other windows of its group strictly overlap it.

    A window meets those that start before its end, less those that end at or
    before its start. Both counts are running sums over the distinct times of
    the group, so no pair of windows is built and one group may hold any share
    of the rows. A window with a null or reversed end overlaps nothing.
    """
    w = windows.select(group, ident, F.col(start).alias("_s"), F.col(end).alias("_e")).where(F.col("_s") <= F.col("_e"))
    lone = F.col("_s") == F.col("_e")
    ends = F.explode(F.array(
        F.struct(F.col("_s").alias("_t"), F.lit(1).alias("_ns"), F.lit(0).alias("_ne"), F.when(lone, 1).otherwise(0).alias("_np")),
        F.struct(F.col("_e").alias("_t"), F.lit(0).alias("_ns"), F.lit(1).alias("_ne"), F.lit(0).alias("_np")),
    ))
    marks = w.select(group, ident, lone.alias("_lone"), ends.alias("_m")).select(group, ident, "_lone", "_m.*")
    times = marks.groupBy(group, "_t").agg(F.sum("_ns").alias("_started_at"), F.sum("_ne").alias("_ended_at"), F.sum("_np").alias("_points"))
    line = prefix_sums(times.withColumn(SLOT, slot("_t", slot_seconds)), [group], ["_t"], {"_cs": F.col("_started_at"), "_ce": F.col("_ended_at")}, SLOT)
    seen = marks.join(line.select(group, "_t", (F.col("_cs") - F.col("_started_at")).alias("_before"), "_ce", "_points"), [group, "_t"])
    at_end, at_start = F.col("_ne") == 1, F.col("_ns") == 1
    own = F.when(F.col("_lone"), F.col("_points")).otherwise(F.lit(-1))
    met = F.when(at_end, F.col("_before")).otherwise(0) + F.when(at_start, own - F.col("_ce")).otherwise(0)
    counted = seen.groupBy(group, ident).agg(F.sum(met).cast("bigint").alias("overlap_count"))
    odd = windows.where(~F.coalesce(F.col(start) <= F.col(end), F.lit(False))).select(group, ident, F.lit(0).cast("bigint").alias("overlap_count"))
    return counted.unionByName(odd)


def merged_intervals(windows: DataFrame, group: str, start: str, end: str) -> DataFrame:
    """The stretches of time that a group's windows cover: what overlaps or touches becomes one.

    A point lies in exactly one of them, or in none. Windows with a null or
    reversed end cover nothing. A group's windows, not its readings, are put
    in order by one task.
    """
    line = Window.partitionBy(group).orderBy(start, end)
    reach = F.max(end).over(line.rowsBetween(Window.unboundedPreceding, -1))
    w = windows.where(F.col(start) <= F.col(end)).select(group, start, end).distinct()
    w = w.withColumn("_new", F.when(F.col(start) <= reach, 0).otherwise(1)).withColumn("_stretch", F.sum("_new").over(line))
    return w.groupBy(group, "_stretch").agg(F.min(start).alias(start), F.max(end).alias(end)).drop("_stretch")


def overlapping(windows: DataFrame, start: str, end: str, from_time, to_time) -> DataFrame:
    """Windows that touch the given range; both ends are inclusive."""
    return windows.where((F.col(start) <= to_time) & (F.col(end) >= from_time))


