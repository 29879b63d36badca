"""Runs of equal labels along a time line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.clean import time_text
from ..functions.display import event_title
from ..functions.numbers import MICROS, micros, seconds_between, slot
from .ordered import SLOT, SLOT_SECONDS, drop_halo, in_slot, with_halo


def label_islands(
    df: DataFrame,
    keys: list[str],
    ts: str,
    label: str,
    max_gap_seconds: float | None = None,
    slot_seconds: float = SLOT_SECONDS,
) -> DataFrame:
    """Maximal runs of one label: keys, label, ``start_ts``, ``end_ts``, ``sample_count``.

    Rows at one time are ordered by label. With ``max_gap_seconds`` a run also
    ends where the pause is longer. Copies of a row are combined before the
    shuffle; runs are found inside slots, and only the first and last run of
    each slot take part in joining runs across slot edges.
    """
    cells = df.groupBy(*keys, slot(ts, slot_seconds).alias(SLOT), ts, label).agg(F.count(F.lit(1)).alias("_n"))

    def breaks(line, start: str, previous_end: str) -> Column:
        changed = ~F.lag(label).over(line).eqNullSafe(F.col(label))
        if max_gap_seconds is not None:
            pause = micros(start) - micros(F.lag(previous_end).over(line))
            changed = changed | (pause > F.lit(int(max_gap_seconds * MICROS)))
        return F.when(F.lag(start).over(line).isNull() | changed, 1).otherwise(0)

    inside = Window.partitionBy(*keys, SLOT).orderBy(ts, label)
    runs = (
        cells.withColumn("_new", breaks(inside, ts, ts))
        .withColumn("_run", F.sum("_new").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy(*keys, SLOT, "_run", label)
        .agg(F.min(ts).alias("_start"), F.max(ts).alias("_end"), F.sum("_n").alias("_n"))
    )
    last = F.max("_run").over(Window.partitionBy(*keys, SLOT))
    edge = (F.col("_run") == 1) | (F.col("_run") == last)
    runs = runs.withColumn("_group", F.when(~edge, F.col(SLOT)))
    line = Window.partitionBy(*keys, "_group").orderBy(SLOT, "_run")
    same_slot = F.lag(SLOT).over(line).eqNullSafe(F.col(SLOT))
    return (
        runs.withColumn("_new", F.when(same_slot, 1).otherwise(breaks(line, "_start", "_end")))
        .withColumn("_island", F.sum("_new").over(line.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy(*keys, "_group", "_island", label)
        .agg(F.min("_start").alias("start_ts"), F.max("_end").alias("end_ts"), F.sum("_n").alias("sample_count"))
        .drop("_group", "_island")
    )


def event_segments(df: DataFrame, max_gap_seconds: float, label: str = "anomaly", run_id: str | Column = "", slot_seconds: float = SLOT_SECONDS) -> DataFrame:
    """Events from flagged rows (``name, stage_num_td, datetime_fmt, anomaly``) with length and identity."""
    flagged = df.where(F.col(label).isNotNull())
    runs = label_islands(flagged, ["name", "stage_num_td"], "datetime_fmt", label, max_gap_seconds, slot_seconds)
    run_id = F.lit(run_id) if isinstance(run_id, str) else run_id
    seconds = seconds_between("start_ts", "end_ts")
    identity = F.concat_ws("|", run_id, "name", F.col("stage_num_td").cast("string"), F.lower(label), time_text("start_ts"), time_text("end_ts"))
    return runs.select(
        F.sha2(identity, 256).alias("event_id"),
        "name",
        "stage_num_td",
        F.lower(label).alias("anomaly"),
        event_title(F.lower(label)).alias("anomaly_display"),
        "start_ts",
        "end_ts",
        seconds.alias("duration_sec"),
        (seconds / 60).alias("duration_min"),
    )


def min_run_filter(df: DataFrame, keys: list[str], ts: str, mask: str, rows: int, name: str, slot_seconds: float = SLOT_SECONDS) -> DataFrame:
    """Add ``name``: the mask, kept only in runs of at least ``rows`` rows."""
    around = rows - 1
    haloed = with_halo(df, keys, ts, before=around, after=around, slot_seconds=slot_seconds)
    return drop_halo(haloed.withColumn(name, long_run(F.col(mask), rows, in_slot(keys, ts))))


def long_run(mask: Column, rows: int, line) -> Column:
    """True where ``mask`` holds on ``rows`` neighbouring rows that include this one."""
    held = F.when(mask, 1).otherwise(0)
    hits = [F.sum(held).over(line.rowsBetween(back - rows + 1, back)) == rows for back in range(rows)]
    out = hits[0]
    for hit in hits[1:]:
        out = out | hit
    return out


def run_neighbours(df: DataFrame, keys: list[str], ts: str, mask: str, rows: int, slot_seconds: float = SLOT_SECONDS) -> DataFrame:
    """Add ``is_before`` and ``is_after``: rows outside a run, within ``rows`` rows of one."""
    haloed = with_halo(df, keys, ts, before=rows, after=rows, slot_seconds=slot_seconds)
    before, after = neighbours(F.col(mask), rows, in_slot(keys, ts))
    return drop_halo(haloed.withColumn("is_before", before).withColumn("is_after", after))


def neighbours(mask: Column, rows: int, line) -> tuple[Column, Column]:
    held = F.when(mask, 1).otherwise(0)
    outside = ~F.coalesce(mask, F.lit(False))

    def near(low: int, high: int) -> Column:
        return outside & (F.coalesce(F.max(held).over(line.rowsBetween(low, high)), F.lit(0)) == 1)

    return near(1, rows), near(-rows, -1)
