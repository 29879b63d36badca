"""Gap stages: cutting an entity's readings where they pause."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numbers import MICROS, micros, seconds_between, slot
from .ordered import SLOT, drop_halo, in_slot, with_halo

STAGE_METHOD = "time_gap"
WINDOW_MEASURES = ("rate_slurry", "press_mainline", "prop_conc_blend_denso")


def _number_slots(slots: DataFrame, gap_seconds: float, prior: DataFrame | None) -> DataFrame:
    """Stage number of every (name, slot).

    A slot is no wider than the gap, so two readings of one slot are never
    split and only the slots have to be put in order: a new stage starts when
    a slot's first reading is at least the gap after the last reading before it.
    """
    line = Window.partitionBy("name").orderBy(SLOT)
    if prior is not None:
        slots = slots.join(
            prior.select("name", F.col("last_record_ts").alias("_prior_ts"), F.col("last_stage").cast("bigint").alias("_prior_stage")), "name", "left"
        )
        previous = F.coalesce(F.lag("_hi").over(line), F.col("_prior_ts"))
        base = F.coalesce(F.col("_prior_stage"), F.lit(0))
    else:
        previous = F.lag("_hi").over(line)
        base = F.lit(0)
    pause = micros("_lo") - micros("_previous")
    starts = F.when(F.col("_previous").isNull() | (pause >= F.lit(int(gap_seconds * MICROS))), 1).otherwise(0)
    numbered = slots.withColumn("_previous", previous).withColumn("_new", starts)
    running = F.sum("_new").over(line.rowsBetween(Window.unboundedPreceding, 0))
    return numbered.withColumn("stage_num_td", (base + running).cast("bigint")).drop("_previous", "_new", "_prior_ts", "_prior_stage")


def stage_slots(df: DataFrame, gap_seconds: float, prior: DataFrame | None = None) -> DataFrame:
    """(name, _slot, stage_num_td) for every slot that holds readings.

    ``prior`` carries ``name, last_record_ts, last_stage`` of earlier batches;
    numbering goes on from it.
    """
    slots = (
        df.where(F.col("record_ts").isNotNull())
        .groupBy("name", slot("record_ts", gap_seconds).alias(SLOT))
        .agg(F.min("record_ts").alias("_lo"), F.max("record_ts").alias("_hi"))
    )
    return _number_slots(slots, gap_seconds, prior).select("name", SLOT, "stage_num_td")


def assign_stages(df: DataFrame, gap_seconds: float, prior: DataFrame | None = None) -> DataFrame:
    """Add ``stage_num_td`` to every reading."""
    return (
        df.where(F.col("record_ts").isNotNull())
        .withColumn(SLOT, slot("record_ts", gap_seconds))
        .join(stage_slots(df, gap_seconds, prior), ["name", SLOT])
        .drop(SLOT)
    )


def _newest(df: DataFrame, column: str, tie: str | None) -> Column:
    """Partial state of "last non-null by record time"; comparable, so it merges with max."""
    order = ["record_ts", *([tie] if tie else [])]
    return F.max(F.when(F.col(column).isNotNull(), F.struct(*order, F.col(column).alias("_v"))))


def _window_partials(df: DataFrame) -> list[Column]:
    tie = "id" if "id" in df.columns else None
    out = [
        F.min("record_ts").alias("_lo"),
        F.max("record_ts").alias("_hi"),
        F.min("created_ts").alias("_created_lo"),
        F.max("created_ts").alias("_created_hi"),
        F.count(F.lit(1)).alias("_n"),
    ]
    for m in WINDOW_MEASURES:
        out += [F.sum(m).alias(f"_sum_{m}"), F.count(m).alias(f"_cnt_{m}"), F.max(m).alias(f"_max_{m}")]
    for c in ("fleet_name", "pad_name", "id", "api_num"):
        if c in df.columns:
            out.append(_newest(df, c, tie).alias(f"_last_{c}"))
    return out


def _merge_partials(parts: DataFrame) -> list[Column]:
    out = [
        F.min("_lo").alias("_lo"),
        F.max("_hi").alias("_hi"),
        F.min("_created_lo").alias("_created_lo"),
        F.max("_created_hi").alias("_created_hi"),
        F.sum("_n").alias("_n"),
    ]
    for m in WINDOW_MEASURES:
        out += [F.sum(f"_sum_{m}").alias(f"_sum_{m}"), F.sum(f"_cnt_{m}").alias(f"_cnt_{m}"), F.max(f"_max_{m}").alias(f"_max_{m}")]
    return out + [F.max(c).alias(c) for c in parts.columns if c.startswith("_last_")]


def _finish_windows(parts: DataFrame) -> DataFrame:
    have = [c for c in ("fleet_name", "pad_name", "id", "api_num") if f"_last_{c}" in parts.columns]
    return parts.select(
        "name",
        "stage_num_td",
        *[F.col(f"_last_{c}")["_v"].alias("well_id" if c == "id" else c) for c in have],
        F.col("_lo").alias("stage_start_ts"),
        F.col("_hi").alias("stage_end_ts"),
        F.col("_created_lo").alias("first_created_ts"),
        F.col("_created_hi").alias("last_created_ts"),
        F.col("_n").alias("sample_count"),
        *[
            c
            for m in WINDOW_MEASURES
            for c in ((F.col(f"_sum_{m}") / F.col(f"_cnt_{m}")).alias(f"avg_{m}"), F.col(f"_max_{m}").alias(f"max_{m}"))
        ],
        F.lit(STAGE_METHOD).alias("stage_detection_method"),
    )


def stage_partials(df: DataFrame, gap_seconds: float, prior: DataFrame | None = None, wells: DataFrame | None = None) -> DataFrame:
    """Mergeable aggregates of every stage: sums and non-null counts, not means.

    Readings are reduced to (name, slot) before anything is ordered, so the
    only shuffle of row-level data is a combined aggregation, and the stage
    numbers are found on the slots alone. ``wells`` with a ``name`` each picks
    wells; where they are too many to broadcast, it is slots that are dealt
    out by well, not readings.
    """
    slots = (
        df.where(F.col("record_ts").isNotNull())
        .groupBy("name", slot("record_ts", gap_seconds).alias(SLOT))
        .agg(*_window_partials(df))
    )
    if wells is not None:
        slots = slots.join(wells, "name", "left_semi")
    numbered = _number_slots(slots, gap_seconds, prior)
    return numbered.groupBy("name", "stage_num_td").agg(*_merge_partials(numbered))


def stage_windows(df: DataFrame, gap_seconds: float, prior: DataFrame | None = None, wells: DataFrame | None = None) -> DataFrame:
    """One row per gap stage: bounds, counts, last identifiers, mean and max of the measures."""
    return _finish_windows(stage_partials(df, gap_seconds, prior, wells))


def windows_of_assigned(df: DataFrame) -> DataFrame:
    """Stage windows of readings that already carry ``stage_num_td``."""
    parts = df.groupBy("name", "stage_num_td").agg(*_window_partials(df))
    return _finish_windows(parts)


def partials_of_assigned(df: DataFrame) -> DataFrame:
    return df.groupBy("name", "stage_num_td").agg(*_window_partials(df))


def merge_partials(*frames: DataFrame) -> DataFrame:
    """Windows of several batches from their mergeable aggregates.

    Means stay right because sums and non-null counts are kept apart.
    """
    union = frames[0]
    for frame in frames[1:]:
        union = union.unionByName(frame, allowMissingColumns=True)
    return _finish_windows(union.groupBy("name", "stage_num_td").agg(*_merge_partials(union)))


def session_state(windows: DataFrame) -> DataFrame:
    """What the next batch needs: each well's last reading time and stage."""
    return windows.groupBy("name").agg(F.max("stage_end_ts").alias("last_record_ts"), F.max("stage_num_td").alias("last_stage"))


def split_late(batch: DataFrame, state: DataFrame) -> DataFrame:
    """Add ``is_late``: not after the last reading its well had before the batch."""
    known = state.select("name", "last_record_ts")
    late = F.coalesce(F.col("record_ts") <= F.col("last_record_ts"), F.lit(False))
    return batch.join(known, "name", "left").withColumn("is_late", late).drop("last_record_ts")


def overlap_violations(windows: DataFrame, slot_seconds: float = 86_400.0) -> DataFrame:
    """Windows that start at or before the latest end of the windows before them.

    The running maximum finds overlaps with any earlier window. It runs inside
    slots of start times, on top of the maximum of the slots before.
    """
    timed = windows.where(F.col("stage_start_ts").isNotNull() & F.col("stage_end_ts").isNotNull()).select(
        "name", "stage_num_td", "stage_start_ts", "stage_end_ts", slot("stage_start_ts", slot_seconds).alias(SLOT)
    )
    slots = timed.groupBy("name", SLOT).agg(F.max("stage_end_ts").alias("_slot_end"))
    line = Window.partitionBy("name").orderBy(SLOT).rowsBetween(Window.unboundedPreceding, -1)
    earlier = slots.select("name", SLOT, F.max("_slot_end").over(line).alias("_earlier"))
    inside = Window.partitionBy("name", SLOT).orderBy("stage_start_ts", "stage_num_td").rowsBetween(Window.unboundedPreceding, -1)
    return (
        timed.withColumn("_inside", F.max("stage_end_ts").over(inside))
        .join(earlier, ["name", SLOT])
        .withColumn("latest_end_before", F.greatest("_inside", "_earlier"))
        .where(F.col("stage_start_ts") <= F.col("latest_end_before"))
        .select("name", "stage_num_td", "stage_start_ts", "latest_end_before")
    )


def check_no_overlaps(windows: DataFrame) -> None:
    """Refuse a stage index whose windows overlap."""
    bad = overlap_violations(windows).limit(10).collect()
    if bad:
        raise ValueError(f"stage windows overlap: {[r.asDict() for r in bad]}")


def sampling_gaps(df: DataFrame, keys: list[str], ts: str, slot_seconds: float) -> DataFrame:
    """Seconds from each row to the row before it, within ``keys``."""
    lone = df.select(*keys, ts)
    haloed = with_halo(lone, keys, ts, before=1, slot_seconds=slot_seconds)
    gap = seconds_between(F.lag(ts).over(in_slot(keys, ts)), ts)
    return drop_halo(haloed.withColumn("gap_seconds", gap)).where(F.col("gap_seconds").isNotNull())
