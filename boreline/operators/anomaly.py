"""Row anomalies of a stage, their events, and counts over them.

The detection rules are this project's own: see the README.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.clean import is_design
from ..functions.display import ANOMALY_KINDS
from ..functions.numbers import UNIT, units
from ..session import stored
from .islands import long_run, neighbours
from .ordered import SLOT_SECONDS, drop_halo, in_slot, with_halo

STAGE = ["name", "stage_num_td"]
TIME = "datetime_fmt"

# Default limits of the detection and the threshold grid.
PRESSURE_THRESHOLD = 200.0
RATE_THRESHOLD = 5.0
MAX_GAP_SECONDS = 120.0
GRID_ROLLING = range(1, 11)
GRID_PRESSURE = range(50, 501, 10)
GRID_RATE = range(1, 21)

SHUTDOWN_RATE = 1.0
SHUTDOWN_ROWS = 3
SWEEP_ROWS = 3


@dataclass(frozen=True)
class Limits:
    pressure: float = PRESSURE_THRESHOLD
    rate: float = RATE_THRESHOLD
    rolling_points: int = 1
    max_gap_seconds: float = MAX_GAP_SECONDS
    shutdown_rate: float = SHUTDOWN_RATE
    shutdown_rows: int = SHUTDOWN_ROWS
    sweep_rows: int = SWEEP_ROWS


def _rolling_delta(measure: str, points: int, line) -> Column:
    """Change of the mean of the last ``points`` values, in units of 1e-6; null on the first row."""

    def mean(first: int, last: int) -> Column:
        frame = line.rowsBetween(first, last)
        return F.sum(measure).over(frame) / F.count(measure).over(frame)

    return F.round(mean(1 - points, 0) - mean(-points, -1)).cast("bigint")


def design_rows(labels: DataFrame) -> DataFrame:
    return labels.where(F.col(TIME).isNotNull() & is_design("substage"))


def rolling_deltas(labels: DataFrame, points: int = 1, slot_seconds: float = SLOT_SECONDS) -> DataFrame:
    """Design rows with ``delta_pressure`` and ``delta_rate`` of their rolling means."""
    rows = design_rows(labels).withColumn("_p", units("press_mainline")).withColumn("_r", units("rate_slurry"))
    haloed = with_halo(rows, STAGE, TIME, before=points, slot_seconds=slot_seconds)
    line = in_slot(STAGE, TIME)
    out = haloed.withColumn("delta_pressure", _rolling_delta("_p", points, line) / UNIT).withColumn(
        "delta_rate", _rolling_delta("_r", points, line) / UNIT
    )
    return drop_halo(out).drop("_p", "_r")


def delta_traces(labels: DataFrame, limits: Limits = Limits(), slot_seconds: float = SLOT_SECONDS) -> DataFrame:
    """Every row of a stage with its deltas and, where a limit is passed, the triggering value."""
    deltas = rolling_deltas(labels.select(*STAGE, TIME, "substage", "press_mainline", "rate_slurry"), limits.rolling_points, slot_seconds)
    rows = labels.where(F.col(TIME).isNotNull()).select(*STAGE, TIME)
    return rows.join(deltas.select(*STAGE, TIME, "delta_pressure", "delta_rate"), [*STAGE, TIME], "left").select(
        *STAGE,
        F.col(TIME).alias("timestamp"),
        "delta_pressure",
        "delta_rate",
        F.when(F.col("delta_pressure") >= limits.pressure, F.col("delta_pressure")).alias("pressure_trigger"),
        F.when(F.col("delta_rate") <= -limits.rate, F.col("delta_rate")).alias("rate_trigger"),
        F.lit(float(limits.pressure)).alias("pressure_threshold"),
        F.lit(-float(limits.rate)).alias("negative_rate_threshold"),
    )


def first_match(*candidates: tuple[Column, str]) -> Column:
    """Label of the first condition that holds."""
    return F.coalesce(*[F.when(mask, label) for mask, label in candidates])


def row_anomalies(labels: DataFrame, limits: Limits = Limits(), slot_seconds: float = SLOT_SECONDS) -> DataFrame:
    """Design rows with their ``anomaly`` (null where none).

    All masks come from one shuffled pass: the halo is wide enough for the
    deltas, for shutdown runs, and for the rows around those runs.
    """
    rows = (
        design_rows(labels)
        .select(*STAGE, TIME, "rate_slurry", "press_mainline")
        .withColumn("_p", units("press_mainline"))
        .withColumn("_r", units("rate_slurry"))
    )
    reach = limits.sweep_rows + limits.shutdown_rows - 1
    haloed = with_halo(rows, STAGE, TIME, before=max(reach, limits.rolling_points), after=reach, slot_seconds=slot_seconds)
    line = in_slot(STAGE, TIME)
    marked = haloed.withColumn("_shutdown", long_run(F.col("rate_slurry") < limits.shutdown_rate, limits.shutdown_rows, line))
    before, after = neighbours(F.col("_shutdown"), limits.sweep_rows, line)
    marked = (
        marked.withColumn("_before", before)
        .withColumn("_after", after)
        .withColumn("_dp", _rolling_delta("_p", limits.rolling_points, line))
        .withColumn("_dr", _rolling_delta("_r", limits.rolling_points, line))
    )
    label = first_match(
        (F.col("_shutdown"), "mid_stage_shutdown"),
        (F.col("_before"), "sweep_pre"),
        (F.col("_after"), "sweep_post"),
        (F.col("_dr") <= int(-limits.rate * UNIT), "pump_rate_drop"),
        (F.col("_dp") >= int(limits.pressure * UNIT), "pressure_surge"),
    )
    return drop_halo(marked).select(*STAGE, TIME, label.alias("anomaly"))


def stage_event_counts(stages: DataFrame, events: DataFrame) -> DataFrame:
    """Events per stage and kind; stages without events count zero."""
    kind = F.col("anomaly")

    def count(*kinds: str) -> Column:
        return F.count_if(kind.isin(*kinds))

    counts = events.groupBy(*STAGE).agg(
        F.count(F.lit(1)).alias("total_anomaly_lines"),
        count("pressure_surge").alias("pressure_surge_lines"),
        count("pump_rate_drop").alias("pump_rate_drop_lines"),
        count("mid_stage_shutdown").alias("mid_stage_shutdown_lines"),
        count("sweep_pre", "sweep_post").alias("sweep_lines"),
    )
    lines = [c for c in counts.columns if c.endswith("_lines")]
    return stages.join(counts, STAGE, "left").select(*stages.columns, *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in lines])


LINES = ["total_anomaly_lines", "pressure_surge_lines", "pump_rate_drop_lines", "mid_stage_shutdown_lines", "sweep_lines"]


def anomaly_summary(summary: DataFrame) -> DataFrame:
    """Wells, stages, stages with any anomaly, and totals per kind.

    Stages are summed per well first; distinct wells are then the row count.
    """
    return anomaly_by_well(summary).agg(
        F.count(F.lit(1)).alias("total_wells"),
        *[F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(n) for c, n in (("stages_total", "total_stages"), ("stages_with_anomaly", "stages_with_anomaly"), *((x, x) for x in LINES))],
    )


def anomaly_by_well(summary: DataFrame) -> DataFrame:
    return summary.groupBy(F.col("name").alias("well_name")).agg(
        F.count(F.lit(1)).alias("stages_total"),
        F.count_if(F.col("total_anomaly_lines") > 0).alias("stages_with_anomaly"),
        *[F.sum(c).cast("bigint").alias(c) for c in LINES],
    )


def anomaly_by_kind(summary: DataFrame) -> DataFrame:
    """Four rows, one per kind, from one row of sums."""
    totals = summary.agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for _, _, c, _ in ANOMALY_KINDS])
    rows = F.explode(
        F.array(*[F.struct(F.lit(n).alias("sort_order"), F.lit(t).alias("anomaly_type"), F.col(c).alias("anomaly_lines"), F.lit(k).alias("color")) for n, t, c, k in ANOMALY_KINDS])
    )
    return totals.select(rows.alias("_r")).select("_r.*")


def threshold_profiles(labels: DataFrame, stages: DataFrame, slot_seconds: float = SLOT_SECONDS) -> DataFrame:
    """Runs of design rows past the thresholds: one row per stage, rolling width and measure, with a count for each threshold as ``segment_counts``.

    A row starts a run for the thresholds its delta has reached and the delta
    of the row just before it had not. So each design row is turned into at
    most one interval of threshold numbers per width and measure, and the
    intervals that hold a threshold are counted, partly before the shuffle.
    Rows are never multiplied by the thresholds.
    """
    steps = {
        "pressure": (GRID_PRESSURE, 1),
        "rate": (GRID_RATE, -1),
    }
    most = max(GRID_ROLLING)
    rows = (
        labels.where(F.col(TIME).isNotNull())
        .select(*STAGE, TIME, is_design("substage").alias("_design"), units("press_mainline").alias("_p"), units("rate_slurry").alias("_r"))
    )
    line = in_slot(STAGE, TIME)
    near = with_halo(rows, STAGE, TIME, before=1, slot_seconds=slot_seconds)
    joined = F.coalesce(F.lag("_design").over(line), F.lit(False))
    design = stored(drop_halo(near.withColumn("_joined", joined)).where("_design").drop("_design"), "design-rows")
    haloed = with_halo(design, STAGE, TIME, before=most + 1, slot_seconds=slot_seconds)

    def reached(delta: Column, kind: str) -> Column:
        """How many thresholds of the kind a delta passes."""
        grid, sign = steps[kind]
        passed = (delta * sign - grid.start * UNIT + grid.step * UNIT) / (grid.step * UNIT)
        return F.when(delta.isNotNull(), F.greatest(F.lit(0), F.least(F.lit(len(grid)), F.floor(passed)))).otherwise(0).cast("int")

    families = [(kind, n) for kind in steps for n in GRID_ROLLING]
    source = {"pressure": "_p", "rate": "_r"}
    haloed = haloed.withColumns({f"_{k}_{n}": reached(_rolling_delta(source[k], n, line), k) for k, n in families})
    haloed = haloed.withColumns({f"_was_{k}_{n}": F.when(F.col("_joined"), F.lag(f"_{k}_{n}").over(line)).otherwise(0) for k, n in families})
    intervals = [
        F.when(
            F.col(f"_{k}_{n}") > F.col(f"_was_{k}_{n}"),
            F.struct(F.lit(n).alias("rolling_points"), F.lit(k).alias("threshold_type"), (F.col(f"_was_{k}_{n}") + 1).alias("low"), (F.col(f"_{k}_{n}") + 1).alias("high")),
        )
        for k, n in families
    ]
    started = drop_halo(haloed).select(*STAGE, F.explode(F.array_compact(F.array(*intervals))).alias("_i")).select(*STAGE, "_i.*")
    group = [*STAGE, "rolling_points", "threshold_type"]
    most_steps = max(len(GRID_PRESSURE), len(GRID_RATE))
    runs = [F.sum(((F.col("low") <= k) & (F.col("high") > k)).cast("int")) for k in range(1, most_steps + 1)]
    profile = started.groupBy(*group).agg(F.array(*runs).alias("_runs"))
    family = F.explode(F.array(*[F.struct(F.lit(n).alias("rolling_points"), F.lit(k).alias("threshold_type")) for k, n in families]))
    base = stages.withColumn("_f", family).select(*stages.columns, "_f.*")
    size = F.when(F.col("threshold_type") == "pressure", len(GRID_PRESSURE)).otherwise(len(GRID_RATE))
    counts = F.coalesce(F.slice("_runs", F.lit(1), size), F.array_repeat(F.lit(0), size)).cast("array<bigint>")
    return base.join(profile, group, "left").withColumn("segment_counts", counts).select(*base.columns, "segment_counts")


def grid_rows(profiles: DataFrame) -> DataFrame:
    """A row for each threshold of ``threshold_profiles``, in place of ``segment_counts``."""
    value = F.when(F.col("threshold_type") == "pressure", F.array(*[F.lit(float(v)) for v in GRID_PRESSURE])).otherwise(F.array(*[F.lit(float(v)) for v in GRID_RATE]))
    placed = profiles.select("*", F.posexplode(value).alias("_pos", "threshold_value"))
    return placed.withColumn("segment_count", F.get("segment_counts", F.col("_pos"))).drop("segment_counts", "_pos")


def threshold_grid(labels: DataFrame, stages: DataFrame, slot_seconds: float = SLOT_SECONDS) -> DataFrame:
    """Runs of design rows past each threshold, for every stage, rolling width and threshold."""
    return grid_rows(threshold_profiles(labels, stages, slot_seconds))


def trigger_counts(stages: DataFrame, grid: DataFrame, summary: DataFrame, pressure: float, rate: float, rolling_points: int, manifest: DataFrame | None = None) -> DataFrame:
    """Grid counts at the chosen thresholds beside the recorded shutdowns, zero where absent.

    ``manifest`` names the current ``source_signature`` of each stage; rows of
    the grid or summary that were made from another one are left out.
    """
    if manifest is not None:
        current = manifest.where(F.col("status") == "active") if "status" in manifest.columns else manifest
        current = current.select(*STAGE, "source_signature").distinct()
        grid = grid.join(current, [*STAGE, "source_signature"], "left_semi")
        if "source_signature" in summary.columns:
            summary = summary.join(current, [*STAGE, "source_signature"], "left_semi")
    chosen = grid.where(
        (F.col("rolling_points") == rolling_points)
        & (((F.col("threshold_type") == "pressure") & (F.col("threshold_value") == float(pressure))) | ((F.col("threshold_type") == "rate") & (F.col("threshold_value") == float(rate))))
    )
    picked = chosen.groupBy(*STAGE).agg(
        F.sum(F.when(F.col("threshold_type") == "pressure", F.col("segment_count"))).alias("_p"),
        F.sum(F.when(F.col("threshold_type") == "rate", F.col("segment_count"))).alias("_r"),
    )
    base = summary.select(*STAGE, F.col("mid_stage_shutdown_lines").alias("_s"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("bigint")
    return stages.select(*STAGE).join(picked, STAGE, "left").join(base, STAGE, "left").select(
        F.col("name").alias("well_name"),
        F.col("stage_num_td").alias("stage_num"),
        zero("_p").alias("pressure_surge_segments"),
        zero("_r").alias("pump_rate_drop_segments"),
        zero("_s").alias("mid_stage_shutdown_segments"),
        (zero("_p") + zero("_r")).alias("triggered_segments"),
    )


SEGMENTS = ["triggered_segments", "pressure_surge_segments", "pump_rate_drop_segments", "mid_stage_shutdown_segments"]


def trigger_summary(counts: DataFrame) -> DataFrame:
    names = ["total_triggered_segments", *SEGMENTS[1:]]
    return counts.agg(
        *[F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(n) for c, n in zip(SEGMENTS, names)],
        F.count_if(F.col("triggered_segments") > 0).alias("stages_with_trigger"),
    )


def trigger_by_well(counts: DataFrame) -> DataFrame:
    return counts.groupBy("well_name").agg(*[F.sum(c).cast("bigint").alias(c) for c in SEGMENTS])


def trigger_histogram(counts: DataFrame) -> DataFrame:
    return counts.groupBy("triggered_segments").agg(F.count(F.lit(1)).alias("stage_count"))


