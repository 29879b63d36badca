"""Parameterised reports: what the dashboards ask for.

Every scope parameter is optional. Unset ones leave no trace in the plan; set
ones are plain filters that Spark pushes into the scan. Live, merged and
historical reports differ only in the tables they are given.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.clean import ALL, DEFAULT_MEASURE, MEASURES, blank_to, chart_label, has_label, measure, number_text, point_id, time_text
from ..functions.display import (
    ANNOTATION_COLORS, ANNOTATION_OTHER, GAP_STAGE_COLOR, GROUND_TRUTH_COLOR, LABEL_COLORS, LABEL_OTHER,
    PAD_ANNOTATION_COLORS, PHASE_COLORS, PHASE_OTHER, driver_title, event_title, lookup,
)
from ..functions.numbers import minutes_interval
from ..operators.intervals import interval_join, merged_intervals, overlapping
from ..operators.islands import label_islands
from ..operators.joins import attach_labels
from ..operators.ordered import SLOT_SECONDS
from ..operators.rollup import bucket_average
from ..sources.reads import optional_filters, time_literal

# Names of the layers that every store has.
SHARED_LAYER = "manual:shared"
MODEL_LAYER = "system:model:platinum_substage_labels"

# Hours of the relative time ranges.
RELATIVE_HOURS = {"previous_6h": 6, "previous_12h": 12, "previous_48h": 48, "previous_72h": 72}


def _null(kind: str = "double") -> Column:
    return F.lit(None).cast(kind)


# --- time bounds -----------------------------------------------------------


def relative_bounds(first: str, last: str, time_range: str) -> tuple[Column, Column]:
    hours = RELATIVE_HOURS.get(time_range)
    start = F.col(first) if hours is None else F.greatest(F.col(first), F.col(last) - F.make_dt_interval(hours=F.lit(hours)))
    return start.alias("start_time"), F.col(last).alias("end_time")


def well_relative_bounds(wells: DataFrame, time_range: str) -> DataFrame:
    """Per well; the index stores its bounds as text."""
    timed = wells.select("name", F.col("first_record_ts").cast("timestamp_ntz").alias("_f"), F.col("last_record_ts").cast("timestamp_ntz").alias("_l"))
    return timed.where(F.col("_f").isNotNull() & F.col("_l").isNotNull()).select("name", *relative_bounds("_f", "_l", time_range))


def pad_relative_bounds(wells: DataFrame, stages: DataFrame, time_range: str, level: str) -> DataFrame:
    """Bounds at pad, well or stage level; the level is chosen before planning."""
    if level == "stage":
        rows = stages.groupBy("name", "stage_num_td").agg(F.min("stage_start_ts").alias("_f"), F.max("stage_end_ts").alias("_l"))
        keys = ["name", "stage_num_td"]
    else:
        keys = ["name"] if level == "well" else ["fleet_name", "pad_name"]
        scoped = wells.select(
            "name", blank_to("fleet_name").alias("fleet_name"), blank_to("pad_name").alias("pad_name"),
            F.col("first_record_ts").cast("timestamp_ntz").alias("_f"), F.col("last_record_ts").cast("timestamp_ntz").alias("_l"),
        )
        rows = scoped.groupBy(*keys).agg(F.min("_f").alias("_f"), F.max("_l").alias("_l"))
    return rows.where(F.col("_f").isNotNull()).select(*keys, F.lit(level).alias("scope_level"), *relative_bounds("_f", "_l", time_range))


def pad_time_bounds(wells: DataFrame) -> DataFrame:
    return wells.groupBy(blank_to("fleet_name").alias("fleet_name"), blank_to("pad_name").alias("pad_name")).agg(
        F.min("first_record_ts").alias("start_time"), F.max("last_record_ts").alias("end_time")
    )


def well_time_bounds(wells: DataFrame, well: str | None = None) -> DataFrame:
    return optional_filters(wells, well=well).select(F.col("name").alias("well_name"), F.col("first_record_ts").alias("start_time"), F.col("last_record_ts").alias("end_time"))


def stage_time_bounds(windows: DataFrame, well: str | None = None, stage: float | None = None, stage_col: str = "stage_num_td") -> DataFrame:
    """Bounds of a stage; where several rows share the number, the earliest."""
    scoped = optional_filters(windows, well=well, stage=stage, stage_col=stage_col)
    one = scoped.groupBy(F.col("name").alias("well_name"), F.col(stage_col).alias("stage_num")).agg(F.min(F.struct("stage_start_ts", "stage_end_ts")).alias("_w"))
    return one.select("well_name", "stage_num", F.col("_w.stage_start_ts").alias("start_time"), F.col("_w.stage_end_ts").alias("end_time"))


# --- option lists ----------------------------------------------------------


def fleet_options(wells: DataFrame) -> DataFrame:
    name = blank_to("fleet_name")
    return wells.select(name.alias("label"), name.alias("value")).distinct()


def pad_options(wells: DataFrame, fleet: str | None = None) -> DataFrame:
    scoped = optional_filters(wells, fleet=fleet)
    name = blank_to("pad_name")
    return scoped.select(name.alias("label"), name.alias("value"), blank_to("fleet_name").alias("fleet_name")).distinct()


def family_options(wells: DataFrame) -> DataFrame:
    return wells.where(F.col("well_family").isNotNull()).select(F.col("well_family").alias("label"), F.col("well_family").alias("value")).distinct()


def well_options(wells: DataFrame, fleet: str | None = None, pad: str | None = None, family: str | None = None) -> DataFrame:
    scoped = optional_filters(wells, fleet=fleet, pad=pad)
    if family is not None:
        scoped = scoped.where(F.col("well_family") == family)
    extra = [c for c in wells.columns if c != "name"]
    site = [blank_to(c).alias(f"{c}_option") for c in ("fleet_name", "pad_name") if c in wells.columns]
    return scoped.select(F.col("name").alias("label"), F.col("name").alias("value"), *extra, *site)


def well_options_with_all(wells: DataFrame, fleet: str | None = None, pad: str | None = None) -> DataFrame:
    names = optional_filters(wells, fleet=fleet, pad=pad).select(F.col("name").alias("value"), F.col("name").alias("label"), F.lit(1).alias("sort_order"))
    every = wells.sparkSession.createDataFrame([(ALL, "All wells", 0)], names.schema)
    return every.unionByName(names)


def stage_options(windows: DataFrame, well: str | None = None, stage_col: str = "stage_num_td") -> DataFrame:
    extra = [c for c in ("stage_start_ts", "stage_end_ts", "sample_count", "source_record_count") if c in windows.columns]
    return optional_filters(windows, well=well).select("name", F.col(stage_col).alias("label"), F.col(stage_col).alias("value"), *extra)


def labelled_stage_options(labels: DataFrame, well: str | None = None) -> DataFrame:
    """Stages that hold labels, after a "select" row; ordered by number."""
    text = number_text(F.col("stage_num_td").cast("double"))
    found = (
        optional_filters(labels, well=well)
        .where(F.col("stage_num_td").isNotNull() & has_label("substage"))
        .select("name", "stage_num_td")
        .distinct()
        .select("name", text.alias("value"), text.alias("label"), F.lit(1).alias("sort_order"))
    )
    names = found.select("name").distinct().select("name", F.lit("-1").alias("value"), F.lit("Select stage").alias("label"), F.lit(0).alias("sort_order"))
    return names.unionByName(found)


# --- charts ----------------------------------------------------------------

CHART = ["telemetry_point_id", "well_name", "timestamp", "stage_num", "rate_slurry", "press_mainline", "selected_concentration", "context_anchor", "records_in_bucket"]


def widened(bounds: DataFrame, context_minutes: float) -> DataFrame:
    """Bounds of wells or of their stages, widened on both sides; those of a well that meet are one, so no reading is shown twice."""
    pad = minutes_interval(context_minutes)
    return merged_intervals(bounds.select("name", (F.col("start_time") - pad).alias("_from"), (F.col("end_time") + pad).alias("_to")), "name", "_from", "_to")


def _in_bounds(rows: DataFrame, bounds: DataFrame, ts: str, half_open: bool = False) -> DataFrame:
    """Rows within bounds of their well, which do not overlap.

    The overall range is looked up first (one row) and filtered on as
    literals, so the scan skips files and row groups outside it; the join runs
    on well and day.
    """
    lo, hi = bounds.agg(F.min("_from"), F.max("_to")).first()
    if lo is not None:
        rows = rows.where(F.col(ts).between(time_literal(lo), time_literal(hi)))
    inside = interval_join(rows, bounds.select("name", "_from", "_to").toDF("name", "_open", "_shut"), ts, "_open", "_shut")
    return (inside.where(F.col(ts) < F.col("_shut")) if half_open else inside).drop("_open", "_shut")


def anchors(bounds: DataFrame) -> DataFrame:
    """Two rows per stretch of time that pin the chart's ends."""
    ends = F.explode(F.array(F.struct(F.lit("context_start").alias("w"), F.col("_from").alias("t")), F.struct(F.lit("context_end").alias("w"), F.col("_to").alias("t"))))
    e = bounds.select("name", ends.alias("_e"))
    return e.select(
        point_id("name", "_e.w", time_text("_e.t")).alias("telemetry_point_id"), F.col("name").alias("well_name"), F.col("_e.t").alias("timestamp"),
        _null().alias("stage_num"), _null().alias("rate_slurry"), _null().alias("press_mainline"), _null().alias("selected_concentration"),
        F.lit(0.0).alias("context_anchor"), F.lit(0).cast("bigint").alias("records_in_bucket"),
    )


def break_times(*windows: DataFrame) -> DataFrame:
    """One millisecond after each stage end, each time once."""
    union = None
    for w in windows:
        ends = w.where(F.col("stage_end_ts").isNotNull()).select("name", "stage_end_ts")
        union = ends if union is None else union.unionByName(ends)
    return union.distinct().select("name", "stage_end_ts", (F.col("stage_end_ts") + F.make_dt_interval(secs=F.lit(0.001))).alias("break_ts"))


def line_breaks(times: DataFrame, tag: str = "stage_break") -> DataFrame:
    """Rows with null measures that stop a line from being drawn across a pause."""
    return times.select(
        point_id("name", F.lit(tag), time_text("break_ts")).alias("telemetry_point_id"), F.col("name").alias("well_name"), F.col("break_ts").alias("timestamp"),
        _null().alias("stage_num"), _null().alias("rate_slurry"), _null().alias("press_mainline"), _null().alias("selected_concentration"),
        _null().alias("context_anchor"), F.lit(0).cast("bigint").alias("records_in_bucket"),
    )


def _raw_points(rows: DataFrame) -> DataFrame:
    return rows.select(
        point_id("name", time_text("record_ts")).alias("telemetry_point_id"), F.col("name").alias("well_name"), F.col("record_ts").alias("timestamp"),
        F.col("stage_num_td").cast("double").alias("stage_num"), "rate_slurry", "press_mainline", "selected_concentration",
        _null().alias("context_anchor"), F.lit(1).cast("bigint").alias("records_in_bucket"),
    )


def chart_window(rows: DataFrame, windows: DataFrame, bounds: DataFrame, context_minutes: float, concentration: str | None = None) -> DataFrame:
    """Readings around each well's bounds with their stage number, and two anchors per well."""
    wide = widened(bounds, context_minutes)
    inside = _in_bounds(rows.select("name", "record_ts", "rate_slurry", "press_mainline", measure(concentration).alias("selected_concentration")), wide, "record_ts")
    held = interval_join(inside, windows.select("name", "stage_num_td", "stage_start_ts", "stage_end_ts"), "record_ts", "stage_start_ts", "stage_end_ts", "left")
    return _raw_points(held).unionByName(anchors(wide))


def history_chart(rows: DataFrame, bounds: DataFrame, context_minutes: float) -> DataFrame:
    inside = _in_bounds(rows, widened(bounds, context_minutes), "datetime_fmt")
    return inside.select(
        point_id("name", number_text(F.col("stage_num").cast("double")), time_text("datetime_fmt")).alias("telemetry_point_id"),
        F.col("name").alias("well_name"), F.col("datetime_fmt").alias("timestamp"), "stage_num", "rate_slurry", "press_mainline", "prop_conc_blend_denso", "records_in_bucket",
    )


def pick_resolution(well: str | None, stage: float | None, requested: str | None = None) -> str:
    """Raw rows for one stage, else what was asked for, else 60 s for a well and 120 s for a pad."""
    if stage is not None and stage >= 0:
        return "raw"
    if requested in ("raw", "rollup_60s", "rollup_120s"):
        return requested
    return "rollup_120s" if well in (None, "", ALL) else "rollup_60s"


# Bucket width of each chart resolution, in seconds.
RESOLUTION_SECONDS = {"rollup_60s": 60, "rollup_120s": 120}


def pad_chart(
    rows: DataFrame, windows: DataFrame, bounds: DataFrame, context_minutes: float, concentration: str | None = None,
    well: str | None = None, stage: float | None = None, requested: str | None = None, bucket_seconds: int | None = None,
) -> DataFrame:
    """Chart of all wells of a pad: raw or bucketed readings, anchors, and breaks at stage ends.

    The branch is picked before planning, so only one of them is in the plan.
    """
    resolution = pick_resolution(well, stage, requested)
    rows = optional_filters(rows, well=well)
    windows = optional_filters(windows, well=well, stage=stage)
    bounds = optional_filters(bounds, well=well)
    wide = widened(bounds, context_minutes)
    ready = rows.select("name", "record_ts", "rate_slurry", "press_mainline", measure(concentration).alias("selected_concentration"))
    inside = _in_bounds(ready, wide, "record_ts")
    if resolution == "raw":
        how = "inner" if stage is not None and stage >= 0 else "left"
        points = _raw_points(interval_join(inside, windows.select("name", "stage_num_td", "stage_start_ts", "stage_end_ts"), "record_ts", "stage_start_ts", "stage_end_ts", how))
    else:
        width = bucket_seconds or RESOLUTION_SECONDS[resolution]
        b = bucket_average(inside, width, ["rate_slurry", "press_mainline", "selected_concentration"])
        points = b.select(
            point_id("name", time_text("bucket_ts")).alias("telemetry_point_id"), F.col("name").alias("well_name"), F.col("bucket_ts").alias("timestamp"),
            _null().alias("stage_num"), "rate_slurry", "press_mainline", "selected_concentration", _null().alias("context_anchor"), "records_in_bucket",
        )
    breaks = _in_bounds(break_times(windows), wide, "stage_end_ts", half_open=True)
    return points.unionByName(anchors(wide)).unionByName(line_breaks(breaks))


def segmentation_chart(
    rows: DataFrame, rollup: DataFrame | None, gap_windows: DataFrame, given_windows: DataFrame, bounds: DataFrame,
    context_minutes: float, concentration: str | None = None, use_rollup: bool = False,
) -> DataFrame:
    """Readings or stored buckets of each well with breaks from two stage sources; half-open bounds."""
    wide = widened(bounds, context_minutes)

    def half_open(df: DataFrame, ts: str) -> DataFrame:
        return _in_bounds(df, wide, ts, half_open=True)

    if use_rollup:
        source = half_open(rollup, "bucket_ts")
        column = MEASURES.get(concentration or "", DEFAULT_MEASURE)
        points = source.select(
            point_id("name", time_text("bucket_ts")).alias("telemetry_point_id"), F.col("name").alias("well_name"), F.col("bucket_ts").alias("timestamp"),
            F.col("rate_slurry_avg").alias("rate_slurry"), F.col("press_mainline_avg").alias("press_mainline"), F.col(f"{column}_avg").alias("selected_concentration"),
            _null().alias("context_anchor"), "records_in_bucket",
        )
    else:
        points = half_open(rows, "record_ts").select(
            point_id("name", time_text("record_ts")).alias("telemetry_point_id"), F.col("name").alias("well_name"), F.col("record_ts").alias("timestamp"),
            "rate_slurry", "press_mainline", measure(concentration).alias("selected_concentration"), _null().alias("context_anchor"), F.lit(1).cast("bigint").alias("records_in_bucket"),
        )
    breaks = half_open(break_times(gap_windows, given_windows), "stage_end_ts")
    return points.unionByName(line_breaks(breaks, "line_break").drop("stage_num")).unionByName(anchors(wide).drop("stage_num"))


def label_chart(
    rows: DataFrame, labels: DataFrame, windows: DataFrame, context_minutes: float, concentration: str | None = None,
    with_design: bool = True, well: str | None = None, stage: float | None = None, with_stage: bool = True,
) -> DataFrame:
    """Readings around each stage with the labels of that stage and, for design labels, the design limits.

    ``windows`` gives ``name, stage_num_td, stage_start_ts, stage_end_ts``; a
    reading near two stages appears once for each. Labels carry gap-stage
    numbers: where the windows are ordinal stages, ``with_stage=False`` joins
    them by well and time alone.
    """
    pad = minutes_interval(context_minutes)
    scoped = optional_filters(windows, well=well, stage=stage)
    wide = scoped.select("name", F.col("stage_num_td").alias("_stage"), (F.col("stage_start_ts") - pad).alias("_c_start"), (F.col("stage_end_ts") + pad).alias("_c_end"))
    ready = optional_filters(rows, well=well).select("name", "record_ts", "rate_slurry", "press_mainline", measure(concentration).alias("selected_concentration"))
    near = interval_join(ready, wide, "record_ts", "_c_start", "_c_end").withColumn("stage_num_td", F.col("_stage"))
    design = [c for c in ("inferred_pressure", "inferred_design_rate") if c in labels.columns]
    joined = attach_labels(near, labels.select("name", *(["stage_num_td"] if with_stage else []), "datetime_fmt", "substage", *design), with_stage=with_stage)
    shown = chart_label("substage") if with_design else F.nullif(F.col("substage"), F.lit("NA"))
    rate = F.col("inferred_design_rate") if with_design else _null()
    points = joined.select(
        F.col("name").alias("well_name"), F.col("_stage").cast("double").alias("stage_num"), F.col("record_ts").alias("ts"), shown.alias("substage_label"),
        "rate_slurry", "press_mainline", "selected_concentration", (F.col("inferred_pressure") if with_design else _null()).alias("inferred_pressure"),
        rate.alias("design_rate"), (rate * 0.95).alias("design_rate_high"), (rate * 0.90).alias("design_rate_rampdown"), _null().alias("context_anchor"),
    )
    ends = wide.select("name", F.explode(F.array("_c_start", "_c_end")).alias("ts"))
    edge = ends.select(
        F.col("name").alias("well_name"), _null().alias("stage_num"), "ts", _null("string").alias("substage_label"),
        *[_null().alias(c) for c in ("rate_slurry", "press_mainline", "selected_concentration", "inferred_pressure", "design_rate", "design_rate_high", "design_rate_rampdown")],
        F.lit(0.0).alias("context_anchor"),
    )
    return points.unionByName(edge)


def stage_drilldown(rows: DataFrame, windows: DataFrame, well: str | None = None, stage: float | None = None) -> DataFrame:
    """Readings inside each stage."""
    scoped = optional_filters(windows, well=well, stage=stage).select("name", "stage_num_td", "stage_start_ts", "stage_end_ts")
    inside = interval_join(optional_filters(rows, well=well), scoped, "record_ts", "stage_start_ts", "stage_end_ts")
    return inside.select(
        point_id("name", time_text("record_ts")).alias("telemetry_point_id"), F.col("name").alias("well_name"), F.col("record_ts").alias("timestamp"),
        F.col("stage_num_td").alias("stage_num"), "press_mainline", "rate_slurry", F.col("prop_conc_blend_denso").alias("selected_concentration"),
    )


# --- label windows ---------------------------------------------------------


def label_windows(labels: DataFrame, phases: bool = False, well: str | None = None, stage: float | None = None, slot_seconds: float = SLOT_SECONDS) -> DataFrame:
    """Islands of each stage with their colour; ``phases`` for the pad/prop/flush alphabet."""
    scoped = optional_filters(labels, well=well, stage=stage).where(has_label("substage") & F.col("datetime_fmt").isNotNull())
    shown = F.col("substage") if phases else chart_label("substage")
    runs = label_islands(scoped.select("name", "stage_num_td", "datetime_fmt", shown.alias("substage_label")), ["name", "stage_num_td"], "datetime_fmt", "substage_label", slot_seconds=slot_seconds)
    colors, other = (PHASE_COLORS, PHASE_OTHER) if phases else (LABEL_COLORS, LABEL_OTHER)
    return runs.withColumn("color", lookup(F.lower("substage_label"), colors, other))


def label_windows_in(labels: DataFrame, windows: DataFrame, stage_col: str, phases: bool = False, slot_seconds: float = SLOT_SECONDS) -> DataFrame:
    """Islands inside given time windows, such as ordinal stages."""
    held = labels.where(has_label("substage") & F.col("datetime_fmt").isNotNull()).select("name", "datetime_fmt", "substage")
    inside = interval_join(held, windows.select("name", F.col(stage_col).alias("stage_num_td"), "stage_start_ts", "stage_end_ts"), "datetime_fmt", "stage_start_ts", "stage_end_ts")
    return label_windows(inside.drop("stage_start_ts", "stage_end_ts"), phases, slot_seconds=slot_seconds)


def stage_windows_in_range(windows: DataFrame, start: datetime | str, end: datetime | str, given: bool = False, well: str | None = None) -> DataFrame:
    """Stages that touch a time range, titled and coloured; ``given`` for the historical stage numbers."""
    column = "stage_num" if given else "stage_num_td"
    scoped = overlapping(optional_filters(windows, well=well), "stage_start_ts", "stage_end_ts", time_literal(start), time_literal(end))
    number = number_text(F.col(column).cast("double"))
    return scoped.select(
        "name", (F.concat(F.lit("Stage "), number) if given else number).alias("window_label"), F.col("stage_start_ts").alias("start_ts"), F.col("stage_end_ts").alias("end_ts"),
        F.lit(GROUND_TRUTH_COLOR if given else GAP_STAGE_COLOR).alias("color"), "sample_count",
    )


# --- annotations and layers ------------------------------------------------


def personal_layer(user: str) -> Column:
    return F.concat(F.lit("manual:user:"), F.md5(F.lit(user).cast("binary")))


def edit_flags(annotations: DataFrame, layers: DataFrame, user: str, fixed_layers: bool = False) -> DataFrame:
    """Add ``can_edit``: the user owns the editable user layer the row is on.

    With ``fixed_layers`` the shared layer and the user's own one are editable too.
    """
    held = layers.select("layer_id", (
        (F.coalesce("source_type", F.lit("user")) == "user") & F.coalesce("is_editable", F.lit(True)) & F.coalesce(F.col("owner_email") == user, F.lit(False))
    ).alias("_owned"))
    joined = annotations.join(held, "layer_id", "left")
    can = F.coalesce("_owned", F.lit(False))
    if fixed_layers:
        can = can | (F.col("layer_id") == SHARED_LAYER) | (F.col("layer_id") == personal_layer(user))
    return joined.withColumn("can_edit", can).drop("_owned")


def island_annotations(labels: DataFrame, pad: bool = False, labeler: str | None = None, slot_seconds: float = SLOT_SECONDS) -> DataFrame:
    """Label islands in the shape of annotations; zero-length ones are dropped, but a pad view keeps points."""
    held = labels.where(F.col("substage").isNotNull() & (F.col("substage") != "NA"))
    runs = label_islands(held.select("name", "stage_num_td", "datetime_fmt", "substage"), ["name", "stage_num_td"], "datetime_fmt", "substage", slot_seconds=slot_seconds)
    point = F.col("substage").isin("stage_start", "stage_end")
    kept = runs.where((F.col("start_ts") < F.col("end_ts")) | (point if pad else F.lit(False)))
    ident = F.concat_ws("|", F.lit("platinum"), "name", number_text(F.col("stage_num_td").cast("double")), "substage", time_text("start_ts"), time_text("end_ts"))
    return kept.select(
        F.md5(ident).alias("annotation_id"), F.lit(MODEL_LAYER).alias("layer_id"), F.lit("platinum_substage_labels").alias("rule_concept_id"),
        F.col("name").alias("well_name"), F.col("stage_num_td").cast("double").alias("stage_num"), F.col("substage").alias("substage_name"),
        F.col("start_ts").alias("start_time"), F.col("end_ts").alias("end_time"), F.col("start_ts").alias("timestamp"),
        F.when(point & F.lit(pad), "point").otherwise("window").alias("annotation_type"), F.lit(labeler).cast("string").alias("labeler_id"),
        F.lit("model").alias("source_type"), F.lit("system-model").alias("created_by_email"), F.lit("system-model").alias("updated_by_email"),
        F.lit(False).alias("can_edit"), F.lit("active").alias("status"), F.col("start_ts").alias("created_at"), F.col("end_ts").alias("updated_at"),
        lookup("substage", PAD_ANNOTATION_COLORS if pad else ANNOTATION_COLORS, ANNOTATION_OTHER).alias("color"),
    )


ANNOTATION_FIELDS = {
    "rule_concept_id": "string", "stage_num": "double", "substage_name": "string", "start_feature": "string", "end_feature": "string",
    "selected_feature": "string", "labeler_id": "string", "notes": "string", "created_by_email": "string", "updated_by_email": "string",
    "source_type": "string", "timestamp": "timestamp_ntz", "created_at": "timestamp_ntz", "updated_at": "timestamp_ntz",
}


def annotation_table(
    annotations: DataFrame, layers: DataFrame, labels: DataFrame, user: str, start: datetime | str, end: datetime | str,
    labeler: str | None = None, layer: str | None = None, own_layers_only: bool = False, pad: bool = False,
    well: str | None = None, slot_seconds: float = SLOT_SECONDS,
) -> DataFrame:
    """Human annotations and label islands of a time range in one table.

    ``own_layers_only`` keeps the shared and the personal layer (and, in a pad
    view, layers the user owns).
    """
    lo, hi = time_literal(start), time_literal(end)
    for column, kind in ANNOTATION_FIELDS.items():
        if column not in annotations.columns:
            annotations = annotations.withColumn(column, _null(kind))
    active = optional_filters(annotations, well=well).where(F.coalesce("status", F.lit("active")) == "active")
    human = overlapping(active, "start_time", "end_time", lo, hi)
    if own_layers_only:
        mine = (F.col("layer_id") == SHARED_LAYER) | (F.col("layer_id") == personal_layer(user))
        owned = layers.where(F.coalesce("status", F.lit("active")) == "active").where(_owned_by(layers, user)).select("layer_id", F.lit(True).alias("_mine"))
        human = human.join(owned, "layer_id", "left").where(mine | (F.coalesce("_mine", F.lit(False)) if pad else F.lit(False))).drop("_mine")
    flagged = edit_flags(human, layers, user, fixed_layers=own_layers_only)
    manual = flagged.select(
        "annotation_id", "layer_id", "rule_concept_id", F.col("name").alias("well_name"), "stage_num", "substage_name", "start_time", "end_time",
        F.coalesce("timestamp", "start_time").alias("timestamp"), "start_feature", "end_feature", "selected_feature", "annotation_type", "labeler_id", "notes",
        F.coalesce("source_type", F.lit("user")).alias("source_type"), "created_by_email", "updated_by_email", "can_edit",
        F.coalesce("status", F.lit("active")).alias("status"), "created_at", "updated_at", _null("string").alias("color"),
    )
    model = island_annotations(optional_filters(labels, well=well).where(F.col("datetime_fmt").between(lo, hi)), pad, labeler, slot_seconds)
    both = manual.unionByName(model, allowMissingColumns=True)
    return both if layer is None else both.where(F.col("layer_id") == layer)


def _owned_by(layers: DataFrame, user: str) -> Column:
    owner = F.coalesce(F.col("owner_email") == user, F.lit(False))
    if "created_by_email" in layers.columns:
        owner = owner | F.coalesce(F.col("created_by_email") == user, F.lit(False))
    return owner


def layer_edit_check(layers: DataFrame, user: str, layer: str | None = None, fixed_layers: bool = False) -> DataFrame:
    """``can_edit`` as 0 or 1 per layer."""
    scoped = layers.where(F.coalesce("status", F.lit("active")) == "active")
    if layer is not None:
        scoped = scoped.where(F.col("layer_id") == layer)
    can = F.coalesce("is_editable", F.lit(True)) & (_owned_by(layers, user) if fixed_layers else F.coalesce(F.col("owner_email") == user, F.lit(False)))
    if fixed_layers:
        can = can | (F.col("layer_id") == SHARED_LAYER) | (F.col("layer_id") == personal_layer(user))
    else:
        can = can & (F.coalesce("source_type", F.lit("user")) == "user")
    return scoped.select("layer_id", F.when(can, 1).otherwise(0).alias("can_edit"))


def fixed_layers(spark: SparkSession, user: str) -> DataFrame:
    """The model, shared and personal layers every user sees."""
    md5 = F.md5(F.lit(user).cast("binary"))
    # What the layer list shows for them.
    base = spark.createDataFrame(
        [
            (MODEL_LAYER, "Automatic Substage Labels", "System generated · Read-only", "platinum_substage_labels", "system-model", "model", False, -100),
            (SHARED_LAYER, "Manual", "Shared manual layer · Editable by everyone", "manual_shared", "shared", "user", True, 0),
            ("", f"Manual - {user}", "Personal manual layer · Editable only by you", "", user, "user", True, 10),
        ],
        "id string, name string, description string, rule_concept_id string, owner_email string, source_type string, can_edit boolean, display_order int",
    )
    return base.withColumn("id", F.when(F.col("id") == "", personal_layer(user)).otherwise(F.col("id"))).withColumn(
        "rule_concept_id", F.when(F.col("rule_concept_id") == "", F.concat(F.lit("manual_user_"), md5)).otherwise(F.col("rule_concept_id"))
    )


def layer_options(layers: DataFrame, labels: DataFrame, user: str, pad: bool = False) -> DataFrame:
    """Layers a user can pick: the fixed ones and those stored; the model layer only where labels exist."""
    spark = layers.sparkSession
    has = labels.where(F.col("substage").isNotNull() & (F.col("substage") != "NA")).select(F.lit(MODEL_LAYER).alias("id")).limit(1)
    fixed = fixed_layers(spark, user)
    if not pad:
        fixed = fixed.join(has, "id", "left_semi").unionByName(fixed.where(F.col("id") != MODEL_LAYER))
    editable = F.coalesce("is_editable", F.lit(True)) & _owned_by(layers, user)
    owner = F.coalesce(F.nullif("owner_email", F.lit("")), F.lit("unknown"))
    stored = layers.where(F.coalesce("status", F.lit("active")) == "active").select(
        F.col("layer_id").alias("id"), F.coalesce(F.nullif("layer_name", F.lit("")), "layer_id").alias("name"), F.concat(F.lit("User layer · "), owner).alias("description"),
        _null("string").alias("rule_concept_id") if "rule_concept_id" not in layers.columns else F.col("rule_concept_id"), "owner_email",
        F.coalesce("source_type", F.lit("user")).alias("source_type"), editable.alias("can_edit"), F.coalesce(F.col("display_order").cast("int"), F.lit(100)).alias("display_order"),
    )
    return fixed.unionByName(stored)


# --- event and score lists -------------------------------------------------


def event_list(events: DataFrame) -> DataFrame:
    return events.select(
        "event_id", F.col("name").alias("well_name"), F.col("stage_num_td").alias("stage_num"), "anomaly", event_title("anomaly").alias("anomaly_display"), "start_ts", "end_ts", "duration_sec", "duration_min"
    )


def score_ranking(scores: DataFrame, fleet: str | None = None, pad: str | None = None, well: str | None = None) -> DataFrame:
    """Stages from the lowest score up."""
    return optional_filters(scores, fleet, pad, well).select(
        F.col("name").alias("well_name"), number_text(F.col("stage_num_td").cast("double")).alias("stage_num"), "composite_score", "score_a", "score_b", "score_c", "score_d",
        driver_title("top_driver").alias("top_driver"), "anomaly_count", "substages_present", "design_minutes",
    )
