"""Whole flows: from readings to stages, labels, anomalies, scores and roll-ups.

Each flow takes frames and returns frames; the caller decides where they are
written. A frame that later steps use more than once is stored first.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.clean import blank_to
from ..functions.numbers import MICROS, micros, slot_start
from ..operators import anomaly, joins, labelling, ordinals, rollup, scores, stages
from ..operators.anomaly import STAGE, TIME, Limits
from ..operators.intervals import interval_join, windows_holding
from ..operators.islands import event_segments
from ..operators.labelling import Labeller
from ..operators.ordered import SLOT_SECONDS
from ..session import stored
from ..sources import reads, signatures, writes

# Versions that results are stored under.
ANOMALY_VERSION = "ds-v1"
TUNING_VERSION = "tuning-v1"
SCORE_VERSION = "stage-execution-v1.0"
NORMALIZATION_VERSION = "percentile-v1"

WINDOW_COLUMNS = ["name", "record_ts", "created_ts", "fleet_name", "pad_name", "id", "api_num", *stages.WINDOW_MEASURES]


def _readings(df: DataFrame) -> DataFrame:
    return df.select(*[c for c in WINDOW_COLUMNS if c in df.columns])


READING_KEY = ["created_ts", "record_ts", "name"]


def one_per_key(old: DataFrame, new: DataFrame) -> DataFrame:
    """Old and new readings, each key once: a resent reading takes the place of the stored one.

    Grouped by the whole reading key, so no well's rows meet in one task.
    """
    both = old.withColumn("_turn", F.lit(0)).unionByName(new.withColumn("_turn", F.lit(1)), allowMissingColumns=True)
    return joins.latest_per_key(both, [c for c in READING_KEY if c in both.columns], ["_turn", "id"] if "id" in both.columns else ["_turn"]).drop("_turn")


def apply_batch(stored_rows: DataFrame, batch: DataFrame, windows: DataFrame, gap_seconds: float) -> dict[str, DataFrame]:
    """Bring a stage index up to date with a batch of readings, late ones included.

    Rows after their well's last reading go on numbering. A late row takes the
    stage of the one window that holds it. A well with a late row outside every
    window, or inside several, is cut again from its full history. Windows that
    gained rows are rebuilt from their rows, one per key of created time,
    record time and well, so reading a batch twice changes nothing and a
    resent reading replaces the old one. Returns the new ``windows``, the ``repair_wells`` and the readings
    ``assigned`` outside repair.
    """
    state = stages.session_state(windows)
    split = stages.split_late(_readings(batch), state)
    placed = stored(windows_holding(split.where("is_late").drop("is_late"), windows, "record_ts", "stage_start_ts", "stage_end_ts", "stage_num_td"), "late-rows")
    # Stored, so that plans are made for as many wells as there are: a shuffle by well would leave each well's readings to one task.
    repair = stored(placed.where(F.col("matches") != 1).select("name").distinct(), "repair-wells")
    late = placed.join(repair, "name", "left_anti").withColumn("stage_num_td", F.col("matched_value")).drop("matches", "matched_value")
    normal = split.where(~F.col("is_late")).drop("is_late").join(repair, "name", "left_anti")
    assigned = stored(stages.assign_stages(normal, gap_seconds, prior=state).unionByName(late), "assigned")
    touched = assigned.select(*STAGE).distinct()

    known = windows.join(touched, STAGE, "left_semi").select(*STAGE, "stage_start_ts", "stage_end_ts")
    before = _rows_in(stored_rows, known)
    rebuilt = stages.windows_of_assigned(one_per_key(before, assigned))
    kept = windows.join(repair, "name", "left_anti").join(touched, STAGE, "left_anti")
    out = kept.unionByName(rebuilt, allowMissingColumns=True)
    if not repair.isEmpty():
        every = one_per_key(_readings(stored_rows), _readings(batch))
        out = out.unionByName(stages.stage_windows(every, gap_seconds, wells=repair), allowMissingColumns=True)
    return {"windows": out, "repair_wells": repair, "assigned": assigned, "touched": touched}


def _rows_in(rows: DataFrame, windows: DataFrame) -> DataFrame:
    """Readings inside the windows.

    The windows' overall range is looked up first and filtered on as literals,
    so the scan of the history skips files and row groups outside it.
    """
    lo, hi = windows.agg(F.min("stage_start_ts"), F.max("stage_end_ts")).first()
    if lo is not None:
        rows = rows.where(F.col("record_ts").between(reads.time_literal(lo), reads.time_literal(hi)))
    return interval_join(_readings(rows), windows, "record_ts", "stage_start_ts", "stage_end_ts").drop("stage_start_ts", "stage_end_ts")


def affected_rows(rows: DataFrame, windows: DataFrame) -> DataFrame:
    """All readings inside the changed windows, each once."""
    return _rows_in(rows, windows.select(*STAGE, "stage_start_ts", "stage_end_ts")).distinct()


def label_rows(rows: DataFrame, labeller: Labeller, context_rows: int = 0, slot_seconds: float | None = None) -> DataFrame:
    ready = rows.select("name", "stage_num_td", F.col("record_ts").alias(TIME), *stages.WINDOW_MEASURES)
    return labelling.label_stages(ready, labeller, context_rows, slot_seconds=slot_seconds)


def live_stage_flow(
    stored_rows: DataFrame, batch: DataFrame, windows: DataFrame, gap_seconds: float,
    marker: Labeller, labeller: Labeller, context_rows: int = 0, slot_seconds: float | None = None,
) -> dict[str, DataFrame]:
    """Stages, marker labels and design labels after one batch.

    Only windows that changed, or that got readings, if only a resent one with
    another value, are read again and relabelled.
    """
    step = apply_batch(stored_rows, batch, windows, gap_seconds)
    after = stored(step["windows"], "windows")
    same = ["stage_start_ts", "stage_end_ts", "sample_count"]
    again = interval_join(batch.join(step["repair_wells"], "name", "left_semi").select("name", "record_ts"), after.select(*STAGE, "stage_start_ts", "stage_end_ts"), "record_ts", "stage_start_ts", "stage_end_ts")
    moved = after.join(windows.select(*STAGE, *same), [*STAGE, *same], "left_anti").select(*STAGE)
    changed = after.join(moved.unionByName(step["touched"]).unionByName(again.select(*STAGE)).distinct(), STAGE, "left_semi")
    stages.check_no_overlaps(after.join(changed.select("name").distinct(), "name", "left_semi"))
    spans = changed.select(*STAGE, "stage_start_ts", "stage_end_ts")
    rows = stored(one_per_key(_rows_in(stored_rows, spans), _rows_in(batch, spans)), "affected")
    markers = stored(label_rows(rows, marker, context_rows, slot_seconds), "markers")
    ready = rows.select("name", "stage_num_td", F.col("record_ts").alias(TIME), *stages.WINDOW_MEASURES)
    labels = labelling.two_pass_labels(ready, markers, labeller, context_rows, slot_seconds=slot_seconds)
    return {"windows": after, "markers": markers, "labels": labels, "repair_wells": step["repair_wells"]}


def merged_feed_flow(stored_rows: DataFrame, batch: DataFrame, windows: DataFrame, gap_seconds: float) -> dict[str, DataFrame]:
    """Upsert the batch into the merged readings, then refresh stages and the well index.

    ``readings`` is a plan, not a copy of the history: write it with
    ``upsert_folder``, which rewrites the touched days only.
    """
    merged = writes.upsert_by_key(stored_rows, batch, READING_KEY, [*READING_KEY, "id"])
    step = apply_batch(stored_rows, batch, windows, gap_seconds)
    touched = batch.select("name").distinct()
    wells = rollup.well_index(merged.join(touched, "name", "left_semi"))
    return {"readings": merged, "windows": step["windows"], "wells": wells}


def recompute_wells(
    rows: DataFrame, names: DataFrame, windows: DataFrame, gap_seconds: float, dry_run: bool = True
) -> dict[str, DataFrame]:
    """Cut the named wells again from all their rows and replace their windows.

    A dry run reports what would be written and leaves the index as it is.
    """
    fresh = stages.stage_windows(_readings(rows.join(names.select("name").distinct(), "name", "left_semi")), gap_seconds)
    plan = fresh.groupBy("name").agg(F.count(F.lit(1)).alias("stages_to_write"), F.sum("sample_count").alias("rows_to_write"))
    if dry_run:
        return {"windows": windows, "plan": plan}
    fresh = stored(fresh, "recomputed")
    stages.check_no_overlaps(fresh)
    return {"windows": writes.replace_entity(windows, fresh), "plan": plan, "fresh": fresh}


def recompute_flow(rows: DataFrame, names: DataFrame, windows: DataFrame, gap_seconds: float, marker: Labeller, labeller: Labeller) -> dict[str, DataFrame]:
    """Everything that is derived from the named wells, made again from all their rows: windows, well index, marker and design labels.

    ``windows`` comes with the wells' old windows replaced; the other results
    are the named wells' own, for ``replace_entity``.
    """
    own = stored(rows.join(names.select("name").distinct(), "name", "left_semi"), "own")
    step = recompute_wells(own, own, windows, gap_seconds, dry_run=False)
    assigned = stored(stages.assign_stages(_readings(own), gap_seconds), "assigned")
    markers = stored(label_rows(assigned, marker), "markers")
    ready = assigned.select("name", "stage_num_td", F.col("record_ts").alias(TIME), *stages.WINDOW_MEASURES)
    return {**step, "wells": rollup.well_index(own), "markers": markers, "labels": labelling.two_pass_labels(ready, markers, labeller)}


def rollup_flow(rows: DataFrame, previous: DataFrame | None, bucket_seconds: int, start: datetime | str | None = None, end: datetime | str | None = None, now: datetime | str | None = None) -> DataFrame:
    """Roll-up of ``[start, end)``, aligned outward to whole buckets, upserted into the stored one.

    A bucket that is refreshed keeps the time it was first made.
    """
    if start is not None:
        rows = rows.where(F.col("record_ts") >= slot_start(reads.time_literal(start), bucket_seconds))
    if end is not None:
        edge = reads.time_literal(end) - F.make_dt_interval(secs=F.lit(0.000001))
        upper = F.timestamp_micros(micros(slot_start(edge, bucket_seconds)) + F.lit(int(bucket_seconds) * MICROS)).cast("timestamp_ntz")
        rows = rows.where(F.col("record_ts") < upper)
    stamp = reads.time_literal(now) if now is not None else F.localtimestamp()
    fresh = rollup.tumbling_rollup(rows, bucket_seconds).withColumn("rollup_created_at", stamp).withColumn("rollup_updated_at", stamp)
    if previous is None:
        return fresh
    keys = ["bucket_seconds", "bucket_ts", "fleet_name", "pad_name", "name"]
    first_made = previous.select(*keys, F.col("rollup_created_at").alias("_made"))
    fresh = fresh.join(first_made, keys, "left").withColumn("rollup_created_at", F.coalesce("_made", "rollup_created_at")).drop("_made")
    return writes.upsert_by_key(previous, fresh, keys)


def row_label_flow(
    rows: DataFrame, previous: DataFrame | None, mode: str, now: datetime, gap_seconds: float,
    labeller: Labeller, context_rows: int = 0, version: str = "rows-v2", slot_seconds: float | None = None,
) -> DataFrame:
    """Second-generation row labels of the look-back; older labels of a well stay."""
    bounded = reads.mode_bounded_read(rows, mode, now)
    assigned = stages.assign_stages(_readings(bounded), gap_seconds)
    labels = label_rows(assigned, labeller, context_rows, slot_seconds)
    per_well = assigned.groupBy("name").agg(F.count(F.lit(1)).alias("n"), F.min("record_ts").alias("lo"), F.max("record_ts").alias("hi"))
    signed = per_well.select("name", signatures.source_signature(per_well, version, ["name", "n", "lo", "hi"]).alias("source_signature"))
    fresh = labels.join(signed, "name").withColumn("algorithm_version", F.lit(version))
    return fresh if previous is None else writes.replace_entity_range(previous, fresh, TIME)


def ordinal_flow(markers: DataFrame, telemetry: DataFrame, version: str = "ordinals-v1") -> dict[str, DataFrame]:
    """Row ordinals in three forms, and the stage windows of each form; the layer is part of the key."""
    rows = stored(ordinals.marker_ordinals(markers), "ordinals")
    layers = [ordinals.ordinal_windows(rows, telemetry, layer) for layer in ordinals.LAYERS]
    index = layers[0].unionByName(layers[1]).unionByName(layers[2]).withColumn("algorithm_version", F.lit(version))
    return {"rows": rows, "windows": index}


def stage_sources(windows: DataFrame, wells: DataFrame | None = None) -> DataFrame:
    """Per stage the values whose change makes it due again, with its site."""
    s = windows.where(F.col("stage_start_ts").isNotNull() & F.col("stage_end_ts").isNotNull())
    if wells is not None:
        site = joins.latest_per_key(wells.select("name", F.col("fleet_name").alias("_fleet"), F.col("pad_name").alias("_pad")), ["name"], ["_fleet", "_pad"])
        s = s.join(site, "name", "left")
    else:
        s = s.withColumn("_fleet", F.lit(None).cast("string")).withColumn("_pad", F.lit(None).cast("string"))
    return s.select(
        blank_to("_fleet", "fleet_name").alias("fleet_name"),
        blank_to("_pad", "pad_name").alias("pad_name"),
        *STAGE,
        F.col("sample_count").alias("source_rows"),
        F.col("stage_start_ts").alias("first_source_ts"),
        F.col("stage_end_ts").alias("last_source_ts"),
        F.coalesce("last_created_ts", "stage_end_ts").alias("latest_source_updated_at"),
    )


SOURCE_FIELDS = ["name", "stage_num_td", "source_rows", "first_source_ts", "last_source_ts", "latest_source_updated_at"]


def anomaly_flow(
    labels: DataFrame, sources: DataFrame, manifest: DataFrame | None, run_id: str, now: datetime | str,
    limits: Limits = Limits(), version: str = ANOMALY_VERSION, max_stages: int | None = None, slot_seconds: float = SLOT_SECONDS,
) -> dict[str, DataFrame]:
    """Anomalies of the stages that changed: row labels, events, stage summary and manifest rows.

    ``has_more`` (one row) tells whether ``max_stages`` left any for another run.
    """
    due = sources
    if manifest is not None:
        seen = manifest.where((F.col("algorithm_version") == version) & (F.col("status") == "active"))
        due = joins.changed_candidates(due, seen, {c: c for c in ("source_rows", "last_source_ts", "latest_source_updated_at")})
    due, more = _batch_of(due, max_stages)
    stamp = reads.time_literal(now)
    due = stored(due.withColumn("source_signature", signatures.source_signature(due, version, SOURCE_FIELDS)), "due")
    rows = stored(anomaly.row_anomalies(labels.join(due.select(*STAGE), STAGE, "left_semi"), limits, slot_seconds).where(F.col("anomaly").isNotNull()), "anomalies")
    events = stored(event_segments(rows, limits.max_gap_seconds, run_id=run_id, slot_seconds=slot_seconds), "events")
    run = [F.lit(run_id).alias("processing_run_id"), F.lit(version).alias("algorithm_version")]
    site = due.select(*STAGE, "fleet_name", "pad_name", "source_signature")

    def tagged(df: DataFrame) -> DataFrame:
        return df.join(site, STAGE).select("*", *run, stamp.alias("created_at"))

    summary = anomaly.stage_event_counts(
        due.select("fleet_name", "pad_name", *STAGE, F.col("first_source_ts").alias("stage_start_ts"), F.col("last_source_ts").alias("stage_end_ts"), "source_rows", "source_signature"), events
    ).select("*", *run, stamp.alias("created_at"))
    manifest_rows = due.select(
        "fleet_name", "pad_name", *STAGE, F.lit(version).alias("algorithm_version"), F.lit(run_id).alias("active_run_id"), "source_signature",
        "source_rows", "first_source_ts", "last_source_ts", "latest_source_updated_at", stamp.alias("processed_at"), F.lit("active").alias("status"),
    )
    return {"labels": tagged(rows), "events": tagged(events), "summary": summary, "manifest": manifest_rows, "has_more": more}


def tuning_flow(labels: DataFrame, due: DataFrame, tuned: DataFrame | None, now: datetime | str, version: str = TUNING_VERSION, slot_seconds: float = SLOT_SECONDS, packed: bool = False) -> DataFrame:
    """Threshold grid of the stages whose source signature is new.

    ``packed`` leaves the counts of a stage, width and measure in one row, to
    be spread by ``anomaly.grid_rows`` when all runs are done.
    """
    if tuned is not None:
        due = joins.changed_candidates(due, tuned, {"source_signature": "source_signature"})
    base = due.select("fleet_name", "pad_name", *STAGE, "source_signature")
    make = anomaly.threshold_profiles if packed else anomaly.threshold_grid
    grid = make(labels.join(due.select(*STAGE), STAGE, "left_semi"), base, slot_seconds)
    return grid.withColumn("algorithm_version", F.lit(version)).withColumn("updated_at", reads.time_literal(now))


def _batch_of(due: DataFrame, max_stages: int | None) -> tuple[DataFrame, DataFrame]:
    """The stages of this run, and in one row whether others are left."""
    if max_stages is None:
        return due, due.sparkSession.createDataFrame([(False,)], "has_more boolean")
    batch = stored(reads.work_batch(due, STAGE, max_stages), "batch")
    return due.join(batch.select(*STAGE), STAGE, "left_semi"), batch.agg(F.coalesce(F.bool_or("has_more"), F.lit(False)).alias("has_more"))


def tuning_manifest(done: DataFrame, now: datetime | str, version: str = TUNING_VERSION) -> DataFrame:
    """What the grid of each stage was made from."""
    return done.select(*STAGE, "source_signature", F.lit(version).alias("algorithm_version"), reads.time_literal(now).alias("processed_at"), F.lit("active").alias("status"))


def tuning_run(
    labels: DataFrame, due: DataFrame, manifest: DataFrame | None, grid: DataFrame | None, now: datetime | str, max_stages: int | None = None,
    version: str = TUNING_VERSION, slot_seconds: float = SLOT_SECONDS, packed: bool = False,
) -> dict[str, DataFrame]:
    """One limited tuning run: the grids of changed stages replace the stored ones; returns ``grid``, ``manifest`` and ``has_more``.

    With ``packed`` the grid that comes in and the one that goes out are packed as ``tuning_flow`` says.
    """
    if manifest is not None:
        seen = manifest.where((F.col("algorithm_version") == version) & (F.col("status") == "active"))
        due = joins.changed_candidates(due, seen, {"source_signature": "source_signature"})
    due, more = _batch_of(due, max_stages)
    due = stored(due, "due")
    fresh = stored(tuning_flow(labels, due, None, now, version, slot_seconds, packed), "fresh-grid")
    done = tuning_manifest(due, now, version)
    return {
        "grid": fresh if grid is None else stored(joins.keep_last(grid, fresh, STAGE), "grid"),
        "manifest": done if manifest is None else stored(joins.keep_last(manifest, done, STAGE), "tuning-manifest"),
        "has_more": more,
    }


def score_flow(
    labels: DataFrame, markers: DataFrame, events: DataFrame, sources: DataFrame, previous: DataFrame | None = None, slot_seconds: float = SLOT_SECONDS, max_stages: int | None = None,
) -> dict[str, DataFrame]:
    """Parts of the changed stages merged over the stored ones, then scores of the whole population.

    ``previous`` are the stored parts: stages whose source signature they hold
    are not computed again. With ``max_stages`` a run takes so many at most,
    and ``has_more`` (one row) tells whether others are left.
    """
    due = sources.select(*STAGE, "fleet_name", "pad_name", signatures.source_signature(sources, SCORE_VERSION, SOURCE_FIELDS).alias("source_signature"))
    if previous is not None:
        due = joins.changed_candidates(due, previous.where(F.col("formula_version") == SCORE_VERSION), {"source_signature": "source_signature"})
    due, more = _batch_of(due, max_stages)
    due = stored(due, "due")
    of_due = [df.join(due.select(*STAGE), STAGE, "left_semi") for df in (labels, markers, events)]
    parts = scores.quality_parts(of_due[0], labelling.design_medians(of_due[1]), of_due[2], slot_seconds)
    parts = parts.join(due, STAGE).withColumn("formula_version", F.lit(SCORE_VERSION))
    if previous is not None:
        parts = joins.keep_last(previous, parts, [*STAGE, "formula_version"])
    parts = stored(parts, "parts")
    population = signatures.population_signature(parts, f"{SCORE_VERSION}|{NORMALIZATION_VERSION}", STAGE, "source_signature")
    scored = scores.population_scores(parts).withColumn("normalization_version", F.lit(NORMALIZATION_VERSION))
    return {"parts": parts, "scores": joins.with_scalar(scored, population), "has_more": more}
