"""Flows, label hooks and streams bound to the test tables."""

from __future__ import annotations

import re
from datetime import datetime

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import anomaly, labelling, ordinals, rollup, stages
from ..operators.intervals import interval_join
from ..operators.joins import active_runs
from ..operators.labelling import GROUP, Fold, Grouped, Trimmed
from ..session import stored, work_path
from ..sources import catalog, reads, testviews as tv, writes
from ..sources.testviews import BUCKET_SECONDS, GAP_SECONDS, LONG_GAP_SECONDS
from ..streaming import live, merged, sessions
from . import flows, runs
from .bound import (
    ANOM_SQL, ROLLUP_COLUMNS, STATS, _rollup_sql, DESIGN_SQL, EVENT_SQL, FIRST, GRID_SQL, LATE_SQL, LIMITS, LINE_COLUMNS, ORDINAL_SQL, ORDINAL_WINDOW, SCORE_VALUES, SCORE_VIEWS, SLOT, SMARK,
    SUMMARY_SQL, WELL_COLUMNS, _events, _ordinal_windows_sql, bound, show, shown,
)
from .oracle import label_view, r, sql, staged, windows

BATCH_WINDOW = ["name", "stage_num_td", "stage_start_ts", "stage_end_ts", "sample_count"]

# The stage index after the second batch, by the rules of the repair flow.
REPAIR_SQL = f"""
rep AS (SELECT DISTINCT name FROM hit WHERE matches <> 1),
st AS (SELECT name, MAX(stage_end_ts) AS last_ts, MAX(stage_num_td) AS last_stage FROM w1 GROUP BY name),
nrm AS (SELECT t.*, st.last_ts, COALESCE(st.last_stage, 0) AS last_stage FROM tel t LEFT JOIN st ON st.name = t.name
  WHERE t.event_id % 10 >= 8 AND t.name NOT IN (SELECT name FROM rep) AND (st.last_ts IS NULL OR t.record_ts > st.last_ts)),
nrm1 AS (SELECT *, last_stage + SUM(is_new) OVER (PARTITION BY name ORDER BY record_ts ROWS UNBOUNDED PRECEDING) AS stage_num_td FROM (
  SELECT *, CASE WHEN prev IS NULL OR epoch_us(record_ts) - epoch_us(prev) >= {GAP_SECONDS}000000 THEN 1 ELSE 0 END AS is_new
  FROM (SELECT *, COALESCE(LAG(record_ts) OVER (PARTITION BY name ORDER BY record_ts), last_ts) AS prev FROM nrm))),
kept AS (SELECT name, record_ts, rate_slurry, stage_num_td FROM s1 WHERE name NOT IN (SELECT name FROM rep)
  UNION ALL SELECT t.name, t.record_ts, t.rate_slurry, h.stage FROM hit h JOIN tel t ON t.id = h.id WHERE h.name NOT IN (SELECT name FROM rep)
  UNION ALL SELECT name, record_ts, rate_slurry, stage_num_td FROM nrm1
  UNION ALL SELECT name, record_ts, rate_slurry, stage_num_td FROM stg WHERE name IN (SELECT name FROM rep)),
after AS (SELECT name, CAST(stage_num_td AS BIGINT) AS stage_num_td, MIN(record_ts) AS stage_start_ts, MAX(record_ts) AS stage_end_ts, COUNT(*) AS sample_count, AVG(rate_slurry) AS avg_rate_slurry
  FROM kept GROUP BY 1, 2)"""
REPAIR = (*FIRST, LATE_SQL, REPAIR_SQL)


def _first_windows(rows: DataFrame) -> DataFrame:
    return stored(stages.stage_windows(tv.first_batch(rows), GAP_SECONDS), "first-windows")


@bound("late_split", sql("tel", """
SELECT id, name, record_ts, COALESCE(record_ts <= last_ts, false) AS is_late FROM tel LEFT JOIN (SELECT name AS n, MAX(record_ts) AS last_ts FROM t1 GROUP BY 1) ON n = name WHERE event_id % 10 >= 8""", FIRST[0]))
def _(spark, d):
    rows = tv.readings(spark, d)
    state = stages.session_state(stages.stage_windows(tv.first_batch(rows), GAP_SECONDS))
    return stages.split_late(tv.second_batch(rows), state).select("id", "name", "record_ts", "is_late")


@bound("late_repair", sql("stg", f"SELECT {', '.join(BATCH_WINDOW)}, {r('avg_rate_slurry')} AS avg_rate_slurry FROM after", *REPAIR))
def _(spark, d):
    rows = tv.readings(spark, d)
    out = flows.apply_batch(tv.first_batch(rows), tv.second_batch(rows), _first_windows(rows), GAP_SECONDS)["windows"]
    return show(out, *BATCH_WINDOW, "avg_rate_slurry", rounded=("avg_rate_slurry",))


@bound("resent_readings", sql("stg", f"""
SELECT k.name, CAST(k.stage_num_td AS BIGINT) AS stage_num_td, MIN(k.record_ts) AS stage_start_ts, MAX(k.record_ts) AS stage_end_ts, COUNT(*) AS sample_count,
  {r("AVG(k.rate_slurry + CASE WHEN t.event_type = 'view' AND t.event_id % 10 < 8 THEN 1 ELSE 0 END)")} AS avg_rate_slurry
FROM kept k JOIN tel t ON t.name = k.name AND t.record_ts = k.record_ts GROUP BY 1, 2""", *REPAIR))
def _(spark, d):
    """Windows of the merged feed where the batch also resends old readings with another rate: each counts once, at its new rate."""
    rows = tv.telemetry(spark, d)
    resent = tv.first_batch(rows).where(F.col("event_type") == "view").withColumn("rate_slurry", F.col("rate_slurry") + 1)
    out = flows.merged_feed_flow(tv.first_batch(rows), tv.second_batch(rows).unionByName(resent), _first_windows(rows), GAP_SECONDS)
    return show(out["windows"], *BATCH_WINDOW, "avg_rate_slurry", rounded=("avg_rate_slurry",))


@bound("merged_readings", sql("tel", "SELECT name, record_ts, id, CASE WHEN event_type = 'view' AND event_id % 10 < 8 THEN rate_slurry + 1 ELSE rate_slurry END AS rate_slurry FROM tel"))
def _(spark, d):
    rows = tv.telemetry(spark, d)
    resent = tv.first_batch(rows).where(F.col("event_type") == "view").withColumn("rate_slurry", F.col("rate_slurry") + 1)
    out = flows.merged_feed_flow(tv.first_batch(rows), tv.second_batch(rows).unionByName(resent), _first_windows(rows), GAP_SECONDS)
    return out["readings"].select("name", "record_ts", "id", "rate_slurry")


CHANGED_SQL = """
chg AS (SELECT a.* FROM win a LEFT JOIN w1 b ON a.name = b.name AND a.stage_num_td = b.stage_num_td AND a.stage_start_ts = b.stage_start_ts AND a.stage_end_ts = b.stage_end_ts
  AND a.sample_count = b.sample_count WHERE b.name IS NULL)"""


@bound("affected_rows", sql("win", "SELECT s.id, s.name, s.record_ts, s.stage_num_td FROM stg s JOIN chg c ON c.name = s.name AND c.stage_num_td = s.stage_num_td", *FIRST, CHANGED_SQL))
def _(spark, d):
    rows = tv.readings(spark, d)
    same = ["name", "stage_num_td", "stage_start_ts", "stage_end_ts", "sample_count"]
    changed = stages.stage_windows(rows, GAP_SECONDS).join(stages.stage_windows(tv.first_batch(rows), GAP_SECONDS).select(*same), same, "left_anti")
    return flows.affected_rows(rows, changed).select("id", "name", "record_ts", "stage_num_td")


def _bucket_counts(source: str, where: str = "true") -> str:
    return f"""SELECT time_bucket(INTERVAL {BUCKET_SECONDS} SECOND, record_ts, TIMESTAMP '1970-01-01') AS bucket_ts, COALESCE(NULLIF(fleet_name, ''), 'Unknown') AS fleet_name, pad_name, name,
  COUNT(*) AS records_in_bucket, {r('AVG(rate_slurry)')} AS rate_slurry_avg FROM {source} WHERE {where} GROUP BY 1, 2, 3, 4"""


BUCKET = ["bucket_ts", "fleet_name", "pad_name", "name", "records_in_bucket", "rate_slurry_avg"]


@bound("lookback_refresh", sql("tel", f"""
SELECT *, TIMESTAMP '2024-01-31' AS rollup_updated_at FROM ({_bucket_counts('tel', "record_ts >= TIMESTAMP '2024-01-24 00:00:00'")})
UNION ALL SELECT *, TIMESTAMP '2024-01-30' FROM ({_bucket_counts('t1', "record_ts < TIMESTAMP '2024-01-24 00:00:00'")})""", FIRST[0]))
def _(spark, d):
    rows = tv.telemetry(spark, d)
    before = stored(flows.rollup_flow(tv.first_batch(rows), None, BUCKET_SECONDS, now="2024-01-30"), "rollup")
    out = flows.rollup_flow(rows, before, BUCKET_SECONDS, start="2024-01-24 05:00:00", now="2024-01-31")
    return show(out, *BUCKET, "rollup_updated_at", rounded=("rate_slurry_avg",))


@bound("mode_bounded_read", sql("tel", "SELECT id, name, record_ts FROM tel WHERE record_ts >= TIMESTAMP '2024-01-28'"))
def _(spark, d):
    return reads.mode_bounded_read(tv.readings(spark, d), "incremental", datetime(2024, 1, 31)).select("id", "name", "record_ts")


# --- label hooks -----------------------------------------------------------


def trend_labeller(rows: pd.DataFrame) -> pd.Series:
    """Rate against the row before it; the rows of the stage's highest rate, its first and its last are named. Needs the whole stage."""
    step = rows["rate_slurry"].diff()
    labels = pd.Series("flat", index=rows.index).mask(step > 0, "up").mask(step < 0, "down")
    labels = labels.mask(rows["rate_slurry"] == rows["rate_slurry"].max(), "peak")
    labels.iloc[-1], labels.iloc[0] = "last", None
    return labels


def trend_of_stages(rows: pd.DataFrame) -> np.ndarray:
    """What ``trend_labeller`` says, of many stages by one call."""
    stage, rate = rows[GROUP], rows["rate_slurry"]
    first, last = stage != stage.shift(), stage != stage.shift(-1)
    step = rate.diff()
    return np.select([first, last, rate == rate.groupby(stage).transform("max"), step > 0, step < 0], [None, "last", "peak", "up", "down"], "flat")


TREND = Grouped(trend_of_stages)


def marker_labeller(rows: pd.DataFrame) -> pd.Series:
    names = pd.Series("PRE_LOW", index=rows.index)
    for low, name in ((200, "PRE"), (400, "LOW"), (600, "MID"), (800, "MID_TRIAL")):
        names = names.mask(rows["press_mainline"] >= low, name)
    return names


def design_labeller(rows: pd.DataFrame) -> pd.Series:
    labels = pd.Series("ramp_up", index=rows.index)
    labels = labels.mask(rows["rate_slurry"] >= 0.9 * rows["inferred_design_rate"], "design")
    labels = labels.mask(rows["press_mainline"] < 200, "stage_end")
    return labels.mask(rows["inferred_design_rate"].isna(), None)


def marker_column() -> Column:
    """What ``marker_labeller`` says, as a Column: it looks at one row only."""
    names = F.when(F.col("press_mainline") >= 800, "MID_TRIAL")
    for low, name in ((600, "MID"), (400, "LOW"), (200, "PRE")):
        names = names.when(F.col("press_mainline") >= low, name)
    return names.otherwise("PRE_LOW")


def design_column() -> Column:
    """What ``design_labeller`` says, as a Column."""
    design = F.col("inferred_design_rate")
    named = F.when(F.col("press_mainline") < 200, "stage_end").when(F.col("rate_slurry") >= 0.9 * design, "design").otherwise("ramp_up")
    return F.when(design.isNotNull(), named)


class Records(Fold):
    """Names the rows of a stage's highest rate so far. Rows before the first one that flows are not written, and stages that never flow are left out."""

    def start(self) -> float:
        return 0.0

    def step(self, state: float, rows: pd.DataFrame) -> tuple[Trimmed | None, float]:
        so_far = rows["rate_slurry"].cummax().clip(lower=state)
        flows_ = (so_far > 0).to_numpy()
        if not flows_.any():
            return None, state
        before = so_far.shift(fill_value=state)
        labels = pd.Series("below", index=rows.index).mask(rows["rate_slurry"] > before, "record")
        first = int(flows_.argmax())
        return Trimmed(labels.iloc[first:], first, len(rows) - 1), float(so_far.iloc[-1])


@bound("label_hook_fold", sql("long", """
SELECT name, stage_num_td, record_ts AS datetime_fmt, CASE WHEN rate_slurry - 50 > COALESCE(before, 0) THEN 'record' ELSE 'below' END AS substage
FROM (SELECT *, GREATEST(MAX(rate_slurry - 50) OVER (PARTITION BY name, stage_num_td ORDER BY record_ts ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
  MAX(rate_slurry - 50) OVER (PARTITION BY name, stage_num_td ORDER BY record_ts ROWS UNBOUNDED PRECEDING) AS so_far FROM long)
WHERE so_far > 0"""))
def _(spark, d):
    """A labeller with memory that writes part of each stage, over rates above 50."""
    rows = tv.staged(spark, d, LONG_GAP_SECONDS).withColumn("rate_slurry", F.col("rate_slurry") - 50)
    return flows.label_rows(rows, Records()).select("name", "stage_num_td", "datetime_fmt", "substage")


@bound("label_hook_facts", sql("long", """
SELECT name, stage_num_td, record_ts AS datetime_fmt, CASE WHEN n IS NULL THEN 'last' WHEN p IS NULL THEN 'first' WHEN rate_slurry = top THEN 'peak' ELSE 'inside' END AS substage
FROM (SELECT *, LAG(record_ts) OVER (PARTITION BY name, stage_num_td ORDER BY record_ts) AS p, LEAD(record_ts) OVER (PARTITION BY name, stage_num_td ORDER BY record_ts) AS n,
  MAX(rate_slurry) OVER (PARTITION BY name, stage_num_td) AS top FROM long)"""))
def _(spark, d):
    """A rule that knows its stage's ends and highest rate, as a Column."""
    rows = labelling.with_stage_facts(tv.staged(spark, d, LONG_GAP_SECONDS).withColumn("datetime_fmt", F.col("record_ts")))
    t = F.col("datetime_fmt")
    rule = F.when(t == F.col("stage_last_ts"), "last").when(t == F.col("stage_first_ts"), "first").when(F.col("rate_slurry") == F.col("stage_max_rate"), "peak").otherwise("inside")
    return labelling.label_stages(rows, rule).select("name", "stage_num_td", "datetime_fmt", "substage")


@bound("label_hook", sql("long", """
SELECT name, stage_num_td, record_ts AS datetime_fmt, CASE WHEN p IS NULL THEN 'NA' WHEN n IS NULL THEN 'last' WHEN rate_slurry = top THEN 'peak' WHEN rate_slurry > p THEN 'up' WHEN rate_slurry < p THEN 'down' ELSE 'flat' END AS substage
FROM (SELECT *, LAG(rate_slurry) OVER (PARTITION BY name, stage_num_td ORDER BY record_ts) AS p, LEAD(record_ts) OVER (PARTITION BY name, stage_num_td ORDER BY record_ts) AS n,
  MAX(rate_slurry) OVER (PARTITION BY name, stage_num_td) AS top FROM long)"""))
def _(spark, d):
    return flows.label_rows(tv.staged(spark, d, LONG_GAP_SECONDS), trend_labeller).select("name", "stage_num_td", "datetime_fmt", "substage")


MARKER_CASE = "CASE WHEN press_mainline >= 800 THEN 'MID_TRIAL' WHEN press_mainline >= 600 THEN 'MID' WHEN press_mainline >= 400 THEN 'LOW' WHEN press_mainline >= 200 THEN 'PRE' ELSE 'PRE_LOW' END"


def _two_pass_sql(rows: str) -> str:
    """Both passes over a view with ``name, stage_num_td, datetime_fmt, rate_slurry, press_mainline``."""
    return f"""
mk AS (SELECT *, {MARKER_CASE} AS marker FROM {rows}),
md AS (SELECT name, stage_num_td, CASE WHEN median(rate_slurry) > 0 THEN median(rate_slurry) END AS design_rate FROM mk WHERE marker IN ('MID', 'MID_TRIAL') GROUP BY 1, 2),
p1 AS (SELECT mk.*, CASE WHEN design_rate IS NULL THEN 'NA' WHEN press_mainline < 200 THEN 'stage_end' WHEN rate_slurry >= 0.9::DOUBLE * design_rate THEN 'slurry' ELSE 'ramp_up' END AS label
  FROM mk LEFT JOIN md ON md.name = mk.name AND md.stage_num_td = mk.stage_num_td),
e1 AS (SELECT name, stage_num_td, MIN(datetime_fmt) AS end_at FROM p1 WHERE label = 'stage_end' GROUP BY 1, 2),
t2 AS (SELECT p1.*, end_at FROM p1 JOIN e1 ON e1.name = p1.name AND e1.stage_num_td = p1.stage_num_td AND datetime_fmt > end_at),
rs AS (SELECT name, stage_num_td, end_at, MIN(datetime_fmt) AS restart_at FROM t2 p WHERE marker = 'PRE'
  AND EXISTS (SELECT 1 FROM t2 x WHERE x.name = p.name AND x.stage_num_td = p.stage_num_td AND x.marker IN ('LOW', 'PRE_LOW') AND x.datetime_fmt < p.datetime_fmt)
  AND EXISTS (SELECT 1 FROM t2 x WHERE x.name = p.name AND x.stage_num_td = p.stage_num_td AND x.marker = 'MID_TRIAL' AND x.datetime_fmt > p.datetime_fmt) GROUP BY 1, 2, 3),
two AS (SELECT p1.name, p1.stage_num_td, p1.datetime_fmt, CASE WHEN p1.datetime_fmt > end_at AND p1.datetime_fmt < restart_at THEN 'NA' ELSE label END AS substage
  FROM p1 LEFT JOIN rs ON rs.name = p1.name AND rs.stage_num_td = p1.stage_num_td)"""


LONG_ROWS = "(SELECT name, stage_num_td, record_ts AS datetime_fmt, rate_slurry, press_mainline FROM long)"


@bound("two_pass_labels", sql("long", "SELECT * FROM two", _two_pass_sql(LONG_ROWS)))
def _(spark, d):
    rows = tv.staged(spark, d, LONG_GAP_SECONDS)
    markers = stored(flows.label_rows(rows, marker_column()), "markers")
    ready = rows.select("name", "stage_num_td", F.col("record_ts").alias("datetime_fmt"), "rate_slurry", "press_mainline")
    return labelling.two_pass_labels(ready, markers, design_column()).select("name", "stage_num_td", "datetime_fmt", "substage")


# --- flows -----------------------------------------------------------------

AFTER_ROWS = """
af AS (SELECT a.* FROM after a LEFT JOIN w1 b ON a.name = b.name AND a.stage_num_td = b.stage_num_td AND a.stage_start_ts = b.stage_start_ts AND a.stage_end_ts = b.stage_end_ts
  AND a.sample_count = b.sample_count WHERE b.name IS NULL),
afr AS (SELECT t.name, a.stage_num_td, t.record_ts AS datetime_fmt, t.rate_slurry, t.press_mainline FROM tel t JOIN af a ON a.name = t.name AND t.record_ts BETWEEN a.stage_start_ts AND a.stage_end_ts)"""


@bound("live_stage_flow", sql("stg", "SELECT * FROM two", *REPAIR, AFTER_ROWS, _two_pass_sql("afr")))
def _(spark, d):
    rows = tv.readings(spark, d)
    out = flows.live_stage_flow(tv.first_batch(rows), tv.second_batch(rows), _first_windows(rows), GAP_SECONDS, marker_column(), design_column())
    return out["labels"].select("name", "stage_num_td", "datetime_fmt", "substage")


@bound("merged_feed_flow", sql("wells", f"SELECT {', '.join(WELL_COLUMNS)} FROM wells WHERE name IN (SELECT name FROM tel WHERE event_id % 10 >= 8)"))
def _(spark, d):
    rows = tv.telemetry(spark, d)
    return flows.merged_feed_flow(tv.first_batch(rows), tv.second_batch(rows), _first_windows(rows), GAP_SECONDS)["wells"].select(*WELL_COLUMNS)


@bound("well_repair_flow", sql("win", f"""
SELECT {', '.join(BATCH_WINDOW)} FROM win WHERE name IN (SELECT name FROM rep) UNION ALL SELECT {', '.join(BATCH_WINDOW)} FROM w1 WHERE name NOT IN (SELECT name FROM rep)""", *REPAIR))
def _(spark, d):
    rows = tv.readings(spark, d)
    w = _first_windows(rows)
    repair = flows.apply_batch(tv.first_batch(rows), tv.second_batch(rows), w, GAP_SECONDS)["repair_wells"]
    return flows.recompute_wells(rows, repair, w, GAP_SECONDS, dry_run=False)["windows"].select(*BATCH_WINDOW)


@bound("well_recompute_flow", sql("win", "SELECT name, COUNT(*) AS stages_to_write, CAST(SUM(sample_count) AS BIGINT) AS rows_to_write FROM win GROUP BY name"))
def _(spark, d):
    rows = tv.readings(spark, d)
    return flows.recompute_wells(rows, rows, _first_windows(rows), GAP_SECONDS)["plan"]


@bound("rollup_flow", sql("tel", _bucket_counts("tel")))
def _(spark, d):
    """Written by day partition, a second batch upserted into it, then read back."""
    rows = tv.telemetry(spark, d)
    path = work_path(spark, "rollup")
    keys = ["bucket_seconds", "bucket_ts", "fleet_name", "pad_name", "name"]
    day = F.col("bucket_ts").cast("date")
    writes.upsert_folder(spark, path, flows.rollup_flow(tv.first_batch(rows), None, BUCKET_SECONDS, now="2024-01-30").withColumn("day", day), keys, "day")
    late = flows.rollup_flow(rows, None, BUCKET_SECONDS, now="2024-01-31").withColumn("day", day)
    writes.upsert_folder(spark, path, late, keys, "day")
    return show(writes.read_folder(spark, path, late.schema, "day"), *BUCKET, rounded=("rate_slurry_avg",))


@bound("row_label_flow", sql("tel", """
SELECT name, record_ts AS datetime_fmt, CASE WHEN p IS NULL THEN 'NA' WHEN n IS NULL THEN 'last' WHEN rate_slurry = top THEN 'peak' WHEN rate_slurry > p THEN 'up' WHEN rate_slurry < p THEN 'down' ELSE 'flat' END AS substage,
  'rows-v2' AS algorithm_version
FROM (SELECT *, LAG(rate_slurry) OVER (PARTITION BY name, stage_num_td ORDER BY record_ts) AS p, LEAD(record_ts) OVER (PARTITION BY name, stage_num_td ORDER BY record_ts) AS n,
  MAX(rate_slurry) OVER (PARTITION BY name, stage_num_td) AS top FROM rst)
UNION ALL SELECT o.name, o.record_ts, 'old', 'rows-v2' FROM tel o LEFT JOIN (SELECT name, MIN(record_ts) AS since FROM recent GROUP BY name) x ON x.name = o.name WHERE since IS NULL OR o.record_ts < since""",
    "\nrecent AS (SELECT * FROM tel WHERE record_ts >= TIMESTAMP '2024-01-28')", staged("recent", GAP_SECONDS, "rst")))
def _(spark, d):
    rows = tv.readings(spark, d)
    previous = rows.select("name", F.col("record_ts").alias("datetime_fmt"), F.lit("old").alias("substage"), F.lit("rows-v2").alias("algorithm_version"))
    out = flows.row_label_flow(rows, previous, "incremental", datetime(2024, 1, 31), GAP_SECONDS, TREND)
    return out.select("name", "datetime_fmt", "substage", "algorithm_version")


@bound("ordinal_flow", sql("stg", "SELECT name, datetime_fmt, ordinal_provisional, ordinal_confirmed, ordinal_continuous FROM ord", SMARK, ORDINAL_SQL))
def _(spark, d):
    return flows.ordinal_flow(tv.marker_labels(spark, d, GAP_SECONDS), tv.readings(spark, d))["rows"].select("name", "datetime_fmt", "ordinal_provisional", "ordinal_confirmed", "ordinal_continuous")


@bound("ordinal_index_flow", sql("stg", "\nUNION ALL ".join(_ordinal_windows_sql(layer) for layer in ordinals.LAYERS), SMARK, ORDINAL_SQL))
def _(spark, d):
    out = flows.ordinal_flow(tv.marker_labels(spark, d, GAP_SECONDS), tv.readings(spark, d))["windows"]
    return show(out, *ORDINAL_WINDOW, rounded=("avg_rate_slurry", "avg_press_mainline"))


def _of_first_batch(text_: str) -> str:
    """The anomaly views again, over the first batch."""
    return re.sub(r"\b(des|a0|a1|a2|anom|ev|summ|lab|lwin)\b", r"\g<1>_b", text_)


FIRST_LONG = (FIRST[0], staged("t1", LONG_GAP_SECONDS, "s1l"), windows("s1l", "lwin_b"), label_view("s1l", "lab_b"))
ANOMALY_VIEWS = (DESIGN_SQL, ANOM_SQL, EVENT_SQL, SUMMARY_SQL)
TWO_RUNS = (*ANOMALY_VIEWS, *FIRST_LONG, *(_of_first_batch(v) for v in ANOMALY_VIEWS))


def _anomaly_runs(spark, d) -> str:
    """Two runs, the second over the stages that changed; returns their folder."""
    rows = tv.telemetry(spark, d)
    root = work_path(spark, "anomalies")
    manifest = None
    for run, batch, now in (("run-1", tv.first_batch(rows), "2024-01-30"), ("run-2", rows, "2024-01-31")):
        index = stages.stage_windows(batch, LONG_GAP_SECONDS)
        assigned = stages.assign_stages(batch, LONG_GAP_SECONDS)
        labels = assigned.select("name", "stage_num_td", F.col("record_ts").alias("datetime_fmt"), tv.substage_of_event().alias("substage"), "rate_slurry", "press_mainline")
        out = flows.anomaly_flow(labels, flows.stage_sources(index), manifest, run, now, LIMITS, slot_seconds=SLOT)
        writes.publish_run({k: out[k] for k in ("labels", "events", "summary")}, out["manifest"], root)
        manifest = writes.current_manifest(spark, root, catalog.MANIFEST.schema, list(catalog.MANIFEST.key), ["processed_at"])
    return root


def _visible(spark, root: str, table: str, contract: catalog.Table) -> DataFrame:
    manifest = writes.current_manifest(spark, root, catalog.MANIFEST.schema, list(catalog.MANIFEST.key), ["processed_at"])
    return active_runs(catalog.read_table(spark, contract, f"{root}/{table}"), manifest, flows.ANOMALY_VERSION)


@bound("anomaly_flow", sql("lab lwin", f"""
SELECT {', '.join(LINE_COLUMNS)} FROM summ UNION ALL SELECT {', '.join(LINE_COLUMNS)} FROM summ_b b WHERE NOT EXISTS (SELECT 1 FROM summ s WHERE s.name = b.name AND s.stage_num_td = b.stage_num_td)""", *TWO_RUNS))
def _(spark, d):
    return _visible(spark, _anomaly_runs(spark, d), "summary", catalog.ANOMALY_SUMMARY).select(*LINE_COLUMNS)


@bound("run_versioned_append", sql("lab lwin", """
SELECT name, stage_num_td, anomaly, start_ts, end_ts FROM ev UNION ALL SELECT name, stage_num_td, anomaly, start_ts, end_ts FROM ev_b b
WHERE NOT EXISTS (SELECT 1 FROM summ s WHERE s.name = b.name AND s.stage_num_td = b.stage_num_td)""", *TWO_RUNS))
def _(spark, d):
    return _visible(spark, _anomaly_runs(spark, d), "events", catalog.ANOMALY_EVENTS).select("name", "stage_num_td", "anomaly", "start_ts", "end_ts")


@bound("tuning_flow", sql("lab lwin", """
SELECT g.name, g.stage_num_td, COALESCE(NULLIF(fleet_name, ''), 'Unknown') AS fleet_name, rolling_points, threshold_type, threshold_value, segment_count, 'tuning-v1' AS algorithm_version
FROM grid g JOIN lwin w ON w.name = g.name AND w.stage_num_td = g.stage_num_td""", GRID_SQL))
def _(spark, d):
    sources = flows.stage_sources(tv.stage_index(spark, d, gap=LONG_GAP_SECONDS))
    due = sources.withColumn("source_signature", flows.signatures.source_signature(sources, flows.TUNING_VERSION, flows.SOURCE_FIELDS))
    out = flows.tuning_flow(tv.labels(spark, d), stored(due, "due"), None, "2024-01-31", slot_seconds=SLOT)
    return out.select("name", "stage_num_td", "fleet_name", "rolling_points", "threshold_type", "threshold_value", "segment_count", "algorithm_version")


@bound("score_flow", sql("lab mark wells", "SELECT name, stage_num_td, top_driver, (SELECT COUNT(*) FROM sc) AS population_size, " + ", ".join(f"{r(c)} AS {c}" for c in SCORE_VALUES) + " FROM sc", *SCORE_VIEWS))
def _(spark, d):
    sources = flows.stage_sources(tv.stage_index(spark, d, gap=LONG_GAP_SECONDS))
    out = flows.score_flow(stored(tv.labels(spark, d), "labels"), stored(tv.marker_labels(spark, d), "markers"), _events(spark, d), sources, slot_seconds=SLOT)["scores"]
    return out.select("name", "stage_num_td", "top_driver", "population_size", *[shown(c) for c in SCORE_VALUES])


@bound("score_rounds", sql("lab mark wells", "SELECT name, stage_num_td, top_driver, (SELECT COUNT(*) FROM sc) AS population_size, " + ", ".join(f"{r(c)} AS {c}" for c in SCORE_VALUES) + " FROM sc", *SCORE_VIEWS))
def _(spark, d):
    """Scored in batches of stages until none is left; the sources of every stage had changed since the stored parts."""
    sources = stored(flows.stage_sources(tv.stage_index(spark, d, gap=LONG_GAP_SECONDS)), "sources")
    labels, markers, events = stored(tv.labels(spark, d), "labels"), stored(tv.marker_labels(spark, d), "markers"), stored(_events(spark, d), "events")
    before = sources.withColumn("source_rows", F.col("source_rows") - 1)
    out = flows.score_flow(labels, markers, events.limit(0), before, slot_seconds=SLOT)
    while True:
        out = flows.score_flow(labels, markers, events, sources, out["parts"], SLOT, max_stages=sources.count() // 2 + 1)
        if not out["has_more"].first()[0]:
            break
    return out["scores"].select("name", "stage_num_td", "top_driver", "population_size", *[shown(c) for c in SCORE_VALUES])


@bound("tuning_rounds", sql("lab lwin", """
SELECT g.name, g.stage_num_td, rolling_points, threshold_type, threshold_value, segment_count FROM grid g""", GRID_SQL))
def _(spark, d):
    """Two runs with a limit, their manifest read back, the grid of changed stages replaced."""
    sources = flows.stage_sources(tv.stage_index(spark, d, gap=LONG_GAP_SECONDS))
    due = stored(sources.withColumn("source_signature", flows.signatures.source_signature(sources, flows.TUNING_VERSION, flows.SOURCE_FIELDS)), "due")
    labels = stored(tv.labels(spark, d), "labels")
    grid = stored(flows.tuning_flow(labels.limit(0), due.withColumn("source_signature", F.lit("before")), None, "2024-01-30", slot_seconds=SLOT, packed=True), "grid")
    manifest = flows.tuning_manifest(due.withColumn("source_signature", F.lit("before")), "2024-01-30")
    while True:
        out = flows.tuning_run(labels, due, manifest, grid, "2024-01-31", due.count() // 2 + 1, slot_seconds=SLOT, packed=True)
        grid, manifest = out["grid"], out["manifest"]
        if not out["has_more"].first()[0]:
            break
    return anomaly.grid_rows(grid).select("name", "stage_num_td", "rolling_points", "threshold_type", "threshold_value", "segment_count")


@bound("recompute_labels", sql("stg", "SELECT * FROM two", _two_pass_sql("(SELECT name, stage_num_td, record_ts AS datetime_fmt, rate_slurry, press_mainline FROM stg)")))
def _(spark, d):
    rows = tv.telemetry(spark, d)
    out = flows.recompute_flow(rows, rows, _first_windows(rows), GAP_SECONDS, marker_column(), design_column())
    return out["labels"].select("name", "stage_num_td", "datetime_fmt", "substage")


@bound("recompute_windows", sql("win wells", f"SELECT {', '.join(f'w.{c}' for c in BATCH_WINDOW)}, x.sample_count AS well_rows FROM win w JOIN wells x ON x.name = w.name"))
def _(spark, d):
    """Windows and well index after the recompute of every well, replaced in the tables of the first batch."""
    rows = tv.telemetry(spark, d)
    out = flows.recompute_flow(rows, rows, _first_windows(rows), GAP_SECONDS, marker_column(), design_column())
    return out["windows"].select(*BATCH_WINDOW).join(out["wells"].select("name", F.col("sample_count").alias("well_rows")), "name").select(*BATCH_WINDOW, "well_rows")


# --- streams ---------------------------------------------------------------

FEED = ["created_ts", "record_ts", "name", "id", "rate_slurry"]


def _feed(spark, rows: DataFrame, parts: list, run) -> None:
    """Land each part of the rows in a folder and let the stream catch up after each."""
    landing = work_path(spark, "landing")
    schema = rows.schema
    for number, part in enumerate(parts):
        part.write.mode("overwrite").parquet(f"{landing}/part={number}")
        run(live.read_feed(spark, f"{landing}/*", schema)).awaitTermination()


@bound("stream_ingest", sql("tel", "SELECT record_ts, name, id, CASE WHEN event_type = 'view' AND event_id % 10 < 8 THEN rate_slurry + 1 ELSE rate_slurry END AS rate_slurry FROM tel"))
def _(spark, d):
    rows = tv.readings(spark, d)
    resent = tv.first_batch(rows).where(F.col("event_type") == "view").withColumn("rate_slurry", F.col("rate_slurry") + 1)
    first, second = tv.first_batch(rows).select(*FEED), tv.second_batch(rows).unionByName(resent).select(*FEED)
    root = work_path(spark, "ingest")
    _feed(spark, first, [first, second], lambda s: live.ingest(s, root, ["record_ts", "name"], ["id"]))
    return live.merged_rows(spark, root, first.schema).select("record_ts", "name", "id", "rate_slurry")


def _late_parts(rows: DataFrame) -> list[DataFrame]:
    """Three parts by time, each with readings that belong to the ones before."""
    t, late = F.col("record_ts"), F.abs(F.hash("id")) % 10
    lo, hi = (reads.time_literal(c) for c in ("2024-01-10", "2024-01-20"))
    when = F.when(t < lo, 0).when(t < hi, 1).otherwise(2)
    turn = F.least(F.lit(2), when + F.when(late < 2, 1).when(late < 3, 2).otherwise(0))
    return [rows.where(turn == k) for k in range(3)]


@bound("stream_sessions", sql("stg", "SELECT id, name, record_ts, stage_num_td FROM stg"))
def _(spark, d):
    """Three in ten readings come one or two batches late; all are in their stages at the end."""
    rows = tv.readings(spark, d).select(*FEED)
    root = work_path(spark, "sessions")
    _feed(spark, rows, _late_parts(rows), lambda s: sessions.sessions(s, root, GAP_SECONDS))
    index = sessions.stage_index(spark, root)
    return interval_join(rows, index, "record_ts", "stage_start_ts", "stage_end_ts").select("id", "name", "record_ts", "stage_num_td")


@bound("stream_stage_index", sql("win", "SELECT name, stage_num_td, stage_start_ts, stage_end_ts FROM win"))
def _(spark, d):
    """The stream begins with the index of the first batch and goes on with the second, whose readings lie among those of the first."""
    rows = tv.readings(spark, d).select(*FEED)
    first = stored(stages.stage_windows(tv.first_batch(tv.readings(spark, d)), GAP_SECONDS).select("name", "stage_num_td", "stage_start_ts", "stage_end_ts"), "first-index")
    root = work_path(spark, "stage-index")
    second = tv.second_batch(tv.readings(spark, d)).select(*FEED)
    _feed(spark, rows, [second], lambda s: sessions.sessions(s, root, GAP_SECONDS, index=first))
    return sessions.stage_index(spark, root, first).select("name", "stage_num_td", "stage_start_ts", "stage_end_ts")


LIVE_TEL = "(SELECT name, stage_num_td, record_ts AS datetime_fmt, rate_slurry + CASE WHEN event_type = 'view' THEN 1 ELSE 0 END AS rate_slurry, press_mainline FROM stg)"


@bound("stream_live", sql("win wells", """
SELECT two.name, two.stage_num_td, two.datetime_fmt, two.substage, w.sample_count AS stage_rows, x.sample_count AS well_rows FROM two
JOIN win w ON w.name = two.name AND w.stage_num_td = two.stage_num_td JOIN wells x ON x.name = two.name""", _two_pass_sql(LIVE_TEL)))
def _(spark, d):
    """One stream keeps readings, stages, labels and wells: late readings, and half of them sent again with another rate."""
    rows = tv.telemetry(spark, d)
    parts = _late_parts(rows)
    again = rows.where("event_type = 'view'")
    parts[2] = parts[2].where("event_type <> 'view'").unionByName(again.withColumn("rate_slurry", F.col("rate_slurry") + 1))
    root = work_path(spark, "live")
    _feed(spark, rows, parts, lambda s: merged.live_tables(s, root, GAP_SECONDS, marker_column(), design_column()))
    tables = {name: merged.read_live(spark, root, name, rows.schema) for name in ("labels", "windows", "wells")}
    stages_ = tables["windows"].select("name", "stage_num_td", F.col("sample_count").alias("stage_rows"))
    wells = tables["wells"].select("name", F.col("sample_count").alias("well_rows"))
    return tables["labels"].join(stages_, ["name", "stage_num_td"]).join(wells, "name").select("name", "stage_num_td", "datetime_fmt", "substage", "stage_rows", "well_rows")


@bound("stream_rollup", sql("tel", _rollup_sql("tel")))
def _(spark, d):
    columns = ["record_ts", "created_ts", "name", "id", "api_num", "fleet_name", "pad_name", *catalog.MEASURE_COLUMNS]
    rows = tv.telemetry(spark, d)
    first, second = tv.first_batch(rows).select(*columns), tv.second_batch(rows).select(*columns)
    root = work_path(spark, "stream-rollup")
    _feed(spark, first, [first, second], lambda s: live.rollup(s, root, BUCKET_SECONDS, 60 * 86_400))
    return show(live.current_buckets(spark, root, first.schema), *ROLLUP_COLUMNS, *STATS, rounded=tuple(s for s in STATS if s.endswith("_avg")))


@bound("stream_rollup_late", sql("tel", _rollup_sql("tel")))
def _(spark, d):
    """The newest readings come first and the oldest last, far behind any watermark; some come twice."""
    columns = ["record_ts", "created_ts", "name", "id", "api_num", "fleet_name", "pad_name", *catalog.MEASURE_COLUMNS]
    rows = tv.telemetry(spark, d).select(*columns)
    parts = _late_parts(rows)[::-1]
    parts[1] = parts[1].unionByName(parts[0].where("rate_slurry > 50"))
    root = work_path(spark, "late-rollup")
    _feed(spark, rows, parts, lambda s: live.rollup(s, root, BUCKET_SECONDS, 86_400))
    return show(live.current_buckets(spark, root, rows.schema), *ROLLUP_COLUMNS, *STATS, rounded=tuple(s for s in STATS if s.endswith("_avg")))


@bound("late_readings", sql("tel", f"""
SELECT CAST(1 AS BIGINT) AS batch, name, time_bucket(INTERVAL {BUCKET_SECONDS} SECOND, record_ts, TIMESTAMP '1970-01-01') AS bucket_ts, COUNT(*) AS readings FROM tel WHERE event_id % 10 >= 8
GROUP BY 1, 2, 3 HAVING time_bucket(INTERVAL {BUCKET_SECONDS} SECOND, MIN(record_ts), TIMESTAMP '1970-01-01') < (SELECT MAX(record_ts) FROM tel WHERE event_id % 10 < 8) - INTERVAL 1 DAY"""))
def _(spark, d):
    """What the second batch has of more than a day before the newest reading of the first."""
    columns = ["record_ts", "created_ts", "name", "id", "api_num", "fleet_name", "pad_name", *catalog.MEASURE_COLUMNS]
    rows = tv.telemetry(spark, d)
    root = work_path(spark, "late-readings")
    _feed(spark, rows.select(*columns), [tv.first_batch(rows).select(*columns), tv.second_batch(rows).select(*columns)], lambda s: live.rollup(s, root, BUCKET_SECONDS, 86_400))
    return live.late_buckets(spark, root)


# --- runs that are taken up again --------------------------------------------


def _until_done(first: DataFrame, every: DataFrame, run) -> None:
    """Runs over part of the source until nothing is due, then over all of it."""
    for rows in (first, every):
        while run(rows):
            pass


def _ordinal_run(spark, d) -> tuple[str, dict[str, DataFrame]]:
    """Ordinals of every well whose markers changed, some wells a run; returns the folder and empty frames of the tables' shapes."""
    root = work_path(spark, "ordinal-run")
    markers, telemetry = stored(tv.marker_labels(spark, d, GAP_SECONDS), "markers"), stored(tv.readings(spark, d), "telemetry")

    def compute(rows: DataFrame, names: DataFrame) -> dict[str, DataFrame]:
        return flows.ordinal_flow(rows, telemetry.join(names, "name", "left_semi"))

    most = markers.select("name").distinct().count() // 2 + 1
    first = markers.where(F.col("datetime_fmt") < reads.time_literal("2024-01-20"))
    columns = ["stage_num_td", "datetime_fmt", "substage"]
    _until_done(first, markers, lambda rows: runs.run_changed_wells(spark, root, rows, columns, compute, "ordinals-v1", "2024-01-31", most))
    return root, compute(markers.limit(0), markers.select("name").limit(0))


@bound("ordinal_run", sql("stg", "SELECT name, datetime_fmt, ordinal_provisional, ordinal_confirmed, ordinal_continuous FROM ord", SMARK, ORDINAL_SQL))
def _(spark, d):
    root, shapes = _ordinal_run(spark, d)
    return runs.read_run(spark, root, "rows", shapes["rows"].schema).select("name", "datetime_fmt", "ordinal_provisional", "ordinal_confirmed", "ordinal_continuous")


@bound("ordinal_index_run", sql("stg", "\nUNION ALL ".join(_ordinal_windows_sql(layer) for layer in ordinals.LAYERS), SMARK, ORDINAL_SQL))
def _(spark, d):
    root, shapes = _ordinal_run(spark, d)
    return show(runs.read_run(spark, root, "windows", shapes["windows"].schema), *ORDINAL_WINDOW, rounded=("avg_rate_slurry", "avg_press_mainline"))


@bound("row_label_run", sql("stg", """
SELECT name, stage_num_td, record_ts AS datetime_fmt, CASE WHEN p IS NULL THEN 'NA' WHEN n IS NULL THEN 'last' WHEN rate_slurry = top THEN 'peak' WHEN rate_slurry > p THEN 'up' WHEN rate_slurry < p THEN 'down' ELSE 'flat' END AS substage
FROM (SELECT *, LAG(rate_slurry) OVER (PARTITION BY name, stage_num_td ORDER BY record_ts) AS p, LEAD(record_ts) OVER (PARTITION BY name, stage_num_td ORDER BY record_ts) AS n,
  MAX(rate_slurry) OVER (PARTITION BY name, stage_num_td) AS top FROM stg)"""))
def _(spark, d):
    """Labels of the wells whose readings changed, some wells a run."""
    rows = stored(tv.readings(spark, d), "readings")
    root = work_path(spark, "label-run")

    def compute(own: DataFrame, names: DataFrame) -> dict[str, DataFrame]:
        return {"labels": flows.label_rows(stages.assign_stages(own, GAP_SECONDS), TREND)}

    most = rows.select("name").distinct().count() // 2 + 1
    _until_done(tv.first_batch(rows), rows, lambda part: runs.run_changed_wells(spark, root, part, ["id", "record_ts"], compute, "rows-v2", "2024-01-31", most))
    shape = compute(rows.limit(0), rows.select("name"))["labels"].schema
    return runs.read_run(spark, root, "labels", shape).select("name", "stage_num_td", "datetime_fmt", "substage")


@bound("recompute_run", sql("win wells", f"SELECT {', '.join(f'w.{c}' for c in BATCH_WINDOW)}, x.sample_count AS well_rows FROM win w JOIN wells x ON x.name = w.name"))
def _(spark, d):
    """Windows, labels and index of the wells whose readings changed, some wells a run."""
    rows = stored(tv.telemetry(spark, d), "readings")
    root = work_path(spark, "recompute-run")
    none = stages.stage_windows(rows.limit(0), GAP_SECONDS)

    def compute(own: DataFrame, names: DataFrame) -> dict[str, DataFrame]:
        out = flows.recompute_flow(own, names, none, GAP_SECONDS, marker_column(), design_column())
        return {"windows": out["fresh"], "wells": out["wells"], "labels": out["labels"]}

    most = rows.select("name").distinct().count() // 2 + 1
    _until_done(tv.first_batch(rows), rows, lambda part: runs.run_changed_wells(spark, root, part, ["id", "record_ts"], compute, "stages-v1", "2024-01-31", most))
    shapes = {"windows": none.schema, "wells": rollup.well_index(rows.limit(0)).schema}
    wells = runs.read_run(spark, root, "wells", shapes["wells"]).select("name", F.col("sample_count").alias("well_rows"))
    return runs.read_run(spark, root, "windows", shapes["windows"]).select(*BATCH_WINDOW).join(wells, "name").select(*BATCH_WINDOW, "well_rows")


@bound("backfill_run", sql("tel", _rollup_sql("tel")))
def _(spark, d):
    """A roll-up of everything, a few days a run, each run from the stored cursor."""
    rows = tv.telemetry(spark, d)
    root = work_path(spark, "backfill")
    while runs.run_backfill(spark, root, rows, BUCKET_SECONDS, 24, 12):
        pass
    return show(runs.read_buckets(spark, root, rows.schema), *ROLLUP_COLUMNS, *STATS, rounded=tuple(s for s in STATS if s.endswith("_avg")))
