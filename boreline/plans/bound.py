"""Every operator bound to the test tables, with the SQL that checks it."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.clean import (
    blank_to, has_label, measure, name_family, normal_label, number_text, point_id, safe_double, safe_time, time_text,
)
from ..functions.display import EVENT_COLORS, EVENT_OTHER, band_color, lookup
from ..functions.numbers import round_half_up, slot_start
from ..operators import anomaly, intervals, islands, joins, labelling, machines, orderstats, ordinals, presence, rollup, scores, stages
from ..operators.anomaly import Limits
from ..session import stored, use_utc
from ..sources import catalog, reads, signatures, testviews as tv, writes
from ..sources.testviews import BUCKET_SECONDS, GAP_SECONDS, LONG_GAP_SECONDS
from . import flows, reports
from .oracle import marker_view, r, sql, staged, text, windows

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

SLOT = 864_000.0  # slot width for the sparse test readings: some 25 of a well
FIRST = "\nt1 AS (SELECT * FROM tel WHERE event_id % 10 < 8)", staged("t1", GAP_SECONDS, "s1"), windows("s1", "w1")
LIMITS = Limits(pressure=200.0, rate=5.0, rolling_points=2, max_gap_seconds=86_400.0, shutdown_rate=20.0, shutdown_rows=2, sweep_rows=1)


def bound(name: str, oracle: str | None = None):
    def register(fn: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(use_utc(spark), sf_dir)

        run.__name__ = name
        QUERIES[name] = run
        if oracle is not None:
            ORACLE[name] = oracle
        return fn

    return register


def shown(c: str, places: int = 6) -> Column:
    """A computed double, rounded for comparison."""
    return round_half_up(F.col(c), places).alias(c)


def show(df: DataFrame, *columns: str, rounded: tuple[str, ...] = ()) -> DataFrame:
    return df.select(*[shown(c) if c in rounded else F.col(c) for c in columns])


# --- S: scans, sources, sinks ----------------------------------------------


@bound("typed_scan", sql("tel", """
SELECT name, id, record_ts, CASE WHEN event_id % 23 = 0 THEN NULL ELSE created_ts END AS created_ts,
       CASE WHEN event_id % 29 = 0 THEN NULL ELSE rate_slurry END AS rate_slurry, press_mainline FROM tel"""))
def _(spark, d):
    loose = tv.readings(spark, d).select(
        "name", "id", F.col("record_ts").cast("string").alias("record_ts"),
        F.when(F.col("event_id") % 23 == 0, " ").otherwise(F.col("created_ts").cast("string")).alias("created_ts"),
        F.when(F.col("event_id") % 29 == 0, "n/a").otherwise(F.col("rate_slurry").cast("string")).alias("rate_slurry"), "press_mainline",
    )
    return catalog.typed(loose, catalog.TELEMETRY).select("name", "id", "record_ts", "created_ts", "rate_slurry", "press_mainline")


@bound("incremental_scan", sql("tel", """
SELECT created_ts, record_ts, name, id FROM tel WHERE created_ts >= TIMESTAMP '2024-01-16' ORDER BY created_ts, record_ts, name LIMIT 200000"""))
def _(spark, d):
    return reads.incremental_scan(tv.readings(spark, d), "2024-01-16", 200_000).select("created_ts", "record_ts", "name", "id")


@bound("incremental_pages", sql("tel", "SELECT minute AS created_ts, record_ts, name, id FROM (SELECT *, date_trunc('day', created_ts) AS minute FROM tel WHERE created_ts IS NOT NULL)"))
def _(spark, d):
    """All rows through pages of a seventh, with many rows on one creation time."""
    rows = tv.readings(spark, d).withColumn("created_ts", F.date_trunc("day", "created_ts").cast("timestamp_ntz")).select("created_ts", "record_ts", "name", "id")
    size, after, pages = rows.count() // 7 + 1, None, []
    while True:
        page = stored(reads.incremental_scan(rows, after, size), "page")
        after = reads.next_cursor(page)
        if after is None:
            break
        pages.append(page)
    return functools.reduce(DataFrame.unionByName, pages)


@bound("upsert_by_key", sql("tel", """
SELECT name, record_ts, id, CASE WHEN event_id % 10 >= 8 THEN rate_slurry WHEN event_type = 'view' THEN rate_slurry + 1 ELSE rate_slurry END AS rate_slurry FROM tel"""))
def _(spark, d):
    rows = tv.readings(spark, d).select("name", "record_ts", "id", "rate_slurry", "event_id", "event_type")
    old = tv.first_batch(rows)
    resent = old.where(F.col("event_type") == "view").withColumn("rate_slurry", F.col("rate_slurry") + 1)
    new = tv.second_batch(rows).unionByName(resent)
    return writes.upsert_by_key(old, new, ["name", "record_ts"], ["id"]).select("name", "record_ts", "id", "rate_slurry")


@bound("replace_entity", sql("win", """
SELECT name, stage_num_td, stage_start_ts, sample_count FROM w1 WHERE name NOT IN (SELECT name FROM win WHERE fleet_name = 'ASIA')
UNION ALL
SELECT name, stage_num_td, stage_start_ts, sample_count FROM win WHERE name IN (SELECT name FROM win WHERE fleet_name = 'ASIA')""", *FIRST))
def _(spark, d):
    rows = tv.telemetry(spark, d)
    old = stages.stage_windows(tv.first_batch(rows), GAP_SECONDS)
    fresh = stored(stages.stage_windows(rows, GAP_SECONDS), "fresh-stages")
    asia = fresh.where(F.col("fleet_name") == "ASIA").select("name").distinct()
    return writes.replace_entity(old, fresh.join(asia, "name", "left_semi")).select("name", "stage_num_td", "stage_start_ts", "sample_count")


CHUNK_SQL = sql("tel", f"""
SELECT fleet_name, CAST(row_number() OVER (PARTITION BY fleet_name ORDER BY chunk_start) - 1 AS BIGINT) AS chunk_no, chunk_start,
       LEAST(chunk_start + INTERVAL 24 HOUR, hi) AS chunk_end
FROM (SELECT fleet_name, hi, unnest(generate_series(lo, hi - INTERVAL 1 MICROSECOND, INTERVAL 24 HOUR)) AS chunk_start
      FROM (SELECT CASE WHEN fleet_name = '' THEN 'Unknown' ELSE fleet_name END AS fleet_name,
                   time_bucket(INTERVAL {BUCKET_SECONDS} SECOND, MIN(record_ts), TIMESTAMP '1970-01-01') AS lo,
                   time_bucket(INTERVAL {BUCKET_SECONDS} SECOND, MAX(record_ts), TIMESTAMP '1970-01-01') + INTERVAL {BUCKET_SECONDS} SECOND AS hi
            FROM tel GROUP BY 1))""")


@bound("backfill_chunks", CHUNK_SQL)
def _(spark, d):
    rows = tv.telemetry(spark, d).withColumn("fleet_name", blank_to("fleet_name"))
    return reads.backfill_chunks(reads.source_bounds(rows, "fleet_name"), 24, BUCKET_SECONDS)


@bound("backfill_pages", CHUNK_SQL)
def _(spark, d):
    """The chunks of every fleet, five to a page, each page from where the one before stopped."""
    rows = tv.telemetry(spark, d).withColumn("fleet_name", blank_to("fleet_name"))
    bounds = stored(reads.source_bounds(rows, "fleet_name"), "bounds")
    cursor, pages = None, []
    while True:
        page = stored(reads.backfill_chunks(bounds, 24, BUCKET_SECONDS, 5, cursor), "chunks")
        if page.isEmpty():
            break
        done = page.groupBy("fleet_name").agg(F.max("resume_at").alias("resume_at"))
        cursor = stored(done if cursor is None else writes.upsert_by_key(cursor, done, ["fleet_name"]), "cursor")
        pages.append(page.withColumn("chunk_no", F.col("chunk_no") + 5 * len(pages)).drop("resume_at"))
    return functools.reduce(DataFrame.unionByName, pages)


@bound("source_bounds", sql("tel", "SELECT pad_name, MIN(record_ts) AS start_time, MAX(record_ts) AS end_time FROM tel GROUP BY pad_name"))
def _(spark, d):
    return reads.source_bounds(tv.telemetry(spark, d), "pad_name")


@bound("resume_entities", sql("tel", "SELECT DISTINCT name FROM tel WHERE name > 'W12' ORDER BY name LIMIT 25"))
def _(spark, d):
    return reads.resume_entities(tv.readings(spark, d), "W12", 25)


SIGNED = ["name", "stage_num_td", "sample_count", "stage_start_ts", "stage_end_ts", "last_created_ts"]
SIGNED_SQL = f"""'ds-v1|' || name || '|' || CAST(stage_num_td AS VARCHAR) || '|' || CAST(sample_count AS VARCHAR) || '|' || {text('stage_start_ts')}
 || '|' || {text('stage_end_ts')} || '|' || COALESCE({text('last_created_ts')}, '')"""


@bound("source_signature", sql("win", f"SELECT name, stage_num_td, sha256({SIGNED_SQL}) AS source_signature FROM win"))
def _(spark, d):
    w = tv.stage_index(spark, d, with_site=False)
    return w.select("name", "stage_num_td", signatures.source_signature(w, "ds-v1", SIGNED).alias("source_signature"))


_WORDS = " || '|' || ".join(f"CAST(SUM(CAST(CAST('0x' || substr(m, {1 + 15 * i}, 15) AS BIGINT) AS HUGEINT)) AS VARCHAR)" for i in range(4))


@bound("population_signature", sql("win", f"""
SELECT sha256('v1|' || CAST(COUNT(*) AS VARCHAR) || '|' || {_WORDS}) AS population_signature, COUNT(*) AS population_size
FROM (SELECT sha256(name || '|' || CAST(stage_num_td AS VARCHAR) || '|' || sha256({SIGNED_SQL})) AS m FROM win)"""))
def _(spark, d):
    w = tv.stage_index(spark, d, with_site=False)
    signed = w.select("name", "stage_num_td", signatures.source_signature(w, "ds-v1", SIGNED).alias("source_signature"))
    return signatures.population_signature(signed, "v1", ["name", "stage_num_td"], "source_signature")


PATH = ["fleet_name", "pad_name", "name"]
_TREE_SUMS = ", ".join(f"CAST(SUM(CAST(CAST('0x' || substr(m, {1 + 15 * k}, 15) AS BIGINT) AS HUGEINT)) % {1 << 60} AS BIGINT) AS d{k}" for k in range(2))


@bound("signature_tree", sql("tel", "\nUNION ALL ".join(
    f"SELECT CAST({k} AS INTEGER) AS level, {', '.join(c if i < k else f'CAST(NULL AS VARCHAR) AS {c}' for i, c in enumerate(PATH))}, COUNT(*) AS rows, {_TREE_SUMS} FROM mem" + (f" GROUP BY {', '.join(PATH[:k])}" if k else "")
    for k in range(4)), f"\nmem AS (SELECT fleet_name, pad_name, name, md5(id || '|' || {text('record_ts')} || '|' || event_type) AS m FROM tel)"))
def _(spark, d):
    """Signatures of all readings, by fleet, pad and well; the second batch moves the tree of the first along its own paths."""
    rows = tv.telemetry(spark, d).select(*PATH, "id", "record_ts", "event_type", "event_id")
    signed = ["id", "record_ts", "event_type"]
    old = signatures.signature_tree(tv.first_batch(rows), PATH, signed)
    wells = tv.second_batch(rows).select(*PATH).distinct()
    leaves = signatures.signature_tree(rows.join(wells, PATH, "left_semi"), PATH, signed).where(F.col("level") == len(PATH))
    before = old.where(F.col("level") == len(PATH)).join(wells, PATH, "left_semi")
    moved = signatures.moved_tree(old, before, leaves, PATH)
    keys = ["level", *PATH]
    gone = moved.select(*[F.col(c).alias(f"m_{c}") for c in keys])
    kept = old.join(gone, signatures.same_key([(c, f"m_{c}") for c in keys]), "left_anti")
    return kept.unionByName(moved).select(*keys, *signatures.TREE)


@bound("changed_by_tree", sql("tel", """
SELECT fleet_name, pad_name, name, CASE WHEN COUNT(*) FILTER (event_id % 10 < 8) = 0 THEN 'added' ELSE 'changed' END AS change FROM tel GROUP BY 1, 2, 3 HAVING COUNT(*) FILTER (event_id % 10 >= 8) > 0"""))
def _(spark, d):
    """The wells that a batch changed, found by descending two trees."""
    rows = tv.telemetry(spark, d).select(*PATH, "id", "record_ts", "event_type", "event_id")
    signed = ["id", "record_ts", "event_type"]
    return signatures.changed_entities(signatures.signature_tree(tv.first_batch(rows), PATH, signed), signatures.signature_tree(rows, PATH, signed), PATH)


# --- P: projections, filters, predicates -----------------------------------


@bound("optional_filters", sql("tel", "SELECT name, record_ts, fleet_name, pad_name, rate_slurry FROM tel WHERE fleet_name = 'EUROPE'"))
def _(spark, d):
    return reads.optional_filters(tv.telemetry(spark, d), fleet="EUROPE", pad="", well="__ALL__", stage=-1).select("name", "record_ts", "fleet_name", "pad_name", "rate_slurry")


@bound("blank_to_default", sql("tel", """
SELECT id, COALESCE(NULLIF(fleet_name, ''), 'Unknown') AS fleet_name, COALESCE(NULLIF(fleet_name, ''), NULLIF(pad_name, ''), 'Unknown') AS site FROM tel"""))
def _(spark, d):
    return tv.telemetry(spark, d).select("id", blank_to("fleet_name").alias("fleet_name"), blank_to("fleet_name", "pad_name").alias("site"))


@bound("normalize_labels", sql("plab", """
SELECT name, datetime_fmt, CASE WHEN lower(substage) IN ('design', 'slurry') THEN 'design' WHEN lower(substage) IN ('shut_off', 'shutoff', 'shut_off_period') THEN 'shut_off'
  WHEN lower(substage) = 'na' THEN NULL ELSE lower(substage) END AS label FROM plab"""))
def _(spark, d):
    return tv.readings(spark, d).select("name", F.col("record_ts").alias("datetime_fmt"), normal_label(tv.substage_of_event()).alias("label"))


@bound("select_measure", sql("tel", """
SELECT id, prop_conc_inline AS inline, prop_conc_target AS target, prop_conc_blend_auger AS auger, prop_conc_blend_denso AS other FROM tel"""))
def _(spark, d):
    return tv.readings(spark, d).select("id", *[measure(m).alias(m) for m in ("inline", "target", "auger", "other")])


@bound("score_bands", sql("tel", """
SELECT id, CASE WHEN rate_slurry >= 70 THEN '#2A9D6F' WHEN rate_slurry >= 45 THEN '#E6A23C' ELSE '#D9534F' END AS color FROM tel"""))
def _(spark, d):
    return tv.readings(spark, d).select("id", band_color("rate_slurry").alias("color"))


@bound("relative_bounds", sql("wells win", """
SELECT 'pad' AS scope_level, COALESCE(NULLIF(fleet_name, ''), 'Unknown') AS fleet_name, pad_name, CAST(NULL AS VARCHAR) AS name, CAST(NULL AS BIGINT) AS stage_num_td,
       GREATEST(MIN(first_ts), MAX(last_ts) - INTERVAL 48 HOUR) AS start_time, MAX(last_ts) AS end_time FROM wells GROUP BY 2, 3
UNION ALL SELECT 'well', NULL, NULL, name, NULL, GREATEST(first_ts, last_ts - INTERVAL 48 HOUR), last_ts FROM wells
UNION ALL SELECT 'stage', NULL, NULL, name, stage_num_td, GREATEST(stage_start_ts, stage_end_ts - INTERVAL 48 HOUR), stage_end_ts FROM win"""))
def _(spark, d):
    rows = tv.telemetry(spark, d)
    wells, index = rollup.well_index(rows), stages.stage_windows(rows, GAP_SECONDS)
    levels = [reports.pad_relative_bounds(wells, index, "previous_48h", level) for level in ("pad", "well", "stage")]
    out = levels[0].unionByName(levels[1], allowMissingColumns=True).unionByName(levels[2], allowMissingColumns=True)
    return out.select("scope_level", "fleet_name", "pad_name", "name", "stage_num_td", "start_time", "end_time")


def _bounds(w: DataFrame) -> DataFrame:
    """The range of every stage; a chart shows all of them with their context, each reading once."""
    return w.select("name", F.col("stage_start_ts").alias("start_time"), F.col("stage_end_ts").alias("end_time"))


# Every stage's own range, for what is shown; ranges that meet as one, for the ends that are pinned.
BOUNDS_SQL = """
rng AS (SELECT name, stage_start_ts - INTERVAL 720 MINUTE AS f, stage_end_ts + INTERVAL 720 MINUTE AS t FROM win),
bnd AS (
  SELECT a.name, a.f, MIN(z.t) AS t
  FROM (SELECT DISTINCT name, f FROM rng x WHERE NOT EXISTS (SELECT 1 FROM rng y WHERE y.name = x.name AND y.f < x.f AND y.t >= x.f)) a
  JOIN (SELECT DISTINCT name, t FROM rng x WHERE NOT EXISTS (SELECT 1 FROM rng y WHERE y.name = x.name AND y.t > x.t AND y.f <= x.t)) z ON z.name = a.name AND z.t >= a.f
  GROUP BY 1, 2)"""
ANCHOR_SQL = f"""
SELECT name || ':context_start:' || {text('f')}, name, f, CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), 0.0, CAST(0 AS BIGINT) FROM bnd
UNION ALL SELECT name || ':context_end:' || {text('t')}, name, t, NULL, NULL, NULL, NULL, 0.0, 0 FROM bnd"""


@bound("context_window", sql("stg win", f"""
SELECT t.name || ':' || {text('t.record_ts')} AS telemetry_point_id, t.name AS well_name, t.record_ts AS "timestamp", CAST(w.stage_num_td AS DOUBLE) AS stage_num,
       t.rate_slurry, t.press_mainline, t.prop_conc_inline AS selected_concentration, CAST(NULL AS DOUBLE) AS context_anchor, CAST(1 AS BIGINT) AS records_in_bucket
FROM (SELECT * FROM tel t WHERE EXISTS (SELECT 1 FROM rng b WHERE b.name = t.name AND t.record_ts BETWEEN b.f AND b.t)) t
LEFT JOIN win w ON w.name = t.name AND t.record_ts BETWEEN w.stage_start_ts AND w.stage_end_ts
UNION ALL {ANCHOR_SQL}""", BOUNDS_SQL))
def _(spark, d):
    w = tv.stage_index(spark, d, with_site=False)
    return reports.chart_window(tv.readings(spark, d), w, _bounds(w), 720, "inline").select(*reports.CHART)


@bound("line_breaks", sql("win", f"""
SELECT name || ':stage_break:' || {text('stage_end_ts + INTERVAL 1 MILLISECOND')} AS telemetry_point_id, name AS well_name, stage_end_ts + INTERVAL 1 MILLISECOND AS "timestamp" FROM win"""))
def _(spark, d):
    return reports.line_breaks(reports.break_times(tv.stage_index(spark, d, with_site=False))).select("telemetry_point_id", "well_name", "timestamp")


@bound("safe_casts", sql("tel", """
SELECT id, TRY_CAST(CASE WHEN event_id % 7 = 0 THEN 'bad' ELSE CAST(prop_conc_target AS VARCHAR) END AS DOUBLE) AS number,
       CASE WHEN event_id % 5 = 0 OR event_id % 3 = 0 THEN NULL ELSE record_ts END AS at FROM tel"""))
def _(spark, d):
    e = F.col("event_id")
    number = F.when(e % 7 == 0, "bad").otherwise(F.col("prop_conc_target").cast("string"))
    at = F.when(e % 5 == 0, "").when(e % 3 == 0, "2024-99-01").otherwise(F.col("record_ts").cast("string"))
    return tv.readings(spark, d).select("id", safe_double(number).alias("number"), safe_time(at).alias("at"))


FAMILY_NAMES = """concat_ws('  ', r_name, n_name, CASE WHEN c_custkey % 2 = 0 THEN CAST(c_custkey AS VARCHAR) ELSE 'H' || CAST(c_custkey AS VARCHAR) END)"""


@bound("name_family", f"""
SELECT c_custkey, name, CASE WHEN pad <> '' THEN pad WHEN c_custkey % 2 = 0 THEN concat_ws(' ', r_name, n_name, CAST(c_custkey AS VARCHAR)) ELSE concat_ws(' ', r_name, n_name) END AS family
FROM (SELECT c_custkey, r_name, n_name, {FAMILY_NAMES} AS name, CASE WHEN c_custkey % 3 = 0 THEN c_mktsegment ELSE '' END AS pad
      FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN (SELECT r_regionkey, replace(r_name, ' ', '-') AS r_name FROM region) ON n_regionkey = r_regionkey)""")
def _(spark, d):
    c = tv.table(spark, d, "customer").join(tv.sites(spark, d), F.col("c_custkey") == F.col("user_id"))
    key = F.col("c_custkey").cast("string")
    last = F.when(F.col("c_custkey") % 2 == 0, key).otherwise(F.concat(F.lit("H"), key))
    named = c.select("c_custkey", F.concat_ws("  ", F.replace("fleet_site", F.lit(" "), F.lit("-")), "pad_name", last).alias("name"), F.when(F.col("c_custkey") % 3 == 0, F.col("c_mktsegment")).otherwise("").alias("pad"))
    return named.select("c_custkey", "name", name_family("name", "pad").alias("family"))


@bound("point_ids", sql("hist", f"SELECT name || ':' || CAST(stage_num AS VARCHAR) || ':' || {text('datetime_fmt')} AS point_id, name, datetime_fmt FROM hist"))
def _(spark, d):
    h = tv.history(spark, d)
    return h.select(point_id("name", number_text(F.col("stage_num").cast("double")), time_text("datetime_fmt")).alias("point_id"), "name", "datetime_fmt")


@bound("edit_flags", sql("ann lay", """
SELECT annotation_id, a.layer_id, COALESCE(is_editable AND owner_email = 'user3', false) AS can_edit FROM ann a LEFT JOIN lay l ON l.layer_id = a.layer_id"""))
def _(spark, d):
    return reports.edit_flags(tv.annotations(spark, d), tv.layers(spark, d), "user3").select("annotation_id", "layer_id", "can_edit")


@bound("resolution_switch", sql("win", f"""
SELECT * FROM (
SELECT name || ':' || {text('bucket_ts')} AS telemetry_point_id, name AS well_name, bucket_ts AS "timestamp", CAST(NULL AS DOUBLE) AS stage_num,
       {r('AVG(rate_slurry)')} AS rate_slurry, {r('AVG(press_mainline)')} AS press_mainline, {r('AVG(prop_conc_blend_denso)')} AS selected_concentration,
       CAST(NULL AS DOUBLE) AS context_anchor, COUNT(*) AS records_in_bucket
FROM (SELECT t.*, time_bucket(INTERVAL {BUCKET_SECONDS} SECOND, record_ts, TIMESTAMP '1970-01-01') AS bucket_ts FROM tel t WHERE EXISTS (SELECT 1 FROM rng b WHERE b.name = t.name AND t.record_ts BETWEEN b.f AND b.t))
GROUP BY name, bucket_ts
UNION ALL {ANCHOR_SQL}
UNION ALL SELECT w.name || ':stage_break:' || {text('stage_end_ts + INTERVAL 1 MILLISECOND')}, w.name, stage_end_ts + INTERVAL 1 MILLISECOND, NULL, NULL, NULL, NULL, NULL, 0
FROM win w WHERE EXISTS (SELECT 1 FROM rng b WHERE b.name = w.name AND w.stage_end_ts >= b.f AND w.stage_end_ts < b.t))""", BOUNDS_SQL))
def _(spark, d):
    w = tv.stage_index(spark, d, with_site=False)
    out = reports.pad_chart(tv.readings(spark, d), w, _bounds(w), 720, None, requested="rollup_120s", bucket_seconds=BUCKET_SECONDS)
    return show(out, *reports.CHART, rounded=("rate_slurry", "press_mainline", "selected_concentration"))


# --- J: joins --------------------------------------------------------------


@bound("interval_join", sql("tel", """
SELECT t.id, t.name, t.record_ts, w.stage_num_td FROM tel t LEFT JOIN w1 w ON w.name = t.name AND t.record_ts >= w.stage_start_ts AND t.record_ts <= w.stage_end_ts""", *FIRST))
def _(spark, d):
    rows = tv.readings(spark, d)
    w = stages.stage_windows(tv.first_batch(rows), GAP_SECONDS).select("name", "stage_num_td", "stage_start_ts", "stage_end_ts")
    return intervals.interval_join(rows.select("id", "name", "record_ts"), w, "record_ts", "stage_start_ts", "stage_end_ts", "left").select("id", "name", "record_ts", "stage_num_td")


@bound("annotated_readings", sql("tel ann", """
SELECT t.id, t.name, t.record_ts, a.annotation_id FROM tel t JOIN ann a ON a.name = t.name AND t.record_ts >= a.start_time AND t.record_ts <= a.end_time"""))
def _(spark, d):
    a = tv.annotations(spark, d).select("name", "annotation_id", "start_time", "end_time")
    return intervals.interval_join(tv.readings(spark, d).select("id", "name", "record_ts"), a, "record_ts", "start_time", "end_time", open_ended=True).select("id", "name", "record_ts", "annotation_id")


@bound("open_ended_join", sql("tel ann", """
SELECT t.id, t.name, t.record_ts, a.annotation_id FROM tel t LEFT JOIN ann a
ON a.name = t.name AND t.record_ts >= a.start_time AND t.record_ts <= CASE WHEN a.name LIKE '%7' THEN TIMESTAMP '9999-12-31' ELSE a.end_time END"""))
def _(spark, d):
    """Readings with their annotations, where some wells' annotations never end."""
    until = F.when(F.col("name").endswith("7"), reads.time_literal("9999-12-31")).otherwise(F.col("end_time"))
    a = tv.annotations(spark, d).select("name", "annotation_id", "start_time", until.alias("end_time"))
    rows = tv.readings(spark, d).select("id", "name", "record_ts")
    return intervals.interval_join(rows, a, "record_ts", "start_time", "end_time", "left", open_ended=True).select("id", "name", "record_ts", "annotation_id")


@bound("attach_labels", sql("tel mark", """
SELECT t.id, t.name, t.record_ts, m.stage_num_td, m.substage FROM tel t LEFT JOIN mark m ON m.name = t.name AND m.datetime_fmt = t.record_ts AND m.substage IN ('MID', 'MID_TRIAL')"""))
def _(spark, d):
    m = tv.marker_labels(spark, d).where(F.col("substage").isin("MID", "MID_TRIAL")).select("name", "stage_num_td", "datetime_fmt", "substage")
    return joins.attach_labels(tv.readings(spark, d).select("id", "name", "record_ts"), m).select("id", "name", "record_ts", "stage_num_td", "substage")


@bound("semi_join", sql("", "SELECT c_custkey, c_name FROM customer WHERE EXISTS (SELECT 1 FROM events WHERE user_id = c_custkey AND event_type = 'purchase')"))
def _(spark, d):
    e = tv.table(spark, d, "events").where(F.col("event_type") == "purchase").select(F.col("user_id").alias("c_custkey"))
    return tv.table(spark, d, "customer").join(e, "c_custkey", "left_semi").select("c_custkey", "c_name")


@bound("active_run_join", sql("man", "SELECT name, stage_num_td, source_rows FROM man WHERE status = 'active'"))
def _(spark, d):
    m = stored(tv.manifest(spark, d), "manifest")
    results = m.select(F.col("active_run_id").alias("processing_run_id"), "name", "stage_num_td", "algorithm_version", "source_rows")
    return joins.active_runs(results, m, "ds-v1").select("name", "stage_num_td", "source_rows")


@bound("changed_candidates", sql("win", """
SELECT a.name, a.stage_num_td, a.sample_count FROM win a LEFT JOIN w1 b ON a.name = b.name AND a.stage_num_td = b.stage_num_td
WHERE b.name IS NULL OR a.sample_count IS DISTINCT FROM b.sample_count OR a.stage_end_ts IS DISTINCT FROM b.stage_end_ts OR a.last_created_ts IS DISTINCT FROM b.last_created_ts""", *FIRST))
def _(spark, d):
    rows = tv.readings(spark, d)
    now, before = stages.stage_windows(rows, GAP_SECONDS), stages.stage_windows(tv.first_batch(rows), GAP_SECONDS)
    return joins.changed_candidates(now, before, {c: c for c in ("sample_count", "stage_end_ts", "last_created_ts")}).select("name", "stage_num_td", "sample_count")


@bound("overlap_count", sql("ann", """
SELECT a.layer_id, a.annotation_id, (SELECT COUNT(*) FROM ann b WHERE b.layer_id = a.layer_id AND b.status = 'active' AND b.annotation_id <> a.annotation_id
  AND b.start_time < a.end_time AND b.end_time > a.start_time) AS overlap_count FROM ann a WHERE a.status = 'active'"""))
def _(spark, d):
    active = tv.annotations(spark, d).where(F.col("status") == "active")
    return intervals.overlap_counts(active, "layer_id", "annotation_id", "start_time", "end_time")


@bound("overlap_filter", sql("ann", """
SELECT annotation_id, start_time, end_time FROM ann WHERE status = 'active' AND start_time <= TIMESTAMP '2024-01-20 12:00:00' AND end_time >= TIMESTAMP '2024-01-10'"""))
def _(spark, d):
    a = tv.annotations(spark, d).where(F.col("status") == "active")
    return intervals.overlapping(a, "start_time", "end_time", reads.time_literal("2024-01-10"), reads.time_literal("2024-01-20 12:00:00")).select("annotation_id", "start_time", "end_time")


LATE_SQL = """
late AS (SELECT t.* FROM tel t JOIN (SELECT name, MAX(record_ts) AS last_ts FROM t1 GROUP BY name) s ON s.name = t.name AND t.record_ts <= s.last_ts WHERE t.event_id % 10 >= 8),
hit AS (SELECT l.id, l.name, l.record_ts, COUNT(w.stage_num_td) AS matches, MAX(w.stage_num_td) AS stage
  FROM late l LEFT JOIN w1 w ON w.name = l.name AND l.record_ts >= w.stage_start_ts AND l.record_ts <= w.stage_end_ts GROUP BY 1, 2, 3)"""


@bound("late_row_match", sql("tel", "SELECT id, name, record_ts, matches, CASE WHEN matches = 1 THEN stage END AS matched_value FROM hit", *FIRST, LATE_SQL))
def _(spark, d):
    rows = tv.readings(spark, d)
    w = stored(stages.stage_windows(tv.first_batch(rows), GAP_SECONDS), "first-windows")
    late = stages.split_late(tv.second_batch(rows), stages.session_state(w)).where("is_late")
    return intervals.windows_holding(late, w, "record_ts", "stage_start_ts", "stage_end_ts", "stage_num_td").select("id", "name", "record_ts", "matches", "matched_value")


@bound("scalar_cross_join", sql("win", """
SELECT name, COUNT(*) AS stages, CAST((SELECT COUNT(*) FROM win) AS BIGINT) AS total_stages FROM win GROUP BY name"""))
def _(spark, d):
    per_well = tv.stage_index(spark, d, with_site=False).groupBy("name").agg(F.count(F.lit(1)).alias("stages"))
    return joins.with_scalar(per_well, per_well.agg(F.sum("stages").alias("total_stages")))


@bound("catalog_join", sql("plab", """
SELECT c.sort_order, c.substage_key, c.substage_label, COALESCE(n, 0) AS row_count
FROM (VALUES (1, 'stage_start', 'Stage Start'), (2, 'ramp_up', 'Ramp Up'), (3, 'design', 'Design'), (4, 'ramp_down', 'Ramp Down'), (5, 'shut_off', 'Shut-Off'), (6, 'stage_end', 'Stage End')) c(sort_order, substage_key, substage_label)
LEFT JOIN (SELECT CASE WHEN substage = 'slurry' THEN 'design' ELSE substage END AS k, COUNT(*) AS n FROM plab WHERE substage <> 'NA' GROUP BY 1) x ON x.k = c.substage_key"""))
def _(spark, d):
    counts = tv.readings(spark, d).select(normal_label(tv.substage_of_event()).alias("label")).where("label IS NOT NULL").groupBy("label").agg(F.count(F.lit(1)).alias("row_count"))
    return joins.catalog_counts(counts, "label", "row_count")


@bound("metadata_merge", sql("win", """
SELECT w.name, w.stage_num_td, m.fleet_name, m.pad_name FROM win w
LEFT JOIN (SELECT name, MIN(fleet_name) AS fleet_name, MIN(pad_name) AS pad_name FROM tel GROUP BY name) m ON m.name = w.name"""))
def _(spark, d):
    meta = tv.telemetry(spark, d).select("name", "fleet_name", "pad_name")
    return joins.metadata_merge(tv.stage_index(spark, d, with_site=False).select("name", "stage_num_td"), meta, ["name"], ["fleet_name", "pad_name"])


@bound("key_list_join", sql("tel", "SELECT name, record_ts, id FROM tel WHERE name IN ('W1', 'W7', 'W12')"))
def _(spark, d):
    return reads.key_list_join(tv.readings(spark, d), reads.key_list(spark, ["W1", "W7", "W12"])).select("name", "record_ts", "id")


# --- A: aggregations -------------------------------------------------------

ROLLUP_COLUMNS = ["bucket_seconds", "bucket_ts", "fleet_name", "pad_name", "name", "id", "api_num", "first_record_ts", "last_record_ts", "first_created_ts", "last_created_ts", "records_in_bucket"]
STATS = [f"{m}_{s}" for m in catalog.MEASURE_COLUMNS for s in ("avg", "min", "max", "first", "last")]


def _rollup_sql(source: str) -> str:
    stats = ", ".join(
        f"{r(f'AVG({m})')} AS {m}_avg, MIN({m}) AS {m}_min, MAX({m}) AS {m}_max, arg_min({m}, record_ts) AS {m}_first, arg_max({m}, record_ts) AS {m}_last"
        for m in catalog.MEASURE_COLUMNS
    )
    return f"""
SELECT CAST({BUCKET_SECONDS} AS INTEGER) AS bucket_seconds, time_bucket(INTERVAL {BUCKET_SECONDS} SECOND, record_ts, TIMESTAMP '1970-01-01') AS bucket_ts,
       COALESCE(NULLIF(fleet_name, ''), 'Unknown') AS fleet_name, pad_name, name, arg_max(id, record_ts) AS id, arg_max(api_num, record_ts) AS api_num,
       MIN(record_ts) AS first_record_ts, MAX(record_ts) AS last_record_ts, MIN(created_ts) AS first_created_ts, MAX(created_ts) AS last_created_ts,
       COUNT(*) AS records_in_bucket, {stats}
FROM {source} GROUP BY 2, 3, 4, 5"""


@bound("tumbling_rollup", sql("tel", _rollup_sql("tel")))
def _(spark, d):
    return show(rollup.tumbling_rollup(tv.telemetry(spark, d), BUCKET_SECONDS), *ROLLUP_COLUMNS, *STATS, rounded=tuple(s for s in STATS if s.endswith("_avg")))


WIDTHS = [BUCKET_SECONDS, 6 * BUCKET_SECONDS, 24 * BUCKET_SECONDS]
PYRAMID_STATS = ["rate_slurry_avg", "rate_slurry_min", "rate_slurry_max", "rate_slurry_first", "rate_slurry_last", "press_mainline_avg"]


@bound("rollup_pyramid", sql("tel", "\nUNION ALL ".join(f"""
SELECT CAST({width} AS INTEGER) AS bucket_seconds, time_bucket(INTERVAL {width} SECOND, record_ts, TIMESTAMP '1970-01-01') AS bucket_ts, COALESCE(NULLIF(fleet_name, ''), 'Unknown') AS fleet_name, pad_name, name,
       COUNT(*) AS records_in_bucket, {r('AVG(rate_slurry)')} AS rate_slurry_avg, MIN(rate_slurry) AS rate_slurry_min, MAX(rate_slurry) AS rate_slurry_max,
       arg_min(rate_slurry, record_ts) AS rate_slurry_first, arg_max(rate_slurry, record_ts) AS rate_slurry_last, {r('AVG(press_mainline)')} AS press_mainline_avg
FROM tel GROUP BY 2, 3, 4, 5""" for width in WIDTHS)))
def _(spark, d):
    """Three widths of the first batch, refreshed where the second one has readings."""
    rows = tv.telemetry(spark, d)
    old = stored(rollup.pyramid(tv.first_batch(rows), WIDTHS), "pyramid")
    bucket = slot_start("record_ts", WIDTHS[0])
    dirty = tv.second_batch(rows).select(bucket.alias("_b"), F.col("name").alias("_name")).distinct()
    base = rollup.base_level(rows.join(dirty, (bucket == F.col("_b")) & (F.col("name") == F.col("_name")), "left_semi"), WIDTHS[0])
    fresh = stored(rollup.refreshed_levels(old, stored(base, "base"), WIDTHS), "refreshed")
    now = old.join(fresh.select(*rollup.PYRAMID_KEY), rollup.PYRAMID_KEY, "left_anti").unionByName(fresh)
    return show(rollup.pyramid_values(now), *rollup.PYRAMID_KEY, "records_in_bucket", *PYRAMID_STATS, rounded=("rate_slurry_avg", "press_mainline_avg"))


@bound("bucket_average", sql("tel", f"""
SELECT name, time_bucket(INTERVAL {BUCKET_SECONDS} SECOND, record_ts, TIMESTAMP '1970-01-01') AS bucket_ts, {r('AVG(rate_slurry)')} AS rate_slurry,
       {r('AVG(press_mainline)')} AS press_mainline, COUNT(*) AS records_in_bucket FROM tel GROUP BY 1, 2"""))
def _(spark, d):
    out = rollup.bucket_average(tv.readings(spark, d), BUCKET_SECONDS, ["rate_slurry", "press_mainline"])
    return show(out, "name", "bucket_ts", "rate_slurry", "press_mainline", "records_in_bucket", rounded=("rate_slurry", "press_mainline"))


WINDOW_AVG = ("avg_rate_slurry", "avg_press_mainline", "avg_prop_conc_blend_denso")
WINDOW_COLUMNS = [
    "name", "stage_num_td", "fleet_name", "pad_name", "well_id", "api_num", "stage_start_ts", "stage_end_ts", "first_created_ts", "last_created_ts", "sample_count",
    "avg_rate_slurry", "max_rate_slurry", "avg_press_mainline", "max_press_mainline", "avg_prop_conc_blend_denso", "max_prop_conc_blend_denso",
]
WINDOWS_SQL = "SELECT " + ", ".join(f"{r(c)} AS {c}" if c in WINDOW_AVG else c for c in WINDOW_COLUMNS) + " FROM win"


@bound("stage_windows", sql("win", WINDOWS_SQL))
def stage_windows(spark, d):
    return show(tv.stage_index(spark, d), *WINDOW_COLUMNS, rounded=WINDOW_AVG)


@bound("stage_index", sql("hidx", f"""
SELECT name, stage_num, stage_start_ts, stage_end_ts, sample_count, source_record_count, {r('avg_rate_slurry')} AS avg_rate_slurry, max_press_mainline FROM hidx"""))
def _(spark, d):
    return show(rollup.history_stage_index(tv.history(spark, d)), "name", "stage_num", "stage_start_ts", "stage_end_ts", "sample_count", "source_record_count", "avg_rate_slurry", "max_press_mainline", rounded=("avg_rate_slurry",))


WELL_COLUMNS = ["name", "well_family", "fleet_name", "pad_name", "well_id", "api_num", "first_record_ts", "last_record_ts", "first_created_ts", "last_created_ts", "sample_count"]


@bound("well_index", sql("wells", f"SELECT {', '.join(WELL_COLUMNS)} FROM wells"))
def _(spark, d):
    return rollup.well_index(tv.telemetry(spark, d)).select(*WELL_COLUMNS)


@bound("history_well_index", sql("hist", f"""
SELECT frac_id, name, name AS well_family, COUNT(*) AS sample_count, COUNT(DISTINCT stage_num) AS stage_count, MIN(stage_num) AS min_stage_num, MAX(stage_num) AS max_stage_num,
       {text('MIN(datetime_fmt)')} AS first_ts, {text('MAX(datetime_fmt)')} AS last_ts, {text('MIN(created_ts)')} AS first_created_ts FROM hist GROUP BY frac_id, name"""))
def _(spark, d):
    return rollup.history_well_index(tv.history(spark, d)).select("frac_id", "name", "well_family", "sample_count", "stage_count", "min_stage_num", "max_stage_num", "first_ts", "last_ts", "first_created_ts")


@bound("merge_windows", sql("win", "SELECT name, stage_num_td, stage_start_ts, stage_end_ts, first_created_ts, last_created_ts, sample_count, "
                            + ", ".join(f"{r(c)} AS {c}" for c in WINDOW_AVG) + ", max_rate_slurry FROM win"))
def _(spark, d):
    assigned = tv.staged(spark, d)
    out = stages.merge_partials(stages.partials_of_assigned(tv.first_batch(assigned)), stages.partials_of_assigned(tv.second_batch(assigned)))
    return show(out, "name", "stage_num_td", "stage_start_ts", "stage_end_ts", "first_created_ts", "last_created_ts", "sample_count", *WINDOW_AVG, "max_rate_slurry", rounded=WINDOW_AVG)


def _presence_labels(spark, d):
    return tv.labels(spark, d, GAP_SECONDS)


PIVOT = ["well_name", "stage_num", "stage_start", "ramp_up", "design", "ramp_down", "shut_off", "stage_end"]
COVER_SQL = """
cov AS (SELECT *, stage_start + ramp_up + design + ramp_down + stage_end AS present_required FROM pres)"""


@bound("presence_pivot", sql("pres", f"SELECT {', '.join(PIVOT)} FROM pres"))
def _(spark, d):
    return presence.presence_pivot(_presence_labels(spark, d)).select(*PIVOT)


@bound("presence_coverage", sql("pres", """
SELECT well_name, stage_num, present_required, CAST(present_required * 20 AS DOUBLE) AS coverage_percent, 5 - present_required AS missing_count,
       CASE WHEN present_required = 5 THEN 1 ELSE 0 END AS complete_stage,
       concat_ws(', ', CASE WHEN stage_start = 0 THEN 'Stage Start' END, CASE WHEN ramp_up = 0 THEN 'Ramp Up' END, CASE WHEN design = 0 THEN 'Design' END,
                 CASE WHEN ramp_down = 0 THEN 'Ramp Down' END, CASE WHEN stage_end = 0 THEN 'Stage End' END) AS missing_substages FROM cov""", COVER_SQL))
def _(spark, d):
    out = presence.presence_coverage(presence.presence_pivot(_presence_labels(spark, d)))
    return out.select("well_name", "stage_num", "present_required", "coverage_percent", "missing_count", "complete_stage", "missing_substages")


SCOPED_SQL = """
scope AS (SELECT DISTINCT name FROM wells WHERE COALESCE(NULLIF(fleet_name, ''), 'Unknown') = 'ASIA'),
scov AS (SELECT * FROM cov WHERE well_name IN (SELECT name FROM scope))"""


@bound("presence_scoped_rows", sql("pres wells", """
SELECT well_name, stage_num, well_name || ' · ' || CAST(stage_num AS VARCHAR) AS stage_label, present_required, 5 - present_required AS missing_count FROM scov""", COVER_SQL, SCOPED_SQL))
def _(spark, d):
    labels = presence.in_scope(_presence_labels(spark, d), rollup.well_index(tv.telemetry(spark, d)), fleet="ASIA")
    out = presence.presence_coverage(presence.presence_pivot(labels)).withColumn("stage_label", presence.stage_label())
    return out.select("well_name", "stage_num", "stage_label", "present_required", "missing_count")


@bound("presence_scoped_summary", sql("pres wells", f"""
SELECT COUNT(*) AS total_stages, {r('SUM(present_required) * 100.0 / 5 / COUNT(*)', 1)} AS average_coverage,
       CAST(SUM(CASE WHEN present_required = 5 THEN 1 ELSE 0 END) AS BIGINT) AS complete_stages FROM scov""", COVER_SQL, SCOPED_SQL))
def _(spark, d):
    labels = presence.in_scope(_presence_labels(spark, d), rollup.well_index(tv.telemetry(spark, d)), fleet="ASIA")
    return presence.presence_summary(presence.presence_coverage(presence.presence_pivot(labels)))


@bound("presence_summary", sql("pres", f"""
SELECT COUNT(*) AS total_stages, {r('SUM(present_required) * 100.0 / 5 / COUNT(*)', 1)} AS average_coverage,
       CAST(SUM(CASE WHEN present_required = 5 THEN 1 ELSE 0 END) AS BIGINT) AS complete_stages FROM cov""", COVER_SQL))
def _(spark, d):
    return presence.presence_summary(presence.presence_coverage(presence.presence_pivot(_presence_labels(spark, d))))


@bound("pair_presence", sql("pres", f"""
SELECT sort_order, substage_key, substage_label, present_count, total_stages, {r('present_count * 100.0 / total_stages', 1)} AS presence_percent, 'All Wells' AS scope_label
FROM (SELECT COUNT(*) AS total_stages, SUM(stage_start) AS a, SUM(ramp_up) AS b, SUM(design) AS c, SUM(ramp_down) AS e, SUM(shut_off) AS f, SUM(stage_end) AS g FROM pres) t,
LATERAL (VALUES (1, 'stage_start', 'Stage Start', CAST(a AS BIGINT)), (2, 'ramp_up', 'Ramp Up', CAST(b AS BIGINT)), (3, 'design', 'Design', CAST(c AS BIGINT)),
  (4, 'ramp_down', 'Ramp Down', CAST(e AS BIGINT)), (5, 'shut_off', 'Shut-Off', CAST(f AS BIGINT)), (6, 'stage_end', 'Stage End', CAST(g AS BIGINT))) v(sort_order, substage_key, substage_label, present_count)"""))
def _(spark, d):
    return presence.pair_presence(_presence_labels(spark, d)).select("sort_order", "substage_key", "substage_label", "present_count", "total_stages", "presence_percent", "scope_label")


@bound("presence_cells", sql("pres", """
SELECT well_name, stage_num, v.* FROM pres, LATERAL (VALUES (1, 'stage_start', 'Stage Start', stage_start), (2, 'ramp_up', 'Ramp Up', ramp_up), (3, 'design', 'Design', design),
  (4, 'ramp_down', 'Ramp Down', ramp_down), (5, 'shut_off', 'Shut-Off', shut_off), (6, 'stage_end', 'Stage End', stage_end)) v(sort_order, substage_key, substage_label, presence_value)"""))
def _(spark, d):
    return presence.presence_cells(presence.presence_pivot(_presence_labels(spark, d)))


@bound("design_medians", sql("mark", f"""
SELECT name, stage_num_td, CASE WHEN rate > 0 THEN {r('rate')} END AS inferred_design_rate, CASE WHEN pressure > 0 THEN {r('pressure')} END AS inferred_pressure
FROM (SELECT name, stage_num_td, median(rate_slurry) AS rate, median(press_mainline) AS pressure FROM mark WHERE substage IN ('MID_TRIAL', 'MID') GROUP BY 1, 2)"""))
def _(spark, d):
    return show(labelling.design_medians(tv.marker_labels(spark, d)), "name", "stage_num_td", "inferred_design_rate", "inferred_pressure", rounded=("inferred_design_rate", "inferred_pressure"))


STEP_SQL = """
step AS (SELECT name, stage_num_td, COALESCE(median(gap), 1.0) AS sampling_step
  FROM (SELECT name, stage_num_td, (epoch_us(record_ts) - epoch_us(LAG(record_ts) OVER (PARTITION BY name, stage_num_td ORDER BY record_ts))) / 1000000 AS gap FROM long) GROUP BY 1, 2)"""


@bound("sampling_step", sql("long", f"SELECT name, stage_num_td, {r('sampling_step', 5)} AS sampling_step FROM step", STEP_SQL))
def _(spark, d):
    out = labelling.sampling_step(tv.staged(spark, d, LONG_GAP_SECONDS), slot_seconds=SLOT)
    return out.select("name", "stage_num_td", shown("sampling_step", 5))


# --- W: ordered computation ------------------------------------------------


@bound("gap_sessions", sql("stg", "SELECT id, name, record_ts, stage_num_td FROM stg"))
def _(spark, d):
    return tv.staged(spark, d).select("id", "name", "record_ts", "stage_num_td")


@bound("gap_sessions_shipments", f"""
SELECT name, stage_num_td, MIN(record_ts) AS stage_start_ts, MAX(record_ts) AS stage_end_ts, COUNT(*) AS sample_count
FROM (SELECT *, SUM(is_new) OVER (PARTITION BY name ORDER BY record_ts, l_orderkey, l_linenumber ROWS UNBOUNDED PRECEDING)::BIGINT AS stage_num_td
  FROM (SELECT 'S' || CAST(l_suppkey AS VARCHAR) AS name, l_shipdate AS record_ts, l_orderkey, l_linenumber,
    CASE WHEN LAG(l_shipdate) OVER o IS NULL
           OR epoch_us(l_shipdate) - epoch_us(LAG(l_shipdate) OVER o) >= 864000000000 THEN 1 ELSE 0 END AS is_new FROM lineitem WINDOW o AS (PARTITION BY l_suppkey ORDER BY l_shipdate, l_orderkey, l_linenumber)))
GROUP BY 1, 2""")
def _(spark, d):
    return stages.assign_stages(tv.shipments(spark, d), 864_000).groupBy("name", "stage_num_td").agg(
        F.min("record_ts").alias("stage_start_ts"), F.max("record_ts").alias("stage_end_ts"), F.count(F.lit(1)).alias("sample_count"))


def _islands_sql(source: str, keys: str, ts: str, label: str, gap: int | None = None) -> str:
    pause = f" OR epoch_us({ts}) - epoch_us(LAG({ts}) OVER w) > {gap}000000" if gap else ""
    return f"""
SELECT {keys}, {label}, MIN({ts}) AS start_ts, MAX({ts}) AS end_ts, COUNT(*) AS sample_count
FROM (SELECT *, SUM(is_new) OVER (PARTITION BY {keys} ORDER BY {ts}, {label} ROWS UNBOUNDED PRECEDING) AS island
  FROM (SELECT *, CASE WHEN LAG({ts}) OVER w IS NULL OR LAG({label}) OVER w IS DISTINCT FROM {label}{pause} THEN 1 ELSE 0 END AS is_new
    FROM {source} WINDOW w AS (PARTITION BY {keys} ORDER BY {ts}, {label})))
GROUP BY {keys}, {label}, island"""


@bound("label_islands", sql("lab", _islands_sql("(SELECT * FROM lab WHERE substage <> 'NA')", "name, stage_num_td", "datetime_fmt", "substage")))
def _(spark, d):
    rows = tv.labels(spark, d).where(has_label("substage"))
    return islands.label_islands(rows, ["name", "stage_num_td"], "datetime_fmt", "substage", slot_seconds=SLOT)


@bound("label_islands_shipments", _islands_sql("(SELECT 'S' || CAST(l_suppkey AS VARCHAR) AS name, l_shipdate AS record_ts, l_returnflag AS substage FROM lineitem)", "name", "record_ts", "substage"))
def _(spark, d):
    return islands.label_islands(tv.shipments(spark, d), ["name"], "record_ts", "substage", slot_seconds=30 * 86_400.0)


@bound("islands_in_window", sql("lab hidx", _islands_sql(
    "(SELECT l.name, h.stage_num, l.datetime_fmt, l.substage FROM lab l JOIN hidx h ON h.name = l.name AND l.datetime_fmt BETWEEN h.stage_start_ts AND h.stage_end_ts WHERE l.substage <> 'NA')",
    "name, stage_num", "datetime_fmt", "substage")))
def _(spark, d):
    index = rollup.history_stage_index(tv.history(spark, d)).select("name", "stage_num", "stage_start_ts", "stage_end_ts")
    rows = tv.labels(spark, d).where(has_label("substage")).select("name", "datetime_fmt", "substage")
    inside = intervals.interval_join(rows, index, "datetime_fmt", "stage_start_ts", "stage_end_ts")
    return islands.label_islands(inside, ["name", "stage_num"], "datetime_fmt", "substage", slot_seconds=SLOT)


ISLE_SQL = "\nisle AS (" + _islands_sql("(SELECT * FROM lab WHERE substage <> 'NA')", "name, stage_num_td", "datetime_fmt", "substage") + ")"
ISLE_ID = f"md5('platinum|' || name || '|' || CAST(stage_num_td AS VARCHAR) || '|' || substage || '|' || {text('start_ts')} || '|' || {text('end_ts')})"
ISLE_COLOR = "CASE substage WHEN 'stage_start' THEN '#1A008B' WHEN 'ramp_up' THEN '#FF1892' WHEN 'slurry' THEN '#01FF81' WHEN 'ramp_down' THEN '#FEA804' WHEN 'shut_off' THEN '#830080' WHEN 'stage_end' THEN '#08FDFF' ELSE '#787878' END"
PAD_COLOR = ISLE_COLOR.replace("#1A008B", "#8A8FC9").replace("#08FDFF", "#7FB8C2")


@bound("island_annotations", sql("lab", f"""
SELECT {ISLE_ID} AS annotation_id, name AS well_name, CAST(stage_num_td AS DOUBLE) AS stage_num, substage AS substage_name, start_ts AS start_time, end_ts AS end_time,
       CASE WHEN substage IN ('stage_start', 'stage_end') THEN 'point' ELSE 'window' END AS annotation_type, {PAD_COLOR} AS color
FROM isle WHERE start_ts < end_ts OR substage IN ('stage_start', 'stage_end')""", ISLE_SQL))
def _(spark, d):
    out = reports.island_annotations(tv.labels(spark, d), pad=True, slot_seconds=SLOT)
    return out.select("annotation_id", "well_name", "stage_num", "substage_name", "start_time", "end_time", "annotation_type", "color")


def _unit(c: str) -> str:
    return f"CAST(ROUND({c} * 1000000) AS BIGINT)"


def _delta(c: str, n: int) -> str:
    now = f"ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW"
    was = f"ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING"
    o = "PARTITION BY name, stage_num_td ORDER BY datetime_fmt"
    return (f"CAST(ROUND(CAST(SUM({c}) OVER ({o} {now}) AS DOUBLE) / COUNT({c}) OVER ({o} {now}) - CAST(SUM({c}) OVER ({o} {was}) AS DOUBLE) / "
            f"NULLIF(COUNT({c}) OVER ({o} {was}), 0)) AS BIGINT)")


DESIGN_SQL = f"\ndes AS (SELECT *, {_unit('press_mainline')} AS p, {_unit('rate_slurry')} AS q FROM lab WHERE substage IN ('design', 'slurry'))"


@bound("rolling_deltas", sql("lab", f"""
SELECT name, stage_num_td, datetime_fmt, {_delta('p', 3)} / 1000000 AS delta_pressure, {_delta('q', 3)} / 1000000 AS delta_rate FROM des""", DESIGN_SQL))
def _(spark, d):
    return anomaly.rolling_deltas(tv.labels(spark, d), 3, SLOT).select("name", "stage_num_td", "datetime_fmt", "delta_pressure", "delta_rate")


@bound("delta_traces", sql("lab", f"""
SELECT l.name, l.stage_num_td, l.datetime_fmt AS "timestamp", dp AS delta_pressure, dq AS delta_rate, CASE WHEN dp >= 200 THEN dp END AS pressure_trigger,
       CASE WHEN dq <= -5 THEN dq END AS rate_trigger, CAST(200 AS DOUBLE) AS pressure_threshold, CAST(-5 AS DOUBLE) AS negative_rate_threshold
FROM lab l LEFT JOIN (SELECT name, stage_num_td, datetime_fmt, {_delta('p', 2)} / 1000000 AS dp, {_delta('q', 2)} / 1000000 AS dq FROM des) x
  ON x.name = l.name AND x.stage_num_td = l.stage_num_td AND x.datetime_fmt = l.datetime_fmt""", DESIGN_SQL))
def _(spark, d):
    return anomaly.delta_traces(tv.labels(spark, d), LIMITS, SLOT)


# Row anomalies: shutdown = 2 rows in a row below rate 20; sweep = 1 row beside one.
ANOM_SQL = f"""
a0 AS (SELECT *, {_delta('p', 2)} AS dp, {_delta('q', 2)} AS dq, rate_slurry < 20 AS low, LAG(rate_slurry) OVER o < 20 AS low_b, LEAD(rate_slurry) OVER o < 20 AS low_a
  FROM des WINDOW o AS (PARTITION BY name, stage_num_td ORDER BY datetime_fmt)),
a1 AS (SELECT *, COALESCE(low AND (low_b OR low_a), false) AS shut FROM a0),
a2 AS (SELECT *, COALESCE(LEAD(shut) OVER o, false) AS shut_next, COALESCE(LAG(shut) OVER o, false) AS shut_prev FROM a1 WINDOW o AS (PARTITION BY name, stage_num_td ORDER BY datetime_fmt)),
anom AS (SELECT name, stage_num_td, datetime_fmt, CASE WHEN shut THEN 'mid_stage_shutdown' WHEN shut_next THEN 'sweep_pre' WHEN shut_prev THEN 'sweep_post'
  WHEN dq <= -5000000 THEN 'pump_rate_drop' WHEN dp >= 200000000 THEN 'pressure_surge' END AS anomaly FROM a2)"""
EVENT_SQL = "\nev AS (" + _islands_sql("(SELECT * FROM anom WHERE anomaly IS NOT NULL)", "name, stage_num_td", "datetime_fmt", "anomaly", 86_400) + ")"
SUMMARY_SQL = """
summ AS (SELECT w.name, w.stage_num_td, w.fleet_name, w.pad_name, w.sample_count, COUNT(e.anomaly) AS total_anomaly_lines,
  COUNT(*) FILTER (WHERE e.anomaly = 'pressure_surge') AS pressure_surge_lines, COUNT(*) FILTER (WHERE e.anomaly = 'pump_rate_drop') AS pump_rate_drop_lines,
  COUNT(*) FILTER (WHERE e.anomaly = 'mid_stage_shutdown') AS mid_stage_shutdown_lines, COUNT(*) FILTER (WHERE e.anomaly IN ('sweep_pre', 'sweep_post')) AS sweep_lines
  FROM lwin w LEFT JOIN ev e ON e.name = w.name AND e.stage_num_td = w.stage_num_td GROUP BY 1, 2, 3, 4, 5)"""
ANOMALY_SQL = (DESIGN_SQL, ANOM_SQL, EVENT_SQL, SUMMARY_SQL)


@bound("first_match_label", sql("lab", "SELECT * FROM anom", DESIGN_SQL, ANOM_SQL))
def _(spark, d):
    return anomaly.row_anomalies(tv.labels(spark, d), LIMITS, SLOT)


def _events(spark, d):
    labels = stored(tv.labels(spark, d), "labels")
    flagged = anomaly.row_anomalies(labels, LIMITS, SLOT).where(F.col("anomaly").isNotNull())
    return islands.event_segments(flagged, LIMITS.max_gap_seconds, run_id="run", slot_seconds=SLOT)


@bound("event_segments", sql("lab", f"""
SELECT sha256('run|' || name || '|' || CAST(stage_num_td AS VARCHAR) || '|' || anomaly || '|' || {text('start_ts')} || '|' || {text('end_ts')}) AS event_id, name, stage_num_td, anomaly,
       CASE anomaly WHEN 'pressure_surge' THEN 'Pressure Surge' WHEN 'pump_rate_drop' THEN 'Pump Rate Drop' WHEN 'mid_stage_shutdown' THEN 'Mid Stage Shutdown'
         WHEN 'sweep_pre' THEN 'Sweep Pre' ELSE 'Sweep Post' END AS anomaly_display, start_ts, end_ts,
       (epoch_us(end_ts) - epoch_us(start_ts)) / 1000000 AS duration_sec, (epoch_us(end_ts) - epoch_us(start_ts)) / 1000000 / 60 AS duration_min FROM ev""", DESIGN_SQL, ANOM_SQL, EVENT_SQL))
def _(spark, d):
    return _events(spark, d)


LINE_COLUMNS = ["name", "stage_num_td", *anomaly.LINES]


def _summary(spark, d) -> DataFrame:
    return anomaly.stage_event_counts(tv.stage_index(spark, d, with_site=False, gap=LONG_GAP_SECONDS).select("name", "stage_num_td"), _events(spark, d))


@bound("stage_event_counts", sql("lab lwin", f"SELECT {', '.join(LINE_COLUMNS)} FROM summ", *ANOMALY_SQL))
def _(spark, d):
    return _summary(spark, d).select(*LINE_COLUMNS)


_SUMS = ", ".join(f"CAST(SUM({c}) AS BIGINT) AS {c}" for c in anomaly.LINES)


@bound("anomaly_summary", sql("lab lwin", f"""
SELECT COUNT(DISTINCT name) AS total_wells, COUNT(*) AS total_stages, COUNT(*) FILTER (WHERE total_anomaly_lines > 0) AS stages_with_anomaly, {_SUMS} FROM summ""", *ANOMALY_SQL))
def _(spark, d):
    return anomaly.anomaly_summary(_summary(spark, d))


@bound("anomaly_by_well", sql("lab lwin", f"""
SELECT name AS well_name, COUNT(*) AS stages_total, COUNT(*) FILTER (WHERE total_anomaly_lines > 0) AS stages_with_anomaly, {_SUMS} FROM summ GROUP BY name""", *ANOMALY_SQL))
def _(spark, d):
    return anomaly.anomaly_by_well(_summary(spark, d))


@bound("anomaly_by_kind", sql("lab lwin", """
SELECT 1 AS sort_order, 'Pressure Surges' AS anomaly_type, CAST(SUM(pressure_surge_lines) AS BIGINT) AS anomaly_lines, '#D35400' AS color FROM summ
UNION ALL SELECT 2, 'Pump Rate Drops', CAST(SUM(pump_rate_drop_lines) AS BIGINT), '#2878B5' FROM summ
UNION ALL SELECT 3, 'Mid-Stage Shutdowns', CAST(SUM(mid_stage_shutdown_lines) AS BIGINT), '#30343B' FROM summ
UNION ALL SELECT 4, 'Sweep', CAST(SUM(sweep_lines) AS BIGINT), '#2A9D6F' FROM summ""", *ANOMALY_SQL))
def _(spark, d):
    return anomaly.anomaly_by_kind(_summary(spark, d))


GRID_SQL = f"""
g0 AS (SELECT *, substage IN ('design', 'slurry') AS is_des, LAG(substage IN ('design', 'slurry')) OVER (PARTITION BY name, stage_num_td ORDER BY datetime_fmt) AS prev_des FROM lab),
g1 AS (SELECT *, {_unit('press_mainline')} AS p, {_unit('rate_slurry')} AS q FROM g0 WHERE is_des),
g2 AS ({" UNION ALL ".join(f"SELECT name, stage_num_td, datetime_fmt, prev_des, {n} AS rolling_points, {_delta('p', n)} AS dp, {_delta('q', n)} AS dq FROM g1" for n in range(1, 11))}),
g3 AS (SELECT *, CASE WHEN prev_des THEN LAG(dp) OVER o END AS dp0, CASE WHEN prev_des THEN LAG(dq) OVER o END AS dq0 FROM g2 WINDOW o AS (PARTITION BY rolling_points, name, stage_num_td ORDER BY datetime_fmt)),
g4 AS (SELECT name, stage_num_td, rolling_points, 'pressure' AS threshold_type, CAST(k AS DOUBLE) AS threshold_value, COUNT(*) AS n FROM g3, (SELECT unnest(range(50, 501, 10)) AS k)
    WHERE dp >= k * 1000000 AND COALESCE(dp0 < k * 1000000, true) GROUP BY ALL
  UNION ALL SELECT name, stage_num_td, rolling_points, 'rate', CAST(k AS DOUBLE), COUNT(*) FROM g3, (SELECT unnest(range(1, 21)) AS k)
    WHERE dq <= -k * 1000000 AND COALESCE(dq0 > -k * 1000000, true) GROUP BY ALL),
gk AS (SELECT 'pressure' AS threshold_type, CAST(unnest(range(50, 501, 10)) AS DOUBLE) AS threshold_value UNION ALL SELECT 'rate', CAST(unnest(range(1, 21)) AS DOUBLE)),
grid AS (SELECT w.name, w.stage_num_td, CAST(rp AS INTEGER) AS rolling_points, gk.threshold_type, gk.threshold_value, COALESCE(n, 0) AS segment_count
  FROM lwin w CROSS JOIN (SELECT unnest(range(1, 11)) AS rp) CROSS JOIN gk
  LEFT JOIN g4 ON g4.name = w.name AND g4.stage_num_td = w.stage_num_td AND g4.rolling_points = rp AND g4.threshold_type = gk.threshold_type AND g4.threshold_value = gk.threshold_value)"""


def _grid(spark, d) -> DataFrame:
    return anomaly.threshold_grid(stored(tv.labels(spark, d), "labels"), tv.stage_index(spark, d, with_site=False, gap=LONG_GAP_SECONDS).select("name", "stage_num_td"), SLOT)


@bound("threshold_grid", sql("lab lwin", "SELECT * FROM grid", GRID_SQL))
def _(spark, d):
    return _grid(spark, d).select("name", "stage_num_td", "rolling_points", "threshold_type", "threshold_value", "segment_count")


TRIG_SQL = """
trig AS (SELECT s.name AS well_name, s.stage_num_td AS stage_num, p.segment_count AS pressure_surge_segments, q.segment_count AS pump_rate_drop_segments,
  s.mid_stage_shutdown_lines AS mid_stage_shutdown_segments, p.segment_count + q.segment_count AS triggered_segments FROM summ s
  JOIN grid p ON p.name = s.name AND p.stage_num_td = s.stage_num_td AND p.rolling_points = 1 AND p.threshold_type = 'pressure' AND p.threshold_value = 200
  JOIN grid q ON q.name = s.name AND q.stage_num_td = s.stage_num_td AND q.rolling_points = 1 AND q.threshold_type = 'rate' AND q.threshold_value = 5)"""
TRIGGER_SQL = (*ANOMALY_SQL, GRID_SQL, TRIG_SQL)


def _triggers(spark, d) -> DataFrame:
    s = _summary(spark, d)
    return anomaly.trigger_counts(tv.stage_index(spark, d, with_site=False, gap=LONG_GAP_SECONDS), _grid(spark, d), s, 200, 5, 1)


@bound("trigger_counts", sql("lab lwin", "SELECT * FROM trig", *TRIGGER_SQL))
def _(spark, d):
    return _triggers(spark, d)


@bound("trigger_counts_current", sql("lab lwin", "SELECT * FROM trig", *TRIGGER_SQL))
def _(spark, d):
    """Grids of an earlier source lie beside the current ones and must not count."""
    now = _grid(spark, d).withColumn("source_signature", F.lit("now"))
    stale = now.withColumn("segment_count", F.col("segment_count") + 3).withColumn("source_signature", F.lit("before"))
    index = tv.stage_index(spark, d, with_site=False, gap=LONG_GAP_SECONDS)
    manifest = index.select("name", "stage_num_td", F.lit("now").alias("source_signature"), F.lit("active").alias("status"))
    return anomaly.trigger_counts(index, now.unionByName(stale), _summary(spark, d).withColumn("source_signature", F.lit("now")), 200, 5, 1, manifest)


@bound("trigger_summary", sql("lab lwin", """
SELECT CAST(SUM(triggered_segments) AS BIGINT) AS total_triggered_segments, CAST(SUM(pressure_surge_segments) AS BIGINT) AS pressure_surge_segments,
       CAST(SUM(pump_rate_drop_segments) AS BIGINT) AS pump_rate_drop_segments, CAST(SUM(mid_stage_shutdown_segments) AS BIGINT) AS mid_stage_shutdown_segments,
       COUNT(*) FILTER (WHERE triggered_segments > 0) AS stages_with_trigger FROM trig""", *TRIGGER_SQL))
def _(spark, d):
    return anomaly.trigger_summary(_triggers(spark, d))


@bound("trigger_by_well", sql("lab lwin", """
SELECT well_name, CAST(SUM(triggered_segments) AS BIGINT) AS triggered_segments, CAST(SUM(pressure_surge_segments) AS BIGINT) AS pressure_surge_segments,
       CAST(SUM(pump_rate_drop_segments) AS BIGINT) AS pump_rate_drop_segments, CAST(SUM(mid_stage_shutdown_segments) AS BIGINT) AS mid_stage_shutdown_segments FROM trig GROUP BY 1""", *TRIGGER_SQL))
def _(spark, d):
    return anomaly.trigger_by_well(_triggers(spark, d))


@bound("trigger_histogram", sql("lab lwin", "SELECT triggered_segments, COUNT(*) AS stage_count FROM trig GROUP BY 1", *TRIGGER_SQL))
def _(spark, d):
    return anomaly.trigger_histogram(_triggers(spark, d))


@bound("first_last", sql("tel", f"""
SELECT name, time_bucket(INTERVAL {BUCKET_SECONDS} SECOND, record_ts, TIMESTAMP '1970-01-01') AS bucket_ts, arg_min(rate_slurry, record_ts) AS first_value, arg_max(rate_slurry, record_ts) AS last_value
FROM tel GROUP BY 1, 2"""))
def _(spark, d):
    rows = tv.readings(spark, d).withColumn("bucket_ts", slot_start("record_ts", BUCKET_SECONDS))
    return joins.first_last(rows, ["name", "bucket_ts"], "rate_slurry")


@bound("latest_per_key", sql("tel", """
SELECT name, event_type, record_ts, rate_slurry, id FROM (SELECT *, row_number() OVER (PARTITION BY name, event_type ORDER BY record_ts DESC) AS rn FROM tel) WHERE rn = 1"""))
def _(spark, d):
    rows = tv.readings(spark, d).select("name", "event_type", "record_ts", "rate_slurry", "id")
    return joins.latest_per_key(rows, ["name", "event_type"], ["record_ts"])


@bound("keep_last", sql("win", """
SELECT name, stage_num_td, sample_count FROM win
UNION ALL SELECT name, stage_num_td, sample_count FROM w1 WHERE NOT EXISTS (SELECT 1 FROM win WHERE win.name = w1.name AND win.stage_num_td = w1.stage_num_td)""", *FIRST))
def _(spark, d):
    rows = tv.readings(spark, d)
    old, new = stages.stage_windows(tv.first_batch(rows), GAP_SECONDS), stages.stage_windows(rows, GAP_SECONDS)
    return joins.keep_last(old, new, ["name", "stage_num_td"]).select("name", "stage_num_td", "sample_count")


MASK_SQL = """
m0 AS (SELECT name, stage_num_td, record_ts, rate_slurry < 30 AS mask FROM long),
m1 AS (SELECT *, SUM(CASE WHEN mask THEN 0 ELSE 1 END) OVER (PARTITION BY name, stage_num_td ORDER BY record_ts ROWS UNBOUNDED PRECEDING) AS g FROM m0),
m2 AS (SELECT name, stage_num_td, record_ts, mask, mask AND COUNT(*) FILTER (WHERE mask) OVER (PARTITION BY name, stage_num_td, g) >= 3 AS kept FROM m1)"""


def _masked(spark, d) -> DataFrame:
    return tv.staged(spark, d, LONG_GAP_SECONDS).select("name", "stage_num_td", "record_ts", (F.col("rate_slurry") < 30).alias("mask"))


@bound("min_run_filter", sql("long", "SELECT name, stage_num_td, record_ts, mask, kept FROM m2", MASK_SQL))
def _(spark, d):
    return islands.min_run_filter(_masked(spark, d), ["name", "stage_num_td"], "record_ts", "mask", 3, "kept", SLOT)


@bound("run_neighbours", sql("long", """
SELECT name, stage_num_td, record_ts, NOT mask AND COALESCE(bool_or(mask) OVER (o ROWS BETWEEN 1 FOLLOWING AND 3 FOLLOWING), false) AS is_before,
       NOT mask AND COALESCE(bool_or(mask) OVER (o ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING), false) AS is_after
FROM m0 WINDOW o AS (PARTITION BY name, stage_num_td ORDER BY record_ts)""", MASK_SQL))
def _(spark, d):
    return islands.run_neighbours(_masked(spark, d), ["name", "stage_num_td"], "record_ts", "mask", 3, SLOT).select("name", "stage_num_td", "record_ts", "is_before", "is_after")


@bound("overlap_violations", sql("ann", """
SELECT name, stage_num_td, stage_start_ts, latest_end_before FROM (SELECT name, CAST(annotation_id AS BIGINT) AS stage_num_td, start_time AS stage_start_ts,
  MAX(end_time) OVER (PARTITION BY name ORDER BY start_time, CAST(annotation_id AS BIGINT) ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS latest_end_before FROM ann)
WHERE stage_start_ts <= latest_end_before"""))
def _(spark, d):
    a = tv.annotations(spark, d).select("name", F.col("annotation_id").cast("bigint").alias("stage_num_td"), F.col("start_time").alias("stage_start_ts"), F.col("end_time").alias("stage_end_ts"))
    return stages.overlap_violations(a)


ORDINAL_SQL = """
epi AS (SELECT name, stage_num_td, MIN(datetime_fmt) FILTER (WHERE substage IN ('MID_TRIAL', 'MID')) AS design_at, MIN(datetime_fmt) FILTER (WHERE substage = 'MID') AS mid_at FROM smark GROUP BY 1, 2),
num AS (SELECT *, COUNT(design_at) OVER o AS design_no, COUNT(mid_at) OVER o AS mid_no, LEAD(stage_num_td) OVER (PARTITION BY name ORDER BY stage_num_td) IS NOT NULL AS closed
  FROM epi WINDOW o AS (PARTITION BY name ORDER BY stage_num_td ROWS UNBOUNDED PRECEDING)),
ord AS (SELECT m.name, m.datetime_fmt, m.stage_num_td, CASE WHEN datetime_fmt >= design_at THEN design_no ELSE 0 END AS ordinal_provisional,
  CASE WHEN datetime_fmt >= mid_at THEN mid_no ELSE 0 END AS ordinal_confirmed, CASE WHEN closed AND mid_at IS NOT NULL THEN mid_no ELSE 0 END AS ordinal_continuous
  FROM smark m JOIN num n ON n.name = m.name AND n.stage_num_td = m.stage_num_td)"""
SMARK = marker_view("stg", "smark")


@bound("marker_ordinals", sql("stg", "SELECT name, stage_num_td, datetime_fmt, ordinal_provisional, ordinal_confirmed, ordinal_continuous FROM ord", SMARK, ORDINAL_SQL))
def _(spark, d):
    return ordinals.marker_ordinals(tv.marker_labels(spark, d, GAP_SECONDS)).select("name", "stage_num_td", "datetime_fmt", "ordinal_provisional", "ordinal_confirmed", "ordinal_continuous")


def _ordinal_windows_sql(layer: str) -> str:
    col = ordinals.LAYERS[layer]
    closed = "true" if layer == "continuous" else "o.ordinal < o.highest"
    return f"""
SELECT o.name, o.ordinal, o.stage_start_ts, o.stage_end_ts, o.sample_count, {closed} AS is_closed, '{layer}' AS stage_layer,
       {r('AVG(t.rate_slurry)')} AS avg_rate_slurry, MAX(t.rate_slurry) AS max_rate_slurry, {r('AVG(t.press_mainline)')} AS avg_press_mainline, MAX(t.press_mainline) AS max_press_mainline
FROM (SELECT *, MAX(ordinal) OVER (PARTITION BY name) AS highest FROM (SELECT name, {col} AS ordinal, MIN(datetime_fmt) AS stage_start_ts, MAX(datetime_fmt) AS stage_end_ts, COUNT(*) AS sample_count
      FROM ord WHERE {col} > 0 GROUP BY 1, 2)) o
LEFT JOIN tel t ON t.name = o.name AND t.record_ts BETWEEN o.stage_start_ts AND o.stage_end_ts GROUP BY ALL"""


ORDINAL_WINDOW = ["name", "ordinal", "stage_start_ts", "stage_end_ts", "sample_count", "is_closed", "stage_layer", "avg_rate_slurry", "max_rate_slurry", "avg_press_mainline", "max_press_mainline"]


@bound("ordinal_windows", sql("stg", _ordinal_windows_sql("confirmed"), SMARK, ORDINAL_SQL))
def _(spark, d):
    rows = ordinals.marker_ordinals(tv.marker_labels(spark, d, GAP_SECONDS))
    return show(ordinals.ordinal_windows(rows, tv.readings(spark, d), "confirmed"), *ORDINAL_WINDOW, rounded=("avg_rate_slurry", "avg_press_mainline"))


RESTART_SQL = """
en AS (SELECT name, stage_num_td, MIN(datetime_fmt) AS stage_end_at FROM lab WHERE substage = 'stage_end' GROUP BY 1, 2),
tl AS (SELECT m.*, e.stage_end_at FROM mark m JOIN en e ON e.name = m.name AND e.stage_num_td = m.stage_num_td AND m.datetime_fmt > e.stage_end_at)"""


@bound("restart_position", sql("lab mark", """
SELECT name, stage_num_td, stage_end_at, MIN(datetime_fmt) AS restart_at FROM tl p WHERE substage = 'PRE'
  AND EXISTS (SELECT 1 FROM tl x WHERE x.name = p.name AND x.stage_num_td = p.stage_num_td AND x.substage IN ('LOW', 'PRE_LOW') AND x.datetime_fmt < p.datetime_fmt)
  AND EXISTS (SELECT 1 FROM tl x WHERE x.name = p.name AND x.stage_num_td = p.stage_num_td AND x.substage = 'MID_TRIAL' AND x.datetime_fmt > p.datetime_fmt)
GROUP BY 1, 2, 3""", RESTART_SQL))
def _(spark, d):
    return labelling.restart_positions(tv.labels(spark, d), tv.marker_labels(spark, d))


@bound("machine_restarts", sql("lab mark", """
SELECT name, stage_num_td, stage_end_at, MIN(datetime_fmt) AS restart_at FROM tl p WHERE substage = 'PRE'
  AND EXISTS (SELECT 1 FROM tl x WHERE x.name = p.name AND x.stage_num_td = p.stage_num_td AND x.substage IN ('LOW', 'PRE_LOW') AND x.datetime_fmt < p.datetime_fmt)
  AND EXISTS (SELECT 1 FROM tl x WHERE x.name = p.name AND x.stage_num_td = p.stage_num_td AND x.substage = 'MID_TRIAL' AND x.datetime_fmt > p.datetime_fmt)
GROUP BY 1, 2, 3""", RESTART_SQL))
def _(spark, d):
    """The restart search as a state machine, its slots on many tasks."""
    keys = ["name", "stage_num_td", "datetime_fmt"]
    markers = tv.marker_labels(spark, d).select(*keys, F.col("substage").alias("marker"))
    return machines.restarts(tv.labels(spark, d).select(*keys, "substage").join(markers, keys), slot_seconds=SLOT)


@bound("machine_runs", sql("long", "SELECT name, stage_num_td, record_ts, mask, kept FROM m2", MASK_SQL))
def _(spark, d):
    """Runs of three rows at least, by a machine that counts from both sides."""
    return machines.long_runs(_masked(spark, d).select("name", "stage_num_td", "record_ts", "mask"), ["name", "stage_num_td"], "record_ts", "mask", 3, "kept", SLOT)


PARTS_SQL = """
med AS (SELECT name, stage_num_td, CASE WHEN median(rate_slurry) > 0 THEN median(rate_slurry) END AS design_rate_d FROM mark WHERE substage IN ('MID_TRIAL', 'MID') GROUP BY 1, 2),
lng AS (SELECT name, stage_num_td, MAX(sample_count) AS longest FROM (""" + _islands_sql("(SELECT name, stage_num_td, datetime_fmt, substage IN ('design', 'slurry') AS d FROM lab)", "name, stage_num_td", "datetime_fmt", "d") + """) WHERE d GROUP BY 1, 2),
agg AS (SELECT l.name, l.stage_num_td, COUNT(*) FILTER (WHERE substage = 'slurry') AS n, COUNT(*) FILTER (WHERE substage = 'slurry' AND rate_slurry < design_rate_d * 0.9) AS dips,
  stddev_samp(rate_slurry) FILTER (WHERE substage = 'slurry') / NULLIF(AVG(rate_slurry) FILTER (WHERE substage = 'slurry'), 0) AS cv_rate,
  stddev_samp(press_mainline) FILTER (WHERE substage = 'slurry') / NULLIF(AVG(press_mainline) FILTER (WHERE substage = 'slurry'), 0) AS cv_press, MAX(design_rate_d) AS design_rate_d,
  MAX((substage = 'stage_start')::INT) + MAX((substage = 'ramp_up')::INT) + MAX((substage = 'slurry')::INT) + MAX((substage = 'ramp_down')::INT) + MAX((substage = 'stage_end')::INT) AS present
  FROM lab l LEFT JOIN med m ON m.name = l.name AND m.stage_num_td = l.stage_num_td GROUP BY 1, 2),
part0 AS (SELECT a.*, n * sampling_step AS design_seconds, COALESCE(longest, 0) AS longest, COALESCE(k, 0) AS anomaly_count FROM agg a
  JOIN step s ON s.name = a.name AND s.stage_num_td = a.stage_num_td LEFT JOIN lng g ON g.name = a.name AND g.stage_num_td = a.stage_num_td
  LEFT JOIN (SELECT name, stage_num_td, COUNT(*) AS k FROM ev GROUP BY 1, 2) e ON e.name = a.name AND e.stage_num_td = a.stage_num_td),
parts AS (SELECT name, stage_num_td, anomaly_count, CAST(present AS BIGINT) AS substages_present, design_seconds, design_seconds / 60 AS design_minutes, (cv_rate + cv_press) / 2 AS raw_a,
  anomaly_count / NULLIF(design_seconds / 60, 0) AS raw_b, present / 5 AS raw_c, cv_rate, cv_press, longest / NULLIF(n, 0) AS longest_run_frac,
  CASE WHEN design_rate_d IS NOT NULL THEN dips / NULLIF(n, 0) END AS dip_rate_d, design_rate_d FROM part0)"""
PART_VALUES = ["design_seconds", "design_minutes", "raw_a", "raw_b", "raw_c", "cv_rate", "cv_press", "longest_run_frac", "dip_rate_d", "design_rate_d"]
PARTS_VIEWS = (DESIGN_SQL, ANOM_SQL, EVENT_SQL, STEP_SQL, PARTS_SQL)


def _parts(spark, d) -> DataFrame:
    labels = stored(tv.labels(spark, d), "labels")
    markers = stored(tv.marker_labels(spark, d), "markers")
    flagged = anomaly.row_anomalies(labels, LIMITS, SLOT).where(F.col("anomaly").isNotNull())
    events = islands.event_segments(flagged, LIMITS.max_gap_seconds, run_id="run", slot_seconds=SLOT)
    return scores.quality_parts(labels, labelling.design_medians(markers), events, SLOT)


@bound("quality_parts", sql("lab mark", "SELECT name, stage_num_td, anomaly_count, substages_present, " + ", ".join(f"{r(c, 5)} AS {c}" for c in PART_VALUES) + " FROM parts", *PARTS_VIEWS))
def _(spark, d):
    return _parts(spark, d).select("name", "stage_num_td", "anomaly_count", "substages_present", *[shown(c, 5) for c in PART_VALUES])


def _rank_sql(c: str, up: bool) -> str:
    return f"(SELECT name, stage_num_td, 100.0 * percent_rank() OVER (ORDER BY ROUND({c}, 9) {'ASC' if up else 'DESC'}) AS s FROM parts WHERE {c} IS NOT NULL)"


_ON = "ON {0}.name = p.name AND {0}.stage_num_td = p.stage_num_td"
SCORES_SQL = f"""
sc0 AS (SELECT p.*, COALESCE(a.s, 0.0) AS score_a, COALESCE(b.s, 0.0) AS score_b, COALESCE(c.s, 0.0) AS score_c, (COALESCE(e.s, 0.0) + COALESCE(f.s, 0.0)) / 2 AS score_d FROM parts p
  LEFT JOIN {_rank_sql('raw_a', False)} a {_ON.format('a')} LEFT JOIN {_rank_sql('raw_b', False)} b {_ON.format('b')} LEFT JOIN {_rank_sql('raw_c', True)} c {_ON.format('c')}
  LEFT JOIN {_rank_sql('design_rate_d', True)} e {_ON.format('e')} LEFT JOIN {_rank_sql('dip_rate_d', False)} f {_ON.format('f')}),
sc1 AS (SELECT *, CAST(score_a * 0.20::DOUBLE + score_b * 0.36::DOUBLE + score_c * 0.16::DOUBLE + score_d * 0.28::DOUBLE AS DOUBLE) AS composite_score,
  0.20::DOUBLE * (100.0 - score_a) AS la, 0.36::DOUBLE * (100.0 - score_b) AS lb, 0.16::DOUBLE * (100.0 - score_c) AS lc, 0.28::DOUBLE * (100.0 - score_d) AS ld FROM sc0),
sc AS (SELECT s.*, CASE GREATEST(la, lb, lc, ld) WHEN la THEN 'process_stability' WHEN lb THEN 'anomaly_burden' WHEN lc THEN 'substage_coherence' ELSE 'achievable_telemetry' END AS top_driver,
  COALESCE(NULLIF(w.fleet_name, ''), 'Unknown') AS fleet_name, COALESCE(NULLIF(w.pad_name, ''), 'Unknown') AS pad_name FROM sc1 s LEFT JOIN wells w ON w.name = s.name)"""
SCORE_VIEWS = (*PARTS_VIEWS, SCORES_SQL)
SCORE_VALUES = ["composite_score", "score_a", "score_b", "score_c", "score_d"]


def _scored(spark, d) -> DataFrame:
    scored = stored(scores.population_scores(stored(_parts(spark, d), "parts")), "scores")
    return scores.scored_sites(scored, rollup.well_index(tv.telemetry(spark, d)))


@bound("population_scores", sql("lab mark wells", "SELECT name, stage_num_td, top_driver, " + ", ".join(f"{r(c)} AS {c}" for c in SCORE_VALUES) + " FROM sc", *SCORE_VIEWS))
def _(spark, d):
    return scores.population_scores(stored(_parts(spark, d), "parts")).select("name", "stage_num_td", "top_driver", *[shown(c) for c in SCORE_VALUES])


@bound("population_update", f"""
WITH now AS (SELECT o_orderkey, o_totalprice AS price, CAST(o_custkey AS DOUBLE) AS load, CASE WHEN o_orderkey % 3 = 0 THEN o_totalprice END AS part FROM orders),
ranked AS (SELECT o_orderkey, 100.0 * percent_rank() OVER (ORDER BY price) AS rank_price, 100.0 * percent_rank() OVER (ORDER BY load DESC) AS rank_load FROM now),
partial AS (SELECT o_orderkey, 100.0 * percent_rank() OVER (ORDER BY part DESC) AS rank_part FROM now WHERE part IS NOT NULL)
SELECT r.o_orderkey, {r('rank_price')} AS rank_price, {r('rank_load')} AS rank_load, {r('COALESCE(rank_part, 0)')} AS rank_part FROM ranked r LEFT JOIN partial s ON s.o_orderkey = r.o_orderkey
WHERE r.o_orderkey % 4 = 0 OR r.o_orderkey % 7 = 0""")
def _(spark, d):
    """A population of orders, of which a quarter comes later and a seventh changes its price: ranks of those, from the counts that they move."""
    key, price = F.col("o_orderkey"), F.col("o_totalprice").cast("double")
    now = tv.table(spark, d, "orders").select("o_orderkey", price.alias("price"), F.col("o_custkey").cast("double").alias("load"), F.when(key % 3 == 0, price).alias("part"))
    old = now.where(key % 4 != 0).withColumn("price", F.when(key % 7 == 0, F.col("price") * 2 + 1).otherwise(F.col("price")))
    parts = {"price": True, "load": False, "part": False}
    cuts = orderstats.range_cuts(old, list(parts))
    counts = stored(orderstats.value_counts(old, list(parts), cuts), "counts")
    totals = stored(orderstats.range_totals(counts), "totals")
    batch = now.where((key % 4 == 0) | (key % 7 == 0))
    moved = stored(orderstats.moved_counts(counts, old.where(key % 7 == 0), batch, list(parts), cuts), "moved")
    totals = orderstats.moved_totals(totals, counts, moved)
    ranks = orderstats.member_ranks(batch, ["o_orderkey"], parts, orderstats.with_moved(counts, moved), totals, cuts)
    return show(ranks, "o_orderkey", *[f"rank_{p}" for p in parts], rounded=tuple(f"rank_{p}" for p in parts))


_BAND = "CASE WHEN AVG(composite_score) >= 70 THEN '#2A9D6F' WHEN AVG(composite_score) >= 45 THEN '#E6A23C' ELSE '#D9534F' END"


@bound("score_by_family", sql("lab mark wells", f"""
SELECT fleet_name, pad_name, fleet_name || ' / ' || pad_name AS family_name, {r('AVG(composite_score)', 1)} AS average_score, COUNT(*) AS stage_count, COUNT(DISTINCT name) AS well_count, {_BAND} AS color
FROM sc GROUP BY 1, 2""", *SCORE_VIEWS))
def _(spark, d):
    return scores.score_by_family(_scored(spark, d))


@bound("score_by_well", sql("lab mark wells", f"""
SELECT name AS well_name, {r('AVG(composite_score)', 1)} AS average_score, COUNT(*) AS stage_count, {r('MIN(composite_score)')} AS lowest_score, {_BAND} AS color FROM sc GROUP BY 1""", *SCORE_VIEWS))
def _(spark, d):
    return show(scores.score_by_well(_scored(spark, d)), "well_name", "average_score", "stage_count", "lowest_score", "color", rounded=("lowest_score",))


@bound("score_global", sql("lab mark wells", f"""
SELECT {r('AVG(composite_score)', 1)} AS average_score, COUNT(*) AS stages_scored, {r('MIN(composite_score)')} AS lowest_score,
       (SELECT name FROM sc ORDER BY composite_score, name, stage_num_td LIMIT 1) AS lowest_well, (SELECT stage_num_td FROM sc ORDER BY composite_score, name, stage_num_td LIMIT 1) AS lowest_stage FROM sc""", *SCORE_VIEWS))
def _(spark, d):
    return show(scores.score_global(_scored(spark, d)), "average_score", "stages_scored", "lowest_score", "lowest_well", "lowest_stage", rounded=("lowest_score",))


@bound("score_breakdown", sql("lab mark wells", "\nUNION ALL ".join(
    f"SELECT name, stage_num_td, '{t}' AS component, {r(c)} AS score, {w}::DOUBLE AS weight, {r(f'{c} * {w}::DOUBLE')} AS weighted_contribution, '{k}' AS color FROM sc"
    for t, c, w, k in (("A - Process Stability", "score_a", 0.20, "#2878B5"), ("B - Event Burden", "score_b", 0.36, "#D35400"), ("C - Substage Coherence", "score_c", 0.16, "#2A9D6F"), ("D - Achievable Telemetry", "score_d", 0.28, "#7A5AF8"))), *SCORE_VIEWS))
def _(spark, d):
    return show(scores.score_breakdown(_scored(spark, d)), "name", "stage_num_td", "component", "score", "weight", "weighted_contribution", "color", rounded=("score", "weighted_contribution"))


# --- L, U: order, limits, set operations -----------------------------------


@bound("ordered_events", sql("lab", """
SELECT name AS well_name, stage_num_td AS stage_num, anomaly, start_ts, end_ts FROM ev ORDER BY start_ts DESC, name, stage_num_td""", DESIGN_SQL, ANOM_SQL, EVENT_SQL))
def _(spark, d):
    return reports.event_list(_events(spark, d)).select("well_name", "stage_num", "anomaly", "start_ts", "end_ts").orderBy(F.desc("start_ts"), "well_name", "stage_num")


@bound("stage_bounds", sql("win", "SELECT name AS well_name, stage_num_td AS stage_num, stage_start_ts AS start_time, stage_end_ts AS end_time FROM win"))
def _(spark, d):
    return reports.stage_time_bounds(tv.stage_index(spark, d, with_site=False))


@bound("work_batch", sql("win", "SELECT name, stage_num_td, (SELECT COUNT(*) FROM win) > 25 AS has_more FROM (SELECT name, stage_num_td FROM win ORDER BY name, stage_num_td LIMIT 25)"))
def _(spark, d):
    return reads.work_batch(tv.stage_index(spark, d, with_site=False), ["name", "stage_num_td"], 25)


RANGE = ("2024-01-05", "2024-01-25")


@bound("annotation_union", sql("lab ann lay", f"""
SELECT a.annotation_id, a.layer_id, a.name AS well_name, CAST(NULL AS DOUBLE) AS stage_num, 'stage_start' AS substage_name, start_time, end_time, start_time AS "timestamp", 'window' AS annotation_type,
       'user' AS source_type, COALESCE(is_editable AND owner_email = 'user3', false) AS can_edit, status, CAST(NULL AS VARCHAR) AS color
FROM ann a LEFT JOIN lay l ON l.layer_id = a.layer_id WHERE status = 'active' AND start_time <= TIMESTAMP '{RANGE[1]}' AND end_time >= TIMESTAMP '{RANGE[0]}'
UNION ALL SELECT {ISLE_ID}, 'system:model:platinum_substage_labels', name, CAST(stage_num_td AS DOUBLE), substage, start_ts, end_ts, start_ts, 'window', 'model', false, 'active', {ISLE_COLOR}
FROM isle2 WHERE start_ts < end_ts""", "\nisle2 AS (" + _islands_sql(f"(SELECT * FROM lab WHERE substage <> 'NA' AND datetime_fmt BETWEEN TIMESTAMP '{RANGE[0]}' AND TIMESTAMP '{RANGE[1]}')", "name, stage_num_td", "datetime_fmt", "substage") + ")"))
def _(spark, d):
    out = reports.annotation_table(tv.annotations(spark, d), tv.layers(spark, d), tv.labels(spark, d), "user3", *RANGE, slot_seconds=SLOT)
    return out.select("annotation_id", "layer_id", "well_name", "stage_num", "substage_name", "start_time", "end_time", "timestamp", "annotation_type", "source_type", "can_edit", "status", "color")


@bound("distinct_union", sql("win hidx", """
SELECT name, stage_end_ts + INTERVAL 1 MILLISECOND AS break_ts FROM win UNION SELECT name, stage_end_ts + INTERVAL 1 MILLISECOND FROM hidx"""))
def _(spark, d):
    gaps = tv.stage_index(spark, d, with_site=False)
    return reports.break_times(gaps, rollup.history_stage_index(tv.history(spark, d))).select("name", "break_ts")


@bound("distinct_options", sql("wells", """
SELECT 'fleet' AS level, COALESCE(NULLIF(fleet_name, ''), 'Unknown') AS value FROM wells GROUP BY 2
UNION ALL SELECT 'pad', pad_name FROM wells GROUP BY pad_name, COALESCE(NULLIF(fleet_name, ''), 'Unknown')
UNION ALL SELECT 'family', well_family FROM wells GROUP BY 2
UNION ALL SELECT 'well', name FROM wells UNION ALL SELECT 'well', '__ALL__'"""))
def _(spark, d):
    wells = rollup.well_index(tv.telemetry(spark, d))
    lists = {"fleet": reports.fleet_options(wells), "pad": reports.pad_options(wells), "family": reports.family_options(wells), "well": reports.well_options_with_all(wells)}
    frames = [df.select(F.lit(level).alias("level"), "value") for level, df in lists.items()]
    return frames[0].unionByName(frames[1]).unionByName(frames[2]).unionByName(frames[3])


@bound("labelled_stage_options", sql("plab", """
SELECT DISTINCT name, '-1' AS value, 'Select stage' AS label, 0 AS sort_order FROM plab WHERE substage <> 'NA'
UNION ALL SELECT DISTINCT name, CAST(stage_num_td AS VARCHAR), CAST(stage_num_td AS VARCHAR), 1 FROM plab WHERE substage <> 'NA'"""))
def _(spark, d):
    return reports.labelled_stage_options(_presence_labels(spark, d))


@bound("relaxed_union", sql("tel", """
SELECT name, record_ts, rate_slurry, CAST(NULL AS DOUBLE) AS press_mainline FROM tel WHERE event_type = 'view'
UNION ALL SELECT name, record_ts, NULL, press_mainline FROM tel WHERE event_type <> 'view'"""))
def _(spark, d):
    t = tv.readings(spark, d)
    view = F.col("event_type") == "view"
    return t.where(view).select("name", "record_ts", "rate_slurry").unionByName(t.where(~view).select("name", "record_ts", "press_mainline"), allowMissingColumns=True)


# --- reports ---------------------------------------------------------------


@bound("label_chart", sql("lab mark lwin", f"""
SELECT t.name AS well_name, CAST(w.stage_num_td AS DOUBLE) AS stage_num, t.record_ts AS ts, CASE WHEN l.substage = 'NA' THEN NULL ELSE l.substage END AS substage_label, t.rate_slurry, t.press_mainline,
       t.prop_conc_target AS selected_concentration, {r('m.pressure')} AS inferred_pressure, {r('m.rate')} AS design_rate, {r('m.rate * 0.95')} AS design_rate_high, CAST(NULL AS DOUBLE) AS context_anchor
FROM lwin w JOIN tel t ON t.name = w.name AND t.record_ts BETWEEN w.stage_start_ts - INTERVAL 30 MINUTE AND w.stage_end_ts + INTERVAL 30 MINUTE
LEFT JOIN (SELECT l.*, x.rate, x.pressure FROM lab l LEFT JOIN (SELECT name, stage_num_td, median(rate_slurry) AS rate, median(press_mainline) AS pressure FROM mark WHERE substage IN ('MID_TRIAL', 'MID') GROUP BY 1, 2) x
  ON x.name = l.name AND x.stage_num_td = l.stage_num_td) m ON m.name = t.name AND m.stage_num_td = w.stage_num_td AND m.datetime_fmt = t.record_ts
LEFT JOIN lab l ON l.name = t.name AND l.stage_num_td = w.stage_num_td AND l.datetime_fmt = t.record_ts
UNION ALL SELECT name, NULL, stage_start_ts - INTERVAL 30 MINUTE, NULL, NULL, NULL, NULL, NULL, NULL, NULL, 0.0 FROM lwin
UNION ALL SELECT name, NULL, stage_end_ts + INTERVAL 30 MINUTE, NULL, NULL, NULL, NULL, NULL, NULL, NULL, 0.0 FROM lwin"""))
def _(spark, d):
    labels = tv.labels(spark, d).join(labelling.design_medians(tv.marker_labels(spark, d)), ["name", "stage_num_td"], "left")
    out = reports.label_chart(tv.readings(spark, d), labels, tv.stage_index(spark, d, with_site=False, gap=LONG_GAP_SECONDS), 30, "target")
    return show(out, "well_name", "stage_num", "ts", "substage_label", "rate_slurry", "press_mainline", "selected_concentration", "inferred_pressure", "design_rate", "design_rate_high", "context_anchor",
                rounded=("inferred_pressure", "design_rate", "design_rate_high"))


ORDINAL_CHART = """(SELECT name, ordinal_confirmed AS ordinal, MIN(datetime_fmt) AS s, MAX(datetime_fmt) AS e FROM ord WHERE ordinal_confirmed > 0 GROUP BY 1, 2)"""


def _ordinal_chart(spark, d, labels: DataFrame, with_design: bool) -> DataFrame:
    marks = ordinals.marker_ordinals(tv.marker_labels(spark, d, GAP_SECONDS)).where(F.col("ordinal_confirmed") > 0)
    windows_ = marks.groupBy("name", F.col("ordinal_confirmed").alias("stage_num_td")).agg(F.min("datetime_fmt").alias("stage_start_ts"), F.max("datetime_fmt").alias("stage_end_ts"))
    return reports.label_chart(tv.readings(spark, d), labels, windows_, 30, "target", with_design=with_design, with_stage=False)


@bound("ordinal_label_chart", sql("stg lab mark", f"""
SELECT t.name AS well_name, CAST(w.ordinal AS DOUBLE) AS stage_num, t.record_ts AS ts, CASE WHEN l.substage = 'NA' THEN NULL ELSE l.substage END AS substage_label, t.rate_slurry,
       t.prop_conc_target AS selected_concentration, {r('x.rate')} AS design_rate, CAST(NULL AS DOUBLE) AS context_anchor
FROM {ORDINAL_CHART} w JOIN tel t ON t.name = w.name AND t.record_ts BETWEEN w.s - INTERVAL 30 MINUTE AND w.e + INTERVAL 30 MINUTE LEFT JOIN lab l ON l.name = t.name AND l.datetime_fmt = t.record_ts
LEFT JOIN (SELECT name, stage_num_td, median(rate_slurry) AS rate FROM mark WHERE substage IN ('MID_TRIAL', 'MID') GROUP BY 1, 2) x ON x.name = l.name AND x.stage_num_td = l.stage_num_td
UNION ALL SELECT name, NULL, s - INTERVAL 30 MINUTE, NULL, NULL, NULL, NULL, 0.0 FROM {ORDINAL_CHART}
UNION ALL SELECT name, NULL, e + INTERVAL 30 MINUTE, NULL, NULL, NULL, NULL, 0.0 FROM {ORDINAL_CHART}""", SMARK, ORDINAL_SQL))
def _(spark, d):
    labels = tv.labels(spark, d).join(labelling.design_medians(tv.marker_labels(spark, d)), ["name", "stage_num_td"], "left")
    return show(_ordinal_chart(spark, d, labels, True), "well_name", "stage_num", "ts", "substage_label", "rate_slurry", "selected_concentration", "design_rate", "context_anchor", rounded=("design_rate",))


@bound("ordinal_phase_chart", sql("stg lab", f"""
SELECT t.name AS well_name, CAST(w.ordinal AS DOUBLE) AS stage_num, t.record_ts AS ts, NULLIF(l.substage, 'NA') AS substage_label, t.press_mainline, CAST(NULL AS DOUBLE) AS context_anchor
FROM {ORDINAL_CHART} w JOIN tel t ON t.name = w.name AND t.record_ts BETWEEN w.s - INTERVAL 30 MINUTE AND w.e + INTERVAL 30 MINUTE LEFT JOIN lab l ON l.name = t.name AND l.datetime_fmt = t.record_ts
UNION ALL SELECT name, NULL, s - INTERVAL 30 MINUTE, NULL, NULL, 0.0 FROM {ORDINAL_CHART} UNION ALL SELECT name, NULL, e + INTERVAL 30 MINUTE, NULL, NULL, 0.0 FROM {ORDINAL_CHART}""", SMARK, ORDINAL_SQL))
def _(spark, d):
    return _ordinal_chart(spark, d, tv.labels(spark, d), False).select("well_name", "stage_num", "ts", "substage_label", "press_mainline", "context_anchor")


@bound("label_windows", sql("lab", """
SELECT name, stage_num_td, substage AS substage_label, start_ts, end_ts, sample_count, CASE substage WHEN 'stage_start' THEN '#5B5FC7' WHEN 'ramp_up' THEN '#D64B8B' WHEN 'slurry' THEN '#3BA66B'
  WHEN 'ramp_down' THEN '#D9902F' WHEN 'shut_off' THEN '#9A4C8D' WHEN 'stage_end' THEN '#4AA8B5' ELSE '#7A8496' END AS color FROM isle""", ISLE_SQL))
def _(spark, d):
    return reports.label_windows(tv.labels(spark, d), slot_seconds=SLOT)


@bound("stage_drilldown", sql("stg", f"""
SELECT name || ':' || {text('record_ts')} AS telemetry_point_id, name AS well_name, record_ts AS "timestamp", stage_num_td AS stage_num, press_mainline, rate_slurry, prop_conc_blend_denso AS selected_concentration FROM stg"""))
def _(spark, d):
    return reports.stage_drilldown(tv.readings(spark, d), tv.stage_index(spark, d, with_site=False))


@bound("segmentation_chart", sql("win hidx", f"""
SELECT t.name || ':' || {text('t.record_ts')} AS telemetry_point_id, t.name AS well_name, t.record_ts AS "timestamp", t.rate_slurry, t.press_mainline, t.prop_conc_blend_auger AS selected_concentration,
       CAST(NULL AS DOUBLE) AS context_anchor, CAST(1 AS BIGINT) AS records_in_bucket FROM tel t WHERE EXISTS (SELECT 1 FROM rng b WHERE b.name = t.name AND t.record_ts >= b.f AND t.record_ts < b.t)
UNION ALL SELECT x.name || ':line_break:' || {text('x.ts + INTERVAL 1 MILLISECOND')}, x.name, x.ts + INTERVAL 1 MILLISECOND, NULL, NULL, NULL, NULL, 0
FROM (SELECT name, stage_end_ts AS ts FROM win UNION SELECT name, stage_end_ts FROM hidx) x WHERE EXISTS (SELECT 1 FROM rng b WHERE b.name = x.name AND x.ts >= b.f AND x.ts < b.t)
UNION ALL SELECT name || ':context_start:' || {text('f')}, name, f, NULL, NULL, NULL, 0.0, 0 FROM bnd UNION ALL SELECT name || ':context_end:' || {text('t')}, name, t, NULL, NULL, NULL, 0.0, 0 FROM bnd""", BOUNDS_SQL))
def _(spark, d):
    w = tv.stage_index(spark, d, with_site=False)
    given = rollup.history_stage_index(tv.history(spark, d))
    return reports.segmentation_chart(tv.readings(spark, d), None, w, given, _bounds(w), 720, "auger")


@bound("history_chart", sql("hist win", f"""
SELECT h.name || ':' || CAST(stage_num AS VARCHAR) || ':' || {text('datetime_fmt')} AS telemetry_point_id, h.name AS well_name, datetime_fmt AS "timestamp", stage_num, rate_slurry, press_mainline,
       prop_conc_blend_denso, records_in_bucket FROM hist h WHERE EXISTS (SELECT 1 FROM rng b WHERE b.name = h.name AND datetime_fmt BETWEEN b.f AND b.t)""", BOUNDS_SQL))
def _(spark, d):
    return reports.history_chart(tv.history(spark, d), _bounds(tv.stage_index(spark, d, with_site=False)), 720)


@bound("stage_range_windows", sql("win hidx", f"""
SELECT name, CAST(stage_num_td AS VARCHAR) AS window_label, stage_start_ts AS start_ts, stage_end_ts AS end_ts, '#D9902F' AS color, sample_count FROM win WHERE stage_end_ts >= TIMESTAMP '{RANGE[0]}' AND stage_start_ts <= TIMESTAMP '{RANGE[1]}'
UNION ALL SELECT name, 'Stage ' || CAST(stage_num AS VARCHAR), stage_start_ts, stage_end_ts, '#228B22', sample_count FROM hidx WHERE stage_end_ts >= TIMESTAMP '{RANGE[0]}' AND stage_start_ts <= TIMESTAMP '{RANGE[1]}'"""))
def _(spark, d):
    gaps = reports.stage_windows_in_range(tv.stage_index(spark, d, with_site=False), *RANGE)
    return gaps.unionByName(reports.stage_windows_in_range(rollup.history_stage_index(tv.history(spark, d)), *RANGE, given=True))


@bound("layer_options", sql("lay", """
SELECT layer_id AS id, layer_id AS name, 'User layer · ' || owner_email AS description, is_editable AND owner_email = 'user3' AS can_edit, display_order FROM lay
UNION ALL SELECT 'system:model:platinum_substage_labels', 'Automatic Substage Labels', 'System generated · Read-only', false, -100
UNION ALL SELECT 'manual:shared', 'Manual', 'Shared manual layer · Editable by everyone', true, 0
UNION ALL SELECT 'manual:user:' || md5('user3'), 'Manual - user3', 'Personal manual layer · Editable only by you', true, 10"""))
def _(spark, d):
    return reports.layer_options(tv.layers(spark, d), tv.labels(spark, d), "user3").select("id", "name", "description", "can_edit", "display_order")


@bound("layer_edit_check", sql("lay", "SELECT layer_id, CASE WHEN is_editable AND owner_email = 'user2' THEN 1 ELSE 0 END AS can_edit FROM lay"))
def _(spark, d):
    return reports.layer_edit_check(tv.layers(spark, d), "user2")


@bound("event_colors", sql("lab", """
SELECT name, anomaly, start_ts, CASE anomaly WHEN 'pressure_surge' THEN 'rgba(211,84,0,0.20)' WHEN 'pump_rate_drop' THEN 'rgba(40,120,181,0.20)' WHEN 'mid_stage_shutdown' THEN 'rgba(48,52,59,0.20)'
  ELSE 'rgba(42,157,111,0.20)' END AS color FROM ev""", DESIGN_SQL, ANOM_SQL, EVENT_SQL))
def _(spark, d):
    return _events(spark, d).select("name", "anomaly", "start_ts", lookup("anomaly", EVENT_COLORS, EVENT_OTHER).alias("color"))


@bound("score_ranking", sql("lab mark wells", f"""
SELECT name AS well_name, CAST(stage_num_td AS VARCHAR) AS stage_num, {r('composite_score')} AS composite_score, CASE top_driver WHEN 'process_stability' THEN 'Process Stability' WHEN 'anomaly_burden' THEN 'Event Burden'
  WHEN 'substage_coherence' THEN 'Substage Coherence' ELSE 'Achievable Telemetry' END AS top_driver, anomaly_count, substages_present FROM sc""", *SCORE_VIEWS))
def _(spark, d):
    return show(reports.score_ranking(_scored(spark, d)), "well_name", "stage_num", "composite_score", "top_driver", "anomaly_count", "substages_present", rounded=("composite_score",))


@bound("well_time_bounds", sql("wells", "SELECT name AS well_name, first_record_ts AS start_time, last_record_ts AS end_time FROM wells"))
def _(spark, d):
    return reports.well_time_bounds(rollup.well_index(tv.telemetry(spark, d)))


@bound("pad_time_bounds", sql("wells", """
SELECT COALESCE(NULLIF(fleet_name, ''), 'Unknown') AS fleet_name, pad_name, MIN(first_record_ts) AS start_time, MAX(last_record_ts) AS end_time FROM wells GROUP BY 1, 2"""))
def _(spark, d):
    return reports.pad_time_bounds(rollup.well_index(tv.telemetry(spark, d)))


@bound("well_relative_bounds", sql("wells", "SELECT name, GREATEST(first_ts, last_ts - INTERVAL 12 HOUR) AS start_time, last_ts AS end_time FROM wells"))
def _(spark, d):
    return reports.well_relative_bounds(rollup.well_index(tv.telemetry(spark, d)), "previous_12h")


@bound("well_options", sql("wells", """
SELECT name AS label, name AS value, well_family, fleet_name, pad_name, well_id, api_num, first_record_ts, last_record_ts, first_created_ts, last_created_ts, sample_count,
       COALESCE(NULLIF(fleet_name, ''), 'Unknown') AS fleet_name_option, COALESCE(NULLIF(pad_name, ''), 'Unknown') AS pad_name_option FROM wells"""))
def _(spark, d):
    return reports.well_options(rollup.well_index(tv.telemetry(spark, d)))


@bound("stage_options", sql("win", "SELECT name, stage_num_td AS label, stage_num_td AS value, stage_start_ts, stage_end_ts, sample_count FROM win"))
def _(spark, d):
    return reports.stage_options(tv.stage_index(spark, d, with_site=False))


ORDINAL_LABELS = """(SELECT l.name, o.ordinal AS stage_num_td, l.datetime_fmt, l.substage AS substage_label FROM lab l JOIN (SELECT name, ordinal_confirmed AS ordinal, MIN(datetime_fmt) AS s, MAX(datetime_fmt) AS e
  FROM ord WHERE ordinal_confirmed > 0 GROUP BY 1, 2) o ON o.name = l.name AND l.datetime_fmt BETWEEN o.s AND o.e WHERE l.substage <> 'NA')"""


@bound("ordinal_label_windows", sql("stg lab", "SELECT *, '#5F8FD6' AS color FROM (" + _islands_sql(ORDINAL_LABELS, "name, stage_num_td", "datetime_fmt", "substage_label") + ")", SMARK, ORDINAL_SQL))
def _(spark, d):
    windows_ = ordinals.marker_ordinals(tv.marker_labels(spark, d, GAP_SECONDS)).where(F.col("ordinal_confirmed") > 0).groupBy("name", F.col("ordinal_confirmed").alias("ordinal")).agg(
        F.min("datetime_fmt").alias("stage_start_ts"), F.max("datetime_fmt").alias("stage_end_ts"))
    return reports.label_windows_in(tv.labels(spark, d), windows_, "ordinal", phases=True, slot_seconds=SLOT)


BREAK_SQL = f"""
SELECT w.name || ':stage_break:' || {text('stage_end_ts + INTERVAL 1 MILLISECOND')}, w.name, stage_end_ts + INTERVAL 1 MILLISECOND, NULL, NULL, NULL, NULL, NULL, 0
FROM win w WHERE EXISTS (SELECT 1 FROM rng b WHERE b.name = w.name AND w.stage_end_ts >= b.f AND w.stage_end_ts < b.t)"""


@bound("pad_chart_raw", sql("stg win", f"""
SELECT t.name || ':' || {text('t.record_ts')} AS telemetry_point_id, t.name AS well_name, t.record_ts AS "timestamp", CAST(w.stage_num_td AS DOUBLE) AS stage_num,
       t.rate_slurry, t.press_mainline, t.prop_conc_target AS selected_concentration, CAST(NULL AS DOUBLE) AS context_anchor, CAST(1 AS BIGINT) AS records_in_bucket
FROM (SELECT * FROM tel t WHERE EXISTS (SELECT 1 FROM rng b WHERE b.name = t.name AND t.record_ts BETWEEN b.f AND b.t)) t
LEFT JOIN win w ON w.name = t.name AND t.record_ts BETWEEN w.stage_start_ts AND w.stage_end_ts
UNION ALL {ANCHOR_SQL} UNION ALL {BREAK_SQL}""", BOUNDS_SQL))
def _(spark, d):
    w = tv.stage_index(spark, d, with_site=False)
    return reports.pad_chart(tv.readings(spark, d), w, _bounds(w), 720, "target", requested="raw").select(*reports.CHART)


@bound("segmentation_rollup_chart", sql("win hidx", f"""
SELECT t.name || ':' || {text('t.bucket_ts')} AS telemetry_point_id, t.name AS well_name, t.bucket_ts AS "timestamp", rate_slurry_avg AS rate_slurry, press_mainline_avg AS press_mainline,
       prop_conc_inline_avg AS selected_concentration, CAST(NULL AS DOUBLE) AS context_anchor, records_in_bucket FROM roll t WHERE EXISTS (SELECT 1 FROM rng b WHERE b.name = t.name AND t.bucket_ts >= b.f AND t.bucket_ts < b.t)
UNION ALL SELECT x.name || ':line_break:' || {text('x.ts + INTERVAL 1 MILLISECOND')}, x.name, x.ts + INTERVAL 1 MILLISECOND, NULL, NULL, NULL, NULL, 0
FROM (SELECT name, stage_end_ts AS ts FROM win UNION SELECT name, stage_end_ts FROM hidx) x WHERE EXISTS (SELECT 1 FROM rng b WHERE b.name = x.name AND x.ts >= b.f AND x.ts < b.t)
UNION ALL SELECT name || ':context_start:' || {text('f')}, name, f, NULL, NULL, NULL, 0.0, 0 FROM bnd UNION ALL SELECT name || ':context_end:' || {text('t')}, name, t, NULL, NULL, NULL, 0.0, 0 FROM bnd""",
    BOUNDS_SQL, "\nroll AS (" + _rollup_sql("tel") + ")"))
def _(spark, d):
    w = tv.stage_index(spark, d, with_site=False)
    given = rollup.history_stage_index(tv.history(spark, d))
    out = reports.segmentation_chart(tv.readings(spark, d), rollup.tumbling_rollup(tv.telemetry(spark, d), BUCKET_SECONDS), w, given, _bounds(w), 720, "inline", use_rollup=True)
    return show(out, *[c for c in reports.CHART if c != "stage_num"], rounded=("rate_slurry", "press_mainline", "selected_concentration"))


@bound("phase_chart", sql("lab lwin", """
SELECT t.name AS well_name, CAST(w.stage_num_td AS DOUBLE) AS stage_num, t.record_ts AS ts, NULLIF(l.substage, 'NA') AS substage_label, t.rate_slurry, CAST(NULL AS DOUBLE) AS design_rate, CAST(NULL AS DOUBLE) AS context_anchor
FROM lwin w JOIN tel t ON t.name = w.name AND t.record_ts BETWEEN w.stage_start_ts AND w.stage_end_ts LEFT JOIN lab l ON l.name = t.name AND l.stage_num_td = w.stage_num_td AND l.datetime_fmt = t.record_ts
UNION ALL SELECT name, NULL, stage_start_ts, NULL, NULL, NULL, 0.0 FROM lwin UNION ALL SELECT name, NULL, stage_end_ts, NULL, NULL, NULL, 0.0 FROM lwin"""))
def _(spark, d):
    out = reports.label_chart(tv.readings(spark, d), tv.labels(spark, d), tv.stage_index(spark, d, with_site=False, gap=LONG_GAP_SECONDS), 0, with_design=False)
    return out.select("well_name", "stage_num", "ts", "substage_label", "rate_slurry", "design_rate", "context_anchor")


@bound("pad_annotation_table", sql("lab ann lay", f"""
SELECT a.annotation_id, a.layer_id, a.name AS well_name, 'stage_start' AS substage_name, start_time, end_time, 'window' AS annotation_type, true AS can_edit, CAST(NULL AS VARCHAR) AS color
FROM ann a JOIN lay l ON l.layer_id = a.layer_id AND l.owner_email = 'user3' WHERE status = 'active' AND start_time <= TIMESTAMP '{RANGE[1]}' AND end_time >= TIMESTAMP '{RANGE[0]}'
UNION ALL SELECT {ISLE_ID}, 'system:model:platinum_substage_labels', name, substage, start_ts, end_ts, CASE WHEN substage IN ('stage_start', 'stage_end') THEN 'point' ELSE 'window' END, false, {PAD_COLOR}
FROM isle2 WHERE start_ts < end_ts OR substage IN ('stage_start', 'stage_end')""",
    "\nisle2 AS (" + _islands_sql(f"(SELECT * FROM lab WHERE substage <> 'NA' AND datetime_fmt BETWEEN TIMESTAMP '{RANGE[0]}' AND TIMESTAMP '{RANGE[1]}')", "name, stage_num_td", "datetime_fmt", "substage") + ")"))
def _(spark, d):
    out = reports.annotation_table(tv.annotations(spark, d), tv.layers(spark, d), tv.labels(spark, d), "user3", *RANGE, own_layers_only=True, pad=True, slot_seconds=SLOT)
    return out.select("annotation_id", "layer_id", "well_name", "substage_name", "start_time", "end_time", "annotation_type", "can_edit", "color")


@bound("layer_annotation_table", sql("ann lay", f"""
SELECT a.annotation_id, a.layer_id, a.name AS well_name, start_time, end_time, COALESCE(is_editable AND owner_email = 'user3', false) AS can_edit FROM ann a LEFT JOIN lay l ON l.layer_id = a.layer_id
WHERE status = 'active' AND a.layer_id = '3-MEDIUM' AND start_time <= TIMESTAMP '{RANGE[1]}' AND end_time >= TIMESTAMP '{RANGE[0]}'"""))
def _(spark, d):
    out = reports.annotation_table(tv.annotations(spark, d), tv.layers(spark, d), tv.labels(spark, d), "user3", *RANGE, layer="3-MEDIUM", slot_seconds=SLOT)
    return out.select("annotation_id", "layer_id", "well_name", "start_time", "end_time", "can_edit")
