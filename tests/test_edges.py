"""Hand tables for the edges: exact gaps, equal times, nulls, late rows, empty input."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from boreline.functions.clean import blank_to, name_family, normal_label, number_text
from boreline.functions.numbers import round_half_up, slot
from boreline.operators import anomaly, intervals, islands, joins, labelling, machines, ordered, rollup, scores, stages
from boreline.plans import flows, reports
from boreline.sources import catalog, reads, signatures, writes

T0 = datetime(2024, 1, 1)


def at(seconds: float) -> datetime:
    return T0 + timedelta(seconds=seconds)


READING = "name string, record_ts timestamp_ntz, created_ts timestamp_ntz, id string, rate_slurry double, press_mainline double, prop_conc_blend_denso double"


def readings(spark, *rows):
    """(name, second) or (name, second, rate)"""
    full = [(r[0], at(r[1]), at(r[1]), str(i), float(r[2]) if len(r) > 2 else 1.0, 10.0, None) for i, r in enumerate(rows)]
    return spark.createDataFrame(full, READING)


def numbered(df):
    return sorted((r["name"], r["record_ts"], r["stage_num_td"]) for r in df.collect())


def test_gap_of_exactly_the_limit_starts_a_stage(spark):
    df = readings(spark, ("a", 0), ("a", 3599.999999), ("a", 7199.999999), ("a", 7200), ("b", 5))
    assert [s for _, _, s in numbered(stages.assign_stages(df, 3600))] == [1, 1, 2, 2, 1]


def test_equal_times_and_slot_edges_stay_in_one_stage(spark):
    df = readings(spark, ("a", 3599.5), ("a", 3600.5), ("a", 3600.5), ("a", 3600.0))
    assert {s for _, _, s in numbered(stages.assign_stages(df, 3600))} == {1}


def test_numbering_goes_on_from_prior_state(spark):
    prior = spark.createDataFrame([("a", at(0), 4), ("b", at(0), 2)], "name string, last_record_ts timestamp_ntz, last_stage bigint")
    df = readings(spark, ("a", 10), ("a", 5000), ("b", 3600), ("c", 1))
    assert [(n, s) for n, _, s in numbered(stages.assign_stages(df, 3600, prior))] == [("a", 4), ("a", 5), ("b", 3), ("c", 1)]


def test_windows_keep_last_non_null_and_skip_nulls(spark):
    rows = [("a", at(0), None, "1", "F1", 2.0), ("a", at(1), at(9), "2", None, None), ("a", at(2), at(8), "3", "", 4.0)]
    df = spark.createDataFrame(rows, "name string, record_ts timestamp_ntz, created_ts timestamp_ntz, id string, fleet_name string, rate_slurry double")
    df = df.withColumn("press_mainline", F.lit(None).cast("double")).withColumn("prop_conc_blend_denso", F.lit(1.0))
    w = stages.stage_windows(df, 3600).first()
    assert (w["fleet_name"], w["well_id"], w["sample_count"], w["avg_rate_slurry"], w["avg_press_mainline"]) == ("", "3", 3, 3.0, None)
    assert (w["first_created_ts"], w["last_created_ts"]) == (at(8), at(9))


def test_empty_input(spark):
    df = readings(spark, ("a", 0)).where("name = 'none'")
    assert stages.stage_windows(df, 3600).count() == 0
    assert anomaly.row_anomalies(catalog.LABELS.empty(spark)).count() == 0


def test_late_row_in_zero_one_and_two_windows(spark):
    w = spark.createDataFrame([("a", 1, at(0), at(10)), ("a", 2, at(8), at(20)), ("a", 3, at(30), at(30))], "name string, stage_num_td bigint, s timestamp_ntz, e timestamp_ntz")
    points = readings(spark, ("a", 5), ("a", 9), ("a", 25), ("a", 10), ("a", 20), ("a", 30), ("b", 5))
    got = {(r["name"], r["record_ts"]): (r["matches"], r["matched_value"]) for r in intervals.windows_holding(points, w, "record_ts", "s", "e", "stage_num_td", slot_seconds=7).collect()}
    assert got == {
        ("a", at(5)): (1, 1), ("a", at(9)): (2, None), ("a", at(25)): (0, None), ("a", at(10)): (2, None),
        ("a", at(20)): (1, 2), ("a", at(30)): (1, 3), ("b", at(5)): (0, None),
    }


def test_long_early_window_hides_no_overlap(spark):
    w = spark.createDataFrame([("a", 1, at(0), at(100)), ("a", 2, at(10), at(20)), ("a", 3, at(50), at(60)), ("a", 4, at(101), at(102))], "name string, stage_num_td bigint, stage_start_ts timestamp_ntz, stage_end_ts timestamp_ntz")
    assert sorted(r["stage_num_td"] for r in stages.overlap_violations(w).collect()) == [2, 3]
    with pytest.raises(ValueError):
        stages.check_no_overlaps(w)


def test_island_with_null_gap_and_copies(spark):
    rows = [("a", at(0), "x"), ("a", at(0), "x"), ("a", at(1), "x"), ("a", at(2), "y"), ("a", at(2), "x"), ("a", at(3), "y"), ("a", at(50), "y")]
    df = spark.createDataFrame(rows, "name string, t timestamp_ntz, label string")
    got = sorted((r["label"], r["start_ts"], r["end_ts"], r["sample_count"]) for r in islands.label_islands(df, ["name"], "t", "label", max_gap_seconds=10, slot_seconds=2).collect())
    assert got == [("x", at(0), at(2), 4), ("y", at(2), at(3), 2), ("y", at(50), at(50), 1)]


def test_gap_of_exactly_the_segment_limit_joins(spark):
    df = spark.createDataFrame([("a", 1, at(0), "p"), ("a", 1, at(120), "p"), ("a", 1, at(240.000001), "p")], "name string, stage_num_td bigint, datetime_fmt timestamp_ntz, anomaly string")
    got = sorted((r["start_ts"], r["duration_sec"], r["anomaly_display"]) for r in islands.event_segments(df, 120).collect())
    assert got == [(at(0), 120.0, "P"), (at(240.000001), 0.0, "P")]


def test_floor_before_the_epoch(spark):
    df = spark.createDataFrame([(datetime(1969, 12, 31, 23, 59, 59),), (datetime(1970, 1, 1),)], "t timestamp_ntz")
    assert [r[0] for r in df.select(slot("t", 60)).collect()] == [-1, 0]


def test_rounding_is_half_away_from_zero(spark):
    df = spark.createDataFrame([(2.25,), (0.35,), (-1.25,), (1.0500000000000000444,)], "x double")
    assert [r[0] for r in df.select(round_half_up(F.col("x"), 1)).collect()] == [2.3, 0.4, -1.3, 1.1]


def test_names_and_labels(spark):
    df = spark.createDataFrame([("A B 12 C", None), ("A B C", " "), ("A", ""), ("  ", None), ("A B", " P ")], "name string, pad string")
    assert [r[0] for r in df.select(name_family("name", "pad")).collect()] == ["A B 12", "A B", "A", "Unknown", "P"]
    labels = spark.createDataFrame([("Design",), ("SLURRY",), ("shutoff",), ("NA",), (None,), ("Ramp_Up",)], "s string")
    assert [r[0] for r in labels.select(normal_label("s")).collect()] == ["design", "design", "shut_off", None, None, "ramp_up"]
    assert [r[0] for r in spark.createDataFrame([(3.0,), (2.5,)], "x double").select(number_text("x")).collect()] == ["3", "2.5"]
    assert spark.createDataFrame([("", "x")], "a string, b string").select(blank_to("a"), blank_to("a", "b")).first()[:] == ("Unknown", "x")


def test_rollup_first_and_last_put_null_creation_last(spark):
    rows = [("a", at(1), None, "1", 1.0), ("a", at(1), at(5), "2", 2.0), ("a", at(9), None, "3", 3.0), ("a", at(9), at(1), "4", 4.0)]
    df = spark.createDataFrame(rows, "name string, record_ts timestamp_ntz, created_ts timestamp_ntz, id string, rate_slurry double")
    for c in catalog.MEASURE_COLUMNS[1:]:
        df = df.withColumn(c, F.lit(1.0))
    df = df.withColumns({"fleet_name": F.lit(""), "pad_name": F.lit(None).cast("string"), "api_num": F.lit("n")})
    b = rollup.tumbling_rollup(df, 60).first()
    assert (b["rate_slurry_first"], b["rate_slurry_last"], b["id"], b["fleet_name"], b["pad_name"]) == (2.0, 4.0, "4", "Unknown", "Unknown")


def test_sampling_step_of_a_lone_row_is_one(spark):
    df = spark.createDataFrame([("a", 1, at(0)), ("b", 1, at(0)), ("b", 1, at(2)), ("b", 1, at(5))], "name string, stage_num_td bigint, record_ts timestamp_ntz")
    got = {r["name"]: r["sampling_step"] for r in labelling.sampling_step(df, slot_seconds=3).collect()}
    assert got == {"a": 1.0, "b": 2.5}


def test_percent_rank_of_ties_nulls_and_one_member(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 1.0), ("c", 2.0), ("d", None)], "k string, v double")
    up = {r["k"]: r["rank_v"] for r in scores.percent_ranks(df, ["k"], {"v": True}).collect()}
    down = {r["k"]: r["rank_v"] for r in scores.percent_ranks(df, ["k"], {"v": False}).collect()}
    assert up == {"a": 0.0, "b": 0.0, "c": 100.0, "d": 0.0}
    assert down == {"a": 50.0, "b": 50.0, "c": 0.0, "d": 0.0}
    assert scores.percent_ranks(df.where("k = 'c'"), ["k"], {"v": True}).first()["rank_v"] == 0.0


def test_filters_that_are_not_set_leave_no_trace(spark):
    df = spark.createDataFrame([("a", "F", "P", 1)], "name string, fleet_name string, pad_name string, stage_num_td bigint")
    for args in ({}, {"fleet": "", "pad": "__ALL__", "well": None, "stage": -1}):
        assert reads.optional_filters(df, **args).collect() == df.collect()
    assert reads.optional_filters(df, stage=2).count() == 0


def test_limited_scan_takes_the_oldest_rows(spark):
    df = readings(spark, *[("a", 30 * i) for i in range(40)], ("b", 45))
    got = [r["record_ts"] for r in reads.incremental_scan(df, at(60), 5).collect()]
    assert got == [at(60), at(90), at(120), at(150), at(180)]
    assert reads.incremental_scan(df, None, 1000).count() == 41


def test_an_empty_replacement_deletes_nothing(spark):
    old = spark.createDataFrame([("a", 1), ("b", 2)], "name string, v int")
    assert writes.replace_entity(old, old.where("v > 5")).count() == 2
    assert writes.replace_entity(old, spark.createDataFrame([("a", 9)], "name string, v int")).where("name = 'a'").first()["v"] == 9


def test_upsert_of_copies_keeps_one_row_per_key(spark):
    old = spark.createDataFrame([("a", 1, 1)], "name string, t int, v int")
    new = spark.createDataFrame([("a", 1, 5), ("a", 1, 7), ("b", 1, 2)], "name string, t int, v int")
    assert sorted(r[:] for r in writes.upsert_by_key(old, new, ["name", "t"], ["v"]).collect()) == [("a", 1, 7), ("b", 1, 2)]


def test_resolution_choice():
    assert reports.pick_resolution(None, None) == "rollup_120s"
    assert reports.pick_resolution("W1", None) == "rollup_60s"
    assert reports.pick_resolution("W1", 3) == "raw"
    assert reports.pick_resolution(None, -1, "raw") == "raw"
    assert reports.pick_resolution("__ALL__", None, "bad") == "rollup_120s"


def test_batch_replay_changes_nothing(spark):
    rows = readings(spark, *[("a", s) for s in (0, 100, 5000, 5100)], *[("b", s) for s in (0, 50)])
    first = stages.stage_windows(rows.where(F.col("record_ts") < at(5050)), 3600)
    batch = rows.where(F.col("record_ts") >= at(5050))
    once = flows.apply_batch(rows.where(F.col("record_ts") < at(5050)), batch, first, 3600)["windows"]
    twice = flows.apply_batch(rows, batch, once, 3600)["windows"]
    key = ["name", "stage_num_td", "stage_start_ts", "stage_end_ts", "sample_count"]
    assert sorted(once.select(*key).collect()) == sorted(twice.select(*key).collect()) == sorted(stages.stage_windows(rows, 3600).select(*key).collect())


def test_threshold_runs_break_at_other_labels(spark):
    press = [0, 100, 200, 300, 300, 400]
    rows = [("a", 1, at(i), "NA" if i == 3 else "design", 10.0, float(p)) for i, p in enumerate(press)]
    df = spark.createDataFrame(rows, "name string, stage_num_td bigint, datetime_fmt timestamp_ntz, substage string, rate_slurry double, press_mainline double")
    grid = anomaly.threshold_grid(df, df.select("name", "stage_num_td").distinct(), slot_seconds=2)
    got = {r["threshold_value"]: r["segment_count"] for r in grid.where("rolling_points = 1 AND threshold_type = 'pressure'").collect()}
    # deltas of the design rows: -, 100, 100 | 100 (after a break), 100
    assert got[100.0] == 2 and got[110.0] == 0 and len(got) == 46
    assert grid.count() == 660


def test_halo_reaches_over_empty_slots(spark):
    df = spark.createDataFrame([("a", at(s), s) for s in (0, 1, 50, 51, 52, 200)], "name string, t timestamp_ntz, v int")
    haloed = ordered.with_halo(df, ["name"], "t", before=3, after=2, slot_seconds=10)
    line = ordered.in_slot(["name"], "t")
    out = ordered.drop_halo(haloed.withColumn("b", F.lag("v", 3).over(line)).withColumn("f", F.lead("v", 2).over(line)))
    assert sorted((r["v"], r["b"], r["f"]) for r in out.collect()) == [(0, None, 50), (1, None, 51), (50, None, 52), (51, 0, 200), (52, 1, None), (200, 50, None)]


def test_nan_moves_no_median(spark):
    from boreline.operators.ordered import exact_median

    df = spark.createDataFrame([("a", v) for v in (float("nan"), 10.0, 20.0, 30.0, None)] + [("b", float("nan"))], "name string, v double")
    assert {r["name"]: r["m"] for r in exact_median(df, ["name"], "v", "m").collect()} == {"a": 20.0}


def test_a_stage_reaches_its_labeller_whole(spark):
    from boreline.operators import labelling

    rows = spark.range(25_000).selectExpr("'W' as name", "id div 12500 as stage_num_td", "timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, 0, id) as datetime_fmt")
    out = labelling.label_stages(rows, lambda part: [str(len(part))] * len(part))
    assert [tuple(r) for r in out.groupBy("stage_num_td", "substage").count().orderBy("stage_num_td").collect()] == [(0, "12500", 12500), (1, "12500", 12500)]


def test_work_batch_tells_what_is_left(spark):
    df = spark.createDataFrame([(k,) for k in range(5)], "k int")
    for limit, more in ((4, True), (5, False), (6, False)):
        got = reads.work_batch(df, ["k"], limit).collect()
        assert [r["k"] for r in got] == list(range(min(5, limit))) and all(r["has_more"] == more for r in got)


def test_nothing_is_left_after_clear_work(spark):
    from pathlib import Path

    from boreline.session import clear_work, stored, work_root

    stored(spark.range(3), "some")
    folder = Path(work_root(spark).removeprefix("file:")) / "boreline" / spark.sparkContext.applicationId
    assert any(folder.iterdir())
    clear_work(spark)
    assert not folder.exists()


def test_a_cluster_must_name_a_shared_folder():
    from types import SimpleNamespace

    from boreline.session import work_root

    for master in ("local-cluster[2,1,512]", "spark://x:7077", "yarn"):
        context = SimpleNamespace(master=master, getConf=lambda: {})
        with pytest.raises(ValueError):
            work_root(SimpleNamespace(conf={}, sparkContext=context))


def test_windows_without_a_range_overlap_nothing(spark):
    w = spark.createDataFrame([("a", 1, at(0), at(10)), ("a", 2, at(5), at(15)), ("a", 3, at(9), None), ("a", 4, at(8), at(2)), ("a", 5, None, at(3))], "g string, i int, s timestamp_ntz, e timestamp_ntz")
    assert {r["i"]: r["overlap_count"] for r in intervals.overlap_counts(w, "g", "i", "s", "e").collect()} == {1: 1, 2: 1, 3: 0, 4: 0, 5: 0}


def test_resent_and_late_readings_count_once(spark):
    schema = "name string, record_ts timestamp_ntz, created_ts timestamp_ntz, fleet_name string, pad_name string, id string, api_num string, rate_slurry double, press_mainline double, prop_conc_blend_denso double"
    row = lambda second, rate: ("a", at(second), at(second), "f", "p", str(second), "x", rate, 1.0, 1.0)
    old = spark.createDataFrame([row(0, 3.0), row(10, 5.0)], schema)
    windows = stages.stage_windows(old, 3600)
    batch = spark.createDataFrame([row(10, 1.0), row(5, 4.0)], schema)
    for _ in range(2):
        (got,) = flows.apply_batch(old, batch, windows, 3600)["windows"].collect()
        assert (got["sample_count"], got["avg_rate_slurry"]) == (3, (3.0 + 1.0 + 4.0) / 3)
        old = flows.merged_feed_flow(old, batch, windows, 3600)["readings"] if "id" in batch.columns else old


def test_a_cursor_gets_past_rows_of_one_time(spark):
    df = spark.createDataFrame([("a", at(0), at(0), str(k)) for k in range(5)] + [("a", at(0), at(1), "z")], "name string, record_ts timestamp_ntz, created_ts timestamp_ntz, id string")
    seen, after = [], None
    while True:
        page = reads.incremental_scan(df, after, 2)
        after = reads.next_cursor(page)
        if after is None:
            break
        seen += [r["id"] for r in page.collect()]
    assert seen == ["0", "1", "2", "3", "4", "z"]


def test_open_ended_windows(spark):
    """Windows of any length against brute force; one that never ends costs few rows."""
    ends = [at(5), at(86_400 * 40), at(86_400 * 900), datetime(9999, 12, 31), at(-10), None]
    rows = [("a" if k % 3 else None, k, at(3_600 * k * 7), e) for k, e in enumerate(ends * 6)]
    windows = spark.createDataFrame(rows, "name string, w int, s timestamp_ntz, e timestamp_ntz")
    points = [("a" if k % 5 else "b", at(50_000 * k - 200_000)) for k in range(120)] + [(None, at(0)), ("a", None), ("a", at(5)), ("a", at(5))]
    df = spark.createDataFrame(points, "name string, t timestamp_ntz")
    want = [(n, t, w) for n, t in points for m, w, s, e in rows if n is not None and n == m and t is not None and e is not None and s <= t <= e]
    got = [tuple(r) for r in intervals.interval_join(df, windows, "t", "s", "e", open_ended=True).select("name", "t", "w").collect()]
    assert sorted(got) == sorted(want) and want
    held = {(n, t) for n, t, _ in want}
    left = [tuple(r) for r in intervals.interval_join(df, windows, "t", "s", "e", "left", open_ended=True).select("name", "t", "w").collect()]
    assert sorted(map(repr, left)) == sorted(map(repr, want + [(n, t, None) for n, t in points if (n, t) not in held]))
    assert intervals.window_nodes(windows.where("w = 3"), "s", "e").count() < 60
    none = windows.limit(0)
    assert intervals.interval_join(df, none, "t", "s", "e", open_ended=True).count() == 0
    assert intervals.interval_join(df, none, "t", "s", "e", "left", open_ended=True).count() == len(points)


def test_charts_show_a_reading_once(spark):
    rows = readings(spark, ("a", 0), ("a", 60), ("a", 9_000), ("a", 9_060), ("b", 0)).withColumns({c: F.lit(1.0) for c in ("prop_conc_target", "prop_conc_blend_auger", "prop_conc_inline")})
    index = stages.stage_windows(rows, 3600)
    bounds = index.select("name", F.col("stage_start_ts").alias("start_time"), F.col("stage_end_ts").alias("end_time"))
    raw = reports.pad_chart(rows, index, bounds, 720, requested="raw").collect()
    ids = [r.telemetry_point_id for r in raw]
    assert len(ids) == len(set(ids)) and sum(r.records_in_bucket for r in raw) == 5
    bucketed = reports.pad_chart(rows, index, bounds, 720, requested="rollup_120s").collect()
    assert sum(r.records_in_bucket for r in bucketed) == 5 and sum(r.context_anchor is not None for r in bucketed) == 4
    near = reports.pad_chart(rows, index, bounds, 30, requested="raw").collect()  # two ranges that do not meet
    assert sum(r.context_anchor is not None for r in near) == 6 and sum(r.records_in_bucket for r in near) == 5


def test_a_fold_reads_a_stage_in_parts(spark):
    class Counter(labelling.Fold):
        """Labels each row with its number in the stage; fails if it is given much at once."""

        def start(self):
            return 0

        def step(self, state, rows):
            assert len(rows) <= 100
            labels = [str(state + k) for k in range(len(rows))]
            keep = [k for k in range(len(rows)) if state + k < 950]
            return (labelling.Trimmed([labels[k] for k in keep], keep[0], keep[-1]) if keep else None), state + len(rows)

    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        df = spark.range(1_000).select(F.lit("a").alias("name"), F.when(F.col("id") < 990, 1).cast("bigint").alias("stage_num_td"), (F.lit(T0) + F.make_dt_interval(secs=F.col("id"))).alias("datetime_fmt"), F.col("id"))
        got = {(r.stage_num_td, r.id): r.substage for r in labelling.label_stages(df, Counter()).collect()}
        assert got == {**{(1, k): str(k) for k in range(950)}, **{(None, 990 + k): str(k) for k in range(10)}}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_labellers_may_trim_or_skip_a_stage(spark):
    rows = [(n, s, at(k)) for n in "ab" for s in (1, 2) for k in range(5)]
    df = spark.createDataFrame(rows, "name string, stage_num_td bigint, datetime_fmt timestamp_ntz")

    def labeller(part):
        if part["name"].iloc[0] == "b":
            return None
        return labelling.Trimmed(["x", None, "z"], 1, 3) if part["stage_num_td"].iloc[0] == 2 else ["w"] * len(part)

    got = sorted((r.name, r.stage_num_td, r.datetime_fmt, r.substage) for r in labelling.label_stages(df, labeller).collect())
    assert got == [("a", 1, at(k), "w") for k in range(5)] + [("a", 2, at(1), "x"), ("a", 2, at(2), "NA"), ("a", 2, at(3), "z")]
    with pytest.raises(Exception, match="one label per row"):
        labelling.label_stages(df, lambda part: ["x"]).collect()
    column = labelling.label_stages(df, F.when(F.col("stage_num_td") == 1, "one"))
    assert {(r.stage_num_td, r.substage) for r in column.collect()} == {(1, "one"), (2, "NA")}
    assert "Exchange" not in column._jdf.queryExecution().executedPlan().toString()


def test_a_signature_tree_finds_what_changed(spark):
    path, schema = ["fleet", "well"], "fleet string, well string, v int"
    rows = [(f, w, k) for f in ("x", "y", None) for w in ("a", "b") for k in range(5)]
    old = signatures.signature_tree(spark.createDataFrame(rows, schema), path, ["v"])
    again = signatures.signature_tree(spark.createDataFrame(rows[::-1], schema).repartition(5), path, ["v"])
    assert sorted(map(repr, old.collect())) == sorted(map(repr, again.collect())) and old.count() == 1 + 3 + 6
    assert signatures.changed_entities(old, again, path).count() == 0
    changed = [r for r in rows if r[:2] != ("y", "b")] + [(None, "a", 4), ("x", "c", 1)]
    new = signatures.signature_tree(spark.createDataFrame(changed, schema), path, ["v"])
    got = {tuple(r) for r in signatures.changed_entities(old, new, path).collect()}
    assert got == {("y", "b", "lost"), (None, "a", "changed"), ("x", "c", "added")}
    keys = F.concat_ws("|", F.coalesce("fleet", F.lit("-")), "well").isin("y|b", "-|a", "x|c") & (F.col("level") == 2)
    moved = signatures.moved_tree(old, old.where(keys), new.where(keys), path)
    after = {tuple(r)[:3]: tuple(r) for r in old.collect()} | {tuple(r)[:3]: tuple(r) for r in moved.collect()}
    assert {r for r in after.values() if r[3]} == {tuple(r) for r in new.collect()}


def test_a_pyramid_is_made_of_multiples(spark):
    rows = readings(spark, ("a", 0, 1), ("a", 119, 3), ("a", 120, 5), ("a", 3_700, 9), ("b", 86_399, 2)).withColumns({c: F.lit(None).cast("string") for c in ("fleet_name", "pad_name", "api_num")})
    rows = rows.withColumns({m: F.lit(None).cast("double") for m in catalog.MEASURE_COLUMNS if m not in rows.columns})
    levels = rollup.pyramid_values(rollup.pyramid(rows, [120, 3_600, 86_400]))
    got = {(r.bucket_seconds, r.name, r.bucket_ts): (r.records_in_bucket, r.rate_slurry_avg, r.rate_slurry_last) for r in levels.collect()}
    assert got[86_400, "a", at(0)] == (4, 4.5, 9.0) and got[3_600, "a", at(0)] == (3, 3.0, 5.0) and got[120, "a", at(0)] == (2, 2.0, 3.0) and len(got) == 3 + 1 + 2 + 1 + 1 + 1
    assert levels.where("prop_conc_target_avg is not null").count() == 0
    assert {r.bucket_seconds for r in rollup.level_for(levels, 86_400, [120, 3_600, 86_400], 100).collect()} == {3_600}
    with pytest.raises(ValueError, match="multiple"):
        rollup.pyramid(rows, [120, 500])


def test_a_machine_over_slots_equals_one_over_rows(spark):
    import random

    rng = random.Random(4)
    steps = tuple(tuple(rng.randrange(5) for _ in range(4)) for _ in range(5))
    rows = [(n, None if rng.random() < 0.02 else at(rng.randrange(40_000)), k, None if rng.random() < 0.05 else rng.randrange(6)) for n in ("a", "b", None) for k in range(300)]
    df = spark.createDataFrame(rows, "name string, t timestamp_ntz, id int, s int").repartition(7)
    for reverse in (False, True):
        want = {}
        for n in ("a", "b", None):
            state = 2
            own = sorted((r for r in rows if r[0] == n), key=lambda r: (r[1] is not None, r[1] or T0, r[2]), reverse=reverse)
            for _, _, k, s in own:
                before = state
                state = steps[state][s] if s is not None and s < 4 else state
                want[n, k] = (before, state)
        out = machines.run_machine(df, machines.Machine(steps, 2), F.col("s"), ["name"], "t", ["id"], 600.0, reverse)
        assert out.columns == [*df.columns, machines.BEFORE, machines.AFTER]
        assert {(r.name, r.id): (r.state_before, r.state_after) for r in out.collect()} == want
    assert machines.run_machine(df.limit(0), machines.Machine(steps), F.col("s"), ["name"], "t").count() == 0
    with pytest.raises(ValueError, match="next state"):
        machines.Machine(((0, 1), (2, 0)))


def test_many_short_stages_are_labelled_by_few_calls(spark):
    from boreline.plans import bound_flows

    rows = [(n, s, at(7 * s + k), float((s * k) % 3) if k != 1 else None) for n in ("a", "b", None) for s in range(60) for k in range(s % 4 + 1)]
    df = spark.createDataFrame(rows, "name string, stage_num_td bigint, datetime_fmt timestamp_ntz, rate_slurry double").coalesce(1)

    def labels(labeller):
        return sorted(map(repr, labelling.label_stages(df, labeller).collect()))

    def all_alike(part):
        return [str(part[["name", "stage_num_td"]].drop_duplicates().shape[0])] * len(part)

    assert labels(bound_flows.TREND) == labels(bound_flows.trend_labeller)
    assert any(int(r.substage) > 10 for r in labelling.label_stages(df, labelling.Grouped(all_alike)).collect())
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2")  # a stage goes on over several batches
    try:
        assert labels(bound_flows.TREND) == labels(bound_flows.trend_labeller)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


@pytest.mark.parametrize("query", ["recompute_labels", "two_pass_labels"])
def test_rules_of_one_row_need_no_python(spark, sf_dir, query):
    import boreline.plans.bound_flows  # noqa: F401  (adds the flows)
    from boreline.plans.bound import QUERIES

    assert "MapInPandas" not in QUERIES[query](spark, sf_dir)._jdf.queryExecution().toString()


def test_group_starts_across_batches():
    import pandas as pd

    from boreline.operators.ordered import group_starts

    first, last = group_starts(pd.DataFrame({"n": ["a", "a", None], "s": [1, 2, 2]}), ["n", "s"], None)
    assert first.tolist() == [True, True, True] and last == (None, 2)
    second, last = group_starts(pd.DataFrame({"n": [None, None, "b"], "s": [2, 2, 2]}), ["n", "s"], last)
    assert second.tolist() == [False, False, True] and last == ("b", 2)


def test_a_pyramid_is_stored_before_it_is_refreshed(spark, sf_dir):
    from boreline.plans.bound import QUERIES

    assert "events.parquet" not in QUERIES["rollup_pyramid"](spark, sf_dir)._jdf.queryExecution().toString()


def test_a_first_commit_has_no_old_rows_to_join(spark):
    new = spark.createDataFrame([("a", 1, 1), ("a", 1, 2), (None, 1, 3)], "name string, k int, v int")
    first = writes.upsert_by_key(None, new, ["name", "k"], ["v"])
    assert "Join" not in first._jdf.queryExecution().toString() and sorted(r.v for r in first.collect()) == [2, 3]
    again = writes.upsert_by_key(first, new.withColumn("v", F.col("v") + 1).where("name is null"), ["name", "k"], ["v"])
    assert sorted(r.v for r in again.collect()) == [2, 4]


def test_packed_grid_is_the_same_grid(spark):
    """A limited run that replaces one stage's grid: 20 packed rows a stage, spread to the 660 of the plain grid."""
    labels = spark.sql("SELECT 'A' AS name, CAST(s AS BIGINT) AS stage_num_td, timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, i) AS datetime_fmt, 'slurry' AS substage, CAST(pmod(i * 37, 11) AS DOUBLE) AS rate_slurry, CAST(pmod(i * 91, 700) AS DOUBLE) AS press_mainline FROM (SELECT explode(sequence(1, 40)) AS i), (SELECT explode(sequence(1, 2)) AS s)")
    due = spark.sql("SELECT 'f' AS fleet_name, 'p' AS pad_name, 'A' AS name, CAST(s AS BIGINT) AS stage_num_td, 'new' AS source_signature FROM (SELECT explode(sequence(1, 3)) AS s)")
    before = due.withColumn("source_signature", F.when(F.col("stage_num_td") == 2, "new").otherwise("old"))
    grids = []
    for packed in (False, True):
        old = flows.tuning_flow(labels.limit(0), before, None, "2024-01-01", packed=packed)
        out = flows.tuning_run(labels, due, flows.tuning_manifest(before, "2024-01-01"), old, "2024-01-02", 1, packed=packed)
        assert out["has_more"].first()[0]
        grids.append(out["grid"])
    assert grids[1].count() == 3 * 20
    names = sorted(grids[0].columns)
    plain, spread = (sorted(map(str, g.select(*names).collect())) for g in (grids[0], anomaly.grid_rows(grids[1])))
    assert plain == spread and len(plain) == 3 * 660
    assert grids[0].where("segment_count > 0").select("stage_num_td").distinct().collect()[0][0] == 1


def test_restarts_are_those_of_the_plain_search(spark):
    """Random stages with repeated rows, equal times and nulls, against the rule read row by row."""
    import random

    dice = random.Random(7)
    kinds = [None, "PRE", "PRE", "LOW", "PRE_LOW", "MID_TRIAL", "MID_TRIAL", "MID", "stage_end"]
    keys = [(n, s) for n in ("a", "b", None) for s in (*range(1, 80), None)]
    marks = [(n, s, None if dice.random() < 0.05 else at(dice.randrange(12)), dice.choice(kinds)) for n, s in keys for _ in range(dice.randrange(24))]
    ends = [(n, s, None if dice.random() < 0.1 else at(dice.randrange(5)), dice.choice(["stage_end", "design", None])) for n, s in keys for _ in range(3)]
    schema = "name string, stage_num_td bigint, datetime_fmt timestamp_ntz, substage string"
    got = labelling.restart_positions(*[spark.createDataFrame(rows, schema) for rows in (ends, marks)])

    def times(rows, key, *kinds):
        return [t for n, s, t, k in rows if (n, s) == key and k in kinds and t is not None]

    want = []
    for key in keys:
        end = min(times(ends, key, "stage_end"), default=None)
        if None in key or end is None:
            continue
        low = min((t for t in times(marks, key, "LOW", "PRE_LOW") if t > end), default=None)
        trial = max((t for t in times(marks, key, "MID_TRIAL") if t > end), default=None)
        starts = [t for t in times(marks, key, "PRE") if low and trial and t > end and low < t < trial]
        if starts:
            want.append((*key, end, min(starts)))
    assert len(want) > 10
    assert sorted((r["name"], r["stage_num_td"], r["stage_end_at"], r["restart_at"]) for r in got.collect()) == want
