"""Streams equal the batch result, also after a replay."""

from __future__ import annotations

import pandas as pd
import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from boreline.functions.numbers import slot
from boreline.operators import stages
from boreline.sources import testviews as tv, writes
from boreline.streaming import live, merged, sessions

FEED = ["created_ts", "record_ts", "name", "id"]


def bounds(df):
    return sorted((r["name"], r["stage_num_td"], r["stage_start_ts"], r["stage_end_ts"]) for r in df.collect())


def with_measures(rows):
    return rows.withColumns({m: F.lit(1.0) for m in stages.WINDOW_MEASURES})


def test_sessions_over_batches_and_late_rows(spark, sf_dir, tmp_path):
    rows = tv.readings(spark, sf_dir).select(*FEED)
    turn = F.abs(F.hash("id")) % 10
    parts = [rows.where(turn < 4), rows.where(turn.between(4, 6)), rows.where(turn >= 6)]  # some are sent twice
    root = str(tmp_path / "out")
    for n, part in enumerate(parts):  # each run starts again from the checkpoint
        part.coalesce(1).write.parquet(str(tmp_path / "in" / f"p={n}"))
        sessions.sessions(live.read_feed(spark, str(tmp_path / "in" / "*"), rows.schema), root, tv.GAP_SECONDS).awaitTermination()
    assert bounds(sessions.stage_index(spark, root)) == bounds(stages.stage_windows(with_measures(rows), tv.GAP_SECONDS))
    late = {r["batch"]: r["sum(readings)"] for r in sessions.late_readings(spark, root).groupBy("batch").sum("readings").collect()}
    last = parts[0].groupBy("name").agg(F.max("record_ts").alias("last"))
    slots = parts[1].groupBy("name", slot("record_ts", tv.GAP_SECONDS)).agg(F.min("record_ts").alias("lo"), F.count(F.lit(1)).alias("n"))
    assert late[1] == slots.join(last, "name").where("lo <= last").agg(F.sum("n")).first()[0] and set(late) == {1, 2}
    assert [r["kind"] for r in sessions.late_readings(spark, root).select("kind").distinct().collect()] == ["late"]


def test_sessions_go_on_from_an_index(spark, sf_dir, tmp_path):
    rows = tv.readings(spark, sf_dir).select(*FEED)
    first = stages.stage_windows(with_measures(tv.first_batch(tv.readings(spark, sf_dir))), tv.GAP_SECONDS)
    tv.second_batch(tv.readings(spark, sf_dir)).select(*FEED).coalesce(1).write.parquet(str(tmp_path / "in" / "p=0"))
    root = str(tmp_path / "out")
    sessions.sessions(live.read_feed(spark, str(tmp_path / "in" / "*"), rows.schema), root, tv.GAP_SECONDS, index=first, kept_days=30).awaitTermination()
    assert bounds(sessions.stage_index(spark, root, first)) == bounds(stages.stage_windows(with_measures(rows), tv.GAP_SECONDS))


@given(st.lists(st.integers(0, 400), min_size=1, max_size=60), st.integers(2, 40))
def test_intervals_in_any_order_give_the_same_stages(times, gap):
    found = []
    for t in times:
        sessions.insert(found, t, t, gap)
    want = []
    for t in sorted(times):
        if want and t - want[-1][1] < gap:
            want[-1] = (want[-1][0], t)
        else:
            want.append((t, t))
    assert found == want


class Memory:
    """State variables of one key without a stream."""

    def __init__(self):
        self.value, self.map = None, {}

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value

    def updateValue(self, k, v):  # noqa: N802
        self.map[k] = v

    def removeKey(self, k):  # noqa: N802
        self.map.pop(k, None)

    def iterator(self):
        return iter(list(self.map.items()))


def one_well(kept=None):
    state = sessions.Stages(10, kept)
    state.tail, state.closed = Memory(), Memory()

    def send(*intervals):
        out = list(state.handleInputRows(("w",), iter([pd.DataFrame(intervals, columns=["lo", "hi", "readings"])]), None))[0]
        return sorted(tuple(None if pd.isna(v) else v for v in r) for r in out.drop(columns="name").itertuples(index=False))

    return state, send


def test_a_late_interval_can_make_two_stages_one():
    _, send = one_well()
    assert send((0, 5, 2), (100, 100, 1), (200, 203, 3)) == [("stage", 1, 0, 5, 0), ("stage", 2, 100, 100, 0), ("stage", 3, 200, 203, 0)]
    assert send((108, 195, 9)) == [("gone", 3, None, None, 0), ("late", None, 108, 195, 9), ("stage", 2, 100, 203, 0)]
    assert send((50, 50, 1)) == [("late", None, 50, 50, 1), ("stage", 2, 50, 50, 0), ("stage", 3, 100, 203, 0)]
    assert send((50, 50, 1)) == [("late", None, 50, 50, 1)]


def test_closed_stages_are_forgotten_by_the_readings_time():
    day = sessions.DAY
    state, send = one_well(kept=2 * day)
    for k in range(6):
        assert send((k * day, k * day + 5, 1)) == [("stage", k + 1, k * day, k * day + 5, 0)]
    assert sorted(state.closed.map) == [(3 * day,), (4 * day,)] and state.tail.get() == (6, 5 * day, 5 * day + 5, 2 * day + 5)
    assert send((day, day, 4)) == [("late", None, day, day, 4), ("unplaced", None, day, day, 4)]
    assert send((3 * day - 50, 3 * day - 50, 1))[1:] == [("stage", 4, 3 * day - 50, 3 * day - 50, 0), ("stage", 5, 3 * day, 3 * day + 5, 0), ("stage", 6, 4 * day, 4 * day + 5, 0), ("stage", 7, 5 * day, 5 * day + 5, 0)]


class Killed(Exception):
    pass


def test_live_tables_survive_a_kill_between_writes(spark, sf_dir, tmp_path, monkeypatch):
    rows = tv.telemetry(spark, sf_dir)
    root = str(tmp_path / "live")
    turn = F.abs(F.hash("id")) % 10
    marker, label = F.when(F.col("press_mainline") >= 500, "MID").otherwise("LOW"), F.when(F.col("rate_slurry") >= F.col("inferred_design_rate"), "design")
    first, second = rows.where(turn < 6), rows.where(turn >= 5)
    merged.apply_live(spark, root, first, tv.GAP_SECONDS, marker, label)

    def tables():
        return {t: sorted(map(repr, merged.read_live(spark, root, t, rows.schema).select("name", *more).collect())) for t, more in (("windows", ["stage_num_td", "sample_count"]), ("labels", ["datetime_fmt", "substage"]), ("readings", ["record_ts", "id"]), ("wells", ["sample_count"]))}

    before = tables()
    with monkeypatch.context() as patch:

        def killed(self, numPartitions):  # noqa: N803
            raise Killed

        patch.setattr(type(rows), "coalesce", killed)
        with pytest.raises(Killed):
            merged.apply_live(spark, root, second, tv.GAP_SECONDS, marker, label)
    assert (tmp_path / "live" / "labels" / "data" / "version=1").exists() and tables() == before
    for _ in range(2):  # the batch again, and once more after its commit
        merged.apply_live(spark, root, second, tv.GAP_SECONDS, marker, label)
        after = tables()
        assert len(after["readings"]) == len(after["labels"]) == rows.count()
        want = stages.stage_windows(rows, tv.GAP_SECONDS)
        assert after["windows"] == sorted(map(repr, want.select("name", "stage_num_td", "sample_count").collect()))
    writes.prune_tables(spark, root, behind=0)
    assert tables() == after
    assert not (tmp_path / "live" / "labels" / "data" / "version=0").exists()


def test_a_replayed_batch_is_not_counted_twice(spark, sf_dir, tmp_path):
    rows = tv.readings(spark, sf_dir).select(*FEED)
    rows.coalesce(1).write.parquet(str(tmp_path / "in" / "p=0"))
    root = tmp_path / "out"
    for _ in range(2):  # a lost checkpoint sends the same files again
        live.ingest(live.read_feed(spark, str(tmp_path / "in" / "*"), rows.schema), str(root), ["record_ts", "name"], ["id"]).awaitTermination()
        (root / "checkpoint").rename(tmp_path / f"checkpoint-{len(list(tmp_path.iterdir()))}")
    assert live.merged_rows(spark, str(root), rows.schema).count() == rows.count()


def test_upsert_folder_touches_only_its_partitions(spark, tmp_path):
    path, schema = str(tmp_path / "t"), "name string, v int, day string"

    def table():
        return sorted((r["name"], r["v"]) for r in writes.read_folder(spark, path, new.schema, "day").collect())

    old = spark.createDataFrame([("a", 1, "2024-01-01"), ("b", 1, "2024-01-02")], schema)
    new = spark.createDataFrame([("a", 5, "2024-01-01"), ("c", 6, "2024-01-01"), ("d", 7, "2024-01-03")], schema)
    writes.upsert_folder(spark, path, old, ["name", "day"], "day")
    writes.upsert_folder(spark, path, new, ["name", "day"], "day")
    assert table() == [("a", 5), ("b", 1), ("c", 6), ("d", 7)]
    assert sorted(p.name for p in (tmp_path / "t" / "data" / "version=1").glob("day=*")) == ["day=2024-01-01", "day=2024-01-03"]
    writes.upsert_folder(spark, path, new.limit(0), ["name", "day"], "day")
    writes.upsert_folder(spark, path, new, ["name", "day"], "day")
    writes.prune_folder(spark, path, new.schema, "day")
    assert table() == [("a", 5), ("b", 1), ("c", 6), ("d", 7)]
    assert sorted(p.name for p in (tmp_path / "t" / "data").glob("version=*")) == ["version=0", "version=2"]


def test_a_crash_before_the_commit_changes_nothing(spark, tmp_path, monkeypatch):
    path, schema = str(tmp_path / "t"), "name string, v int, day string"
    old = spark.createDataFrame([("a", 1, "d1"), ("b", 1, "d2")], schema)
    new = spark.createDataFrame([("a", 5, "d1"), ("c", 6, "d2")], schema)
    writes.upsert_folder(spark, path, old, ["name", "day"], "day")

    def table():
        return sorted((r["name"], r["v"]) for r in writes.read_folder(spark, path, new.schema, "day").collect())

    class Lost(Exception):
        pass

    def crash(self, numPartitions):  # noqa: N803
        raise Lost

    with monkeypatch.context() as patch:
        patch.setattr(type(new), "coalesce", crash)
        with pytest.raises(Lost):
            writes.upsert_folder(spark, path, new, ["name", "day"], "day")
    assert (tmp_path / "t" / "data" / "version=1").exists() and table() == [("a", 1), ("b", 1)]
    writes.upsert_folder(spark, path, new, ["name", "day"], "day")
    assert table() == [("a", 5), ("b", 1), ("c", 6)]


def test_a_retried_run_replaces_its_rows(spark, tmp_path):
    root = str(tmp_path / "runs")
    rows = spark.createDataFrame([("a", "r1"), ("b", "r1")], "name string, processing_run_id string")
    manifest = spark.createDataFrame([("a", "r1", "x")], "name string, active_run_id string, status string")
    for _ in range(2):
        writes.publish_run({"labels": rows}, manifest, root)
    writes.publish_run({"labels": rows.withColumn("processing_run_id", F.lit("r2"))}, manifest.withColumn("active_run_id", F.lit("r2")), root)
    assert spark.read.parquet(f"{root}/labels").count() == 4 and spark.read.parquet(f"{root}/manifest").count() == 2
