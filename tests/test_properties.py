"""Random data against plain Python, with one well holding a third of the rows."""

from __future__ import annotations

import random
import statistics
from datetime import datetime, timedelta
from itertools import groupby

import pandas as pd
import pytest
from pyspark.sql import functions as F

from boreline.operators import intervals, islands, labelling, ordered, stages

T0 = datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def data():
    rng = random.Random(7)
    rows = []
    for well in range(12):
        size = 600 if well == 0 else rng.randint(1, 120)
        seconds = sorted(rng.choice([rng.randint(0, 4000), rng.randint(0, 400)]) for _ in range(size))
        rows += [(f"w{well}", T0 + timedelta(seconds=s), rng.choice("xyz"), float(rng.randint(0, 9)), i) for i, s in enumerate(seconds)]
    return rows


@pytest.fixture(scope="module")
def frame(spark, data):
    return spark.createDataFrame(data, "name string, record_ts timestamp_ntz, label string, v double, i int").cache()


def by_well(data):
    return {k: list(g) for k, g in groupby(sorted(data, key=lambda r: r[0]), key=lambda r: r[0])}


@pytest.mark.parametrize("gap", [7, 20])
def test_sessions(frame, data, gap):
    want = set()
    for well, rows in by_well(data).items():
        stage, last = 0, None
        for r in sorted(rows, key=lambda r: r[1]):
            if last is None or (r[1] - last).total_seconds() >= gap:
                stage += 1
            last = r[1]
            want.add((well, r[1], stage))
    assert {(r["name"], r["record_ts"], r["stage_num_td"]) for r in stages.assign_stages(frame, gap).collect()} == want


@pytest.mark.parametrize("max_gap", [None, 15])
@pytest.mark.parametrize("width", [5, 300])
def test_islands(frame, data, max_gap, width):
    want = []
    for well, rows in by_well(data).items():
        run = None
        for r in sorted(rows, key=lambda r: (r[1], r[2])):
            if run and run[0] == r[2] and (max_gap is None or (r[1] - run[2]).total_seconds() <= max_gap):
                run[2], run[3] = r[1], run[3] + 1
            else:
                if run:
                    want.append((well, *run))
                run = [r[2], r[1], r[1], 1]
        want.append((well, *run))
    got = [(r["name"], r["label"], r["start_ts"], r["end_ts"], r["sample_count"]) for r in islands.label_islands(frame, ["name"], "record_ts", "label", max_gap, width).collect()]
    assert sorted(got) == sorted(want)
    assert sum(g[4] for g in got) == len(data)


@pytest.mark.parametrize("width", [1.0, 4.0])
def test_median(frame, data, width):
    got = {r["name"]: r["m"] for r in ordered.exact_median(frame, ["name"], "v", "m", width).collect()}
    assert got == {w: statistics.median(r[3] for r in rows) for w, rows in by_well(data).items()}


def test_overlap_counts(spark):
    rng = random.Random(3)
    rows = []
    for i in range(300):
        s = rng.randint(0, 500)
        rows.append(("hot" if i % 3 else f"g{i % 4}", str(i), T0 + timedelta(seconds=s), T0 + timedelta(seconds=s + rng.choice([0, 0, 5, 80]))))
    df = spark.createDataFrame(rows, "layer string, k string, s timestamp_ntz, e timestamp_ntz")
    want = {(g, k): sum(1 for h, j, s2, e2 in rows if h == g and j != k and s2 < e and e2 > s) for g, k, s, e in rows}
    assert {(r["layer"], r["k"]): r["overlap_count"] for r in intervals.overlap_counts(df, "layer", "k", "s", "e", 40).collect()} == want


@pytest.mark.parametrize("bucket", [30, 1000])
def test_interval_join(spark, frame, data, bucket):
    rng = random.Random(5)
    windows = []
    for n in range(60):
        s = rng.randint(0, 4000)
        windows.append((f"w{rng.choice([0, 0, 1, 2, 3])}", n, T0 + timedelta(seconds=s), T0 + timedelta(seconds=s + rng.choice([0, 3, 400]))))
    w = spark.createDataFrame(windows, "name string, n int, s timestamp_ntz, e timestamp_ntz")
    want = sorted((r[0], r[4], n) for r in data for name, n, s, e in windows if name == r[0] and s <= r[1] <= e)
    got = sorted((r["name"], r["i"], r["n"]) for r in intervals.interval_join(frame, w, "record_ts", "s", "e", bucket_seconds=bucket).collect())
    assert got == want


def test_min_run_and_neighbours(spark):
    rng = random.Random(11)
    mask = [rng.random() < 0.5 for _ in range(400)]
    rows = [("a", 1, T0 + timedelta(seconds=3 * i), m) for i, m in enumerate(mask)]
    df = spark.createDataFrame(rows, "name string, stage_num_td bigint, t timestamp_ntz, m boolean")
    keys = ["name", "stage_num_td"]
    kept = [False] * 400
    for _, run in groupby(range(400), key=lambda i: mask[i]):
        run = list(run)
        for i in run:
            kept[i] = mask[i] and len(run) >= 3
    got = [r["k"] for r in islands.min_run_filter(df, keys, "t", "m", 3, "k", slot_seconds=10).orderBy("t").collect()]
    assert got == kept
    near = [(not mask[i] and any(mask[i + 1 : i + 3]), not mask[i] and any(mask[max(0, i - 2) : i])) for i in range(400)]
    assert [(r["is_before"], r["is_after"]) for r in islands.run_neighbours(df, keys, "t", "m", 2, slot_seconds=10).orderBy("t").collect()] == near


def test_label_hook_is_the_same_for_any_slot(frame):
    rows = frame.dropDuplicates(["name", "record_ts"]).select("name", F.lit(1).cast("bigint").alias("stage_num_td"), F.col("record_ts").alias("datetime_fmt"), "v")

    def labeller(part: pd.DataFrame) -> pd.Series:
        return (part["v"].diff().fillna(0) > 0).map({True: "up", False: None})

    outs = []
    for width in (10, 100_000):
        out = labelling.label_stages(rows, labeller, 1, slot_seconds=width)
        outs.append(sorted((r["name"], r["datetime_fmt"], r["substage"]) for r in out.collect()))
    assert outs[0] == outs[1] and {s for _, _, s in outs[0]} == {"up", "NA"}


def test_merged_partials_equal_one_pass(frame):
    df = frame.select("name", "record_ts", F.col("record_ts").alias("created_ts"), F.col("i").cast("string").alias("id"), F.col("v").alias("rate_slurry"), F.col("v").alias("press_mainline"), F.col("v").alias("prop_conc_blend_denso"))
    whole = stages.stage_windows(df, 20)
    assigned = stages.assign_stages(df, 20)
    parts = [stages.partials_of_assigned(assigned.where(F.col("id").cast("int") % 3 == k)) for k in range(3)]
    columns = whole.columns
    assert sorted(stages.merge_partials(*parts).select(*columns).collect()) == sorted(whole.collect())
    assert stages.overlap_violations(whole).count() == 0
