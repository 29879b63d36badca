"""Plans keep to the shapes the library promises."""

from __future__ import annotations

import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from boreline.operators import islands, stages
from boreline.sources import testviews as tv

ROOT = Path(__file__).resolve().parents[1] / "boreline"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def rows(spark, sf_dir):
    return tv.readings(spark, sf_dir)


def test_no_window_sees_a_whole_well_of_readings(rows):
    """Entity-wide windows run on slots only: a partial aggregate lies below each."""
    text = plan(stages.stage_windows(rows, 3600))
    first_exchange = [line for line in text.splitlines() if "Exchange hashpartitioning" in line][-1]
    assert re.search(r"hashpartitioning\(name#\d+, (_slot|_groupingexpression)#\d+L", first_exchange)
    assert "partial_" in text


def test_island_windows_carry_the_slot(rows):
    text = plan(islands.label_islands(rows.withColumn("stage", F.lit(1)), ["name"], "record_ts", "event_type"))
    windows = [line for line in text.splitlines() if re.search(r"\bWindow \[", line)]
    assert windows and all("_slot" in line or "_group" in line for line in windows)


def test_filters_and_columns_reach_the_scan(spark, sf_dir):
    df = tv.readings(spark, sf_dir).where(F.col("record_ts") >= F.lit("2024-01-20").cast("timestamp_ntz")).select("name", "record_ts")
    text = plan(df)
    assert "GreaterThanOrEqual(ts" in text
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint>" in text


def test_stage_numbering_reads_two_columns(rows):
    text = plan(stages.stage_slots(rows, 3600))
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint>" in text


def test_operators_hold_no_driver_loops():
    for path in (ROOT / "operators").glob("*.py"):
        source = path.read_text()
        allowed = 1 if path.name == "stages.py" else 0  # the overlap check reports at most ten rows
        assert source.count(".collect()") == allowed, path
        for banned in ("toPandas(", "toLocalIterator", "localCheckpoint", ".rdd", "F.udf("):
            assert banned not in source, (path, banned)


def test_no_python_in_relational_plans(spark, sf_dir):
    from __spark_entry__ import queries

    for name in ("stage_windows", "label_islands", "overlap_count", "presence_coverage", "tumbling_rollup"):
        text = plan(queries()[name](spark, sf_dir))
        assert "Python" not in text and "InPandas" not in text, name


def test_chart_range_reaches_the_scan(spark, sf_dir, rows):
    from boreline.plans import reports

    bounds = spark.createDataFrame([("W1",)], "name string").select("name", F.lit("2024-01-10").cast("timestamp_ntz").alias("start_time"), F.lit("2024-01-12").cast("timestamp_ntz").alias("end_time"))
    text = plan(reports.chart_window(rows, stages.stage_windows(rows, 3600), bounds, 30))
    assert "GreaterThanOrEqual(ts,2024-01-09T23:30)" in text and "LessThanOrEqual(ts,2024-01-12T00:30)" in text


def test_second_pass_joins_stored_restarts_only(spark, rows):
    """The search for restarts is not made again for each branch, and joins markers with the few stages that can have one, not with labels."""
    from boreline.operators import labelling
    from boreline.plans import bound_flows, flows

    staged = stages.assign_stages(rows, tv.LONG_GAP_SECONDS)
    markers = flows.label_rows(staged, bound_flows.marker_column())
    ready = staged.select("name", "stage_num_td", F.col("record_ts").alias("datetime_fmt"), "rate_slurry", "press_mainline")
    first = labelling.label_stages(ready, bound_flows.marker_column())
    assert "Aggregate" not in plan(labelling.two_pass_labels(ready, markers, bound_flows.design_column()))
    assert "stage_end)" not in plan(labelling.restart_positions(first, markers))


def test_wells_cut_again_are_picked_from_slots(spark, rows):
    """Where they are too many to broadcast, no readings are dealt out by well."""
    from boreline.plans import flows

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        old, batch = tv.first_batch(rows), tv.second_batch(rows)
        step = flows.apply_batch(old, batch, stages.stage_windows(old, tv.GAP_SECONDS), tv.GAP_SECONDS)
        assert step["repair_wells"].count()
        lines = step["windows"]._jdf.queryExecution().optimizedPlan().toString().splitlines()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    below = [lines[i + 1] for i, line in enumerate(lines) if "Join LeftSemi, (name#" in line and "stage_num_td" not in line]
    assert below and all(re.search(r"Aggregate \[name#\d+, (_slot|_groupingexpression)#\d+L\]", line) for line in below)
