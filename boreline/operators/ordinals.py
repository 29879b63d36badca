"""Stage ordinals from marker rows, and stage windows built on them.

The ordinal rules are this project's own: see the README.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .anomaly import STAGE, TIME
from .intervals import interval_join
from .labelling import DESIGN_MARKERS

LAYERS = {"provisional": "ordinal_provisional", "confirmed": "ordinal_confirmed", "continuous": "ordinal_continuous"}


def marker_ordinals(markers: DataFrame) -> DataFrame:
    """Row ordinals in three forms; 0 means none.

    Provisional counts gap stages from their first design marker on, confirmed
    from their first ``MID`` on. Continuous spreads the confirmed number over
    the whole gap stage once a later row of the well lies outside it. Numbers
    are found on one row per gap stage.
    """
    stage = markers.groupBy(*STAGE).agg(
        F.min(F.when(F.col("substage").isin(DESIGN_MARKERS), F.col(TIME))).alias("_design_at"),
        F.min(F.when(F.col("substage") == "MID", F.col(TIME))).alias("_mid_at"),
    )
    line = Window.partitionBy("name").orderBy("stage_num_td")
    upto = line.rowsBetween(Window.unboundedPreceding, 0)
    numbered = stage.select(
        *STAGE, "_design_at", "_mid_at",
        F.count("_design_at").over(upto).alias("_design_no"),
        F.count("_mid_at").over(upto).alias("_mid_no"),
        F.lead("stage_num_td").over(line).isNotNull().alias("_closed"),
    )
    rows = markers.join(numbered, STAGE)

    def from_mark(mark: str, number: str):
        return F.when(F.col(TIME) >= F.col(mark), F.col(number)).otherwise(0).cast("bigint")

    return rows.select(
        *markers.columns,
        from_mark("_design_at", "_design_no").alias("ordinal_provisional"),
        from_mark("_mid_at", "_mid_no").alias("ordinal_confirmed"),
        F.when(F.col("_closed") & F.col("_mid_at").isNotNull(), F.col("_mid_no")).otherwise(0).cast("bigint").alias("ordinal_continuous"),
    )


def ordinal_windows(rows: DataFrame, telemetry: DataFrame, layer: str) -> DataFrame:
    """Windows of one ordinal layer, with the measures of the readings inside them.

    A window is closed when a higher ordinal exists for the well; windows of
    the continuous layer always are.
    """
    ordinal = LAYERS[layer]
    windows = rows.where(F.col(ordinal) > 0).groupBy("name", F.col(ordinal).alias("ordinal")).agg(
        F.min(TIME).alias("stage_start_ts"), F.max(TIME).alias("stage_end_ts"), F.count(F.lit(1)).alias("sample_count")
    )
    highest = windows.groupBy("name").agg(F.max("ordinal").alias("_highest"))
    inside = interval_join(telemetry.select("name", "record_ts", "rate_slurry", "press_mainline"), windows.select("name", "ordinal", "stage_start_ts", "stage_end_ts"), "record_ts", "stage_start_ts", "stage_end_ts")
    measured = inside.groupBy("name", "ordinal").agg(
        F.avg("rate_slurry").alias("avg_rate_slurry"), F.max("rate_slurry").alias("max_rate_slurry"),
        F.avg("press_mainline").alias("avg_press_mainline"), F.max("press_mainline").alias("max_press_mainline"),
    )
    closed = F.lit(True) if layer == "continuous" else F.col("ordinal") < F.col("_highest")
    return (
        windows.join(highest, "name")
        .join(measured, ["name", "ordinal"], "left")
        .withColumn("is_closed", closed)
        .withColumn("stage_layer", F.lit(layer))
        .drop("_highest")
    )
