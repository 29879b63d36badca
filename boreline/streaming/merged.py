"""One live stream: readings, stages, labels and wells, brought up to date by one commit per micro-batch.

A micro-batch goes through the live flow on the tables as they were committed
last, and what it changes in any of them becomes valid at once. A batch that
died half-way, or that is sent again, finds the tables as they were before, or
with its own rows in them; either way they end the same.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators import rollup, stages
from ..operators.anomaly import TIME
from ..operators.labelling import Labeller
from ..plans import flows
from ..session import stored
from ..sources.writes import Change, commit_tables, prune_tables, read_table

#: Folders of the tables that are kept by well.
FOLDERS = 16


def _folder(df: DataFrame) -> DataFrame:
    return df.withColumn("folder", F.pmod(F.xxhash64("name"), F.lit(FOLDERS)).cast("string"))


def _shape(spark: SparkSession, table: str, feed: T.StructType) -> tuple[T.StructType, str]:
    """Schema and partition of a table; ``feed`` is the schema of the readings."""
    empty = spark.createDataFrame([], feed)
    if table == "readings":
        return T.StructType([*feed.fields, T.StructField("day", T.StringType())]), "day"
    if table == "windows":
        return _folder(stages.stage_windows(empty, 1)).schema, "folder"
    if table == "wells":
        return _folder(rollup.well_index(empty)).schema, "folder"
    ready = empty.select("name", F.lit(0).cast("bigint").alias("stage_num_td"), F.col("record_ts").alias(TIME), *stages.WINDOW_MEASURES)
    labels = ready.withColumns({"inferred_design_rate": F.lit(0.0), "inferred_pressure": F.lit(0.0), "substage": F.lit(""), "day": F.lit("")})
    return T.StructType([T.StructField(f.name, f.dataType) for f in labels.schema]), "day"


def read_live(spark: SparkSession, root: str, table: str, feed: T.StructType) -> DataFrame:
    """``readings``, ``windows``, ``labels`` or ``wells`` as of the last commit."""
    schema, partition = _shape(spark, table, feed)
    return read_table(spark, root, table, schema, partition).drop(partition)


def apply_live(spark: SparkSession, root: str, batch: DataFrame, gap_seconds: float, marker: Labeller, labeller: Labeller, day_format: str = "yyyy-MM-dd") -> None:
    """One batch of readings into all four tables.

    Resent readings take the place of the stored ones, late ones are placed or
    have their well cut again. Windows of a well are replaced together, labels
    by well and time, and readings by their key, so labels of windows that did
    not change are neither read nor written but for the days they share.
    """
    batch = stored(batch.where(F.col("name").isNotNull() & F.col("record_ts").isNotNull()), "live-batch")
    feed = batch.schema
    now = {name: read_live(spark, root, name, feed) for name in ("readings", "windows")}
    # Windows of the batch's wells are all that the step can change.
    names = batch.select("name").distinct()
    windows = stored(now["windows"].join(names, "name", "left_semi"), "live-windows")
    own = now["readings"].join(names, "name", "left_semi")
    step = flows.live_stage_flow(own, batch, windows, gap_seconds, marker, labeller)
    after = step["windows"].select(*windows.columns)
    labels = step["labels"].withColumn("day", F.date_format(TIME, day_format))
    key = tuple(flows.READING_KEY)
    wells = rollup.well_index(flows.one_per_key(own, batch))
    commit_tables(
        spark,
        root,
        {
            "readings": Change(batch.withColumn("day", F.date_format("record_ts", day_format)), key, "day", (*key, "id")),
            "windows": Change(_folder(after), ("name",), "folder"),
            "labels": Change(labels, ("name", TIME), "day"),
            "wells": Change(_folder(wells), ("name",), "folder"),
        },
    )


def live_tables(stream: DataFrame, root: str, gap_seconds: float, marker: Labeller, labeller: Labeller, day_format: str = "yyyy-MM-dd", every: str | None = None) -> StreamingQuery:
    """Keep the four tables below ``root`` from a stream of readings; read them with ``read_live``."""

    def handle(batch: DataFrame, number: int) -> None:
        if not batch.isEmpty():
            apply_live(batch.sparkSession, root, batch, gap_seconds, marker, labeller, day_format)
            prune_tables(batch.sparkSession, root)

    writer = stream.writeStream.option("checkpointLocation", f"{root}/checkpoint").foreachBatch(handle)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()
