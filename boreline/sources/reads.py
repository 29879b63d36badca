"""Bounded, incremental and resumable reads."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.clean import ALL, UNKNOWN, blank_to
from ..functions.numbers import MICROS, micros, slot, slot_start
from ..operators.ordered import SLOT, prefix_sums

# How far back each mode reads, in hours.
MODE_HOURS = {"live": 6, "incremental": 72, "historical": None, "rebuild": None}


def time_literal(ts: datetime | str) -> Column:
    return F.lit(str(ts)).cast("timestamp_ntz")


def optional_filters(
    df: DataFrame,
    fleet: str | None = None,
    pad: str | None = None,
    well: str | None = None,
    stage: float | None = None,
    stage_col: str = "stage_num_td",
) -> DataFrame:
    """Filter only on what the caller set.

    Null, empty text, the "all" mark and a negative stage mean no filter; a
    filter that is not set never reaches the plan.
    """
    for column, value in (("fleet_name", fleet), ("pad_name", pad)):
        if value not in (None, "", ALL):
            if value == UNKNOWN:
                df = df.where(blank_to(column) == value)
            else:
                df = df.where(F.col(column) == value)
    if well not in (None, "", ALL):
        df = df.where(F.col("name") == well)
    if stage is not None and stage >= 0:
        df = df.where(F.col(stage_col) == F.lit(stage))
    return df


CURSOR = ["created_ts", "record_ts", "name", "id"]


def incremental_scan(df: DataFrame, after: datetime | str | tuple | None, limit: int | None = None) -> DataFrame:
    """Rows created after the checkpoint, oldest first.

    A time as checkpoint is inclusive, since rows may share it; the keyed
    upsert makes reading one twice harmless. The cursor of a page, from
    ``next_cursor``, is exclusive: creation time, record time, well and row id,
    so a limited scan gets past any number of rows of one time. Rows equal in
    all four are one row to it. No checkpoint means from the start.
    """
    rows = df.where(F.col("name").isNotNull() & F.col("record_ts").isNotNull() & F.col("created_ts").isNotNull())
    order = [c for c in CURSOR if c in df.columns]
    if isinstance(after, tuple):
        created, record, *rest = after
        values = [time_literal(created), time_literal(record), *map(F.lit, rest)][: len(order)]
        rows = rows.where((F.col("created_ts") >= values[0]) & (F.struct(*order) > F.struct(*(v.alias(c) for v, c in zip(values, order)))))
    elif after is not None:
        rows = rows.where(F.col("created_ts") >= time_literal(after))
    if limit is None:
        return rows
    end = _batch_end(rows, limit)
    if end is not None:
        rows = rows.where(F.col("created_ts") < time_literal(end))
    return rows.orderBy(*order).limit(limit)


def next_cursor(page: DataFrame) -> tuple | None:
    """Where the scan after this page starts; null for an empty page, after which nothing is left."""
    order = [c for c in CURSOR if c in page.columns]
    last = page.agg(F.max(F.struct(*order)).alias("last")).first()["last"]
    return None if last is None else tuple(last)


def _batch_end(rows: DataFrame, limit: int) -> datetime | None:
    """Time by which ``limit`` rows were created, found on counts per minute.

    Without it every task of a large scan would hand ``limit`` rows to the one
    task that merges them.
    """
    minutes = rows.groupBy(slot_start("created_ts", 60).alias("minute")).agg(F.count(F.lit(1)).alias("n"))
    days = minutes.withColumn(SLOT, slot("minute", 86_400))
    counted = prefix_sums(days, [], ["minute"], {"so_far": F.col("n")}, SLOT)
    full = counted.where(F.col("so_far") >= limit).agg(F.min("minute")).first()[0]
    return None if full is None else full + timedelta(minutes=1)


def source_bounds(df: DataFrame, *by: str) -> DataFrame:
    """First and last event time of each scope that has rows."""
    timed = df.where(F.col("record_ts").isNotNull())
    return (
        timed.groupBy(*by)
        .agg(F.min("record_ts").alias("start_time"), F.max("record_ts").alias("end_time"))
        .where(F.col("start_time").isNotNull())
    )


def resume_entities(df: DataFrame, after: str | None, limit: int) -> DataFrame:
    """Next page of distinct entity names above a cursor."""
    names = df.select("name").where(F.col("name").isNotNull())
    if after:
        names = names.where(F.col("name") > after)
    return names.distinct().orderBy("name").limit(limit)


def work_batch(df: DataFrame, keys: list[str], limit: int) -> DataFrame:
    """The first ``limit`` keys in order; ``has_more`` says whether others are left.

    One key more than asked for is taken; at most that many rows are counted.
    """
    batch = df.select(*keys).orderBy(*keys).limit(limit + 1)
    every = Window.partitionBy(F.lit(1))
    counted = batch.withColumn("_place", F.row_number().over(every.orderBy(*keys))).withColumn("has_more", F.count(F.lit(1)).over(every) > limit)
    return counted.where(F.col("_place") <= limit).drop("_place")


def backfill_chunks(bounds: DataFrame, chunk_hours: int, bucket_seconds: int, max_chunks: int | None = None, cursor: DataFrame | None = None) -> DataFrame:
    """Chunks that cover each scope's bounds, aligned outward to whole buckets.

    ``bounds`` has ``start_time`` and ``end_time``; both ends are widened to
    bucket edges so that no bucket is ever computed from part of its rows.
    With ``max_chunks`` each scope gets that many, and every row tells in
    ``resume_at`` where the scope's next page starts (null: nothing is left).
    ``cursor`` has the scope's columns and that value; scopes with a null one
    are done, scopes it does not know start at their beginning.
    """
    width = bucket_seconds * MICROS
    step = F.make_dt_interval(F.lit(0), F.lit(max(int(chunk_hours), 1)))
    last = F.timestamp_micros(micros(slot_start("end_time", bucket_seconds)) + F.lit(width)).cast("timestamp_ntz")
    aligned = bounds.withColumn("_from", slot_start("start_time", bucket_seconds)).withColumn("_to", last)
    if cursor is not None:
        scope = [c for c in cursor.columns if c != "resume_at"]
        known = cursor.select(*scope, "resume_at", F.lit(True).alias("_known"))
        aligned = aligned.join(known, scope, "left").where(F.col("_known").isNull() | F.col("resume_at").isNotNull())
        aligned = aligned.withColumn("_from", F.coalesce("resume_at", "_from")).drop("resume_at", "_known")
    chunks = aligned.withColumn("_starts", F.sequence("_from", F.col("_to") - F.make_dt_interval(secs=F.lit(0.000001)), step))
    paged = []
    if max_chunks is not None:
        most = max(int(max_chunks), 1)
        chunks = chunks.withColumn("resume_at", F.get("_starts", F.lit(most))).withColumn("_starts", F.slice("_starts", 1, most))
        paged = ["resume_at"]
    keep = [c for c in bounds.columns if c not in ("start_time", "end_time")]
    return chunks.select(*keep, *paged, "_to", F.posexplode("_starts").alias("chunk_no", "chunk_start")).select(
        *keep, F.col("chunk_no").cast("bigint").alias("chunk_no"), "chunk_start", F.least(F.col("chunk_start") + step, F.col("_to")).alias("chunk_end"), *paged
    )


def mode_bounded_read(df: DataFrame, mode: str, now: datetime, ts: str = "record_ts") -> DataFrame:
    """Rows within the look-back of the mode."""
    hours = MODE_HOURS[mode]
    if hours is None:
        return df
    return df.where(F.col(ts) >= time_literal(now - timedelta(hours=hours)))


def key_list(spark: SparkSession, names: list[str]) -> DataFrame:
    return spark.createDataFrame([(n,) for n in names], "name string")


def key_list_join(df: DataFrame, keys: DataFrame) -> DataFrame:
    """Rows whose entity is in the key list; Spark broadcasts the list when it is small."""
    return df.join(keys.select("name").distinct(), "name", "left_semi")
