"""Live ingest and a live roll-up.

Outputs are keyed upserts, so a batch that is replayed after a failure
overwrites its own rows and nothing is counted twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import _parse_datatype_string

from ..functions.numbers import slot_start
from ..operators import joins
from ..operators import rollup as batch_rollup
from ..session import stored
from ..sources.writes import Change, commit_tables, prune_folder, prune_tables, read_folder, read_table, upsert_folder

READING_KEY = ["created_ts", "record_ts", "name"]
NEWEST = "record_ts timestamp_ntz, part string"


def read_feed(spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int | None = None) -> DataFrame:
    """Parquet files as a stream; the limit on files bounds a batch."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def _drain(stream: DataFrame, checkpoint: str, handle, mode: str = "append", every: str | None = None) -> StreamingQuery:
    def once(batch: DataFrame, number: int) -> None:
        batch.persist()  # a handler runs several jobs over its batch
        try:
            handle(batch, number)
        finally:
            batch.unpersist()

    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(once)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def ingest(stream: DataFrame, root: str, keys: list[str], order: list[str], day_format: str = "yyyy-MM-dd", every: str | None = None) -> StreamingQuery:
    """Upsert every batch into the merged readings, which are stored by day.

    Only the days a batch touches are rewritten; a finer ``day_format`` makes
    those folders smaller. Among rows of one key the newest batch wins, and
    within a batch the last by ``order``; replaying a batch changes nothing.
    Versions that were out of date before the batch are deleted.
    """

    def handle(batch: DataFrame, number: int) -> None:
        keyed = batch.where(F.col("name").isNotNull() & F.col("record_ts").isNotNull()).withColumn("day", F.date_format("record_ts", day_format))
        upsert_folder(batch.sparkSession, f"{root}/readings", keyed, keys, "day", order)
        prune_folder(batch.sparkSession, f"{root}/readings", keyed.schema, "day", behind=1)

    return _drain(stream, f"{root}/checkpoint", handle, every=every)


def merged_rows(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    return read_folder(spark, f"{root}/readings", T.StructType([*schema.fields, T.StructField("day", T.StringType())]), "day").drop("day")


LATE = "batch bigint, name string, bucket_ts timestamp_ntz, readings bigint, day string"


def _bucket_day(column: str = "bucket_ts") -> Column:
    return F.date_format(column, "yyyy-MM-dd")


def apply_buckets(spark: SparkSession, root: str, batch: DataFrame, bucket_seconds: int, late_seconds: float, number: int = 0) -> None:
    """One batch of readings into the stored readings and their buckets, by one commit.

    A batch makes the (bucket, well) pairs that it has readings of dirty; these
    are rolled up again from their stored readings, however old they are, and
    take the place of what they were. Of the readings only the days of dirty
    buckets are read. Pairs that are ``late_seconds`` behind the newest reading
    there was before the batch are listed with their number of readings.
    """
    rows = stored(batch.where(F.col("name").isNotNull() & F.col("record_ts").isNotNull()).withColumn("day", F.date_format("record_ts", "yyyy-MM-dd")), "bucket-batch")
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in rows.schema])
    history = read_table(spark, root, "readings", schema, "day")
    dirty = stored(rows.groupBy(slot_start("record_ts", bucket_seconds).alias("bucket_ts"), "name").agg(F.count(F.lit(1)).alias("readings")), "dirty-buckets")
    ends = F.array("bucket_ts", F.col("bucket_ts") + F.make_dt_interval(secs=F.lit(float(bucket_seconds))))
    days = dirty.select(F.explode(F.transform(F.sequence(F.to_date(ends[0]), F.to_date(ends[1])), lambda d: F.date_format(d, "yyyy-MM-dd"))).alias("day")).distinct()
    touched = history.join(days, "day", "left_semi").withColumn("bucket_ts", slot_start("record_ts", bucket_seconds))
    old = touched.join(dirty, ["bucket_ts", "name"], "left_semi").select(*rows.columns)
    buckets = batch_rollup.tumbling_rollup(joins.keep_last(old, joins.latest_per_key(rows, READING_KEY, [*READING_KEY, "id"]), READING_KEY), bucket_seconds)
    newest = read_table(spark, root, "newest", _parse_datatype_string(NEWEST), "part").agg(F.max("record_ts")).first()[0]
    changes = {
        "readings": Change(rows, tuple(READING_KEY), "day", (*READING_KEY, "id")),
        "buckets": Change(buckets.withColumn("day", _bucket_day()), ("bucket_seconds", "bucket_ts", "name"), "day"),
        "newest": Change(rows.agg(F.greatest(F.max("record_ts"), F.lit(newest).cast("timestamp_ntz")).alias("record_ts")).withColumn("part", F.lit("all")), ("part",), "part"),
    }
    if newest is not None:
        behind = F.col("bucket_ts") < F.lit(newest).cast("timestamp_ntz") - F.make_dt_interval(secs=F.lit(float(late_seconds)))
        late = dirty.where(behind).select(F.lit(number).cast("bigint").alias("batch"), "name", "bucket_ts", "readings", _bucket_day().alias("day"))
        changes["late"] = Change(late, ("batch", "name", "bucket_ts"), "day")
    commit_tables(spark, root, changes)


def rollup(stream: DataFrame, root: str, bucket_seconds: int, late_seconds: float, every: str | None = None) -> StreamingQuery:
    """Time buckets kept current, with every column of the batch roll-up; no reading is too old to count.

    Read them with ``current_buckets``, and with ``late_buckets`` those that
    came more than ``late_seconds`` late. Resent readings take the place of
    the stored ones and replayed batches change nothing.
    """

    def handle(batch: DataFrame, number: int) -> None:
        if not batch.isEmpty():
            apply_buckets(batch.sparkSession, root, batch, bucket_seconds, late_seconds, number)
            prune_tables(batch.sparkSession, root)

    return _drain(stream, f"{root}/checkpoint", handle, every=every)


def current_buckets(spark: SparkSession, root: str, feed: T.StructType) -> DataFrame:
    """The buckets as they stand; ``feed`` is the schema of the readings."""
    shape = batch_rollup.tumbling_rollup(spark.createDataFrame([], feed), 1).schema
    return read_table(spark, root, "buckets", T.StructType([*shape.fields, T.StructField("day", T.StringType())]), "day").drop("day")


def late_buckets(spark: SparkSession, root: str) -> DataFrame:
    """``batch, name, bucket_ts, readings`` of what came late."""
    return read_table(spark, root, "late", _parse_datatype_string(LATE), "day").drop("day")
