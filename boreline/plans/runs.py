"""Runs that are taken up again: wells whose sources changed, and a roll-up back-fill, page by page.

A run takes a bounded batch of what is due, makes its results, and commits
them together with what says that they are done: a manifest of source
signatures, or a cursor. A run that dies changes nothing; called again and
again until nothing is due, runs end where one pass over everything ends.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.types import _parse_datatype_string

from ..operators import rollup
from ..session import stored
from ..sources import reads, signatures
from ..sources.writes import Change, commit_tables, read_table

MANIFEST = "name string, algorithm_version string, source_signature string, source_rows bigint, processed_at timestamp_ntz, folder string"
CURSOR = "scope string, resume_at timestamp_ntz, part string"
#: Folders of tables that are kept by well.
FOLDERS = 16


def by_folder(df: DataFrame) -> DataFrame:
    return df.withColumn("folder", F.pmod(F.xxhash64("name"), F.lit(FOLDERS)).cast("string"))


def well_signatures(rows: DataFrame, columns: list[str], version: str) -> DataFrame:
    """``name, source_signature, source_rows`` of each well's rows, in whatever order they are."""
    tree = signatures.signature_tree(rows.where(F.col("name").isNotNull()), ["name"], columns).where(F.col("level") == 1)
    return tree.select("name", signatures.source_signature(tree, version, signatures.TREE).alias("source_signature"), F.col("rows").alias("source_rows"))


def run_manifest(spark: SparkSession, root: str) -> DataFrame:
    return read_table(spark, root, "manifest", _parse_datatype_string(MANIFEST), "folder").drop("folder")


def due_wells(spark: SparkSession, root: str, rows: DataFrame, columns: list[str], version: str) -> DataFrame:
    """Wells that have no results of this version, or whose rows have changed since."""
    signed = well_signatures(rows, columns, version)
    done = run_manifest(spark, root).where(F.col("algorithm_version") == version).select("name", "source_signature")
    return signed.join(done, ["name", "source_signature"], "left_anti")


def run_changed_wells(
    spark: SparkSession, root: str, rows: DataFrame, columns: list[str], compute: Callable[[DataFrame, DataFrame], dict[str, DataFrame]], version: str, now: str, max_wells: int
) -> bool:
    """Make the results of the next ``max_wells`` due wells again and replace them; tells whether more are due.

    ``compute`` gets the wells' rows and their names, and returns tables with a
    ``name``. All tables and the manifest become valid by one commit. A well
    for which a table has no rows keeps its old ones there.
    """
    due = due_wells(spark, root, rows, columns, version)
    batch = stored(reads.work_batch(due, ["name"], max_wells).join(due, "name"), "due-wells")
    first = batch.select("has_more").first()
    if first is None:
        return False
    names = batch.select("name")
    tables = compute(rows.join(names, "name", "left_semi"), names)
    changes = {t: Change(by_folder(df), ("name",), "folder") for t, df in tables.items()}
    done = batch.select("name", F.lit(version).alias("algorithm_version"), "source_signature", "source_rows", reads.time_literal(now).alias("processed_at"))
    commit_tables(spark, root, {**changes, "manifest": Change(by_folder(done), ("name",), "folder")})
    return first["has_more"]


def read_run(spark: SparkSession, root: str, table: str, schema: T.StructType) -> DataFrame:
    """A table of results; ``schema`` is that of what ``compute`` returned."""
    plain = T.StructType([T.StructField(f.name, f.dataType) for f in schema])
    return read_table(spark, root, table, T.StructType([*plain, T.StructField("folder", T.StringType())]), "folder").drop("folder")


def run_backfill(spark: SparkSession, root: str, rows: DataFrame, bucket_seconds: int, chunk_hours: int, max_chunks: int) -> bool:
    """Roll up the next ``max_chunks`` chunks of the readings' time and move the cursor; tells whether chunks are left.

    Chunks are whole buckets wide, so no bucket is made from part of its rows.
    """
    known = read_table(spark, root, "cursor", _parse_datatype_string(CURSOR), "part").select("scope", "resume_at")
    bounds = reads.source_bounds(rows).withColumn("scope", F.lit("all"))
    chunks = stored(reads.backfill_chunks(bounds, chunk_hours, bucket_seconds, max_chunks, known), "chunks")
    span = chunks.agg(F.min("chunk_start"), F.max("chunk_end"), F.max("resume_at")).first()
    if span[0] is None:
        return False
    t = F.col("record_ts")
    own = rows.where((t >= reads.time_literal(span[0])) & (t < reads.time_literal(span[1])))
    buckets = rollup.tumbling_rollup(own, bucket_seconds).withColumn("day", F.date_format("bucket_ts", "yyyy-MM-dd"))
    at = spark.range(1).select(F.lit("all").alias("scope"), F.lit(span[2]).cast("timestamp_ntz").alias("resume_at"), F.lit("all").alias("part"))
    commit_tables(spark, root, {"buckets": Change(buckets, ("bucket_seconds", "bucket_ts", "name"), "day"), "cursor": Change(at, ("scope",), "part")})
    return span[2] is not None


def read_buckets(spark: SparkSession, root: str, feed: T.StructType) -> DataFrame:
    shape = rollup.tumbling_rollup(spark.createDataFrame([], feed), 1).schema
    return read_table(spark, root, "buckets", T.StructType([*shape.fields, T.StructField("day", T.StringType())]), "day").drop("day")
