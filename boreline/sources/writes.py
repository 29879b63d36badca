"""Keyed and run-versioned writes on Parquet folders.

A folder is partitioned by a column that new rows touch only in part (a day, a
run), so an upsert reads and rewrites just the touched partitions. Keyed
tables keep versions of a partition and a table of commits that says which is
valid; runs replace their own partition only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.types import _parse_datatype_string

from ..operators.joins import keep_last, latest_per_key
from ..session import remove_path, stored


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The stored table, or an empty frame before its first write."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def overwrite_partitions(df: DataFrame, path: str, *partition_by: str) -> None:
    """Replace exactly the partitions that ``df`` has rows for.

    The rebalance hint lets AQE split a partition that is too large for one
    writer and gather the small ones.
    """
    df.hint("rebalance", *partition_by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)


def upsert_by_key(old: DataFrame | None, new: DataFrame, keys: list[str], order: list[str] | None = None) -> DataFrame:
    """Old rows whose key is not in ``new``, and one new row per key; without an old table the new rows alone."""
    fresh = latest_per_key(new, keys, order) if order else new
    return fresh if old is None else keep_last(old, fresh, keys, unique=bool(order))


def read_folder(spark: SparkSession, path: str, schema: T.StructType, partition: str) -> DataFrame:
    """A table kept by ``upsert_folder``: of each partition the rows of its newest committed version."""
    field = schema[partition]
    commits = read_or_empty(spark, f"{path}/commits", T.StructType([field, T.StructField("version", T.LongType())]))
    live = commits.groupBy(partition).agg(F.max("version").alias("version"))
    data = read_or_empty(spark, f"{path}/data", T.StructType([*[f for f in schema.fields if f.name != partition], T.StructField("version", T.LongType()), field]))
    return data.join(live, [partition, "version"], "left_semi").select(*schema.names)


def upsert_folder(spark: SparkSession, path: str, new: DataFrame, keys: list[str], partition: str, order: list[str] | None = None) -> None:
    """Upsert into a table kept by partition, which must follow from the key.

    The touched partitions are written whole under a new version; a small
    table of commits, written last, makes them the valid ones. Nothing that a
    reader may see is overwritten, so a crash at any point leaves the table as
    it was, and a replay writes the same version again. One writer at a time.
    ``new`` is evaluated once. The range of touched partitions is looked up
    first (one row), so only those are read of the old table.
    """
    new = stored(new, "upsert")
    lo, hi = new.agg(F.min(partition), F.max(partition)).first()
    if lo is None:
        return
    last = read_or_empty(spark, f"{path}/commits", T.StructType([new.schema[partition], T.StructField("version", T.LongType())])).agg(F.max("version")).first()[0]
    version = 0 if last is None else last + 1
    touched = new.select(partition).distinct()
    old = None
    if last is not None:
        old = read_folder(spark, path, new.schema, partition).where(F.col(partition).between(F.lit(lo), F.lit(hi))).join(touched, partition, "left_semi")
    merged = upsert_by_key(old, new, keys, order)
    merged.hint("rebalance", partition).write.mode("overwrite").partitionBy(partition).parquet(f"{path}/data/version={version}")
    touched.coalesce(1).write.mode("overwrite").parquet(f"{path}/commits/version={version}")


@dataclass(frozen=True)
class Change:
    """New rows of one table: one row per key replaces the old ones with that key. With ``order`` the last of a key counts, without it all."""

    rows: DataFrame
    keys: tuple[str, ...]
    partition: str
    order: tuple[str, ...] = ()


COMMITS = "table string, part string, version bigint"


def read_table(spark: SparkSession, root: str, table: str, schema: T.StructType, partition: str) -> DataFrame:
    """A table kept by ``commit_tables`` as of the last commit."""
    commits = read_or_empty(spark, f"{root}/commits", _parse_datatype_string(COMMITS)).where(F.col("table") == table)
    live = commits.groupBy(F.col("part").alias(partition)).agg(F.max("version").alias("version"))
    data = read_or_empty(spark, f"{root}/{table}/data", T.StructType([*[f for f in schema.fields if f.name != partition], T.StructField("version", T.LongType()), schema[partition]]))
    return data.join(live, [partition, "version"], "left_semi").select(*schema.names)


def commit_tables(spark: SparkSession, root: str, changes: dict[str, Change]) -> None:
    """Upsert into several tables below ``root`` by one commit.

    Each table's touched partitions are written whole under a new version. One
    small file, written last, makes the partitions of all tables the valid
    ones: readers see all of the changes or none, a crash at any point leaves
    the tables as they were, and a replay writes the same version again.
    Partitions are strings. One writer at a time.
    """
    last = read_or_empty(spark, f"{root}/commits", _parse_datatype_string(COMMITS)).agg(F.max("version")).first()[0]
    version = 0 if last is None else last + 1
    touched = None
    for table, change in changes.items():
        new = stored(change.rows, f"commit-{table}")
        parts = new.select(change.partition).distinct()
        old = None if last is None else read_table(spark, root, table, new.schema, change.partition).join(parts, change.partition, "left_semi")
        merged = upsert_by_key(old, new, list(change.keys), list(change.order) or None)
        merged.hint("rebalance", change.partition).write.mode("overwrite").partitionBy(change.partition).parquet(f"{root}/{table}/data/version={version}")
        named = parts.select(F.lit(table).alias("table"), F.col(change.partition).alias("part"))
        touched = named if touched is None else touched.unionByName(named)
    touched.coalesce(1).write.mode("overwrite").parquet(f"{root}/commits/version={version}")


def prune_tables(spark: SparkSession, root: str, behind: int = 1) -> None:
    """Delete the data of versions that none of the last ``behind`` + 1 commits needs."""
    commits = read_or_empty(spark, f"{root}/commits", _parse_datatype_string(COMMITS)).cache()
    last = commits.agg(F.max("version")).first()[0]
    needed = None
    for back in range(behind + 1):
        then = commits.where(F.col("version") <= F.lit(last) - back).groupBy("table", "part").agg(F.max("version").alias("version")).select("table", "version")
        needed = then if needed is None else needed.union(then)
    needed = needed.distinct()
    for row in commits.select("table", "version").distinct().join(needed, ["table", "version"], "left_anti").toLocalIterator():
        remove_path(spark, f"{root}/{row.table}/data/version={row.version}")
    for row in commits.select("version").distinct().join(needed.select("version"), "version", "left_anti").toLocalIterator():
        remove_path(spark, f"{root}/commits/version={row.version}")
    commits.unpersist()


def prune_folder(spark: SparkSession, path: str, schema: T.StructType, partition: str, behind: int = 0) -> None:
    """Delete the versions of which no partition is the newest any more.

    ``behind`` keeps what was newest that many versions ago too, for readers
    that began before the last writes; with 0 no reader may be at work.
    """
    commits = read_or_empty(spark, f"{path}/commits", T.StructType([schema[partition], T.StructField("version", T.LongType())])).cache()
    last = commits.agg(F.max("version")).first()[0]
    newest = None
    for back in range(behind + 1):
        then = commits.where(F.col("version") <= F.lit(last) - back).groupBy(partition).agg(F.max("version").alias("version")).select("version")
        newest = then if newest is None else newest.union(then)
    # Versions, not rows: as many as writes since the last pruning.
    for row in commits.select("version").distinct().join(newest.distinct(), "version", "left_anti").toLocalIterator():
        remove_path(spark, f"{path}/commits/version={row.version}")
        remove_path(spark, f"{path}/data/version={row.version}")
    commits.unpersist()


def replace_entity(old: DataFrame, new: DataFrame, entity: str = "name") -> DataFrame:
    """All rows of the entities in ``new`` are replaced by the new ones.

    An entity without new rows keeps its old rows: an empty replacement never
    deletes.
    """
    return keep_last(old, new, [entity])


def replace_entity_range(old: DataFrame, new: DataFrame, ts: str, entity: str = "name") -> DataFrame:
    """Like ``replace_entity``, but only from each entity's first new row on."""
    since = new.groupBy(entity).agg(F.min(ts).alias("_since"))
    kept = old.join(since, entity, "left").where(F.col("_since").isNull() | (F.col(ts) < F.col("_since"))).drop("_since")
    return kept.unionByName(new, allowMissingColumns=True)


def append_run(df: DataFrame, path: str, run: str = "processing_run_id") -> None:
    """Write the rows of a run; a run that is retried replaces its own rows, other runs are never changed."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(run).parquet(path)


def publish_run(tables: dict[str, DataFrame], manifest: DataFrame, root: str, manifest_run: str = "active_run_id") -> None:
    """Write a run's tables, then its manifest rows, in that order.

    Readers go through the manifest, so a run that stopped half-way is never
    seen. The manifest is stored per run; the newest row of a key wins.
    """
    for name, df in tables.items():
        append_run(df, f"{root}/{name}")
    append_run(manifest, f"{root}/manifest", manifest_run)


def current_manifest(spark: SparkSession, root: str, schema: T.StructType, keys: list[str], order: list[str]) -> DataFrame:
    return latest_per_key(read_or_empty(spark, f"{root}/manifest", schema), keys, order)
