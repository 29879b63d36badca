"""Equi joins, visibility through a manifest, and one-row-per-key choices."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.display import SUBSTAGES


def attach_labels(telemetry: DataFrame, labels: DataFrame, with_stage: bool = False) -> DataFrame:
    """Left join of labels on (name, time), or on (name, stage, time)."""
    right = labels.withColumnRenamed("datetime_fmt", "record_ts")
    keys = ["name", "stage_num_td", "record_ts"] if with_stage else ["name", "record_ts"]
    return telemetry.join(right, keys, "left")


def active_runs(results: DataFrame, manifest: DataFrame, version: str | None = None) -> DataFrame:
    """Results of the runs the manifest names as active.

    Matched on run, name, stage and version. Spark picks the join from the
    manifest's size; it is not forced to a broadcast.
    """
    live = manifest.where(F.col("status") == "active")
    if version is not None:
        live = live.where(F.col("algorithm_version") == version)
    keys = live.select(F.col("active_run_id").alias("processing_run_id"), "name", "stage_num_td", "algorithm_version")
    return results.join(keys, ["processing_run_id", "name", "stage_num_td", "algorithm_version"], "left_semi")


def changed_candidates(stages: DataFrame, manifest: DataFrame, compare: dict[str, str], force: bool = False) -> DataFrame:
    """Stages the manifest lacks or holds with other source values.

    ``compare`` maps a stage column to its manifest column; they are compared
    null-safely. ``force`` keeps every stage.
    """
    known = manifest.select("name", "stage_num_td", F.lit(True).alias("_known"), *[F.col(m).alias(f"_m_{s}") for s, m in compare.items()])
    joined = stages.join(known, ["name", "stage_num_td"], "left")
    if not force:
        differs: Column = F.col("_known").isNull()
        for s in compare:
            differs = differs | ~F.col(s).eqNullSafe(F.col(f"_m_{s}"))
        joined = joined.where(differs)
    return joined.drop("_known", *[f"_m_{s}" for s in compare])


def catalog_counts(counts: DataFrame, code: str, count: str) -> DataFrame:
    """The fixed label catalogue with its counts, zero where absent."""
    catalog = counts.sparkSession.createDataFrame(SUBSTAGES, "sort_order int, substage_key string, substage_label string")
    right = counts.select(F.col(code).alias("substage_key"), F.col(count).alias("_count"))
    return catalog.join(right, "substage_key", "left").select(
        "sort_order", "substage_key", "substage_label", F.coalesce("_count", F.lit(0)).cast("bigint").alias(count)
    )


def with_scalar(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Put the columns of a one-row aggregate on every row."""
    return df.crossJoin(F.broadcast(one_row))


def metadata_merge(df: DataFrame, metadata: DataFrame, keys: list[str], prefer: list[str]) -> DataFrame:
    """Left join of one metadata row per key; among duplicates the first by ``prefer`` is taken."""
    return df.join(latest_per_key(metadata, keys, prefer, newest=False), keys, "left")


def latest_per_key(df: DataFrame, keys: list[str], order: list[str], newest: bool = True) -> DataFrame:
    """One row per key, the last (or first) by ``order``.

    An aggregate, not a window: copies of a key are reduced before the
    shuffle, however many there are.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    ordering = [c for c in order if c not in keys]
    pick = F.max if newest else F.min
    row = pick(F.struct(*ordering, *rest)).alias("_row")
    return df.groupBy(*keys).agg(row).select(*[F.col(c) if c in keys else F.col("_row")[c].alias(c) for c in df.columns])


def keep_last(old: DataFrame, new: DataFrame, keys: list[str], unique: bool = False) -> DataFrame:
    """Union of old and new rows; a new row replaces the old one of its key. Nulls of a key are equal.

    ``unique`` says that ``new`` has each key once, which saves making its keys distinct.
    """
    fresh = new.select(*[F.col(k).alias(f"_new_{k}") for k in keys])
    fresh = fresh if unique else fresh.distinct()
    same = functools.reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_new_{k}")) for k in keys])
    return old.join(fresh, same, "left_anti").unionByName(new, allowMissingColumns=True)


def first_last(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """First and last value per key by record time; equal times go by creation time, nulls last both ways."""
    created = F.col("created_ts")
    forward = F.struct("record_ts", created.isNull(), created, "id")
    backward = F.struct(F.col("record_ts"), created.isNotNull(), created, F.col("id"))
    return df.groupBy(*keys).agg(F.min_by(value, forward).alias("first_value"), F.max_by(value, backward).alias("last_value"))
