"""Time buckets and entity indexes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.clean import blank_to, name_family, time_text
from ..functions.numbers import slot_start
from ..sources.catalog import MEASURE_COLUMNS


def bucket_values() -> list[Column]:
    """What a bucket holds of its readings, as aggregates.

    The first and last readings of a bucket are each one struct of all
    measures, so they come from one reading.
    """
    created = F.col("created_ts")
    reading = F.struct(*MEASURE_COLUMNS, "id", "api_num")
    forward = F.struct(F.col("record_ts"), created.isNull().alias("n"), created, F.col("id"))
    backward = F.struct(F.col("record_ts"), created.isNotNull().alias("n"), created, F.col("id"))
    return [
        F.min_by(reading, forward).alias("_first"),
        F.max_by(reading, backward).alias("_last"),
        F.min("record_ts").alias("first_record_ts"),
        F.max("record_ts").alias("last_record_ts"),
        F.min("created_ts").alias("first_created_ts"),
        F.max("created_ts").alias("last_created_ts"),
        F.count(F.lit(1)).alias("records_in_bucket"),
        *[f(m).alias(f"{m}_{s}") for m in MEASURE_COLUMNS for s, f in (("avg", F.avg), ("min", F.min), ("max", F.max))],
    ]


def bucket_columns(out: DataFrame, bucket_seconds: int) -> DataFrame:
    """The stored shape of aggregated buckets."""
    return out.select(
        F.lit(int(bucket_seconds)).alias("bucket_seconds"),
        "bucket_ts", "fleet_name", "pad_name", "name",
        F.col("_last")["id"].alias("id"),
        F.col("_last")["api_num"].alias("api_num"),
        "first_record_ts", "last_record_ts", "first_created_ts", "last_created_ts", "records_in_bucket",
        *[
            c
            for m in MEASURE_COLUMNS
            for c in (f"{m}_avg", f"{m}_min", f"{m}_max", F.col("_first")[m].alias(f"{m}_first"), F.col("_last")[m].alias(f"{m}_last"))
        ],
    )


def tumbling_rollup(df: DataFrame, bucket_seconds: int) -> DataFrame:
    """Per (bucket, fleet, pad, well): counts, time bounds, and avg, min, max, first, last of each measure, in one aggregation."""
    rows = df.where(F.col("record_ts").isNotNull() & F.col("name").isNotNull()).select(
        slot_start("record_ts", bucket_seconds).alias("bucket_ts"),
        blank_to("fleet_name").alias("fleet_name"),
        blank_to("pad_name").alias("pad_name"),
        "name", "id", "api_num", "record_ts", "created_ts", *MEASURE_COLUMNS,
    )
    return bucket_columns(rows.groupBy("bucket_ts", "fleet_name", "pad_name", "name").agg(*bucket_values()), bucket_seconds)


# --- pyramid of roll-ups -----------------------------------------------------

PYRAMID_KEY = ["bucket_seconds", "bucket_ts", "fleet_name", "pad_name", "name"]


def _first_of(column: str = "record_ts") -> Column:
    created = F.col("created_ts")
    return F.struct(F.col(column), created.isNull().alias("none"), created, F.col("id"), F.struct(*MEASURE_COLUMNS).alias("reading"))


def base_level(df: DataFrame, bucket_seconds: int) -> DataFrame:
    """Buckets as sums, non-null counts, extremes, and first and last reading: what larger buckets can be merged from."""
    rows = df.where(F.col("record_ts").isNotNull() & F.col("name").isNotNull()).withColumns(
        {"bucket_ts": slot_start("record_ts", bucket_seconds), "fleet_name": blank_to("fleet_name"), "pad_name": blank_to("pad_name"), "bucket_seconds": F.lit(int(bucket_seconds))}
    )
    return rows.groupBy(*PYRAMID_KEY).agg(
        F.count(F.lit(1)).alias("n"),
        *[f(m).alias(f"{m}_{s}") for m in MEASURE_COLUMNS for s, f in (("sum", F.sum), ("cnt", F.count), ("min", F.min), ("max", F.max))],
        F.min(_first_of()).alias("opening"),
        F.max(_first_of()).alias("closing"),
    )


def next_level(level: DataFrame, bucket_seconds: int) -> DataFrame:
    """Buckets of a multiple of the width, merged from those of one level."""
    wide = level.withColumns({"bucket_ts": slot_start("bucket_ts", bucket_seconds), "bucket_seconds": F.lit(int(bucket_seconds))})
    return wide.groupBy(*PYRAMID_KEY).agg(
        F.sum("n").alias("n"),
        *[f(f"{m}_{s}").alias(f"{m}_{s}") for m in MEASURE_COLUMNS for s, f in (("sum", F.sum), ("cnt", F.sum), ("min", F.min), ("max", F.max))],
        F.min("opening").alias("opening"),
        F.max("closing").alias("closing"),
    )


def pyramid(df: DataFrame, widths: list[int]) -> DataFrame:
    """Mergeable buckets of every width, each level made from the one below; readings are read once.

    Each width is a multiple of the one before it.
    """
    if any(b % a for a, b in zip(widths, widths[1:])):
        raise ValueError("each width must be a multiple of the one before it")
    level = base_level(df, widths[0])
    out = level
    for width in widths[1:]:
        level = next_level(level, width)
        out = out.unionByName(level)
    return out


def refreshed_levels(old: DataFrame, base: DataFrame, widths: list[int]) -> DataFrame:
    """The buckets of all levels that change when ``base`` replaces buckets of the lowest one.

    ``old`` holds all levels. Of each level only the parents of what changed
    below are merged again, from the children they have.
    """
    changed, out = base, base
    for below, width in zip(widths, widths[1:]):
        own = [c for c in PYRAMID_KEY if c != "bucket_seconds"]
        parent = slot_start("bucket_ts", width)
        touched = changed.select(parent.alias("_parent"), "name", "fleet_name", "pad_name").distinct()
        kept = old.where(F.col("bucket_seconds") == below).join(changed.select(*own), own, "left_anti")
        kept = kept.withColumn("_parent", parent).join(touched, ["_parent", "name", "fleet_name", "pad_name"], "left_semi").drop("_parent")
        changed = next_level(kept.unionByName(changed), width)
        out = out.unionByName(changed)
    return out


def pyramid_values(levels: DataFrame) -> DataFrame:
    """Buckets as charts read them: counts, and average, extremes, first and last of each measure."""
    return levels.select(
        *PYRAMID_KEY,
        F.col("opening.record_ts").alias("first_record_ts"),
        F.col("closing.record_ts").alias("last_record_ts"),
        F.col("n").alias("records_in_bucket"),
        *[
            c
            for m in MEASURE_COLUMNS
            for c in (
                (F.col(f"{m}_sum") / F.nullif(F.col(f"{m}_cnt"), F.lit(0))).alias(f"{m}_avg"), F.col(f"{m}_min"), F.col(f"{m}_max"),
                F.col(f"opening.reading.{m}").alias(f"{m}_first"), F.col(f"closing.reading.{m}").alias(f"{m}_last"),
            )
        ],
    )


def level_for(levels: DataFrame, span_seconds: float, widths: list[int], points: int = 2_000) -> DataFrame:
    """The finest level that shows a span with no more than ``points`` buckets, or the coarsest one."""
    fit = [w for w in widths if span_seconds / w <= points] or widths[-1:]
    return levels.where(F.col("bucket_seconds") == fit[0])


def bucket_average(df: DataFrame, bucket_seconds: int, measures: list[str]) -> DataFrame:
    """Mean of the measures and row count per (well, bucket)."""
    return df.groupBy("name", slot_start("record_ts", bucket_seconds).alias("bucket_ts")).agg(
        *[F.avg(m).alias(m) for m in measures], F.count(F.lit(1)).alias("records_in_bucket")
    )


def history_stage_index(df: DataFrame) -> DataFrame:
    """Stage index from a given stage number."""
    rows = df.where(F.col("name").isNotNull() & F.col("stage_num").isNotNull() & F.col("datetime_fmt").isNotNull())
    return rows.groupBy("site", "frac_id", "source_file", "name", "stage_num").agg(
        F.min("datetime_fmt").alias("stage_start_ts"),
        F.max("datetime_fmt").alias("stage_end_ts"),
        F.min("created_ts").alias("first_created_ts"),
        F.max("created_ts").alias("last_created_ts"),
        F.count(F.lit(1)).alias("sample_count"),
        F.sum("records_in_bucket").alias("source_record_count"),
        *[f(m).alias(f"{s}_{m}") for m in ("rate_slurry", "press_mainline", "prop_conc_blend_denso") for s, f in (("avg", F.avg), ("max", F.max))],
    )


def well_index(df: DataFrame) -> DataFrame:
    """One row per well: family, last non-null identifiers, time bounds as text, count."""
    rows = df.where(F.col("name").isNotNull() & F.col("record_ts").isNotNull())

    def newest(c: str):
        return F.max(F.when(F.col(c).isNotNull(), F.struct("record_ts", "id", F.col(c).alias("v"))))["v"].alias(c)

    wells = rows.groupBy("name").agg(
        newest("fleet_name"), newest("pad_name"), newest("id").alias("well_id"), newest("api_num"),
        F.min("record_ts").alias("_first"), F.max("record_ts").alias("_last"),
        F.coalesce(F.min("created_ts"), F.min("record_ts")).alias("_first_created"),
        F.coalesce(F.max("created_ts"), F.max("record_ts")).alias("_last_created"),
        F.count(F.lit(1)).alias("sample_count"),
    )
    return wells.select(
        "name",
        name_family("name", "pad_name").alias("well_family"),
        "fleet_name", "pad_name", "well_id", "api_num",
        time_text("_first").alias("first_record_ts"),
        time_text("_last").alias("last_record_ts"),
        time_text("_first_created").alias("first_created_ts"),
        time_text("_last_created").alias("last_created_ts"),
        "sample_count",
    )


def history_well_index(df: DataFrame) -> DataFrame:
    """Historical wells with their number of given stages.

    Stages are counted on (well, stage) partials, so no well's rows are
    gathered to be made distinct.
    """
    rows = df.where(F.col("name").isNotNull() & F.col("datetime_fmt").isNotNull())
    parts = rows.groupBy("site", "frac_id", "source_file", "name", "stage_num").agg(
        F.count(F.lit(1)).alias("_n"), F.min("datetime_fmt").alias("_lo"), F.max("datetime_fmt").alias("_hi"),
        F.min("created_ts").alias("_clo"), F.max("created_ts").alias("_chi"),
    )
    return parts.groupBy("site", "frac_id", "source_file", "name").agg(
        F.sum("_n").alias("sample_count"), F.count("stage_num").alias("stage_count"),
        F.min("stage_num").alias("min_stage_num"), F.max("stage_num").alias("max_stage_num"),
        time_text(F.min("_lo")).alias("first_ts"), time_text(F.max("_hi")).alias("last_ts"),
        time_text(F.min("_clo")).alias("first_created_ts"), time_text(F.max("_chi")).alias("last_created_ts"),
    ).withColumn("well_family", name_family("name"))
