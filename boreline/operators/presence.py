"""Which labels each stage holds, and how complete stages are."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.clean import ALL, has_label, normal_label, number_text
from ..functions.display import REQUIRED_SUBSTAGES, SUBSTAGES
from ..functions.numbers import round_half_up
from ..sources.reads import optional_filters
from .joins import catalog_counts, with_scalar


def labelled(labels: DataFrame) -> DataFrame:
    return labels.where(F.col("stage_num_td").isNotNull() & has_label("substage"))


def in_scope(labels: DataFrame, wells: DataFrame, fleet: str | None = None, pad: str | None = None, well: str | None = None) -> DataFrame:
    """Labels of the wells that the well index has for a fleet, pad or well; what is not set does not filter."""
    chosen = optional_filters(wells, fleet, pad, well).select("name").distinct()
    return labels.join(chosen, "name", "left_semi")


def stage_label(well: str | None = None) -> Column:
    """How a report names a stage: its number, with the well in front where several wells are shown."""
    number = number_text(F.col("stage_num").cast("double"))
    return number if well not in (None, "", ALL) else F.concat("well_name", F.lit(" · "), number)


def presence_pivot(labels: DataFrame) -> DataFrame:
    """One 0/1 column per label for every (well, stage)."""
    code = normal_label("substage")
    flags = [F.max(F.when(code == key, 1).otherwise(0)).alias(key) for _, key, _ in SUBSTAGES]
    return labelled(labels).groupBy(F.col("name").alias("well_name"), F.col("stage_num_td").alias("stage_num")).agg(*flags)


def presence_coverage(pivot: DataFrame) -> DataFrame:
    """Share of the required labels present, and which are missing."""
    present = sum((F.col(c) for c in REQUIRED_SUBSTAGES), F.lit(0))
    titles = {key: title for _, key, title in SUBSTAGES}
    missing = F.concat_ws(", ", *[F.when(F.col(c) == 0, titles[c]) for c in REQUIRED_SUBSTAGES])
    required = len(REQUIRED_SUBSTAGES)
    return (
        pivot.withColumn("present_required", present)
        .withColumn("coverage_percent", round_half_up(F.col("present_required") * 100.0 / required, 1))
        .withColumn("missing_count", F.lit(required) - F.col("present_required"))
        .withColumn("complete_stage", F.when(F.col("missing_count") == 0, 1).otherwise(0))
        .withColumn("missing_substages", missing)
    )


def presence_summary(coverage: DataFrame) -> DataFrame:
    mean = F.sum("present_required") * 100.0 / len(REQUIRED_SUBSTAGES) / F.count(F.lit(1))
    return coverage.agg(
        F.count(F.lit(1)).alias("total_stages"),
        F.coalesce(round_half_up(mean, 1), F.lit(0.0)).alias("average_coverage"),
        F.coalesce(F.sum("complete_stage"), F.lit(0)).cast("bigint").alias("complete_stages"),
    )


def presence_cells(pivot: DataFrame) -> DataFrame:
    """One row per stage and catalogue label."""
    cells = F.explode(
        F.array(*[F.struct(F.lit(n).alias("sort_order"), F.lit(k).alias("substage_key"), F.lit(t).alias("substage_label"), F.col(k).alias("presence_value")) for n, k, t in SUBSTAGES])
    )
    return pivot.select("well_name", "stage_num", cells.alias("_c")).select("well_name", "stage_num", "_c.*")


def pair_presence(labels: DataFrame) -> DataFrame:
    """Share of all (well, stage) pairs that hold each label.

    Pairs are made distinct per label first, so the counts run on one row per
    stage and label instead of on readings.
    """
    pivot = presence_pivot(labels)
    totals = pivot.agg(F.count(F.lit(1)).alias("total_stages"), *[F.sum(k).alias(k) for _, k, _ in SUBSTAGES])
    counts = totals.select(
        F.explode(F.array(*[F.struct(F.lit(k).alias("substage_key"), F.coalesce(F.col(k), F.lit(0)).alias("present_count")) for _, k, _ in SUBSTAGES])).alias("_c")
    ).select("_c.*")
    rows = with_scalar(catalog_counts(counts, "substage_key", "present_count"), totals.select("total_stages"))
    share = F.coalesce(F.col("present_count") * 100.0 / F.nullif(F.col("total_stages"), F.lit(0)), F.lit(0.0))
    return rows.withColumn("presence_percent", round_half_up(share, 1)).withColumn("scope_label", F.lit("All Wells"))
