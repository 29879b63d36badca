"""Stage quality parts, population scores and their read side.

The formulas of the parts and of the normalisation are this project's own: see
the README. Weights and bands are fixed values of the reports.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.clean import blank_to, is_design, normal_label
from ..functions.display import REQUIRED_SUBSTAGES, SCORE_PARTS, band_color
from ..functions.numbers import round_half_up
from ..session import stored
from .anomaly import STAGE, TIME
from .islands import label_islands
from .labelling import sampling_step
from .ordered import SLOT, SLOT_SECONDS, prefix_sums

DIP_SHARE = 0.90


def quality_parts(labels: DataFrame, medians: DataFrame, events: DataFrame, slot_seconds: float = SLOT_SECONDS) -> DataFrame:
    """Raw score parts of every stage that has labels.

    Everything is one grouped aggregate over the label rows, plus the longest
    design run (islands), the sampling step and the number of events; each is
    reduced to one row per stage before the joins.
    """
    design = is_design("substage")

    def in_design(c: str) -> Column:
        return F.when(design, F.col(c))

    code = normal_label("substage")
    held = [F.max(F.when(code == k, 1).otherwise(0)) for k in REQUIRED_SUBSTAGES]
    rated = labels.join(medians.select(*STAGE, F.col("inferred_design_rate").alias("design_rate_d")), STAGE, "left")
    base = rated.groupBy(*STAGE).agg(
        F.count(F.lit(1)).alias("label_rows"),
        F.count_if(design).alias("_design_rows"),
        F.count_if(design & (F.col("rate_slurry") < F.col("design_rate_d") * DIP_SHARE)).alias("_dips"),
        (F.stddev_samp(in_design("rate_slurry")) / F.nullif(F.avg(in_design("rate_slurry")), F.lit(0.0))).alias("cv_rate"),
        (F.stddev_samp(in_design("press_mainline")) / F.nullif(F.avg(in_design("press_mainline")), F.lit(0.0))).alias("cv_press"),
        F.first("design_rate_d").alias("design_rate_d"),
        sum(held[1:], held[0]).cast("bigint").alias("substages_present"),
    )
    runs = label_islands(labels.select(*STAGE, TIME, design.alias("_design")), STAGE, TIME, "_design", slot_seconds=slot_seconds)
    longest = runs.where("_design").groupBy(*STAGE).agg(F.max("sample_count").alias("_longest"))
    step = sampling_step(labels.select(*STAGE, TIME), TIME, slot_seconds)
    burden = events.groupBy(*STAGE).agg(F.count(F.lit(1)).alias("_events"))
    joined = base.join(step, STAGE).join(longest, STAGE, "left").join(burden, STAGE, "left")
    seconds = F.col("_design_rows") * F.col("sampling_step")
    rows = F.nullif(F.col("_design_rows"), F.lit(0))
    return joined.select(
        *STAGE,
        F.coalesce("_events", F.lit(0)).cast("bigint").alias("anomaly_count"),
        "substages_present",
        seconds.alias("design_seconds"),
        (seconds / 60).alias("design_minutes"),
        ((F.col("cv_rate") + F.col("cv_press")) / 2).alias("raw_a"),
        (F.coalesce("_events", F.lit(0)) / F.nullif(seconds / 60, F.lit(0.0))).alias("raw_b"),
        (F.col("substages_present") / len(REQUIRED_SUBSTAGES)).alias("raw_c"),
        "cv_rate",
        "cv_press",
        (F.coalesce("_longest", F.lit(0)) / rows).alias("longest_run_frac"),
        F.when(F.col("design_rate_d").isNotNull(), F.col("_dips") / rows).alias("dip_rate_d"),
        "design_rate_d",
    )


# raw part, and whether a higher value is better
RANKED = {"raw_a": False, "raw_b": False, "raw_c": True, "design_rate_d": True, "dip_rate_d": False}


def percent_ranks(population: DataFrame, keys: list[str], parts: dict[str, bool], slots: int = 64) -> DataFrame:
    """100 x percent rank of each part over the whole population; ties share a rank, null scores 0.

    Values are compared at a resolution of 1e-9, so the order in which Spark
    added them up cannot change a rank.

    Equal values are counted first. The distinct values are cut into ranges at
    approximate quantiles; ranks are then exact running sums inside the ranges
    plus the totals of the ranges before, so no task sees the whole population.
    """
    long = population.select(
        *keys, F.explode(F.array(*[F.struct(F.lit(p).alias("part"), F.round(F.col(p).cast("double"), 9).alias("value")) for p in parts])).alias("_p")
    ).select(*keys, "_p.*").where(F.col("value").isNotNull())
    counts = long.groupBy("part", "value").agg(F.count(F.lit(1)).alias("_n"))
    # stored, because an approximate quantile may differ between two evaluations
    cuts = stored(counts.groupBy("part").agg(F.percentile_approx("value", [i / slots for i in range(1, slots)], 1000).alias("_cuts")), "cuts")
    placed = counts.join(F.broadcast(cuts), "part").withColumn(SLOT, F.size(F.filter("_cuts", lambda c: c < F.col("value")))).drop("_cuts")
    ranked = prefix_sums(placed, ["part"], ["value"], {"_cum": F.col("_n")}, SLOT, totals=True)
    better_below = F.col("_cum") - F.col("_n")
    better_above = F.col("_cum_total") - F.col("_cum")
    higher = F.col("part").isin([p for p, up in parts.items() if up])
    others = F.col("_cum_total") - 1
    score = F.when(others > 0, F.when(higher, better_below).otherwise(better_above) * 100.0 / others).otherwise(0.0)
    scored = long.join(ranked.select("part", "value", score.alias("_score")), ["part", "value"])
    wide = scored.groupBy(*keys).agg(*[F.max(F.when(F.col("part") == p, F.col("_score"))).alias(f"rank_{p}") for p in parts])
    return population.join(wide, keys, "left").select(*population.columns, *[F.coalesce(f"rank_{p}", F.lit(0.0)).alias(f"rank_{p}") for p in parts])


def population_scores(parts: DataFrame) -> DataFrame:
    """Four component scores, their weighted sum, and the component that costs most."""
    ranked = percent_ranks(parts, STAGE, RANKED)
    scored = ranked.select(
        *parts.columns,
        F.col("rank_raw_a").alias("score_a"),
        F.col("rank_raw_b").alias("score_b"),
        F.col("rank_raw_c").alias("score_c"),
        ((F.col("rank_design_rate_d") + F.col("rank_dip_rate_d")) / 2).alias("score_d"),
    )
    weighted = [F.col(p[1]) * p[2] for p in SCORE_PARTS]
    losses = [F.struct((F.lit(p[2]) * (F.lit(100.0) - F.col(p[1]))).alias("loss"), F.lit(-i).alias("at"), F.lit(p[4]).alias("code")) for i, p in enumerate(SCORE_PARTS)]
    return scored.withColumn("composite_score", weighted[0] + weighted[1] + weighted[2] + weighted[3]).withColumn("top_driver", F.greatest(*losses)["code"])


def scored_sites(scores: DataFrame, wells: DataFrame) -> DataFrame:
    """Scores with their fleet and pad."""
    site = wells.select("name", blank_to("fleet_name").alias("fleet_name"), blank_to("pad_name").alias("pad_name"))
    return scores.join(site, "name", "left")


def _mean(c: str = "composite_score") -> Column:
    return round_half_up(F.avg(c), 1)


def score_by_family(scores: DataFrame) -> DataFrame:
    per_well = scores.groupBy("fleet_name", "pad_name", "name").agg(F.sum("composite_score").alias("_s"), F.count(F.lit(1)).alias("_n"))
    mean = F.sum("_s") / F.sum("_n")
    return per_well.groupBy("fleet_name", "pad_name").agg(
        F.concat("fleet_name", F.lit(" / "), "pad_name").alias("family_name"),
        round_half_up(mean, 1).alias("average_score"),
        F.sum("_n").alias("stage_count"),
        F.count(F.lit(1)).alias("well_count"),
        band_color(mean).alias("color"),
    )


def score_by_well(scores: DataFrame) -> DataFrame:
    return scores.groupBy(F.col("name").alias("well_name")).agg(
        _mean().alias("average_score"),
        F.count(F.lit(1)).alias("stage_count"),
        F.min("composite_score").alias("lowest_score"),
        band_color(F.avg("composite_score")).alias("color"),
    )


def score_global(scores: DataFrame) -> DataFrame:
    """Mean, count, and the lowest stage; ties go by name, then stage."""
    low = F.min(F.struct("composite_score", *STAGE))
    return scores.agg(_mean().alias("_mean"), F.count(F.lit(1)).alias("stages_scored"), low.alias("_low")).select(
        F.coalesce("_mean", F.lit(0.0)).alias("average_score"),
        "stages_scored",
        F.coalesce(F.col("_low")["composite_score"], F.lit(0.0)).alias("lowest_score"),
        F.coalesce(F.col("_low")["name"], F.lit("")).alias("lowest_well"),
        F.coalesce(F.col("_low")["stage_num_td"], F.lit(0)).cast("bigint").alias("lowest_stage"),
    )


def score_breakdown(scores: DataFrame) -> DataFrame:
    """Four weighted component rows per stage."""
    rows = F.explode(
        F.array(*[
            F.struct(F.lit(t).alias("component"), F.col(c).alias("score"), F.lit(w).alias("weight"), (F.col(c) * w).alias("weighted_contribution"), F.lit(k).alias("color"))
            for t, c, w, k, _, _ in SCORE_PARTS
        ])
    )
    return scores.select(*STAGE, rows.alias("_r")).select(*STAGE, "_r.*")
