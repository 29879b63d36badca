"""Telemetry-shaped views over the test tables.

Each function derives a frame from the given Parquet tables. ``GAP_SECONDS`` and ``BUCKET_SECONDS`` fit the spacing of the
``events`` table; production feeds use 3,600 and 60.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import stages

GAP_SECONDS = 43_200
LONG_GAP_SECONDS = 259_200  # long stages, for the operators that look along a stage
BUCKET_SECONDS = 21_600

# How test events stand in for the two label alphabets.
SUBSTAGE_OF_EVENT = {"signup": "stage_start", "click": "ramp_up", "view": "slurry", "purchase": "ramp_down", "error": "stage_end"}
MARKER_OF_EVENT = {"signup": "PRE", "click": "LOW", "view": "MID_TRIAL", "purchase": "MID", "error": "PRE_LOW"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _case(column: str, mapping: dict[str, str]):
    chain = F
    for key, value in mapping.items():
        chain = chain.when(F.col(column) == key, value)
    return chain.otherwise(F.lit(None).cast("string"))


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Telemetry without its site: needs no join."""
    e = table(spark, sf_dir, "events")
    return e.select(
        F.when(F.col("event_id") % 17 != 0, F.col("ts") + F.make_dt_interval(mins=(F.col("event_id") % 7).cast("int"))).alias("created_ts"),
        F.col("ts").alias("record_ts"),
        F.concat(F.lit("W"), F.col("user_id").cast("string")).alias("name"),
        F.col("event_id").cast("string").alias("id"),
        F.col("user_id").cast("string").alias("api_num"),
        F.col("value").alias("rate_slurry"),
        (F.col("event_id") % 100).cast("double").alias("prop_conc_target"),
        (F.col("event_id") % 50).cast("double").alias("prop_conc_blend_denso"),
        (F.col("event_id") % 20).cast("double").alias("prop_conc_blend_auger"),
        (F.col("event_id") % 10).cast("double").alias("prop_conc_inline"),
        (F.get_json_object("props", "$.k").cast("double") * 10).alias("press_mainline"),
        "event_id",
        "event_type",
        "user_id",
    )


def sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Well number to fleet and pad."""
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    return (
        c.join(n, c.c_nationkey == n.n_nationkey)
        .join(r, n.n_regionkey == r.r_regionkey)
        .select(F.col("c_custkey").alias("user_id"), F.col("r_name").alias("fleet_site"), F.col("n_name").alias("pad_name"))
    )


def telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        readings(spark, sf_dir)
        .join(sites(spark, sf_dir), "user_id")
        .withColumn("fleet_name", F.when(F.col("event_id") % 19 == 0, "").otherwise(F.col("fleet_site")))
        .drop("fleet_site")
    )


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Historical telemetry with a given stage number: the week of the reading."""
    return readings(spark, sf_dir).select(
        F.lit("site").alias("site"),
        F.col("user_id").cast("double").alias("frac_id"),
        F.lit("events").alias("source_file"),
        "created_ts",
        F.col("record_ts").alias("datetime_fmt"),
        "name",
        (F.ceil(F.dayofmonth("record_ts") / 7)).cast("bigint").alias("stage_num"),
        "rate_slurry",
        "press_mainline",
        "prop_conc_blend_denso",
        (F.col("event_id") % 3 + 1).cast("double").alias("records_in_bucket"),
    )


def stage_index(spark: SparkSession, sf_dir: str, with_site: bool = True, gap: float = GAP_SECONDS) -> DataFrame:
    source = telemetry(spark, sf_dir) if with_site else readings(spark, sf_dir)
    return stages.stage_windows(source, gap)


def staged(spark: SparkSession, sf_dir: str, gap: float = GAP_SECONDS) -> DataFrame:
    """Readings with their stage number."""
    return stages.assign_stages(readings(spark, sf_dir), gap)


def substage_of_event():
    return (
        F.when(F.col("event_id") % 11 == 0, "NA")
        .when(F.col("event_id") % 13 == 0, "shut_off")
        .otherwise(_case("event_type", SUBSTAGE_OF_EVENT))
    )


def labels(spark: SparkSession, sf_dir: str, gap: float = LONG_GAP_SECONDS) -> DataFrame:
    return staged(spark, sf_dir, gap).select(
        "name",
        "stage_num_td",
        F.col("record_ts").alias("datetime_fmt"),
        substage_of_event().alias("substage"),
        "rate_slurry",
        "press_mainline",
        "prop_conc_blend_denso",
        "event_id",
    )


def marker_labels(spark: SparkSession, sf_dir: str, gap: float = LONG_GAP_SECONDS) -> DataFrame:
    """Labels of the first-generation alphabet."""
    return staged(spark, sf_dir, gap).select(
        "name",
        "stage_num_td",
        F.col("record_ts").alias("datetime_fmt"),
        _case("event_type", MARKER_OF_EVENT).alias("substage"),
        "rate_slurry",
        "press_mainline",
        "prop_conc_blend_denso",
    )


def annotations(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    start = F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(mins=((F.col("o_orderkey") * 37) % 43200).cast("int"))
    return o.select(
        F.col("o_orderkey").cast("string").alias("annotation_id"),
        F.col("o_orderpriority").alias("layer_id"),
        F.concat(F.lit("W"), F.col("o_custkey").cast("string")).alias("name"),
        start.alias("start_time"),
        (start + F.make_dt_interval(hours=(F.col("o_orderkey") % 5).cast("int"))).alias("end_time"),
        F.when(F.col("o_orderstatus") == "F", "closed").otherwise("active").alias("status"),
        F.lit("window").alias("annotation_type"),
        F.lit("stage_start").alias("substage_name"),
    )


def layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One layer per order priority, owned by a numbered user."""
    ids = table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("layer_id")).distinct()
    number = F.substring("layer_id", 1, 1)
    return ids.select(
        "layer_id",
        F.col("layer_id").alias("layer_name"),
        F.concat(F.lit("user"), number).alias("owner_email"),
        (number != "1").alias("is_editable"),
        F.lit("user").alias("source_type"),
        F.lit("active").alias("status"),
        number.cast("double").alias("display_order"),
    )


def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run per stage; every ninth stage number is retired."""
    return stage_index(spark, sf_dir).select(
        "name",
        "stage_num_td",
        F.md5(F.concat_ws("|", "name", F.col("stage_num_td").cast("string"))).alias("active_run_id"),
        F.when(F.col("stage_num_td") % 9 == 0, "retired").otherwise("active").alias("status"),
        F.lit("ds-v1").alias("algorithm_version"),
        F.col("sample_count").alias("source_rows"),
    )


def first_batch(df: DataFrame) -> DataFrame:
    return df.where(F.col("event_id") % 10 < 8)


def second_batch(df: DataFrame) -> DataFrame:
    return df.where(F.col("event_id") % 10 >= 8)


def shipments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as telemetry: many readings share a time."""
    return table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("name"),
        F.col("l_shipdate").alias("record_ts"),
        F.col("l_returnflag").alias("substage"),
        F.col("l_quantity").alias("rate_slurry"),
    )
