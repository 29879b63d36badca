"""Column contracts of the stored tables: types, required columns and keys."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.clean import safe_double, safe_time

# Names of the measures.
MEASURE_COLUMNS = [
    "rate_slurry",
    "press_mainline",
    "prop_conc_blend_denso",
    "prop_conc_inline",
    "prop_conc_target",
    "prop_conc_blend_auger",
]


@dataclass(frozen=True)
class Table:
    """A stored table: ``columns`` in DDL form and the primary key. The instances below are fixed contracts."""

    name: str
    columns: str
    key: tuple[str, ...]

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromDDL(self.columns)

    def empty(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([], self.schema)


_RUN = "fleet_name string, pad_name string, processing_run_id string, algorithm_version string, source_signature string, "

TELEMETRY = Table(
    "telemetry",
    "created_ts timestamp_ntz, fleet_name string, pad_name string, record_ts timestamp_ntz, name string, id string, "
    "api_num string, rate_slurry double, prop_conc_target double, prop_conc_blend_denso double, "
    "prop_conc_blend_auger double, prop_conc_inline double, press_mainline double",
    ("created_ts", "record_ts", "name"),
)
HISTORY = Table(
    "history",
    "site string, frac_id double, source_file string, created_ts timestamp_ntz, datetime_fmt timestamp_ntz, name string, "
    "stage_num double, rate_slurry double, press_mainline double, prop_conc_blend_denso double, "
    "records_in_bucket double, ingested_ts timestamp_ntz",
    ("frac_id", "datetime_fmt", "name"),
)
ROLLUP = Table(
    "rollup",
    "bucket_seconds int, bucket_ts timestamp_ntz, fleet_name string, pad_name string, name string, id string, api_num string, "
    "first_record_ts timestamp_ntz, last_record_ts timestamp_ntz, first_created_ts timestamp_ntz, "
    "last_created_ts timestamp_ntz, records_in_bucket bigint, "
    + "".join(f"{m}_{s} double, " for m in MEASURE_COLUMNS for s in ("avg", "min", "max", "first", "last"))
    + "rollup_created_at timestamp_ntz, rollup_updated_at timestamp_ntz",
    ("bucket_seconds", "bucket_ts", "fleet_name", "pad_name", "name"),
)
STAGES = Table(
    "stages",
    "name string, stage_num_td bigint, fleet_name string, pad_name string, well_id string, api_num string, "
    "stage_start_ts timestamp_ntz, stage_end_ts timestamp_ntz, first_created_ts timestamp_ntz, "
    "last_created_ts timestamp_ntz, sample_count bigint, avg_rate_slurry double, max_rate_slurry double, "
    "avg_press_mainline double, max_press_mainline double, avg_prop_conc_blend_denso double, "
    "max_prop_conc_blend_denso double, stage_detection_method string",
    ("name", "stage_num_td"),
)
LABELS = Table(
    "labels",
    "name string, stage_num_td bigint, datetime_fmt timestamp_ntz, substage string, rate_slurry double, "
    "press_mainline double, prop_conc_blend_denso double, inferred_design_rate double, inferred_pressure double, "
    "model_name string, source_type string, created_at timestamp_ntz, updated_at timestamp_ntz",
    ("name", "stage_num_td", "datetime_fmt"),
)
ANNOTATIONS = Table(
    "annotations",
    "annotation_id string, layer_id string, rule_concept_id string, labeler_id string, frac_id double, site string, "
    "name string, stage_num double, annotation_type string, substage_name string, start_feature string, "
    "end_feature string, selected_feature string, start_time timestamp_ntz, end_time timestamp_ntz, "
    "timestamp timestamp_ntz, notes string, metadata_json string, source_type string, created_by_email string, "
    "updated_by_email string, is_public boolean, status string, created_at timestamp_ntz, updated_at timestamp_ntz, "
    "deleted_at timestamp_ntz",
    ("annotation_id",),
)
LAYERS = Table(
    "layers",
    "layer_id string, name string, rule_concept_id string, labeler_id string, layer_name string, owner_email string, "
    "created_by_email string, updated_by_email string, source_type string, status string, frac_id double, "
    "is_editable boolean, display_order double, is_visible_default boolean, created_at timestamp_ntz, "
    "updated_at timestamp_ntz, deleted_at timestamp_ntz",
    ("layer_id",),
)
ANOMALY_LABELS = Table(
    "anomaly_labels",
    _RUN + "name string, stage_num_td bigint, datetime_fmt timestamp_ntz, anomaly string, created_at timestamp_ntz",
    ("processing_run_id", "name", "stage_num_td", "datetime_fmt"),
)
ANOMALY_EVENTS = Table(
    "anomaly_events",
    _RUN + "event_id string, name string, stage_num_td bigint, anomaly string, anomaly_display string, "
    "start_ts timestamp_ntz, end_ts timestamp_ntz, duration_sec double, duration_min double, created_at timestamp_ntz",
    ("processing_run_id", "event_id"),
)
ANOMALY_SUMMARY = Table(
    "anomaly_summary",
    _RUN + "name string, stage_num_td bigint, stage_start_ts timestamp_ntz, stage_end_ts timestamp_ntz, "
    "source_rows bigint, total_anomaly_lines bigint, pressure_surge_lines bigint, pump_rate_drop_lines bigint, "
    "mid_stage_shutdown_lines bigint, sweep_lines bigint, created_at timestamp_ntz",
    ("processing_run_id", "name", "stage_num_td"),
)
MANIFEST = Table(
    "manifest",
    "fleet_name string, pad_name string, name string, stage_num_td bigint, algorithm_version string, "
    "active_run_id string, source_signature string, source_rows bigint, first_source_ts timestamp_ntz, "
    "last_source_ts timestamp_ntz, latest_source_updated_at timestamp_ntz, processed_at timestamp_ntz, status string",
    ("name", "stage_num_td", "algorithm_version"),
)
THRESHOLD_COUNTS = Table(
    "threshold_counts",
    "fleet_name string, pad_name string, name string, stage_num_td bigint, rolling_points int, threshold_type string, "
    "threshold_value double, segment_count bigint, source_signature string, algorithm_version string, "
    "updated_at timestamp_ntz",
    ("name", "stage_num_td", "rolling_points", "threshold_type", "threshold_value", "algorithm_version"),
)

TABLES = {
    t.name: t
    for t in (
        TELEMETRY, HISTORY, ROLLUP, STAGES, LABELS, ANNOTATIONS, LAYERS, ANOMALY_LABELS, ANOMALY_EVENTS,
        ANOMALY_SUMMARY, MANIFEST, THRESHOLD_COUNTS,
    )
}


def typed(df: DataFrame, table: Table) -> DataFrame:
    """Bring a loosely typed frame to the table's types, once, at load.

    Text that is not a number or a time becomes null; columns the frame lacks
    are null.
    """
    have = dict(df.dtypes)

    def column(field: T.StructField) -> Column:
        kind = field.dataType.simpleString()
        if field.name not in have:
            return F.lit(None).cast(kind).alias(field.name)
        if have[field.name] == kind:
            return F.col(field.name)
        if have[field.name] == "string" and kind == "timestamp_ntz":
            return safe_time(field.name).alias(field.name)
        if have[field.name] == "string" and kind == "double":
            return safe_double(field.name).alias(field.name)
        return F.col(field.name).try_cast(kind).alias(field.name)

    return df.select(*[column(f) for f in table.schema.fields])


def read_table(spark: SparkSession, table: Table, path: str) -> DataFrame:
    """Parquet under the declared schema, so nothing is inferred and scans prune columns."""
    return spark.read.schema(table.schema).parquet(path)
