"""Schemas of every table and message. Nothing in the package infers a schema."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Names, types and order of the columns are those of the tables that users have.
# `False` marks a column that is never NULL.

# --- bronze -----------------------------------------------------------------

BRONZE_NEO = (
    T.StructType()
    .add("event_id", "long")
    .add("ingestion_timestamp", "timestamp")
    .add("feed_start_date", "date")
    .add("feed_end_date", "date")
    .add("neo_id", "string", False)
    .add("neo_reference_id", "string")
    .add("neo_name", "string")
    .add("is_potentially_hazardous_asteroid", "boolean")
    .add("absolute_magnitude_h", "double")
    .add("estimated_diameter", "string")
    .add("close_approach_date", "date", False)
    .add("close_approach_date_full", "string")
    .add("epoch_date_close_approach", "long")
    .add("relative_velocity", "string")
    .add("miss_distance", "string")
    .add("orbiting_body", "string")
    .add("raw_neo", "string")
)

BRONZE_SATCAT = (
    T.StructType()
    .add("id", "long")
    .add("ingestion_timestamp", "timestamp")
    .add("snapshot_group", "string", False)
    .add("snapshot_date", "date", False)
    .add("raw_csv_row", "string", False)
    .add("parsed_record", "string")
    # The same as a VARIANT: parsed once, when the row is written. NULL where it is malformed.
    .add("record", T.VariantType())
)

QUARANTINE = (
    T.StructType()
    .add("stream", "string", False)
    .add("reason", "string", False)
    .add("message_key", "string")
    .add("value", "string")
    .add("quarantined_at", "timestamp", False)
)

# --- silver -----------------------------------------------------------------

SILVER_NEO = (
    T.StructType()
    .add("neo_sk", "long", False)
    .add("neo_id", "string", False)
    .add("neo_reference_id", "string")
    .add("name", "string")
    .add("absolute_magnitude_h", "double")
    .add("estimated_diameter_km_min", "double")
    .add("estimated_diameter_km_max", "double")
    .add("is_potentially_hazardous_asteroid", "boolean", False)
    .add("is_sentry_object", "boolean")
    .add("nasa_jpl_url", "string")
    .add("first_seen_date", "date")
    .add("last_seen_date", "date")
)

SILVER_APPROACH = (
    T.StructType()
    .add("approach_sk", "long", False)
    .add("neo_sk", "long", False)
    .add("neo_id", "string", False)
    .add("close_approach_date", "date", False)
    .add("close_approach_date_full", "string")
    .add("epoch_date_close_approach", "long")
    .add("orbiting_body", "string")
    .add("rel_velocity_km_s", "double")
    .add("rel_velocity_km_h", "double")
    .add("rel_velocity_mi_h", "double")
    .add("miss_distance_km", "double")
    .add("miss_distance_lunar", "double")
    .add("miss_distance_au", "double")
    .add("miss_distance_miles", "double")
    .add("ingestion_timestamp", "timestamp")
    .add("source_run_id", "string")
)

SILVER_SATELLITE = (
    T.StructType()
    .add("satellite_sk", "long", False)
    .add("norad_cat_id", "integer", False)
    .add("object_id", "string")
    .add("object_name", "string", False)
    .add("object_type", "string")
    .add("owner", "string")
    .add("ops_status_code", "string")
    .add("launch_date", "date")
    .add("launch_site", "string")
    .add("decay_date", "date")
    .add("orbit_center", "string")
    .add("orbit_type", "string")
    .add("rcs", "double")
    .add("first_seen_date", "date")
    .add("last_seen_date", "date")
)

SILVER_SNAPSHOT = (
    T.StructType()
    .add("orbit_snapshot_sk", "long", False)
    .add("satellite_sk", "long", False)
    .add("norad_cat_id", "integer", False)
    .add("snapshot_date", "date", False)
    .add("period_minutes", "double")
    .add("inclination_deg", "double")
    .add("apogee_km", "double")
    .add("perigee_km", "double")
    .add("ecc", "double")
    .add("mean_motion_rev_per_day", "double")
    .add("ingestion_timestamp", "timestamp")
    .add("source_group", "string")
    .add("source_run_id", "string")
)

# --- gold -------------------------------------------------------------------

GOLD_DAILY_ACTIVITY = (
    T.StructType()
    .add("close_approach_date", "date")
    .add("total_approaches", "long")
    .add("unique_objects", "long")
    .add("hazardous_approaches", "long")
)

GOLD_HAZARD_SUMMARY = (
    T.StructType()
    .add("neo_id", "string")
    .add("name", "string")
    .add("is_hazardous", "boolean")
    .add("total_approaches", "long")
    .add("first_approach_date", "date")
    .add("last_approach_date", "date")
    .add("closest_approach_km", "double")
)

GOLD_ORBIT_SUMMARY = (
    T.StructType()
    .add("norad_cat_id", "integer")
    .add("object_name", "string")
    .add("object_type", "string")
    .add("owner", "string")
    .add("snapshot_count", "long")
    .add("first_snapshot_date", "date")
    .add("last_snapshot_date", "date")
    .add("avg_period_minutes", "double")
    .add("avg_inclination_deg", "double")
    .add("avg_apogee_km", "double")
    .add("avg_perigee_km", "double")
)

GOLD_NEO_FEATURES = (
    T.StructType()
    .add("approach_sk", "long")
    .add("neo_id", "string")
    .add("close_approach_date", "date")
    .add("rel_velocity_km_s", "double")
    .add("rel_velocity_km_h", "double")
    .add("miss_distance_km", "double")
    .add("miss_distance_lunar", "double")
    .add("miss_distance_au", "double")
    .add("absolute_magnitude_h", "double")
    .add("is_hazardous_label", "integer")
)

GOLD_SATCAT_FEATURES = (
    T.StructType()
    .add("orbit_snapshot_sk", "long")
    .add("norad_cat_id", "integer")
    .add("snapshot_date", "date")
    .add("period_minutes", "double")
    .add("inclination_deg", "double")
    .add("apogee_km", "double")
    .add("perigee_km", "double")
    .add("object_type", "string")
    .add("owner", "string")
)

# Mergeable state of the orbit summary: sums and counts per satellite.
ORBIT_MEASURES = ("period_minutes", "inclination_deg", "apogee_km", "perigee_km")
GOLD_ORBIT_PARTIAL = (
    T.StructType()
    .add("norad_cat_id", "integer")
    .add("snapshot_count", "long")
    .add("first_snapshot_date", "date")
    .add("last_snapshot_date", "date")
)
for _measure in ORBIT_MEASURES:
    GOLD_ORBIT_PARTIAL = GOLD_ORBIT_PARTIAL.add(f"sum_{_measure}", "decimal(38,9)").add(
        f"count_{_measure}", "long"
    )

# Moments of the deltas between snapshots, and the last elements, per satellite.
MOMENT_ELEMENTS = ("period_minutes", "apogee_km", "perigee_km")
ORBIT_MOMENTS = (
    T.StructType().add("norad_cat_id", "integer").add("last_snapshot_date", "date")
)
for _measure in MOMENT_ELEMENTS:
    ORBIT_MOMENTS = (
        ORBIT_MOMENTS.add(f"last_{_measure}", "double")
        .add(f"n_{_measure}", "long")
        .add(f"mean_{_measure}", "double")
        .add(f"m2_{_measure}", "double")
    )

# --- meta -------------------------------------------------------------------

# The run ledger is append-only: one 'start' and at most a few 'end' events per run.
RUN_EVENT = (
    T.StructType()
    .add("run_id", "string", False)
    .add("pipeline_name", "string", False)
    .add("triggered_by", "string")
    .add("dag_id", "string")
    .add("task_id", "string")
    .add("event", "string", False)
    .add("event_time", "timestamp", False)
    .add("status", "string", False)
    .add("records_processed", "long")
    .add("error_message", "string")
)

DQ_RECORD = (
    T.StructType()
    .add("dq_run_id", "string", False)
    .add("run_id", "string")
    .add("check_name", "string", False)
    .add("status", "string", False)
    .add("total_records", "long")
    .add("failed_records", "long")
    .add("details", "string")
    .add("created_at", "timestamp", False)
)

# Finished micro-batches, as the streams report them.
STREAM_PROGRESS = (
    T.StructType()
    .add("stream", "string", False)
    .add("query_id", "string", False)
    .add("batch_id", "long", False)
    .add("finished_at", "timestamp", False)
    .add("input_rows", "long")
)

# Last surrogate key reserved by each load of a table.
KEY_RANGE = (
    T.StructType()
    .add("table_name", "string", False)
    .add("reserved_by", "string", False)
    .add("last_key", "long", False)
)

# --- ml ---------------------------------------------------------------------

MODEL_REGISTRY = (
    T.StructType()
    .add("model_id", "string", False)
    .add("model_name", "string", False)
    .add("model_version", "integer", False)
    .add("algorithm", "string", False)
    .add("feature_set", "string", False)
    .add("artifact_uri", "string", False)
    .add("trained_at", "timestamp", False)
    .add("training_run_id", "string")
    .add("gate_passed", "boolean", False)
    .add("params", "string")
)

MODEL_METRIC = (
    T.StructType()
    .add("metric_id", "string", False)
    .add("model_id", "string", False)
    .add("metric_name", "string", False)
    .add("metric_value", "double", False)
    .add("dataset_split", "string", False)
    .add("created_at", "timestamp", False)
)

PREDICTION = (
    T.StructType()
    .add("prediction_id", "string", False)
    .add("model_id", "string", False)
    .add("entity_type", "string", False)
    .add("entity_key", "string", False)
    .add("snapshot_ref", "string")
    .add("predicted_label", "string")
    .add("predicted_score", "double")
    .add("inference_run_id", "string")
    .add("created_at", "timestamp", False)
)

TABLES: dict[str, T.StructType] = {
    "bronze.neo_event_raw": BRONZE_NEO,
    "bronze.satcat_raw": BRONZE_SATCAT,
    "bronze.quarantine": QUARANTINE,
    "silver.neo": SILVER_NEO,
    "silver.neo_close_approach": SILVER_APPROACH,
    "silver.satcat_satellite": SILVER_SATELLITE,
    "silver.satcat_orbit_snapshot": SILVER_SNAPSHOT,
    "gold.neo_daily_activity": GOLD_DAILY_ACTIVITY,
    "gold.neo_hazard_summary": GOLD_HAZARD_SUMMARY,
    "gold.satcat_orbit_partial": GOLD_ORBIT_PARTIAL,
    "gold.satcat_orbit_summary": GOLD_ORBIT_SUMMARY,
    "gold.orbit_moments": ORBIT_MOMENTS,
    "gold.ai_neo_features": GOLD_NEO_FEATURES,
    "gold.ai_satcat_features": GOLD_SATCAT_FEATURES,
    "meta.pipeline_run": RUN_EVENT,
    "meta.data_quality_run": DQ_RECORD,
    "meta.key_range": KEY_RANGE,
    "meta.stream_progress": STREAM_PROGRESS,
    "ml.model_registry": MODEL_REGISTRY,
    "ml.model_metric": MODEL_METRIC,
    "ml.prediction": PREDICTION,
}


def as_variant(text: str) -> Column:
    """A JSON text column as a VARIANT; NULL where it is malformed or repeats a member."""
    return F.try_parse_json(text)


# --- JSON -------------------------------------------------------------------

# Nested objects are read as STRING: Spark keeps their JSON text, so unknown members survive
# and each nested document is parsed once, when its numbers are needed.
FEED_DOCUMENT = "near_earth_objects MAP<STRING, ARRAY<STRING>>"

FEED_OBJECT = (
    "id STRING, neo_reference_id STRING, name STRING, "
    "is_potentially_hazardous_asteroid BOOLEAN, absolute_magnitude_h DOUBLE, "
    "estimated_diameter STRING, close_approach_data ARRAY<STRUCT<"
    "close_approach_date: STRING, close_approach_date_full: STRING, "
    "epoch_date_close_approach: BIGINT, relative_velocity: STRING, miss_distance: STRING, "
    "orbiting_body: STRING>>"
)

DIAMETER = "kilometers STRUCT<estimated_diameter_min: STRING, estimated_diameter_max: STRING>"
VELOCITY = "kilometers_per_second STRING, kilometers_per_hour STRING, miles_per_hour STRING"
DISTANCE = "kilometers STRING, lunar STRING, astronomical STRING, miles STRING"

SATCAT_FIELDS = (
    "NORAD_CAT_ID", "OBJECT_ID", "OBJECT_NAME", "OBJECT_TYPE", "OWNER", "OPS_STATUS_CODE",
    "LAUNCH_DATE", "LAUNCH_SITE", "DECAY_DATE", "ORBIT_CENTER", "ORBIT_TYPE", "RCS",
    "PERIOD", "INCLINATION", "APOGEE", "PERIGEE",
)

NEO_MESSAGE = (
    "neo_id STRING, neo_reference_id STRING, neo_name STRING, "
    "is_potentially_hazardous_asteroid BOOLEAN, absolute_magnitude_h DOUBLE, "
    "estimated_diameter STRING, close_approach_date STRING, close_approach_date_full STRING, "
    "epoch_date_close_approach BIGINT, relative_velocity STRING, miss_distance STRING, "
    "orbiting_body STRING, raw_neo STRING"
)

SATCAT_MESSAGE = "snapshot_group STRING, snapshot_timestamp STRING, satcat MAP<STRING, STRING>"
