"""Declared schemas. Spark parquet enforces no keys; see operators.checks for those."""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType, DoubleType, IntegerType, LongType, StringType, StructField, StructType,
    TimestampType,
)

_TYPES = {
    "STRING": StringType(), "DOUBLE": DoubleType(), "INT": IntegerType(), "BIGINT": LongType(),
    "BOOLEAN": BooleanType(), "TIMESTAMP": TimestampType(),
}


def schema_of(columns: str) -> StructType:
    """``name TYPE [NOT NULL], ...`` as a StructType, with no session needed."""
    fields = []
    for column in columns.split(","):
        name, kind, *constraint = column.split()
        fields.append(StructField(name, _TYPES[kind], not constraint))
    return StructType(fields)

TAG_READING = schema_of(
    "event_id STRING NOT NULL, tag_id STRING NOT NULL, source_ts TIMESTAMP NOT NULL, "
    "value DOUBLE, value_text STRING, quality STRING NOT NULL, unit STRING NOT NULL, "
    "seq BIGINT NOT NULL, producer STRING NOT NULL, ingest_ts TIMESTAMP NOT NULL"
)

DIM_TAG = schema_of(
    "tag_id STRING, asset_id STRING, asset_name STRING, asset_type STRING, area_code STRING, "
    "area_name STRING, measure STRING, instrument_type STRING, unit STRING, value_class STRING, "
    "sample_hz DOUBLE, nominal DOUBLE, lo_lo DOUBLE, lo DOUBLE, hi DOUBLE, hi_hi DOUBLE, "
    "is_mass_balance BOOLEAN, is_pdm BOOLEAN, enum_values STRING, description STRING"
)

DIM_NODE = schema_of(
    "node_id STRING, node_name STRING, node_type STRING, area_code STRING, balance_role STRING, "
    "accumulation_tag_id STRING, capacity_t DOUBLE, layout_x INT, layout_y INT"
)

DIM_ARC = schema_of(
    "arc_id STRING, from_node_id STRING, to_node_id STRING, arc_name STRING, design_tph DOUBLE, "
    "measure_tag_id STRING, measure_method STRING, stream_type STRING"
)

DIM_RULE = schema_of(
    "rule_id STRING, rule_name STRING, scope_type STRING, scope_value STRING, rule_type STRING, "
    "severity STRING, window_seconds INT, message_template STRING, enabled BOOLEAN"
)

CHANGE_FEED_COLUMNS = ["_pg_change_type", "_pg_lsn", "_pg_xid", "_timestamp", "_sort_by"]

VIBRATION_FEATURE_COLUMNS = [
    "asset_id", "tag_id", "window_start", "window_end", "rms_mm_s", "peak_mm_s", "crest_factor",
    "kurtosis", "stddev_mm_s", "sample_count", "rms_delta_1h", "rms_delta_24h", "rms_slope_24h",
    "rms_pct_of_baseline", "bearing_temp_c", "motor_current_a", "throughput_tph", "run_minutes",
    "hours_since_maintenance", "iso_10816_zone", "label_failure_30d",
]

ALERT_COLUMNS = [
    "alert_id", "raised_at", "tag_id", "asset_id", "area_code", "node_id", "rule_id", "rule_name",
    "rule_type", "severity", "trigger_value", "trigger_text", "limit_low", "limit_high", "message",
    "delivery_status", "delivery_attempts", "delivered_at", "http_status", "acknowledged_by",
    "acknowledged_at",
]

# The enumerations the plant contract allows.
QUALITIES = ["GOOD", "BAD", "UNCERTAIN", "STALE"]
ORDER_STATUSES = ["OPEN", "IN_PROGRESS", "ON_HOLD", "CLOSED", "CANCELLED"]
ORDER_PRIORITIES = ["CRITICAL", "HIGH", "MEDIUM", "LOW"]
NOTE_KINDS = ["DIAGNOSIS", "ACTION", "PARTS", "HANDOVER", "SAFETY"]
