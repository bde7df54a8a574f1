"""Declared schemas. Nothing in the package infers one, and every field is nullable."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: field names and order of the message and table contracts ---
IDENTITY_FIELDS = ("timestamp", "vehicle_id", "vehicle_model", "vehicle_class")
OBD_FIELDS = ("rpm", "speed", "throttle_position", "coolant_temp", "battery_voltage", "maf", "fuel_level")
GPS_FIELDS = ("latitude", "longitude")
ROLLING_MEAN_FIELDS = ("coolant_temp", "rpm", "battery_voltage", "maf", "throttle_position")
# --- end of fixed values ---

READING_FIELDS = OBD_FIELDS + GPS_FIELDS
BRONZE_COLUMNS = IDENTITY_FIELDS + READING_FIELDS + ("anomaly_flag", "anomaly_reason")
SILVER_FEATURES = tuple(f"rolling_avg_{name}" for name in ROLLING_MEAN_FIELDS) + (
    "rolling_anomaly_count", "coolant_temp_delta", "is_session_start", "session_id",
)
SILVER_COLUMNS = BRONZE_COLUMNS + SILVER_FEATURES
HEALTH_COLUMNS = (
    "vehicle_id", "vehicle_model", "vehicle_class", "avg_coolant_temp", "max_coolant_temp",
    "avg_battery_voltage", "min_battery_voltage", "avg_rpm", "total_anomaly_count", "total_readings",
    "anomaly_rate", "avg_rolling_anomaly_count", "max_coolant_temp_delta", "total_sessions", "health_score",
)
PREDICTION_COLUMNS = ("vehicle_id", "risk_probability", "risk_label", "predicted_at")

# An optional, strictly increasing ingest number (message offset, event id). It breaks ties between
# readings of one vehicle with the same timestamp; it is not part of the bronze contract.
SEQUENCE = "seq"

BRONZE_SCHEMA = T.StructType(
    [T.StructField("timestamp", T.TimestampType())]
    + [T.StructField(name, T.StringType()) for name in IDENTITY_FIELDS[1:]]
    + [T.StructField(name, T.FloatType()) for name in OBD_FIELDS]
    + [T.StructField(name, T.DoubleType()) for name in GPS_FIELDS]
    + [T.StructField("anomaly_flag", T.IntegerType()), T.StructField("anomaly_reason", T.StringType())]
)

SILVER_SCHEMA = T.StructType(
    list(BRONZE_SCHEMA.fields)
    + [T.StructField(f"rolling_avg_{name}", T.DoubleType()) for name in ROLLING_MEAN_FIELDS]
    + [
        T.StructField("rolling_anomaly_count", T.LongType()),
        T.StructField("coolant_temp_delta", T.DoubleType()),
        T.StructField("is_session_start", T.IntegerType()),
        T.StructField("session_id", T.LongType()),
    ]
)

PREDICTION_SCHEMA = T.StructType(
    [
        T.StructField("vehicle_id", T.StringType()),
        T.StructField("risk_probability", T.DoubleType()),
        T.StructField("risk_label", T.IntegerType()),
        T.StructField("predicted_at", T.TimestampType()),
    ]
)
