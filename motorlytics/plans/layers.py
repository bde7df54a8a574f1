"""The layers as one chain of functions, and as SQL views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from motorlytics.operators.health import health_breakdown, vehicle_health, vehicle_metrics
from motorlytics.operators.readings import bronze, detect_anomalies, to_bronze
from motorlytics.operators.windows import silver_telemetry
from motorlytics.schemas import SEQUENCE
from motorlytics.sources.messages import accepted, decode_messages


def bronze_from_messages(messages: DataFrame, framed: bool = False) -> DataFrame:
    return bronze(accepted(decode_messages(messages, framed=framed)))


def bronze_from_readings(readings: DataFrame) -> DataFrame:
    """Bronze from flat, typed readings."""
    keep = tuple(c for c in (SEQUENCE,) if c in readings.columns)
    return to_bronze(detect_anomalies(readings), keep)


def gold_from_bronze(bronze_rows: DataFrame, **silver_options) -> DataFrame:
    return vehicle_health(silver_telemetry(bronze_rows, **silver_options))


def breakdown_from_bronze(bronze_rows: DataFrame, **silver_options) -> DataFrame:
    return health_breakdown(vehicle_metrics(silver_telemetry(bronze_rows, **silver_options)))


def register_views(spark: SparkSession, **layers: DataFrame) -> None:
    """Name the layers for SQL users, e.g. ``register_views(spark, bronze=b, silver=s, gold=g)``."""
    for name, frame in layers.items():
        frame.createOrReplaceTempView(name)
