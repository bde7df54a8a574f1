"""Per-vehicle metrics, penalties and the health score."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from motorlytics.functions import scoring
from motorlytics.schemas import HEALTH_COLUMNS

PENALTIES = ("anomaly_penalty", "thermal_penalty", "electrical_penalty", "mechanical_penalty")


def vehicle_metrics(silver: DataFrame, approximate_sessions: bool = False) -> DataFrame:
    """One row per vehicle. ``avg_maf`` is the mean of the rolling mean.

    Model and class are the smallest value seen, so that a rerun gives the same row. All measures merge
    partially in each task; ``approximate_sessions`` trades the exact distinct count for a sketch.
    """
    distinct = F.approx_count_distinct if approximate_sessions else F.count_distinct
    return silver.groupBy("vehicle_id").agg(
        F.min("vehicle_model").alias("vehicle_model"),
        F.min("vehicle_class").alias("vehicle_class"),
        F.avg("coolant_temp").alias("avg_coolant_temp"),
        F.max("coolant_temp").alias("max_coolant_temp"),
        F.avg("battery_voltage").alias("avg_battery_voltage"),
        F.min("battery_voltage").alias("min_battery_voltage"),
        F.avg("rpm").alias("avg_rpm"),
        F.avg("rolling_avg_maf").alias("avg_maf"),
        F.sum("anomaly_flag").alias("total_anomaly_count"),
        F.count(F.lit(1)).alias("total_readings"),
        F.avg("rolling_anomaly_count").alias("avg_rolling_anomaly_count"),
        F.max("coolant_temp_delta").alias("max_coolant_temp_delta"),
        distinct("session_id").alias("total_sessions"),
    )


# Mean measures of a vehicle and the silver column each is the mean of.
_MEANS = {
    "avg_coolant_temp": "coolant_temp",
    "avg_battery_voltage": "battery_voltage",
    "avg_rpm": "rpm",
    "avg_maf": "rolling_avg_maf",
    "avg_rolling_anomaly_count": "rolling_anomaly_count",
}
_LOWEST = ("vehicle_model", "vehicle_class", "min_battery_voltage")
_HIGHEST = ("max_coolant_temp", "max_coolant_temp_delta")
_ADDED = ("total_sessions", "total_anomaly_count", "total_readings", *[f"{m}_{part}" for m in _MEANS for part in ("sum", "count")])


def vehicle_totals(silver: DataFrame, *by: str) -> DataFrame:
    """Metrics in a form that can be added up: sums and counts instead of means.

    Sessions are counted by their starts, which needs silver as a full or continuous refresh gives it, where the first
    reading of a vehicle alone starts without a gap. ``by`` names further columns to keep totals apart by.
    """
    sums = [F.sum(F.col(c).cast("double")).alias(f"{m}_sum") for m, c in _MEANS.items()]
    counts = [F.count(c).alias(f"{m}_count") for m, c in _MEANS.items()]
    return silver.groupBy("vehicle_id", *by).agg(
        F.min("vehicle_model").alias("vehicle_model"),
        F.min("vehicle_class").alias("vehicle_class"),
        F.min("battery_voltage").alias("min_battery_voltage"),
        F.max("coolant_temp").alias("max_coolant_temp"),
        F.max("coolant_temp_delta").alias("max_coolant_temp_delta"),
        F.sum("is_session_start").alias("total_sessions"),
        F.sum("anomaly_flag").alias("total_anomaly_count"),
        F.count(F.lit(1)).alias("total_readings"),
        *sums, *counts,
    )


def merge_totals(totals: DataFrame, *by: str) -> DataFrame:
    """Totals of disjoint sets of readings, combined per vehicle (and ``by``)."""
    return totals.groupBy("vehicle_id", *by).agg(
        *[F.min(c).alias(c) for c in _LOWEST],
        *[F.max(c).alias(c) for c in _HIGHEST],
        *[F.sum(c).alias(c) for c in _ADDED],
    )


def metrics_from_totals(totals: DataFrame) -> DataFrame:
    means = [F.try_divide(F.col(f"{m}_sum"), F.col(f"{m}_count")).alias(m) for m in _MEANS]
    return totals.select("vehicle_id", *_LOWEST, *_HIGHEST, "total_sessions", "total_anomaly_count", "total_readings", *means)


def health_breakdown(metrics: DataFrame) -> DataFrame:
    """Metrics with the anomaly rate, each penalty and the score."""
    rated = metrics.withColumn("anomaly_rate", F.col("total_anomaly_count") / F.col("total_readings"))
    penalised = rated.withColumns({name: getattr(scoring, name)() for name in PENALTIES})
    return penalised.withColumn("health_score", scoring.health_score())


def vehicle_health(silver: DataFrame) -> DataFrame:
    """The gold contract: one scored row per vehicle."""
    return health_breakdown(vehicle_metrics(silver)).select(*HEALTH_COLUMNS)


def vehicle_features(metrics: DataFrame) -> DataFrame:
    """Inputs and target of the risk model, one row per vehicle.

    Only indicators that the score does not use directly: adding its own averages would leak the target.
    """
    scored = health_breakdown(metrics)
    return scored.select(
        "vehicle_id",
        "vehicle_class",
        (F.col("avg_maf") / (F.col("avg_rpm") + 1)).alias("maf_rpm_ratio"),
        (F.col("avg_battery_voltage") - F.col("min_battery_voltage")).alias("volt_volatility"),
        "max_coolant_temp_delta",
        "health_score",
        scoring.at_risk_label().alias("is_at_risk"),
    )
