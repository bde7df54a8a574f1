"""Fleet questions over silver, health and prediction tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from motorlytics.functions import scoring

# --- fixed values: look-back spans, bucket width and list length ---
LIVE_RATE_SPAN = "5 minutes"
SERIES_SPAN = "1 hour"
SERIES_BUCKET = "10 seconds"
WORST_VEHICLES = 20
# --- end of fixed values ---


def as_of_column(as_of: dt.datetime | Column | None) -> Column:
    """The moment "live" queries look back from; the current time unless given (naive means UTC)."""
    if as_of is None:
        return F.current_timestamp()
    if isinstance(as_of, Column):
        return as_of
    if as_of.tzinfo is not None:
        as_of = as_of.astimezone(dt.timezone.utc).replace(tzinfo=None)
    return F.lit(as_of.isoformat(sep=" ")).cast("timestamp_ntz").cast("timestamp")


def recent(rows: DataFrame, span: str, as_of: dt.datetime | Column | None = None) -> DataFrame:
    """Rows strictly newer than ``span`` before ``as_of``; a constant bound that reaches the scan."""
    return rows.filter(F.col("timestamp") > as_of_column(as_of) - F.expr(f"INTERVAL {span}"))


def total_vehicles(health: DataFrame) -> DataFrame:
    return health.agg(F.count_distinct("vehicle_id").alias("total_vehicles"))


def live_anomaly_rate(silver: DataFrame, as_of: dt.datetime | Column | None = None) -> DataFrame:
    return recent(silver, LIVE_RATE_SPAN, as_of).agg((F.avg("anomaly_flag") * 100).alias("anomaly_rate_pct"))


def at_risk_count(predictions: DataFrame) -> DataFrame:
    return predictions.filter(F.col("risk_label") == 1).agg(F.count(F.lit(1)).alias("at_risk_vehicles"))


def health_distribution(health: DataFrame) -> DataFrame:
    counts = health.groupBy(scoring.health_grade().alias("health_grade")).agg(F.count(F.lit(1)).alias("vehicles"))
    return counts.orderBy(F.desc("vehicles"), "health_grade")


def risk_distribution(predictions: DataFrame) -> DataFrame:
    return predictions.groupBy(scoring.risk_text().alias("label")).agg(F.count(F.lit(1)).alias("vehicles"))


def anomaly_series(silver: DataFrame, as_of: dt.datetime | Column | None = None) -> DataFrame:
    """Anomalies per 10 s bucket over the last hour; buckets without readings have no row."""
    bucket = F.window("timestamp", SERIES_BUCKET)["start"]
    counts = recent(silver, SERIES_SPAN, as_of).groupBy(bucket.alias("time")).agg(
        F.sum("anomaly_flag").alias("anomalies"))
    return counts.orderBy("time")


def worst_vehicles(health: DataFrame, predictions: DataFrame, n: int = WORST_VEHICLES,
                   missing_probability: float | None = None) -> DataFrame:
    """The ``n`` lowest scores with their risk. A vehicle without a prediction stays, with NULL (or a given value).

    Both tables have one row per vehicle, so the join neither multiplies rows nor has a hot key, and the
    lowest scores can be picked before it.
    """
    worst = health.orderBy("health_score", "vehicle_id").limit(n).select(
        "vehicle_id", "vehicle_model", "vehicle_class", "health_score", "anomaly_rate")
    joined = worst.join(predictions.select("vehicle_id", "risk_probability"), "vehicle_id", "left")
    if missing_probability is not None:
        joined = joined.fillna(missing_probability, ["risk_probability"])
    return joined.orderBy("health_score", "vehicle_id")


def average_health_by_model(health: DataFrame) -> DataFrame:
    means = health.groupBy("vehicle_model").agg(F.avg("health_score").alias("avg_health"))
    return means.orderBy("avg_health", "vehicle_model")


def kpi_statuses(silver: DataFrame, health: DataFrame, predictions: DataFrame,
                 as_of: dt.datetime | Column | None = None) -> DataFrame:
    """The two fleet numbers and every vehicle's score with their threshold status."""
    rate = live_anomaly_rate(silver, as_of).select(
        F.lit("anomaly_rate").alias("kpi"), F.lit("fleet").alias("subject"), F.col("anomaly_rate_pct").alias("value"))
    count = at_risk_count(predictions).select(
        F.lit("at_risk_vehicles").alias("kpi"), F.lit("fleet").alias("subject"),
        F.col("at_risk_vehicles").cast("double").alias("value"))
    scores = health.select(
        F.lit("health_score").alias("kpi"), F.col("vehicle_id").alias("subject"), F.col("health_score").alias("value"))

    def with_status(df: DataFrame, steps) -> DataFrame:
        return df.withColumn("status", scoring.kpi_status(F.col("value"), steps))

    return (
        with_status(rate, scoring.ANOMALY_RATE_STEPS)
        .unionByName(with_status(count, scoring.AT_RISK_COUNT_STEPS))
        .unionByName(with_status(scores, scoring.HEALTH_SCORE_STEPS))
    )
