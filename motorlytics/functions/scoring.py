"""Health penalties, score, grades and threshold labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: penalty caps, slopes, exponents and starting points ---
ANOMALY_CAP, ANOMALY_EXPONENT, ANOMALY_SLOPE = 40.0, 1.2, 500.0
THERMAL_CAP, MEAN_TEMP_EXPONENT, MEAN_TEMP_SLOPE, PEAK_TEMP_SLOPE = 25.0, 1.8, 5.0, 10.0
MEAN_TEMP_FROM = {"PASSENGER": 108.0, "COMMERCIAL": 110.0}
PEAK_TEMP_FROM = {"PASSENGER": 115.0, "COMMERCIAL": 117.0}
ELECTRICAL_CAP = 20.0
VOLT_FROM = {"PASSENGER": 13.2, "COMMERCIAL": 25.5}
VOLT_SLOPE = {"PASSENGER": 80.0, "COMMERCIAL": 40.0}
MECHANICAL_CAP, MECHANICAL_MIN_RPM, AIRFLOW_FROM, AIRFLOW_SLOPE = 15.0, 1000.0, 0.0015, 30000.0
AT_RISK_BELOW = 70.0
GRADE_STEPS = ((90.0, "Excellent"), (75.0, "Good"), (50.0, "Fair"))
LOWEST_GRADE = "Poor"
AT_RISK, HEALTHY = "At-Risk", "Healthy"
ANOMALY_RATE_STEPS = ((None, "green"), (5.0, "red"))
AT_RISK_COUNT_STEPS = ((None, "green"), (1.0, "red"))
HEALTH_SCORE_STEPS = ((None, "red"), (50.0, "orange"), (80.0, "green"))
# --- end of fixed values ---


def _by_class(per_class: dict[str, Column]) -> Column:
    """One expression per known class; any other class is not penalised."""
    known = None
    for name, expression in per_class.items():
        test = F.col("vehicle_class") == name
        known = F.when(test, expression) if known is None else known.when(test, expression)
    return known.otherwise(0.0)


def _excess(value: Column) -> Column:
    """The positive part, 0 for a missing measure."""
    return F.when(value > 0, value).otherwise(0.0)


def anomaly_penalty() -> Column:
    return F.least(F.lit(ANOMALY_CAP), F.pow("anomaly_rate", F.lit(ANOMALY_EXPONENT)) * ANOMALY_SLOPE)


def thermal_penalty() -> Column:
    mean, peak = F.col("avg_coolant_temp"), F.col("max_coolant_temp").cast("double")
    return _by_class({
        name: F.least(
            F.lit(THERMAL_CAP),
            F.pow(_excess(mean - MEAN_TEMP_FROM[name]), F.lit(MEAN_TEMP_EXPONENT)) * MEAN_TEMP_SLOPE
            + _excess(peak - PEAK_TEMP_FROM[name]) * PEAK_TEMP_SLOPE,
        )
        for name in MEAN_TEMP_FROM
    })


def electrical_penalty() -> Column:
    mean = F.col("avg_battery_voltage")
    return _by_class({
        name: F.least(F.lit(ELECTRICAL_CAP), _excess(start - mean) * VOLT_SLOPE[name])
        for name, start in VOLT_FROM.items()
    })


def mechanical_penalty() -> Column:
    per_turn = F.try_divide(F.col("avg_maf"), F.col("avg_rpm"))
    penalty = F.least(F.lit(MECHANICAL_CAP), _excess(F.lit(AIRFLOW_FROM) - per_turn) * AIRFLOW_SLOPE)
    return F.when(F.col("avg_rpm") > MECHANICAL_MIN_RPM, penalty).otherwise(0.0)


def health_score() -> Column:
    left = (
        F.lit(100.0)
        - F.col("anomaly_penalty")
        - F.col("thermal_penalty")
        - F.col("electrical_penalty")
        - F.col("mechanical_penalty")
    )
    return F.round(F.greatest(F.lit(0.0), F.least(F.lit(100.0), left)), 2)


def at_risk_label(score: str = "health_score") -> Column:
    return (F.col(score) < AT_RISK_BELOW).cast("int")


def health_grade(score: str = "health_score") -> Column:
    (top, best), *rest = GRADE_STEPS
    grade = F.when(F.col(score) >= top, best)
    for bound, name in rest:
        grade = grade.when(F.col(score) >= bound, name)
    return grade.otherwise(LOWEST_GRADE)


def risk_text(label: str = "risk_label") -> Column:
    return F.when(F.col(label) == 1, AT_RISK).otherwise(HEALTHY)


def kpi_status(value: Column, steps: Sequence[tuple[float | None, str]]) -> Column:
    """The name of the highest step whose lower bound the value reaches; NULL for a NULL value."""
    (_, base), *above = steps
    ladder = F.when(value.isNull(), F.lit(None).cast("string"))
    for bound, name in sorted(above, reverse=True):
        ladder = ladder.when(value >= bound, name)
    return ladder.otherwise(base)
