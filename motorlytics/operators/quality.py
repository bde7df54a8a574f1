"""Reading quality: physical bounds, duplicates, class enrichment."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from motorlytics.schemas import SEQUENCE
from motorlytics.sources.fleet import CLASS_PROFILES, DEFAULT_CLASS, PROFILE_FIELDS, class_profiles, model_classes

# --- fixed values: physical bounds of a reading (low, high); None is unbounded ---
BOUNDS = {
    "rpm": (0.0, "max_rpm"),
    "speed": (0.0, "max_speed"),
    "coolant_temp": (40.0, 140.0),
    "throttle_position": (0.0, 100.0),
    "battery_voltage": ("min_volt", None),
    "maf": (0.0, None),
    "fuel_level": (0.0, 100.0),
}
PASSENGER_MIN_VOLT, OTHER_MIN_VOLT = 10.5, 21.0
DECIMALS = 4
# --- end of fixed values ---


def _bound(bound):
    if bound is None or isinstance(bound, float):
        return None if bound is None else F.lit(bound)
    if bound == "min_volt":
        return F.when(F.col("vehicle_class") == "PASSENGER", PASSENGER_MIN_VOLT).otherwise(OTHER_MIN_VOLT)
    limit = F.lit(CLASS_PROFILES[DEFAULT_CLASS][bound])
    for name, profile in CLASS_PROFILES.items():
        limit = F.when(F.col("vehicle_class") == name, profile[bound]).otherwise(limit)
    return limit


def clip_readings(readings: DataFrame) -> DataFrame:
    """Bring readings into their physical range, rounded to 4 decimals.

    ``out_of_bounds`` counts the readings that had to move; a missing reading stays missing.
    """
    clipped, moved = {}, F.lit(0)
    for name, (low, high) in BOUNDS.items():
        value = F.col(name).cast("double")
        low, high = _bound(low), _bound(high)
        limited = value if low is None else F.greatest(value, low)
        limited = limited if high is None else F.least(limited, high)
        clipped[name] = F.when(value.isNotNull(), F.round(limited, DECIMALS))
        moved = moved + F.coalesce((limited != value).cast("int"), F.lit(0))
    return readings.withColumns({**clipped, "out_of_bounds": moved})


def dedupe_readings(readings: DataFrame, keep: str = "last") -> DataFrame:
    """One reading per (vehicle, timestamp): the last (or first) by ``seq``, then by the other columns.

    An aggregate rather than a window: copies collapse before the shuffle, so a key with very many
    copies costs one row per task.
    """
    keys = ["vehicle_id", "timestamp"]
    rest = [c for c in readings.columns if c not in keys]
    rest.sort(key=lambda c: c != SEQUENCE)
    pick = F.max if keep == "last" else F.min
    chosen = readings.groupBy(*keys).agg(pick(F.struct(*rest)).alias("_chosen"))
    return chosen.select(*[F.col(c) if c in keys else F.col(f"_chosen.`{c}`") for c in readings.columns])


def enrich_fleet(readings: DataFrame, profiles: dict | None = None, models: dict | None = None) -> DataFrame:
    """Add the class of the model (PASSENGER for an unlisted one) and the profile of that class.

    Both dimensions come from the fleet configuration, tens of rows, so they are broadcast.
    """
    spark = readings.sparkSession
    by_model = model_classes(spark, models).withColumnRenamed("vehicle_class", "_listed")
    by_class = class_profiles(spark, profiles).withColumnRenamed("vehicle_class", "fleet_class")
    with_class = readings.join(F.broadcast(by_model), "vehicle_model", "left").withColumn(
        "fleet_class", F.coalesce("_listed", F.lit(DEFAULT_CLASS))
    )
    joined = with_class.join(F.broadcast(by_class), "fleet_class", "left")
    return joined.select(*readings.columns, "fleet_class", *PROFILE_FIELDS)
