"""Fleet dimensions: class profiles and the class of each model."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# --- fixed values: class profiles and models of the fleet ---
CLASS_PROFILES = {
    "PASSENGER": {"idle_rpm": 850.0, "max_rpm": 6500.0, "max_speed": 180.0, "avg_temp": 90.0,
                  "volt_baseline": 14.2, "maf_mult": 0.15},
    "COMMERCIAL": {"idle_rpm": 650.0, "max_rpm": 4000.0, "max_speed": 100.0, "avg_temp": 92.0,
                   "volt_baseline": 26.5, "maf_mult": 0.25},
}
DEFAULT_CLASS = "PASSENGER"
PASSENGER_MODELS = (
    "Maruti Suzuki Swift", "Maruti Suzuki Baleno", "Maruti Suzuki Dzire", "Maruti Suzuki Ertiga",
    "Maruti Suzuki Brezza", "Tata Nexon", "Tata Punch", "Tata Safari", "Tata Harrier", "Hyundai i20",
    "Hyundai Creta", "Hyundai Venue", "Hyundai Verna", "Mahindra XUV700", "Mahindra Scorpio-N",
    "Mahindra Thar", "Toyota Innova Hycross", "Toyota Fortuner", "Kia Seltos", "Kia Sonet",
)
COMMERCIAL_MODELS = (
    "Tata Ace", "Tata Intra", "Mahindra Bolero", "Ashok Leyland Dost", "Force Traveller", "Eicher Pro 2049",
)
# --- end of fixed values ---

MODEL_CLASSES = {
    **dict.fromkeys(PASSENGER_MODELS, "PASSENGER"),
    **dict.fromkeys(COMMERCIAL_MODELS, "COMMERCIAL"),
}
PROFILE_FIELDS = tuple(CLASS_PROFILES[DEFAULT_CLASS])


def load_fleet_config(path: str | None = None) -> tuple[dict, dict]:
    """(profiles, model classes) from a YAML file with those two sections, or the built-in fleet."""
    if path is None:
        return CLASS_PROFILES, MODEL_CLASSES
    import yaml

    with open(path, encoding="utf-8") as handle:
        config = yaml.safe_load(handle)
    return config["profiles"], config["models"]


def class_profiles(spark: SparkSession, profiles: dict | None = None) -> DataFrame:
    profiles = profiles or CLASS_PROFILES
    schema = T.StructType([T.StructField("vehicle_class", T.StringType())]
                          + [T.StructField(name, T.DoubleType()) for name in PROFILE_FIELDS])
    rows = [(name, *[float(profile[f]) for f in PROFILE_FIELDS]) for name, profile in profiles.items()]
    return spark.createDataFrame(rows, schema)


def model_classes(spark: SparkSession, models: dict | None = None) -> DataFrame:
    return spark.createDataFrame(list((models or MODEL_CLASSES).items()),
                                 "vehicle_model string, vehicle_class string")
