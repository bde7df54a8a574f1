"""The risk model: training on vehicle features, scoring the fleet, storing the model."""

from __future__ import annotations

import datetime as dt
import math

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from motorlytics.operators.evaluation import class_balance, stratified_split
from motorlytics.plans.kpis import as_of_column
from motorlytics.schemas import PREDICTION_COLUMNS, PREDICTION_SCHEMA
from motorlytics.sources.fleet import CLASS_PROFILES
from motorlytics.sources.tables import is_empty, rebuild

# --- fixed values: features and model settings ---
NUMERIC_FEATURES = ("maf_rpm_ratio", "volt_volatility", "max_coolant_temp_delta")
TREES, DEPTH, LEARNING_RATE, SEED = 100, 5, 0.1, 42
# --- end of fixed values ---

FEATURES = (*NUMERIC_FEATURES, "vehicle_class")
_NUMBER = "vehicle_class_number"
ROWS_PER_PARTITION = 100_000
# The classes of the fleet in alphabetical order as a plain number, and one more for any other text.
_CASES = " ".join(f"WHEN '{name}' THEN {code}.0D" for code, name in enumerate(sorted(CLASS_PROFILES)))
CLASS_NUMBER = f"CASE vehicle_class {_CASES} ELSE {len(CLASS_PROFILES)}.0D END"


def model_input(features: DataFrame) -> DataFrame:
    """Features without gaps: a vehicle with one reading has no temperature change yet, which counts as 0."""
    return features.fillna(0.0, list(NUMERIC_FEATURES))


def risk_stages(trees: int = TREES) -> Pipeline:
    numbered = SQLTransformer(statement=f"SELECT *, {CLASS_NUMBER} AS {_NUMBER} FROM __THIS__")
    assembler = VectorAssembler(inputCols=[*NUMERIC_FEATURES, _NUMBER], outputCol="features")
    booster = GBTClassifier(labelCol="is_at_risk", featuresCol="features", weightCol="weight", maxIter=trees,
                            maxDepth=DEPTH, stepSize=LEARNING_RATE, seed=SEED)
    return Pipeline(stages=[numbered, assembler, booster])


def fit_risk_model(train: DataFrame, trees: int = TREES) -> PipelineModel:
    """Fit on training rows, one per vehicle. Positives weigh negatives / positives, so both labels count equally.

    Boosting reads the rows hundreds of times: they stay in memory or on disk, in partitions sized to
    their number rather than to the history they were computed from.
    """
    balance = class_balance(train).first()
    weight = F.when(F.col("is_at_risk") == 1, balance["scale_pos_weight"]).otherwise(1.0)
    partitions = math.ceil((balance["negatives"] + balance["positives"]) / ROWS_PER_PARTITION) or 1
    weighted = model_input(train).select(*FEATURES, "is_at_risk", weight.alias("weight"))
    weighted = weighted.repartition(partitions).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return risk_stages(trees).fit(weighted)
    finally:
        weighted.unpersist()


def train_and_test(features: DataFrame) -> tuple[DataFrame, DataFrame]:
    split = stratified_split(features)
    return (split.filter(~F.col("is_test")).drop("is_test"), split.filter("is_test").drop("is_test"))


def score_vehicles(model: PipelineModel, features: DataFrame) -> DataFrame:
    """``features`` with ``risk_probability`` and ``risk_label``."""
    scored = model.transform(model_input(features))
    return scored.select(
        *features.columns,
        vector_to_array("probability")[1].alias("risk_probability"),
        F.col("prediction").cast("int").alias("risk_label"),
    )


def fleet_predictions(model: PipelineModel, features: DataFrame, predicted_at: dt.datetime | None = None) -> DataFrame:
    """The predictions contract for the whole fleet, stamped with the time of the run (or a given one) in whole seconds."""
    time = F.date_trunc("SECOND", as_of_column(predicted_at))
    return score_vehicles(model, features).withColumn("predicted_at", time).select(*PREDICTION_COLUMNS)


def refresh_predictions(features: DataFrame, path: str, predicted_at: dt.datetime | None = None,
                        model: PipelineModel | None = None) -> DataFrame | None:
    """Fit on a stored feature table (unless a model is given), score the fleet, and replace the predictions at ``path``.

    Without any vehicle nothing is fitted or replaced, and the result is None.
    """
    if is_empty(features):
        return None
    model = model or fit_risk_model(train_and_test(features)[0])
    rebuild(fleet_predictions(model, features, predicted_at), path)
    return features.sparkSession.read.schema(PREDICTION_SCHEMA).parquet(path)


def threshold_predictions(features: DataFrame) -> DataFrame:
    """A fixed score from voltage volatility alone: a baseline to compare the model with."""
    probability = 1.0 - F.try_divide(F.lit(1.0), 1.0 + F.col("volt_volatility"))
    return features.withColumn("risk_probability", probability).withColumn(
        "risk_label", (F.col("risk_probability") >= 0.5).cast("int"))


def label_predictions(features: DataFrame) -> DataFrame:
    """Predictions whose label is the health rule itself, with the fixed score as probability."""
    return threshold_predictions(features).withColumn("risk_label", F.col("is_at_risk")).select(
        "vehicle_id", "risk_probability", "risk_label")


def feature_importance(model: PipelineModel, features: DataFrame) -> DataFrame:
    """(feature, importance), as many rows as the model has features."""
    weights = model.stages[-1].featureImportances.toArray()
    rows = [(name, float(weight)) for name, weight in zip(FEATURES, weights)]
    return features.sparkSession.createDataFrame(rows, "feature string, importance double")


def save_model(model: PipelineModel, path: str) -> None:
    """Category codes and trees are stored together, so scoring cannot mix two trainings."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
