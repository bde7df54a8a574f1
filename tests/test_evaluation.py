"""Encoding, split, report, AUC and the model."""

import hashlib
import math
import random

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from motorlytics.operators import evaluation
from motorlytics.plans import risk


def vehicles(spark, n=400, seed=1, distinct=37):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        score = rng.randrange(distinct) / distinct
        label = int(rng.random() < score)
        rows.append((f"V{i}", rng.choice(["COMMERCIAL", "PASSENGER", "Unknown"]), score, label, int(score >= 0.5)))
    return rows, spark.createDataFrame(
        rows, "vehicle_id string, vehicle_class string, risk_probability double, is_at_risk int, risk_label int")


@pytest.mark.parametrize("distinct", [1, 37, 10**6])
def test_auc(spark, distinct):
    rows, df = vehicles(spark, distinct=distinct)
    positives = [r[2] for r in rows if r[3]]
    negatives = [r[2] for r in rows if not r[3]]
    if not positives or not negatives:
        assert evaluation.auc_roc(df).first()["auc_roc"] is None
        return
    won = sum((p > n) + 0.5 * (p == n) for p in positives for n in negatives)
    got = evaluation.auc_roc(df).first()
    assert got["auc_roc"] == pytest.approx(won / len(positives) / len(negatives), abs=1e-12)
    built_in = BinaryClassificationEvaluator(rawPredictionCol="risk_probability", labelCol="is_at_risk", numBins=0)
    assert got["auc_roc"] == pytest.approx(built_in.evaluate(df), abs=1e-9)


def test_auc_with_crowded_scores(spark):
    """Most scores lie in a sliver that any fixed-width bucketing would put into one bucket."""
    df = spark.range(5000).select(
        F.when(F.col("id") % 10 == 0, F.col("id") / 5000).otherwise(0.5 + F.col("id") * 1e-12).alias("risk_probability"),
        (F.xxhash64("id") % 3 == 0).cast("int").alias("is_at_risk"))
    rows = df.collect()
    positives, negatives = ([r[0] for r in rows if r[1] == k] for k in (1, 0))
    won = sum((p > n) + 0.5 * (p == n) for p in positives for n in negatives)
    assert evaluation.auc_roc(df).first()["auc_roc"] == pytest.approx(won / len(positives) / len(negatives), abs=1e-12)


def test_split_is_exact_and_repeatable(spark):
    rows, df = vehicles(spark, n=333)
    got = {r["vehicle_id"]: r["is_test"] for r in evaluation.stratified_split(df.repartition(7)).collect()}
    for label in (0, 1):
        ids = sorted((r[0] for r in rows if r[3] == label), key=lambda v: hashlib.md5(f"42-{v}".encode()).hexdigest())
        cut = math.ceil(len(ids) * 0.2)
        assert [got[v] for v in ids] == [True] * cut + [False] * (len(ids) - cut)


def test_report(spark):
    rows, df = vehicles(spark)
    got = {r["label"]: r for r in evaluation.classification_report(df).collect()}
    f1s = []
    for label in (0, 1):
        hit = sum(r[3] == label and r[4] == label for r in rows)
        said, real = sum(r[4] == label for r in rows), sum(r[3] == label for r in rows)
        row = got[str(label)]
        assert (row["precision"], row["recall"], row["support"]) == (pytest.approx(hit / said), pytest.approx(hit / real), real)
        f1s.append(2 * hit / (said + real))
        assert row["f1"] == pytest.approx(f1s[-1])
    assert got["macro avg"]["f1"] == pytest.approx(sum(f1s) / 2)
    assert got["accuracy"]["f1"] == pytest.approx(sum(r[3] == r[4] for r in rows) / len(rows))
    empty = {r["label"]: r for r in evaluation.classification_report(df.filter("false")).collect()}
    assert empty["accuracy"]["f1"] == 0.0 and empty["0"]["support"] == 0


def test_class_balance_and_encoding(spark):
    df = spark.createDataFrame([("b", 0), ("a", 0), ("b", 1), (None, 0)], "c string, is_at_risk int")
    assert evaluation.class_balance(df).first().asDict() == {"negatives": 3, "positives": 1, "scale_pos_weight": 3.0}
    assert evaluation.class_balance(df.filter("is_at_risk = 0")).first()["scale_pos_weight"] == 1.0
    codes = evaluation.encode_category(df.filter("c IS NOT NULL"), "c", "code")
    assert sorted((r["c"], r["code"]) for r in codes.collect()) == [("a", 0), ("b", 1), ("b", 1)]


def test_model(spark, tmp_path):
    rng = random.Random(4)
    rows = []
    for i in range(300):
        swing = rng.random() * 3
        rows.append((f"V{i}", rng.choice(["COMMERCIAL", "PASSENGER"]), rng.random() / 100, swing,
                     rng.choice([None, rng.random()]), 50.0, int(swing > 2)))
    features = spark.createDataFrame(rows, "vehicle_id string, vehicle_class string, maf_rpm_ratio double, "
                                     "volt_volatility double, max_coolant_temp_delta double, health_score double, is_at_risk int")
    train, test = risk.train_and_test(features)
    assert train.count() + test.count() == 300
    model = risk.fit_risk_model(train, trees=3)
    assert evaluation.auc_roc(risk.score_vehicles(model, test)).first()["auc_roc"] > 0.95
    importance = {r["feature"]: r["importance"] for r in risk.feature_importance(model, features).collect()}
    assert max(importance, key=importance.get) == "volt_volatility" and set(importance) == set(risk.FEATURES)
    risk.save_model(model, str(tmp_path / "model"))
    again = risk.load_model(str(tmp_path / "model"))
    one, two = (sorted(risk.score_vehicles(m, features).select("vehicle_id", "risk_probability").collect()) for m in (model, again))
    assert one == two
    new_class = features.limit(1).withColumn("vehicle_class", F.lit("TRACTOR"))
    predicted = risk.fleet_predictions(model, new_class)
    assert predicted.columns == ["vehicle_id", "risk_probability", "risk_label", "predicted_at"]
    assert predicted.first()["predicted_at"].microsecond == 0


def test_split_keeps_rows_without_label_or_key(spark):
    rows = [(f"V{i}", i % 2 if i % 5 else None) for i in range(200)] + [(None, 1), (None, None)]
    df = spark.createDataFrame(rows, "vehicle_id string, is_at_risk int")
    got = evaluation.stratified_split(df)
    assert got.count() == len(rows)
    assert sum(r["is_test"] for r in got.collect() if r["is_at_risk"] is None) == math.ceil(41 * 0.2)


def test_auc_leaves_out_rows_without_score(spark):
    schema = "is_at_risk int, risk_probability double"
    got = evaluation.auc_roc(spark.createDataFrame([(1, 0.9), (0, 0.1), (0, None), (None, 0.5), (1, float("nan"))], schema)).first()
    assert (got["auc_roc"], got["positives"], got["negatives"], got["skipped"]) == (1.0, 1, 1, 3)
    assert evaluation.auc_roc(spark.createDataFrame([], schema)).first()["auc_roc"] is None


def test_fit_with_many_classes(spark):
    rows = [(f"V{i}", f"class {i % 40}", i % 7 / 7, i % 3 / 3, float(i % 5), int(i % 4 == 0)) for i in range(200)]
    df = spark.createDataFrame(rows, "vehicle_id string, vehicle_class string, maf_rpm_ratio double, volt_volatility double, "
                                     "max_coolant_temp_delta double, is_at_risk int")
    model = risk.fit_risk_model(df, trees=2)
    assert risk.score_vehicles(model, df).count() == 200 and risk.feature_importance(model, df).count() == 4


def test_known_classes_are_numbered_and_the_rest_share_a_number(spark):
    df = spark.createDataFrame([("B",), ("A",), ("text",), (None,)], "c string")
    got = {r["c"]: r["code"] for r in evaluation.encode_known(df, "c", "code", ("B", "A")).collect()}
    assert got == {"A": 0, "B": 1, "text": 2, None: 2}


def test_no_vehicle_leaves_the_predictions_alone(spark, tmp_path):
    from motorlytics.plans import risk

    features = spark.createDataFrame([], "vehicle_id string, vehicle_class string, maf_rpm_ratio double, "
                                         "volt_volatility double, max_coolant_temp_delta double, is_at_risk int")
    assert risk.refresh_predictions(features, str(tmp_path / "predictions")) is None
    assert not (tmp_path / "predictions").exists()
