"""Trees as a relation: a Spark ML model's own scores and importances, and boosting over counted cells."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from motorlytics.operators import evaluation
from motorlytics.plans import boosting, risk

SCHEMA = ("vehicle_id string, vehicle_class string, maf_rpm_ratio double, volt_volatility double, "
          "max_coolant_temp_delta double, health_score double, is_at_risk int")


def fleet(n, seed=4):
    rng, rows = random.Random(seed), []
    for i in range(n):
        swing, ratio = rng.random() * 3, rng.random() / 100
        at_risk = int(swing > 2 or (ratio < 0.002 and rng.random() < 0.7))
        rows.append((f"V{i}", rng.choice(["COMMERCIAL", "PASSENGER", "TRACTOR"]), ratio, swing, rng.choice([None, rng.random()]), 50.0, at_risk))
    return rows


@pytest.fixture(scope="module")
def features(spark):
    return spark.createDataFrame(fleet(400), SCHEMA).cache()


def probabilities(df):
    return {r["vehicle_id"]: (r["risk_probability"], r["risk_label"]) for r in df.collect()}


def test_nodes_of_a_spark_model_score_as_the_model_does(spark, features):
    model = risk.fit_risk_model(features, trees=4)
    nodes = boosting.nodes_of(model)
    assert nodes.schema.names == [part.split()[0] for part in boosting.NODES.split(", ")]
    expected, got = probabilities(risk.score_vehicles(model, features)), probabilities(boosting.scored_by_nodes(nodes, features, trees=4))
    assert got.keys() == expected.keys()
    for key, (p, label) in expected.items():
        assert got[key] == (pytest.approx(p, abs=1e-12), label)


def test_importance_of_a_spark_model_equals_its_own(spark, features):
    model = risk.fit_risk_model(features, trees=4)
    own = {r["feature"]: r["importance"] for r in risk.feature_importance(model, features).collect()}
    ours = {r["feature"]: r["importance"] for r in boosting.importance_from_nodes(boosting.nodes_of(model)).collect()}
    assert ours == {name: pytest.approx(value, abs=1e-9) for name, value in own.items()}


def test_boosting_learns(spark, features):
    train, test = risk.train_and_test(features)
    nodes = boosting.fit_trees(train, trees=20).cache()
    assert evaluation.auc_roc(boosting.scored_by_nodes(nodes, test, trees=20)).first()["auc_roc"] > 0.9
    rows = nodes.collect()
    inner = {(r["tree"], r["node"]): r for r in rows if r["feature"]}
    for r in rows:  # every node but the root is the child of an inner node; both sides of a split hold enough
        assert r["node"] == 0 or (r["tree"], (r["node"] - 1) // 2) in inner
        assert r["node"] == 0 or r["weight"] >= boosting.LEAST_HESSIAN
        assert (r["left"], r["right"]) == ((2 * r["node"] + 1, 2 * r["node"] + 2) if r["feature"] else (None, None))
        assert r["gain"] > boosting.LEAST_GAIN if r["feature"] else r["gain"] == 0
    importance = {r["feature"]: r for r in boosting.importance_from_nodes(nodes).collect()}
    assert set(importance) == set(risk.FEATURES) and sum(r["importance"] for r in importance.values()) == pytest.approx(1)
    assert sum(r["splits"] for r in importance.values()) == len(inner)
    assert max(importance.values(), key=lambda r: r["importance"])["feature"] == "volt_volatility"


def test_each_vehicle_counts_wherever_it_lies(spark, features):
    """Copies of every vehicle change the weights, not what is counted: cells stay, vehicles double."""
    values = boosting.feature_values(features)
    cuts = boosting.cut_points(values)
    once, twice = (boosting.counted_cells(v, cuts) for v in (values, values.unionByName(values).repartition(7)))
    keys = [f"bin_{n}" for n in range(4)] + ["label"]
    assert once.count() == twice.count() <= 32**3 * 3 * 2
    assert twice.select(*keys, "vehicles").exceptAll(once.select(*keys, (2 * F.col("vehicles")).alias("vehicles"))).count() == 0
    assert all(len(c) < boosting.BINS and c == sorted(set(c)) for c in cuts.values())


def test_missing_labels_keys_and_rows(spark, features):
    odd = spark.createDataFrame([("N", "PASSENGER", 0.001, 2.9, None, 1.0, None), (None, None, 0.009, 0.1, 0.5, 1.0, 0)], SCHEMA)
    with_odd = features.where("vehicle_id < 'V3'").unionByName(odd.limit(1))
    assert sorted(boosting.fit_trees(with_odd, trees=2).collect()) == sorted(boosting.fit_trees(features.where("vehicle_id < 'V3'"), trees=2).collect())
    nodes = boosting.fit_trees(features, trees=3).cache()
    scored = boosting.scored_by_nodes(nodes, odd, trees=3)
    assert scored.columns == [*odd.columns, "risk_probability", "risk_label"] and scored.count() == 2
    assert {r["vehicle_id"]: r["risk_label"] for r in scored.collect()} == {"N": 1, None: 0}
    none = boosting.fit_trees(features.limit(0))
    assert none.count() == 0
    assert {r["risk_probability"] for r in boosting.scored_by_nodes(none, odd).collect()} == {0.5}
    assert {r["importance"] for r in boosting.importance_from_nodes(none).collect()} == {0.0}


def test_one_label_only_gives_small_steps_and_no_split(spark, features):
    rows = boosting.fit_trees(features.withColumn("is_at_risk", F.lit(0)), trees=2).collect()
    assert [r["feature"] for r in rows] == [None, None] and all(r["value"] < 0 for r in rows)


def test_predictions_table(spark, features, tmp_path):
    path = str(tmp_path / "predictions")
    assert boosting.refresh_predictions(features.limit(0), path) is None and not (tmp_path / "predictions").exists()
    nodes = boosting.fit_trees(features, trees=2)
    stored = boosting.refresh_predictions(features, path, nodes=nodes)
    assert stored.columns == ["vehicle_id", "risk_probability", "risk_label", "predicted_at"] and stored.count() == 400
    assert stored.first()["predicted_at"].microsecond == 0


def test_scoring_broadcasts_nodes_and_shuffles_vehicles_once(spark, features):
    nodes = boosting.fit_trees(features, trees=2)
    plan = boosting.scored_by_nodes(nodes, features, trees=2)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert plan.count("BroadcastHashJoin") >= 6
