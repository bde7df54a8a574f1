"""Score, penalties, grades, statuses and features at their limits."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from motorlytics.functions import scoring
from motorlytics.operators.health import PENALTIES, health_breakdown, vehicle_features, vehicle_health
from motorlytics.operators.windows import silver_telemetry
from motorlytics.plans import kpis
from motorlytics.schemas import HEALTH_COLUMNS

USUAL = dict(vehicle_id="V", vehicle_model="M", vehicle_class="PASSENGER", avg_coolant_temp=90.0, max_coolant_temp=100.0,
             avg_battery_voltage=14.0, min_battery_voltage=13.5, avg_rpm=2000.0, avg_maf=10.0, total_anomaly_count=0,
             total_readings=100, avg_rolling_anomaly_count=0.0, max_coolant_temp_delta=1.0, total_sessions=1)
SCHEMA = ", ".join(f"{k} " + ("string" if isinstance(v, str) else "bigint" if isinstance(v, int) else "double")
                   for k, v in USUAL.items())


def scored(spark, *changes):
    rows = [tuple({**USUAL, **c, "vehicle_id": str(i)}.values()) for i, c in enumerate(changes)]
    return [r.asDict() for r in health_breakdown(spark.createDataFrame(rows, SCHEMA)).orderBy("vehicle_id").collect()]


def penalties(row):
    return tuple(round(row[p], 6) for p in PENALTIES)


def test_penalties(spark):
    heavy = dict(vehicle_class="COMMERCIAL", avg_battery_voltage=26.5)
    rows = scored(
        spark, {}, dict(total_anomaly_count=1), dict(avg_coolant_temp=108.0, max_coolant_temp=115.0),
        dict(avg_coolant_temp=109.0, max_coolant_temp=115.5), dict(avg_battery_voltage=13.1),
        {**heavy, "avg_coolant_temp": 110.0, "max_coolant_temp": 117.0}, {**heavy, "avg_battery_voltage": 25.4},
        dict(avg_rpm=1000.0, avg_maf=0.0), dict(avg_rpm=2000.0, avg_maf=2.8))
    assert penalties(rows[0]) == (0, 0, 0, 0) and rows[0]["health_score"] == 100.0
    assert rows[1]["anomaly_penalty"] == pytest.approx(0.01 ** 1.2 * 500)
    assert penalties(rows[2]) == (0, 0, 0, 0)
    assert penalties(rows[3]) == (0, 10.0, 0, 0)
    assert penalties(rows[4]) == (0, 0, 8.0, 0)
    assert penalties(rows[5]) == (0, 0, 0, 0)
    assert penalties(rows[6]) == (0, 0, 4.0, 0)
    assert penalties(rows[7]) == (0, 0, 0, 0)
    assert penalties(rows[8]) == (0, 0, 0, 3.0)


def test_every_cap_gives_zero_and_unknown_class_is_spared(spark):
    worst = dict(total_anomaly_count=100, avg_coolant_temp=130.0, max_coolant_temp=140.0, avg_battery_voltage=9.0, avg_maf=0.0)
    capped, unknown = scored(spark, worst, {**worst, "vehicle_class": "Unknown"})
    assert penalties(capped) == (40, 25, 20, 15) and capped["health_score"] == 0.0
    assert penalties(unknown) == (40, 0, 0, 15) and unknown["health_score"] == 45.0


def test_labels_grades_and_statuses(spark):
    scores = spark.createDataFrame([(s,) for s in (100.0, 90.0, 89.99, 80.0, 75.0, 70.0, 69.99, 50.0, 49.99)], "health_score double")
    status = scoring.kpi_status(F.col("health_score"), scoring.HEALTH_SCORE_STEPS)
    got = scores.select(scoring.at_risk_label(), scoring.health_grade(), status).collect()
    assert [r[0] for r in got] == [0, 0, 0, 0, 0, 0, 1, 1, 1]
    assert [r[1] for r in got] == ["Excellent", "Excellent", "Good", "Good", "Good", "Fair", "Fair", "Fair", "Poor"]
    assert [r[2] for r in got] == ["green"] * 4 + ["orange"] * 4 + ["red"]
    rates = spark.createDataFrame([(4.99,), (5.0,), (None,)], "v double")
    assert [r[0] for r in rates.select(scoring.kpi_status(F.col("v"), scoring.ANOMALY_RATE_STEPS)).collect()] == ["green", "red", None]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(
    st.sampled_from(["PASSENGER", "COMMERCIAL", "Unknown"]), st.floats(-50, 300), st.floats(-50, 300), st.floats(0, 60),
    st.floats(0, 9000), st.floats(0, 500), st.integers(0, 1000), st.integers(1, 1000)), min_size=1, max_size=40))
def test_score_stays_in_range(spark, rows):
    names = ("vehicle_class", "avg_coolant_temp", "max_coolant_temp", "avg_battery_voltage", "avg_rpm", "avg_maf",
             "total_anomaly_count", "total_readings")
    changes = [dict(zip(names, (*r[:6], min(r[6], r[7]), r[7]))) for r in rows]
    assert all(0.0 <= row["health_score"] <= 100.0 for row in scored(spark, *changes))


def test_health_table(bronze_rows):
    silver = silver_telemetry(bronze_rows([
        ("A", 0, dict(vehicle_model="Z")), ("A", 1000, dict(vehicle_model="B", anomaly_flag=1)), ("B", 0)]))
    got = {r["vehicle_id"]: r for r in vehicle_health(silver).collect()}
    assert tuple(got["A"].asDict()) == HEALTH_COLUMNS
    assert (got["A"]["vehicle_model"], got["A"]["total_readings"], got["A"]["total_sessions"]) == ("B", 2, 2)
    assert (got["A"]["anomaly_rate"], got["B"]["health_score"]) == (0.5, 100.0)


def test_features(spark):
    metrics = spark.createDataFrame([tuple(USUAL.values())], SCHEMA)
    row = vehicle_features(metrics).first()
    assert row["maf_rpm_ratio"] == 10.0 / 2001.0 and row["volt_volatility"] == 0.5 and row["is_at_risk"] == 0


def test_worst_vehicles_keep_unpredicted_ones(spark):
    health = spark.createDataFrame([(f"V{i:02d}", "M", "PASSENGER", float(i // 2), 0.0) for i in range(30)],
                                   "vehicle_id string, vehicle_model string, vehicle_class string, health_score double, anomaly_rate double")
    predictions = spark.createDataFrame([("V01", 0.9), ("V29", 0.1)], "vehicle_id string, risk_probability double")
    got = kpis.worst_vehicles(health, predictions).collect()
    assert [r["vehicle_id"] for r in got] == [f"V{i:02d}" for i in range(20)]
    assert [r["risk_probability"] for r in got[:3]] == [None, 0.9, None]
    filled = kpis.worst_vehicles(health, predictions, 2, missing_probability=0.0).collect()
    assert [r["risk_probability"] for r in filled] == [0.0, 0.9]


def test_live_span_is_strict(bronze_rows):
    from conftest import at

    rows = bronze_rows([("A", 0, dict(anomaly_flag=1)), ("A", 1, dict(anomaly_flag=1)), ("A", 300)])
    assert kpis.live_anomaly_rate(rows, at(300)).first()[0] == 50.0
    series = kpis.anomaly_series(rows, at(300)).collect()
    assert [(r["time"].minute, r["anomalies"]) for r in series] == [(0, 2), (5, 0)]
    assert kpis.live_anomaly_rate(rows).first()[0] is None  # nothing in the last five minutes of today
