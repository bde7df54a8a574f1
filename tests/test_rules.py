"""Anomaly rules on both sides of every limit."""

import pytest
from pyspark.sql import functions as F

from motorlytics.operators.readings import detect_anomalies

LOW, OVER = "Low Voltage (Alternator Failure)", "Over-voltage (Regulator Failure)"
MAF, SLIP = "MAF Sensor Failure / Implausibility", "Transmission Slip / Stuck Throttle"
NAMES = ["rpm", "speed", "throttle_position", "coolant_temp", "battery_voltage", "maf"]
USUAL = dict(rpm=800.0, speed=0.0, throttle_position=0.0, coolant_temp=90.0, battery_voltage=14.0, maf=5.0)

CASES = [
    ("PASSENGER", dict(rpm=6500.0), "Normal"),
    ("PASSENGER", dict(rpm=6500.1), "Extreme RPM"),
    ("COMMERCIAL", dict(rpm=4200.0, battery_voltage=26.5), "Normal"),
    ("COMMERCIAL", dict(rpm=4200.1, battery_voltage=26.5), "Extreme RPM"),
    ("PASSENGER", dict(rpm=499.0, speed=10.0), "Normal"),
    ("PASSENGER", dict(rpm=499.0, speed=10.1), "Engine Stall Risk"),
    ("PASSENGER", dict(rpm=500.0, speed=20.0), "Normal"),
    ("PASSENGER", dict(coolant_temp=115.0), "Normal"),
    ("PASSENGER", dict(coolant_temp=115.1), "Overheating"),
    ("PASSENGER", dict(battery_voltage=11.5), "Normal"),
    ("PASSENGER", dict(battery_voltage=11.4), LOW),
    ("PASSENGER", dict(battery_voltage=16.0), "Normal"),
    ("PASSENGER", dict(battery_voltage=16.1), OVER),
    ("COMMERCIAL", dict(battery_voltage=22.0), "Normal"),
    ("COMMERCIAL", dict(battery_voltage=21.9), LOW),
    ("COMMERCIAL", dict(battery_voltage=30.0), "Normal"),
    ("COMMERCIAL", dict(battery_voltage=30.1), OVER),
    ("PASSENGER", dict(rpm=2500.0, maf=0.0), "Normal"),
    ("PASSENGER", dict(rpm=2501.0, maf=1.9), MAF),
    ("PASSENGER", dict(rpm=2501.0, maf=2.0), "Normal"),
    ("PASSENGER", dict(throttle_position=75.1, speed=4.9, rpm=2501.0), SLIP),
    ("PASSENGER", dict(throttle_position=75.0, speed=4.9, rpm=2501.0), "Normal"),
    ("PASSENGER", dict(rpm=7000.0, coolant_temp=120.0, battery_voltage=10.0, maf=1.0, throttle_position=80.0),
     "; ".join(["Extreme RPM", "Overheating", LOW, MAF, SLIP])),
    (None, dict(rpm=5000.0), "Normal"),
    ("Unknown", dict(rpm=5000.0), "Extreme RPM"),
    (None, dict(battery_voltage=26.5), OVER),
    ("Unknown", dict(battery_voltage=26.5), OVER),
    ("PASSENGER", dict.fromkeys(NAMES), "Normal"),
    ("COMMERCIAL", dict.fromkeys(NAMES), LOW),
]


@pytest.fixture(scope="module")
def flagged(spark):
    rows = [(i, cls, *[{**USUAL, **change}[n] for n in NAMES]) for i, (cls, change, _) in enumerate(CASES)]
    schema = "i int, vehicle_class string, " + ", ".join(f"{n} double" for n in NAMES)
    return {r["i"]: r for r in detect_anomalies(spark.createDataFrame(rows, schema)).collect()}


@pytest.mark.parametrize("i", range(len(CASES)))
def test_rule(flagged, i):
    assert flagged[i]["anomaly_reason"] == CASES[i][2]
    assert flagged[i]["anomaly_flag"] == (CASES[i][2] != "Normal")


def test_rules_use_values_before_storage_narrows_them(spark):
    """115.0000001 is 115.0 as a float but fires as the double it arrived as."""
    row = spark.range(1).select(
        F.lit("PASSENGER").alias("vehicle_class"),
        *[F.lit(115.0000001 if n == "coolant_temp" else USUAL[n]).alias(n) for n in NAMES])
    assert detect_anomalies(row).first()["anomaly_reason"] == "Overheating"
