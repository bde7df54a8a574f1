"""Threshold rules that turn one reading into an anomaly flag and a reason text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: rule limits, all strict, and the reading assumed when one is missing ---
PASSENGER_MAX_RPM, OTHER_MAX_RPM = 6500.0, 4200.0
STALL_BELOW_RPM, STALL_ABOVE_SPEED = 500.0, 10.0
MAX_COOLANT = 115.0
COMMERCIAL_MIN_VOLT, COMMERCIAL_MAX_VOLT = 22.0, 30.0
OTHER_MIN_VOLT, OTHER_MAX_VOLT = 11.5, 16.0
BUSY_RPM, MIN_AIRFLOW = 2500.0, 2.0
SLIP_ABOVE_THROTTLE, SLIP_BELOW_SPEED = 75.0, 5.0

ASSUMED_READING = {
    "rpm": 0.0,
    "speed": 0.0,
    "battery_voltage": 14.0,
    "coolant_temp": 90.0,
    "throttle_position": 0.0,
    "maf": 0.0,
}
ASSUMED_CLASS = "PASSENGER"

EXTREME_RPM = "Extreme RPM"
STALL_RISK = "Engine Stall Risk"
OVERHEATING = "Overheating"
LOW_VOLTAGE = "Low Voltage (Alternator Failure)"
OVER_VOLTAGE = "Over-voltage (Regulator Failure)"
AIRFLOW_FAULT = "MAF Sensor Failure / Implausibility"
SLIP = "Transmission Slip / Stuck Throttle"
NO_ANOMALY = "Normal"
REASON_SEPARATOR = "; "
# --- end of fixed values ---


def _reading(name: str) -> Column:
    # Rules see doubles: storage narrows to float only afterwards.
    return F.coalesce(F.col(name).cast("double"), F.lit(ASSUMED_READING[name]))


def fired_rules() -> Column:
    """Reasons joined in rule order; the empty string when no rule fires.

    A class that is neither PASSENGER nor COMMERCIAL gets the lower engine-speed limit but the 12 V
    limits, so the two class tests below are deliberately different.
    """
    vehicle_class = F.coalesce(F.col("vehicle_class"), F.lit(ASSUMED_CLASS))
    rpm, speed, throttle = _reading("rpm"), _reading("speed"), _reading("throttle_position")
    volt, coolant, maf = _reading("battery_voltage"), _reading("coolant_temp"), _reading("maf")

    max_rpm = F.when(vehicle_class == "PASSENGER", PASSENGER_MAX_RPM).otherwise(OTHER_MAX_RPM)
    heavy = vehicle_class == "COMMERCIAL"
    min_volt = F.when(heavy, COMMERCIAL_MIN_VOLT).otherwise(OTHER_MIN_VOLT)
    max_volt = F.when(heavy, COMMERCIAL_MAX_VOLT).otherwise(OTHER_MAX_VOLT)
    busy = rpm > BUSY_RPM

    return F.concat_ws(
        REASON_SEPARATOR,
        F.when(rpm > max_rpm, EXTREME_RPM).when(
            (rpm < STALL_BELOW_RPM) & (speed > STALL_ABOVE_SPEED), STALL_RISK
        ),
        F.when(coolant > MAX_COOLANT, OVERHEATING),
        F.when(volt < min_volt, LOW_VOLTAGE).when(volt > max_volt, OVER_VOLTAGE),
        F.when(busy & (maf < MIN_AIRFLOW), AIRFLOW_FAULT),
        F.when((throttle > SLIP_ABOVE_THROTTLE) & (speed < SLIP_BELOW_SPEED) & busy, SLIP),
    )
