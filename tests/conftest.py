from __future__ import annotations

import datetime as dt
import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from motorlytics.schemas import BRONZE_SCHEMA  # noqa: E402
from motorlytics.session import build_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"
T0 = dt.datetime(2024, 1, 1)


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[8]", spark__sql__shuffle__partitions="4", spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false", spark__driver__memory="6g",
        spark__checkpoint__dir=f"file://{tempfile.mkdtemp(prefix='scratch-')}",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


NORMAL = dict(vehicle_model="M", vehicle_class="PASSENGER", rpm=800.0, speed=0.0, throttle_position=0.0,
              coolant_temp=90.0, battery_voltage=14.0, maf=5.0, fuel_level=50.0, latitude=1.0, longitude=2.0,
              anomaly_flag=0, anomaly_reason="Normal")


def at(seconds: float) -> dt.datetime:
    return (T0 + dt.timedelta(seconds=seconds)).replace(tzinfo=dt.timezone.utc)


@pytest.fixture(scope="session")
def bronze_rows(spark):
    """Bronze rows from (vehicle, seconds, changes) or (vehicle, seconds, changes, seq)."""

    def build(rows, with_seq=True):
        schema = BRONZE_SCHEMA
        data = []
        for number, row in enumerate(rows):
            values = {**NORMAL, "vehicle_id": row[0], "timestamp": at(row[1]), **(row[2] if len(row) > 2 else {})}
            record = [values[f.name] for f in BRONZE_SCHEMA.fields]
            data.append((*record, row[3] if len(row) > 3 else number) if with_seq else tuple(record))
        names = [f.name for f in schema.fields]
        kinds = [f"{f.name} {f.dataType.simpleString()}" for f in schema.fields] + (["seq bigint"] if with_seq else [])
        assert len(names) == 15
        return spark.createDataFrame(data, ", ".join(kinds))

    return build
