"""Decoding: what is accepted, what is quarantined and why."""

import json

import pytest
from pyspark.sql import functions as F

from motorlytics.operators.readings import bronze, flatten
from motorlytics.plans.layers import bronze_from_messages
from motorlytics.schemas import BRONZE_COLUMNS, OBD_FIELDS
from motorlytics.sources import derived, messages as m
from motorlytics.streaming import ingest
from motorlytics.streaming.bronze_table import BronzeTable

OBD = dict(rpm=800, speed=0.0, throttle_position=0.0, coolant_temp=90.0, battery_voltage=14.0, maf=5.0, fuel_level=100.0)
GOOD = dict(timestamp="2026-02-22T12:00:00Z", vehicle_id="TEST_001", vehicle_model="Maruti Suzuki Swift",
            vehicle_class="PASSENGER", obd=OBD, gps=dict(latitude=37.7749, longitude=-122.4194))


def without(*keys):
    return json.dumps({k: v for k, v in GOOD.items() if k not in keys})


def having(**changes):
    return json.dumps({**GOOD, **changes})


CASES = {
    "good": (json.dumps(GOOD), None),
    "no groups": (without("obd", "gps"), None),
    "no class": (without("vehicle_class"), None),
    "missing reading": (having(obd={k: v for k, v in OBD.items() if k != "maf"}), None),
    "extra fields": (having(trip={"driver": "d"}, obd={**OBD, "torque": "high", "rpm2": None}), None),
    "reading in exponent form": (json.dumps(GOOD).replace('"rpm": 800', '"rpm": 8e2'), None),
    "repeated key": (json.dumps(GOOD)[:-1] + ', "vehicle_id": "TEST_001"}', None),
    "leading blanks": ("  \n" + json.dumps(GOOD) + "\n ", None),
    "null obd": (having(obd=None), "wrong_type:obd"),
    "obd is a number": (having(obd=3), "wrong_type:obd"),
    "gps is a list": (having(gps=[1, 2]), "wrong_type:gps"),
    "null reading": (having(obd={**OBD, "rpm": None}), "wrong_type:obd.rpm"),
    "text reading": (having(obd={**OBD, "rpm": "12"}), "wrong_type:obd.rpm"),
    "truth value reading": (having(obd={**OBD, "speed": True}), "wrong_type:obd.speed"),
    "not a number": (having(obd={**OBD, "speed": "NaN"}), "wrong_type:obd.speed"),
    "null latitude": (having(gps=dict(latitude=None, longitude=1.0)), "wrong_type:gps.latitude"),
    "number as id": (having(vehicle_id=42), "wrong_type:vehicle_id"),
    "number as time": (having(timestamp=1700000000), "wrong_type:timestamp"),
    "null class": (having(vehicle_class=None), "wrong_type:vehicle_class"),
    "no id": (without("vehicle_id"), "missing_vehicle_id"),
    "no time": (without("timestamp"), "missing_timestamp"),
    "bad time": (having(timestamp="bad"), "bad_timestamp"),
    "year only": (having(timestamp="2026"), "bad_timestamp"),
    "impossible date": (having(timestamp="2026-02-30T00:00:00Z"), "bad_timestamp"),
    "cut off": (json.dumps(GOOD)[:-9], "malformed_json"),
    "two messages": (json.dumps(GOOD) * 2, "malformed_json"),
    "two messages with a comma": (json.dumps(GOOD) + "," + json.dumps(GOOD), "malformed_json"),
    "text after": (json.dumps(GOOD) + " x", "malformed_json"),
    "one brace too many": (json.dumps(GOOD) + "}", "malformed_json"),
    "single quotes": (json.dumps(GOOD).replace('"', "'"), "malformed_json"),
    "bare NaN": (json.dumps(GOOD).replace('"rpm": 800', '"rpm": NaN'), "malformed_json"),
    "a list": (f"[{json.dumps(GOOD)}]", "not_an_object"),
    "a text": ('"x"', "not_an_object"),
    "empty": ("", "malformed_json"),
    "nothing": (None, "malformed_json"),
}


@pytest.fixture(scope="module")
def decoded(spark):
    rows = [(name, value) for name, (value, _) in CASES.items()]
    return m.decode_messages(spark.createDataFrame(rows, "name string, value string")).cache()


@pytest.mark.parametrize("name", CASES)
def test_decision(decoded, name):
    assert decoded.filter(F.col("name") == name).first()["reject_reason"] == CASES[name][1]


def test_every_message_is_either_accepted_or_quarantined(decoded):
    assert m.accepted(decoded).count() + m.quarantined(decoded).count() == len(CASES)
    assert set(m.quarantined(decoded).columns) == {"name", "value", "reject_reason"}
    counts = {r[0]: r[1] for r in m.quarantine_counts(decoded).collect()}
    assert counts["malformed_json"] == 9 and sum(counts.values()) == sum(r is not None for _, r in CASES.values())


def test_bronze_row(decoded):
    row = bronze(m.accepted(decoded).filter("name = 'good'")).first()
    assert tuple(row.asDict()) == BRONZE_COLUMNS
    assert (row["rpm"], row["latitude"], row["anomaly_flag"], row["anomaly_reason"]) == (800.0, 37.7749, 0, "Normal")


def test_missing_parts_are_stored_as_null_and_unknown(decoded):
    rows = bronze(m.accepted(decoded), keep=("name",))
    row = {r["name"]: r for r in rows.collect()}
    assert all(row["no groups"][f] is None for f in OBD_FIELDS) and row["no groups"]["anomaly_reason"] == "Normal"
    assert row["no class"]["vehicle_class"] == "Unknown"
    assert row["missing reading"]["maf"] is None and row["missing reading"]["rpm"] == 800.0


@pytest.mark.parametrize("text, expected", [
    ("2026-02-22T12:00:00Z", "2026-02-22 12:00:00"),
    ("2026-02-22T12:00:00+00:00", "2026-02-22 12:00:00"),
    ("2026-02-22T12:00:00.123456+00:00", "2026-02-22 12:00:00.123"),
    ("2026-02-22T12:00:00.5+05:30", "2026-02-22 06:30:00.5"),
    ("2026-02-22 12:00:00", "2026-02-22 12:00:00"),
    ("2026-02-22", "2026-02-22 00:00:00"),
])
def test_times(spark, text, expected):
    value = having(timestamp=text)
    row = bronze(m.accepted(m.decode_messages(spark.createDataFrame([(value,)], "value string"))))
    assert row.select(F.col("timestamp").cast("string")).first()[0] == expected


def test_framed_bytes(spark):
    frame = spark.createDataFrame([(bytearray(b"\0\0\0\0\7" + json.dumps(GOOD).encode()),)], "value binary")
    assert m.accepted(m.decode_messages(frame, framed=True)).first()["vehicle_id"] == "TEST_001"
    assert m.decode_messages(frame).first()["reject_reason"] == "malformed_json"


def test_flatten_precedence(spark):
    row = spark.sql("SELECT 1 AS a, 1 AS b, named_struct('a', 2, 'c', 2) AS obd, named_struct('c', 3, 'a', 3) AS gps")
    assert flatten(row).first().asDict() == {"a": 3, "b": 1, "c": 3}


def test_round_trip(spark, decoded):
    good = m.accepted(decoded).filter("name = 'good'")
    encoded = m.encode_messages(good)
    assert encoded.first()["key"] == "TEST_001"
    assert json.loads(encoded.first()["value"]) == {**GOOD, "obd": {k: float(v) for k, v in OBD.items()}}
    stored = m.encode_messages(bronze(good))
    again = bronze(m.accepted(m.decode_messages(stored)))
    assert again.drop("key").first() == bronze(good).first()
    assert len(m.encode_messages(good, key="random").first()["key"]) == 36


def test_topic_options():
    secure = m.broker_options("h:1", "user", 'p"w')
    assert secure["kafka.security.protocol"] == "SASL_SSL" and secure["kafka.sasl.mechanism"] == "PLAIN"
    assert r'password="p\"w"' in secure["kafka.sasl.jaas.config"]
    assert "kafka.security.protocol" not in m.broker_options("h:1")
    options = m.topic_source_options(secure, max_offsets_per_trigger=10)
    assert (options["subscribe"], options["startingOffsets"]) == (m.INPUT_TOPIC, "latest")
    assert options["maxOffsetsPerTrigger"] == "10"


def test_iso_forms_of_time(spark):
    from pyspark.sql import functions as F

    from motorlytics.functions.times import parse_instant

    midnight, ten = "2024-01-01 00:00:00", "2024-01-01 10:20:30"
    cases = {"20240101T000000": midnight, "20240101": midnight, "2024-W01-1": midnight, "2024W011": midnight, "2024-W01": midnight,
             "2024-01-01T10:20:30Z": ten, "20240101T102030.000+0000": ten, "2024-01-01 12:20:30+02:00": ten, "2024-W01-1T10:20:30": ten,
             "2020-W53-5": "2021-01-01 00:00:00", "2024-01-01 10:00:00 America/New_York": None, "2024": None, "10:00:00": None,
             "2023-W53-1": None, "2024-13-01": None, "bad": None, "": None, None: None}
    rows = spark.createDataFrame([(k, v) for k, v in cases.items()], "t string, e string")
    got = rows.select("t", "e", F.date_format(parse_instant(F.col("t")), "yyyy-MM-dd HH:mm:ss").alias("g")).collect()
    assert [(r.t, r.g) for r in got] == [(r.t, r.e) for r in got]


def events_at(spark, path, n):
    """A table of one file, as the given tables are."""
    rows = spark.range(n).select(F.col("id").alias("event_id"), F.expr("timestamp_seconds(1704067200 + id * 97)").alias("ts"),
                                 (F.col("id") % 7).alias("user_id"), F.col("id").cast("double").alias("value"))
    rows.coalesce(1).write.parquet(f"{path}/events.parquet")
    return str(path)


def test_partitions_of_messages_follow_their_rows(spark, tmp_path, monkeypatch):
    folder = events_at(spark, tmp_path, 2000)
    monkeypatch.setattr(derived, "MESSAGES_PER_TASK", 100)
    found = derived.messages(spark, folder)
    assert found.rdd.getNumPartitions() == 20
    assert sorted(r.seq for r in found.select("seq").collect()) == list(range(2000))
    monkeypatch.setattr(derived, "MESSAGES_PER_TASK", 2000)
    assert derived.messages(spark, folder).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism


def test_a_batch_of_one_file_is_decoded_on_all_cores(spark, tmp_path):
    derived.messages(spark, events_at(spark, tmp_path, 1000)).coalesce(1).write.parquet(f"{tmp_path}/in")
    stored = spark.read.parquet(f"{tmp_path}/in")
    source = lambda: spark.readStream.schema(stored.schema).parquet(f"{tmp_path}/in")
    ingest.start_bronze(source(), f"{tmp_path}/b", f"{tmp_path}/q", f"{tmp_path}/c", None).awaitTermination()
    bronze = spark.read.parquet(f"{tmp_path}/b")
    assert len(bronze.inputFiles()) >= spark.sparkContext.defaultParallelism
    expected = bronze_from_messages(stored)
    assert sorted(map(str, bronze.select(*expected.columns).collect())) == sorted(map(str, expected.collect()))
    table = BronzeTable(spark, f"{tmp_path}/t", seq="long")
    ingest.start_bronze_table(source(), table, f"{tmp_path}/tq", f"{tmp_path}/tc", None).awaitTermination()
    assert len(table.read().inputFiles()) >= spark.sparkContext.defaultParallelism and table.read().count() == bronze.count()
    writer = ingest.rejected_stream(source()).writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/rc")
    writer.trigger(availableNow=True).start(f"{tmp_path}/r").awaitTermination()
    rejected = spark.read.parquet(f"{tmp_path}/r")
    assert rejected.count() == 1000 - bronze.count() and rejected.select(F.input_file_name()).distinct().count() > 1
