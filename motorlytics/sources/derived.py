"""Telemetry and raw messages derived from the ``events`` table.

The given tables hold no vehicle readings, so every event becomes one reading: its value is the fuel
level, the other sensors follow from its ids by integer arithmetic. One query text serves Spark and the SQL check; only the words in ``Dialect`` differ.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from motorlytics.sources.tables import spread


@dataclass(frozen=True)
class Dialect:
    text: str
    reading_time: str
    iso_time: str


MESSAGES_PER_TASK = 190_000

# Event times are compressed 100 times around 2024-01-01, which gives gaps on both sides of a session gap.
SPARK = Dialect(
    text="STRING",
    reading_time=(
        "timestamp_millis((1704067200000000 + (unix_micros(CAST(ts AS TIMESTAMP)) - 1704067200000000) div 100)"
        " div 1000)"
    ),
    iso_time="date_format(timestamp, \"yyyy-MM-dd'T'HH:mm:ss.SSS'Z'\")",
)
DUCKDB = Dialect(
    text="VARCHAR",
    reading_time=(
        "make_timestamp(((1704067200000000 + (epoch_us(ts) - 1704067200000000) // 100) // 1000) * 1000)"
    ),
    iso_time="strftime(timestamp, '%Y-%m-%dT%H:%M:%S.%gZ')",
)


def telemetry_sql(dialect: Dialect, events: str = "events") -> str:
    return f"""
SELECT {dialect.reading_time} AS timestamp,
  concat('V', lpad(CAST(user_id AS {dialect.text}), 6, '0')) AS vehicle_id,
  concat('Model-', lpad(CAST(user_id % 26 AS {dialect.text}), 2, '0')) AS vehicle_model,
  CASE WHEN user_id % 16 = 5 THEN 'Unknown' WHEN user_id % 4 = 3 THEN 'COMMERCIAL' ELSE 'PASSENGER' END
    AS vehicle_class,
  CAST(CASE WHEN fault = 1 THEN 7000 WHEN fault = 2 THEN 300 WHEN fault IN (6, 7) THEN 3000
       ELSE 650 + h1 * 3 END AS FLOAT) AS rpm,
  CAST(CASE WHEN fault = 7 THEN 2 WHEN fault = 2 THEN 40 ELSE h1 * 0.1 END AS FLOAT) AS speed,
  CAST(CASE WHEN fault = 7 THEN 80 ELSE h2 * 0.07 END AS FLOAT) AS throttle_position,
  CAST(CASE WHEN fault = 3 THEN 121.5 ELSE 86 + (user_id % 5) * 4.5 + h2 * 0.008 END AS FLOAT) AS coolant_temp,
  CAST((CASE WHEN user_id % 4 = 3 AND user_id % 16 <> 5 THEN 25.4 ELSE 13.1 END) + (user_id % 7) * 0.2
     + CASE WHEN fault = 4 THEN -5.0 WHEN fault = 5 THEN 6.0 ELSE 0.0 END AS FLOAT) AS battery_voltage,
  CAST(CASE WHEN fault = 6 THEN 0.5 ELSE (650 + h1 * 3) * (0.0012 + (user_id % 6) * 0.0006) END AS FLOAT) AS maf,
  CAST(20 + least(coalesce(value, 0), 1000) * 0.08 AS FLOAT) AS fuel_level,
  CAST(18.976 + h1 * 0.0002 AS DOUBLE) AS latitude,
  CAST(72.7777 + h2 * 0.0002 AS DOUBLE) AS longitude,
  event_id AS seq
FROM (SELECT *, CASE WHEN h3 < (user_id % 10) * 15 THEN 1 + (event_id % 7) ELSE 0 END AS fault
  FROM (SELECT *, (event_id * 7919 + user_id * 104729) % 1000 AS h1,
               (event_id * 6271 + user_id * 15485863) % 1000 AS h2,
               (event_id * 3571 + user_id * 32452843) % 1000 AS h3 FROM {events}) a) b
"""


def message_sql(dialect: Dialect, telemetry: str = "telemetry") -> str:
    """One JSON message per reading; each kind of defect and omission recurs throughout the table."""

    def number(name: str) -> str:
        return f"CAST(CAST({name} AS DOUBLE) AS {dialect.text})"

    def obd(rpm: str, voltage: bool = True) -> str:
        others = ["speed", "throttle_position", "coolant_temp", "maf", "fuel_level"]
        if voltage:
            others.insert(3, "battery_voltage")
        rest = ", ".join(f"', \"{name}\": ', {number(name)}" for name in others)
        return f"concat(', \"obd\": {{\"rpm\": ', {rpm}, {rest}, '}}')"

    return f"""
SELECT seq, CASE kind
    WHEN 1 THEN concat('{{"timestamp": "', iso_time)
    WHEN 12 THEN concat('["', vehicle_id, '"]')
    ELSE concat('{{"vehicle_model": "', vehicle_model, '"', time_part, id_part, class_part, obd_part, gps_part,
                CASE WHEN kind = 10 THEN ', "trip": {{"driver": "d"}}' ELSE '' END, '}}') END AS value
FROM (SELECT seq, kind, iso_time, vehicle_id, vehicle_model,
    CASE kind WHEN 5 THEN ', "timestamp": "bad"' WHEN 13 THEN ''
         ELSE concat(', "timestamp": "', iso_time, '"') END AS time_part,
    CASE kind WHEN 11 THEN ', "vehicle_id": 42' WHEN 14 THEN ''
         ELSE concat(', "vehicle_id": "', vehicle_id, '"') END AS id_part,
    CASE kind WHEN 6 THEN '' ELSE concat(', "vehicle_class": "', vehicle_class, '"') END AS class_part,
    CASE kind WHEN 2 THEN ', "obd": null' WHEN 3 THEN {obd("'null'")} WHEN 4 THEN {obd("'\"12\"'")}
         WHEN 7 THEN '' WHEN 8 THEN {obd(number("rpm"), voltage=False)} ELSE {obd(number("rpm"))} END AS obd_part,
    CASE kind WHEN 9 THEN ''
         ELSE concat(', "gps": {{"latitude": ', {number("latitude")}, ', "longitude": ', {number("longitude")}, '}}')
         END AS gps_part
  FROM (SELECT *, seq % 97 AS kind, {dialect.iso_time} AS iso_time FROM {telemetry}) a) b
"""


def _scan(folder: str) -> str:
    return f"parquet.`{folder}/events.parquet`"


def telemetry(spark: SparkSession, folder: str) -> DataFrame:
    """Flat, typed readings with ``seq`` as the order tiebreaker."""
    return spark.sql(telemetry_sql(SPARK, _scan(folder)))


def messages(spark: SparkSession, folder: str) -> DataFrame:
    """The same readings as raw JSON text (``seq``, ``value``), on all cores even when the table is one file.

    Text is about 20 times the size of the rows it is made of, so partitions are bounded by rows; their number is read from file footers.
    """
    events = spark.read.parquet(f"{folder}/events.parquet").select("event_id", "ts", "user_id", "value")
    events = spread(events, least=-(-events.count() // MESSAGES_PER_TASK))
    query = message_sql(SPARK, f"({telemetry_sql(SPARK, '@events')}) telemetry")
    # Braces of the JSON text are doubled, because the query is formatted to bind the table.
    query = query.replace("{", "{{").replace("}", "}}").replace("@events", "{events}")
    return spark.sql(query, events=events)
