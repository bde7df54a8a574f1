"""Sketches per day and trips in slices against exact counts."""

import datetime as dt

from conftest import at
from pyspark.sql import functions as F

from motorlytics.operators import sketches
from motorlytics.operators.windows import silver_telemetry
from motorlytics.streaming import live


def lines(df):
    return sorted(map(str, df.collect()))


def test_sketches_of_days_merge(spark):
    rows = spark.range(200_000).select(
        F.concat(F.lit("V"), F.col("id") % 30_000).alias("vehicle_id"), (F.col("id") % 7).alias("session_id"),
        F.timestamp_seconds(F.col("id") * 3).alias("timestamp"))
    stored = sketches.daily_sketches(rows).cache()
    assert stored.count() == 7 and stored.select(F.max(F.length("vehicles"))).first()[0] < 20_000
    days = [r[0] for r in stored.select("event_date").orderBy("event_date").collect()]
    for first, last in ((None, None), (days[1], days[2]), (days[3], None), (None, days[0])):
        part = rows.withColumn("day", F.to_date("timestamp")).filter(F.col("day").between(first or days[0], last or days[-1]))
        exact = part.agg(F.count_distinct("vehicle_id"), F.count_distinct("vehicle_id", "session_id"), F.count("*")).first()
        got = sketches.distinct_between(stored, first, last).first()
        assert got["readings"] == exact[2]
        for value, wanted in zip(got[:2], exact[:2]):
            assert abs(value - wanted) <= sketches.RELATIVE_ERROR * wanted
    assert tuple(sketches.distinct_between(stored, dt.date(2100, 1, 1)).first()) == (0, 0, 0)


def test_sketches_with_nulls(bronze_rows):
    rows = silver_telemetry(bronze_rows([("A", 0), ("A", 900), ("B", 5)])).withColumn(
        "vehicle_id", F.when(F.col("vehicle_id") == "A", "A"))
    got = sketches.distinct_between(sketches.daily_sketches(rows)).first()
    assert (got["vehicles"], got["sessions"], got["readings"]) == (1, 2, 3)


def test_trips_in_slices(bronze_rows):
    gaps = [0, 300, 600, 901, 1202, 3599, 3600, 3899.999, 4200, 7000, 7200, 7300, 50_000, 50_300, 93_000]
    rows = bronze_rows([("A", t, dict(anomaly_flag=k % 2), k) for k, t in enumerate(gaps)] + [("B", 3500 + 20 * k, {}, 100 + k) for k in range(500)]
                       + [("A", 0, {}, 900), ("B", 3600, {}, 901)])
    for seconds in (60, 3600, 6 * 3600, 10**9):
        assert lines(live.trips_in_slices(rows, seconds)) == lines(live.trips(rows))
    assert live.trips_in_slices(rows.filter("false")).count() == 0


def test_no_task_has_a_vehicle_whole(bronze_rows):
    """The readings are dealt by vehicle and slice; only stretches of slices meet by vehicle."""
    rows = bronze_rows([("A", 100 * k, {}, k) for k in range(2000)])
    text = live.trips_in_slices(rows, 3600)._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in text.split("\n") if "Exchange hashpartitioning" in line]
    keys = [line[line.index("(") + 1 : line.index(")")].split(", ")[:-1] for line in exchanges]
    assert [len(k) for k in keys] == [1, 2] and all("vehicle_id" in k[0] for k in keys)
    stretches = rows.groupBy("vehicle_id", F.floor(F.unix_micros("timestamp") / 3.6e9)).count()
    assert stretches.agg(F.max("count")).first()[0] == 36 and stretches.count() == 56
    assert live.trips_in_slices(rows, 3600).first()["ended_at"] == at(199_900).replace(tzinfo=None)
