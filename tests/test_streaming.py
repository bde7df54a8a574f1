"""Streams give what the batch form gives."""

import os

import pytest
from conftest import SMALL, at
from pyspark.sql import Window
from pyspark.sql import functions as F

from motorlytics.operators.windows import silver_telemetry
from motorlytics.plans.layers import bronze_from_messages, bronze_from_readings
from motorlytics.sources import derived
from motorlytics.sources.messages import decode_messages, quarantined
from motorlytics.streaming import ingest, live
from motorlytics.streaming.ordered import batches, late_drops, stage_in_order, start_sized, state_partitions
from motorlytics.streaming.refresh import SilverStore


def lines(df):
    return sorted(map(str, df.collect()))


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Messages and bronze rows as folders of three files each, written and therefore read in time order."""
    root = str(tmp_path_factory.mktemp("input"))
    inputs = {"messages": derived.messages(spark, SMALL), "bronze": bronze_from_readings(derived.telemetry(spark, SMALL))}
    for name, rows in inputs.items():
        order = "seq" if name == "messages" else "timestamp"
        thirds = rows.withColumn("_third", F.ntile(3).over(Window.orderBy(order)))
        for third in (1, 2, 3):
            part = thirds.filter(F.col("_third") == third).drop("_third").coalesce(1)
            part.write.mode("append").parquet(f"{root}/{name}")
    return {name: spark.read.parquet(f"{root}/{name}") for name in ("messages", "bronze")}, root


def stream_of(spark, stored, name):
    frames, root = stored
    return spark.readStream.schema(frames[name].schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/{name}")


def drained(stream, path):
    writer = stream.writeStream.format("parquet").option("checkpointLocation", f"{path}/c").trigger(availableNow=True)
    writer.start(f"{path}/o").awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{path}/o")


def test_bronze_and_quarantine(spark, stored, tmp_path):
    query = ingest.start_bronze(stream_of(spark, stored, "messages"), f"{tmp_path}/b", f"{tmp_path}/q", f"{tmp_path}/c", None)
    query.awaitTermination()
    bronze = spark.read.parquet(f"{tmp_path}/b")
    assert bronze.select("batch_id").distinct().count() == 3
    expected = bronze_from_messages(stored[0]["messages"])
    assert lines(bronze.select(*expected.columns)) == lines(expected)
    rejected = quarantined(decode_messages(stored[0]["messages"]))
    assert lines(spark.read.parquet(f"{tmp_path}/q").select(*rejected.columns)) == lines(rejected)


def test_repeated_batch_replaces_its_rows(spark, stored, tmp_path):
    rows = stored[0]["bronze"]
    for _ in range(2):
        ingest.write_batch(rows, f"{tmp_path}/b", 0)
    assert spark.read.parquet(f"{tmp_path}/b").count() == rows.count()


def test_plain_bronze_stream(spark, stored, tmp_path):
    got = drained(ingest.bronze_stream(stream_of(spark, stored, "messages")), tmp_path)
    assert lines(got) == lines(bronze_from_messages(stored[0]["messages"]))


def closed_by(rows, column):
    mark = rows.agg(F.max("timestamp") - F.expr("INTERVAL 10 MINUTES")).first()[0]
    return column <= F.lit(mark.isoformat(sep=" ")).cast("timestamp")


def test_series(spark, stored, tmp_path):
    rows = stored[0]["bronze"]
    batch = live.live_anomaly_series(rows)
    got = drained(live.live_anomaly_series(stream_of(spark, stored, "bronze")), tmp_path)
    assert lines(got) == lines(batch.filter(closed_by(rows, F.col("time") + F.expr("INTERVAL 10 SECONDS"))))


def test_trips(spark, stored, tmp_path):
    rows = stored[0]["bronze"]
    batch = live.trips(rows)
    got = drained(live.trips(stream_of(spark, stored, "bronze")), tmp_path)
    assert lines(got) == lines(batch.filter(closed_by(rows, F.col("ended_at") + F.expr("INTERVAL 300 SECONDS"))))
    assert batch.count() == silver_telemetry(rows).agg(F.sum("is_session_start")).first()[0]


def test_rate_counts_every_reading_once_per_window(bronze_rows):
    rows = bronze_rows([("A", 0, dict(anomaly_flag=1)), ("A", 9.999), ("A", 10), ("A", 299)])
    got = {r["as_of"]: r["anomaly_rate_pct"] for r in live.live_anomaly_rate(rows).collect()}
    assert got[at(10).replace(tzinfo=None)] == 50.0
    assert got[at(300).replace(tzinfo=None)] == 25.0
    assert got[at(310).replace(tzinfo=None)] == 0.0 and max(got) == at(590).replace(tzinfo=None)


def test_duplicates(spark, stored, tmp_path):
    rows = stored[0]["bronze"]
    root = f"{tmp_path}/twice"
    rows.unionByName(rows).write.parquet(root)
    got = drained(live.without_duplicates(spark.readStream.schema(rows.schema).parquet(root)), tmp_path)
    assert lines(got.select("vehicle_id", "timestamp")) == lines(rows.select("vehicle_id", "timestamp"))


def test_silver(spark, stored, tmp_path):
    store = SilverStore(spark, f"{tmp_path}/silver")
    store.start(stream_of(spark, stored, "bronze"), f"{tmp_path}/c", None).awaitTermination()
    assert lines(store.read()) == lines(silver_telemetry(stored[0]["bronze"], keep=("seq",)))


def test_files_in_order_of_time_lose_nothing_over_many_batches(bronze_rows, spark, tmp_path):
    """Two days of readings in six files: in order none is late, in reverse order most are, and the count says how many."""
    data = [("AB"[k % 2], 17.0 * k, dict(anomaly_flag=k % 3 == 0 and 1 or 0), k) for k in range(6000)]
    rows = bronze_rows(data[::-1])
    parts = stage_in_order(rows.repartition(5), f"{tmp_path}/in", rows_per_file=800)
    assert parts >= 6
    source = lambda: spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 2).parquet(f"{tmp_path}/in")

    def run(name):
        writer = live.live_anomaly_series(source()).writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/{name}c")
        query = writer.trigger(availableNow=True).start(f"{tmp_path}/{name}")
        query.awaitTermination()
        return query

    query = run("forward")
    assert batches(query) >= 3 and late_drops(query) == 0
    expected = live.live_anomaly_series(rows).filter(closed_by(rows, F.col("time") + F.expr("INTERVAL 10 SECONDS")))
    assert lines(spark.read.parquet(f"{tmp_path}/forward")) == lines(expected)
    names = sorted(p for p in (tmp_path / "in").iterdir() if p.name.startswith("part-"))
    for number, path in enumerate(reversed(names)):
        os.utime(path, (1_000_000 + number, 1_000_000 + number))
    assert late_drops(run("backward")) > 100


def test_copies_are_merged_before_the_shuffle(spark, tmp_path):
    """One key holds half of the input: what leaves the tasks is bounded by them, and the result is that without merging."""
    hot = spark.range(30_000).select(F.lit("hot").alias("vehicle_id"), F.lit(at(5)).cast("timestamp").alias("timestamp"), F.col("id").alias("n"))
    other = spark.range(30_000).select(F.format_string("v%d", F.col("id") % 50).alias("vehicle_id"),
                                       F.timestamp_seconds(F.lit(int(at(0).timestamp())) + F.floor(F.col("id") / 50)).alias("timestamp"), (-F.col("id")).alias("n"))
    hot.unionByName(other).orderBy(F.rand(3)).repartition(6).write.parquet(f"{tmp_path}/in")
    rows = spark.read.parquet(f"{tmp_path}/in")
    keys = ["vehicle_id", "timestamp"]
    left = live.collapsed(rows, keys)
    assert left.schema == rows.schema and left.filter("vehicle_id = 'hot'").count() <= 2 * rows.rdd.getNumPartitions()
    assert left.filter("vehicle_id <> 'hot'").count() == 30_000
    assert live.collapsed(rows, keys, remembered=0).select(keys).distinct().count() == 30_001
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 3).parquet(f"{tmp_path}/in")
    plan = live.without_duplicates(stream, collapse=True)
    writer = plan.writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True)
    query = writer.start(f"{tmp_path}/o")
    query.awaitTermination()
    got = spark.read.schema(rows.schema).parquet(f"{tmp_path}/o")
    assert got.count() == 30_001 == got.select(keys).distinct().count()
    reached = sum(op["customMetrics"]["numDroppedDuplicateRows"] for p in query.recentProgress for op in p["stateOperators"])
    assert reached <= 2 * 6  # of 30,000 copies


def test_merging_copies_keeps_nulls_and_other_columns(spark):
    rows = spark.createDataFrame(
        [(None, None, [1]), (None, None, [2]), ("a", None, None), ("a", at(1), [3]), ("a", at(1), [3]), (None, at(1), [])] * 3,
        "vehicle_id string, timestamp timestamp, k0 array<int>").coalesce(1)
    got = live.collapsed(rows, ["vehicle_id", "timestamp"])
    assert sorted(map(str, (tuple(r)[:2] for r in got.collect()))) == sorted(map(str, (tuple(r)[:2] for r in rows.limit(6).dropDuplicates(["vehicle_id", "timestamp"]).collect())))
    assert got.filter("vehicle_id is null and timestamp is null").first().k0 == [1] and got.count() == 4
    assert live.collapsed(rows.limit(0), ["vehicle_id"]).count() == 0 and live.collapsed(rows, ["timestamp", "vehicle_id"]).count() == 4


def test_state_is_cut_by_the_size_of_a_batch_not_of_the_table(bronze_rows, spark, tmp_path):
    rows = bronze_rows([("AB"[k % 2], 17.0 * k, dict(anomaly_flag=k % 2), k) for k in range(600)])
    stage_in_order(rows, f"{tmp_path}/in", rows_per_file=200, partitions=1)
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "300")
    try:
        assert state_partitions(spark, 200) == spark.sparkContext.defaultParallelism and state_partitions(spark, 10**9) == 300
        writer = live.live_anomaly_series(stream).writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/c")
        query = start_sized(writer.trigger(availableNow=True), f"{tmp_path}/o", 200, spark)
        query.awaitTermination()
        assert spark.conf.get("spark.sql.shuffle.partitions") == "300"
        spark.conf.set("spark.sql.shuffle.partitions", "2")
        assert state_partitions(spark, 200) == 2
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    steps = [op["numShufflePartitions"] for p in query.recentProgress for op in p["stateOperators"]]
    assert batches(query) == 3 and set(steps) == {spark.sparkContext.defaultParallelism}
    expected = live.live_anomaly_series(rows).filter(closed_by(rows, F.col("time") + F.expr("INTERVAL 10 SECONDS")))
    assert lines(spark.read.parquet(f"{tmp_path}/o")) == lines(expected)
