"""Rows laid out by vehicle and time at once."""

import datetime as dt
import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from motorlytics.sources.clustering import cell, clustered, edges_of, interleaved
from motorlytics.sources.tables import EVENT_DATE, with_event_date, write_telemetry
from motorlytics.streaming.bronze_table import BronzeTable

START = 1_704_067_200  # a midnight


def readings(spark, vehicles=64, per_vehicle=288, hot=0):
    """Each vehicle every five minutes of a day, and the first one ``hot`` times as often."""
    one = spark.range(vehicles * per_vehicle).select(
        F.format_string("v%03d", F.col("id") % vehicles).alias("vehicle_id"),
        F.timestamp_seconds(F.lit(START) + F.floor(F.col("id") / vehicles) * (86_400 // per_vehicle)).alias("timestamp"), "id")
    more = one.filter("vehicle_id = 'v000'").withColumn("n", F.explode(F.array_repeat(F.lit(0), hot))).drop("n")
    return with_event_date(one.unionByName(more))


def read_by(folder, vehicle=None, hour=None):
    """Files of a folder, and how many of them have a row group whose statistics admit the lookup."""
    files = glob.glob(f"{folder}/**/*.parquet", recursive=True)
    low = dt.datetime.fromtimestamp(START + 3600 * hour, dt.timezone.utc) if hour is not None else None

    def admits(path):
        meta = pq.ParquetFile(path).metadata
        names = meta.schema.names
        for g in range(meta.num_row_groups):
            group = meta.row_group(g)
            v, t = (group.column(names.index(c)).statistics for c in ("vehicle_id", "timestamp"))
            if vehicle and not v.min <= vehicle <= v.max:
                continue
            if low and not (t.min < low + dt.timedelta(hours=1) and low <= t.max):
                continue
            return True
        return False

    return len(files), sum(map(admits, files))


def test_bits_in_turn(spark):
    got = spark.range(64).select(interleaved(F.shiftright("id", 3).cast("int"), F.col("id").bitwiseAND(F.lit(7)).cast("int"), 3).alias("z"), "id").collect()
    for row in got:
        one, other = f"{row.id >> 3:03b}", f"{row.id & 7:03b}"
        assert row.z == int("".join(a + b for a, b in zip(one, other)), 2)


def test_edges_and_cells(spark):
    rows = readings(spark, hot=20)
    edges = edges_of(rows, "vehicle_id", 8)
    assert edges == sorted(set(edges)) and 4 <= len(edges) <= 7 and edges_of(rows.limit(0), "vehicle_id", 8) == []
    placed = rows.withColumn("z", cell(edges, 3))
    assert placed.agg(F.min("z"), F.max("z")).first()[0] == 0 and placed.filter("z >= 64 or z is null").count() == 0
    none = spark.createDataFrame([(None, None)], "vehicle_id string, timestamp timestamp")
    assert none.select(cell(edges, 3)).first()[0] == 0 == none.select(cell([], 3)).first()[0]


@pytest.mark.parametrize("hot", [0, 30])
def test_lookups_by_vehicle_and_by_hour_read_few_files(spark, tmp_path, hot):
    rows = readings(spark, hot=hot)
    order = [EVENT_DATE, "vehicle_id", "timestamp"]
    layouts = {"cells": clustered(rows, files=64), "ranges": rows.repartitionByRange(64, *order).sortWithinPartitions(*order)}
    read = {}
    for name, frame in layouts.items():
        frame.write.partitionBy(EVENT_DATE).parquet(f"{tmp_path}/{name}")
        assert spark.read.parquet(f"{tmp_path}/{name}").count() == rows.count()
        read[name] = [read_by(f"{tmp_path}/{name}", v, h) for v, h in (("v040", 7), ("v040", None), (None, 7))]
    files, one = read["cells"][0]
    assert files >= 40 and one <= 4  # a vehicle's hour
    assert read["cells"][1][1] <= files / 2 and read["cells"][2][1] <= files / 2  # either of them alone
    if not hot:
        assert read["ranges"][2][1] == read["ranges"][2][0]  # plain ranges: an hour is in every file


def test_interleaved_bronze_has_the_same_rows(bronze_rows, spark, tmp_path):
    data = [(f"V{k % 7}", 900.0 * k, {}, k) for k in range(60)] + [(None, 5.0, {}, 60)]
    table = BronzeTable(spark, str(tmp_path), fan_in=2, interleaved=True, seq="long")
    for n in range(0, 61, 8):
        table.add(bronze_rows(data[n : n + 8]), n // 8)
        table.compact()
    assert sorted(r.seq for r in table.read().select("seq").collect()) == list(range(61))
    assert max(e.level for e in table.manifest.entries()) >= 2


def test_stored_bronze_has_statistics_of_time(bronze_rows, tmp_path):
    write_telemetry(bronze_rows([(f"V{k % 3}", 60.0 * k) for k in range(40)]), f"{tmp_path}/b")
    for path in glob.glob(f"{tmp_path}/b/**/*.parquet", recursive=True):
        meta = pq.ParquetFile(path).metadata
        stats = meta.row_group(0).column(meta.schema.names.index("timestamp")).statistics
        assert stats.has_min_max and isinstance(stats.max, dt.datetime)
