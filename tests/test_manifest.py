"""Tables that list their folders: atomic commits, merging in levels, days that are replaced at once."""

from __future__ import annotations

import datetime as dt
import threading
from concurrent.futures import ThreadPoolExecutor

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from motorlytics.operators import windows
from motorlytics.plans.layers import bronze_from_messages
from motorlytics.schemas import BRONZE_SCHEMA
from motorlytics.sources import derived
from motorlytics.sources.manifest import Entry, Manifest
from motorlytics.streaming import bronze_table, ingest
from motorlytics.streaming.bronze_table import BronzeTable, DayTable


def lines(df):
    return sorted(map(str, df.collect()))


def test_versions_and_what_they_keep(spark, tmp_path):
    table = Manifest(spark, str(tmp_path), retained=2)
    assert table.version() == 0 and table.entries() == [] and table.read(BRONZE_SCHEMA).count() == 0
    folders = [table.write(spark.range(n + 1), f"t{n}") for n in range(4)]
    for n, folder in enumerate(folders):
        assert table.commit(lambda now: [Entry(folder, n)]) == n + 1
    assert [e.folder for e in table.entries()] == folders[-1:] and [e.folder for e in table.entries(3)] == folders[2:3]
    assert len([p for p in (tmp_path / "_versions").iterdir() if p.name.startswith("v")]) == 2
    assert {p.name for p in (tmp_path / "data").iterdir()} == {f.split("/")[1] for f in folders[2:]}
    assert table.read(spark.range(1).schema).count() == 4


def test_writers_at_the_same_time_lose_nothing(spark, tmp_path):
    table, other, seen = Manifest(spark, str(tmp_path)), Manifest(spark, str(tmp_path)), []

    def with_mine(entries):
        if not seen:  # a second writer commits while this one works out its list
            other.commit(lambda now: [*now, Entry("data/_folder=1", 1)])
        seen.append(entries)
        return [*entries, Entry("data/_folder=0", 0)]

    assert table.commit(with_mine) == 2
    assert len(seen) == 2 and {e.batch for e in table.entries()} == {0, 1}


def test_batches_merge_in_levels(bronze_rows, spark, tmp_path):
    table = BronzeTable(spark, str(tmp_path), fan_in=3, seq="long")
    data = [(f"V{k % 7}", 9000.0 * k, {}, k) for k in range(60)]
    counts = []
    for n in range(12):
        rows = bronze_rows(data[5 * n : 5 * n + 5])
        table.add(rows, n)
        table.compact()
        if n % 4 == 1:
            table.add(rows, n)  # the last batch runs again
        counts.append(len(table.manifest.entries()))
    assert lines(table.read().select("seq", *BRONZE_SCHEMA.names)) == lines(bronze_rows(data).select("seq", *BRONZE_SCHEMA.names))
    levels = sorted((e.level, e.batch) for e in table.manifest.entries())
    assert max(level for level, _ in levels) == 2 and max(counts) <= 3 * 3 and counts[-1] < 8
    one = table.read().filter("vehicle_id = 'V3' AND event_date = '2024-01-02'")
    assert "PartitionFilters: [isnotnull(event_date" in one._jdf.queryExecution().executedPlan().toString()


def test_a_merge_that_fails_changes_nothing(bronze_rows, spark, tmp_path, monkeypatch):
    table = BronzeTable(spark, str(tmp_path), fan_in=2, seq="long")
    for n in range(3):
        table.add(bronze_rows([("A", 10 * n, {}, n)]), n)
    before, version = lines(table.read()), table.manifest.version()
    with monkeypatch.context() as broken:
        broken.setattr(table.manifest, "commit", lambda change: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            table.compact()
    assert lines(table.read()) == before and table.manifest.version() == version
    assert table.compact() == 2 and lines(table.read()) == before


def test_days_are_replaced_at_once(bronze_rows, spark, tmp_path, monkeypatch):
    day = 86400
    table = DayTable(spark, str(tmp_path), bronze_rows([("A", 0)]).schema)
    old = bronze_rows([("A", 10, {}, 1), ("A", day, {}, 2), ("B", 2 * day, {}, 3)])
    assert table.merge(old) == 3
    update = bronze_rows([("A", 10, dict(rpm=99.0), 1), ("C", day + 5, {}, 4), ("C", 9 * day, {}, 5)])
    before = lines(table.read())
    with monkeypatch.context() as broken:  # the job ends after the rows are written and before the commit
        broken.setattr(table.manifest, "commit", lambda change: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            table.merge(update, 1)
    assert lines(table.read()) == before
    assert table.merge(update, 1) == 3
    kept = old.filter("seq <> 1").unionByName(update)
    assert lines(table.read()) == lines(kept)
    untouched = [e for e in table.manifest.entries() if e.part == "2024-01-03"]
    assert [e.batch for e in untouched] == [0]
    assert {r["seq"] for r in table.read(dt.date(2024, 1, 2), dt.date(2024, 1, 3)).collect()} == {2, 3, 4}
    none = update.withColumn("timestamp", F.lit(None).cast("timestamp")).limit(1)
    assert table.merge(none, 2) == 1 and table.read().count() == 6 and table.merge(none.filter("false"), 3) == 0


def test_stream_into_the_table_with_merges_between_batches(spark, tmp_path):
    messages = derived.messages(spark, SMALL)
    messages.repartition(7).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(messages.schema).option("maxFilesPerTrigger", "1").parquet(f"{tmp_path}/in")
    table = BronzeTable(spark, f"{tmp_path}/bronze", fan_in=2, seq="long")
    ingest.start_bronze_table(stream, table, f"{tmp_path}/q", f"{tmp_path}/c", None).awaitTermination()
    expected = bronze_from_messages(messages)
    assert lines(table.read().select(*expected.columns)) == lines(expected)
    assert max(e.level for e in table.manifest.entries()) == 2 and len(table.manifest.entries()) <= 4
    assert bronze_table.FAN_IN == 8


def test_counts_beside_the_rows(bronze_rows, spark, tmp_path):
    """Counts follow batches that run again and merges; with them no job runs before silver is asked for."""
    table = BronzeTable(spark, str(tmp_path), fan_in=2, counted=True, seq="long")
    data = [("hot" if k % 3 == 0 else f"V{k % 7}", 9000.0 * k, {}, k) for k in range(60)]
    for n in range(6):
        table.add(bronze_rows(data[10 * n : 10 * n + 5]), n)  # fails halfway, say
        table.add(bronze_rows(data[10 * n : 10 * n + 10]), n)
        table.compact()
    rows = table.read()
    days = {(r[0], r[1]): r[2] for r in rows.groupBy("event_date", "vehicle_id").count().collect()}
    assert {(r[0], r[1]): r[2] for r in table.daily_counts().groupBy("event_date", "vehicle_id").sum("readings").collect()} == days
    assert table.large_vehicles(10) == windows.large_vehicles(rows, 10) == {"hot": 20}
    assert table.large_vehicles(20) == {} and len(table.counts.entries()) < 6
    large = table.large_vehicles(30)
    spark.sparkContext.setJobGroup("silver", "silver")
    try:
        silver = windows.silver_telemetry(rows, keep=("seq",), rows_per_task=30, large=large)
        assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("silver")) == 0
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert silver.count() == 60
    assert BronzeTable(spark, f"{tmp_path}/empty", counted=True).large_vehicles() == {}


def test_levels_that_fill_each_other_are_written_once(bronze_rows, spark, tmp_path, monkeypatch):
    table, written = BronzeTable(spark, str(tmp_path), fan_in=2, seq="long"), []
    write = table.manifest.write
    monkeypatch.setattr(table.manifest, "write", lambda rows, label, by: written.append(label) or write(rows, label, by))
    for n in range(8):
        table.add(bronze_rows([("A", 10 * n, {}, n)]), n)
        table.compact(n)  # a batch's own folder is not merged, whatever else is listed
    table.compact(8)
    assert [(e.level, e.batch) for e in table.manifest.entries()] == [(3, 7)]
    assert [label for label in written if label.startswith("level")] == ["level-1", "level-2", "level-1", "level-3"]
    assert sorted(r.seq for r in table.read().select("seq").collect()) == list(range(8))


def test_bronze_is_merged_while_a_batch_is_added(spark, tmp_path, monkeypatch):
    messages = derived.messages(spark, SMALL).limit(300)
    messages.repartition(3).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(messages.schema).option("maxFilesPerTrigger", "1").parquet(f"{tmp_path}/in")
    table = BronzeTable(spark, f"{tmp_path}/bronze", fan_in=2, seq="long")
    met, add, compact = threading.Barrier(2, timeout=120), table.add, table.compact
    monkeypatch.setattr(table, "add", lambda *args: (met.wait(), add(*args)))
    monkeypatch.setattr(table, "compact", lambda *args: (met.wait(), compact(*args)))
    ingest.start_bronze_table(stream, table, f"{tmp_path}/q", f"{tmp_path}/c", None).awaitTermination()
    expected = bronze_from_messages(spark.read.parquet(f"{tmp_path}/in"))
    assert lines(table.read().select(*expected.columns)) == lines(expected)
    assert sorted((e.level, e.batch) for e in table.manifest.entries()) == [(0, 2), (1, 1)]


def test_threads_that_share_a_list_take_turns(spark, tmp_path):
    table = Manifest(spark, str(tmp_path))

    def add(k):
        table.commit(lambda now: [*now, Entry(f"data/_folder={k}", k)])

    with ThreadPoolExecutor(8) as pool:
        list(pool.map(add, range(24)))
    assert {e.batch for e in table.entries()} == set(range(24)) and table.version() == 24
