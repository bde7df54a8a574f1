"""Stored tables: creation, layout, rebuilds, merges, views."""

import pytest
from conftest import at
from pyspark.sql import functions as F

from motorlytics.operators.windows import silver_telemetry
from motorlytics.plans.layers import register_views
from motorlytics.schemas import BRONZE_COLUMNS, BRONZE_SCHEMA
from motorlytics.sources import tables


def test_create_bronze_table_once(spark, tmp_path, bronze_rows):
    for _ in range(2):
        tables.create_bronze_table(spark, "bronze_made_here", str(tmp_path / "b"))
    rows = tables.with_event_date(bronze_rows([("A", 0)], with_seq=False))
    rows.write.mode("append").insertInto("bronze_made_here")
    tables.create_bronze_table(spark, "bronze_made_here", str(tmp_path / "b"))
    assert spark.table("bronze_made_here").count() == 1
    assert spark.table("bronze_made_here").columns == [*BRONZE_COLUMNS, "event_date"]
    spark.sql("DROP TABLE bronze_made_here")


def test_append_and_reload(spark, tmp_path, bronze_rows):
    path = str(tmp_path / "b")
    rows = bronze_rows([("B", 86_400), ("A", 5), ("A", 1)], with_seq=False)
    tables.write_telemetry(rows, path)
    tables.write_telemetry(rows, path)
    stored = tables.read_telemetry(spark, path, BRONZE_SCHEMA)
    assert stored.count() == 6 and stored.select("event_date").distinct().count() == 2
    tables.write_telemetry(rows.filter("vehicle_id = 'B'"), path, mode="overwrite")
    assert stored.sparkSession.read.parquet(path).count() == 1


def test_files_are_sorted(spark, tmp_path, bronze_rows):
    path = str(tmp_path / "b")
    tables.write_telemetry(bronze_rows([("B", 1), ("A", 5), ("A", 1)], with_seq=False).coalesce(1), path)
    got = [(r[0], r[1]) for r in tables.read_telemetry(spark, path, BRONZE_SCHEMA).select("vehicle_id", "timestamp").collect()]
    assert got == sorted(got)


def test_rebuild_and_empty(spark, tmp_path):
    path = str(tmp_path / "g")
    tables.rebuild(spark.createDataFrame([("B", 1.0), ("A", 2.0)], "vehicle_id string, health_score double"), path)
    tables.rebuild(spark.createDataFrame([("C", 1.0)], "vehicle_id string, health_score double"), path)
    assert [r[0] for r in spark.read.parquet(path).collect()] == ["C"]
    assert not tables.is_empty(spark.read.parquet(path)) and tables.is_empty(spark.read.parquet(path).filter("false"))
    tables.rebuild_table(spark.read.parquet(path), "health_made_here")
    assert spark.table("health_made_here").count() == 1
    spark.sql("DROP TABLE health_made_here")


def test_publish_switches_when_complete(spark, tmp_path):
    def predictions(n):
        return spark.range(n).selectExpr("CAST(id AS string) AS vehicle_id", "0.5D AS risk_probability")

    tables.publish(predictions(2), "predictions_made_here", str(tmp_path))
    tables.publish(predictions(3), "predictions_made_here", str(tmp_path))
    assert spark.table("predictions_made_here").count() == 3
    broken = predictions(3).selectExpr("raise_error('no') AS vehicle_id")
    with pytest.raises(Exception):
        tables.publish(broken, "predictions_made_here", str(tmp_path))
    assert spark.table("predictions_made_here").count() == 3
    spark.sql("DROP VIEW predictions_made_here")


def test_merge_replaces_by_key(bronze_rows):
    target = bronze_rows([("A", 0), ("A", 1), ("B", 0)])
    updates = bronze_rows([("A", 1, dict(rpm=1.0), 9), ("C", 0, {}, 10)])
    got = {(r["vehicle_id"], r["timestamp"]): r["rpm"] for r in tables.merge_by_key(target, updates).collect()}
    assert len(got) == 4 and got["A", at(1).replace(tzinfo=None)] == 1.0


def test_merge_days_rewrites_only_touched_days(spark, tmp_path, bronze_rows):
    path = str(tmp_path / "b")
    tables.write_telemetry(bronze_rows([("A", 0), ("A", 1), ("A", 86_400)], with_seq=False), path)
    other = sorted(p.name for p in (tmp_path / "b" / "event_date=2024-01-02").glob("*.parquet"))
    updates = bronze_rows([("A", 1, dict(rpm=1.0)), ("B", 2)], with_seq=False)
    tables.merge_days(spark, path, BRONZE_SCHEMA, updates)
    tables.merge_days(spark, path, BRONZE_SCHEMA, updates.filter("false"))
    stored = spark.read.parquet(path)
    assert stored.count() == 4 and stored.filter(F.col("rpm") == 1.0).count() == 1
    assert other == sorted(p.name for p in (tmp_path / "b" / "event_date=2024-01-02").glob("*.parquet"))


def test_views(spark, bronze_rows):
    rows = bronze_rows([("A", 0), ("A", 1000)])
    register_views(spark, bronze=rows, silver=silver_telemetry(rows))
    assert spark.sql("SELECT max(session_id) FROM silver JOIN bronze USING (vehicle_id, timestamp)").first()[0] == 2


def test_merge_days_keeps_readings_without_time(spark, tmp_path, bronze_rows):
    path = str(tmp_path / "b")
    rows = bronze_rows([("A", 5), ("B", 7)], with_seq=False)
    untimed = rows.withColumn("timestamp", F.lit(None).cast("timestamp"))
    tables.write_telemetry(rows.unionByName(untimed.where("vehicle_id = 'A'")), path)
    tables.merge_days(spark, path, BRONZE_SCHEMA, untimed.where("vehicle_id = 'B'"))
    stored = tables.read_telemetry(spark, path, BRONZE_SCHEMA)
    assert sorted((r["vehicle_id"], r["timestamp"] is None) for r in stored.collect()) == [
        ("A", False), ("A", True), ("B", False), ("B", True)]


def test_scratch_needs_a_shared_folder_on_a_cluster():
    from motorlytics.session import check_shared

    for folder, master in (("file:/x", "local[4]"), ("hdfs://h/x", "yarn"), ("s3a://b/x", "k8s://h"), ("/x", "local-cluster[2,1,1024]")):
        check_shared(folder, master)
    for folder, master in (("file:/x", "yarn"), ("/x", "spark://h:7077")):
        with pytest.raises(ValueError):
            check_shared(folder, master)
