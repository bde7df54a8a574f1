"""Shape of the physical plans: shuffles, scans, Python workers."""

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from motorlytics.operators import evaluation, health, quality, windows
from motorlytics.operators.incremental import continuous_refresh, newer_than
from motorlytics.plans import kpis, layers
from motorlytics.schemas import SILVER_SCHEMA
from motorlytics.session import written
from motorlytics.sources import derived, tables
from motorlytics.sources.messages import accepted, decode_messages


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def bronze(spark):
    return layers.bronze_from_readings(derived.telemetry(spark, SMALL))


@pytest.fixture(scope="module")
def silver_table(spark, bronze, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("silver"))
    tables.write_telemetry(windows.silver_telemetry(bronze), path)
    return tables.read_telemetry(spark, path, SILVER_SCHEMA)


def test_silver_has_one_shuffle_and_one_sort(bronze):
    text = plan(windows.silver_telemetry(bronze, rows_per_task=None))
    assert text.count("Exchange") == 1 and text.count("+- Sort ") == 1 and text.count("Window [") == 2


def test_gold_on_silver_adds_no_shuffle(bronze):
    assert plan(layers.gold_from_bronze(bronze, rows_per_task=None)).count("Exchange") == 1


def test_gold_from_a_table_aggregates_before_the_shuffle(silver_table):
    text = plan(health.vehicle_health(silver_table))
    assert text.count("partial_avg") and "Window" not in text
    assert "latitude" not in text  # columns the score does not need are not read


def test_no_python_worker(spark, bronze):
    parsed = layers.bronze_from_messages(derived.messages(spark, SMALL))
    for df in (parsed, windows.silver_telemetry(bronze), layers.gold_from_bronze(bronze), quality.clip_readings(bronze)):
        assert "Python" not in plan(df) and "Pandas" not in plan(df)


def test_filtering_decoded_messages_parses_once(spark):
    text = plan(accepted(decode_messages(derived.messages(spark, SMALL))))
    assert text.count("from_json") == 1


def test_filters_and_columns_reach_the_scan(silver_table):
    text = silver_table.sparkSession._jvm.PythonSQLUtils.explainString(
        kpis.live_anomaly_rate(silver_table, kpis.dt.datetime(2024, 1, 1, 5))._jdf.queryExecution(), "formatted")
    assert "GreaterThan(timestamp," in text
    assert "ReadSchema: struct<timestamp:timestamp,anomaly_flag:int>" in text
    recent = plan(newer_than(silver_table, kpis.dt.datetime(2024, 1, 1, 5)))
    assert "PartitionFilters: [isnotnull(event_date" in recent


def test_late_readings_prune_days(silver_table, bronze):
    """The newest rows of touched vehicles are given; silver is read between literal days, and never for the result itself."""
    late = bronze.orderBy(F.col("timestamp").desc()).limit(1)
    known, texts = windows.latest_state(silver_table), []

    def keep(rows, label):
        if label.startswith(("end", "look", "replaced")):
            texts.append(plan(rows))
        return written(rows, label)

    refresh = continuous_refresh(late.drop("seq"), silver_table, known, keep=keep)
    assert len(texts) >= 3
    for text in texts:
        scans = [line for line in text.splitlines() if "FileScan" in line and "event_date#" in line and "silver" in line]
        assert scans and all("PartitionFilters: [isnotnull(event_date" in line for line in scans)
    assert "event_date" not in plan(refresh.rows)


def test_last_rows_are_cut_before_the_shuffle(silver_table):
    text = plan(windows.latest_state(silver_table))
    assert "Partial" in text and "WindowGroupLimit" in text


def test_top_list_is_not_a_full_sort(silver_table):
    scored = health.vehicle_health(silver_table)
    predictions = scored.select("vehicle_id", F.lit(0.5).alias("risk_probability"))
    assert "TakeOrderedAndProject" in plan(kpis.worst_vehicles(scored, predictions))


def test_duplicates_collapse_before_the_shuffle(bronze):
    assert "partial_max" in plan(quality.dedupe_readings(bronze))


def test_split_orders_no_label_in_one_task(spark):
    df = spark.range(100).select(F.col("id").cast("string").alias("vehicle_id"), (F.col("id") % 2).cast("int").alias("is_at_risk"))
    text = plan(evaluation.stratified_split(df))
    assert "row_number() windowspecdefinition(is_at_risk" in text and "_prefix" in text


def test_registered_queries_keep_the_protection_of_hot_vehicles():
    import inspect

    import registered_queries

    text = inspect.getsource(registered_queries)
    assert "rows_per_task=None" not in text and ".count()" not in text
