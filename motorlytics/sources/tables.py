"""Stored tables: scans, creation, full rebuilds and keyed merges on Parquet."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from motorlytics.schemas import BRONZE_SCHEMA

EVENT_DATE = "event_date"


def create_bronze_table(spark: SparkSession, name: str, location: str | None = None) -> None:
    """Create the bronze table, partitioned by day, unless it exists."""
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in BRONZE_SCHEMA.fields)
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({fields}, `{EVENT_DATE}` date) "
        f"USING parquet PARTITIONED BY ({EVENT_DATE}){where}"
    )


def with_event_date(df: DataFrame) -> DataFrame:
    return df.withColumn(EVENT_DATE, F.to_date("timestamp"))


def laid_out(df: DataFrame) -> DataFrame:
    """Rows sorted by (vehicle, time) within each day's files, so min/max statistics can skip blocks.

    Sorting happens inside the tasks that already hold the rows: no shuffle, and a busy day stays
    spread over as many tasks as produced it.
    """
    return with_event_date(df).sortWithinPartitions(EVENT_DATE, "vehicle_id", "timestamp")


def write_telemetry(df: DataFrame, path: str, mode: str = "append") -> None:
    """Write bronze or silver rows; ``overwrite`` replaces the whole table (truncate and load)."""
    (laid_out(df).write.mode(mode).option("partitionOverwriteMode", "static")
     .partitionBy(EVENT_DATE).parquet(path))


def read_telemetry(spark: SparkSession, path: str, schema: T.StructType, **extra: str) -> DataFrame:
    """Scan a stored telemetry table with its declared schema (and further columns given by name=type)."""
    full = T.StructType(list(schema.fields))
    for name, kind in {**extra, EVENT_DATE: "date"}.items():
        full = full.add(name, kind)
    return spark.read.schema(full).parquet(path)


def rebuild(df: DataFrame, path: str, order: str = "vehicle_id") -> None:
    """Replace a per-vehicle table (health, predictions) with the rows of ``df``."""
    (df.sortWithinPartitions(order).write.mode("overwrite")
     .option("partitionOverwriteMode", "static").parquet(path))


def rebuild_table(df: DataFrame, name: str, order: str = "vehicle_id") -> None:
    df.sortWithinPartitions(order).write.mode("overwrite").format("parquet").saveAsTable(name)


def publish(df: DataFrame, view: str, path: str, order: str = "vehicle_id") -> None:
    """Replace what ``view`` shows: write a new folder under ``path``, then switch the view to it.

    Readers see the old rows until the new ones are complete, and a run that fails changes nothing.
    """
    spark = df.sparkSession
    target = f"{path.rstrip('/')}/version-{uuid.uuid4().hex}"
    df.sortWithinPartitions(order).write.parquet(target)
    spark.sql(f"CREATE OR REPLACE VIEW {view} AS SELECT * FROM parquet.`{target}`")


def spread(df: DataFrame, least: int = 0) -> DataFrame:
    """Give an input of few files as many partitions as there are cores (or ``least``) before heavy work on each row.

    Input that already has that many stays as it is, so large tables are not shuffled.
    """
    wanted = max(df.sparkSession.sparkContext.defaultParallelism, least)
    if df.isStreaming:  # a batch's files are not known yet
        return df.repartition(wanted)
    return df.repartition(wanted) if df.rdd.getNumPartitions() < wanted else df


def is_empty(df: DataFrame) -> bool:
    """True when a table has no rows; reads at most one."""
    return df.isEmpty()


def merge_by_key(target: DataFrame, updates: DataFrame, keys: tuple[str, ...] = ("vehicle_id", "timestamp")
                 ) -> DataFrame:
    """Target rows whose key is not updated, plus all updates (replace by key).

    The anti join is on the whole key, so the readings of one vehicle spread over all tasks.
    """
    kept = target.join(updates.select(*keys).distinct(), list(keys), "left_anti")
    return kept.select(*target.columns).unionByName(updates.select(*target.columns))


def merge_days(spark: SparkSession, path: str, schema: T.StructType, updates: DataFrame,
               keys: tuple[str, ...] = ("vehicle_id", "timestamp")) -> None:
    """Apply ``updates`` by key to a stored table, rewriting only the days they touch."""
    updates = with_event_date(updates)
    days = [row[0] for row in updates.select(EVENT_DATE).distinct().collect()]  # calendar days of one batch
    if not days:
        return
    in_days = F.col(EVENT_DATE).isin([d for d in days if d is not None])
    if None in days:  # readings without a time have a partition of their own
        in_days = F.coalesce(in_days, F.lit(False)) | F.col(EVENT_DATE).isNull()
    touched = read_telemetry(spark, path, schema).filter(in_days)
    merged = merge_by_key(touched, updates, keys)
    (merged.sortWithinPartitions(EVENT_DATE, "vehicle_id", "timestamp")
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(EVENT_DATE).parquet(path))
