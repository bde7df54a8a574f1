"""Measures over event-time windows of a bronze stream; each has the same result as its batch form."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from motorlytics.functions.times import micros_between
from motorlytics.operators.windows import SESSION_GAP_MICROS
from motorlytics.plans.kpis import LIVE_RATE_SPAN, SERIES_BUCKET

# --- fixed values: the session gap (readings exactly this far apart stay together) ---
SESSION_GAP = "300 seconds"
# --- end of fixed values ---

LATENESS = "10 minutes"
SLICE_SECONDS = 6 * 3600


def live_anomaly_series(bronze: DataFrame, lateness: str = LATENESS) -> DataFrame:
    """Anomalies per 10 s window; counts merge in every task before the shuffle."""
    windows = bronze.withWatermark("timestamp", lateness).groupBy(F.window("timestamp", SERIES_BUCKET))
    return windows.agg(F.sum("anomaly_flag").alias("anomalies")).select(
        F.col("window.start").alias("time"), "anomalies")


def live_anomaly_rate(bronze: DataFrame, lateness: str = LATENESS) -> DataFrame:
    """The anomaly rate of the last 5 minutes, every 10 seconds.

    Readings are first counted per 10 s; only those small counts are copied into the 30 windows that
    contain them.
    """
    step = bronze.withWatermark("timestamp", lateness).groupBy(F.window("timestamp", SERIES_BUCKET).alias("step")).agg(
        F.sum("anomaly_flag").alias("_anomalies"), F.count("anomaly_flag").alias("_readings"))
    sliding = step.groupBy(F.window(F.window_time("step"), LIVE_RATE_SPAN, SERIES_BUCKET)).agg(
        F.sum("_anomalies").alias("_anomalies"), F.sum("_readings").alias("_readings"))
    rate = F.try_divide(F.col("_anomalies"), F.col("_readings")) * 100
    return sliding.select(F.col("window.end").alias("as_of"), rate.alias("anomaly_rate_pct"))


def trips(bronze: DataFrame, lateness: str = LATENESS) -> DataFrame:
    """One row per vehicle and uninterrupted stretch of readings."""
    grouped = bronze.withWatermark("timestamp", lateness).groupBy(
        "vehicle_id", F.session_window("timestamp", SESSION_GAP))
    return grouped.agg(
        F.min("timestamp").alias("started_at"),
        F.max("timestamp").alias("ended_at"),
        F.count(F.lit(1)).alias("readings"),
        F.sum("anomaly_flag").alias("anomalies"),
    ).drop("session_window")


def trips_in_slices(bronze: DataFrame, slice_seconds: int = SLICE_SECONDS) -> DataFrame:
    """The same trips of a batch, in two steps: within slices of time, then across them.

    The readings of a vehicle spread over its slices, so no task holds a long history. What meets per vehicle afterwards is a row
    per slice and uninterrupted stretch. As a session, such a row lasts as long as it is, and then the gap. Readings without a
    time are in no trip.
    """
    slice_number = F.floor(F.unix_micros("timestamp") / F.lit(slice_seconds * 1_000_000))
    stretches = bronze.groupBy("vehicle_id", slice_number.alias("slice"), F.session_window("timestamp", SESSION_GAP)).agg(
        F.min("timestamp").alias("started_at"),
        F.max("timestamp").alias("ended_at"),
        F.count(F.lit(1)).alias("readings"),
        F.sum("anomaly_flag").alias("anomalies"),
    ).drop("session_window", "slice")
    length = F.concat((micros_between(F.col("ended_at"), F.col("started_at")) + SESSION_GAP_MICROS).cast("string"), F.lit(" microseconds"))
    whole = stretches.groupBy("vehicle_id", F.session_window("started_at", length))
    return whole.agg(
        F.min("started_at").alias("started_at"),
        F.max("ended_at").alias("ended_at"),
        F.sum("readings").alias("readings"),
        F.sum("anomalies").alias("anomalies"),
    ).drop("session_window")


def without_duplicates(bronze: DataFrame, lateness: str = LATENESS, collapse: bool = False) -> DataFrame:
    """Each (vehicle, timestamp) once; state is forgotten after ``lateness``.

    With ``collapse``, copies are merged in every task before rows are shuffled, for streams in which one key may hold a large
    share of a batch. It moves all rows through Arrow, so it costs more than it saves where copies are few.
    """
    keys = ["vehicle_id", "timestamp"]
    rows = collapsed(bronze, keys) if collapse else bronze
    return rows.withWatermark("timestamp", lateness).dropDuplicatesWithinWatermark(keys)


def collapsed(rows: DataFrame, keys: list[str], remembered: int = 100_000) -> DataFrame:
    """``rows`` with fewer copies of each key, and at least one of every key; no shuffle.

    Copies within an Arrow batch become the first of them. A key that had some is remembered by its task, and its later copies go
    too; with more than ``remembered`` such keys the task starts anew, so its memory is bounded. A key with copies in every
    batch thus leaves a task about once. What remains is for the stateful step that follows, so this never changes its
    result. Nulls are equal to each other. On streams a micro-batch's partitions are the tasks.
    """
    kept = rows.columns
    positions = [kept.index(k) for k in keys]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow as pa

        repeated: set[tuple] = set()
        for batch in batches:
            if not batch.num_rows:
                continue
            named = [f"k{i}" for i in range(len(positions))]
            columns = [batch.column(p) for p in positions]
            columns = [c.cast(pa.int64()) if pa.types.is_timestamp(c.type) else c for c in columns]
            found = pa.table([*columns, pa.array(range(batch.num_rows), pa.int64())], names=[*named, "row"])
            groups = found.group_by(named, use_threads=False).aggregate([("row", "min"), ("row", "count")])
            first = groups.column("row_min").to_pylist()
            copied = [i for i, n in enumerate(groups.column("row_count").to_pylist()) if n > 1]
            if copied:
                some = groups.take(copied)
                gone = set()
                for i, key in zip(copied, zip(*(some.column(name).to_pylist() for name in named))):
                    if key in repeated:
                        gone.add(i)
                    else:
                        if len(repeated) >= remembered:
                            repeated.clear()
                        repeated.add(key)
                first = [row for i, row in enumerate(first) if i not in gone]
            yield batch if len(first) == batch.num_rows else batch.take(pa.array(sorted(first), pa.int64()))

    return rows.mapInArrow(run, rows.schema)
