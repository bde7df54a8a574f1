"""Stored readings as a stream that arrives in order of time, so that watermarks hold over many batches."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

STATE_ROWS_PER_TASK = 50_000


def stage_in_order(rows: DataFrame, folder: str, time_column: str = "timestamp", rows_per_file: int = 1_000_000,
                   partitions: int | None = None) -> int:
    """Write ``rows`` to a new folder, cut into files by ranges of time, and date the files so that a file source admits them
    in that order; the number of files.

    A file source takes files by the time they were changed. Ranges are written by as many tasks as there are, which end in any
    order, and are numbered in theirs; so each file gets the time of its number. This needs a store that lets files be dated
    (HDFS and local ones do). Rows without a time come first. There are ``partitions`` ranges, or as many as Spark chooses.
    """
    spark = rows.sparkSession
    ranged = rows.repartitionByRange(*([partitions] if partitions else []), time_column).sortWithinPartitions(time_column)
    ranged.write.option("maxRecordsPerFile", rows_per_file).parquet(folder)
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    parts = sorted((s.getPath() for s in files.listStatus(path) if s.getPath().getName().startswith("part-")), key=lambda p: p.getName())
    first = int(time.time()) * 1000 - 1000 * len(parts)  # whole seconds: some stores keep no smaller unit
    for number, part in enumerate(parts):
        files.setTimes(part, first + 1000 * number, -1)
    return len(parts)


def state_partitions(spark: SparkSession, rows_per_batch: int) -> int:
    """Into how many partitions the state of a stream with batches of bounded size is cut: a task per core, more if a batch would give
    them over ``STATE_ROWS_PER_TASK`` rows each, and never more than the session's setting, which is sized for whole tables."""
    wanted = max(spark.sparkContext.defaultParallelism, -(-rows_per_batch // STATE_ROWS_PER_TASK))
    return min(wanted, int(spark.conf.get("spark.sql.shuffle.partitions")))


def start_sized(writer: DataStreamWriter, path: str, rows_per_batch: int, spark: SparkSession) -> StreamingQuery:
    """Start a stream with ``state_partitions``. A query keeps the number that its session has when it starts, and every batch runs that
    many tasks per stateful step, each of which reports to the driver. The session's setting is put back."""
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    spark.conf.set(name, str(state_partitions(spark, rows_per_batch)))
    try:
        return writer.start(path)
    finally:
        spark.conf.set(name, before)


def late_drops(query: StreamingQuery) -> int:
    """How many rows the watermark has shut out so far, over the batches the query still reports."""
    return sum(op["numRowsDroppedByWatermark"] for batch in query.recentProgress for op in batch["stateOperators"])


def batches(query: StreamingQuery) -> int:
    """How many batches had rows."""
    return len({p["batchId"] for p in query.recentProgress if p["numInputRows"]})
