"""Splitting long ordered histories into bounded, contiguous runs.

A window over one vehicle runs in one task, so a vehicle with a large share of all readings needs its
history cut. Range partitioning by (keys, order) cuts it evenly from a sample, whatever the
distribution of times; a partition, sorted, is cut on into runs by position.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from motorlytics.session import written

RUN = "_run"
ROWS_PER_PARTITION = 250_000
_POSITION_BITS = 33  # of ``monotonically_increasing_id``: a row's position in its partition, below the partition's number


def counted_above(rows: DataFrame, key: str, limit: int) -> DataFrame:
    """Keys with more than ``limit`` rows and their counts; counted before the shuffle."""
    return rows.groupBy(key).agg(F.count(F.lit(1)).alias("_rows")).filter(F.col("_rows") > limit)


def in_runs(rows: DataFrame, keys: list[str], order: list[str], total_rows: int, rows_per_run: int) -> DataFrame:
    """``rows`` with a run number: runs ascend with (keys, order) and hold about ``rows_per_run`` rows.

    The numbers are read several times by later steps and must not change, so the rows are written to
    the shared scratch folder and read back. The last two sort keys only separate rows equal in (keys,
    order): by content, and then, for copies of one row, which are interchangeable, by position. So even
    copies of one row spread over runs, and a task that runs again cannot move a row to another run.

    Short runs share a partition of about ``ROWS_PER_PARTITION`` rows: tasks and the sample that the ranges are drawn from, which
    goes to the driver, follow the rows and not the number of runs. Numbers ascend, with gaps between partitions.
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism
    runs = max(1, math.ceil(total_rows / rows_per_run))
    partitions = min(runs, max(cores, math.ceil(total_rows / ROWS_PER_PARTITION)))
    sorting = [*keys, *order, "_content", "_copy"]
    ranged = (
        rows.withColumns({"_content": F.xxhash64(*rows.columns), "_copy": F.monotonically_increasing_id()})
        .repartitionByRange(partitions, *sorting)
        .sortWithinPartitions(*sorting)
        .drop("_content", "_copy")
        .withColumn("_place", F.monotonically_increasing_id())
    )
    position = F.col("_place").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
    number = F.col("_place") - position + F.floor(position / F.lit(rows_per_run))
    return written(ranged.withColumn(RUN, number).drop("_place"), "runs")
