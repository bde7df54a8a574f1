"""Layout of stored rows by vehicle and time at once, so that lookups by either of them read few files."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from motorlytics.sources.tables import EVENT_DATE

BITS = 5
_DAY = 86_400
_CELL = "_cell"


def edges_of(rows: DataFrame, column: str, parts: int) -> list:
    """Where the distinct values of ``column`` are to be cut into at most ``parts`` ranges of about equal size: each range's least
    value but the first's, in order. Copies of a value don't move the cuts."""
    distinct = rows.select(column).where(F.col(column).isNotNull()).distinct()
    ranged = distinct.repartitionByRange(parts, column).select(F.spark_partition_id().alias("part"), column)
    least = ranged.groupBy("part").agg(F.min(column).alias("least")).collect()  # ``parts`` rows at most
    return sorted(row["least"] for row in least)[1:]


def _sum(terms: list[Column]) -> Column:
    return reduce(add, terms, F.lit(0))


def interleaved(one: Column, other: Column, bits: int) -> Column:
    """The lowest ``bits`` bits of two numbers in turn, those of ``one`` first."""
    def bit(x: Column, b: int) -> Column:
        return F.shiftright(x, b).bitwiseAND(F.lit(1))

    return _sum([F.shiftleft(bit(x, b), 2 * b + up) for b in range(bits) for x, up in ((one, 1), (other, 0))])


def cell(edges: list, bits: int = BITS) -> Column:
    """The place of a row among the 4 ** ``bits`` cells of its day, in the order that keeps both neighbours in vehicle and in time close.
    Rows without a vehicle or a time count as the first of them."""
    vehicle = _sum([F.when(F.col("vehicle_id") >= F.lit(edge), 1).otherwise(0) for edge in edges])
    second = F.pmod(F.unix_seconds("timestamp"), F.lit(_DAY))
    slot = F.coalesce(F.floor(second * F.lit(1 << bits) / F.lit(_DAY)), F.lit(0)).cast("int")
    return interleaved(vehicle, slot, bits)


def clustered(rows: DataFrame, bits: int = BITS, files: int | None = None) -> DataFrame:
    """``rows`` (with their day) in ``files`` ranges of day and cell, or as many as Spark chooses.

    Vehicles are cut by ranges of their ids, so least and greatest ids in a file's statistics stay telling. A vehicle with a large
    share of the rows has the cells of its range, and within a cell the ranges are cut by vehicle and time: no file grows with it.
    """
    order = [EVENT_DATE, _CELL, "vehicle_id", "timestamp"]
    placed = rows.withColumn(_CELL, cell(edges_of(rows, "vehicle_id", 1 << bits), bits))
    ranged = placed.repartitionByRange(*([files] if files else []), *order)
    return ranged.sortWithinPartitions(*order).drop(_CELL)
