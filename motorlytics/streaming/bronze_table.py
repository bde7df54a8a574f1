"""Bronze kept by a stream: a folder per batch, merged in levels, and days that are replaced whole."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from motorlytics.operators.windows import ROWS_PER_TASK, large_by_counts
from motorlytics.schemas import BRONZE_SCHEMA
from motorlytics.sources.clustering import clustered
from motorlytics.sources.manifest import Entry, Manifest, cascade
from motorlytics.sources.tables import EVENT_DATE, laid_out, merge_by_key, with_event_date

FAN_IN = 8
_NO_DAY = "__HIVE_DEFAULT_PARTITION__"
COUNTS_SCHEMA = T.StructType().add(EVENT_DATE, "date").add("vehicle_id", "string").add("readings", "long")


def _summed(rows: DataFrame) -> DataFrame:
    return rows.groupBy(EVENT_DATE, "vehicle_id").agg(F.sum("readings").alias("readings"))


class BronzeTable:
    """Rows of batches. A batch that runs again replaces itself, also after other batches were merged.

    When ``fan_in`` folders of a level have gathered, they become one of the next level: few files, cut by ranges of day,
    vehicle and time, so that a vehicle's hour lies in few of them. A row is rewritten once per level at most, and a table of n
    batches has about ``fan_in`` * log(n) live folders. The newest batch is never merged, since it may come again.

    With ``counted``, readings per day and vehicle are kept beside the rows, in batches and levels of their own, so that vehicles
    with very many are known without a count over all rows. A batch counts what it has just written, one column of it.

    With ``interleaved``, merged folders are cut by day and by cells of vehicle and time instead (``clustered``). A vehicle's hour
    still lies in few files, and so does an hour of all vehicles, which plain ranges spread over every file of its day.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType = BRONZE_SCHEMA, fan_in: int = FAN_IN, *,
                 counted: bool = False, interleaved: bool = False, **extra: str):
        self.interleaved = interleaved
        self.manifest, self.fan_in = Manifest(spark, path), fan_in
        self.counts = Manifest(spark, f"{path.rstrip('/')}/counts") if counted else None
        self.schema = T.StructType(list(schema.fields))
        for name, kind in {**extra, EVENT_DATE: "date"}.items():
            self.schema = self.schema.add(name, kind)

    def read(self) -> DataFrame:
        return self.manifest.read(self.schema)

    def add(self, rows: DataFrame, batch_id: int) -> None:
        """Rows of a batch. Merged folders name their last batch, so only the batch's own folder has its number."""
        folder = self.manifest.write(laid_out(rows), f"batch-{batch_id}", EVENT_DATE)
        if self.counts:  # before the rows are listed: a job that fails in between leaves counts that are too high, until it is repeated
            found = self.manifest.read(self.schema, [Entry(folder, batch_id)])
            self._list(self.counts, self.counts.write(_summed(found.withColumn("readings", F.lit(1))), f"batch-{batch_id}"), batch_id)
        self._list(self.manifest, folder, batch_id)

    @staticmethod
    def _list(manifest: Manifest, folder: str, batch_id: int) -> None:
        manifest.commit(lambda entries: [e for e in entries if e.batch != batch_id] + [Entry(folder, batch_id)])

    def daily_counts(self) -> DataFrame:
        """``event_date, vehicle_id, readings``, at most a row per live folder of counts, day and vehicle."""
        return self.counts.read(COUNTS_SCHEMA)

    def large_vehicles(self, rows_per_task: int = ROWS_PER_TASK) -> dict[str, int]:
        """``large`` for ``silver_telemetry`` from the counts alone."""
        return large_by_counts(self.daily_counts(), rows_per_task)

    def compact(self, before_batch: int | None = None) -> int:
        """Merge levels that are full, lowest first; the number of folders of rows merged. Only folders of batches before the newest
        one are merged, or before ``before_batch``, which may be added at the same time."""
        if self.counts:
            self._compact(self.counts, self._merge_counts, before_batch)
        return self._compact(self.manifest, self._merge, before_batch)

    def _compact(self, manifest: Manifest, merge, before_batch: int | None) -> int:
        merged = 0
        while True:
            entries = manifest.entries()
            bound = max((e.batch for e in entries), default=-1) if before_batch is None else before_batch
            found, level = cascade([e for e in entries if e.batch < bound], self.fan_in)
            if not found:
                return merged
            merge(found, level)
            merged += len(found)

    def _merge(self, entries: list[Entry], level: int) -> None:
        rows = self.manifest.read(self.schema, entries)
        order = [EVENT_DATE, "vehicle_id", "timestamp"]
        ranged = clustered(rows) if self.interleaved else rows.repartitionByRange(*order).sortWithinPartitions(*order)
        folder = self.manifest.write(ranged, f"level-{level}", EVENT_DATE)
        self._replace(self.manifest, entries, folder, level)

    def _merge_counts(self, entries: list[Entry], level: int) -> None:
        folder = self.counts.write(_summed(self.counts.read(COUNTS_SCHEMA, entries)), f"level-{level}")
        self._replace(self.counts, entries, folder, level)

    @staticmethod
    def _replace(manifest: Manifest, entries: list[Entry], folder: str, level: int) -> None:
        whole, gone = Entry(folder, max(e.batch for e in entries), level), {e.folder for e in entries}
        manifest.commit(lambda now: [e for e in now if e.folder not in gone] + [whole])


class DayTable:
    """A keyed table in which each day has a version of its own, and updates replace the days they touch all at once."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType):
        self.manifest, self.schema = Manifest(spark, path), schema

    def read(self, first: dt.date | None = None, last: dt.date | None = None) -> DataFrame:
        """Rows of all days, or of those between two; rows without a time only if no bound is given."""
        def wanted(day: str) -> bool:
            if day == _NO_DAY:
                return first is None and last is None
            return (first is None or day >= first.isoformat()) and (last is None or day <= last.isoformat())

        return self.manifest.read(self.schema, [e for e in self.manifest.entries() if wanted(e.part)])

    def merge(self, updates: DataFrame, batch_id: int = 0, keys: tuple[str, ...] = ("vehicle_id", "timestamp")) -> int:
        """Replace rows with the keys of ``updates`` and add the rest; the number of days written anew.

        Until the last step, one rename, readers see the old rows of every day, and a job that fails leaves them.
        """
        days = {str(row[0]) if row[0] is not None else _NO_DAY
                for row in updates.select(F.to_date("timestamp")).distinct().collect()}  # calendar days of one batch
        if not days:
            return 0
        old = self.manifest.read(self.schema, [e for e in self.manifest.entries() if e.part in days])
        merged = merge_by_key(old, updates.select(*self.schema.names), keys)
        rows = with_event_date(merged).sortWithinPartitions(EVENT_DATE, "vehicle_id", "timestamp")
        folder = self.manifest.write(rows, f"days-{batch_id}", EVENT_DATE)
        fresh = [Entry(f"{folder}/{EVENT_DATE}={day}", batch_id, 0, day) for day in sorted(days)]
        self.manifest.commit(lambda now: [e for e in now if e.part not in days] + fresh)
        return len(days)
