"""Per-vehicle rolling features and sessions (the silver columns)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from motorlytics.functions.times import micros_between
from motorlytics.operators.runs import RUN, counted_above, in_runs
from motorlytics.schemas import BRONZE_COLUMNS, ROLLING_MEAN_FIELDS, SEQUENCE, SILVER_FEATURES

# --- fixed values: frame lengths in rows and the session gap (a longer gap starts a session) ---
MEAN_ROWS, COUNT_ROWS = 10, 20
SESSION_GAP_MICROS = 300_000_000
# --- end of fixed values ---

LOOKBACK = COUNT_ROWS - 1
ROWS_PER_TASK = 5_000_000

_IS_ROW = "_is_row"  # 0 for a row that is only context for the rows after it
_BASE = "_base"  # sessions before the context, carried by its first row
_CONTEXT_FIELDS = ("anomaly_flag", *ROLLING_MEAN_FIELDS)


def reading_order(columns: list[str]) -> list[str]:
    """Order of one vehicle's readings: time, then the ingest number or else the remaining columns."""
    if SEQUENCE in columns:
        return ["timestamp", SEQUENCE]
    return ["timestamp", *[c for c in columns if c in BRONZE_COLUMNS and c not in ("timestamp", "vehicle_id")]]


def _starts_session(time: Column, previous: Column) -> Column:
    gap = micros_between(time, previous)
    return F.when(previous.isNull() | (gap > SESSION_GAP_MICROS), 1).otherwise(0)


def _features(rows: DataFrame, keys: list[str], order: list[str], first_delta: str) -> DataFrame:
    """All window columns over one partitioning and order, so one shuffle and one sort serve them all."""
    seeded = _IS_ROW in rows.columns
    by_time = Window.partitionBy(*keys).orderBy(*([_IS_ROW] if seeded else []), *order)

    def last_rows(n: int):
        return by_time.rowsBetween(1 - n, Window.currentRow)

    # Means of float columns accumulate in double; casting first would widen the shuffled rows.
    before = F.expr("lag(coolant_temp, 1, CAST(0 AS FLOAT))" if first_delta == "zero_base" else "lag(coolant_temp)")
    framed = rows.select(
        "*",
        *[F.avg(name).over(last_rows(MEAN_ROWS)).alias(f"rolling_avg_{name}") for name in ROLLING_MEAN_FIELDS],
        F.sum("anomaly_flag").over(last_rows(COUNT_ROWS)).alias("rolling_anomaly_count"),
        before.over(by_time).alias("_before"),
        F.lag("timestamp").over(by_time).alias("_previous"),
    )
    measured = framed.select(
        *[c for c in framed.columns if c not in ("_before", "_previous")],
        (F.col("coolant_temp").cast("double") - F.col("_before").cast("double")).alias("coolant_temp_delta"),
        _starts_session(F.col("timestamp"), F.col("_previous")).alias("is_session_start"),
    )
    step = F.col("is_session_start").cast("long")
    if seeded:
        step = F.when(F.col(_IS_ROW) == 1, step).otherwise(F.col(_BASE))
    so_far = by_time.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = measured.select("*", F.sum(step).over(so_far).alias("session_id"))
    return numbered.filter(F.col(_IS_ROW) == 1).drop(_IS_ROW, _BASE) if seeded else numbered


def _context(order: list[str]) -> Column:
    """The part of a reading later readings look back at; time order first, so that arrays sort by it."""
    names = [*order, *[c for c in _CONTEXT_FIELDS if c not in order]]
    return F.struct(*[F.col(c) for c in names])


def _with_seeds(rows: DataFrame, keys: list[str], seeds: DataFrame) -> DataFrame:
    """Rows plus, per key, up to 19 context rows; the first of them carries the sessions so far."""
    context = seeds.select(*keys, "sessions", F.posexplode("tail").alias("_at", "_row"))
    context = context.select(
        *keys, "_row.*",
        F.lit(0).alias(_IS_ROW),
        F.when(F.col("_at") == 0, F.col("sessions")).otherwise(F.lit(0)).cast("long").alias(_BASE),
    )
    body = rows.withColumn(_IS_ROW, F.lit(1)).withColumn(_BASE, F.lit(0).cast("long"))
    return body.unionByName(context, allowMissingColumns=True)


def state_of(order: list[str], among: Column | None = None) -> list[Column]:
    """Aggregates that make a vehicle's state of its last 19 rows, or of those ``among`` the rows."""
    def picked(column: Column) -> Column:
        return column if among is None else F.when(among, column)

    return [
        F.max(picked(F.col("session_id"))).alias("sessions"),
        F.max(picked(F.col("timestamp"))).alias("last_time"),
        F.sort_array(F.collect_list(picked(_context(order)))).alias("tail"),
    ]


def latest_state(silver: DataFrame, order: list[str] | None = None) -> DataFrame:
    """What the next readings of each vehicle depend on: its last 19 rows and its session count.

    ``row_number`` with a bound is cut to 19 rows per vehicle in every task before the shuffle.
    """
    order = order or reading_order(silver.columns)
    newest = Window.partitionBy("vehicle_id").orderBy(*[F.col(c).desc() for c in order])
    tail = silver.withColumn("_nth", F.row_number().over(newest)).filter(F.col("_nth") <= LOOKBACK)
    return tail.groupBy("vehicle_id").agg(*state_of(order))


def _split_features(rows: DataFrame, seeds: DataFrame | None, whose: list[str], order: list[str], first_delta: str,
                    total_rows: int, rows_per_run: int) -> DataFrame:
    """Features of histories too large for one task: per run, with context taken from the runs before.

    Each run is first reduced to one summary row (its last 19 rows, its first and last time, the
    sessions that start inside it). A window over a history's summaries, which are few, gives every run
    its context rows and session count; then all runs are computed independently.
    """
    stored = in_runs(rows, whose, order, total_rows, rows_per_run)
    keys = [*whose, RUN]
    by_time = Window.partitionBy(*keys).orderBy(*order)
    narrow = stored.select(*keys, *order, *[c for c in _CONTEXT_FIELDS if c not in order])
    inside = narrow.select(
        "*",
        F.lag("timestamp").over(by_time).alias("_previous"),
        F.row_number().over(by_time).alias("_nth"),
        F.count(F.lit(1)).over(Window.partitionBy(*keys)).alias("_size"),
    )
    starts = F.when(F.col("_previous").isNotNull(), _starts_session(F.col("timestamp"), F.col("_previous")))
    summary = inside.groupBy(*keys).agg(
        F.sum(F.coalesce(starts, F.lit(0))).alias("_inner"),
        F.min("timestamp").alias("_first"),
        F.max("timestamp").alias("_last"),
        F.sort_array(F.collect_list(
            F.when(F.col("_nth") > F.col("_size") - LOOKBACK, _context(order))
        )).alias("tail"),
    )
    if seeds is not None:
        carried = seeds.select(
            *whose, F.lit(-1).cast("long").alias(RUN), F.col("sessions").alias("_inner"),
            F.col("tail")[0]["timestamp"].alias("_first"), F.col("last_time").alias("_last"), "tail",
        )
        summary = summary.unionByName(carried)
    by_run = Window.partitionBy(*whose).orderBy(RUN)
    opens = F.when(F.col(RUN) < 0, 0).otherwise(_starts_session(F.col("_first"), F.lag("_last").over(by_run)))
    earlier = by_run.rowsBetween(Window.unboundedPreceding, -1)
    linked = summary.withColumn("_sessions", F.col("_inner") + opens).select(
        *keys,
        F.sum("_sessions").over(earlier).alias("sessions"),
        F.flatten(F.collect_list("tail").over(by_run.rowsBetween(-LOOKBACK, -1))).alias("_tails"),
    )
    run_seeds = linked.filter(F.col(RUN) >= 0).select(
        *keys, "sessions",
        F.slice("_tails", F.greatest(F.size("_tails") - LOOKBACK + 1, F.lit(1)), LOOKBACK).alias("tail"),
    )
    return _features(_with_seeds(stored, keys, run_seeds), keys, order, first_delta).drop(RUN)


def large_vehicles(rows: DataFrame, rows_per_task: int | None) -> dict[str, int]:
    """Vehicles with more rows than one task should have, with their number: at most all rows / ``rows_per_task`` of them."""
    if rows_per_task is None:
        return {}
    return {r["vehicle_id"]: r["_rows"] for r in counted_above(rows, "vehicle_id", rows_per_task).collect()}


def large_by_counts(counts: DataFrame, rows_per_task: int) -> dict[str, int]:
    """The same from stored counts (``vehicle_id``, ``readings``, a vehicle in any number of rows)."""
    sums = counts.groupBy("vehicle_id").agg(F.sum("readings").alias("readings")).filter(F.col("readings") > rows_per_task)
    return {r["vehicle_id"]: r["readings"] for r in sums.collect()}


def silver_telemetry(
    bronze: DataFrame,
    *,
    first_delta: str = "null",
    seeds: DataFrame | None = None,
    rows_per_task: int | None = ROWS_PER_TASK,
    rows_per_run: int | None = None,
    keep: tuple[str, ...] = (),
    large: dict[str, int] | None = None,
    apart: tuple[str, ...] = (),
) -> DataFrame:
    """Bronze rows with rolling means, anomaly context, temperature change and sessions.

    ``first_delta`` is the change of a vehicle's first reading: ``"null"``, or ``"zero_base"`` for the
    full reading. ``seeds`` (see ``latest_state``) continues from rows processed earlier. Vehicles with
    more than ``rows_per_task`` rows are computed in runs (of ``rows_per_run``, by default as many rows);
    a narrow count finds them first, and ``rows_per_task=None`` skips it for input known to have none. A caller that has
    counted gives them as ``large`` (see ``large_vehicles``, or ``BronzeTable.large_vehicles`` for counts kept with the rows), and nothing runs before the result is asked for.
    Columns in ``apart``, which rows and seeds carry, divide a vehicle's rows into histories of their own.
    """
    if first_delta not in ("null", "zero_base"):
        raise ValueError("first_delta is 'null' or 'zero_base'")
    order = reading_order(bronze.columns)
    whose = ["vehicle_id", *apart]
    output = [*BRONZE_COLUMNS, *SILVER_FEATURES, *keep]
    needed = list(dict.fromkeys([*BRONZE_COLUMNS, *order, *keep, *apart]))
    rows = bronze.select(*needed)

    def whole(part: DataFrame, its_seeds: DataFrame | None) -> DataFrame:
        if its_seeds is not None:
            part = _with_seeds(part, whose, its_seeds)
        return _features(part, whose, order, first_delta)

    if large is None:
        large = large_vehicles(rows, rows_per_task)
    if not large:
        return whole(rows, seeds).select(*output)

    # At most (all rows / rows_per_task) names, so they fit a broadcast.
    names = F.broadcast(rows.sparkSession.createDataFrame([(name,) for name in large], "vehicle_id string"))

    def part_of(df: DataFrame | None, how: str) -> DataFrame | None:
        return None if df is None else df.join(names, "vehicle_id", how)

    split = _split_features(part_of(rows, "left_semi"), part_of(seeds, "left_semi"), whose, order, first_delta,
                            sum(large.values()), rows_per_run or rows_per_task or ROWS_PER_TASK)
    rest = whole(part_of(rows, "left_anti"), part_of(seeds, "left_anti"))
    return rest.select(*output).unionByName(split.select(*output))


def sessions(silver: DataFrame) -> DataFrame:
    """One row per trip, from the session numbers."""
    return silver.groupBy("vehicle_id", "session_id").agg(
        F.min("timestamp").alias("started_at"),
        F.max("timestamp").alias("ended_at"),
        F.count(F.lit(1)).alias("readings"),
        F.sum("anomaly_flag").alias("anomalies"),
    )
