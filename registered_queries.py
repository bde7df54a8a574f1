"""Every operator as a query over the given tables: ``name -> (spark, folder) -> DataFrame``."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from motorlytics.operators import evaluation, health, incremental, quality, readings, sketches, windows
from motorlytics.plans import boosting, kpis, layers, risk
from motorlytics.schemas import (
    BRONZE_COLUMNS, BRONZE_SCHEMA, GPS_FIELDS, IDENTITY_FIELDS, OBD_FIELDS, READING_FIELDS, SILVER_COLUMNS,
)
from motorlytics.session import scratch_path, written
from motorlytics.sources import derived, messages
from motorlytics.sources.fleet import CLASS_PROFILES, MODEL_CLASSES
from motorlytics.sources.tables import merge_by_key, read_telemetry
from motorlytics.streaming import ingest, live
from motorlytics.streaming.bronze_table import BronzeTable, DayTable
from motorlytics.streaming.ordered import batches, late_drops, stage_in_order, start_sized
from motorlytics.streaming.refresh import SilverStore

CUTOFF = dt.datetime(2024, 1, 1, 3, 36)

FLEET_MODELS = (*MODEL_CLASSES, "Unlisted")
READINGS_PER_BATCH = 4000
RECORDS_PER_FILE, FILES_PER_BATCH = 20_000, 3
TIMED_RECORDS_PER_FILE, TIMED_PARTITIONS, TIMED_FILES_PER_BATCH = 100_000, 8, 2  # four batches of small input too

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(function):
    QUERIES[function.__name__.strip("_")] = function
    return function


def shown(df: DataFrame, *columns: str) -> DataFrame:
    """Comparable values: UTC times without zone, floats as doubles, computed means at 6 decimals."""
    kinds = dict(df.dtypes)
    measured = ("rolling_avg_", "avg_", "coolant_temp_delta", "max_coolant_temp_delta", "anomaly_rate", "_penalty",
                "_ratio", "volatility", "probability", "precision", "recall", "f1", "auc_roc", "scale_pos_weight", "value")

    def view(name: str):
        if kinds[name] == "timestamp":
            return F.col(name).cast("timestamp_ntz").alias(name)
        if kinds[name] in ("float", "double"):
            value = F.col(name).cast("double")
            return (F.round(value, 6) if any(m in name for m in measured) else value).alias(name)
        return F.col(name)

    return df.select(*[view(c) for c in columns or df.columns])


# --- inputs shared by the queries ---


def _bronze(spark: SparkSession, folder: str) -> DataFrame:
    return layers.bronze_from_readings(derived.telemetry(spark, folder))


def _silver(spark: SparkSession, folder: str, **options) -> DataFrame:
    return windows.silver_telemetry(_bronze(spark, folder), keep=("seq",), **options)


def _metrics(spark: SparkSession, folder: str) -> DataFrame:
    return health.vehicle_metrics(_silver(spark, folder))


def _health(spark: SparkSession, folder: str) -> DataFrame:
    return health.vehicle_health(_silver(spark, folder))


def _features(spark: SparkSession, folder: str) -> DataFrame:
    return health.vehicle_features(_metrics(spark, folder))


def _stored_metrics(spark: SparkSession, folder: str) -> DataFrame:
    """Metrics written once, for questions that read them several times."""
    return written(_metrics(spark, folder), "metrics")


def _stored_features(spark: SparkSession, folder: str) -> DataFrame:
    return written(_features(spark, folder), "features")


def _newest(spark: SparkSession, folder: str) -> dt.datetime:
    return incremental.high_water(derived.telemetry(spark, folder))


def _decoded(spark: SparkSession, folder: str) -> DataFrame:
    return messages.decode_messages(derived.messages(spark, folder))


SILVER_OUT = ("seq", *SILVER_COLUMNS)
METRICS_OUT = ("vehicle_id", "vehicle_model", "vehicle_class", "avg_coolant_temp", "max_coolant_temp",
               "avg_battery_voltage", "min_battery_voltage", "avg_rpm", "total_anomaly_count", "total_readings",
               "avg_rolling_anomaly_count", "max_coolant_temp_delta", "total_sessions")
HEALTH_OUT = (*METRICS_OUT, "anomaly_rate", "health_score")
TRIPS_OUT = ("vehicle_id", "started_at", "ended_at", "readings", "anomalies")


# --- messages and bronze ---


@query
def decode_json(spark, folder):
    good = messages.accepted(_decoded(spark, folder))
    fields = [F.col(f"obd.{f}") for f in OBD_FIELDS] + [F.col(f"gps.{f}") for f in GPS_FIELDS]
    return good.select("seq", *IDENTITY_FIELDS, *fields)


@query
def quarantine_counts(spark, folder):
    return messages.quarantine_counts(_decoded(spark, folder))


@query
def quarantine_messages(spark, folder):
    return messages.quarantined(_decoded(spark, folder)).select("seq", "reject_reason")


@query
def flatten(spark, folder):
    flat = readings.flatten(messages.accepted(_decoded(spark, folder)))
    return flat.select("seq", *IDENTITY_FIELDS, *READING_FIELDS)


@query
def parse_types(spark, folder):
    typed = readings.parse_types(readings.flatten(messages.accepted(_decoded(spark, folder))))
    return shown(typed, "seq", *IDENTITY_FIELDS, *READING_FIELDS)


@query
def bronze_projection(spark, folder):
    flat = readings.parse_types(readings.flatten(messages.accepted(_decoded(spark, folder))))
    return shown(readings.to_bronze(readings.detect_anomalies(flat)))


@query
def bronze(spark, folder):
    return shown(layers.bronze_from_messages(derived.messages(spark, folder)))


@query
def encode_json(spark, folder):
    """Encoding and decoding give back the readings."""
    encoded = messages.encode_messages(derived.telemetry(spark, folder))
    decoded = messages.accepted(messages.decode_messages(encoded))
    return shown(readings.parse_types(readings.flatten(decoded)), "key", *IDENTITY_FIELDS, *READING_FIELDS)


@query
def detect_anomalies(spark, folder):
    flagged = readings.detect_anomalies(derived.telemetry(spark, folder))
    return shown(flagged, "seq", "vehicle_id", "timestamp", "anomaly_flag", "anomaly_reason")


# --- quality ---


@query
def enrich_fleet(spark, folder):
    """Models are those of the built-in fleet, in turn, and one that is not listed."""
    names = F.array(*[F.lit(m) for m in FLEET_MODELS])
    model = F.get(names, (F.col("seq") % len(FLEET_MODELS)).cast("int"))
    return quality.enrich_fleet(derived.telemetry(spark, folder).select("seq", "vehicle_id", model.alias("vehicle_model")))


@query
def enrich_fleet_models(spark, folder):
    models = {f"Model-{n:02d}": "COMMERCIAL" if n >= 20 else "PASSENGER" for n in range(26)}
    rows = derived.telemetry(spark, folder).select("seq", "vehicle_id", "vehicle_model")
    enriched = quality.enrich_fleet(rows, models=models)
    return enriched.select("seq", "vehicle_id", "vehicle_model", "fleet_class", "max_rpm", "volt_baseline")


@query
def clip_readings(spark, folder):
    clipped = quality.clip_readings(derived.telemetry(spark, folder))
    return shown(clipped, "seq", "vehicle_id", "timestamp", *OBD_FIELDS, "out_of_bounds")


@query
def dedupe_readings(spark, folder):
    """Times are cut to the minute, so that there are duplicates to drop."""
    rows = derived.telemetry(spark, folder).withColumn("timestamp", F.date_trunc("MINUTE", "timestamp"))
    return shown(quality.dedupe_readings(rows), "vehicle_id", "timestamp", "seq", "rpm")


# --- silver ---


@query
def rolling_means(spark, folder):
    return shown(_silver(spark, folder), "seq", "vehicle_id",
                 *[c for c in SILVER_COLUMNS if c.startswith("rolling_avg_")])


@query
def rolling_anomaly_count(spark, folder):
    return _silver(spark, folder).select("seq", "vehicle_id", "rolling_anomaly_count")


@query
def coolant_delta(spark, folder):
    return shown(_silver(spark, folder), "seq", "vehicle_id", "coolant_temp_delta")


@query
def coolant_delta_zero_base(spark, folder):
    return shown(_silver(spark, folder, first_delta="zero_base"), "seq", "vehicle_id", "coolant_temp_delta")


@query
def sessionize(spark, folder):
    return shown(_silver(spark, folder), "seq", "vehicle_id", "timestamp", "is_session_start", "session_id")


@query
def silver_telemetry(spark, folder):
    return shown(_silver(spark, folder), *SILVER_OUT)


@query
def silver_telemetry_in_runs(spark, folder):
    """Every vehicle's history cut into runs, as for a vehicle too large for one task."""
    rows = _bronze(spark, folder)
    split = windows.silver_telemetry(rows, keep=("seq",), rows_per_task=40, rows_per_run=500)
    return shown(split, *SILVER_OUT)


@query
def silver_counted(spark, folder):
    """The same from a table of three batches, which has counted its readings per vehicle and day."""
    rows = _bronze(spark, folder)
    table = BronzeTable(spark, scratch_path(spark, "counted-bronze"), fan_in=2, counted=True, seq="long")
    for n in range(3):
        table.add(rows.filter(F.pmod("seq", F.lit(3)) == n), n)
    table.compact()
    large = table.large_vehicles(100)
    split = windows.silver_telemetry(table.read(), keep=("seq",), rows_per_task=100, rows_per_run=500, large=large)
    return shown(split, *SILVER_OUT)


@query
def silver_incremental_slice(spark, folder):
    rows = _bronze(spark, folder)
    stored = windows.silver_telemetry(rows.filter(F.col("timestamp") <= kpis.as_of_column(CUTOFF)), keep=("seq",))
    return shown(incremental.slice_refresh(rows, stored, keep=("seq",)), *SILVER_OUT)


@query
def silver_incremental_continuous(spark, folder):
    """Two arrivals, the second with late readings, give the silver of one full refresh."""
    is_first = (F.col("timestamp") <= kpis.as_of_column(CUTOFF)) & (F.col("seq") % 500 != 7)
    return _arrived(spark, folder, F.when(is_first, 0).otherwise(1), 2)


@query
def silver_late_arrivals(spark, folder):
    """So do three, of which the third is all late and the second partly; sessions move twice."""
    is_old = F.col("timestamp") <= kpis.as_of_column(CUTOFF)
    turn = F.when(F.col("seq") % 500 == 7, 2).when(is_old & (F.col("seq") % 700 != 11), 0).otherwise(1)
    return _arrived(spark, folder, turn, 3)


def _arrived(spark: SparkSession, folder: str, turn: Column, turns: int) -> DataFrame:
    arrivals = written(_bronze(spark, folder).withColumn("turn", turn), "arrivals")
    silver = written(windows.silver_telemetry(arrivals.filter("turn = 0"), keep=("seq",)), "silver")
    for n in range(1, turns):
        refresh = incremental.continuous_refresh(arrivals.filter(F.col("turn") == n), silver)
        silver = incremental.refreshed(silver, refresh._replace(rows=written(refresh.rows, "refreshed")))
        if n + 1 < turns:
            silver = written(silver, "silver")
    return shown(silver, *SILVER_OUT)


@query
def silver_upsert(spark, folder):
    rows = _silver(spark, folder)
    cutoff = kpis.as_of_column(CUTOFF)
    stored = rows.filter(F.col("timestamp") <= cutoff)
    fresh = rows.filter(F.col("timestamp") > cutoff - F.expr("INTERVAL 1 HOUR")).withColumn(
        "anomaly_reason", F.lit("Reviewed"))
    return shown(merge_by_key(stored, fresh), "seq", "vehicle_id", "timestamp", "anomaly_reason", "session_id")


@query
def silver_upsert_days(spark, folder):
    """The same into a stored table, where the days of the update are replaced at once."""
    rows = written(_silver(spark, folder), "silver")
    cutoff = kpis.as_of_column(CUTOFF)
    table = DayTable(spark, scratch_path(spark, "silver-days"), rows.schema)
    table.merge(rows.filter(F.col("timestamp") <= cutoff))
    table.merge(rows.filter(F.col("timestamp") > cutoff - F.expr("INTERVAL 1 HOUR")).withColumn("anomaly_reason", F.lit("Reviewed")), 1)
    return shown(table.read(), "seq", "vehicle_id", "timestamp", "anomaly_reason", "session_id")


@query
def trips(spark, folder):
    return shown(windows.sessions(_silver(spark, folder)))


@query
def trips_session_window(spark, folder):
    return shown(live.trips(_bronze(spark, folder)), *TRIPS_OUT)


@query
def trips_in_slices(spark, folder):
    """A third of all readings are of one vehicle here, and slices spread them."""
    rows = _bronze(spark, folder)
    return shown(live.trips_in_slices(rows.withColumn("vehicle_id", F.when(F.col("seq") % 3 == 0, "V-HOT").otherwise(F.col("vehicle_id")))), *TRIPS_OUT)


@query
def fleet_by_sketches(spark, folder):
    """Vehicles, sessions and readings of all days and of the last two, from sketches stored per day."""
    stored = written(sketches.daily_sketches(_silver(spark, folder)), "sketches")
    newest = stored.agg(F.max("event_date")).first()[0]
    spans = [("all", sketches.distinct_between(stored))]
    if newest is not None:
        spans.append(("last two days", sketches.distinct_between(stored, newest - dt.timedelta(days=1), newest)))
    rows = None
    for name, row in spans:
        one = row.select(F.lit(name).alias("span"), "*")
        rows = one if rows is None else rows.unionByName(one)
    exact = _silver(spark, folder).agg(F.count_distinct("vehicle_id", "session_id")).first()[0]
    within = F.when(F.col("span") == "all", F.abs(F.col("sessions") - exact) <= sketches.RELATIVE_ERROR * exact)
    return rows.select("span", "vehicles", "readings", within.alias("sessions_within_error"))


# --- gold ---


@query
def vehicle_metrics(spark, folder):
    return shown(_metrics(spark, folder), *METRICS_OUT, "avg_maf")


@query
def health_breakdown(spark, folder):
    scored = health.health_breakdown(_metrics(spark, folder))
    return shown(scored, "vehicle_id", "anomaly_rate", *health.PENALTIES, "health_score")


@query
def gold_vehicle_health(spark, folder):
    return shown(_health(spark, folder), *HEALTH_OUT)


@query
def gold_from_messages(spark, folder):
    """Raw messages to health scores, with bronze stored once."""
    rows = written(layers.bronze_from_messages(derived.messages(spark, folder)), "bronze")
    return shown(layers.gold_from_bronze(rows), *HEALTH_OUT)


@query
def gold_zero_base(spark, folder):
    """Health where a vehicle's first reading counts as a change from zero."""
    return shown(health.vehicle_health(_silver(spark, folder, first_delta="zero_base")), *HEALTH_OUT)


# --- dashboard ---


@query
def kpi_total_vehicles(spark, folder):
    return kpis.total_vehicles(_health(spark, folder))


@query
def kpi_anomaly_rate_live(spark, folder):
    return shown(kpis.live_anomaly_rate(_bronze(spark, folder), _newest(spark, folder)))


@query
def kpi_at_risk_count(spark, folder):
    return kpis.at_risk_count(risk.label_predictions(_features(spark, folder)))


@query
def kpi_status(spark, folder):
    features = _stored_features(spark, folder)
    return shown(kpis.kpi_statuses(_bronze(spark, folder), features, risk.label_predictions(features),
                                   _newest(spark, folder)))


@query
def health_distribution(spark, folder):
    return kpis.health_distribution(_health(spark, folder))


@query
def risk_distribution(spark, folder):
    return kpis.risk_distribution(risk.label_predictions(_features(spark, folder)))


@query
def anomaly_timeseries_10s(spark, folder):
    return shown(kpis.anomaly_series(_bronze(spark, folder), _newest(spark, folder)))


@query
def worst_vehicles(spark, folder):
    metrics = _stored_metrics(spark, folder)
    predictions = risk.label_predictions(health.vehicle_features(metrics))
    return shown(kpis.worst_vehicles(health.health_breakdown(metrics), predictions))


@query
def avg_health_by_model(spark, folder):
    return shown(kpis.average_health_by_model(_health(spark, folder)))


# --- risk model ---


@query
def vehicle_features(spark, folder):
    return shown(_features(spark, folder))


@query
def at_risk_label(spark, folder):
    return _features(spark, folder).select("vehicle_id", "health_score", "is_at_risk")


@query
def encode_class(spark, folder):
    coded = evaluation.encode_category(_features(spark, folder), "vehicle_class", "vehicle_class_code")
    return coded.select("vehicle_id", "vehicle_class", F.col("vehicle_class_code").cast("long").alias("vehicle_class_code"))


@query
def encode_class_known(spark, folder):
    coded = evaluation.encode_known(_features(spark, folder), "vehicle_class", "vehicle_class_code", tuple(CLASS_PROFILES))
    return coded.select("vehicle_id", "vehicle_class", F.col("vehicle_class_code").cast("long").alias("vehicle_class_code"))


@query
def stratified_split(spark, folder):
    return evaluation.stratified_split(_stored_features(spark, folder)).select("vehicle_id", "is_at_risk", "is_test")


@query
def class_balance(spark, folder):
    train, _ = risk.train_and_test(_stored_features(spark, folder))
    return shown(evaluation.class_balance(train))


@query
def classification_report(spark, folder):
    return shown(evaluation.classification_report(risk.threshold_predictions(_features(spark, folder))))


@query
def auc_roc(spark, folder):
    return shown(evaluation.auc_roc(risk.threshold_predictions(_stored_features(spark, folder))), "auc_roc")


def _nodes(features: DataFrame) -> DataFrame:
    """The trees fitted to the training side of stored features, stored themselves."""
    return written(boosting.fit_trees(risk.train_and_test(features)[0]), "risk-nodes")


@query
def risk_predictions(spark, folder):
    features = _stored_features(spark, folder)
    return shown(boosting.fleet_predictions(_nodes(features), features, CUTOFF))


@query
def risk_tree_gains(spark, folder):
    """Per tree its splits, what they gain, and how many vehicles end in its leaves."""
    nodes = _nodes(_stored_features(spark, folder))
    gains = nodes.groupBy("tree").agg(
        F.count("feature").alias("splits"), F.round(F.sum("gain"), 6).alias("gain"), F.max(F.col("node")).alias("last_node"))
    return gains.select(F.col("tree").cast("long").alias("tree"), "splits", "gain", F.col("last_node").cast("long").alias("last_node"))


@query
def feature_importance(spark, folder):
    return shown(boosting.importance_from_nodes(_nodes(_stored_features(spark, folder))).withColumnRenamed("importance", "value"))


@query
def model_quality(spark, folder):
    """The report of the fitted trees on vehicles they have not seen."""
    features = _stored_features(spark, folder)
    _, test = risk.train_and_test(features)
    return shown(evaluation.classification_report(boosting.scored_by_nodes(_nodes(features), test)))


@query
def model_auc(spark, folder):
    """The area under the curve of the fitted trees on vehicles they have not seen."""
    features = _stored_features(spark, folder)
    _, test = risk.train_and_test(features)
    scored = boosting.scored_by_nodes(_nodes(features), test)
    # scores are compared at the precision they are shown with
    return shown(evaluation.auc_roc(written(scored.withColumn("risk_probability", F.round("risk_probability", 9)), "scored")), "auc_roc")


def _predictions(spark: SparkSession, metrics: DataFrame) -> DataFrame:
    """The stored predictions of the fitted trees for the whole fleet."""
    features = written(health.vehicle_features(metrics), "features")
    return boosting.refresh_predictions(features, scratch_path(spark, "predictions"), CUTOFF)


@query
def stored_predictions(spark, folder):
    """The table of predictions, with probabilities within 0 and 1 and labels that follow from them."""
    rows = _predictions(spark, _stored_metrics(spark, folder))
    return shown(rows.select(
        "*", F.col("risk_probability").between(0, 1).alias("in_range"),
        ((F.col("risk_probability") > 0.5) == (F.col("risk_label") == 1)).alias("label_agrees")))


@query
def kpis_on_predictions(spark, folder):
    """The at-risk count and the risk distribution over the table of predictions."""
    rows = _predictions(spark, _stored_metrics(spark, folder))
    by_label = kpis.risk_distribution(rows).select("label", "vehicles")
    return by_label.unionByName(kpis.at_risk_count(rows).select(F.lit("count").alias("label"), F.col("at_risk_vehicles").alias("vehicles")))


@query
def worst_vehicles_on_predictions(spark, folder):
    metrics = _stored_metrics(spark, folder)
    worst = kpis.worst_vehicles(health.health_breakdown(metrics), _predictions(spark, metrics))
    return shown(worst, "vehicle_id", "vehicle_model", "vehicle_class", "health_score", "risk_probability")


@query
def feature_importance_total(spark, folder):
    rows = boosting.importance_from_nodes(_nodes(_stored_features(spark, folder)))
    return rows.agg(F.count("feature").alias("features"), F.round(F.sum("importance"), 6).alias("total"))


@query
def model_quality_supports(spark, folder):
    """Supports of the report on unseen vehicles: these depend on the split alone."""
    return model_quality(spark, folder).select("label", "support")


# --- streams, run until all input is consumed ---


def _staged(spark: SparkSession, rows: DataFrame, label: str, timed: bool = True) -> tuple[DataFrame, str]:
    """``rows`` as a file stream in batches of a bounded number of rows, in order of time where event time decides what is
    late. And a folder for its output and checkpoint."""
    root = scratch_path(spark, label)
    if timed:
        stage_in_order(rows, f"{root}/input", rows_per_file=TIMED_RECORDS_PER_FILE, partitions=TIMED_PARTITIONS)
    else:
        rows.write.option("maxRecordsPerFile", RECORDS_PER_FILE).parquet(f"{root}/input")
    files = TIMED_FILES_PER_BATCH if timed else FILES_PER_BATCH
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", str(files)).parquet(f"{root}/input"), root


def _drained(stream: DataFrame, root: str) -> DataFrame:
    """Append ``stream`` to the exactly-once file sink until its input ends, then read the result."""
    spark = stream.sparkSession
    writer = stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", f"{root}/checkpoint")
    query = start_sized(writer.trigger(availableNow=True), f"{root}/output", TIMED_RECORDS_PER_FILE * TIMED_FILES_PER_BATCH, spark)
    query.awaitTermination()
    if late_drops(query):
        raise RuntimeError(f"{late_drops(query)} rows of {batches(query)} batches came too late, though they were sent in order")
    return spark.read.schema(stream.schema).parquet(f"{root}/output")


@query
def stream_bronze(spark, folder):
    stream, root = _staged(spark, derived.messages(spark, folder), "stream-bronze", timed=False)
    ingest.start_bronze(stream, f"{root}/bronze", f"{root}/quarantine", f"{root}/checkpoint",
                        interval=None).awaitTermination()
    return shown(read_telemetry(spark, f"{root}/bronze", BRONZE_SCHEMA, seq="long", batch_id="long"),
                 "seq", *BRONZE_COLUMNS)


@query
def stream_bronze_table(spark, folder):
    """The same into a table whose batches are merged in levels between further batches."""
    stream, root = _staged(spark, derived.messages(spark, folder), "stream-bronze", timed=False)
    table = BronzeTable(spark, f"{root}/bronze", fan_in=2, seq="long")
    ingest.start_bronze_table(stream, table, f"{root}/quarantine", f"{root}/checkpoint", interval=None).awaitTermination()
    return shown(table.read(), "seq", *BRONZE_COLUMNS)


@query
def stream_bronze_interleaved(spark, folder):
    """The same with merged folders cut by vehicle and time at once; how many readings of each vehicle and hour lie in it."""
    stream, root = _staged(spark, derived.messages(spark, folder), "stream-bronze", timed=False)
    table = BronzeTable(spark, f"{root}/bronze", fan_in=2, interleaved=True, seq="long")
    ingest.start_bronze_table(stream, table, f"{root}/quarantine", f"{root}/checkpoint", interval=None).awaitTermination()
    hours = table.read().groupBy("vehicle_id", F.date_trunc("hour", "timestamp").alias("hour"))
    return hours.agg(F.count(F.lit(1)).alias("readings"), F.sum("anomaly_flag").alias("anomalies"), F.max("seq").alias("last_seq"))


@query
def stream_quarantine(spark, folder):
    stream, root = _staged(spark, derived.messages(spark, folder), "stream-quarantine", timed=False)
    return _drained(ingest.rejected_stream(stream), root).select("seq", "reject_reason")


@query
def stream_anomaly_series(spark, folder):
    stream, root = _staged(spark, _bronze(spark, folder), "stream-series")
    return shown(_drained(live.live_anomaly_series(stream), root))


@query
def stream_anomaly_rate(spark, folder):
    stream, root = _staged(spark, _bronze(spark, folder), "stream-rate")
    return shown(_drained(live.live_anomaly_rate(stream), root))


@query
def stream_trips(spark, folder):
    stream, root = _staged(spark, _bronze(spark, folder), "stream-trips")
    return shown(_drained(live.trips(stream), root), *TRIPS_OUT)


@query
def stream_dedupe(spark, folder):
    """Every reading arrives twice."""
    once = _bronze(spark, folder)
    stream, root = _staged(spark, once.unionByName(once), "stream-dedupe")
    return shown(_drained(live.without_duplicates(stream), root), "vehicle_id", "timestamp")


@query
def stream_dedupe_hot_key(spark, folder):
    """One key holds half of the input: every reading comes once, and the earliest again as often as there are readings."""
    once = _bronze(spark, folder)
    least = once.agg(F.min(F.struct(F.unix_micros("timestamp").alias("micros"), "vehicle_id")).alias("key")).first().key
    copies = once.withColumn("timestamp", F.timestamp_micros(F.lit(least.micros if least else None).cast("long")))
    copies = copies.withColumn("vehicle_id", F.lit(least.vehicle_id if least else None).cast("string"))
    stream, root = _staged(spark, once.unionByName(copies), "stream-dedupe")
    return shown(_drained(live.without_duplicates(stream, collapse=True), root), "vehicle_id", "timestamp")


def _streamed_store(spark: SparkSession, folder: str) -> SilverStore:
    root = scratch_path(spark, "stream-silver")
    rows = _bronze(spark, folder)
    (rows.repartitionByRange("timestamp").sortWithinPartitions("timestamp")
     .write.option("maxRecordsPerFile", READINGS_PER_BATCH).parquet(f"{root}/input"))
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", "1").parquet(f"{root}/input")
    store = SilverStore(spark, f"{root}/silver", snapshot_every=3, buckets=8, fan_in=3)
    store.start(stream, f"{root}/checkpoint", interval=None).awaitTermination()
    return store


@query
def silver_stream(spark, folder):
    """Files of a fixed number of readings arrive as micro-batches; the stored silver equals one full refresh."""
    return shown(_streamed_store(spark, folder).read(), *SILVER_OUT)


@query
def gold_stream(spark, folder):
    """Health from the totals that the batches have added up."""
    return shown(_streamed_store(spark, folder).health(), *HEALTH_OUT)
