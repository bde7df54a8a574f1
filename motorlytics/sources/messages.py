"""Raw messages: reading a topic, decoding JSON with strict types, encoding readings."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from motorlytics.functions.times import parse_instant
from motorlytics.schemas import GPS_FIELDS, IDENTITY_FIELDS, OBD_FIELDS

# --- fixed values: topic names and the registry framing (one magic byte, a four-byte schema id) ---
INPUT_TOPIC = "vehicle.telemetry.raw"
OUTPUT_TOPIC = "vehicle_telemetry"
FRAME_BYTES = 5
# --- end of fixed values ---

REJECT = "reject_reason"
OFFSETS_PER_PARTITION = 2**44


def broker_options(servers: str, username: str | None = None, password: str | None = None) -> dict[str, str]:
    """Connection options shared by source and sink; with credentials the link is SASL_SSL / PLAIN."""
    options = {"kafka.bootstrap.servers": servers}
    if username is not None:
        escaped = [str(part).replace("\\", "\\\\").replace('"', '\\"') for part in (username, password or "")]
        options |= {
            "kafka.security.protocol": "SASL_SSL",
            "kafka.sasl.mechanism": "PLAIN",
            "kafka.sasl.jaas.config": (
                "org.apache.kafka.common.security.plain.PlainLoginModule required "
                f'username="{escaped[0]}" password="{escaped[1]}";'
            ),
        }
    return options


def topic_source_options(
    connection: dict[str, str],
    topic: str = INPUT_TOPIC,
    starting_offsets: str = "latest",
    max_offsets_per_trigger: int | None = None,
    min_partitions: int | None = None,
    group_prefix: str | None = None,
) -> dict[str, str]:
    """Options for ``readStream.format("kafka")``; progress lives in the query checkpoint."""
    options = {**connection, "subscribe": topic, "startingOffsets": starting_offsets}
    if max_offsets_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    if min_partitions:
        options["minPartitions"] = str(min_partitions)
    if group_prefix:
        options["groupIdPrefix"] = group_prefix
    return options


def read_topic(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """Messages of a topic as a stream, each with a unique ingest number that ascends within its partition."""
    source = spark.readStream.format("kafka").options(**options).load()
    return source.select(
        "value",
        (F.col("partition").cast("long") * OFFSETS_PER_PARTITION + F.col("offset")).alias("seq"),
        F.col("timestamp").alias("ingest_time"),
    )


def write_topic(encoded: DataFrame, connection: dict[str, str], checkpoint: str,
                topic: str = OUTPUT_TOPIC) -> DataStreamWriter:
    """A stream writer that publishes ``key`` / ``value`` rows; the caller starts it."""
    return (
        encoded.writeStream.format("kafka")
        .options(**connection, topic=topic)
        .option("checkpointLocation", checkpoint)
    )


def message_text(value: Column, framed: bool = False) -> Column:
    """Payload bytes or text as a string, without the registry frame when there is one."""
    if framed:
        value = F.substring(value.cast("binary"), FRAME_BYTES + 1, 2**31 - 1)
    return value.cast("string")


def _mistyped(leaf: Column, name: str, expected: Callable[[Column], Column]) -> Column:
    """``name`` when the value is present with another JSON type; a present null counts, a missing key does not."""
    return F.when(~expected(F.schema_of_variant(leaf)), name)


def _is_object(kind: Column) -> Column:
    return kind.startswith("OBJECT")


def _is_number(kind: Column) -> Column:
    return kind.startswith("DECIMAL") | kind.isin("BIGINT", "DOUBLE", "FLOAT")


def _is_string(kind: Column) -> Column:
    return kind == "STRING"


def _parts(value: Column, fields: tuple[str, ...]) -> Column:
    """Split an object into one variant per declared field; NULL when the value is not an object."""
    return F.try_variant_get(value, "$", "struct<" + ", ".join(f"{f}: variant" for f in fields) + ">")


def _looked_up_defect(text: Column) -> Column:
    """What is wrong with a message, found field by field; NULL when nothing is."""

    def first_wrong(parts: Column) -> Column:
        top, obd, gps = parts["top"], parts["obd"], parts["gps"]
        wrong = F.coalesce(
            *[_mistyped(top[name], name, _is_string) for name in IDENTITY_FIELDS],
            *[_mistyped(top[name], name, _is_object) for name in ("obd", "gps")],
            *[_mistyped(obd[name], f"obd.{name}", _is_number) for name in OBD_FIELDS],
            *[_mistyped(gps[name], f"gps.{name}", _is_number) for name in GPS_FIELDS],
        )
        return F.when(top.isNull(), "malformed_json").otherwise(F.concat(F.lit("wrong_type:"), wrong))

    def split(message: Column) -> Column:
        top = _parts(message, (*IDENTITY_FIELDS, "obd", "gps"))
        return F.struct(top.alias("top"), _parts(F.try_variant_get(message, "$.obd", "variant"), OBD_FIELDS).alias("obd"),
                        _parts(F.try_variant_get(message, "$.gps", "variant"), GPS_FIELDS).alias("gps"))

    return F.transform(F.transform(F.array(F.try_parse_json(text)), split), first_wrong)[0]


_CORRUPT = "_corrupt"
_READ_SCHEMA = "struct<{}, obd: struct<{}>, gps: struct<{}>, {}: string>".format(
    ", ".join(f"{f}: variant" for f in IDENTITY_FIELDS),
    ", ".join(f"{f}: double" for f in OBD_FIELDS),
    ", ".join(f"{f}: double" for f in GPS_FIELDS),
    _CORRUPT,
)
_READ_OPTIONS = {
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": _CORRUPT,
    "allowNonNumericNumbers": "false",
    "allowSingleQuotes": "false",
}


def decode_messages(messages: DataFrame, value: str = "value", framed: bool = False) -> DataFrame:
    """Read the declared fields of each message, checking every one against its JSON type.

    Returns the other input columns, the raw ``value`` text, the declared fields (``obd`` and ``gps`` as
    structs) and ``reject_reason``, NULL for a good message. No message fails the job and none is lost:
    a missing key is accepted, a present value of another type (null included) is not, and a reading
    that no table could hold (no vehicle, no usable time) is rejected here rather than at the write.
    Extra fields are ignored.

    A typed read gives the values, but it stops at the end of the first value and cannot tell a missing
    key from a null. Counting the elements of ``[<text>, 0]`` covers the whole text; field-by-field
    checks run only for the messages in which the typed read left something open.
    """
    kept = [c for c in messages.columns if c != value]
    text = messages.withColumn(value, message_text(F.col(value), framed))
    read = text.select(*kept, value, F.from_json(value, _READ_SCHEMA, _READ_OPTIONS).alias("_read"))
    texts = [F.col(f"_read.{name}") for name in IDENTITY_FIELDS]
    numbers = [F.col(f"_read.obd.{name}") for name in OBD_FIELDS] + [F.col(f"_read.gps.{name}") for name in GPS_FIELDS]
    is_corrupt = F.col(f"_read.{_CORRUPT}").isNotNull()
    is_open = is_corrupt | reduce(or_, [n.isNull() for n in numbers])
    is_open = is_open | reduce(or_, [t.isNull() | ~_is_string(F.schema_of_variant(t)) for t in texts])
    elements = F.json_array_length(F.concat(F.lit("["), F.col(value), F.lit(", 0]")))
    defect = (
        F.when(F.coalesce(elements, F.lit(0)) != 2, "malformed_json")
        .when(~F.col(value).rlike(r"^\s*\{"), "not_an_object")
        .when(is_open, F.coalesce(_looked_up_defect(F.col(value)), F.when(is_corrupt, "malformed_json")))
    )
    row = F.struct(
        *[F.try_variant_get(t, "$", "string").alias(name) for t, name in zip(texts, IDENTITY_FIELDS)],
        F.col("_read.obd"),
        F.col("_read.gps"),
        defect.alias("_defect"),
    )
    # A generator, because a filter on its output stays above it: as a plain projection, filtering on
    # the reject reason would repeat the parse inside the filter.
    typed = read.select(*kept, value, row.alias("_row")).select(*kept, value, F.inline(F.array("_row")))
    reason = (
        F.when(F.col("_defect").isNotNull(), F.col("_defect"))
        .when(F.col("vehicle_id").isNull(), "missing_vehicle_id")
        .when(F.col("timestamp").isNull(), "missing_timestamp")
        .when(parse_instant(F.col("timestamp")).isNull(), "bad_timestamp")
    )
    return typed.withColumn(REJECT, reason).drop("_defect")


def accepted(decoded: DataFrame, value: str = "value") -> DataFrame:
    return decoded.filter(F.col(REJECT).isNull()).drop(REJECT, value)


def quarantined(decoded: DataFrame, value: str = "value") -> DataFrame:
    """Rejected messages with their text, so that they can be repaired and replayed."""
    kept = [c for c in decoded.columns if c not in (*IDENTITY_FIELDS, "obd", "gps")]
    return decoded.filter(F.col(REJECT).isNotNull()).select(*kept)


def quarantine_counts(decoded: DataFrame) -> DataFrame:
    return (
        decoded.filter(F.col(REJECT).isNotNull())
        .groupBy(REJECT)
        .agg(F.count(F.lit(1)).alias("messages"))
    )


def encode_messages(readings: DataFrame, key: str = "vehicle_id") -> DataFrame:
    """Flat or nested readings as topic rows (``key``, ``value``).

    The default key keeps a vehicle's readings on one broker partition and therefore in order;
    ``key="random"`` spreads them instead.
    """
    nested = readings.columns
    obd = F.col("obd") if "obd" in nested else F.struct(*[F.col(f).cast("double").alias(f) for f in OBD_FIELDS])
    gps = F.col("gps") if "gps" in nested else F.struct(*[F.col(f).cast("double").alias(f) for f in GPS_FIELDS])
    time = F.col("timestamp")
    if dict(readings.dtypes)["timestamp"] != "string":
        time = F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss.SSSXXX")
    body = F.to_json(F.struct(
        time.alias("timestamp"), "vehicle_id", "vehicle_model", "vehicle_class", obd.alias("obd"), gps.alias("gps"),
    ))
    key_column = F.expr("uuid()") if key == "random" else F.col(key).cast("string")
    return readings.select(key_column.alias("key"), body.alias("value"))
