"""From decoded messages to bronze rows: flatten, type, flag, project."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from motorlytics.functions.rules import NO_ANOMALY, fired_rules
from motorlytics.functions.times import parse_instant
from motorlytics.schemas import BRONZE_SCHEMA, READING_FIELDS, SEQUENCE

UNKNOWN = "Unknown"


def flatten(messages: DataFrame) -> DataFrame:
    """Lift the fields of ``obd`` and ``gps`` to the top level.

    When a name occurs more than once, ``gps`` wins over ``obd`` and ``obd`` over the top level.
    """
    groups = [g for g in ("obd", "gps") if g in messages.columns]
    sources: dict[str, list] = {c: [F.col(f"`{c}`")] for c in messages.columns if c not in groups}
    for group in groups:
        for name in messages.schema[group].dataType.names:
            sources.setdefault(name, []).insert(0, F.col(f"`{group}`.`{name}`"))
    return messages.select(*[F.coalesce(*found).alias(name) for name, found in sources.items()])


def parse_types(flat: DataFrame) -> DataFrame:
    """Text times become UTC instants (ms), readings doubles; what cannot be read becomes NULL."""
    typed = {name: F.expr(f"try_cast(`{name}` AS double)") for name in READING_FIELDS if name in flat.columns}
    if dict(flat.dtypes).get("timestamp") == "string":
        typed["timestamp"] = parse_instant(F.col("timestamp"))
    return flat.withColumns(typed)


def detect_anomalies(typed: DataFrame) -> DataFrame:
    """Add ``anomaly_flag`` and ``anomaly_reason``; a missing class counts as PASSENGER here only."""
    # Two steps, so that the rules run once for both columns.
    fired = typed.withColumn("anomaly_reason", fired_rules())
    is_normal = F.col("anomaly_reason") == ""
    return fired.withColumns({
        "anomaly_flag": (~is_normal).cast("int"),
        "anomaly_reason": F.when(is_normal, NO_ANOMALY).otherwise(F.col("anomaly_reason")),
    })


def to_bronze(flagged: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """The bronze contract: its columns, order and storage types; ``keep`` appends lineage columns."""
    columns = []
    for field in BRONZE_SCHEMA.fields:
        column = F.col(field.name)
        if field.name in ("vehicle_model", "vehicle_class"):
            column = F.coalesce(column, F.lit(UNKNOWN))
        columns.append(column.cast(field.dataType).alias(field.name))
    return flagged.select(*columns, *keep)


def bronze(messages: DataFrame, keep: tuple[str, ...] | None = None) -> DataFrame:
    """Accepted messages to bronze rows; the same code runs on a batch and on a stream."""
    if keep is None:
        keep = tuple(c for c in (SEQUENCE,) if c in messages.columns)
    return to_bronze(messages.transform(flatten).transform(parse_types).transform(detect_anomalies), keep)
