"""Helpers the text operators share: session limits, table reads, bounded slices of Arrow batches."""

from __future__ import annotations

import os
import re
import tempfile
import zipfile
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A batch handed to Python holds a few hundred documents, so that a task's memory follows this and not the partition.
BATCH_SETTINGS = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "256",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20),
}
SLICE_BYTES = 4 << 20


_shipped: set[str] = set()


def prepare(spark: SparkSession) -> None:
    """Batch limits, and once per application the package itself for the executors, wherever they run."""
    for key, value in BATCH_SETTINGS.items():
        spark.conf.set(key, value)
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
        packed = os.path.join(tempfile.mkdtemp(), "motorlytics.zip")
        with zipfile.ZipFile(packed, "w") as out:
            for folder, _, names in os.walk(os.path.join(root, "motorlytics")):
                for name in sorted(n for n in names if n.endswith(".py")):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, root))
        context.addPyFile(packed)  # the driver serves it to the executors
        _shipped.add(context.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the columns an operator reads, by fixed names; a null text becomes the empty one."""
    return docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def free_name(docs: DataFrame, name: str) -> str:
    """``name``, or a longer one that is no column of ``docs``; Spark doesn't tell upper from lower case."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def as_bytes(column: pa.Array) -> list[bytes]:
    return column.cast(pa.large_binary()).to_pylist()


def slices(items: Sequence[bytes], limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive items of about ``limit`` bytes; an item longer than that is a range of its own."""
    start = size = 0
    for i, item in enumerate(items):
        if size and size + len(item) > limit:
            yield start, i
            start, size = i, 0
        size += len(item) + 1
    if start < len(items):
        yield start, len(items)


def batch(schema: pa.Schema, columns: Sequence) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)],
        schema=schema,
    )


def many_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, wherever the optimizer moves the expression."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def filesystem(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a shared folder and the folder's path there; works on the driver and in tasks."""
    return fs.FileSystem.from_uri(re.sub("^file:/(?!/)", "file:///", uri))


# Unsigned CRC-32 of an id's decimal digits in DuckDB, which has no such function.
CRC32_SQL = """xor(4294967295, list_reduce(
  list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: ascii(c)::BIGINT)),
  lambda a, c: list_reduce(list_prepend(xor(a, c), range(8)),
                           lambda x, i: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END))))"""
