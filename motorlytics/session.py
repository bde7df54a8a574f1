"""Session settings and the shared scratch folder."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

# All event times are UTC instants. Duplicate JSON keys keep the last value, as most JSON readers do.
# Sessions merge on the map side, so a busy vehicle does not ship every reading. Times are written in the type that has statistics
# in Parquet (Spark's default type has none), so that bounds on time skip row groups.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.sessionWindow.mergeSessions.inLocalPartition": "true",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
}

# Only for sessions this module builds; a cluster brings its own sizing. A batch of the silver store runs about 270 pieces of generated
# code, more than the 100 that Spark keeps by default, so without a larger cache every batch compiles all of them again.
BUILD_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.codegen.cache.maxEntries": "4000",
}


def build_session(app: str = "motorlytics", master: str | None = None, **settings: str) -> SparkSession:
    """A session with the settings above; keyword arguments use ``__`` for dots and win over defaults."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    extra = {key.replace("__", "."): value for key, value in settings.items()}
    for key, value in {**BUILD_SETTINGS, **RUNTIME_SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return prepare_session(builder.getOrCreate())


def prepare_session(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the package counts on to a session somebody else built."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shuffle_partitions_for(input_bytes: int, partition_bytes: int = 128 * 1024**2, at_least: int = 8) -> int:
    """``spark.sql.shuffle.partitions`` for a job over ``input_bytes`` of shuffled rows.

    AQE joins partitions that turn out small but never splits one that is too large for a window or an
    aggregate, so the setting has to be high enough: about 800,000 for 100 TB, not the default 200.
    """
    return max(at_least, -(-input_bytes // partition_bytes))


def check_shared(folder: str, master: str) -> None:
    """Raise where executors on several machines would each see a folder of their own."""
    if folder.startswith(("file:", "/")) and not master.startswith("local"):
        raise ValueError(f"set spark.checkpoint.dir to a folder all executors share; {folder} is local to each machine")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh folder in the shared checkpoint directory for a table that cuts lineage.

    The directory is the cluster's ``spark.checkpoint.dir``, or without one a folder in the warehouse. A cluster whose warehouse
    is a local folder too has no place that all executors share, which is an error here rather than lost rows later.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        warehouse = spark.conf.get("spark.sql.warehouse.dir")
        check_shared(warehouse, spark.sparkContext.master)
        root = f"{warehouse.rstrip('/')}/_scratch"
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a table in the shared scratch folder: computed once, whatever reads it, and safe from lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def side_by_side(spark: SparkSession, *steps: Callable[[], object]) -> list:
    """What steps that don't need each other return. Their jobs run at the same time, under the caller's job group; an error
    in one is raised when all have ended."""
    with ThreadPoolExecutor(len(steps)) as pool:
        return [done.result() for done in [pool.submit(inheritable_thread_target(spark)(step)) for step in steps]]
