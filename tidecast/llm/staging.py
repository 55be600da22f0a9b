"""Tables that several later steps read, kept in the shared folder of the session."""

from __future__ import annotations

import ctypes
import sys
import types
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidecast.session import scratch_path

#: Rows of an Arrow batch.
BATCH_ROWS = 2000


def new_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder, deleted when the session's JVM ends."""
    path = scratch_path(spark, name)
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(target)
    return path


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and return a reader of the written table.

    Unlike a cache, the table survives lost executors, and its lineage is one file scan.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def worker_store(owner: str) -> dict:
    """A dictionary that lives as long as the Python worker, so that caches outlast one task.

    A worker goes through many stages. It keeps the caches of one operator; when another one asks, they go.
    """
    held = vars(sys.modules.setdefault("_tidecast_worker", types.ModuleType("_tidecast_worker")))
    if held.get("owner") != owner:
        held.update(owner=owner, store={})
    return held["store"]


def release() -> None:
    """Give the memory that a finished task has freed back to the system; a worker would keep it through later stages."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc alone has it
    if trim is not None:
        trim(0)


def short_batches(spark: SparkSession, most: int) -> None:
    """Lower the rows of the session's Arrow batches to ``most``; changes no result."""
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(rows)) <= most:
        spark.conf.set(rows, str(most))


def map_batches(df: DataFrame, fn: Callable, schema: T.StructType | str, most: int = BATCH_ROWS) -> DataFrame:
    """``mapInArrow`` with batches of at most ``most`` rows; a task's end gives its free memory back.

    A batch is held several times on its way (the JVM's buffers, Arrow's, the function's), and the default of 10,000
    whole texts is too much for two tasks beside a full heap. The session's setting is lowered; it changes no result.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from fn(batches)
        release()

    short_batches(df.sparkSession, most)
    return df.mapInArrow(run, schema)


def small(df: DataFrame, rows: int) -> bool:
    """Whether ``df`` has at most ``rows`` rows; reads no more than it needs to know."""
    return df.limit(rows + 1).count() <= rows
