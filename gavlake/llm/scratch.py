"""Written intermediate tables in the shared checkpoint folder, and their removal."""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Callable

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

from gavlake.session import scratch_path


def ship_by_value(module: str) -> None:
    """Send the functions of ``module`` to executors as code, so they need no package."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


def give_back() -> None:
    """Return freed memory to the system: Python workers outlive their tasks and would keep it.

    Arrow's pool and, where the C library has the call, the heap of NumPy's arrays.
    """
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def lean_batches(work: Callable) -> Callable:
    """``work`` (batches -> batches) for ``mapInArrow``; the worker keeps no memory of it after a task."""

    def run(batches):
        yield from work(batches)
        give_back()

    return run


def lean_group(work: Callable) -> Callable:
    """``work`` (table -> table) for ``applyInArrow``; the worker keeps no memory of a group."""

    def run(table: pa.Table) -> pa.Table:
        out = work(table)
        give_back()
        return out

    return run


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once below ``spark.checkpoint.dir`` and read back.

    It cuts the lineage, and a lost executor costs no more than the files' next read.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._staged_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Remove staged tables that no later step reads."""
    for table in tables:
        path = getattr(table, "_staged_path", None)
        if path:
            spark: SparkSession = table.sparkSession
            jvm = spark._jvm
            target = jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


#: Bytes of a batch of rows on its way to Python; long texts then make short batches.
BATCH_BYTES = 4 << 20
_BATCH_KEY = "spark.sql.execution.arrow.maxBytesPerBatch"


def small_batches(spark: SparkSession) -> None:
    """Hold the session's Arrow batches to BATCH_BYTES, as the plans to come read the setting."""
    now = int(spark.conf.get(_BATCH_KEY).rstrip("bB"))
    if now <= 0 or now > BATCH_BYTES:
        spark.conf.set(_BATCH_KEY, str(BATCH_BYTES))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


ship_by_value(__name__)
