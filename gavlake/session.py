"""Session helpers: building a session for tests/bench, and the shared scratch folder.

Scratch data (lineage cuts, staged stream input, write-then-swap targets) always goes
below ``spark.checkpoint.dir``. On a cluster that setting names a shared folder and is
read from the session; only when it is unset (local runs, tests) do we create one.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"
_SHUFFLES = "spark.sql.shuffle.partitions"
_SCANS = "spark.sql.files.maxPartitionBytes"
# Records of an exchange's partition, and bytes of files that a task reads, at most: what a task then sorts, some
# hundred bytes a record, does not grow with the index.
RECORDS_PER_TASK = 250_000
SCAN_BYTES = 32 << 20


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "gavlake") -> SparkSession:
    """Session with the settings the package expects (AQE on, UTC, no UI).

    For a local master the shuffle partitions default to 8; on a cluster the cluster's
    own setting is kept unless ``shuffle_partitions`` is given.
    """
    master = master or os.environ.get("GAVLAKE_MASTER", "local[8]")
    if shuffle_partitions is None and master.startswith("local"):
        shuffle_partitions = 8
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("GAVLAKE_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    scratch_root(spark)
    return spark


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]):
    """Plans made inside are made with these settings of the session."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def observed_writes(spark: SparkSession):
    """Writes inside report their observed counts even where a step has no rows: else the plan's adaptive
    part cuts such steps off, and the counts taken in them are lost."""
    return settings(spark, {"spark.sql.adaptive.optimizer.excludedRules":
                            "org.apache.spark.sql.execution.adaptive.AQEPropagateEmptyRelation"})


def compilable(spark: SparkSession):
    """Plans run inside keep to methods that the JVM compiles: one of more than 8,000 bytes of code is only ever
    interpreted, so a projection of many long expressions is then generated in pieces."""
    return settings(spark, {"spark.sql.codegen.hugeMethodLimit": "8000"})


def scans_of(spark: SparkSession, most: int):
    """Plans run inside read files in tasks of at most ``most`` bytes, or fewer if the session says so."""
    return settings(spark, {_SCANS: str(min(_scan_bytes(spark), most))})


def _scan_bytes(spark: SparkSession) -> int:
    return spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()


def sized_for(spark: SparkSession, records: int) -> SparkSession:
    """A session to work on so many records: ``spark`` if its shuffle partitions suffice, else a new one of the same
    context, catalog and settings that has more of them and reads files in smaller tasks.

    A DataFrame that runs later is planned by the settings of its session then, so they can't be lent for a while
    (``settings``); and the user's own session keeps its settings. Adaptive execution joins partitions that are small.
    """
    wanted = -(-records // RECORDS_PER_TASK)
    if wanted <= int(spark.conf.get(_SHUFFLES)):
        return spark
    scratch_root(spark)
    sized = spark.newSession()
    for k, v in spark.conf.getAll.items():
        if sized.conf.isModifiable(k):
            sized.conf.set(k, v)
    sized.conf.set(_SHUFFLES, str(wanted))
    sized.conf.set(_SCANS, str(min(_scan_bytes(spark), SCAN_BYTES)))
    return sized


def scratch_root(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session.

    Read from the session; only a local session without one gets a temporary folder.
    """
    current = spark.conf.get(_CHECKPOINT_KEY, None)
    if not current:
        current = spark.sparkContext.getCheckpointDir()
    if not current:
        if not spark.sparkContext.master.startswith("local"):
            # a machine-local folder is not visible to the executors of a cluster
            raise RuntimeError("set spark.checkpoint.dir to a folder on shared storage")
        current = tempfile.mkdtemp(prefix="gavlake-ckpt-")
        spark.conf.set(_CHECKPOINT_KEY, current)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(current)
    return current.rstrip("/")


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh, never reused folder below the shared checkpoint folder."""
    return "/".join([scratch_root(spark), "gavlake", *parts, uuid.uuid4().hex])


def written_once(df: DataFrame, *parts: str) -> tuple[DataFrame, str]:
    """``df`` written below the shared folder and read back, and its folder (see ``remove``)."""
    path = scratch_path(df.sparkSession, *parts)
    with observed_writes(df.sparkSession):
        df.write.parquet(path, compression="zstd")
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def files_exceed(df: DataFrame, limit: int, suffix: str = "") -> bool:
    """Whether the files that ``df`` is read from have more than ``limit`` bytes in all; no if it is not read from
    files, or they are not known (a stream's batch), or the name of one does not end in ``suffix``."""
    spark, total, files = df.sparkSession, 0, df.inputFiles()
    if not all(file.endswith(suffix) for file in files):
        return False
    for file in files:
        path = spark._jvm.org.apache.hadoop.fs.Path(file)
        total += path.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(path).getLen()
        if total > limit:
            return True
    return False


def remove(spark: SparkSession, *paths: str) -> None:
    """Delete scratch folders that no later step reads."""
    for path in paths:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
