"""Index scan (SRC-1) and live-record filter (SRC-2)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import RAW_INDEX

# Column that holds the text of a document that does not decode (null for the others).
CORRUPT = "_corrupt_record"
RAW_INDEX_CHECKED = T.StructType([*RAW_INDEX.fields, T.StructField(CORRUPT, T.StringType(), True)])
# Why a document gives no record, apart: it does not decode, it was deleted, it is no artifact.
DROP_REASONS = ("corrupt", "deleted", "not_artifact")


def read_index(spark: SparkSession, path: str, fmt: str = "parquet", keep_corrupt: bool = False) -> DataFrame:
    """Read decoded index documents with the declared schema (no inference).

    From JSON lines, ``keep_corrupt`` adds the column ``_corrupt_record``: the line, where it is not a
    JSON object or a field has not its declared type. (Without it such a line reads as nulls.)
    """
    if fmt == "json":
        reader = spark.read.schema(RAW_INDEX_CHECKED if keep_corrupt else RAW_INDEX)
        return reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).json(path)
    return spark.read.schema(RAW_INDEX).format(fmt).load(path)


def drop_reason(columns: list[str]) -> F.Column:
    """Why a document gives no record: one of ``DROP_REASONS``, or null for a live artifact.

    A missing flag counts as false.
    """
    reason = (F.when(~F.col("is_live").eqNullSafe(True), F.lit("deleted"))
              .when(~F.col("is_artifact").eqNullSafe(True), F.lit("not_artifact")))
    if CORRUPT in columns:
        reason = F.when(F.col(CORRUPT).isNotNull(), F.lit("corrupt")).otherwise(reason)
    return reason


def live_records(raw: DataFrame, observation: Observation | None = None) -> DataFrame:
    """Keep documents that are live and decode to an artifact.

    With an ``Observation`` the dropped counts are collected as a side effect of the
    job that consumes the result (no extra pass): ``corrupt`` (of an index read with
    ``keep_corrupt``; 0 else), ``deleted`` and ``not_artifact``.
    """
    # a missing flag counts as false, in the filter and in the drop counts alike; the
    # null-safe equality is still pushed to the Parquet scan
    live = F.col("is_live").eqNullSafe(True)
    artifact = F.col("is_artifact").eqNullSafe(True)
    checked = CORRUPT in raw.columns
    if observation is not None:
        reason = drop_reason(raw.columns)
        raw = raw.observe(
            observation,
            F.count(F.lit(1)).alias("scanned"),
            *[F.count_if(reason.eqNullSafe(r)).alias(r) for r in DROP_REASONS],
        )
    if checked:
        return raw.filter(F.col(CORRUPT).isNull() & live & artifact).drop(CORRUPT)
    return raw.filter(live & artifact)


def corrupt_lines(raw: DataFrame) -> DataFrame:
    """(line, read_as) of the documents that do not decode, of an index read with ``keep_corrupt``:
    the text, and what could be read of it (JSON).

    All fields are referred to, so none is pruned from the scan and a line counts as corrupt here as
    it does in a load.
    """
    fields = [F.col(f.name) for f in RAW_INDEX.fields]
    return raw.filter(F.col(CORRUPT).isNotNull()).select(
        F.col(CORRUPT).alias("line"), F.to_json(F.struct(*fields)).alias("read_as"))
