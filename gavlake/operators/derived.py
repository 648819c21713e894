"""Derived tables: ``gav`` (flattened records, PRJ-11..14) and the roll-ups ``g`` / ``ga``
(AGG-1/2, PRJ-15)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import epoch_ms_to_datetime, fix_extension, group_prefix, sha1_prefix
from ..schemas import EXTENSION_FIXES, G, GA, GAV, GAV_JSON_READ
from .records import conform


def by_coordinate(artifactinfo: DataFrame) -> DataFrame:
    """Rows range-partitioned by the coordinate string, which begins with group and artifact.

    Files of ``gav`` then hold narrow ranges of coordinates, a hot group spreads over
    several of them, and lookups skip the others by their statistics. The range
    partitioner samples the stored rows, before the JSON parse.
    """
    return artifactinfo.repartitionByRange("uinfo")


def flatten_gav(artifactinfo: DataFrame, fixes=EXTENSION_FIXES) -> DataFrame:
    """``artifactinfo`` -> ``gav``: parse the JSON once (only the fields ``gav`` uses),
    take typed fields, apply fixes.

    Numbers are read as text and converted with ``try_cast`` so that quoted numbers are
    accepted; a value that is not a number becomes NULL instead of failing the job.
    """
    # exploded from an array of one: a filter on the fields stays above it, where it reads the parsed
    # fields; below, it would repeat the parse for each of them
    parsed = artifactinfo.select("*", F.explode(F.array(F.from_json("json", GAV_JSON_READ))).alias("_r"))
    r = lambda f: F.col(f"_r.{f}")
    out = parsed.select(
        "uinfo_md5", "uinfo_length", "uinfo",
        r("groupId").alias("group_id"),
        r("artifactId").alias("artifact_id"),
        r("version").alias("artifact_version"),
        "major_version", "version_seq",
        epoch_ms_to_datetime(r("lastModified").try_cast(T.LongType())).alias("last_modified"),
        r("size").try_cast(T.LongType()).alias("size"),
        sha1_prefix(r("sha1")).alias("sha1"),
        "signature_exists", "sources_exists", "javadoc_exists",
        r("classifier").alias("classifier"),
        "classifier_length",
        fix_extension(r("groupId"), r("artifactId"), r("fileExtension"), fixes).alias("file_extension"),
        r("packaging").alias("packaging"),
        r("name").alias("name"),
        r("description").alias("description"),
    )
    return conform(out, GAV)


def _rollup_aggs():
    return [
        F.count_distinct("artifact_version").cast(T.IntegerType()).alias("artifact_version_counter"),
        F.count_distinct("major_version").cast(T.IntegerType()).alias("major_version_counter"),
        F.max("version_seq").alias("version_seq_max"),
        F.to_date(F.max("last_modified")).alias("last_modified_max"),
    ]


def with_group_prefixes(df: DataFrame, col: str = "group_id") -> DataFrame:
    return df.select("*", *[group_prefix(col, k).alias(f"group_id_left{k}") for k in range(1, 5)])


def group_artifact_rollup(gav: DataFrame) -> DataFrame:
    """``ga``: per (group, artifact) distinct versions, distinct majors, max key, max date.

    The two distinct counts plan as Expand + aggregation keyed on (group, artifact,
    distinct value) with map-side partial aggregation, then a second aggregation keyed
    on (group, artifact): a hot artifact is spread over tasks in the first step and
    reduced map-side before the second.
    """
    return conform(gav.groupBy("group_id", "artifact_id").agg(*_rollup_aggs()), GA)


def group_rollup(gav: DataFrame) -> DataFrame:
    """``g``: the same counters per group, plus the four group prefixes."""
    return conform(with_group_prefixes(gav.groupBy("group_id").agg(*_rollup_aggs())), G)
