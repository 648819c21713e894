"""Analysis queries over the stored tables (AGG-3..8, DIST-2, FLT-1..3/6..8, JOIN-5/6,
LIM-1, PRJ-19..21)."""

from __future__ import annotations

import datetime as dt
import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import byte_length, group_prefix, key_hex
from ..schemas import DEFAULT_EXTENSIONS, SHA1_MAX_LEN
from .json_docs import json_rows_lateral  # noqa: F401  (one of the analysis queries)
from .views import extension_filter


def one_year_before(as_of: dt.datetime | dt.date | str) -> dt.datetime:
    """``as_of - INTERVAL 1 YEAR`` (29 February goes to 28 February)."""
    if isinstance(as_of, str):
        as_of = dt.datetime.fromisoformat(as_of)
    if not isinstance(as_of, dt.datetime):
        as_of = dt.datetime(as_of.year, as_of.month, as_of.day)
    try:
        return as_of.replace(year=as_of.year - 1)
    except ValueError:
        return as_of.replace(year=as_of.year - 1, day=28)


def recent_within(df: DataFrame, as_of=None, col: str = "last_modified") -> DataFrame:
    """Rows modified in the year before ``as_of`` (default: now) (FLT-6).

    A fixed ``as_of`` becomes a literal bound that the Parquet scan can use.
    """
    if as_of is None:
        bound = F.current_timestamp().cast(T.TimestampNTZType()) - F.expr("INTERVAL 1 YEAR")
    else:
        # from ISO text: a string -> TIMESTAMP_NTZ cast does not depend on the session zone
        bound = F.lit(one_year_before(as_of).isoformat(sep=" ")).cast(T.TimestampNTZType())
    return df.filter(F.col(col) > bound)


def _revised(gav: DataFrame, keys: list[str], as_of, extensions) -> DataFrame:
    cand = gav.filter(F.col("classifier").isNull())
    cand = extension_filter(recent_within(cand, as_of), extensions)
    return (cand.groupBy(*keys).agg(F.count(F.lit(1)).alias("counter"))
            .orderBy(F.col("counter").desc(), *[F.col(k).asc() for k in keys]))


def most_revised_groups(gav: DataFrame, as_of=None, extensions=DEFAULT_EXTENSIONS) -> DataFrame:
    """Files per group over the last year, unclassified, allowed extensions (AGG-3)."""
    return _revised(gav, ["group_id"], as_of, extensions)


def most_revised_artifacts(gav: DataFrame, as_of=None, extensions=DEFAULT_EXTENSIONS) -> DataFrame:
    """Same per (group, artifact) (AGG-4)."""
    return _revised(gav, ["group_id", "artifact_id"], as_of, extensions)


def _count_by_prefix(ga: DataFrame, k: int, two_letter_only: bool = False) -> DataFrame:
    name = f"group_id_left{k}"
    pre = ga.select(group_prefix("group_id", k).alias(name))
    if two_letter_only:
        pre = pre.filter(byte_length(name) == 2)
    return (pre.groupBy(name).agg(F.count(F.lit(1)).alias("counter"))
            .orderBy(F.col("counter").desc(), F.col(name).asc()))


def artifacts_by_country(ga: DataFrame) -> DataFrame:
    """Artifacts per two-letter first prefix (AGG-5, FLT-7)."""
    return _count_by_prefix(ga, 1, two_letter_only=True)


def artifacts_by_org(ga: DataFrame) -> DataFrame:
    """Artifacts per two-part prefix (AGG-6)."""
    return _count_by_prefix(ga, 2)


def artifacts_by_top_level(ga: DataFrame) -> DataFrame:
    """Artifacts per first prefix, count desc then name (AGG-7)."""
    return _count_by_prefix(ga, 1)


def json_sha1(artifactinfo: DataFrame) -> F.Column:
    return F.get_json_object(F.col("json"), "$.sha1")


def max_checksum_length(artifactinfo: DataFrame) -> DataFrame:
    """Longest checksum in bytes, read from the JSON (AGG-8)."""
    return artifactinfo.agg(
        F.max(byte_length(json_sha1(artifactinfo))).cast(T.IntegerType()).alias("max_sha1_length"))


def bad_checksums(artifactinfo: DataFrame) -> DataFrame:
    """Records whose checksum is longer than 40 bytes, with the upper-case hex key (FLT-8)."""
    return artifactinfo.filter(byte_length(json_sha1(artifactinfo)) > SHA1_MAX_LEN).select(
        "*", key_hex("uinfo_md5", upper=True).alias("uinfo_md5_hex"))


def find_by_key(artifactinfo: DataFrame, key: bytes | str) -> DataFrame:
    """Point lookup by the content key itself: 16 bytes, or their hex form (FLT-1).

    On the bucketed table the equality selects one bucket.
    """
    raw = bytes.fromhex(key) if isinstance(key, str) else bytes(key)
    return artifactinfo.filter(F.col("uinfo_md5") == F.lit(bytearray(raw)))


def find_by_md5(artifactinfo: DataFrame, uinfo: str) -> DataFrame:
    """Point lookup by the content key of a coordinate string (FLT-1)."""
    return find_by_key(artifactinfo, hashlib.md5(uinfo.encode()).digest())


def find_by_major_version(artifactinfo: DataFrame, major: int) -> DataFrame:
    """Equality on the major version (FLT-2)."""
    return artifactinfo.filter(F.col("major_version") == F.lit(major))


def records(table: DataFrame, eq: dict[str, object] | None = None, size: int = 10,
            page: int = 1, order: str = "uinfo_md5") -> DataFrame:
    """A page of rows matching a conjunction of equality filters (FLT-3, LIM-1).

    The filters reach the Parquet scan; the page is a top-k on ``order`` (a total
    order, so pages are stable), planned as TakeOrderedAndProject.
    """
    cond = F.lit(True)
    for col, value in (eq or {}).items():
        cond = cond & (F.col(col) == F.lit(value))
    ordered = table.filter(cond).orderBy(order)
    if page > 1:
        ordered = ordered.offset((page - 1) * size)
    return ordered.limit(size)


def coordinate_lookup(gav: DataFrame, group_id: str, artifact_id: str, size: int = 10,
                      page: int = 1) -> DataFrame:
    """A page of files of one artifact, ordered by key (FLT-3, LIM-1)."""
    return records(gav, {"group_id": group_id, "artifact_id": artifact_id}, size, page)


def page_after(table: DataFrame, order: list[str], size: int = 10, after: tuple | None = None,
               eq: dict[str, object] | None = None) -> DataFrame:
    """The ``size`` rows that follow the cursor ``after`` in the order of the columns ``order``, which
    must be total and without nulls (LIM-1, FLT-3).

    The cursor is the last row's values of ``order`` (see ``cursor``), none for the first page. It is a
    filter on the first column and a finer one on the rest, both of literals, so the scan
    skips what lies before it; rows of earlier pages are neither sorted nor counted, as an OFFSET
    would have them. Pages tile the result, and rows that arrive meanwhile shift none of them.
    """
    rows = table
    for col, value in (eq or {}).items():
        rows = rows.filter(F.col(col) == F.lit(value))
    if after is not None:
        if len(after) != len(order):
            raise ValueError(f"the cursor has {len(after)} values, the order {len(order)} columns")
        values = [F.lit(bytearray(v) if isinstance(v, bytes) else v) for v in after]
        beyond = F.lit(False)
        for c, v in reversed(list(zip(order, values, strict=True))):
            beyond = (F.col(c) > v) | ((F.col(c) == v) & beyond)
        rows = rows.filter(F.col(order[0]) >= values[0]).filter(beyond)
    return rows.orderBy(*order).limit(size)


def cursor(page: DataFrame, order: list[str]) -> tuple | None:
    """The cursor behind a page (its rows are collected: a page is small); None if it is empty."""
    rows = page.select(*order).collect()
    return max((tuple(bytes(v) if isinstance(v, bytearray) else v for v in r) for r in rows), default=None)


def hex_keys(artifactinfo: DataFrame) -> DataFrame:
    """All stored columns and ``HEX(uinfo_md5)`` (PRJ-19)."""
    return artifactinfo.select("*", key_hex("uinfo_md5", upper=True).alias("uinfo_md5_hex"))


def json_keys(artifactinfo: DataFrame, limit: int | None = 100) -> DataFrame:
    """Top-level keys of each JSON record, first ``limit`` records by key (PRJ-21, LIM-1).

    The top-k comes first, so keys are read from ``limit`` documents only.
    """
    rows = artifactinfo.select("uinfo_md5", "json")
    if limit is not None:
        rows = rows.orderBy("uinfo_md5").limit(limit)
    return rows.select("uinfo_md5", F.json_object_keys("json").alias("json_keys"))


def json_key_lateral(artifactinfo: DataFrame) -> DataFrame:
    """One row per (record, top-level key) (JOIN-5)."""
    return artifactinfo.select(
        "uinfo_md5", F.explode(F.json_object_keys("json")).alias("json_key"))


def distinct_json_keys(artifactinfo: DataFrame) -> DataFrame:
    """All top-level keys over all records, sorted (DIST-2).

    Partial aggregation runs before the shuffle, so each task forwards only its
    distinct keys.
    """
    return json_key_lateral(artifactinfo).select("json_key").distinct().orderBy("json_key")
