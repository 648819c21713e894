"""Maintained roll-ups: ``g`` and ``ga`` kept up to date from increments of ``gav`` (AGG-1/2).

A distinct count cannot be added to another one, so beside each roll-up there is the set that
it counts: the distinct versions of each key with their major version. An increment's
versions that the set lacks are added to it, and they are what the counters grow by; maxima
are merged. Rows are laid out in parts by a hash of the group, so an increment opens only the
parts of its own groups; within a part the work is distributed by version, so a hot group
is no hot task. The set's folders are only added to; the parts of the (small) roll-ups are replaced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import G, GA
from ..sinks.tables import PART, TableStore
from .derived import with_group_prefixes
from .records import conform

# Parts of the roll-ups and their sets: the driver handles numbers of parts, never keys.
PARTS = 64
KEYS = {"g": ["group_id"], "ga": ["group_id", "artifact_id"]}
SCHEMAS = {"g": G, "ga": GA}
COUNTERS = ("artifact_version_counter", "major_version_counter", "version_seq_max", "last_modified_max")


def part_of(group: str = "group_id", parts: int = PARTS) -> F.Column:
    return F.pmod(F.xxhash64(group), F.lit(parts)).cast(T.IntegerType())


def with_part(df: DataFrame) -> DataFrame:
    return df.withColumn(PART, part_of())


def version_set(gav: DataFrame, keys: list[str]) -> DataFrame:
    """The distinct versions of each key, with their major version (which depends on the version alone)."""
    return gav.where("artifact_version is not null").select(*keys, "artifact_version", "major_version").distinct()


def touched_parts(delta: DataFrame) -> list[int]:
    """Parts that the groups of ``delta`` belong to, at most ``PARTS`` numbers."""
    return sorted(r[0] for r in delta.select(part_of()).distinct().collect())


def _lacking(rows: DataFrame, known: DataFrame, columns: list[str]) -> DataFrame:
    """Rows whose ``columns`` (null equals null) are not in ``known``."""
    k = known.select(*[F.col(c).alias(f"_k_{c}") for c in columns])
    same = [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in columns]
    cond = same[0]
    for s in same[1:]:
        cond = cond & s
    return rows.join(k, cond, "left_anti")


def add_to_rollup(delta: DataFrame, store: TableStore, name: str, parts: list[int]
                  ) -> tuple[dict[str, dict], int]:
    """Changes that bring the roll-up ``name`` and its set up to date with the new files ``delta``, and the
    number of rows that the replaced parts hold.

    One union of what the counters grow by, of the new files' maxima and of the parts as they are,
    then one aggregation by key: nulls group as everywhere, and a new key needs no case of its own.
    """
    keys, versions = KEYS[name], f"{name}_versions"
    known = store.table(versions, parts)
    fresh = _lacking(version_set(delta, keys), known, [*keys, "artifact_version"])
    set_change, _ = store.write_parts(with_part(fresh), versions, "add", [*keys, "artifact_version"])
    added = store.written(set_change)
    majors = _lacking(added.where("major_version is not null").select(*keys, "major_version").distinct(),
                      known, [*keys, "major_version"])
    none = {"v": F.lit(0), "m": F.lit(0), "s": F.lit(None).cast("long"), "d": F.lit(None).cast("date")}

    def part_rows(df: DataFrame, **given) -> DataFrame:
        return df.select(*keys, *[(given.get(c, none[c])).alias(c) for c in none])

    grown = (part_rows(added, v=F.lit(1))
             .unionByName(part_rows(majors, m=F.lit(1)))
             .unionByName(part_rows(delta, s=F.col("version_seq"), d=F.to_date("last_modified")))
             .unionByName(part_rows(store.table(name, parts), **dict(zip(none, map(F.col, COUNTERS), strict=True))))
             .groupBy(*keys).agg(F.sum("v").alias(COUNTERS[0]), F.sum("m").alias(COUNTERS[1]),
                                 F.max("s").alias(COUNTERS[2]), F.max("d").alias(COUNTERS[3])))
    rollup = conform(with_group_prefixes(grown) if name == "g" else grown, SCHEMAS[name])
    change, rows = store.write_parts(with_part(rollup), name, "parts", keys)
    return {versions: set_change, name: change}, rows
