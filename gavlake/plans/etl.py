"""End-to-end plans: index load (raw index -> ``artifactinfo``) and derived-table
refresh (``artifactinfo`` -> ``gav`` -> ``g``, ``ga``), lazily as DataFrames or
executed into a ``TableStore`` with one audit row per step (PRJ-22)."""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.by_date import NAME, write_by_date
from ..operators.derived import by_coordinate, flatten_gav, group_artifact_rollup, group_rollup
from ..operators.quality import enforce_limits, with_reject_flag
from ..operators.records import (
    KEY,
    MAX_LOOKUP_KEYS,
    artifactinfo_from_records,
    at_positions,
    batch_is_small,
    conform,
    first_positions,
    first_wins_dedup,
    new_records,
    stored_among,
    to_artifactinfo,
    with_content_key,
)
from ..operators.rollup_state import KEYS, add_to_rollup, touched_parts, version_set, with_part
from ..schemas import ARTIFACTINFO
from ..session import SCAN_BYTES, files_exceed, remove, scans_of, written_once
from ..sinks.tables import TableStore
from ..sources.index import CORRUPT, DROP_REASONS, live_records

# Bytes of input files above which a batch is counted before it is loaded into a filled store.
COUNTED_FIRST_BYTES = 64 << 20
# Bytes of input files that a task of a load reads at most. The dedup sorts whole records before their exchange, and
# as rows they take many times their bytes in a compressed file: what a task sorts must fit its memory, or it is spilled.
LOAD_SCAN_BYTES = SCAN_BYTES

AUDIT_SCHEMA = T.StructType([
    T.StructField("step", T.StringType(), False),
    T.StructField("table_name", T.StringType(), False),
    T.StructField("rows_written", T.LongType(), True),
    T.StructField("rows_dropped", T.LongType(), True),
    T.StructField("seconds", T.DoubleType(), True),
])


@dataclass
class Tables:
    artifactinfo: DataFrame
    gav: DataFrame
    g: DataFrame
    ga: DataFrame


def load_plan(raw: DataFrame, store_keys: DataFrame | None = None, fix_signature: bool = False,
              observation: Observation | None = None, by_key: bool = False) -> DataFrame:
    """Raw index -> new ``artifactinfo`` rows (lazy, apart from the batch-size check and the first pass over
    a large index).

    Of a large index the keys and positions are read first, and the records then filtered where they are
    (``first_positions``). With ``by_key`` they are shuffled by key at any size: a filter on the key, of a lookup, goes
    below that. Neither the size check nor the first pass has the observation, so the observed counts
    always come from the real load.
    """
    if not by_key and reads_twice(raw):
        marked = first_positions(with_content_key(live_records(raw)), () if store_keys is None else (store_keys,))
        if marked:
            first = at_positions(with_content_key(live_records(raw, observation)), marked[0])
            return conform(to_artifactinfo(first, fix_signature), ARTIFACTINFO)
    small = batch_is_small(live_records(raw)) if store_keys is not None else None
    return artifactinfo_from_records(live_records(raw, observation), store_keys,
                                     fix_signature=fix_signature, small_batch=small)


def reads_twice(raw: DataFrame) -> bool:
    """Whether an index is so large that its keys are read apart from its records: those of Parquet files only, of
    which the columns that are read do not change what they hold (as they may of JSON lines)."""
    return CORRUPT not in raw.columns and files_exceed(raw, COUNTED_FIRST_BYTES, ".parquet")


def derive_plan(artifactinfo: DataFrame) -> Tables:
    """``artifactinfo`` -> all derived tables (lazy)."""
    gav = flatten_gav(artifactinfo)
    return Tables(artifactinfo, gav, group_rollup(gav), group_artifact_rollup(gav))


def full_plan(raw: DataFrame, fix_signature: bool = False, by_key: bool = False) -> Tables:
    return derive_plan(load_plan(raw, fix_signature=fix_signature, by_key=by_key))


@dataclass
class Loaded:
    """A load that is written but not committed."""
    changes: dict[str, dict]
    written: int
    rejected: int
    scan: dict[str, int]
    seconds: float

    @property
    def dropped(self) -> int:
        return sum(self.scan.get(k, 0) for k in DROP_REASONS)

    def audit(self) -> list[tuple]:
        rows = [("load", "artifactinfo", self.written, self.dropped, self.seconds)]
        if "artifactinfo_rejects" in self.changes:
            rows.append(("load", "artifactinfo_rejects", self.rejected, 0, 0.0))
        return rows


def write_load(raw: DataFrame, store: TableStore, fix_signature: bool = False, limits: str = "off",
               columnar: bool = False) -> Loaded:
    """Write the new records of ``raw`` to folders that no table has yet.

    ``raw`` is scanned once, but for a large one (below). Against a filled store the deduplicated batch is written to the
    shared folder first: the size check, the keys that filter the store and the rows are all
    read from there. The keys of a tiny batch are looked up as literals; those of a small one are
    broadcast to a scan of the store's keys; beyond that both sides are joined by bucket. Only a batch that reads
    large files is counted beforehand. One with more documents than keys are ever broadcast is not copied: of Parquet
    files the keys and positions are read first and joined by bucket, and only new records are shuffled, once, for the
    write; of others the exchange of the dedup is the join's and the write's as well. ``columnar`` says that a batch whose
    files are not known, of a stream, is read from Parquet files. ``limits``: what happens to records that break a declared limit of
    ``artifactinfo``: "fail" stops, "quarantine" puts them into ``artifactinfo_rejects`` (each
    key once), "off" stores them.
    """
    if limits not in ("fail", "quarantine", "off"):
        raise ValueError(f"limits must be fail, quarantine or off, not {limits!r}")
    with scans_of(raw.sparkSession, LOAD_SCAN_BYTES):
        return _write_load(raw, store, fix_signature, limits, columnar)


def _write_load(raw: DataFrame, store: TableStore, fix_signature: bool, limits: str, columnar: bool) -> Loaded:
    obs = Observation("scan")
    t0 = time.time()
    live = with_content_key(live_records(raw, obs))
    first, marked = first_wins_dedup(live), None
    scratch, keyed = [], True
    if store.exists("artifactinfo"):
        twice = reads_twice(raw) or columnar and CORRUPT not in raw.columns
        large = (twice or files_exceed(raw, COUNTED_FIRST_BYTES)) and not batch_is_small(raw)  # documents bound the keys
        if large and twice:
            refused = store.exists("artifactinfo_rejects") and limits == "quarantine"
            marked = first_positions(live, (store.keys(), *([store.keys("artifactinfo_rejects")] if refused else [])))
        if not large:
            batch, path = written_once(first, "batch")
            scratch.append(path)
        if marked:
            first, keyed = at_positions(live, marked[0]), False
            scratch.append(marked[1])
        elif large:
            first = new_records(first, store.keys())
        elif batch_is_small(batch, MAX_LOOKUP_KEYS):
            known = stored_among(store.keys(), [bytes(r[0]) for r in batch.select(KEY).collect()])
            first = batch.filter(~F.col(KEY).isin([F.lit(bytearray(k)) for k in known])) if known else batch
            keyed = False
        else:
            keyed = not batch_is_small(batch)
            first = new_records(batch, store.keys(), small_batch=not keyed, batch_keys=batch)
        if not marked and limits == "quarantine" and store.exists("artifactinfo_rejects"):
            first = first.join(store.keys("artifactinfo_rejects"), "uinfo_md5", "left_anti")
    new = conform(to_artifactinfo(first, fix_signature), ARTIFACTINFO)
    mode = "add" if store.exists("artifactinfo") else "replace"
    rejected = 0
    if limits == "quarantine":
        changes, written, rejected = store.write_split(
            with_reject_flag(new, "artifactinfo", "rejected"), "rejected", "artifactinfo", "artifactinfo_rejects",
            mode, keyed)
    else:
        new = enforce_limits(new, "artifactinfo") if limits == "fail" else new
        change, written = store.write_version(new, "artifactinfo", mode, keyed)
        changes = {"artifactinfo": change}
    remove(raw.sparkSession, *scratch)
    if marked and written + rejected != marked[2]:
        raise RuntimeError(f"{marked[2]} new records were found, but {written + rejected} when they were read again")
    return Loaded(changes, written, rejected, obs.get, time.time() - t0)


def run_load(spark: SparkSession, raw: DataFrame, store: TableStore,
             fix_signature: bool = False, limits: str = "off",
             stream: tuple[str, int] | None = None) -> list[tuple]:
    """Append the new records of ``raw`` to ``artifactinfo`` (full load when empty).

    ``limits`` as in ``write_load``; records stored with "off" are reported or rejected by the
    refresh. ``stream``: (id, batch number) that the store notes with the records.
    """
    loaded = write_load(raw, store, fix_signature, limits)
    store.commit(loaded.changes, stream)
    return loaded.audit()


def _write_gav(gav_new: DataFrame, store: TableStore, limits: str, mode: str) -> tuple[dict[str, dict], int, int]:
    """(changes, rows written, rows rejected) of ``gav`` under a limit mode."""
    if limits == "quarantine":
        # one job, one JSON parse: the write is split by the reject flag
        return store.write_split(with_reject_flag(gav_new, "gav", "rejected"), "rejected", "gav", "gav_rejects", mode)
    if limits not in ("fail", "off"):
        raise ValueError(f"limits must be fail, quarantine or off, not {limits!r}")
    change, written = store.write_version(
        enforce_limits(gav_new, "gav") if limits == "fail" else gav_new, "gav", mode)
    return {"gav": change}, written, 0


def run_refresh(spark: SparkSession, store: TableStore, limits: str = "fail", maintain: bool = False,
                by_date: bool = False) -> list[tuple]:
    """Rebuild ``gav`` from ``artifactinfo``, then ``g`` and ``ga`` from the new ``gav``.

    All three are written first and swapped together, so a failure in any of them leaves
    all old tables as they were. ``limits`` handles rows breaking a declared column limit
    (QLT-1): ``"fail"`` stops the refresh (like the reference, whose insert fails on too
    long data), ``"quarantine"`` writes them to ``gav_rejects`` and keeps them out of
    ``gav``, ``"off"`` skips the check. Row counts come from the write jobs themselves.
    With ``maintain`` the roll-ups' state is written too, for ``run_increment``; with ``by_date`` the
    copy of ``gav`` by time. A copy that is there already is kept up to date.
    """
    audit = []
    t0 = time.time()
    entries, written, rejected = _write_gav(flatten_gav(by_coordinate(store.table("artifactinfo"))), store, limits,
                                            "replace")
    audit.append(("refresh", "gav", written, rejected, time.time() - t0))
    gav = store.written(entries["gav"])  # not yet pointed to
    for name, build in (("g", group_rollup), ("ga", group_artifact_rollup)):
        t0 = time.time()
        if maintain:
            # in ranges, so that the versions of a hot group are written by several tasks
            entries[name], written = store.write_parts(with_part(build(gav)), name, "replace", KEYS[name])
            entries[f"{name}_versions"], _ = store.write_parts(
                with_part(version_set(gav, KEYS[name])), f"{name}_versions", "replace",
                [*KEYS[name], "artifact_version"])
        else:
            entries[name], written = store.write_version(build(gav), name)
            if store.exists(f"{name}_versions"):
                entries[f"{name}_versions"] = None  # the state of roll-ups that are gone
        audit.append(("refresh", name, written, 0, time.time() - t0))
    if by_date or store.exists(NAME):
        t0 = time.time()
        entries[NAME], written = write_by_date(gav, store, "replace")
        audit.append(("refresh", NAME, written, 0, time.time() - t0))
    store.commit(entries, derived=True)
    return audit


def run_increment(spark: SparkSession, raw: DataFrame, store: TableStore, limits: str = "quarantine",
                  fix_signature: bool = False, stream: tuple[str, int] | None = None) -> list[tuple]:
    """Load ``raw`` and bring ``gav``, ``g`` and ``ga`` up to date with it."""
    return commit_increment(spark, store, write_load(raw, store, fix_signature, limits), limits, stream)


def commit_increment(spark: SparkSession, store: TableStore, loaded: Loaded, limits: str = "quarantine",
                     stream: tuple[str, int] | None = None) -> list[tuple]:
    """Derive from a written load what the derived tables lack, and commit all of it.

    Everything becomes visible by one move of the pointer, which also notes ``stream``. Without
    maintained roll-ups (a first run) they are built from all records. Afterwards
    a step reads the records that ``gav`` lacks and, of the roll-ups and their sets, the parts that
    the new files' groups belong to.
    """
    audit = loaded.audit()
    if not (store.exists("g_versions") and store.exists("ga_versions")):
        store.commit(loaded.changes)
        audit += run_refresh(spark, store, limits, maintain=True)
        if stream:
            store.commit({}, stream, derived=True)
        return audit
    changes = dict(loaded.changes)
    t0 = time.time()
    folders = store.folders("artifactinfo", after=store.derived_until())
    folders += [f["path"] for f in changes["artifactinfo"]["folders"]]
    lacking = spark.read.schema(ARTIFACTINFO).parquet(*folders)
    gav_changes, written, rejected = _write_gav(flatten_gav(by_coordinate(lacking)), store, limits, "add")
    changes |= gav_changes
    audit.append(("increment", "gav", written, rejected, time.time() - t0))
    delta = store.written(gav_changes["gav"])
    parts = touched_parts(delta)
    for name in ("g", "ga"):
        t0 = time.time()
        rollup_changes, rows = add_to_rollup(delta, store, name, parts)
        changes |= rollup_changes
        audit.append(("increment", name, rows, 0, time.time() - t0))
    if store.exists(NAME):
        t0 = time.time()
        changes[NAME], rows = write_by_date(delta, store, "add")
        audit.append(("increment", NAME, rows, 0, time.time() - t0))
    store.commit(changes, stream, derived=True)
    return audit


def run_all(spark: SparkSession, raw: DataFrame, store: TableStore,
            fix_signature: bool = False, limits: str = "fail", load_limits: str | None = None) -> DataFrame:
    """Load then refresh; returns the audit as a DataFrame (one row per step).

    ``load_limits``: limit mode of the records themselves; without it they are checked by the load
    only if ``limits`` is "fail", else by the refresh.
    """
    audit = run_load(spark, raw, store, fix_signature, load_limits or ("fail" if limits == "fail" else "off"))
    audit += run_refresh(spark, store, limits)
    return spark.createDataFrame(audit, AUDIT_SCHEMA)
