"""Table sinks (SNK-1..4).

Tables are catalog tables over Parquet folders below a root folder. The root holds one
small pointer file that names the current folders of every table, so a store is opened by
its root alone: another object, another session or another program on the same root sees
the same tables.

* ``append`` writes the rows of one DataFrame to a folder of their own with a single job and
  then adds that folder to the table by moving the pointer; what a killed job left behind is in
  no table;
* ``overwrite`` writes the new content to a fresh folder and only then moves the pointer,
  so a failed refresh leaves the old content readable instead of an empty table;
* ``write_parts`` writes rows by the number in a column, so that a later write can replace or
  extend some numbers and leave the others' folders alone;
* ``commit`` moves the pointer for several tables at once, and notes with them which batch of which
  stream they hold: a batch that comes again is known without reading any table;
* ``declare`` creates empty tables with the declared schemas.

In the catalog each folder is a partition by the number of the commit that added it (and
the part), columns that ``table`` leaves out.

Layout: ``artifactinfo`` is bucketed by its key, so a key lookup reads one bucket and the
skip-if-stored join needs no shuffle of the store; the other tables are sorted within
files, so that Parquet statistics let lookups skip row groups. One writer per store is
assumed.
"""

from __future__ import annotations

import hashlib
import json
import re
import time
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import TABLES, column_type
from ..session import observed_writes, settings

# Sort columns within written files, per table.
SORT_COLUMNS = {
    # the dedup already yields key order within partitions, so this sort is free
    "artifactinfo": ("uinfo_md5",),
    "gav": ("group_id", "artifact_id", "artifact_version"),
    "g": ("group_id",),
    "ga": ("group_id", "artifact_id"),
    "g_versions": ("group_id", "artifact_version"),
    "ga_versions": ("group_id", "artifact_id", "artifact_version"),
    "gav_by_date": ("last_modified", "uinfo_md5"),
}
# Tables that are bucketed, and by which column.
BUCKET_COLUMN = {"artifactinfo": "uinfo_md5"}
# Partition columns of the catalog tables: number of the commit, and part.
BATCH, PART = "_batch", "_part"
_SHUFFLES = "spark.sql.shuffle.partitions"
# Checksums and keys hardly compress, the text around them does.
CODEC = "zstd"


class TableStore:
    """Named tables under ``root``; the catalog database is named after the root.

    ``buckets`` is the bucket count of a bucketed table when it is created (default: the
    session's shuffle partitions, so the dedup's partitions are the buckets).
    """

    def __init__(self, spark: SparkSession, root: str, database: str | None = None,
                 max_records_per_file: int | None = None, buckets: int | None = None):
        self.spark = spark
        if "'" in root:
            raise ValueError(f"quote in store path {root!r}")
        self.root = root.rstrip("/")
        self.database = database or "gavlake_" + hashlib.md5(self.root.encode()).hexdigest()[:16]
        if not re.fullmatch(r"[A-Za-z_][A-Za-z0-9_]*", self.database):
            raise ValueError(f"bad database name {self.database!r}")
        self.max_records_per_file = max_records_per_file
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self._synced: dict[str, dict] = {}
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.database} LOCATION '{self.root}/_db'")
        self._sync()

    # -- the pointer: which folders hold each table -------------------------------
    def _pointer_files(self) -> list[str]:
        """Pointer files, oldest first."""
        fs, p = self._fs_path(f"{self.root}/_pointer")
        if not fs.exists(p):
            return []
        return sorted(st.getPath().toString() for st in fs.listStatus(p)
                      if st.getPath().getName().endswith(".json"))

    def read_text(self, path: str) -> str:
        fs, p = self._fs_path(path)
        stream = fs.open(p)
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def _pointer(self) -> dict:
        """``tables``: entry of each table; ``streams``: last batch of each stream; ``derived``:
        last commit whose records are in the derived tables; ``number``: of this commit."""
        files = self._pointer_files()
        if not files:
            return {"tables": {}, "streams": {}, "derived": -1, "number": -1}
        return json.loads(self.read_text(files[-1]))

    def commit(self, changes: dict[str, dict | None], stream: tuple[str, int] | None = None,
               derived: bool = False) -> None:
        """Move the pointer for all ``changes`` at once: a new file, visible by one rename.

        A change comes from a ``write_`` method; None removes the table. ``stream`` is the (id, batch
        number) that the changes hold, ``derived`` says that the derived tables now cover all records.
        """
        files = self._pointer_files()
        pointer = self._pointer()
        number = pointer["number"] + 1
        for name, change in changes.items():
            if change is None:
                pointer["tables"].pop(name, None)
                continue
            old = pointer["tables"].get(name, {}).get("folders", [])
            new = [f | {"batch": number} for f in change["folders"]]
            if change["mode"] == "replace":
                old = []
            elif change["mode"] == "parts":
                parts = {f["part"] for f in new}
                old = [f for f in old if f["part"] not in parts]
            pointer["tables"][name] = {k: change[k] for k in ("columns", "clustered", "parted")} | {"folders": old + new}
        if stream:
            pointer["streams"][stream[0]] = stream[1]
        pointer |= {"number": number, "derived": number if derived else pointer["derived"]}
        fs, tmp = self._fs_path(f"{self.root}/_pointer/_{uuid.uuid4().hex}")
        out = fs.create(tmp)
        out.write(bytearray(json.dumps(pointer).encode()))
        out.close()
        _, final = self._fs_path(f"{self.root}/_pointer/{number:012d}.json")
        if not fs.rename(tmp, final):
            raise RuntimeError(f"the pointer of {self.root} could not be moved")
        for old_file in files[:-2]:
            fs.delete(self._fs_path(old_file)[1], False)
        self._sync()

    def has_batch(self, stream: str, batch: int) -> bool:
        """Whether a batch of a stream is in the store, by the pointer alone."""
        return self._pointer()["streams"].get(stream, -1) >= batch

    def folders(self, name: str, after: int = -1) -> list[str]:
        """Folders of a table, of later commits than ``after`` only."""
        return [f["path"] for f in self._pointer()["tables"][name]["folders"] if f["batch"] > after]

    def derived_until(self) -> int:
        return self._pointer()["derived"]

    def _sync(self) -> dict[str, dict]:
        """Make the catalog's tables those of the pointer."""
        pointer = self._pointer()
        for name, entry in pointer["tables"].items():
            q = self.qualified(name)
            shape = hashlib.md5(json.dumps([entry[k] for k in ("columns", "clustered", "parted")]).encode()).hexdigest()
            known = self.spark.catalog.tableExists(q)
            if known and self._synced.get(name) == entry:
                continue
            if known and self._shape(q) != shape:
                self.spark.sql(f"DROP TABLE {q}")
                known = False
            if not known:
                by = f"{BATCH} INT" + (f", {PART} INT" if entry["parted"] else "")
                cut = f"{BATCH}, {PART}" if entry["parted"] else BATCH
                self.spark.sql(f"CREATE TABLE {q} ({entry['columns']}, {by}) USING parquet PARTITIONED BY ({cut}) "
                               f"{entry['clustered']} LOCATION '{self.root}/{name}' "
                               f"TBLPROPERTIES ('gavlake.shape' = '{shape}')")
            wanted = {f"{BATCH}={f['batch']}" + (f"/{PART}={f['part']}" if entry["parted"] else ""): f["path"]
                      for f in entry["folders"]}
            there = {r[0] for r in self.spark.sql(f"SHOW PARTITIONS {q}").collect()}
            spec = lambda s: f"PARTITION ({s.replace('/', ', ')})"
            if new := sorted(wanted.keys() - there):
                self.spark.sql(f"ALTER TABLE {q} ADD IF NOT EXISTS "
                               + " ".join(f"{spec(s)} LOCATION '{wanted[s]}'" for s in new))
            if gone := sorted(there - wanted.keys()):
                self.spark.sql(f"ALTER TABLE {q} DROP IF EXISTS " + ", ".join(map(spec, gone)))
            self._synced[name] = entry
        return pointer["tables"]

    def _shape(self, q: str) -> str | None:
        rows = self.spark.sql(f"SHOW TBLPROPERTIES {q}").collect()
        return next((r.value for r in rows if r.key == "gavlake.shape"), None)

    def _change(self, name: str, mode: str, schema: T.StructType, folders: list[dict], parted: bool = False) -> dict:
        fields = [f for f in schema.fields if f.name != PART]
        columns = ", ".join(f"`{f.name}` {column_type(name, f)}" for f in fields)
        read_as = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
        clustered = ""
        if name in BUCKET_COLUMN:
            # the bucket count stays that of the table's creation
            key, known = BUCKET_COLUMN[name], self._pointer()["tables"].get(name, {}).get("clustered")
            clustered = known or f"CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {self.buckets} BUCKETS"
        return {"mode": mode, "columns": columns, "read_as": read_as, "clustered": clustered, "parted": parted,
                "folders": folders}

    # -- naming -----------------------------------------------------------------
    def qualified(self, name: str) -> str:
        return f"{self.database}.{name}"

    def exists(self, name: str) -> bool:
        return name in self._sync()

    def table(self, name: str, parts: Iterable[int] | None = None) -> DataFrame:
        """The table, or ``parts`` of it (other parts' folders are not opened)."""
        self._sync()
        df = self.spark.table(self.qualified(name))
        if parts is not None:
            df = df.where(F.col(PART).isin(list(parts)))
        return df.drop(BATCH, PART)

    def keys(self, name: str = "artifactinfo", key: str = "uinfo_md5") -> DataFrame | None:
        return self.table(name).select(key) if self.exists(name) else None

    def location(self, name: str) -> str:
        """The folder of a table that was written at once."""
        return self._sync()[name]["folders"][0]["path"]

    def written(self, change: dict) -> DataFrame:
        """The rows of a change that nothing points to yet."""
        schema = T.StructType.fromDDL(change["read_as"])
        paths = [f["path"] for f in change["folders"]]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    # -- writing ----------------------------------------------------------------
    def _writer(self, df: DataFrame, name: str):
        sort = [c for c in SORT_COLUMNS.get(name, ()) if c in df.columns]
        if sort and name not in BUCKET_COLUMN:
            df = df.sortWithinPartitions(*sort)
        w = df.write.format("parquet").option("compression", CODEC)
        if self.max_records_per_file:
            w = w.option("maxRecordsPerFile", self.max_records_per_file)
        return w

    def _new_folder(self, name: str) -> str:
        return f"{self.root}/{name}/v{int(time.time() * 1000):015d}_{uuid.uuid4().hex[:8]}"

    @staticmethod
    def _counted(df: DataFrame) -> tuple[DataFrame, Observation]:
        """Count the written rows as a side effect of the write job (no extra pass)."""
        obs = Observation()
        return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs

    def write_version(self, df: DataFrame, name: str, mode: str = "replace", keyed: bool = False) -> tuple[dict, int]:
        """Write ``df`` to a folder that nothing points to yet; returns (change for ``commit``, rows).

        ``mode``: "replace" the table, or "add" to it. ``keyed``: the rows come out of a shuffle by the
        table's bucket column, which is then given one partition a bucket.
        """
        path = self._new_folder(name)
        change = self._change(name, mode, df.schema, [{"path": path}])
        df, obs = self._counted(df)
        if change["clustered"]:
            self._write_buckets(df, name, change, path, keyed)
        else:
            with observed_writes(df.sparkSession):
                self._writer(df, name).mode("errorifexists").save(path)
        return change, int(obs.get.get("rows", 0))

    def _write_buckets(self, df: DataFrame, name: str, change: dict, path: str, keyed: bool,
                       flag: str | None = None) -> None:
        """One file a bucket (and value of ``flag``), whatever the session's shuffle partitions are.

        Bucketed files can only be written through a catalog table: a passing one over the
        folder, dropped again (it is external, the files stay).
        """
        key = BUCKET_COLUMN[name]
        count = int(re.search(r"INTO (\d+) BUCKETS", change["clustered"])[1])
        passing = self.qualified(f"{name}_{uuid.uuid4().hex[:8]}")
        by = f"PARTITIONED BY (`{flag}`)" if flag else ""
        flag_column = f", `{flag}` INT" if flag else ""
        # the key's Bloom filters answer lookups of keys that are not there; they grow to what a file needs
        blooms = (f"OPTIONS ('compression' = '{CODEC}', 'parquet.bloom.filter.enabled#{key}' = 'true', "
                  "'parquet.bloom.filter.adaptive.enabled' = 'true')")
        self.spark.sql(f"CREATE TABLE {passing} ({change['columns']}{flag_column}) USING parquet {blooms} {by} "
                       f"{change['clustered']} LOCATION '{path}'")
        try:
            with settings(df.sparkSession, {_SHUFFLES: str(count)}), observed_writes(df.sparkSession):
                w = self._writer(df if keyed else df.repartition(count, key), name)
                w = w.bucketBy(count, key).sortBy(key)
                (w.partitionBy(flag) if flag else w).mode("append").saveAsTable(passing)
        finally:
            self.spark.sql(f"DROP TABLE {passing}")

    def replace_all(self, changes: dict[str, dict]) -> None:
        """Point several tables at versions written before, all at once (SNK-2)."""
        self.commit(changes)

    def overwrite(self, df: DataFrame, name: str) -> int:
        """Write-then-swap replacement of the table's content (SNK-2); returns the rows."""
        change, rows = self.write_version(df, name)
        self.commit({name: change})
        return rows

    def write_split(self, df: DataFrame, flag: str, name_false: str, name_true: str, mode: str = "replace",
                    keyed: bool = False) -> tuple[dict[str, dict], int, int]:
        """New folders of two tables from one job: rows with ``flag`` false go to
        ``name_false``, true to ``name_true`` (one pass over ``df``, e.g. one JSON parse).

        The write is partitioned by the flag. Returns (changes, rows false, rows true).
        """
        path = self._new_folder(name_false)
        data_cols = [c for c in df.columns if c != flag]
        schema = df.select(*data_cols).schema
        obs = Observation()
        counted = df.observe(obs, F.count_if(~F.col(flag)).alias("n_false"),
                             F.count_if(F.col(flag)).alias("n_true"))
        counted = counted.select(*data_cols, F.when(F.col(flag), F.lit(1)).otherwise(F.lit(0)).alias(flag))
        changes = {name: self._change(name, mode, schema, [{"path": f"{path}/{flag}={k}"}])
                   for k, name in enumerate((name_false, name_true))}
        if name_false in BUCKET_COLUMN:
            self._write_buckets(counted, name_false, changes[name_false], path, keyed, flag)
        else:
            # flag first, so the writer's ordering on the partition column is already met
            sort = [flag] + [c for c in SORT_COLUMNS.get(name_false, ()) if c in data_cols]
            w = counted.sortWithinPartitions(*sort).write.format("parquet").option("compression", CODEC)
            if self.max_records_per_file:
                w = w.option("maxRecordsPerFile", self.max_records_per_file)
            with observed_writes(df.sparkSession):
                w.partitionBy(flag).mode("errorifexists").save(path)
        fs, _ = self._fs_path(path)
        for part in "01":  # a table needs its folder even if no row went there
            fs.mkdirs(self._fs_path(f"{path}/{flag}={part}")[1])
        m = obs.get
        return changes, int(m.get("n_false", 0)), int(m.get("n_true", 0))

    def write_parts(self, df: DataFrame, name: str, mode: str, ranges: list[str] | None = None) -> tuple[dict, int]:
        """Write ``df`` by its column ``_part``; ``mode``: "replace" the table, replace its "parts" that
        ``df`` has, or "add" to them.

        A part is written by one task, so it has one file; with ``ranges`` parts are cut into ranges of
        these columns, so that a hot part is spread over tasks and its files hold narrow ranges.
        """
        path = self._new_folder(name)
        sort = [PART] + (ranges or [c for c in SORT_COLUMNS.get(name, ()) if c in df.columns])
        # counted after the shuffle: ranges are found by a first pass over what comes before it
        dealt, obs = self._counted(df.repartitionByRange(PART, *ranges) if ranges else df.repartition(PART))
        with observed_writes(df.sparkSession):
            w = dealt.sortWithinPartitions(*sort).write.option("compression", CODEC)
            w.partitionBy(PART).mode("errorifexists").parquet(path)
        fs, p = self._fs_path(path)
        names = sorted(st.getPath().getName() for st in fs.listStatus(p) if st.isDirectory())
        folders = [{"path": f"{path}/{n}", "part": int(n.removeprefix(f"{PART}="))}
                   for n in names if n.startswith(f"{PART}=")]
        return self._change(name, mode, df.schema, folders, parted=True), int(obs.get.get("rows", 0))

    def parts(self, name: str) -> list[int]:
        """The parts that a table has."""
        return sorted({f["part"] for f in self._pointer()["tables"][name]["folders"]})

    def append(self, df: DataFrame, name: str, keyed: bool = False, stream: tuple[str, int] | None = None) -> int:
        """Append with one write job; creates the table on first use (SNK-1); returns the
        rows appended. ``stream``: see ``commit``."""
        change, rows = self.write_version(df, name, "add", keyed)
        self.commit({name: change}, stream)
        return rows

    def compact(self, name: str) -> int:
        """Rewrite a table of many folders as one; returns the rows."""
        entry = self._sync()[name]
        if name == "artifactinfo" and 0 <= self.derived_until() < max(f["batch"] for f in entry["folders"]):
            # the folders tell which records the derived tables still lack
            raise RuntimeError("refresh the derived tables before compacting the records")
        if entry["parted"]:
            df = self.spark.table(self.qualified(name)).drop(BATCH)
            change, rows = self.write_parts(df, name, "replace", list(SORT_COLUMNS.get(name, ())))
        else:
            change, rows = self.write_version(self.table(name), name)
        self.commit({name: change}, derived=name == "artifactinfo" and self.derived_until() >= 0)
        return rows

    # -- retention ----------------------------------------------------------------
    def _fs_path(self, path: str):
        """Hadoop FileSystem and Path for ``path`` (works for any scheme: file, hdfs, s3a)."""
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), p

    def folder_exists(self, path: str) -> bool:
        fs, p = self._fs_path(path)
        return fs.exists(p)

    def versions(self, name: str) -> list[str]:
        """Version folders of a table, oldest first (names sort by write time)."""
        fs, p = self._fs_path(f"{self.root}/{name}")
        if not fs.exists(p):
            return []
        return sorted(st.getPath().toString() for st in fs.listStatus(p)
                      if st.isDirectory() and st.getPath().getName().startswith("v"))

    def vacuum(self, name: str, keep: int = 1) -> list[str]:
        """Delete old version folders of ``name``: all but the newest ``keep`` (at least
        one), and never one that the store's pointer names. Returns the deleted folders."""
        in_use = [f["path"] for e in self._pointer()["tables"].values() for f in e["folders"]]
        versions = self.versions(name)
        newest = set(versions[-max(keep, 1):])
        removed = []
        for v in versions:
            folder = v.rsplit("/", 1)[-1]  # folder names are unique
            if v in newest or any(folder in loc.split("/") for loc in in_use):
                continue
            fs, p = self._fs_path(v)
            fs.delete(p, True)
            removed.append(v)
        return removed

    def declare(self, names=("artifactinfo", "gav", "g", "ga")) -> None:
        """Create empty tables with the declared schemas, when missing (SNK-3); the two
        views over them are in ``plans.catalog.declare_views``."""
        missing = [n for n in names if not self.exists(n)]
        if missing:
            self.commit({n: self.write_version(self.spark.createDataFrame([], TABLES[n]), n)[0]
                         for n in missing})


# Lines in a compressed text file. Such a file is read by one task, so its size is bounded.
LINES_PER_FILE = 500_000


def write_lines(lines: DataFrame, path: str, compression: str | None = None) -> None:
    """Write the only column of ``lines`` as text, plain or compressed.

    ``gzip`` is set to its fastest level, which takes JSON lines to a small part of their size.
    """
    w = lines.write.mode("errorifexists")
    if compression:
        w = (w.option("compression", compression).option("zlib.compress.level", "BEST_SPEED")
             .option("maxRecordsPerFile", LINES_PER_FILE))
    w.text(path)


def export_json(artifactinfo: DataFrame, path: str, compression: str | None = None) -> str:
    """Write the JSON column as text, one document per line (SNK-4)."""
    write_lines(artifactinfo.select("json"), path, compression)
    return path
