"""Registry of the package's queries: name -> callable(spark, sf_dir) -> DataFrame.

Each query reads the driver's tables below ``sf_dir`` (index records are derived from
``lineitem`` and ``part``, see ``sources.fixture``) and runs the operator named in
Parameters that the reference takes from the clock or from an undefined table are fixed
here (``oracle.AS_OF``, ``schemas.DEFAULT_EXTENSIONS``), so results are reproducible.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import oracle
from .functions.columns import is_binary_classifier, is_stable_version, key_hex
from .functions.sql import register_functions
from .functions.version import shrink_to_digits, shrink_year, with_version_key, with_version_parts
from .operators import analytics as A
from .operators.by_date import since
from .operators.collation import COORDINATES, collated, plain
from .operators.derived import group_artifact_rollup
from .operators.json_docs import json_paths
from .operators.quality import length_violations
from .operators.records import batch_is_small, first_wins_dedup, new_records, with_content_key
from .operators.views import ga_latest, stable_binaries
from .schemas import ARTIFACTINFO, DEFAULT_EXTENSIONS
from .plans.catalog import declare_views, register_views
from .plans.etl import Tables, full_plan, run_all, run_load, run_refresh, write_load
from .session import remove, scratch_path, sized_for
from .sinks.tables import TableStore, export_json, write_lines
from .sources.fixture import index_size, raw_index
from .sources.index import DROP_REASONS, live_records, read_index
from .streaming.incremental import refresh, stream_audit

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(name: str):
    def deco(fn):
        REGISTRY[name] = lambda spark, sf_dir: printable(fn(sized_for(spark, index_size(spark, sf_dir)), sf_dir))
        REGISTRY[name].__doc__ = fn.__doc__
        return fn
    return deco


def printable(df: DataFrame) -> DataFrame:
    """Binary columns -> lower-case hex strings (same as ``md5()``), nested ones -> JSON."""
    def shown(f):
        if isinstance(f.dataType, T.BinaryType):
            return key_hex(F.col(f.name)).alias(f.name)
        if isinstance(f.dataType, (T.MapType, T.ArrayType)):
            return F.to_json(F.col(f.name)).alias(f.name)
        return F.col(f.name)

    return df.select(*[shown(f) for f in df.schema.fields])


def tables(spark: SparkSession, sf_dir: str, by_key: bool = False) -> Tables:
    return full_plan(raw_index(spark, sf_dir), by_key=by_key)


def _store(spark: SparkSession) -> TableStore:
    return TableStore(spark, scratch_path(spark, "store"))


# ---------------------------------------------------------------- sources, sinks
@query("index_scan")
def q_index_scan(spark, sf_dir):
    """All index documents, written as an index and scanned with the declared schema (SRC-1).

    The stored files are range-partitioned and sorted by ``doc_ord``, so reading them
    yields documents in order within each file; no global sort is added.
    """
    path = scratch_path(spark, "index")
    raw_index(spark, sf_dir).write.parquet(path)
    return read_index(spark, path)


@query("live_records")
def q_live_records(spark, sf_dir):
    """Live artifact documents only (SRC-2)."""
    return live_records(raw_index(spark, sf_dir))


def _middle(raw: DataFrame) -> int:
    """The middle document position: two runs then cover the whole index."""
    return raw.agg(F.max("doc_ord")).first()[0] // 2


@query("incremental_refresh")
def q_incremental_refresh(spark, sf_dir):
    """Stream runs over arriving files, the store reopened by its root before each: first
    full, then the delta, then nothing (SRC-3)."""
    raw = raw_index(spark, sf_dir)
    mid = _middle(raw)
    root = scratch_path(spark, "stream")
    src = f"{root}/incoming"
    raw.filter(F.col("doc_ord") <= mid).write.mode("append").parquet(src)
    first = refresh(spark, src, TableStore(spark, f"{root}/store"))
    raw.filter(F.col("doc_ord") > mid).write.mode("append").parquet(src)
    second = refresh(spark, src, TableStore(spark, f"{root}/store"))
    third = refresh(spark, src, TableStore(spark, f"{root}/store"))
    if not (first.mode == "full" and second.mode == "incremental" and third.rows_appended == 0):
        raise RuntimeError(f"incremental refresh misbehaved: {first}, {second}, {third}")
    return TableStore(spark, f"{root}/store").table("artifactinfo")


@query("table_reads")
def q_table_reads(spark, sf_dir):
    """Every table of a store opened by its root: rows, and distinct keys or groups (SRC-4)."""
    store = _refreshed_store(spark, sf_dir)
    opened = TableStore(spark, store.root)
    names = {"artifactinfo": "uinfo_md5", "gav": "uinfo_md5", "gav_rejects": "uinfo_md5",
             "g": "group_id", "ga": "group_id"}
    parts = [opened.table(t).agg(F.lit(t).alias("table_name"), F.count(F.lit(1)).alias("n_rows"),
                                 F.count_distinct(k).alias("n_keys")) for t, k in names.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("append_artifactinfo")
def q_append(spark, sf_dir):
    """Key and run of every record of two appends: first half of the index, then the whole
    index, of which the stored records are skipped (SNK-1)."""
    raw = raw_index(spark, sf_dir)
    store = _store(spark)
    run_load(spark, raw.filter(F.col("doc_ord") <= _middle(raw)), store)
    before = store.write_version(store.table("artifactinfo").select("uinfo_md5"), "first_run")[0]
    run_load(spark, raw, store)
    first = store.written(before).select("uinfo_md5", F.lit(1).alias("seen"))
    return (store.table("artifactinfo").join(first, "uinfo_md5", "left")
            .select("uinfo_md5", F.when(F.col("seen").isNull(), 2).otherwise(1).alias("run")))


def _refreshed_store(spark, sf_dir) -> TableStore:
    """A store after a load and two refreshes; rows that break a limit are set aside."""
    store = _store(spark)
    run_all(spark, raw_index(spark, sf_dir), store, limits="quarantine")
    run_refresh(spark, store, limits="quarantine")  # replaces the content write-then-swap
    return store


@query("overwrite_gav")
def q_overwrite_gav(spark, sf_dir):
    """``gav`` after two write-then-swap refreshes, without the rejected rows (SNK-2)."""
    return _refreshed_store(spark, sf_dir).table("gav")


@query("overwrite_g")
def q_overwrite_g(spark, sf_dir):
    """``g`` after two write-then-swap refreshes, of the accepted rows (SNK-2)."""
    return _refreshed_store(spark, sf_dir).table("g")


@query("overwrite_ga")
def q_overwrite_ga(spark, sf_dir):
    """``ga`` after two write-then-swap refreshes, of the accepted rows (SNK-2)."""
    return _refreshed_store(spark, sf_dir).table("ga")


@query("gav_rejects")
def q_gav_rejects(spark, sf_dir):
    """Rows that the refresh set aside as breaking a declared limit (QLT-1)."""
    return _refreshed_store(spark, sf_dir).table("gav_rejects")


@query("artifactinfo_rejects")
def q_artifactinfo_rejects(spark, sf_dir):
    """Records that two loads set aside as breaking a declared limit, each key once (QLT-1)."""
    raw, store = raw_index(spark, sf_dir), _store(spark)
    run_load(spark, raw.filter(F.col("doc_ord") <= _middle(raw)), store, limits="quarantine")
    run_load(spark, raw, store, limits="quarantine")
    return store.table("artifactinfo_rejects")


def _maintained_store(spark, sf_dir) -> TableStore:
    """A store after three increments through the stream; the roll-ups are kept up to date."""
    raw, root = raw_index(spark, sf_dir), scratch_path(spark, "maintained")
    step = raw.agg(F.max("doc_ord")).first()[0] // 3
    for k in range(3):
        arrived = raw.filter(F.col("doc_ord") > k * step)
        arrived = arrived.filter(F.col("doc_ord") <= (k + 1) * step) if k < 2 else arrived
        arrived.write.mode("append").parquet(f"{root}/incoming", compression="zstd")
        refresh(spark, f"{root}/incoming", TableStore(spark, f"{root}/store"), limits="quarantine", maintain=True)
    return TableStore(spark, f"{root}/store")


@query("maintained_g")
def q_maintained_g(spark, sf_dir):
    """``g`` kept up to date by three increments (AGG-1, SRC-3)."""
    return _maintained_store(spark, sf_dir).table("g")


@query("maintained_ga")
def q_maintained_ga(spark, sf_dir):
    """``ga`` kept up to date by three increments (AGG-2, SRC-3)."""
    return _maintained_store(spark, sf_dir).table("ga")


@query("replayed_batch")
def q_replayed_batch(spark, sf_dir):
    """Records after a batch came twice: the stream forgets that its last batch was done (SRC-3)."""
    raw, root = raw_index(spark, sf_dir), scratch_path(spark, "replayed")
    mid = _middle(raw)
    for part in (F.col("doc_ord") <= mid, F.col("doc_ord") > mid):
        raw.filter(part).write.mode("append").parquet(f"{root}/incoming", compression="zstd")
        refresh(spark, f"{root}/incoming", TableStore(spark, f"{root}/store"), f"{root}/checkpoint")
    remove(spark, f"{root}/checkpoint/commits/1")
    again = refresh(spark, f"{root}/incoming", TableStore(spark, f"{root}/store"), f"{root}/checkpoint")
    if [b["skipped"] for b in again.batches] != [True]:
        raise RuntimeError(f"the replayed batch was not skipped: {again}")
    return TableStore(spark, f"{root}/store").table("artifactinfo")


def _broken_index(spark, sf_dir) -> str:
    """The index as JSON lines; some are cut off, some have a field of the wrong type."""
    path, raw = scratch_path(spark, "lines"), raw_index(spark, sf_dir)
    line = (F.when(F.col("doc_ord") % 37 == 0, F.concat(F.lit('{"doc_ord":'), "doc_ord", F.lit(',"uinfo":"cut')))
            .when(F.col("doc_ord") % 41 == 0, F.concat(F.lit('{"doc_ord":"no '), "doc_ord", F.lit('","is_live":true}')))
            .otherwise(F.to_json(F.struct(*raw.columns))))
    write_lines(raw.select(line), path, compression="gzip")
    return path


@query("drop_reasons")
def q_drop_reasons(spark, sf_dir):
    """Documents that a load scanned and dropped, by reason; some lines do not decode (SRC-1, SRC-2)."""
    lines, store = _broken_index(spark, sf_dir), _store(spark)
    scan = write_load(read_index(spark, lines, "json", keep_corrupt=True), store).scan
    remove(spark, lines, store.root)  # the counts are all that is read from here on
    return spark.createDataFrame([(k, int(scan[k])) for k in ("scanned", *DROP_REASONS)], "reason string, n long")


@query("index_rejects")
def q_index_rejects(spark, sf_dir):
    """Lines that the stream could not decode (SRC-2, SRC-3)."""
    lines, store = _broken_index(spark, sf_dir), _store(spark)
    refresh(spark, lines, store, source_format="json")
    remove(spark, lines)
    return store.table("index_rejects").select("line")


@query("stream_audit")
def q_stream_audit(spark, sf_dir):
    """One row for each micro-batch of two stream runs, read after the store is reopened (PRJ-22, SRC-3)."""
    raw, root = raw_index(spark, sf_dir), scratch_path(spark, "audited")
    mid = _middle(raw)
    for part in (F.col("doc_ord") <= mid, F.col("doc_ord") > mid):
        raw.filter(part).write.mode("append").parquet(f"{root}/incoming")
        refresh(spark, f"{root}/incoming", TableStore(spark, f"{root}/store"), limits="quarantine")
    return stream_audit(TableStore(spark, f"{root}/store")).drop("stream", "seconds")


@query("declared_types")
def q_declared_types(spark, sf_dir):
    """Declared types of the tables' columns, as the catalog has them, and the longest value that a load
    and a refresh put there (SNK-3, QLT-1)."""
    store = _refreshed_store(spark, sf_dir)
    out = None
    for name in ("artifactinfo", "gav", "g", "ga"):
        t = store.table(name)
        types = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE {store.qualified(name)}").collect()}
        text = [f.name for f in t.schema.fields if isinstance(f.dataType, T.StringType)]
        longest = t.agg(*[F.max(F.length(c)).alias(c) for c in text])
        part = longest.select(F.explode(F.array(*[
            F.struct(F.lit(name).alias("object"), F.lit(c).alias("column_name"),
                     F.lit(types[c]).alias("declared"), F.col(c).alias("longest")) for c in text])).alias("r")
        ).select("r.*")
        out = part if out is None else out.unionByName(part)
    return out


@query("declare_tables")
def q_declare_tables(spark, sf_dir):
    """Columns of the four declared tables and two views, with the values that a load and a
    refresh put there: object, column, type, position, number of values (SNK-3)."""
    store = _store(spark)
    store.declare()
    declare_views(spark, store)
    run_all(spark, raw_index(spark, sf_dir), store, limits="quarantine")
    out = None
    for name in ("artifactinfo", "gav", "g", "ga", "v_ga2ga", "v_artifactinfo2gav"):
        t = spark.table(store.qualified(name)) if name.startswith("v_") else store.table(name)
        counted = t.agg(*[F.count(F.col(c)).alias(c) for c in t.columns])
        rows = [F.struct(F.lit(name).alias("object"), F.lit(f.name).alias("column_name"),
                         F.lit(f.dataType.simpleString()).alias("data_type"),
                         F.lit(i + 1).alias("position"), F.col(f.name).alias("n_values"))
                for i, f in enumerate(t.schema.fields)]
        part = counted.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
        out = part if out is None else out.unionByName(part)
    return out


@query("sql_views")
def q_sql_views(spark, sf_dir):
    """SQL over the two registered views: downloadable files per named artifact (SNK-3).

    The files are counted before the join: an artifact of many names and many files has a row for
    each name, not one for each pair.
    """
    register_views(spark, _refreshed_store(spark, sf_dir))
    return spark.sql("""
        SELECT n.group_id, n.artifact_id, n.name, b.files, b.newest
        FROM (SELECT DISTINCT group_id, artifact_id, name FROM v_ga2ga) n
        JOIN (SELECT group_id, artifact_id, count(*) AS files, max(version_seq) AS newest
              FROM v_artifactinfo2gav GROUP BY group_id, artifact_id) b
          ON n.group_id = b.group_id AND n.artifact_id = b.artifact_id""")


@query("export_json")
def q_export_json(spark, sf_dir):
    """JSON documents written as text lines and read back (SNK-4)."""
    path = export_json(tables(spark, sf_dir).artifactinfo, scratch_path(spark, "export"), compression="gzip")
    return spark.read.text(path).select(F.col("value").alias("json"))


# ---------------------------------------------------------------- projections
def _distinct_versions(spark, sf_dir) -> DataFrame:
    return live_records(raw_index(spark, sf_dir)).select("version").distinct()


@query("content_key")
def q_content_key(spark, sf_dir):
    """MD5 of the coordinate string (PRJ-1)."""
    ai = tables(spark, sf_dir).artifactinfo
    return ai.select("uinfo", "uinfo_md5")


def _version_parts(spark, sf_dir) -> DataFrame:
    """The parsed parts of each distinct version, as the load stages them."""
    return with_version_parts(_distinct_versions(spark, sf_dir))


@query("version_tokens")
def q_version_tokens(spark, sf_dir):
    """Digit-run tokens of each distinct version (PRJ-2)."""
    return _version_parts(spark, sf_dir).select(
        "version", F.col("_v_dot").alias("has_dot"),
        *[F.get("_v_tok", i).alias(f"token{i + 1}") for i in range(4)])


@query("safe_long")
def q_safe_long(spark, sf_dir):
    """Tokens as longs, 0 when absent or too large (PRJ-3)."""
    return _version_parts(spark, sf_dir).select(
        "version", *[F.col(f"_v_t{i}").alias(f"t{i}") for i in range(1, 5)])


@query("shrink_long")
def q_shrink_long(spark, sf_dir):
    """Tokens shrunk to their slot limits (PRJ-4)."""
    t1, t2, t3, t4 = (F.col(f"_v_t{i}") for i in range(1, 5))
    return _version_parts(spark, sf_dir).select(
        "version", shrink_year(t1).alias("first_shrunk"),
        shrink_to_digits(t2, 4).alias("minor_4"), shrink_to_digits(t2, 6).alias("minor_6"),
        shrink_to_digits(t3, 6).alias("incremental_6"), shrink_to_digits(t3, 3).alias("incremental_3"),
        shrink_to_digits(t4, 6).alias("fourth_6"))


@query("version_seq")
def q_version_seq(spark, sf_dir):
    """Sortable version key per distinct version (PRJ-5)."""
    return with_version_key(_distinct_versions(spark, sf_dir)).select("version", "version_seq")


@query("major_version")
def q_major_version(spark, sf_dir):
    """Major version per distinct version (PRJ-6)."""
    return with_version_key(_distinct_versions(spark, sf_dir)).select("version", "major_version")


@query("length_features")
def q_length_features(spark, sf_dir):
    """Coordinate and classifier lengths (PRJ-7)."""
    return tables(spark, sf_dir).artifactinfo.select("uinfo_md5", "uinfo_length", "classifier_length")


@query("availability_codes")
def q_availability_codes(spark, sf_dir):
    """Availability names as ordinals (PRJ-8)."""
    return tables(spark, sf_dir).artifactinfo.select(
        "uinfo_md5", "signature_exists", "sources_exists", "javadoc_exists")


@query("truncate_uinfo")
def q_truncate_uinfo(spark, sf_dir):
    """Stored (cut) coordinate string (PRJ-9)."""
    return tables(spark, sf_dir).artifactinfo.select("uinfo_md5", "uinfo")


@query("to_json")
def q_to_json(spark, sf_dir):
    """Whole record as JSON without null fields (PRJ-10)."""
    return tables(spark, sf_dir).artifactinfo.select("uinfo_md5", "json")


@query("flatten_gav")
def q_flatten_gav(spark, sf_dir):
    """``gav`` from the JSON records (PRJ-11)."""
    return tables(spark, sf_dir).gav


@query("epoch_ms_to_datetime")
def q_epoch(spark, sf_dir):
    """Epoch ms -> rounded second-precision datetime (PRJ-12)."""
    return tables(spark, sf_dir).gav.select("uinfo_md5", "last_modified")


@query("sha1_prefix")
def q_sha1_prefix(spark, sf_dir):
    """Checksum cut to 40 characters (PRJ-13)."""
    return tables(spark, sf_dir).gav.select("uinfo_md5", "sha1")


@query("fix_known_bad")
def q_fix_known_bad(spark, sf_dir):
    """Extension of every file after the fix of known-bad data (PRJ-14)."""
    return tables(spark, sf_dir).gav.select("uinfo_md5", "uinfo", "file_extension")


@query("group_prefixes")
def q_group_prefixes(spark, sf_dir):
    """Four group prefixes per group (PRJ-15)."""
    return tables(spark, sf_dir).g.select("group_id", *[f"group_id_left{k}" for k in range(1, 5)])


@query("null_fallback")
def q_null_fallback(spark, sf_dir):
    """Files without a name or description, with the artifact id in its place (PRJ-16)."""
    gav = tables(spark, sf_dir).gav.filter("name is null or description is null")
    return gav.select("uinfo_md5", "artifact_id", F.coalesce("name", "artifact_id").alias("name"),
                      F.coalesce("description", "artifact_id").alias("description"))


@query("download_command")
def q_download_command(spark, sf_dir):
    """Download command of each stable binary (PRJ-17)."""
    return stable_binaries(tables(spark, sf_dir).gav).select("ref_md5", "location")


@query("constant_and_rename")
def q_constant_and_rename(spark, sf_dir):
    """Renamed columns and the constant location type (PRJ-18)."""
    return stable_binaries(tables(spark, sf_dir).gav).select(
        "ref_md5", "mvn_last_modified", "location_type")


@query("hex_key")
def q_hex_key(spark, sf_dir):
    """All columns and the upper-case hex of the key (PRJ-19)."""
    return A.hex_keys(tables(spark, sf_dir).artifactinfo)


@query("byte_length")
def q_byte_length(spark, sf_dir):
    """Checksum length in bytes, from the JSON (PRJ-20)."""
    ai = tables(spark, sf_dir).artifactinfo
    return ai.select("uinfo_md5", F.octet_length(A.json_sha1(ai)).cast("int").alias("sha1_bytes"))


@query("json_keys")
def q_json_keys(spark, sf_dir):
    """Top-level JSON keys of the first 100 records by key (PRJ-21)."""
    out = A.json_keys(tables(spark, sf_dir).artifactinfo, limit=100)
    return out.select("uinfo_md5", F.array_join("json_keys", ",").alias("json_keys"))


@query("refresh_marker")
def q_refresh_marker(spark, sf_dir):
    """One audit row per load/refresh step (PRJ-22); seconds left out of the result."""
    audit = run_all(spark, raw_index(spark, sf_dir), _store(spark), limits="quarantine")
    return audit.select("step", "table_name", "rows_written", "rows_dropped")


@query("sql_functions")
def q_sql_functions(spark, sf_dir):
    """The package's functions called from ``spark.sql``, for each distinct version (PRJ-2..6)."""
    register_functions(spark)
    _distinct_versions(spark, sf_dir).createOrReplaceTempView("distinct_versions")
    return spark.sql("""
        SELECT version, major_version(version) AS major_version, version_seq(version) AS version_seq,
               get(version_tokens(version), 0) AS token1,
               shrink_long(safe_long(get(version_tokens(version), 1)), 9999L) AS minor_4,
               is_stable_version(version) AS stable
        FROM distinct_versions""")


@query("sql_functions_gav")
def q_sql_functions_gav(spark, sf_dir):
    """The same for files: key, prefixes, time and download command (PRJ-1, 12, 15, 17)."""
    register_functions(spark)
    live = with_content_key(live_records(raw_index(spark, sf_dir)))
    first_wins_dedup(live).createOrReplaceTempView("first_records")
    return spark.sql("""
        SELECT content_key(uinfo) AS uinfo_md5, group_prefix(groupId, 2) AS org,
               epoch_ms_to_datetime(lastModified) AS last_modified, availability_code(javadocExists) AS javadoc_exists,
               download_command(groupId, artifactId, version, fileExtension, classifier) AS command
        FROM first_records""")


# ---------------------------------------------------------------- filters
@query("find_by_md5")
def q_find_by_md5(spark, sf_dir):
    """Point lookup by content key (FLT-1)."""
    return A.find_by_md5(tables(spark, sf_dir, by_key=True).artifactinfo, oracle.LOOKUP_UINFO)


@query("find_by_major_version")
def q_find_by_major(spark, sf_dir):
    """Records of one major version (FLT-2)."""
    return A.find_by_major_version(tables(spark, sf_dir).artifactinfo, oracle.LOOKUP_MAJOR)


@query("coordinate_lookup")
def q_coordinate_lookup(spark, sf_dir):
    """First page of 10 files of one artifact (FLT-3)."""
    return A.coordinate_lookup(tables(spark, sf_dir).gav, oracle.LOOKUP_GROUP, oracle.LOOKUP_ARTIFACT)


@query("seek_page")
def q_seek_page(spark, sf_dir):
    """The third page of 10 files in the order of (version key, content key), by the cursors of the first
    two (LIM-1, FLT-3)."""
    gav, order = tables(spark, sf_dir).gav.filter("version_seq is not null"), ["version_seq", "uinfo_md5"]
    after = None
    for _ in range(2):
        after = A.cursor(A.page_after(gav, order, 10, after), order)
    return A.page_after(gav, order, 10, after)


@query("recent_by_date")
def q_recent_by_date(spark, sf_dir):
    """Most revised groups in the year before ``AS_OF``, from the copy of ``gav`` by time: only the parts of
    the years from then on are opened (FLT-6, AGG-3)."""
    store = _store(spark)
    run_load(spark, raw_index(spark, sf_dir), store)
    run_refresh(spark, store, limits="quarantine", by_date=True)
    return A.most_revised_groups(since(store, A.one_year_before(oracle.AS_OF)), oracle.AS_OF)


@query("stable_versions")
def q_stable_versions(spark, sf_dir):
    """Files whose version has none of the unstable words (FLT-4)."""
    return tables(spark, sf_dir).gav.filter(is_stable_version("artifact_version")).select(
        "uinfo_md5", "artifact_version")


@query("binary_classifier")
def q_binary_classifier(spark, sf_dir):
    """Files without classifier or with the binary one (FLT-5)."""
    return tables(spark, sf_dir).gav.filter(is_binary_classifier("classifier")).select(
        "uinfo_md5", "classifier")


@query("recent_within")
def q_recent_within(spark, sf_dir):
    """Files modified in the year before ``AS_OF`` (FLT-6)."""
    return A.recent_within(tables(spark, sf_dir).gav, oracle.AS_OF).select("uinfo_md5", "last_modified")


@query("country_codes")
def q_country_codes(spark, sf_dir):
    """Groups whose first prefix has two bytes (FLT-7)."""
    g = tables(spark, sf_dir).g
    return g.filter(F.octet_length("group_id_left1") == 2).select("group_id", "group_id_left1")


@query("bad_checksums")
def q_bad_checksums(spark, sf_dir):
    """Records whose JSON checksum is longer than 40 bytes (FLT-8)."""
    return A.bad_checksums(tables(spark, sf_dir).artifactinfo)


@query("length_violations")
def q_length_violations(spark, sf_dir):
    """Broken declared limits of ``gav`` and ``artifactinfo`` (QLT-1)."""
    t = tables(spark, sf_dir)
    return length_violations(t.gav, "gav").unionByName(length_violations(t.artifactinfo, "artifactinfo"))


# ---------------------------------------------------------------- joins
@query("ga_latest")
def q_ga_latest(spark, sf_dir):
    """Newest-version name/description per artifact, fan-out kept (JOIN-1)."""
    t = tables(spark, sf_dir)
    return ga_latest(t.ga, t.gav, rolled_up=True)


@query("stable_binaries")
def q_stable_binaries(spark, sf_dir):
    """Stable downloadable binaries (JOIN-2)."""
    return stable_binaries(tables(spark, sf_dir).gav)


@query("semi_in_samples")
def q_semi_in_samples(spark, sf_dir):
    """Most revised artifacts with the extension list as a table (semi join) (JOIN-3)."""
    ext = spark.createDataFrame([(e,) for e in DEFAULT_EXTENSIONS], "extension string")
    # planned by size: no broadcast is asked for
    return A.most_revised_artifacts(tables(spark, sf_dir).gav, oracle.AS_OF, ext)


@query("new_records")
def q_new_records(spark, sf_dir):
    """Deduplicated records whose key is not stored yet; store = first half (JOIN-4)."""
    raw = raw_index(spark, sf_dir)
    live = with_content_key(live_records(raw))
    # the first half is cut at the middle index position (a scalar subquery)
    mid = raw.select(F.expr("max(doc_ord) div 2").alias("m")).scalar()
    stored = live.filter(F.col("doc_ord") <= mid).select("uinfo_md5")
    # hash-partitioned anti join (the path for batches above the broadcast bound)
    return new_records(first_wins_dedup(live), stored, small_batch=False).select("uinfo_md5", "uinfo")


@query("new_records_small_batch")
def q_new_records_small_batch(spark, sf_dir):
    """Same as ``new_records`` with the path chosen by the batch-size check: below the
    bound the store's keys are filtered by a broadcast of the batch keys (JOIN-4)."""
    raw = raw_index(spark, sf_dir)
    live = with_content_key(live_records(raw))
    mid = raw.select(F.expr("max(doc_ord) div 2").alias("m")).scalar()
    stored = live.filter(F.col("doc_ord") <= mid).select("uinfo_md5")
    return new_records(first_wins_dedup(live), stored, small_batch=batch_is_small(live),
                       batch_keys=live).select(
        "uinfo_md5", "uinfo")


@query("new_records_lookup")
def q_new_records_lookup(spark, sf_dir):
    """Key and run of every record of two loads: all of the index but its last 500 documents, then those and
    the first 300 again, a batch that is looked up key by key (JOIN-4, FLT-1)."""
    raw, store = raw_index(spark, sf_dir), _store(spark)
    last = raw.agg(F.max("doc_ord")).first()[0] - 500
    run_load(spark, raw.filter(F.col("doc_ord") <= last), store)
    folder = store.folders("artifactinfo")
    run_load(spark, raw.filter((F.col("doc_ord") > last) | (F.col("doc_ord") <= 300)), store)
    first = spark.read.schema(ARTIFACTINFO).parquet(*folder).select("uinfo_md5", F.lit(1).alias("seen"))
    return (store.table("artifactinfo").join(first, "uinfo_md5", "left")
            .select("uinfo_md5", F.when(F.col("seen").isNull(), 2).otherwise(1).alias("run")))


@query("json_key_lateral")
def q_json_key_lateral(spark, sf_dir):
    """One row per (record, JSON key) (JOIN-5)."""
    return A.json_key_lateral(tables(spark, sf_dir).artifactinfo)


def _mixed_documents(ai: DataFrame) -> DataFrame:
    """The records with a JSON column of every kind, by the length of the coordinates: some empty, blank,
    malformed or cut off, some arrays, some with rows that are no objects."""
    n = F.col("uinfo_length")
    json = (F.when(n % 7 == 1, F.lit("")).when(n % 7 == 2, F.lit(" \n ")).when(n % 7 == 3, F.lit("oops"))
            .when(n % 7 == 4, F.lit('{"groupId":"cut')).when(n % 7 == 5, F.lit('[1,{"groupId":"second"},null]'))
            .when(n % 3 == 0, F.concat(F.lit("["), "json", F.lit(',{"groupId":"second"}]')))
            .otherwise(F.col("json")))
    return ai.withColumn("json", json)


@query("json_rows_lateral")
def q_json_rows_lateral(spark, sf_dir):
    """JSON documents of every kind as numbered rows, first 100 by key; more than 100 documents before
    the page's end have no rows (JOIN-6)."""
    return A.json_rows_lateral(_mixed_documents(tables(spark, sf_dir).artifactinfo), limit=100)


@query("json_table_sql")
def q_json_table_sql(spark, sf_dir):
    """The table function in ``spark.sql``: rows of whole documents, and rows at a path within (JOIN-6)."""
    register_functions(spark)
    _mixed_documents(tables(spark, sf_dir).artifactinfo).createOrReplaceTempView("json_table_input")
    return spark.sql("""
        SELECT uinfo_md5, '$' AS path, t.rowid, t.cols['groupId'] AS value, t.cols['note'] AS note
        FROM json_table_input d,
             LATERAL json_table(d.json, '$', map('groupId', '$.groupId', 'note', '$.attributes.note')) t
        UNION ALL
        SELECT uinfo_md5, '$.matchHighlights', t.rowid, t.cols['value'], NULL
        FROM json_table_input d, LATERAL json_table(d.json, '$.matchHighlights', map('value', '$')) t""")


@query("json_paths")
def q_json_paths(spark, sf_dir):
    """Every path of the JSON documents with its types and number of values (DIST-2, PRJ-21)."""
    return json_paths(tables(spark, sf_dir).artifactinfo)


# ---------------------------------------------------------------- aggregations
@query("group_rollup")
def q_group_rollup(spark, sf_dir):
    """``g``: counters per group (AGG-1)."""
    return tables(spark, sf_dir).g


@query("group_artifact_rollup")
def q_group_artifact_rollup(spark, sf_dir):
    """``ga``: counters per group and artifact (AGG-2)."""
    return tables(spark, sf_dir).ga


def _spaced(gav: DataFrame) -> DataFrame:
    """Files of which some have trailing spaces in their coordinates, by the length of those."""
    n = F.col("uinfo_length")
    return gav.withColumns({
        "group_id": F.when(n % 5 == 0, F.concat("group_id", F.lit("  "))).otherwise(F.col("group_id")),
        "artifact_id": F.when(n % 7 == 0, F.concat("artifact_id", F.lit(" "))).otherwise(F.col("artifact_id"))})


@query("collated_rollup")
def q_collated_rollup(spark, sf_dir):
    """``ga`` of coordinates that differ in trailing spaces: they count as one (AGG-2, collation)."""
    return plain(group_artifact_rollup(collated(_spaced(tables(spark, sf_dir).gav))))


@query("collated_latest")
def q_collated_latest(spark, sf_dir):
    """Newest-version names of such coordinates: they join as one (JOIN-1, collation)."""
    columns = (*COORDINATES, "name", "description")  # an artifact id may stand for a name
    gav = collated(_spaced(tables(spark, sf_dir).gav), columns)
    ga = collated(group_artifact_rollup(gav))
    return plain(ga_latest(ga, gav, rolled_up=True), columns)


@query("most_revised_groups")
def q_most_revised_groups(spark, sf_dir):
    """Files per group in the year before ``AS_OF`` (AGG-3)."""
    return A.most_revised_groups(tables(spark, sf_dir).gav, oracle.AS_OF)


@query("most_revised_artifacts")
def q_most_revised_artifacts(spark, sf_dir):
    """Files per artifact in the year before ``AS_OF`` (AGG-4)."""
    return A.most_revised_artifacts(tables(spark, sf_dir).gav, oracle.AS_OF)


@query("artifacts_by_country")
def q_by_country(spark, sf_dir):
    """Artifacts per two-letter first prefix (AGG-5)."""
    return A.artifacts_by_country(tables(spark, sf_dir).ga)


@query("artifacts_by_org")
def q_by_org(spark, sf_dir):
    """Artifacts per two-part prefix (AGG-6)."""
    return A.artifacts_by_org(tables(spark, sf_dir).ga)


@query("artifacts_by_top_level")
def q_by_top_level(spark, sf_dir):
    """Artifacts per first prefix (AGG-7)."""
    return A.artifacts_by_top_level(tables(spark, sf_dir).ga)


@query("max_checksum_length")
def q_max_checksum_length(spark, sf_dir):
    """Longest checksum in bytes (AGG-8)."""
    return A.max_checksum_length(tables(spark, sf_dir).artifactinfo)


@query("first_wins_dedup")
def q_first_wins_dedup(spark, sf_dir):
    """Winning document per content key (DIST-1)."""
    live = with_content_key(live_records(raw_index(spark, sf_dir)))
    return first_wins_dedup(live).select("uinfo_md5", "doc_ord")


@query("distinct_json_keys")
def q_distinct_json_keys(spark, sf_dir):
    """All JSON keys over all records (DIST-2)."""
    return A.distinct_json_keys(tables(spark, sf_dir).artifactinfo)


@query("limit_n")
def q_limit_n(spark, sf_dir):
    """First page of 10 ``gav`` rows by key (LIM-1)."""
    return tables(spark, sf_dir).gav.orderBy("uinfo_md5").limit(10)

