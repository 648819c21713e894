"""Steps that must not grow faster than their input."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from conftest import SMALL_SF
from gavlake import queries as Q
from gavlake import session
from gavlake.functions.sql import register_functions
from gavlake.operators import records
from gavlake.operators.quality import length_violations
from gavlake.operators.records import at_positions, first_positions, first_wins_dedup
from gavlake.plans import etl
from gavlake.plans.etl import full_plan
from gavlake.session import scratch_path
from gavlake.sinks.tables import TableStore, export_json
from gavlake.sources import fixture
from gavlake.sources.fixture import dense_order, raw_index
from gavlake.sources.index import read_index


def _files(spark, path: str) -> dict[str, int]:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return {st.getPath().getName(): st.getLen() for st in fs.listStatus(p) if st.getPath().getName().startswith("part")}


def _plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_f1_broken_lines_are_stored_compressed(spark):
    files = _files(spark, Q._broken_index(spark, SMALL_SF))
    plain = raw_index(spark, SMALL_SF).agg(F.sum(F.length(F.to_json(F.struct("*"))))).first()[0]
    assert all(name.endswith(".gz") for name in files)
    assert sum(files.values()) < plain / 4


def test_f1_drop_reasons_leaves_no_lines(spark, monkeypatch):
    made, real = [], Q.scratch_path
    monkeypatch.setattr(Q, "scratch_path", lambda *a: made.append(real(*a)) or made[-1])
    assert Q.REGISTRY["drop_reasons"](spark, SMALL_SF).count() == 4
    store = TableStore(spark, real(spark, "store"))
    assert made and not any(store.folder_exists(p) for p in made)


def test_f2_index_rejects_leaves_no_lines(spark, monkeypatch):
    made, real = [], Q._broken_index
    monkeypatch.setattr(Q, "_broken_index", lambda *a: made.append(real(*a)) or made[-1])
    out = Q.REGISTRY["index_rejects"](spark, SMALL_SF)
    n = raw_index(spark, SMALL_SF).filter("doc_ord % 37 = 0 OR doc_ord % 41 = 0").count()
    assert out.count() == n > 0
    store = TableStore(spark, scratch_path(spark, "store"))
    assert made and not store.folder_exists(made[0])


def test_f3_a_filter_on_gav_does_not_repeat_the_parse(spark):
    gav = full_plan(raw_index(spark, SMALL_SF)).gav
    assert _plan(length_violations(gav, "gav")).count("from_json") == 1


def test_f3_a_record_without_json_keeps_its_row(spark):
    ai = full_plan(raw_index(spark, SMALL_SF)).artifactinfo
    broken = ai.limit(3).withColumn("json", F.lit(None).cast("string"))
    from gavlake.operators.derived import flatten_gav
    assert [r.group_id for r in flatten_gav(broken).collect()] == [None] * 3


def test_f4_sql_views_counts_files_before_the_join(spark):
    lines = _plan(Q.REGISTRY["sql_views"](spark, SMALL_SF)).splitlines()
    top_join = next(i for i, line in enumerate(lines) if "Join Inner" in line)
    assert not any("Aggregate" in line for line in lines[:top_join])


def test_f5_export_can_be_compressed(spark):
    ai = full_plan(raw_index(spark, SMALL_SF)).artifactinfo
    path = export_json(ai, scratch_path(spark, "export"), compression="gzip")
    assert all(name.endswith(".gz") for name in _files(spark, path))
    assert sorted(r.value for r in spark.read.text(path).collect()) == sorted(r.json for r in ai.collect())


def test_f6_the_index_is_built_by_compiled_code_and_stored_compressed(spark, monkeypatch):
    limits, paths, real = [], [], fixture.scratch_path
    monkeypatch.setattr(fixture, "scratch_path", lambda *a: paths.append(real(*a)) or paths[-1])
    key = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(key)
    monkeypatch.setattr(F, "monotonically_increasing_id", _noting(F.monotonically_increasing_id, limits, spark, key))
    out = dense_order(spark.range(100).select(F.col("id").alias("k")), ["k"], "pos")
    assert sorted(r.pos for r in out.collect()) == list(range(1, 101))
    assert limits == ["8000"] and spark.conf.get(key) == before
    assert all(".zstd." in name for name in _files(spark, paths[0]))


def _noting(fn, seen, spark, key):
    def noted():
        seen.append(spark.conf.get(key))
        return fn()
    return noted


def test_f12_store_files_are_compressed(spark):
    store = Q._refreshed_store(spark, SMALL_SF)
    for name in ("gav", "g", "ga", "artifactinfo"):
        files = [f for f in store.table(name).inputFiles()]
        assert files and all(".zstd." in f for f in files), name


def test_f19_the_table_function_parses_a_document_once(spark):
    register_functions(spark)
    spark.createDataFrame([("[1,2]",)], "json string").createOrReplaceTempView("f19_docs")
    rows = spark.sql("SELECT t.rowid FROM f19_docs d, LATERAL json_table(d.json, '$', map('v', '$')) t")
    plan = _plan(rows).lower()
    assert plan.count("parse_json") + plan.count("parsejson") == 1 and "schema_of_variant" not in plan
    assert sorted(r.rowid for r in rows.collect()) == [1, 2]


def test_f16_a_load_sorts_small_scans(spark, monkeypatch):
    path, seen = scratch_path(spark, "index"), []
    raw_index(spark, SMALL_SF).coalesce(1).write.parquet(path)
    raw, key = spark.read.parquet(path), "spark.sql.files.maxPartitionBytes"
    size, before = sum(_files(spark, path).values()), spark.conf.get(key)
    wide, write = spark.read.parquet(path).rdd.getNumPartitions(), TableStore.write_version

    def spy(self, df, *args, **kw):
        seen.append((spark.conf.get(key), spark.read.parquet(path).rdd.getNumPartitions()))
        return write(self, df, *args, **kw)

    monkeypatch.setattr(TableStore, "write_version", spy)
    most = size // (4 * wide)
    monkeypatch.setattr(etl, "LOAD_SCAN_BYTES", most)
    loaded = etl.write_load(raw, TableStore(spark, scratch_path(spark, "store")))
    assert loaded.written > 0 and seen == [(str(most), seen[0][1])] and seen[0][1] > wide
    assert spark.conf.get(key) == before


def _sized(spark, monkeypatch, records: int = 500):
    monkeypatch.setattr(session, "RECORDS_PER_TASK", records)
    monkeypatch.setattr(session, "SCAN_BYTES", 100_000)
    return session.sized_for(spark, fixture.index_size(spark, SMALL_SF))


def _all_rows(df) -> list:
    return sorted(map(str, df.collect()))


def test_f10_a_large_index_has_more_partitions(spark, monkeypatch):
    keys = ["spark.sql.shuffle.partitions", "spark.sql.files.maxPartitionBytes"]
    before = [spark.conf.get(k) for k in keys]
    assert session.sized_for(spark, 8 * session.RECORDS_PER_TASK) is spark
    n = -(-fixture.index_size(spark, SMALL_SF) // 500)
    sized = _sized(spark, monkeypatch)
    assert n > 8 and [sized.conf.get(k) for k in keys] == [str(n), "100000"]
    assert sized.conf.get("spark.sql.session.timeZone") == "UTC" and scratch_path(sized, "x").startswith(
        session.scratch_root(spark))
    assert [spark.conf.get(k) for k in keys] == before  # the user's session stays as it is


def test_f10_f11_f15_f18_same_rows_in_more_partitions(spark, monkeypatch):
    for name in ("epoch_ms_to_datetime", "group_artifact_rollup", "hex_key", "declared_types", "json_table_sql"):
        few = Q.REGISTRY[name](spark, SMALL_SF)
        assert few.sparkSession is spark
        few = _all_rows(few)
        with monkeypatch.context() as m:
            _sized(spark, m)
            many = Q.REGISTRY[name](spark, SMALL_SF)
            assert many.sparkSession is not spark, name
            assert _all_rows(many) == few, name


def test_f14_f17_a_large_load_has_more_buckets(spark, monkeypatch):
    sized = _sized(spark, monkeypatch)
    store = Q._refreshed_store(sized, SMALL_SF)
    assert f"INTO {sized.conf.get('spark.sql.shuffle.partitions')} BUCKETS" in store._pointer()["tables"]["artifactinfo"]["clustered"]
    assert store.table("gav_rejects").count() == Q._refreshed_store(spark, SMALL_SF).table("gav_rejects").count() > 0


def test_f21_f22_same_maintained_rollups_in_more_partitions(spark, monkeypatch):
    few = {n: _all_rows(Q._maintained_store(spark, SMALL_SF).table(n)) for n in ("g", "ga")}
    many = Q._maintained_store(_sized(spark, monkeypatch), SMALL_SF)
    assert {n: _all_rows(many.table(n)) for n in ("g", "ga")} == few


def _whole_and_in_place(spark, monkeypatch, name):
    """Rows of a query whose dedup shuffles the records, and of one that marks positions; and the plan of the latter."""
    whole = _all_rows(Q.REGISTRY[name](spark, SMALL_SF))
    monkeypatch.setattr(etl, "COUNTED_FIRST_BYTES", 0)
    df = Q.REGISTRY[name](spark, SMALL_SF)
    rows = _all_rows(df)
    return whole, rows, df._jdf.queryExecution().executedPlan().toString()


def test_r04_f15_bad_checksums_shuffles_no_records(spark, monkeypatch):
    whole, rows, plan = _whole_and_in_place(spark, monkeypatch, "bad_checksums")
    assert rows == whole != []
    assert "hashpartitioning(uinfo_md5" not in plan and "Window [row_number" not in plan, plan


def test_r04_f15_positions_tell_the_first_records(spark):
    df = spark.createDataFrame([(b"a", 5), (b"a", 7), (b"b", -3), (b"b", -600), (b"c", 1 << 40), (None, 9), (None, 8)],
                               "uinfo_md5 binary, doc_ord long")
    kept = lambda *stored: sorted(r.doc_ord for r in at_positions(df, first_positions(df, stored)[0]).collect())
    assert kept() == sorted(r.doc_ord for r in first_wins_dedup(df).collect()) == [-600, 5, 8, 1 << 40]
    assert kept(df.filter("doc_ord = 7"), df.filter("doc_ord = -3")) == [8, 1 << 40]
    none = df.limit(0)
    assert at_positions(none, first_positions(none)[0]).collect() == []


@pytest.mark.parametrize("rows", [
    [(b"a", None), (b"a", 7)], [(b"a", 5), (b"b", 5)], [(b"a", 5), (b"a", 5)], [(b"a", 5), (b"b", 5), (b"b", 4)]])
def test_r04_f15_positions_that_are_missing_or_shared_are_not_used(spark, rows):
    assert first_positions(spark.createDataFrame(rows, "uinfo_md5 binary, doc_ord long")) is None


def test_r04_f15_too_many_marks_and_odd_sources_shuffle_the_records(spark, monkeypatch):
    raw, path = raw_index(spark, SMALL_SF), scratch_path(spark, "lines")
    usual = _all_rows(full_plan(raw).artifactinfo)
    monkeypatch.setattr(etl, "COUNTED_FIRST_BYTES", 0)
    assert etl.reads_twice(raw)
    raw.write.json(path)
    assert not etl.reads_twice(read_index(spark, path, "json"))
    monkeypatch.setattr(records, "MAX_BROADCAST_SLICES", 3)
    ai = full_plan(raw).artifactinfo
    assert "Window" in _plan(ai) and _all_rows(ai) == usual


def _shuffles_no_records(spark, monkeypatch, name):
    whole, rows, plan = _whole_and_in_place(spark, monkeypatch, name)
    assert rows == whole != []
    assert "hashpartitioning(uinfo_md5" not in plan and "Window [row_number" not in plan, plan


def test_r04_f1_seek_page_shuffles_no_records(spark, monkeypatch):
    _shuffles_no_records(spark, monkeypatch, "seek_page")


def test_r04_f16_json_table_sql_shuffles_no_records(spark, monkeypatch):
    _shuffles_no_records(spark, monkeypatch, "json_table_sql")


def test_r04_f17_constant_and_rename_shuffles_no_records(spark, monkeypatch):
    _shuffles_no_records(spark, monkeypatch, "constant_and_rename")


def test_r04_f5_json_paths_shuffles_no_records(spark, monkeypatch):
    whole = _all_rows(Q.REGISTRY["json_paths"](spark, SMALL_SF))
    monkeypatch.setattr(etl, "COUNTED_FIRST_BYTES", 0)
    monkeypatch.setattr(records, "first_wins_dedup", lambda *_: pytest.fail("the records are shuffled"))
    assert _all_rows(Q.REGISTRY["json_paths"](spark, SMALL_SF)) == whole != []


def test_r04_f12_collated_latest_shuffles_no_records(spark, monkeypatch):
    _shuffles_no_records(spark, monkeypatch, "collated_latest")
