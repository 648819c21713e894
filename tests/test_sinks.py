"""Sinks: declared tables, JSON export, append file size."""

from __future__ import annotations

import json

from gavlake.plans.etl import full_plan
from gavlake.schemas import TABLES
from gavlake.session import scratch_path
from gavlake.sinks.tables import TableStore, export_json
from gavlake.sources.fixture import raw_index
from tests.conftest import SMALL_SF


def test_declare_creates_declared_schemas(spark):
    store = TableStore(spark, scratch_path(spark, "declare"))
    store.declare()
    for name in ("artifactinfo", "gav", "g", "ga"):
        t = store.table(name)
        assert t.count() == 0
        assert [(f.name, f.dataType) for f in t.schema] == [(f.name, f.dataType) for f in TABLES[name]]
    store.declare()  # idempotent


def test_export_json_lines_round_trip(spark):
    ai = full_plan(raw_index(spark, SMALL_SF)).artifactinfo
    path = export_json(ai, scratch_path(spark, "export"))
    lines = [r.value for r in spark.read.text(path).collect()]
    assert len(lines) == ai.count()
    docs = [json.loads(x) for x in lines[:50]]
    assert all("groupId" in d and "version" in d for d in docs)
    assert all(v is not None for d in docs for v in d.values())  # nulls are left out


def test_append_respects_records_per_file(spark):
    store = TableStore(spark, scratch_path(spark, "rpf"), max_records_per_file=1000)
    ai = full_plan(raw_index(spark, SMALL_SF)).artifactinfo
    store.append(ai, "artifactinfo")
    files = spark.table(store.qualified("artifactinfo")).inputFiles()
    n = store.table("artifactinfo").count()
    assert n == ai.count() and len(files) >= n // 1000


def test_vacuum_keeps_what_tables_use(spark):
    from gavlake.plans.etl import run_load, run_refresh
    store = TableStore(spark, scratch_path(spark, "vacuum"))
    run_load(spark, raw_index(spark, SMALL_SF), store)
    run_refresh(spark, store, limits="quarantine")   # gav and gav_rejects share a folder
    rejects = store.table("gav_rejects").count()
    run_refresh(spark, store, limits="off")
    run_refresh(spark, store, limits="off")
    n = store.table("gav").count()
    assert len(store.versions("gav")) == 3
    removed = store.vacuum("gav", keep=1)
    assert len(removed) == 1                         # the quarantine folder is still in use
    assert store.table("gav").count() == n and store.table("gav_rejects").count() == rejects > 0
    assert len(store.versions("gav")) == 2
    store.vacuum("gav", keep=0)                      # the folder that a table names always stays
    assert store.table("gav").count() == n
    assert store.vacuum("g", keep=1) and len(store.versions("g")) == 1
    assert store.table("g").count() > 0
