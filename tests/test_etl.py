"""Stores, incremental mode and the DuckDB oracle over the registered queries."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from gavlake.plans.etl import full_plan, run_all, run_load, run_refresh
from gavlake.session import scratch_path
from gavlake.sinks.tables import TableStore
from gavlake.sources.fixture import raw_index
from gavlake.streaming.incremental import refresh
from tests.conftest import SMALL_SF


@pytest.fixture(scope="module")
def raw(spark):
    path = scratch_path(spark, "test-raw")
    raw_index(spark, SMALL_SF).write.parquet(path)
    return spark.read.parquet(path)


def _keys(df):
    return sorted(r[0] for r in df.select(F.lower(F.hex("uinfo_md5"))).collect())


def _shown(df):
    return sorted(repr(tuple(r)) for r in df.collect())


def test_doc_ord_dense_and_ordered(spark, raw):
    n = raw.count()
    stats = raw.agg(F.min("doc_ord"), F.max("doc_ord"), F.count_distinct("doc_ord")).first()
    assert tuple(stats) == (1, n, n)


def test_overwrite_is_write_then_swap(spark, raw):
    store = TableStore(spark, scratch_path(spark, "swap"))
    run_all(spark, raw, store, limits="quarantine")
    before = store.table("ga").count()
    failing = store.table("gav").select(
        F.when(F.col("version_seq") > 0, F.raise_error(F.lit("boom"))).alias("group_id"))
    with pytest.raises(Exception):
        store.overwrite(failing, "ga")
    assert store.table("ga").count() == before  # the old content is still there
    run_refresh(spark, store, limits="quarantine")
    assert store.table("ga").count() == before


def test_failed_refresh_changes_no_table(spark, raw, monkeypatch):
    """The build of ``ga`` fails after ``gav`` and ``g`` are written: all three stay as they were."""
    from gavlake.plans import etl
    store = TableStore(spark, scratch_path(spark, "together"))
    run_load(spark, raw.filter("doc_ord <= 1000"), store)
    run_refresh(spark, store, limits="quarantine")
    before = {n: (store.location(n), store.table(n).count()) for n in ("gav", "g", "ga")}
    run_load(spark, raw, store)

    def failing(gav):
        return gav.select(F.when(F.col("uinfo_length") > 0, F.raise_error(F.lit("boom"))).alias("group_id"))

    monkeypatch.setattr(etl, "group_artifact_rollup", failing)
    with pytest.raises(Exception, match="boom"):
        run_refresh(spark, store, limits="quarantine")
    assert {n: (store.location(n), store.table(n).count()) for n in before} == before
    monkeypatch.undo()
    run_refresh(spark, store, limits="quarantine")
    assert all(store.location(n) != before[n][0] for n in before)


def test_store_reopens_from_its_root(spark, raw):
    """Other objects, and a session with an empty catalog, see the tables and go on from them."""
    root = scratch_path(spark, "reopen")
    mid = raw.agg(F.max("doc_ord")).first()[0] // 2
    raw.filter(F.col("doc_ord") <= mid).write.mode("append").parquet(f"{root}/in")
    assert refresh(spark, f"{root}/in", TableStore(spark, f"{root}/store")).mode == "full"
    raw.filter(F.col("doc_ord") > mid).write.mode("append").parquet(f"{root}/in")
    second = TableStore(spark, f"{root}/store")
    assert refresh(spark, f"{root}/in", second).mode == "incremental"
    full = full_plan(raw).artifactinfo
    assert _keys(second.table("artifactinfo")) == _keys(full)
    run_refresh(spark, second, limits="quarantine")
    run_refresh(spark, second, limits="quarantine")
    rows = {n: second.table(n).count() for n in ("artifactinfo", "gav", "g", "ga", "gav_rejects")}
    # a session whose catalog knows nothing of the store
    spark.sql(f"DROP DATABASE {second.database} CASCADE")
    third = TableStore(spark, f"{root}/store")
    assert {n: third.table(n).count() for n in rows} == rows
    # another catalog database over the same root: what it vacuums is nothing that is read
    other = TableStore(spark, f"{root}/store", database=second.database + "_other")
    for n in rows:
        other.vacuum(n, keep=1)
    assert {n: third.table(n).count() for n in rows} == rows
    # tables that another program moves are followed
    run_refresh(spark, other, limits="off")
    assert third.table("gav").count() == rows["gav"] + rows["gav_rejects"]


def test_lost_store_is_not_taken_for_an_empty_one(spark, raw):
    root = scratch_path(spark, "lost")
    raw.filter("doc_ord <= 100").write.parquet(f"{root}/in")
    refresh(spark, f"{root}/in", TableStore(spark, f"{root}/a"), f"{root}/ckpt")
    with pytest.raises(RuntimeError, match="has progress"):
        refresh(spark, f"{root}/in", TableStore(spark, f"{root}/b"), f"{root}/ckpt")


def test_load_limits(spark, raw):
    with pytest.raises(Exception, match="declared limit broken"):  # versions are missing
        run_load(spark, raw, TableStore(spark, scratch_path(spark, "load-limits")), limits="fail")


def test_size_check_moves_one_row_per_task(spark, raw):
    """The check's single exchange carries counts, not records."""
    from gavlake.operators import records as R
    from gavlake.sources.index import live_records
    live = live_records(raw.repartition(5))
    assert R.batch_is_small(live, live.count()) and not R.batch_is_small(live, live.count() - 1)
    plan = live.groupBy().count()._jdf.queryExecution().executedPlan().toString()
    above = plan.split("Exchange SinglePartition")[1].strip().splitlines()
    assert "HashAggregate" in above[1] and "partial_count" in above[1]


def test_incremental_equals_full(spark, raw):
    full = full_plan(raw).artifactinfo
    mid = raw.agg(F.max("doc_ord")).first()[0] // 3
    root = scratch_path(spark, "incr")
    src, ckpt = f"{root}/in", f"{root}/ckpt"
    store = TableStore(spark, f"{root}/store")
    for lo, hi in ((0, mid), (mid, 2 * mid), (2 * mid, 10 ** 12)):
        raw.filter((F.col("doc_ord") > lo) & (F.col("doc_ord") <= hi)).write.mode("append").parquet(src)
        rep = refresh(spark, src, store, ckpt)
        assert rep.mode == ("full" if lo == 0 else "incremental")
    assert _keys(store.table("artifactinfo")) == _keys(full)
    assert sorted(map(tuple, store.table("artifactinfo").collect())) == sorted(map(tuple, full.collect()))
    # same checkpoint: nothing new
    assert refresh(spark, src, store, ckpt).rows_appended == 0
    # fresh checkpoint replays every file; the anti-join keeps the store unchanged
    assert refresh(spark, src, store, f"{root}/ckpt2").rows_appended == 0
    assert store.table("artifactinfo").count() == full.count()


def test_append_skips_stored(spark, raw):
    store = TableStore(spark, scratch_path(spark, "append"))
    first = run_load(spark, raw.filter("doc_ord <= 1000"), store)
    second = run_load(spark, raw, store)
    again = run_load(spark, raw, store)
    assert again[0][2] == 0
    assert first[0][2] + second[0][2] == full_plan(raw).artifactinfo.count()


def test_oracle_all_queries(spark):
    from tests.oracle_compare import compare
    res = compare(spark, SMALL_SF, verbose=False)
    bad = {k: v for k, v in res.items() if v[0] not in ("OK", "ROWS_ONLY")}
    assert not bad, bad


def test_refresh_limit_modes(spark, raw):
    from gavlake.operators.quality import length_violations
    store = TableStore(spark, scratch_path(spark, "limits"))
    run_load(spark, raw, store)
    n = store.table("artifactinfo").count()
    bad = length_violations(full_plan(raw).gav, "gav").select("uinfo_md5").distinct().count()
    assert bad > 0
    with pytest.raises(Exception, match="declared limit broken"):
        run_refresh(spark, store, limits="fail")
    assert not store.exists("gav")  # nothing half-written became visible
    audit = run_refresh(spark, store, limits="quarantine")
    assert audit[0][2] == n - bad and audit[0][3] == bad
    assert store.table("gav_rejects").count() == bad
    run_refresh(spark, store, limits="off")
    assert store.table("gav").count() == n


def test_sql_views_match_dataframe_queries(spark, raw):
    from gavlake import oracle
    from gavlake.operators import analytics as A
    from gavlake.plans.catalog import SAMPLE_SQL, register_views, run_sample
    store = TableStore(spark, scratch_path(spark, "sql"))
    run_all(spark, raw, store, limits="quarantine")
    register_views(spark, store)
    ai, gav, ga = store.table("artifactinfo"), store.table("gav"), store.table("ga")
    frames = {
        "most_revised_groups": A.most_revised_groups(gav, oracle.AS_OF),
        "most_revised_artifacts": A.most_revised_artifacts(gav, oracle.AS_OF),
        "artifacts_by_country": A.artifacts_by_country(ga),
        "artifacts_by_org": A.artifacts_by_org(ga),
        "artifacts_by_top_level": A.artifacts_by_top_level(ga),
        "distinct_json_keys": A.distinct_json_keys(ai),
        "max_checksum_length": A.max_checksum_length(ai),
        "bad_checksums": A.bad_checksums(ai),
        "json_keys": A.json_keys(ai, limit=100),
        "json_rows_lateral": A.json_rows_lateral(ai, limit=100),
        "hex_key": A.hex_keys(ai),
    }
    for name in SAMPLE_SQL:
        got = run_sample(spark, name, oracle.AS_OF).collect()
        want = frames[name].collect()
        assert [tuple(r) for r in got] == [tuple(r) for r in want] or sorted(map(tuple, got)) == sorted(map(tuple, want)), name
    from gavlake.operators.views import ga_latest
    assert spark.sql("SELECT count(*) FROM v_ga2ga").first()[0] == ga_latest(ga, gav).count()
    assert spark.sql("SELECT count(*) FROM v_artifactinfo2gav WHERE location_type = 2").first()[0] > 0


def test_incremental_many_micro_batches(spark, raw):
    """k files arriving in doc_ord order, one run with one file per micro-batch."""
    full = full_plan(raw).artifactinfo
    top = raw.agg(F.max("doc_ord")).first()[0]
    root = scratch_path(spark, "incr-k")
    src = f"{root}/in"
    k = 4
    for i in range(k):
        lo, hi = top * i // k, top * (i + 1) // k
        raw.filter((F.col("doc_ord") > lo) & (F.col("doc_ord") <= hi)).coalesce(1) \
            .write.mode("append").parquet(src)
    store = TableStore(spark, f"{root}/store")
    rep = refresh(spark, src, store, f"{root}/ckpt", max_files_per_trigger=1)
    assert rep.mode == "full" and len(rep.batches) == k
    assert sorted(map(tuple, store.table("artifactinfo").collect())) == sorted(map(tuple, full.collect()))


def test_read_index_json_and_parquet(spark, raw):
    from gavlake.sources.index import read_index
    root = scratch_path(spark, "read-index")
    raw.write.json(f"{root}/json")
    raw.write.parquet(f"{root}/parquet")
    a = read_index(spark, f"{root}/json", fmt="json")
    b = read_index(spark, f"{root}/parquet")
    assert a.schema == b.schema
    assert _shown(a) == _shown(b) == _shown(raw.select(*b.columns))


def test_stream_reports_drops(spark, raw):
    root = scratch_path(spark, "drops")
    raw.write.parquet(f"{root}/in")
    rep = refresh(spark, f"{root}/in", TableStore(spark, f"{root}/store"), f"{root}/ckpt")
    live = raw.filter("is_live AND is_artifact").count()
    assert sum(b["scanned"] for b in rep.batches) == raw.count()
    assert sum(b["dropped"] for b in rep.batches) == raw.count() - live


def test_observed_counts_not_taken_from_size_check(spark, raw, monkeypatch):
    """With a tiny broadcast bound the size check stops early; drops still cover all rows."""
    import gavlake.operators.records as R
    monkeypatch.setattr(R, "MAX_BROADCAST_KEYS", 10)
    store = TableStore(spark, scratch_path(spark, "obs"))
    run_load(spark, raw.filter("doc_ord <= 100"), store)
    audit = run_load(spark, raw, store)
    assert audit[0][3] == raw.count() - raw.filter("is_live AND is_artifact").count()


def test_doc_ord_is_reproducible(spark):
    """Two independent numberings (other range samples, other partition counts) agree,
    so a recomputation after a lost executor gives the same doc_ord."""
    from gavlake.sources.fixture import dense_order, join_inputs, record_columns, ORDER_COLUMNS
    li = spark.read.parquet(f"{SMALL_SF}/lineitem.parquet")
    pa = spark.read.parquet(f"{SMALL_SF}/part.parquet")
    a = dense_order(join_inputs(li, pa), list(ORDER_COLUMNS), "doc_ord", project=record_columns)
    b = dense_order(join_inputs(li, pa), list(ORDER_COLUMNS), "doc_ord", num_partitions=5,
                    project=record_columns)
    cols = ["doc_ord", "uinfo", "lastModified"]
    assert sorted(map(tuple, a.select(cols).collect())) == sorted(map(tuple, b.select(cols).collect()))


def test_stream_from_json_lines(spark, raw):
    root = scratch_path(spark, "json-stream")
    raw.write.json(f"{root}/in")
    store = TableStore(spark, f"{root}/store")
    rep = refresh(spark, f"{root}/in", store, f"{root}/ckpt", source_format="json")
    full = full_plan(raw).artifactinfo
    assert rep.rows_appended == full.count()
    assert _keys(store.table("artifactinfo")) == _keys(full)


def test_drop_counts_cover_missing_flags(spark):
    from pyspark.sql import Observation
    from gavlake.sources.index import live_records
    from tests.test_operators import raw_row
    from gavlake.schemas import RAW_INDEX
    rows = [raw_row(1), raw_row(2, live=None), raw_row(3, artifact=None), raw_row(4, live=False)]
    obs = Observation()
    kept = live_records(spark.createDataFrame(rows, RAW_INDEX), obs).count()
    m = obs.get
    assert kept == 1 and m["scanned"] == 4 and m["deleted"] + m["not_artifact"] == 3


def test_stream_checkpoint_defaults_to_store(spark, raw):
    root = scratch_path(spark, "ckpt-default")
    raw.write.parquet(f"{root}/incoming")
    store = TableStore(spark, f"{root}/store")
    first = refresh(spark, f"{root}/incoming", store)
    again = refresh(spark, f"{root}/incoming", store)
    assert first.rows_appended > 0 and again.batches == []  # progress kept with the store
