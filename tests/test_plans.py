"""Physical-plan checks: pushdown, pruning, partial aggregation, no shuffle of the store."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from gavlake import oracle
from gavlake.operators import analytics as A
from gavlake.operators.derived import group_artifact_rollup, group_rollup
from gavlake.operators.records import first_wins_dedup, new_records
from gavlake.operators.views import stable_binaries
from gavlake.plans.etl import load_plan, run_all
from gavlake.session import scratch_path
from gavlake.sinks.tables import TableStore
from gavlake.sources.fixture import raw_index
from tests.conftest import SMALL_SF


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module", autouse=True)
def long_metadata(spark):
    old = spark.conf.get("spark.sql.maxMetadataStringLength")
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    yield
    spark.conf.set("spark.sql.maxMetadataStringLength", old)


@pytest.fixture(scope="module")
def store(spark):
    s = TableStore(spark, scratch_path(spark, "plans"))
    run_all(spark, raw_index(spark, SMALL_SF), s, limits="quarantine")
    return s


def test_lookup_pushes_filters_and_takes_top_k(store):
    p = plan(A.coordinate_lookup(store.table("gav"), oracle.LOOKUP_GROUP, oracle.LOOKUP_ARTIFACT))
    assert "TakeOrderedAndProject" in p
    assert re.search(r"PushedFilters: \[[^\]]*EqualTo\(group_id,org.apache.tomcat\)", p)
    assert re.search(r"PushedFilters: \[[^\]]*EqualTo\(artifact_id,tomcat\)", p)


def test_extension_list_reaches_the_scan(store):
    p = plan(stable_binaries(store.table("gav")))
    assert re.search(r"PushedFilters: \[[^\]]*In\(file_extension", p)
    assert "Join" not in p  # a list is a predicate, not a join


def test_revised_reads_only_needed_columns(store):
    p = plan(A.most_revised_groups(store.table("gav"), oracle.AS_OF))
    schema = re.search(r"ReadSchema: struct<([^>]*)>", p).group(1)
    assert sorted(c.split(":")[0] for c in schema.split(",")) == [
        "classifier", "file_extension", "group_id", "last_modified"]
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThan\(last_modified", p)


def test_rollups_aggregate_before_every_exchange(store):
    for df in (group_rollup(store.table("gav")), group_artifact_rollup(store.table("gav"))):
        p = df._jdf.queryExecution().executedPlan().toString()
        lines = [ln.strip(" :+-") for ln in p.splitlines()]
        for i, ln in enumerate(lines):
            if ln.startswith("Exchange hashpartitioning"):
                assert lines[i + 1].startswith("HashAggregate"), p  # partial aggregate below


def test_dedup_limits_map_side(spark):
    from gavlake.operators.records import with_content_key
    from gavlake.sources.index import live_records
    p = plan(first_wins_dedup(with_content_key(live_records(raw_index(spark, SMALL_SF)))))
    assert re.search(r"WindowGroupLimit .*Partial", p) and re.search(r"WindowGroupLimit .*Final", p)


def test_small_batch_does_not_shuffle_the_store(spark, store):
    batch = store.table("artifactinfo").limit(10)
    out = new_records(batch, store.table("artifactinfo"), small_batch=True)
    p = plan(out)
    assert "LeftSemi" in p and "LeftAnti" in p
    # the only scan of the store not under a limit is read without an exchange above it
    assert "SortMergeJoin" not in p


def test_key_lookup_pushes_binary_equality(store):
    p = plan(A.find_by_md5(store.table("artifactinfo"), oracle.LOOKUP_UINFO))
    assert re.search(r"PushedFilters: \[[^\]]*EqualTo\(uinfo_md5", p), p


def test_key_lookup_reads_one_bucket(spark, store):
    # the plan names the buckets only where it also reads them as partitions
    spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")
    try:
        p = plan(A.find_by_md5(store.table("artifactinfo"), oracle.LOOKUP_UINFO))
    finally:
        spark.conf.unset("spark.sql.sources.bucketing.autoBucketedScan.enabled")
    assert re.search(r"SelectedBucketsCount: 1 out of (\d+)", p), p
    assert A.find_by_md5(store.table("artifactinfo"), oracle.LOOKUP_UINFO).count() == 1
    key = store.table("artifactinfo").first().uinfo_md5
    assert A.find_by_key(store.table("artifactinfo"), bytes(key)).count() == 1
    assert A.find_by_key(store.table("artifactinfo"), bytes(key).hex()).count() == 1


def test_large_batch_join_does_not_shuffle_the_store(spark, store):
    """The store's buckets are the partitions that the anti join asks for."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        ai = store.table("artifactinfo")
        batch = ai.select(F.unhex(F.md5("uinfo_md5")).alias("uinfo_md5"))
        p = plan(new_records(batch, ai, small_batch=False))
        assert p.count("Exchange hashpartitioning") == 1, p
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_coordinate_lookup_can_skip_files(spark):
    """Files of ``gav`` hold narrow ranges: few can hold a given group, and a hot group fills several."""
    import glob

    import pyarrow.parquet as pq
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        s = TableStore(spark, scratch_path(spark, "ranges"))
        run_all(spark, raw_index(spark, SMALL_SF), s, limits="quarantine")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    ranges = []
    for f in glob.glob(s.location("gav").removeprefix("file:") + "/*.parquet"):
        meta = pq.ParquetFile(f).metadata
        col = next(i for i in range(meta.num_columns) if meta.row_group(0).column(i).path_in_schema == "group_id")
        stats = [meta.row_group(g).column(col).statistics for g in range(meta.num_row_groups)]
        ranges.append((min(x.min for x in stats), max(x.max for x in stats)))
    assert len(ranges) >= 6
    assert 1 <= sum(lo <= oracle.LOOKUP_GROUP <= hi for lo, hi in ranges) <= 3
    top = s.table("g").orderBy("artifact_version_counter", ascending=False).first().group_id
    assert any(lo <= top <= hi for lo, hi in ranges)


def test_json_work_comes_after_the_limit(store):
    p = plan(A.json_keys(store.table("artifactinfo")))
    below = p[p.rindex("TakeOrderedAndProject"):].split("\n", 1)[1]
    assert not re.search(r"(?i)invoke|json_object_keys|from_json|Generate", below), p
    # whether a document has rows takes a look at it, but only the page's documents are taken apart
    p = plan(A.json_rows_lateral(store.table("artifactinfo")))
    below = p[p.rindex("TakeOrderedAndProject"):].split("\n", 1)[1]
    assert "Generate" not in below and "output=[uinfo_md5" in p, p
    assert not re.search(r"Project [^\n]*(?i:invoke|variant)", below), p


def test_ga_latest_reads_gav_once(store):
    from gavlake.operators.views import ga_latest
    p = plan(ga_latest(store.table("ga"), store.table("gav"), rolled_up=True))
    assert len(re.findall(r"Location: [^\n]*/gav/", p)) == 1 or p.count("description:string") == 1


def test_declared_view_is_the_operator(spark, store):
    from gavlake.operators.views import ga_latest
    from gavlake.plans.catalog import declare_views
    declare_views(spark, store)
    view = spark.table(store.qualified("v_ga2ga"))
    assert "LeftOuter" not in plan(view)
    rows = lambda df: sorted(map(repr, df.collect()))
    gav, ga = store.table("gav"), store.table("ga")
    assert rows(view) == rows(ga_latest(ga, gav, rolled_up=True)) == rows(ga_latest(ga, gav))
    assert rows(spark.table(store.qualified("v_artifactinfo2gav"))) == rows(stable_binaries(gav))


def test_a_hot_key_is_split_through_the_declared_view(spark):
    """One version with very many files: its partition is read by several tasks of the view's join."""
    from gavlake.operators.records import conform
    from gavlake.plans.catalog import declare_views
    from gavlake.schemas import GAV
    from gavlake.session import settings
    n = 30_000
    text = F.concat(F.sha2(F.col("id").cast("string"), 512), F.sha2(F.col("id").cast("string"), 384))
    rows = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("g"), "id")).alias("group_id"),
        F.lit("a").alias("artifact_id"), F.lit("1.0").alias("artifact_version"), F.lit(1).alias("major_version"),
        F.lit(10 ** 16).alias("version_seq"), text.alias("name"), text.alias("description"),
        *[F.lit(None).alias(f.name) for f in GAV.fields
          if f.name not in ("group_id", "artifact_id", "artifact_version", "major_version", "version_seq", "name",
                            "description")])
    s = TableStore(spark, scratch_path(spark, "hot-view"))
    s.overwrite(conform(rows, GAV), "gav")
    s.overwrite(group_artifact_rollup(s.table("gav")), "ga")
    declare_views(spark, s)
    small = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
             "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
             "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
             "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k", "spark.sql.shuffle.partitions": "16"}
    with settings(spark, small):
        view = spark.table(s.qualified("v_ga2ga"))
        assert len(view.collect()) == n
        final = view._jdf.queryExecution().executedPlan().toString()
    assert "skew=true" in final, final


def test_filter_on_version_key_parses_each_version_once(spark):
    found = A.find_by_major_version(load_plan(raw_index(spark, SMALL_SF)), oracle.LOOKUP_MAJOR)
    optimized = found._jdf.queryExecution().optimizedPlan().toString()
    assert optimized.count("regexp_extract_all") == 1, optimized
    assert found.select("major_version").distinct().collect() == [(oracle.LOOKUP_MAJOR,)]
