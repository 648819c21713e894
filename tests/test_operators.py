"""Unit tests per operator on small literal DataFrames (FIXTURES.md §3)."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from gavlake.functions.columns import (
    availability_code,
    epoch_ms_to_datetime,
    group_prefix,
    is_stable_version,
)
from gavlake.operators import analytics as A
from gavlake.operators.derived import flatten_gav, group_artifact_rollup, group_rollup
from gavlake.operators.quality import enforce_limits, length_violations, with_reject_flag
from gavlake.operators.records import artifactinfo_from_records
from gavlake.operators.views import extension_filter, ga_latest, stable_binaries
from gavlake.plans.etl import full_plan
from gavlake.schemas import ARTIFACTINFO, GAV, RAW_INDEX


def raw_row(doc_ord, uinfo="g|a|1.0|NA|jar", live=True, artifact=True, **kw):
    base = dict(doc_ord=doc_ord, is_live=live, is_artifact=artifact, uinfo=uinfo, groupId="g",
                artifactId="a", version="1.0", classifier=None, fileExtension="jar",
                packaging="jar", name="n", description="d", lastModified=1_700_000_000_499,
                size=10, sha1="x" * 40, repository="central", sourcesExists="PRESENT",
                javadocExists="NOT_PRESENT", signatureExists="NOT_AVAILABLE",
                attributes=None, context=None, matchHighlights=None)
    base.update(kw)
    return tuple(base[f.name] for f in RAW_INDEX.fields)


def test_first_wins_and_live_filter(spark):
    rows = [
        raw_row(5, name="third", sha1="c" * 40),
        raw_row(2, name="first", sha1="a" * 40),
        raw_row(1, name="deleted", live=False),
        raw_row(0, name="not-artifact", artifact=False),
        raw_row(3, name="second"),
    ]
    raw = spark.createDataFrame(rows, RAW_INDEX)
    ai = artifactinfo_from_records(raw.filter("is_live AND is_artifact"))
    assert ai.schema == ARTIFACTINFO or [f.name for f in ai.schema] == ARTIFACTINFO.fieldNames()
    out = ai.collect()
    assert len(out) == 1
    assert '"name":"first"' in out[0].json
    assert out[0].signature_exists == 1  # filled from the sources flag by default
    fixed = artifactinfo_from_records(raw.filter("is_live AND is_artifact"), fix_signature=True)
    assert fixed.first().signature_exists == 2


def test_skip_stored_keys(spark):
    raw = spark.createDataFrame([raw_row(1), raw_row(2, uinfo="g|a|2.0|NA|jar", version="2.0")],
                                RAW_INDEX)
    stored = artifactinfo_from_records(raw.filter("doc_ord = 1")).select("uinfo_md5")
    new = artifactinfo_from_records(raw, store_keys=stored).collect()
    assert [r.uinfo for r in new] == ["g|a|2.0|NA|jar"]


def test_availability_codes(spark):
    df = spark.createDataFrame([("NOT_PRESENT",), ("PRESENT",), ("NOT_AVAILABLE",), ("??",), (None,)],
                               "n string")
    assert [r.c for r in df.select(availability_code("n").alias("c")).collect()] == [0, 1, 2, None, None]


def test_epoch_rounding(spark):
    vals = [0, 499, 500, 1_700_000_000_499, 1_700_000_000_500, -1, None,
            253402300799499, 253402300799500, 9223372036854775807]
    df = spark.createDataFrame([(v,) for v in vals], "ms long")
    got = [r.t for r in df.select(epoch_ms_to_datetime("ms").alias("t")).collect()]
    e = dt.datetime(1970, 1, 1)
    assert got == [e, e, e + dt.timedelta(seconds=1), dt.datetime(2023, 11, 14, 22, 13, 20),
                   dt.datetime(2023, 11, 14, 22, 13, 21), None, None,
                   dt.datetime(9999, 12, 31, 23, 59, 59), None, None]


def test_epoch_rounding_independent_of_session_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        df = spark.createDataFrame([(500,)], "ms long")
        assert df.select(epoch_ms_to_datetime("ms").alias("t")).first().t == dt.datetime(1970, 1, 1, 0, 0, 1)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_group_prefixes(spark):
    df = spark.createDataFrame([("junit",), ("a.b",), ("a.b.c.d.e",), ("",), ("a.b.",)], "g string")
    got = df.select(*[group_prefix("g", k).alias(f"p{k}") for k in range(1, 5)]).collect()
    assert tuple(got[0]) == ("junit",) * 4
    assert tuple(got[1]) == ("a", "a.b", "a.b", "a.b")
    assert tuple(got[2]) == ("a", "a.b", "a.b.c", "a.b.c.d")
    assert tuple(got[3]) == ("",) * 4
    assert tuple(got[4]) == ("a", "a.b", "a.b.", "a.b.")


def test_stable_versions(spark):
    vs = ["1.0", "1.0-M1", "2.0-alpha", "3.0.Final", "1.0-SNAPSHOT", "4.0-RC1", "5.0-GA", None, "1.0-sp1"]
    df = spark.createDataFrame([(v,) for v in vs], "v string")
    got = [r.v for r in df.filter(is_stable_version("v")).collect()]
    assert got == ["1.0", "3.0.Final", "5.0-GA"]


def _ai_with_json(spark, docs):
    rows = [Row(uinfo_md5=bytes([i]) * 16, major_version=1, version_seq=1, uinfo_length=1,
                classifier_length=0, signature_exists=0, sources_exists=0, javadoc_exists=0,
                uinfo=f"u{i}", json=j) for i, j in enumerate(docs)]
    return spark.createDataFrame(rows, ARTIFACTINFO)


def test_flatten_json_variants(spark):
    docs = [
        '{"groupId":"g","artifactId":"a","version":"1","lastModified":1500,"size":12,"sha1":"' + "s" * 45 + '"}',
        '{"groupId":"g","artifactId":"a","version":"2","lastModified":"2500","size":"13"}',
        '{"groupId":"g","artifactId":"a","version":"3","size":null}',
        '{"groupId":"org.apache.tomcat","artifactId":"tomcat","version":"9","fileExtension":"zip.sha512"}',
        '[1,2]',
        'not json',
    ]
    gav = flatten_gav(_ai_with_json(spark, docs))
    assert gav.columns == GAV.fieldNames()
    rows = {r.uinfo: r for r in gav.collect()}
    assert rows["u0"].last_modified == dt.datetime(1970, 1, 1, 0, 0, 2)
    assert rows["u0"].size == 12 and rows["u0"].sha1 == "s" * 40
    assert rows["u1"].last_modified == dt.datetime(1970, 1, 1, 0, 0, 3) and rows["u1"].size == 13
    assert rows["u2"].size is None and rows["u2"].last_modified is None
    assert rows["u3"].file_extension == "zip"
    assert rows["u4"].group_id is None and rows["u5"].group_id is None


def test_checksum_queries(spark):
    docs = ['{"sha1":"' + "a" * 40 + '"}', '{"sha1":"' + "b" * 41 + '"}', '{"sha1":"' + "c" * 92 + '"}',
            '{"sha1":"' + "é" * 21 + '"}', '{"groupId":"x"}']
    ai = _ai_with_json(spark, docs)
    assert A.max_checksum_length(ai).first().max_sha1_length == 92
    bad = A.bad_checksums(ai).collect()
    assert sorted(r.uinfo for r in bad) == ["u1", "u2", "u3"]  # é is two bytes
    assert bad[0].uinfo_md5_hex == bad[0].uinfo_md5.hex().upper()


def test_json_keys_and_rows(spark):
    ai = _ai_with_json(spark, ['{"b":1,"a":{"x":1}}', '{"groupId":"g"}', '[{"groupId":"h"},{"groupId":"i"}]'])
    keys = [r.json_key for r in A.distinct_json_keys(ai).collect()]
    assert keys == ["a", "b", "groupId"]
    rows = A.json_rows_lateral(ai, limit=None).orderBy("uinfo_md5", "rowid").collect()
    assert [(r.rowid, r.groupId) for r in rows] == [(1, None), (1, "g"), (1, "h"), (2, "i")]


def _gav(spark, rows, nullable=False):
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in GAV.fields]) \
        if nullable else GAV
    full = []
    for i, r in enumerate(rows):
        d = dict(uinfo_md5=i.to_bytes(16, "big"), uinfo_length=5, uinfo=f"u{i}", group_id="g",
                 artifact_id="a", artifact_version="1.0", major_version=1, version_seq=1,
                 last_modified=dt.datetime(2020, 1, 1), size=1, sha1="s", signature_exists=0,
                 sources_exists=0, javadoc_exists=0, classifier=None, classifier_length=0,
                 file_extension="jar", packaging="jar", name=None, description=None)
        d.update(r)
        full.append(tuple(d[f.name] for f in GAV.fields))
    return spark.createDataFrame(full, schema)


def test_rollups_and_fan_out(spark):
    gav = _gav(spark, [
        dict(artifact_version="1.0", major_version=1, version_seq=10, name="old"),
        dict(artifact_version="2.0", major_version=2, version_seq=20, name="new-jar"),
        dict(artifact_version="2.0", major_version=2, version_seq=20, name="new-pom", file_extension="pom"),
        dict(artifact_id="b", artifact_version="2.1", major_version=2, version_seq=21,
             last_modified=dt.datetime(2021, 5, 6, 7, 8, 9)),
    ])
    ga = group_artifact_rollup(gav)
    got = {r.artifact_id: r for r in ga.collect()}
    assert (got["a"].artifact_version_counter, got["a"].major_version_counter, got["a"].version_seq_max) == (2, 2, 20)
    g = group_rollup(gav).first()
    assert (g.artifact_version_counter, g.major_version_counter, g.version_seq_max) == (3, 2, 21)
    assert g.last_modified_max == dt.date(2021, 5, 6) and g.group_id_left1 == "g"
    view = ga_latest(ga, gav).filter("artifact_id = 'a'").collect()
    assert sorted(r.name for r in view) == ["new-jar", "new-pom"]  # fan-out kept
    b = ga_latest(ga, gav).filter("artifact_id = 'b'").first()
    assert b.name == "b" and b.description == "b"  # fallback to the artifact id
    assert ga_latest(ga, gav, distinct=True).count() == 3


def test_stable_binaries_and_extension_table(spark):
    gav = _gav(spark, [
        dict(classifier=None, file_extension="jar"),
        dict(classifier="bin", file_extension="zip", artifact_version="1.1"),
        dict(classifier="sources", file_extension="jar"),
        dict(classifier=None, file_extension="pom"),
        dict(classifier=None, artifact_version="1.0-beta"),
    ])
    out = stable_binaries(gav).orderBy("ref_md5").collect()
    assert [r.location for r in out] == [
        "mvn dependency:copy -U -DoutputDirectory=. -Dartifact=g:a:1.0:jar",
        "mvn dependency:copy -U -DoutputDirectory=. -Dartifact=g:a:1.1:zip:bin",
    ]
    assert all(r.location_type == 2 for r in out)
    ext = spark.createDataFrame([("jar",), ("zip",)], "extension string")
    assert extension_filter(gav, ext).count() == extension_filter(gav, ["jar", "zip"]).count() == 4


def test_quality_modes(spark):
    gav = _gav(spark, [dict(), dict(artifact_version="v" * 129), dict(sha1="s" * 41, group_id=None)])
    v = length_violations(gav, "gav").collect()
    assert sorted((r.column_name, r.rule) for r in v) == [
        ("artifact_version", "max_length_128"), ("group_id", "not_null"), ("sha1", "max_length_40")]
    flagged = with_reject_flag(gav, "gav").collect()
    assert sorted(r.rejected for r in flagged) == [False, True, True]
    assert enforce_limits(gav.limit(1), "gav").count() == 1
    with pytest.raises(Exception, match="declared limit broken"):
        enforce_limits(gav, "gav").collect()


def test_no_python_in_plans(spark):
    from tests.conftest import SMALL_SF
    from gavlake.sources.fixture import raw_index
    t = full_plan(raw_index(spark, SMALL_SF))
    for df in (t.artifactinfo, t.gav, t.g, t.ga, ga_latest(t.ga, t.gav), stable_binaries(t.gav)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "EvalPython" not in plan and "PythonUDF" not in plan


def test_dedup_plan_limits_before_shuffle(spark):
    from tests.conftest import SMALL_SF
    from gavlake.sources.fixture import raw_index
    ai = full_plan(raw_index(spark, SMALL_SF)).artifactinfo
    plan = ai._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_hot_key_dedup_and_fan_out(spark):
    """One key holds a third of all rows: results stay whole and exact."""
    n = 3000
    rows = [raw_row(i, uinfo="hot|a|1.0|NA|jar" if i % 3 == 0 else f"g|a|{i}|NA|jar",
                    version="1.0" if i % 3 == 0 else f"{i}.0", name=f"n{i}") for i in range(n, 0, -1)]
    raw = spark.createDataFrame(rows, RAW_INDEX).repartition(8)
    ai = artifactinfo_from_records(raw)
    assert ai.count() == n - n // 3 + 1
    hot = ai.filter(F.col("uinfo") == "hot|a|1.0|NA|jar").first()
    assert '"name":"n3"' in hot.json  # the smallest doc_ord among the hot rows
    # newest version of one artifact has n files: all of them come back (fan-out)
    gav = _gav(spark, [dict(version_seq=2, name=f"f{i}") for i in range(n)]
               + [dict(version_seq=1, name="old")])
    view = ga_latest(group_artifact_rollup(gav), gav)
    assert view.count() == n and view.filter("name = 'old'").count() == 0


def test_ga_latest_unmatched_rows(spark):
    gav = _gav(spark, [dict(version_seq=5, name="x")])
    ga = group_artifact_rollup(gav).union(
        spark.createDataFrame([("g", "zz", 1, 1, None, None)], group_artifact_rollup(gav).schema))
    out = {r.artifact_id: (r.name, r.description) for r in ga_latest(ga, gav).collect()}
    assert out == {"a": ("x", "a"), "zz": ("zz", "zz")}


def test_every_declared_limit_at_and_above(spark):
    from gavlake.schemas import COLUMN_LIMITS
    limits = [(c, n) for t, c, n, _ in COLUMN_LIMITS if t == "gav" and n is not None]
    rows = []
    for col, n in limits:
        rows.append({col: "x" * n})        # at the limit: fine
        rows.append({col: "y" * (n + 1)})  # one above: reported
    gav = _gav(spark, rows)
    got = sorted((r.column_name, r.rule, r.actual_length) for r in length_violations(gav, "gav").collect())
    assert got == sorted((c, f"max_length_{n}", n + 1) for c, n in limits)
    nulls = _gav(spark, [{c: None} for t, c, n, nn in COLUMN_LIMITS if t == "gav" and nn], nullable=True)
    got = sorted(r.column_name for r in length_violations(nulls, "gav").filter("rule = 'not_null'").collect())
    assert got == sorted(c for t, c, n, nn in COLUMN_LIMITS if t == "gav" and nn)


def test_full_record_with_nested_keys(spark):
    """A record with all 18 keys, incl. nested ones the tables do not use."""
    doc = ('{"groupId":"g","artifactId":"a","version":"1.0","classifier":null,'
           '"fileExtension":"jar","packaging":"jar","name":"n","description":"d",'
           '"lastModified":1700000000500,"size":5,"sha1":"' + "a" * 40 + '",'
           '"repository":"central","sourcesExists":"PRESENT","javadocExists":"NOT_PRESENT",'
           '"signatureExists":"NOT_AVAILABLE","attributes":{"k":"v"},"context":"ctx",'
           '"matchHighlights":[]}')
    ai = _ai_with_json(spark, [doc])
    row = flatten_gav(ai).first()
    assert (row.group_id, row.artifact_version, row.size, row.classifier) == ("g", "1.0", 5, None)
    assert row.last_modified == dt.datetime(2023, 11, 14, 22, 13, 21)
    keys = [r.json_key for r in A.distinct_json_keys(ai).collect()]
    assert len(keys) == 18 and {"attributes", "context", "matchHighlights"} <= set(keys)


def test_records_pages(spark):
    gav = _gav(spark, [dict(artifact_version=f"1.{i}") for i in range(25)]
               + [dict(artifact_id="other")])
    pages = [A.records(gav, {"group_id": "g", "artifact_id": "a"}, size=10, page=p).collect()
             for p in (1, 2, 3, 4)]
    assert [len(x) for x in pages] == [10, 10, 5, 0]
    keys = [r.uinfo_md5 for x in pages for r in x]
    assert keys == sorted(keys) and len(set(keys)) == 25
    assert A.coordinate_lookup(gav, "g", "other").count() == 1


def test_extension_table_above_bound_uses_shuffle_join(spark, monkeypatch):
    import gavlake.operators.views as V
    gav = _gav(spark, [dict(file_extension=e) for e in ("jar", "zip", "pom", "war")])
    ext = spark.createDataFrame([("jar",), ("zip",)], "extension string")
    small = V.extension_filter(gav, ext, small_extensions=V.extensions_are_small(ext))
    monkeypatch.setattr(V, "MAX_BROADCAST_EXTENSIONS", 1)
    big = V.extension_filter(gav, ext, small_extensions=V.extensions_are_small(ext))

    def analyzed(df):
        return df._jdf.queryExecution().analyzed().toString().lower()

    # below the bound the broadcast is forced by a hint; above it the planner decides
    assert "strategy=broadcast" in analyzed(small) and "strategy=broadcast" not in analyzed(big)
    assert "leftsemi" in analyzed(big)
    assert sorted(r.file_extension for r in big.collect()) == ["jar", "zip"]


def test_uinfo_is_cut_at_250(spark):
    rows = [raw_row(i, uinfo="u" * n) for i, n in enumerate((249, 250, 251, 300), start=1)]
    got = artifactinfo_from_records(spark.createDataFrame(rows, RAW_INDEX)).collect()
    assert sorted((r.uinfo_length, len(r.uinfo)) for r in got) == [(249, 249), (250, 250), (251, 250), (300, 250)]


def test_nested_record_keys_reach_the_json(spark):
    import json
    row = raw_row(1)
    names = [f.name for f in RAW_INDEX.fields]
    full = dict(zip(names, row))
    full.update(attributes={"k": 'a "quoted" value'}, context="ctx", matchHighlights=["x", "y"])
    ai = artifactinfo_from_records(spark.createDataFrame([tuple(full[n] for n in names)], RAW_INDEX)).first()
    doc = json.loads(ai.json)
    assert doc["attributes"] == {"k": 'a "quoted" value'} and doc["matchHighlights"] == ["x", "y"]
    assert doc["context"] == "ctx"


def test_rolled_up_latest_equals_the_general_one(spark):
    gav = _gav(spark, [dict(), dict(artifact_id="b", version_seq=None), dict(artifact_id=None),
                       dict(group_id=None), dict(artifact_version="2.0")], nullable=True)
    ga = group_artifact_rollup(gav)
    a = sorted(map(repr, ga_latest(ga, gav).collect()))
    assert a == sorted(map(repr, ga_latest(ga, gav, rolled_up=True).collect())) and len(a) >= 4


def test_lazy_functions_start_no_job(spark):
    from gavlake.operators.views import extension_filter
    gav = _gav(spark, [dict()])
    ext = spark.createDataFrame([("jar",)], "extension string")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("lazy", "lazy")
    try:
        extension_filter(gav, ext)
        stable_binaries(gav)
        ga_latest(group_artifact_rollup(gav), gav)
        A.json_rows_lateral(_ai_with_json(spark, ["{}"]))
        assert list(tracker.getJobIdsForGroup("lazy")) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
