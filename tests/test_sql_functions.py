"""The package's functions in SQL against their DataFrame forms."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from gavlake.functions.columns import (
    availability_code,
    content_key,
    download_command,
    epoch_ms_to_datetime,
    group_prefix,
    is_stable_version,
)
from gavlake.functions.sql import register_functions
from gavlake.functions.version import shrink_to_digits, shrink_year, with_version_key
from tests.test_version import GOLDEN, _random_versions


def test_versions_equal_the_dataframe_form(spark):
    register_functions(spark)
    versions = [v for v, *_ in GOLDEN] + _random_versions(2_000) + [None]
    df = spark.createDataFrame([(v,) for v in versions], "version string")
    df.createOrReplaceTempView("versions_in")
    got = spark.sql("SELECT version, major_version(version) AS major_version, version_seq(version) AS version_seq, "
                    "is_stable_version(version) AS stable FROM versions_in")
    want = with_version_key(df).select("version", "major_version", "version_seq",
                                       is_stable_version("version").alias("stable"))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    table = spark.sql("SELECT version_seq(version) FROM versions_in")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in table and len(set(re.findall(r"\*\((\d+)\)", table))) == 1  # one codegen stage


def test_shrinking_to_any_limit(spark):
    register_functions(spark)
    values = [0, 1, 9, 10, 99, 999, 1000, 9223372036, 9223372037, 92233720369, 2 ** 63 - 1, 12345678]
    df = spark.createDataFrame([(v,) for v in values], "v long")
    df.createOrReplaceTempView("longs_in")
    got = spark.sql("SELECT v, shrink_long(v, 9999L) AS a, shrink_long(v, 9223372036L) AS b, shrink_long(v, 5L) AS c "
                    "FROM longs_in").collect()
    want = df.select("v", shrink_to_digits(F.col("v"), 4).alias("a"), shrink_year(F.col("v")).alias("b")).collect()
    assert {r.v: (r.a, r.b) for r in got} == {r.v: (r.a, r.b) for r in want}

    def shrunk(v):
        while v > 5:
            v //= 10
        return v

    assert {r.v: r.c for r in got} == {v: shrunk(v) for v in values}


def test_other_functions_in_a_database(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS gavlake_fn")
    names = register_functions(spark, "gavlake_fn")
    assert {"version_seq", "json_table", "download_command"} <= set(names)
    df = spark.createDataFrame(
        [("org.a.b.c", "x", "1.0", "jar", None, "PRESENT", 1500), ("flat", "y", "2", "zip", "bin", "odd", -1),
         (None, "z", None, None, "c", None, None), ("a.b", "'q", "3", "jar", "", "NOT_AVAILABLE", 253402300799500)],
        "g string, a string, v string, e string, c string, n string, ms long")
    df.createOrReplaceTempView("files_in")
    f = "gavlake_fn."
    got = spark.sql(f"SELECT {f}content_key(g) AS k, {f}group_prefix(g, 2) AS p, {f}availability_code(n) AS n, "
                    f"{f}epoch_ms_to_datetime(ms) AS t, {f}download_command(g, a, v, e, c) AS d FROM files_in")
    want = df.select(content_key("g").alias("k"), group_prefix("g", 2).alias("p"), availability_code("n").alias("n"),
                     epoch_ms_to_datetime("ms").alias("t"), download_command("g", "a", "v", "e", "c").alias("d"))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
