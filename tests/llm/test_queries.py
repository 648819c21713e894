"""The registered queries, and their DuckDB SQL where there is some."""

from __future__ import annotations

import duckdb

from gavlake.llm import queries as q

SF = "/root/testdata/sf0.01"


def test_one_query_per_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in q.REGISTRY) == list(range(1, 14))


def test_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    for name, sql in q.ORACLE.items():
        want = con.sql(sql)
        got = q.REGISTRY[name](spark, SF)
        assert got.columns == want.columns
        assert sorted(map(tuple, got.collect())) == sorted(want.fetchall())
