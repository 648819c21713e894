"""JSON documents as relations, in DataFrames and in SQL."""

from __future__ import annotations

import json
from collections import Counter

import pytest

from gavlake.functions.sql import register_functions
from gavlake.operators.json_docs import json_paths, json_rows_lateral, json_table

DOCS = ["", " \n ", "oops", '{"groupId":', "5", "null", None, '"text"', "[]", "{}",
        '{"groupId":"a","n":7,"x":{"y":[1,{"z":null}],"k.l":"m"}}', '[{"groupId":"b"},2,null,[3]]', '  {"groupId":3}']


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(bytes([k]), d) for k, d in enumerate(DOCS)], "uinfo_md5 binary, json string")


def shown(df):
    return [(r.uinfo_md5[0], *tuple(r)[1:]) for r in df.collect()]


WANT = [(9, 1, None), (10, 1, "a"), (11, 1, "b"), (11, 2, None), (11, 3, None), (11, 4, None), (12, 1, "3")]


@pytest.mark.parametrize("limit", [None, 1, 2, 4, 6, 100])
def test_documents_without_rows_take_no_place_in_the_page(docs, limit):
    assert sorted(shown(json_rows_lateral(docs, limit))) == WANT[:limit]


def test_table_with_path_columns_and_ordinality(docs):
    got = json_table(docs, "json", {"g": "$.groupId", "n": ("$.n", "int")})
    assert sorted(shown(got), key=str) == [(k, i, g, 7 if k == 10 else None) for k, i, g in
                                           sorted(WANT, key=str)]
    inner = json_table(docs, "json", {"v": ("$", "bigint")}, path="$.x.y", ordinality="at")
    assert sorted(shown(inner), key=str) == [(10, 1, 1), (10, 2, None)]
    outer = json_table(docs, "json", {"g": "$.groupId"}, ordinality=None, outer=True)
    assert Counter(r[0] for r in shown(outer)) == Counter({k: 4 if k == 11 else 1 for k in range(13)})
    with pytest.raises(ValueError, match="there already"):
        json_table(docs, "json", {"uinfo_md5": "$"})


def test_table_function(spark, docs):
    register_functions(spark)
    docs.createOrReplaceTempView("json_docs")
    got = spark.sql("""SELECT uinfo_md5, t.rowid, t.cols['g'] AS g
                       FROM json_docs d, LATERAL json_table(d.json, '$', map('g', '$.groupId')) t""")
    assert sorted(shown(got)) == WANT
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Join" not in plan


def test_every_path_with_its_types(docs):
    kinds = {str: "STRING", int: "BIGINT", bool: "BOOLEAN", type(None): "VOID", list: "ARRAY", dict: "OBJECT"}
    want = Counter()

    def walk(path, v):
        want[path, kinds[type(v)]] += 1
        for k, x in (v.items() if isinstance(v, dict) else ()):
            walk(f"{path}.{k}", x)
        for x in (v if isinstance(v, list) else ()):
            walk(f"{path}[*]", x)

    for d in DOCS:
        try:
            walk("$", json.loads(d or ""))
        except ValueError:
            continue
    got = json_paths(docs)
    assert {(r.path, r.type): r.n_values for r in got.collect()} == dict(want)
    assert json_paths(docs.limit(0)).collect() == []
