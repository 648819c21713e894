"""Driver contract: entry / queries / oracle_sql."""

from __future__ import annotations

import importlib.util
import os

from gavlake.schemas import GA

_ENTRY = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "__spark_entry__.py")


def _load():
    spec = importlib.util.spec_from_file_location("spark_entry", _ENTRY)
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    return mod


def test_entry_schema_and_rows(spark):
    df = _load().entry(spark)
    assert df.columns == GA.fieldNames()
    assert df.count() > 0


def test_every_query_has_oracle_sql():
    from gavlake import oracle
    from gavlake.queries import REGISTRY
    mod = _load()
    q, sql = mod.queries(), mod.oracle_sql()
    assert set(REGISTRY) == set(oracle.sql()) <= set(q)
    assert len(REGISTRY) >= 61
    assert set(sql) <= set(q)
