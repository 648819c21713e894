"""op3: jump hash against a scalar loop; sizes, slots and growth."""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np

from gavlake.llm.sharding import assign_shards, jump


def slow_jump(key, shards):
    key %= 1 << 64
    b, j = -1, 0
    while j < shards:
        b = j
        key = (key * 2862933555777941757 + 1) % (1 << 64)
        j = int((b + 1) * (float(1 << 31) / ((key >> 33) + 1)))
    return b


def test_jump_against_the_loop():
    keys = np.random.default_rng(0).integers(-(1 << 63), 1 << 63, 3000, dtype=np.int64)
    for shards in (1, 2, 16, 17, 1000):
        assert jump(keys, shards).tolist() == [slow_jump(int(k), shards) for k in keys]
    assert len(jump(np.zeros(0, np.int64), 5)) == 0


def check(got, rows):
    want = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows)
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == want
    slots: dict = {}
    shard_of: dict = {}
    for r in got:
        assert r.law == "key" and 0 <= r.shard < 16
        assert r.grown_shard in (r.shard, 16)
        assert shard_of.setdefault(r.doc_id, (r.shard, r.grown_shard)) == (r.shard, r.grown_shard)
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_table(small):
    got = assign_shards(small).collect()
    check(got, [(r.doc_id, r.text) for r in small.collect()])
    again = {r.doc_id: (r.shard, r.slot) for r in assign_shards(small).collect()}
    assert again == {r.doc_id: (r.shard, r.slot) for r in got}


def test_edge_cases(edge_docs, edge_rows, no_docs):
    check(assign_shards(edge_docs.repartition(3)).collect(), [(r[0], r[1]) for r in edge_rows])
    assert assign_shards(no_docs).collect() == []


def test_hot_key_has_gapless_slots(spark):
    df = spark.range(3000, numPartitions=7).selectExpr("if(id % 3 = 0, 5, id) as doc_id", "'t' as text")
    check(assign_shards(df).collect(), [(5 if i % 3 == 0 else i, "t") for i in range(3000)])
