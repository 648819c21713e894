"""op9: matches against all windows; the index against all items."""

from __future__ import annotations

import random

import numpy as np
from llm_text import prose

from gavlake.llm import decontaminate as dc


def test_every_item_within_the_radius_is_found():
    rng = np.random.default_rng(3)
    b = dc.Benchmark(list(range(50)), [prose(i, 30) for i in range(50)], {}, 50)
    for _ in range(300):
        i = int(rng.integers(50))
        bits = np.unpackbits(b.prints[i])
        bits[rng.choice(128, int(rng.integers(0, dc.RADIUS + 1)), replace=False)] ^= 1
        near = np.packbits(bits)
        far = np.unpackbits(b.prints ^ near, axis=1).sum(axis=1)
        assert sorted(x for x, _ in b.within(near)) == np.flatnonzero(far <= dc.RADIUS).tolist()


def words_of(text):
    return "".join(c if (c.isascii() and c.isalnum()) or ord(c) > 127 else " " for c in text.lower()).split()


def brute(docs, items):
    """(doc, item) pairs of which some window of the item's size has the similarity, by all windows."""
    def grams(words):
        out = {}
        for i in range(len(words) - 4):
            out[tuple(words[i:i + 5])] = out.get(tuple(words[i:i + 5]), 0) + 1
        return out

    items = [(i, words_of(t)) for i, t in items if t]
    items = [(i, w) for i, w in items if len(w) >= 5]
    held = {}
    for _, w in items:
        for g in set(grams(w)):
            held[g] = held.get(g, 0) + 1
    weight = lambda g: np.log1p(len(items) / held.get(g, 1))
    out = set()
    for d, t in docs:
        words = words_of(t or "")
        own = set(grams(words))
        for i, w in items:
            b = grams(w)
            if not own & set(b):
                continue  # similarity 0 everywhere
            for at in range(-len(w) + 5, len(words) - 4):
                a = grams(words[max(0, at):at + len(w)])
                low = sum(min(n, b[g]) * weight(g) for g, n in a.items() if g in b)
                both = sum(n * weight(g) for x in (a, b) for g, n in x.items())
                if low and low / (both - low) >= dc.SIMILARITY:
                    out.add((d, i))
                    break
    return out


def test_against_all_windows(spark):
    r = random.Random(1)
    items = [(i, prose(500 + i, r.randint(15, 50))) for i in range(25)]
    docs = []
    for d in range(60):
        words = prose(2000 + d, r.randint(20, 120)).split()
        if d % 2:
            w = items[r.randrange(25)][1].split()
            kind = d % 5
            if kind == 1:
                w[-1] = "changed"
            elif kind == 2:
                w = [x.upper() + "!!" for x in w]
            elif kind == 3:
                w = w[: len(w) // 2]
            at = r.randrange(len(words))
            words[at:at] = w
        docs.append((d, " ".join(words)))
    docs += [(100, items[0][1]), (101, None), (102, ""), (103, items[3][1] + " " + items[4][1])]
    ds = spark.createDataFrame(docs, "doc_id long, text string")
    bs = spark.createDataFrame(items, "item_id long, text string")
    got = dc.contaminated(ds, bs).collect()
    want = brute(docs, items)
    assert {(r.doc_id, r.item_id) for r in got} == want and len(want) > 20
    assert all(r.similarity >= dc.SIMILARITY - 1e-9 for r in got)
    kept = {r.doc_id for r in dc.decontaminated(ds, bs).collect()}
    assert kept == {d for d, _ in docs} - {d for d, _ in want}


def test_several_passes_equal_one(spark, small, monkeypatch):
    bench = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    one = {(r.doc_id, r.item_id) for r in dc.contaminated(small, bench).collect()}
    monkeypatch.setattr(dc, "ITEMS_PER_PASS", 7)
    more = {(r.doc_id, r.item_id) for r in dc.contaminated(small, bench).collect()}
    assert one == more and one


def test_edge_cases(spark, edge_docs, edge_rows, no_docs):
    items = spark.createDataFrame([(1, prose(2, 120)), (1, prose(2, 120)), (2, None), (3, ""), (4, "two words"),
                                   (None, prose(3, 30))], "item_id long, text string")
    got = [(r.doc_id, r.item_id) for r in dc.contaminated(edge_docs, items).collect()]
    # rows 1 (twice), 7 and 8 match both rows of item 1; the row without an id matches the item without one
    assert sorted(got, key=str) == sorted([(1, 1)] * 4 + [(7, 1)] * 2 + [(8, 1)] * 2 + [(None, None)], key=str)
    kept = dc.decontaminated(edge_docs, items)
    assert kept.columns == edge_docs.columns and kept.count() == len(edge_rows) - 5
    assert dc.contaminated(no_docs, items).collect() == [] and dc.decontaminated(no_docs, items).collect() == []
    assert dc.decontaminated(edge_docs, items.limit(0)).count() == len(edge_rows)


def test_weights_are_those_of_the_whole_benchmark(spark, monkeypatch):
    """Passages whose boilerplate, held by all items, is reworded: the same result in any passes."""
    shared, second = [f"common{i}" for i in range(24)], [f"second{i}" for i in range(24)]
    items = [(i, " ".join([*(shared if i < 9 else second), *(f"own{i}x{j}" for j in range(40))])) for i in range(12)]
    docs = []
    for d in range(9):
        reworded = items[d][1].split()
        reworded[2], reworded[8] = "new", "other"
        # shingles that only items of other passes hold
        borrowed = [*second[:8], *items[d][1].split()[8:]]
        for k, words in enumerate((reworded, borrowed)):
            docs.append((10 * d + k, " ".join([prose(10 * d + k, 30), *words, prose(500 + 10 * d + k, 30)])))
    ds = spark.createDataFrame(docs, "doc_id long, text string")
    bs = spark.createDataFrame(items, "item_id long, text string")
    want = brute(docs, items)
    assert len(want) == 18
    results = []
    for size in (5_000, 4, 1):
        monkeypatch.setattr(dc, "ITEMS_PER_PASS", size)
        got = dc.contaminated(ds, bs).collect()
        assert {(r.doc_id, r.item_id) for r in got} == want
        results.append(sorted(tuple(r) for r in got))
        if size != 1:
            kept = {r.doc_id for r in dc.decontaminated(ds, bs).collect()}
            assert kept == {d for d, _ in docs} - {d for d, _ in want}
    assert results[0] == results[1] == results[2]
