"""op4: components against all pairs."""

from __future__ import annotations

import random
import re
import string

from llm_text import prose

from gavlake.llm import jaccard_join as jj
from gavlake.llm.components import components
from gavlake.llm.jaccard_join import jaccard_components, one_per_component

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def shingle_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if len(words) < 5:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[i:i + 5]) for i in range(len(words) - 4))


def all_pairs(rows):
    """Per row (n, component) by comparing every pair."""
    sets = [shingle_set(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            common = len(a & sets[j])
            if common and 100 * common >= 80 * (len(a) + len(sets[j]) - common):
                parent[find(i)] = find(j)
    ids: dict = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            ids[find(i)] = min(doc, ids.get(find(i), doc))
    return [(doc, len(sets[i]), ids.get(find(i)) if sets[i] else doc) for i, (doc, _) in enumerate(rows)]


def check(docs, rows):
    got = [(r.doc_id, r.n_shingles, r.component_id) for r in jaccard_components(docs).collect()]
    assert sorted(got, key=str) == sorted(all_pairs(rows), key=str)


def test_table(small):
    check(small, [(r.doc_id, r.text) for r in small.collect()])


def test_edge_cases(edge_docs, edge_rows, no_docs):
    check(edge_docs, [(r[0], r[1]) for r in edge_rows])
    assert jaccard_components(no_docs).collect() == []


def test_near_copies_at_the_threshold(spark):
    """Variants of a few texts around similarity 0.8, exact thresholds, sizes and chains."""
    r = random.Random(5)
    rows = []
    for base in range(6):
        words = prose(100 + base, r.choice([9, 24, 60, 150])).split()
        words = [f"{w}{i}" for i, w in enumerate(words)]
        for _ in range(40):
            own = list(words)
            for _ in range(r.randint(0, max(1, len(own) // 20))):
                own[r.randrange(len(own))] = f"new{r.randrange(10 ** 6)}"
            rows.append((len(rows), " ".join(own[r.randint(0, 2):])))
    # exactly at the threshold: 8 of 10 n-grams, and just below: 7 of 9
    rows += [(900, "a b c d e f g h i j k l m"), (901, "a b c d e f g h i j k l x")]
    rows += [(902, " ".join(f"q{i}" for i in range(14))), (903, " ".join(f"q{i}" for i in range(12)))]
    check(spark.createDataFrame(rows, "doc_id long, text string"), rows)


def test_hot_group(spark):
    """A third of all rows are copies and another third near copies of one text."""
    base = [f"w{i}" for i in range(80)]
    rows = []
    for i in range(600):
        if i % 3 == 0:
            rows.append((i, " ".join(base)))
        elif i % 3 == 1:
            own = list(base)
            own[i % 80] = f"v{i}"
            rows.append((i, " ".join(own)))
        else:
            rows.append((i, prose(1000 + i, 40)))
    check(spark.createDataFrame(rows, "doc_id long, text string"), rows)


def test_one_stays(spark, edge_docs, edge_rows, no_docs):
    got = one_per_component(edge_docs)
    assert got.columns == edge_docs.columns
    kept = [(r.doc_id, r.text) for r in got.collect()]
    comps = {}
    for (i, t, *_), (_, n, c) in zip(edge_rows, all_pairs([(r[0], r[1]) for r in edge_rows])):
        comps.setdefault((c, "set") if n else (len(comps), "alone"), []).append((i, t))
    assert len(kept) == len(comps)
    assert (1, edge_rows[0][1]) in kept and 7 not in [i for i, _ in kept] and 8 not in [i for i, _ in kept]
    assert one_per_component(no_docs).collect() == []


def test_components_of_chains(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 101), (101, 100), (7, 7), (200, 199)]
    df = spark.createDataFrame(edges, "a long, b long")
    roots = {r.v: r.root for r in components(df).collect()}
    assert len({roots[i] for i in range(61)}) == 1
    assert roots[100] == roots[101] != roots[0] and roots[199] == roots[200]
    assert components(df.limit(0)).collect() == []


def test_prefixes_of_short_texts_are_dealt_evenly(spark, monkeypatch):
    """Texts of one to nine words: no fragment holds a large share of the postings."""
    rows = [(i, prose(i, 1 + i % 9) + f" title{i}") for i in range(4_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    fragments = jj._fragments(spark, 8_000, False)
    sizes = [(r.fragment, len(r.tokens) // 4)
             for r in jj._postings(docs, fragments, jj.SHINGLE_WORDS, jj.SIMILARITY_PCT, False).collect()]
    held = {}
    for f, n in sizes:
        held[f] = held.get(f, 0) + n
    assert set(held) <= set(range(fragments))
    assert max(held.values()) < 4 * sum(held.values()) / fragments
    assert jj._fragments(spark, 100 * fragments * jj.FRAGMENT_POSTINGS, False) >= 100 * fragments
    # many more fragments give the same components
    rows = rows[:150] + [(10_000 + i, t.upper()) for i, t in rows[:150:2]]
    monkeypatch.setattr(jj, "FRAGMENT_POSTINGS", 5)
    check(spark.createDataFrame(rows, "doc_id long, text string"), rows)


def test_rounds_grow_with_the_logarithm_whatever_the_numbering(spark, monkeypatch):
    """Chains numbered in order, from both ends and at random, a star and a grid."""
    import random

    import gavlake.llm.components as cc
    rounds = []
    real = cc.staged
    monkeypatch.setattr(cc, "staged", lambda df, name: rounds.append(name) or real(df, name))
    n = 1_024
    mixed = list(range(n))
    random.Random(1).shuffle(mixed)
    for links in ([(i, i + 1) for i in range(n)], [(mixed[i], mixed[i + 1]) for i in range(n - 1)],
                  [(i, n - i) for i in range(n // 2)] + [(n - i, i + 1) for i in range(n // 2)],
                  [(0, i) for i in range(1, n)]):
        rounds.clear()
        roots = {r.v: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
        assert len(set(roots.values())) == 1 and set(roots.values()) <= set(roots)
        assert rounds.count("hooks") < 15
