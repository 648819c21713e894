"""Divergence of sources against plain dense arithmetic; its SQL is checked with the other queries'."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_text import prose

from gavlake.llm import source_divergence as s

TERM = re.compile("[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def brute(rows, min_df=3, top=200):
    """Every group with every kept term of its language."""
    docs = [(lang or "", source or "", Counter(TERM.findall((text or "").translate(LOWER))))
            for text, lang, source in rows]
    out = []
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        df = Counter(t for _, _, c in own for t in c)
        kept = [t for t in df if df[t] >= min_df]
        groups = defaultdict(Counter)
        for _, source, c in own:
            groups[source].update(c)
            groups[None].update(c)

        def chances(count, kept=kept):
            n = sum(count[t] for t in kept) + len(kept)
            return {t: 1 + 10**9 * (count[t] + 1) // n for t in kept}

        p = {g: chances(c) for g, c in groups.items()}
        f = lambda a, b: (a - b) * (a - b) // b
        for source in groups.keys() - {None}:
            pair = [(sum(f(p[source][t], p[o][t]) for t in kept), o) for o in groups.keys() - {None, source}]
            term = [(f(p[source][t], p[None][t]), t) for t in kept
                    if groups[source][t] and p[source][t] > p[None][t]]
            for part, items in (("pair", pair), ("term", term)):
                items.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, source, part, item, v, k) for k, (v, item) in enumerate(items, 1)
                        if part == "pair" or k <= top]
    return sorted(out)


def test_vectors():
    texts = ["Ab ab-é1É", "", "x" * 10 + " Ab"]
    raw = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.cumsum([0, *[len(t.encode()) for t in texts]])
    terms, row, term, count = s.document_vectors(raw, offsets)
    got = {(int(r), terms[int(t)].as_py()): int(c) for r, t, c in zip(row, term, count, strict=True)}
    assert got == {(0, "ab"): 2, (0, "é"): 1, (0, "É"): 1, (2, "xxxxxxxxxx"): 1, (2, "ab"): 1}


@pytest.mark.parametrize("min_df, top", [(3, 200), (1, 2), (100, 5)])
def test_equals_dense_arithmetic(spark, edge_docs, edge_rows, min_df, top):
    got = s.source_divergence(edge_docs, min_df, top)
    assert sorted(map(tuple, got.collect())) == brute([r[1:4] for r in edge_rows], min_df, top)


def test_a_hot_group_and_ties(spark):
    # a third of the rows in one group, terms of equal counts, groups without kept terms
    rows = [(prose(k % 40, 60), "en", "hot") for k in range(60)]
    rows += [(prose(100 + k, 30), "en", f"s{k % 7}") for k in range(60)]
    rows += [(f"alpha beta gamma d{'x' * (k % 3)}", "de", f"t{k % 2}") for k in range(30)]
    rows += [("1 2 3", "en", "none"), (None, "en", None), ("solo", "fr", "a"), ("solo", "fr", "b"), ("", None, "c")]
    docs = spark.createDataFrame(rows, "text string, lang string, source string").repartition(5)
    assert sorted(map(tuple, s.source_divergence(docs, top_terms=4).collect())) == brute(rows, top=4)


def test_no_rows(no_docs):
    assert s.source_divergence(no_docs).collect() == []


def test_counts_beyond_a_long(spark):
    """1e9 * (count + 1) outgrows 64 bits from 9.2e9 occurrences on."""
    p = spark.range(1).selectExpr("cast(20000000000 as bigint) as n", "cast(30000000000 as bigint) as total",
                                  "cast(5 as bigint) as terms").selectExpr(f"{s._probability('n', 'total')} as p")
    assert p.first().p == 1 + 10**9 * (20 * 10**9 + 1) // (30 * 10**9 + 5)
