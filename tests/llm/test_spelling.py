"""Spelling variants against all pairs of words."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_text import prose

from gavlake.llm import spelling as s

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def words_of(rows):
    n = Counter()
    for doc_id, text in rows:
        for word in RUN.findall(text or ""):
            word = word.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
            if h % 31 == 0:
                k = h % len(word)
                word = word[:k] + word[k + 1:]
            n[word] += 1
    return {w: c for w, c in n.items() if len(w) >= 7 and c >= 2}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    k = 0
    while k < len(a) and a[k] == b[k]:
        k += 1
    return a != b and (a[k + 1:] == b[k + 1:] if len(a) == len(b) else a[k:] == b[k + 1:])


def brute(n):
    """All pairs with a common deletion (or equal but for one place), then each pair's edits."""
    holes = defaultdict(set)
    for w in n:
        for k in range(len(w)):
            holes[w[:k] + w[k + 1:]].add(w)
        holes[w].add(w)
    near = defaultdict(set)
    for group in holes.values():
        for a in group:
            near[a] |= {b for b in group if one_edit(a, b)}
    form = {}
    for w in n:
        if near[w]:
            best = min(near[w], key=lambda x: (-n[x], x))
            if n[best] >= 10 * n[w]:
                form[w] = best
    out = []
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n[w], len(near[w]), n[form[w]] if w in form else None))
    return sorted(out, key=str)


def result(df):
    return sorted(map(tuple, df.select("word", "form", "root", "n", "n_near", "form_n").collect()), key=str)


def test_checksums():
    words = [b"seven77", b"a", b"x" * 64, b"y" * 65, "é".encode() * 300]
    sizes = np.array([len(w) for w in words])
    plain = np.array([zlib.crc32(w) for w in words], np.uint32)
    prefixes = [b"1:", b":", b"123456:"]
    own = np.tile(np.arange(5), 3)
    start = np.repeat(np.array([zlib.crc32(p) for p in prefixes], np.uint32), 5)
    want = [zlib.crc32(p + w) for p in prefixes for w in words]
    assert s.checksums(start, own, sizes, plain).tolist() == want


def test_scan_finds_what_all_pairs_find():
    r = random.Random(3)
    words = sorted({"pre" + "".join(r.choice("abé") for _ in range(r.choice((4, 5)))) for _ in range(150)})
    shared = [0] + [s._common(a, b) for a, b in zip(words, words[1:], strict=False)]
    for q in words:
        got = [words[i] for i in s.scan(q, words, shared, 0, len(words), 3)]
        assert got == [w for w in words if one_edit(q, w)]


def near_pairs(spark, words):
    df = spark.createDataFrame([(w, k + 1) for k, w in enumerate(words)], "word string, n long")
    return sorted((r.word, r.near, r.near_n) for r in s.near_words(df).collect())


@pytest.mark.parametrize("block", [2_000, 3])
def test_every_pair_once(spark, monkeypatch, block):
    """Edits at every place; with small blocks most halves go over several of them."""
    monkeypatch.setattr(s, "BLOCK_WORDS", block)
    base = ["abcdefg", "abcdefgh", "aaaaaaa", "aaaaaaaa", "ababababab", "éçàüöñß"]
    words = set(base)
    for w in base:
        for k in range(len(w) + 1):
            words |= {w[:k] + "x" + w[k:], w[:k] + "x" + w[k + 1:], w[:k] + w[k + 1:]}
    words = sorted(w for w in words if len(w) >= 7)
    want = sorted((a, b, words.index(b) + 1) for a in words for b in words if one_edit(a, b))
    assert near_pairs(spark, words) == want


def test_a_hot_half(spark, monkeypatch):
    """A third of all words begin alike; their list takes many blocks."""
    monkeypatch.setattr(s, "BLOCK_WORDS", 20)
    r = random.Random(5)
    hot = {"inter" + "".join(r.choice("abcdef") for _ in range(r.choice((4, 5)))) for _ in range(300)}
    other = {"".join(r.choice("abcdefghij") for _ in range(r.randint(7, 10))) for _ in range(600)}
    words = sorted(hot | other)
    holes = sorted((a, b, words.index(b) + 1) for a in words for b in words if one_edit(a, b))
    assert near_pairs(spark, words) == holes


def test_equals_all_pairs(spark, small, edge_docs, edge_rows):
    from gavlake.llm.queries import REGISTRY

    rows = [(r.doc_id, r.text) for r in small.select("doc_id", "text").collect()]
    assert result(REGISTRY["op13_spelling"](spark, "/root/testdata/sf0.001")) == brute(words_of(rows))
    assert result(s.spelling_variants(edge_docs)) == brute(words_of([r[:2] for r in edge_rows]))


def test_chains_ties_and_long_words(spark):
    rows = [(k, t) for k, t in enumerate(
        ["ABCDEFGH " * 5_000, "abcdefgx " * 400, "abcdexgx " * 30, "abcyexgx " * 2, "abcdefgz " * 400,
         "étéétéété étéétéét× " * 3, "w" * 90_000 + " " + "w" * 90_000, "w" * 89_999 + " " + "w" * 89_999,
         prose(9, 3_000), "short words", None, ""])] + [(None, "nullnulls nullnulls nullnull")] * 2
    want = brute(words_of(rows))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert result(s.spelling_variants(df)) == want
    by = {w[0]: w for w in want}
    assert by["abcyexgx"][2] == "abcdefgh" and by["abcyexgx"][1] == "abcdexgx"


def test_no_rows(no_docs):
    assert s.spelling_variants(no_docs).collect() == []
