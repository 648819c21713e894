"""op1: chunks, likeness and edited texts against plain Python."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa

from gavlake.llm import fingerprint as fp


def slow_chunks(text):
    """Chunks by a byte loop: cut behind a byte whose hash matches the mask of the size so far."""
    data = text.encode()
    gear = (fp.mix(np.arange(1, 257, dtype=np.uint64)) & np.uint64(0xFFFFFFFF)).tolist()
    h, seen = 0, []
    for byte in bytes(32) + data:
        h = (2 * h + gear[byte]) & 0xFFFFFFFF
        seen.append(h)
    seen = seen[32:]
    out, at = set(), 0
    while at < len(data):
        end = min(at + fp.MOST, len(data))
        for p in range(at + fp.LEAST, end):
            if seen[p - 1] & (fp.STRICT if p < at + fp.NORMAL else fp.LOOSE) == 0:
                end = p
                break
        out.add(data[at:end])
        at = end
    return out


def expected(rows):
    """{(doc_id, text): [(n_chars, sha, near_edited, near_next)]} by definition."""
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0), reverse=True)
    texts = [r[1] or "" for r in order]

    def like(a, b):
        a, b = slow_chunks(a), slow_chunks(b)
        total = sum(map(len, a))
        return sum(len(c) for c in a & b) / total if total else float(not b)

    out = []
    for i, text in enumerate(texts):
        after, half = texts[(i + 1) % len(texts)], len(text) // 2
        edited = text[:len(text) - half] + after[:half]
        out.append((order[i][0], len(text), hashlib.sha256(edited.encode()).hexdigest(),
                    like(text, edited), like(text, after)))
    return out


def close(got, want):
    assert len(got) == len(want)
    for a, b in zip(sorted(got, key=str), sorted(want, key=str)):
        assert a[:3] == b[:3]
        assert abs(a[3] - b[3]) < 1e-9 and abs(a[4] - b[4]) < 1e-9, (a, b)


def rows_of(df):
    return [(r.doc_id, r.n_chars, r.edited_sha256, r.near_edited, r.near_next) for r in df.collect()]


def test_against_plain_python(spark, small):
    rows = [(r.doc_id, r.text) for r in small.select("doc_id", "text").collect()]
    close(rows_of(fp.fingerprints(small)), expected(rows))


def test_edge_cases(edge_docs, edge_rows):
    # ids that are not tied: the order among equal ids is by a hash of the text
    ids = [2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12]
    docs = edge_docs.where(edge_docs.doc_id.isin(ids))
    got = fp.fingerprints(docs)
    close(rows_of(got), expected([r for r in edge_rows if r[0] in ids]))
    by_text = {}
    for r in fp.fingerprints(edge_docs).collect():
        by_text.setdefault(r.n_chars, set()).add(r.fingerprint)
    assert fp.fingerprints(edge_docs).count() == len(edge_rows)
    assert by_text[0] == {""}


def test_empty_and_single(spark, no_docs):
    assert fp.fingerprints(no_docs).collect() == []
    lone = fp.fingerprints(spark.createDataFrame([(5, "some words " * 40)], "doc_id long, text string")).collect()
    assert len(lone) == 1 and lone[0].near_next == 1.0


def test_shift_resistance():
    r = np.random.default_rng(0)
    text = "".join(r.choice(list("abcdefgh "), 8000))
    moved, = fp.chunk_sets(pa.array(["inserted " + text]))
    own, = fp.chunk_sets(pa.array([text]))
    assert fp.containment(own, moved) > 0.97
    assert fp.containment(own, own) == 1.0
    assert all(n <= fp.MOST for n in own.values())
