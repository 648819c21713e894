"""op7: forward sums against all segmentations; held-out accuracy."""

from __future__ import annotations

import itertools

import numpy as np

from gavlake.llm import language as lg


def all_segmentations(word, probs):
    total = 0.0
    for cuts in itertools.product([0, 1], repeat=len(word) - 1):
        parts, at = [], 0
        for i, c in enumerate(cuts, 1):
            if c:
                parts.append(word[at:i])
                at = i
        parts.append(word[at:])
        p = 1.0
        for x in parts:
            p *= probs.get(x, 0.0)
        total += p
    return total


def test_forward_sums_all_segmentations():
    rng = np.random.default_rng(2)
    pieces = sorted({bytes(rng.choice(list(b"abc "), rng.integers(1, 5)).tolist()) for _ in range(60)} | {b"a", b"b", b"c", b" "})
    codes = np.unique(np.array([int.from_bytes(p, "big") for p in pieces], np.uint64))
    by_code = {int.from_bytes(p, "big"): p for p in pieces}
    table = rng.random((len(codes), 3))
    probs = [{by_code[int(c)]: table[i, k] for i, c in enumerate(codes)} for k in range(3)]
    words = [bytes(rng.choice(list(b"abc"), 7).tolist()) for _ in range(20)]
    got = lg.word_likelihoods(codes, table, np.frombuffer(b"".join(words), np.uint8).reshape(-1, 7))
    want = np.log([[all_segmentations(w, p) for p in probs] for w in words])
    assert np.allclose(got, want)


def test_fitting_raises_the_likelihood():
    codes = np.unique(np.array([int.from_bytes(p, "big") for p in
                                (b"a", b"b", b" ", b" a", b"ab", b" ab", b"ba", b"bb")], np.uint64))
    counts = {b"abab": 5, b"bb": 1, b"ab": 9}

    def likelihood(rounds):
        probs = lg.fit_pieces(codes, counts, rounds)
        assert abs(probs.sum() - 1) < 1e-9
        return sum(n * lg.word_likelihoods(codes, probs[:, None], np.frombuffer(b" " + w, np.uint8)[None])[0, 0]
                   for w, n in counts.items())

    assert likelihood(0) < likelihood(1) < likelihood(4)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = lg.fit_languages(docs.where(~lg.held_out(2, 4)))
    rows = lg.identify(docs.select("doc_id", "text", "lang", lg.held_out(2, 4).alias("out")), model).collect()
    own = [r for r in rows if r.out]
    assert len(own) > 150 and len(rows) == 1000
    assert sum(r.lang == r.lang_pred for r in own) >= 0.97 * len(own)
    assert all(0 <= r.score <= 1 for r in rows)


def test_edge_cases(spark, edge_docs, edge_rows, no_docs):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = lg.fit_languages(docs)
    got = lg.identify(edge_docs, model)
    assert set(got.columns) == set(edge_docs.columns)  # lang_pred and score replace columns of these names
    rows = got.collect()
    assert len(rows) == len(edge_rows)
    for r in rows:
        letters = r.text is not None and any(c.isalpha() for c in r.text)
        assert (r.lang_pred == "und") == (not letters)
        assert (r.score == 0.0) == (not letters)
    assert lg.identify(no_docs, model).collect() == []
    nothing = lg.fit_languages(no_docs)
    assert {r.lang_pred for r in lg.identify(edge_docs, nothing).collect()} == {"und"}


def test_kept_words_do_not_change_scores(small):
    model = lg.fit_languages(small)
    import pyarrow as pa

    texts = pa.array([r.text for r in small.collect()])
    scorer = lg.Scorer(*model[1:])
    whole = scorer.texts(texts)
    parts = np.concatenate([scorer.texts(texts.slice(i, 7)) for i in range(0, len(texts), 7)])
    assert np.allclose(whole, parts)


def test_long_words_keep_their_whole_sum():
    """Words of 200 bytes: logarithms of the sums over all segmentations, one place after the other."""
    rng = np.random.default_rng(3)
    pieces = sorted({bytes(rng.choice(list(b"abc"), rng.integers(2, 6)).tolist()) for _ in range(50)} | {b"a", b"b", b"c"})
    codes = np.unique(np.array([int.from_bytes(p, "big") for p in pieces], np.uint64))
    by_code = {int.from_bytes(p, "big"): p for p in pieces}
    table = rng.random((len(codes), 2)) * 1e-3
    probs = [{by_code[int(c)]: table[i, k] for i, c in enumerate(codes)} for k in range(2)]
    for size in (33, 64, 200, 201):
        words = [bytes(rng.choice(list(b"abc"), size).tolist()) for _ in range(4)]
        got = lg.word_likelihoods(codes, table, np.frombuffer(b"".join(words), np.uint8).reshape(-1, size))
        for w, row in zip(words, got, strict=True):
            for k in range(2):
                ahead = [0.0] + [-np.inf] * size
                for end in range(1, size + 1):
                    for begin in range(max(0, end - 8), end):
                        p = probs[k].get(w[begin:end])
                        if p:
                            ahead[end] = np.logaddexp(ahead[end], ahead[begin] + np.log(p))
                assert np.isclose(row[k], ahead[size])


def test_a_text_is_not_cut_into_stretches(spark):
    """A text without spaces scores as the one word that it is."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    langs, codes, table = lg.fit_languages(docs)
    word = "überschwänglichkeitsbeteuerungen" * 8
    import pyarrow as pa

    raw = b" " + word.encode()
    want = lg.word_likelihoods(codes, table, np.frombuffer(raw, np.uint8)[None])[0]
    assert np.allclose(lg.Scorer(codes, table).texts(pa.array([word]))[0], want)
