"""op5 and op10: held-out accuracy, label model, risk and edge cases."""

from __future__ import annotations

import numpy as np
import pytest

from gavlake.llm import quality as ql
from gavlake.llm import toxicity as tx

DIR = "/root/testdata/sf0.1"


def auc(score, label):
    order = np.argsort(score)
    rank = np.empty(len(score))
    rank[order] = np.arange(1, len(score) + 1)
    for s in np.unique(score):
        rank[score == s] = rank[score == s].mean()
    n = label.sum()
    return (rank[label == 1].sum() - n * (n + 1) / 2) / (n * (len(label) - n))


@pytest.mark.parametrize("run,column,least", [(tx.toxicity, "toxic", 0.95), (ql.quality, "quality", 0.98)])
def test_held_out(spark, run, column, least):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    labels = spark.read.parquet(f"{DIR}/labels.parquet")
    rows = run(docs, labels).join(labels, "doc_id").where("held_out").collect()
    score, label = np.array([r.score for r in rows]), np.array([r[column] for r in rows])
    assert len(rows) > 500 and auc(score, label) > least
    assert ((score >= (0.5 if column == "toxic" else 0.3)) == [r.predicted == 1 for r in rows]).all()


@pytest.mark.parametrize("run,column", [(tx.toxicity, "toxic"), (ql.quality, "quality")])
def test_edge_cases(spark, edge_docs, edge_rows, no_docs, run, column):
    labels = spark.createDataFrame([(1, 1), (7, 0), (8, None), (None, 1), (9, 1), (9, 0), (10, 0), (99, 1), (11, 0)],
                                   f"doc_id long, {column} int")
    rows = run(edge_docs, labels).collect()
    assert len(rows) == len(edge_rows)
    assert all(0 <= r.score <= 1 and r.predicted in (0, 1) and r.held_out is not None for r in rows)
    by_id = {}
    for r in rows:
        by_id.setdefault(r.doc_id, set()).add(r.score)
    assert len(by_id[1]) == 1 and by_id[2] == by_id[3]  # repeated rows; null and empty texts
    assert run(no_docs, labels).collect() == []
    assert len(run(edge_docs, labels.limit(0)).collect()) == len(edge_rows)


def local_passes(votes, parts=3):
    """Passes over distinct vote patterns, in parts as tasks would take them."""
    pattern, n = np.unique(votes, axis=0, return_counts=True)
    cut = np.array_split(np.arange(len(pattern)), parts)
    return lambda model, moments: np.sum(
        [model.sums(pattern[c].astype(bool), n[c].astype(float), moments) for c in cut], axis=0)


def test_label_model_finds_accuracies_and_correlations_from_votes_alone():
    r = np.random.default_rng(0)
    y = r.random(20000) < 0.15
    fire = lambda yes, no: np.where(y, r.random(len(y)) < yes, r.random(len(y)) < no)
    a, b, c, d = fire(0.6, 0.01), fire(0.5, 0.02), fire(0.4, 0.01), fire(0.5, 0.01)
    votes = np.stack([a, b, c, d, a], axis=1)  # the fifth copies the first
    model = tx.fit_label_model(5, local_passes(votes))
    assert abs(model.rate[1, 1] - 0.5) < 0.08 and abs(model.rate[1, 3] - 0.5) < 0.08
    assert model.correlations[0, 4] > 0.7 > 0.3 > model.correlations[0, 1]
    post = model.posterior(votes)
    assert auc(post, y.astype(int)) > 0.93
    # voters that disagree decide by their rates, so the posterior is no voter's copy
    assert 0.01 < model.posterior(np.array([[0, 0, 1, 0, 0]], bool))[0] < 0.999
    assert auc(post, y.astype(int)) > max(auc(v.astype(float), y.astype(int)) for v in (a, b, c, d))


def toxic_corpus(spark, n=3_000, labelled=90):
    """Toxic texts hold four to seven of 40 own words; a few texts have a label, one in 30 of them a wrong one."""
    r = np.random.default_rng(4)
    bad = ["zz" + "".join(r.choice(list("aeioukrt"), 5)) for _ in range(40)]
    plain = ["".join(r.choice(list("abdeginorstu"), r.integers(3, 8))) for _ in range(400)]
    rows, labels = [], []
    for i in range(n):
        toxic = r.random() < 0.15
        words = list(r.choice(plain, 40)) + (list(r.choice(bad, r.integers(4, 8))) if toxic else [])
        r.shuffle(words)
        rows.append((i, " ".join(words), int(toxic)))
    held = spark.createDataFrame(rows, "doc_id long, text string, truth int")
    out = held.select("*", tx.held_out(tx.HELD_OUT, tx.FOLDS).alias("out")).collect()
    learn = [x for x in out if not x.out]
    labels = [(x.doc_id, x.truth if k % 30 else 1 - x.truth) for k, x in enumerate(learn[:labelled])]
    return held, spark.createDataFrame(labels, "doc_id long, toxic int")


def test_unlabelled_texts_and_the_label_model_add_to_labels_and_lexicon(spark, monkeypatch):
    monkeypatch.setattr(tx, "VOTER_PRECISION", 0.85)  # the few labelled texts allow no finer share
    docs, labels = toxic_corpus(spark)
    rows = tx.toxicity(docs, labels).join(docs.select("doc_id", "truth"), "doc_id").where("held_out").collect()
    truth = np.array([r.truth for r in rows])
    whole = auc(np.array([r.score for r in rows]), truth)

    def scored(model):
        got = {r.doc_id: r.score for r in tx.score_toxicity(docs, model).where("held_out").collect()}
        return auc(np.array([got[r.doc_id] for r in rows]), truth)

    # the same terms' miner and linear model on the labels alone
    labelled = tx.training_rows(docs, labels, "toxic")
    terms = [t for t, _ in tx.telling_terms(labelled)]
    x, gold = tx._features(labelled, terms, "label")
    label_only = scored((terms, tx.fit_linear(x.astype(float), gold)))
    words = [tx.word_term(w) for w in tx.LEXICON]
    lexicon_only = scored((words, np.append(np.ones(len(words)), [0.0, 0.0, 0.0, -3.0])))
    assert whole > label_only + 0.05 and whole > lexicon_only + 0.3, (whole, label_only, lexicon_only)


def test_posterior_differs_from_labels_where_voters_disagree(spark, monkeypatch):
    monkeypatch.setattr(tx, "VOTER_PRECISION", 0.85)
    docs, labels = toxic_corpus(spark)
    labelled = tx.training_rows(docs, labels, "toxic").select("doc_id", "text", "label")
    voters = tx.choose_voters(labelled)
    model = tx.fit_label_model(len(voters), tx.passes(tx.vote_patterns(docs, voters), len(voters)))
    post = {r.doc_id: r.post for r in tx.posteriors(labelled, voters, model).collect()}
    rows = labelled.join(docs.select("doc_id", "truth"), "doc_id").collect()
    wrong = [r for r in rows if r.label != r.truth]
    assert len(wrong) >= 3 and any((post[r.doc_id] >= 0.5) != bool(r.label) for r in wrong)


def plain_scores(texts, terms, weights):
    """The classifier's scores in plain Python: words and beginnings counted one by one."""
    import re

    index = {t: k for k, t in enumerate(terms)}
    out = []
    for text in texts:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" or ("À" <= c <= "Þ" and c != "×") else c for c in text or "")
        n = np.zeros(len(terms))
        for word in re.findall(r"[a-z\u0080-\U0010FFFF]+", low):
            raw = word.encode()
            hasher = tx.SpanHasher(1 << 10)
            at = np.frombuffer(raw, np.uint8)
            keys = [int(tx.mix(hasher(at, np.array([0]), np.array([len(raw)])))[0])]
            keys += [(int(hasher(at, np.array([0]), np.array([k]))[0]) + k) % (1 << 64)
                     for k in tx.BEGINNINGS if len(raw) > k]
            for key in keys:
                if key in index:
                    n[index[key]] += 1
        raw = np.frombuffer((text or "").encode(), np.uint8)
        flags = tx.patterns_of(raw, np.array([0, len(raw)]))[0]
        z = np.minimum(n, tx.LEVELS) @ weights[:len(terms)] + flags @ weights[len(terms):-1] + weights[-1]
        out.append(1 / (1 + np.exp(-z)))
    return out


def test_scores_equal_plain_arithmetic(spark, small):
    terms = [tx.word_term(w) for w in ("the", "idiot", "réeux")]
    hasher = tx.SpanHasher(1 << 10)
    raw = np.frombuffer(b"ther", np.uint8)
    terms.append((int(hasher(raw, np.array([0]), np.array([4]))[0]) + 4) % (1 << 64))
    weights = np.array([0.3, 2.0, 1.5, -0.7, 0.9, 0.8, 0.6, -2.0])
    rows = small.select("doc_id", "text").collect()
    got = {r.doc_id: r.score for r in tx.score_toxicity(small, (terms, weights)).collect()}
    want = plain_scores([r.text for r in rows], terms, weights)
    assert np.allclose([got[r.doc_id] for r in rows], want)


def test_class_prior_and_risk():
    r = np.random.default_rng(1)
    good = np.stack([r.integers(0, 4, 4000), 4 + r.integers(0, 2, 4000)], axis=1)
    bad = np.stack([r.integers(3, 6, 1000) % 4 + 0, 4 + np.full(1000, 2)], axis=1)
    web = np.concatenate([np.stack([r.integers(0, 4, 3000), 4 + r.integers(0, 2, 3000)], axis=1), bad])
    prior = ql.class_prior(good, web, 7)
    assert abs(prior - 0.75) < 0.06
    w = ql.fit_positive_unlabelled(good, web, 7, prior)
    score = w[web].sum(axis=1) + w[-1]
    assert auc(score, (np.arange(len(web)) < 3000).astype(int)) > 0.99


def test_terms_are_found_with_their_counts():
    import pyarrow as pa

    terms = [tx.word_term("idiot"), tx.word_term("réeux")]
    rows, found, times, flags = tx.Finder(terms).hits(
        pa.array(["An IDIOT, idiot!", None, "", "idiots", "RÉEUX réeux x", "AAA!!! BBB!!!"]))
    assert list(zip(rows.tolist(), found.tolist(), times.tolist())) == [(0, 0, 2), (4, 1, 2)]
    assert flags[5].tolist() == [True, True, False] and flags.shape == (6, 3)
