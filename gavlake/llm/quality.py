"""Quality classification by positive-unlabelled learning.

Trusted positives are the training rows that are labelled good; bad labels are not used. The
other side is unlabelled web text, a mixture of good and bad. A classifier is trained by
the non-negative unbiased risk estimator: with the class prior p,
``p R+(good) + max(0, R-(unlabelled) - p R-(good))``, where a negative second part (which only
overfitting makes) is pushed back up. The prior is estimated from scores that tell positives
from unlabelled text: the smallest ratio of unlabelled to positive mass above a score.

Features are shares of characters, words, lines and repetitions of the whole text, each cut into bins at
quantiles, so that the linear model is additive in free functions of them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gavlake.llm.language import held_out
from gavlake.llm.scratch import ship_by_value, small_batches
from gavlake.llm.text import SpanHasher, lower_ascii, runs, shingles, spaces, text_slices
from gavlake.llm.toxicity import FOLDS, HELD_OUT, TRAIN_ROWS, training_rows

THRESHOLD = 0.3
BINS = 12
FEATURES = ("capitals", "digits", "exclaims", "symbols", "pipes", "commas", "stops", "blanks", "non_ascii",
            "bytes", "words", "word_bytes", "word_spread", "odd_ends", "shout_words", "repeats",
            "distinct", "pairs", "triples", "line_bytes", "distinct_lines")
#: Steps of the descent and its rate, penalty of squared weights.
STEPS, RATE, PENALTY = 400, 0.1, 1e-4


def _per_row(values, first):
    """Sums of ``values`` from each row's first to the next row's."""
    sums = np.concatenate([[0.0], np.cumsum(values, dtype=float)])
    return sums[first[1:]] - sums[first[:-1]]


def _distinct(h, first):
    """Number of distinct values of each row, by their first 40 bits."""
    row = np.repeat(np.arange(len(first) - 1, dtype=np.uint64), np.diff(first))
    keys = np.sort((row << np.uint64(40)) | (h >> np.uint64(24)))
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    return np.bincount((keys[new] >> np.uint64(40)).astype(np.int64), minlength=len(first) - 1).astype(float)


def features(column) -> np.ndarray:
    """A row of FEATURES for each text; null and empty texts have zeros."""
    hasher, white = SpanHasher(), spaces()
    parts = [np.zeros((0, len(FEATURES)))]
    kinds = np.zeros((256, 9), bool)
    kinds[65:91, 0] = kinds[48:58, 1] = True
    kinds[[ord(c) for c in "!?"], 2] = True
    kinds[[ord(c) for c in "*#$%&@^~=_<>{}[]\\/+"], 3] = True
    kinds[ord("|"), 4] = True
    kinds[[ord(c) for c in ",;:"], 5] = True
    kinds[ord("."), 6] = True
    kinds[:, 7] = white
    kinds[128:, 8] = True
    odd = kinds[:, 2] | kinds[:, 3] | kinds[:, 4]
    for _, raw, offsets in text_slices(column):
        size = np.maximum(np.diff(offsets), 1)
        out = [_per_row(kinds[raw, k], offsets) / size for k in range(9)]
        low = lower_ascii(raw)
        starts, ends, first = runs(~white[low], offsets)
        n = np.maximum(np.diff(first), 1)
        long = (ends - starts).astype(float)
        words = hasher(low, starts, ends)
        mean = _per_row(long, first) / n
        spread = np.sqrt(np.maximum(_per_row(long * long, first) / n - mean * mean, 0))
        last = np.array([0], np.uint8) if not len(raw) else raw[np.maximum(ends - 1, 0)]
        capital = kinds[raw[starts], 0] & kinds[raw[np.minimum(starts + 1, ends - 1)], 0] & (long > 1)
        again = np.zeros(len(words), bool)
        again[1:] = words[1:] == words[:-1]
        again[first[:-1][np.diff(first) > 0]] = False
        pairs, at2 = shingles(words, first, 2)
        triples, at3 = shingles(words, first, 3)
        lines, line_ends, at = runs(raw != 10, offsets)
        n_lines = np.maximum(np.diff(at), 1)
        out += [np.log1p(np.diff(offsets)), np.log1p(np.diff(first)), mean, spread,
                _per_row(odd[last] if len(starts) else np.zeros(0), first) / n,
                _per_row(capital, first) / n, _per_row(again, first) / n,
                _distinct(words, first) / n,
                _distinct(pairs, at2) / np.maximum(np.diff(at2), 1),
                _distinct(triples, at3) / np.maximum(np.diff(at3), 1),
                np.log1p(_per_row(line_ends - lines, at) / n_lines),
                _distinct(hasher(raw, lines, line_ends), at) / n_lines]
        parts.append(np.stack(out, axis=1))
    return np.concatenate(parts)


def bin_edges(x: np.ndarray, bins: int = BINS) -> list[np.ndarray]:
    """Cuts at quantiles, closer together at both ends, of each feature."""
    at = np.sort(np.concatenate([np.linspace(0, 1, bins)[1:-1], [0.01, 0.03, 0.06, 0.94, 0.97, 0.99]]))
    return [np.unique(np.quantile(x[:, f], at)) for f in range(x.shape[1])]


def binned(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    """Index of each feature's bin within one list of all bins."""
    out = np.zeros(x.shape, np.int64)
    base = 0
    for f, cuts in enumerate(edges):
        out[:, f] = base + np.searchsorted(cuts, x[:, f], "right")
        base += len(cuts) + 1
    return out


def _descend(good, unlabelled, n, risk):
    """Weights that minimise a risk, whose gradient by the scores ``risk`` gives (Adam)."""
    w = np.zeros(n + 1)
    m, v = np.zeros(n + 1), np.zeros(n + 1)
    for t in range(1, STEPS + 1):
        sg, su = w[good].sum(axis=1) + w[-1], w[unlabelled].sum(axis=1) + w[-1]
        dg, du = risk(1 / (1 + np.exp(-sg)), 1 / (1 + np.exp(-su)), sg, su)
        grad = PENALTY * w
        grad[:-1] += np.bincount(good.ravel(), np.repeat(dg, good.shape[1]), n)
        grad[:-1] += np.bincount(unlabelled.ravel(), np.repeat(du, unlabelled.shape[1]), n)
        grad[-1] += dg.sum() + du.sum()
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        w -= RATE * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    return w


def class_prior(good: np.ndarray, unlabelled: np.ndarray, n: int) -> float:
    """Share of good texts among the unlabelled ones."""
    def telling(pg, pu, _sg, _su):
        return (pg - 1) / len(pg), pu / len(pu)

    # fitted on one half, read off on the other
    w = _descend(good[::2], unlabelled[::2], n, telling)
    g, u = (w[x[1::2]].sum(axis=1) for x in (good, unlabelled))
    cuts = np.quantile(g, np.linspace(0.0, 0.75, 26))
    ratios = [(u >= c).mean() / max((g >= c).mean(), 1e-9) for c in cuts]
    return float(np.clip(min(ratios), 0.05, 0.98))


def fit_positive_unlabelled(good: np.ndarray, unlabelled: np.ndarray, n: int, prior: float) -> np.ndarray:
    """Weights of the bins by the non-negative risk."""

    def risk(pg, pu, sg, su):
        negative = np.logaddexp(0, su).mean() - prior * np.logaddexp(0, sg).mean()
        up, down = prior * (pg - 1) / len(pg), prior * pg / len(pg)
        if negative >= 0:
            return up - down, pu / len(pu)
        return down, -pu / len(pu)  # push the negative part back up

    return _descend(good, unlabelled, n, risk)


def _sample(rows: DataFrame):
    """Features of a bounded set of rows, in a fixed order."""

    def read(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(features(batch.column("text")).tolist(),
                                                  pa.list_(pa.float64()))], ["doc_id", "x"])

    out = rows.select("doc_id", "text").mapInArrow(read, "doc_id bigint, x array<double>")
    got = out.orderBy("doc_id", "x").collect()
    return np.array([r.x for r in got], float).reshape(-1, len(FEATURES))


def fit_quality(docs: DataFrame, labels: DataFrame):
    """(edges, weights, prior); both sides are samples of about TRAIN_ROWS rows, picked by a hash.

    Without trusted positives the weights are None, and every text scores the threshold.
    """
    good = _sample(training_rows(docs, labels, "quality").where("label = 1"))
    rows = docs.where(~held_out(HELD_OUT, FOLDS)).where("text is not null")
    share = min(1.0, TRAIN_ROWS / max(rows.count(), 1))
    web = _sample(rows.where(F.pmod(F.xxhash64("doc_id", F.lit("web")), F.lit(1_000_000)) < int(share * 1_000_000)))
    if not len(good) or not len(web):
        return [], None, 0.0
    edges = bin_edges(web)
    n = sum(len(c) + 1 for c in edges)
    good, web = binned(good, edges), binned(web, edges)
    prior = class_prior(good, web, n)
    return edges, fit_positive_unlabelled(good, web, n, prior), prior


def score_quality(docs: DataFrame, model) -> DataFrame:
    """(doc_id, held_out, score, predicted) per row of ``docs``, from its text alone.

    Null texts score as empty ones. Rows are independent, so repeated ones score alike;
    other columns are not read.
    """
    edges, weights, _ = model
    small_batches(docs.sparkSession)

    def score(batches):
        for batch in batches:
            if weights is None:
                p = np.full(batch.num_rows, THRESHOLD)
            else:
                x = binned(features(batch.column("text")), edges)
                p = 1 / (1 + np.exp(-np.clip(weights[x].sum(axis=1) + weights[-1], -30, 30)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(p, pa.float64()),
                 pa.array((p >= THRESHOLD).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    rows = docs.select("doc_id", held_out(HELD_OUT, FOLDS).alias("held_out"), "text")
    return rows.mapInArrow(score, "doc_id bigint, held_out boolean, score double, predicted int")


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``score_quality`` by the model that ``docs`` and ``labels`` (doc_id, quality) give."""
    small_batches(docs.sparkSession)
    return score_quality(docs, fit_quality(docs, labels))


ship_by_value(__name__)
