"""Language identification by segmentation-marginalised unigrams.

Each language has a probability for every piece of a fixed public vocabulary of byte pieces. A
word's probability is the sum over all its segmentations into pieces of the product of their
probabilities, by the forward algorithm; a text's is the product over its words. The
probabilities are learned by expectation maximisation (forward-backward) on the words of a
bounded sample of labelled texts, and the language of the highest posterior wins.

A word is a run of letters (ASCII letters and all non-ASCII characters), lower-cased, with a
space before it; pieces that begin with a space begin a word. Equal words of a batch are
scored once, all words of one length together.
"""

from __future__ import annotations

import base64
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gavlake.llm.scratch import lean_batches, ship_by_value, small_batches
from gavlake.llm.text import SpanHasher, runs, text_slices

#: Ranks of a byte-level vocabulary for many languages (tiktoken format).
VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
#: Labelled documents per language that the model is fitted on, about; a hash of the rows picks them.
TRAIN_DOCS = 250
ROUNDS = 4
#: Longest piece in bytes (a packed 64-bit code), and longest stretch of a word in fitting; scores are of whole words.
PIECE_BYTES, WORD_BYTES = 8, 32
#: Expected uses that every piece is given besides those counted.
SMOOTHING = 0.01
#: Words whose scores a task keeps; then it begins anew.
KEPT_WORDS = 200_000


def read_pieces(path: str = VOCABULARY) -> np.ndarray:
    """Sorted codes (bytes packed into 64 bits) of the pieces that words can hold."""
    codes = []
    with open(path, "rb") as lines:
        for line in lines:
            piece = base64.b64decode(line.split()[0])
            body = piece.removeprefix(b" ")
            if len(piece) <= PIECE_BYTES and all(c >= 128 or 97 <= c <= 122 for c in body):
                codes.append(int.from_bytes(piece, "big"))
    return np.unique(np.array(codes, np.uint64))


def _lookup(codes, wanted):
    """Index of each wanted code, or len(codes) where there is none."""
    at = np.minimum(np.searchsorted(codes, wanted), len(codes) - 1)
    return np.where(codes[at] == wanted, at, len(codes))


def _ends(codes, words):
    """(end, length, rows, pieces): the pieces of the words (rows of bytes) by where they end."""
    n = words.shape[1]
    packed = words.astype(np.uint64)
    shorter = None
    found = {}
    for size in range(1, min(PIECE_BYTES, n) + 1):
        now = packed if size == 1 else (shorter[:, :-1] << np.uint64(8)) | packed[:, size - 1:]
        for k in range(now.shape[1]):
            piece = _lookup(codes, now[:, k])
            rows = np.flatnonzero(piece < len(codes))
            if len(rows):
                found[k + size, size] = (rows, piece[rows])
        shorter = now
    return found


def word_likelihoods(codes, table, words):
    """Log probability of each word (rows of equally many bytes) in each column of ``table``.

    The forward sums of the last places are scaled now and then, so that words of any length keep
    their whole sum over all segmentations.
    """
    n = words.shape[1]
    packed = words.astype(np.uint64)
    pieces = {}
    for size in range(1, min(PIECE_BYTES, n) + 1):
        wide = packed if size == 1 else (wide[:, :-1] << np.uint64(8)) | packed[:, size - 1:]
        pieces[size] = _lookup(codes, wide)
    padded = np.vstack([table, np.zeros((1, table.shape[1]))])
    # ring[k % keep]: sum over all segmentations of the first k bytes, over exp(logs)
    keep = PIECE_BYTES + 1
    ring = np.zeros((keep, len(words), table.shape[1]))
    ring[0] = 1.0
    logs = np.zeros((len(words), table.shape[1]))
    for end in range(1, n + 1):
        now = np.zeros_like(logs)
        for size in range(1, min(PIECE_BYTES, end) + 1):
            now += ring[(end - size) % keep] * padded[pieces[size][:, end - size]]
        ring[end % keep] = now
        if end % keep == 0:
            top = ring.max(axis=0)
            top[top == 0] = 1.0
            ring /= top
            logs += np.log(top)
    return logs + np.log(np.maximum(ring[n % keep], 1e-300))


def expected_uses(codes, probs, words, weights):
    """Expected uses of each piece in words of one length, each seen ``weights`` times."""
    found = _ends(codes, words)
    n = words.shape[1]
    ahead, behind = np.zeros((n + 1, len(words))), np.zeros((n + 1, len(words)))
    ahead[0] = behind[n] = 1.0
    for end, size in sorted(found):
        rows, piece = found[end, size]
        ahead[end, rows] += ahead[end - size, rows] * probs[piece]
    for end, size in sorted(found, reverse=True):
        rows, piece = found[end, size]
        behind[end - size, rows] += behind[end, rows] * probs[piece]
    uses = np.zeros(len(codes))
    scale = weights / np.maximum(ahead[n], 1e-300)
    for (end, size), (rows, piece) in found.items():
        np.add.at(uses, piece, ahead[end - size, rows] * probs[piece] * behind[end, rows] * scale[rows])
    return uses


def by_length(words: Iterable[bytes]):
    """(indices, byte rows) of the words of each length."""
    groups: dict[int, list[int]] = {}
    words = list(words)
    for i, w in enumerate(words):
        groups.setdefault(len(w), []).append(i)
    for size, own in sorted(groups.items()):
        rows = np.frombuffer(b"".join(words[i] for i in own), np.uint8).reshape(-1, size)
        yield np.array(own), rows


def _stretches(word: bytes) -> list[bytes]:
    """A word with its space, cut so that no stretch underflows while the pieces are fitted."""
    word = b" " + word
    return [word[i:i + WORD_BYTES] for i in range(0, len(word), WORD_BYTES)]


def fit_pieces(codes, counts: dict[bytes, int], rounds: int = ROUNDS):
    """Piece probabilities of a language from its word counts, beginning with equal ones."""
    parts: dict[bytes, int] = {}
    for word, n in counts.items():
        for s in _stretches(word):
            parts[s] = parts.get(s, 0) + n
    weights = np.array(list(parts.values()), float)
    groups = [(own, rows) for own, rows in by_length(parts)]
    probs = np.full(len(codes), 1.0 / len(codes))
    for _ in range(rounds):
        uses = np.full(len(codes), SMOOTHING)
        for own, rows in groups:
            for a in range(0, len(own), 20_000):
                uses += expected_uses(codes, probs, rows[a:a + 20_000], weights[own[a:a + 20_000]])
        probs = uses / uses.sum()
    return probs


class Scorer:
    """Scores of texts; keeps those of the words that it has met."""

    def __init__(self, codes, table):
        self.codes, self.table = codes, table
        self.hasher = SpanHasher()
        self.letters = np.zeros(256, bool)
        self.letters[65:91] = self.letters[97:123] = True
        self.letters[128:] = True
        self._forget()

    def _forget(self):
        self.known = np.zeros(0, np.uint64)
        self.scores = np.zeros((0, self.table.shape[1]))

    def _learn(self, names, words):
        out = np.zeros((len(words), self.table.shape[1]))
        for own, rows in by_length(b" " + w for w in words):
            step = max(1, 400_000 // rows.shape[1])
            for a in range(0, len(own), step):
                out[own[a:a + step]] = word_likelihoods(self.codes, self.table, rows[a:a + step])
        if len(self.known) > KEPT_WORDS:
            self._forget()
        names = np.concatenate([self.known, names])
        order = np.argsort(names)
        self.known, self.scores = names[order], np.concatenate([self.scores, out])[order]

    def texts(self, column):
        """Log probability of each text in each language."""
        out = np.zeros((len(column), self.table.shape[1]))
        for first, raw, offsets in text_slices(column):
            starts, ends, at = runs(self.letters[raw], offsets)
            if not len(starts):
                continue
            names, where, back = np.unique(self.hasher(raw, starts, ends),
                                           return_index=True, return_inverse=True)
            if len(self.known):
                new = self.known[np.minimum(np.searchsorted(self.known, names), len(self.known) - 1)] != names
            else:
                new = np.ones(len(names), bool)
            if new.any():
                if len(self.known) > KEPT_WORDS:
                    new[:] = True
                data = raw.tobytes()
                self._learn(names[new], [data[starts[i]:ends[i]] for i in where[new]])
            scores = self.scores[np.searchsorted(self.known, names)][back]
            sums = np.concatenate([np.zeros((1, scores.shape[1])), np.cumsum(scores, axis=0)])
            out[first:first + len(at) - 1] = sums[at[1:]] - sums[at[:-1]]
        return out


def held_out(remainder: int, of: int):
    """Column: crc32 of the doc_id as text leaves ``remainder``; false for a null doc_id."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % of == remainder,
                      F.lit(False))


def fit_languages(labelled: DataFrame, vocabulary: str = VOCABULARY, train_docs: int = TRAIN_DOCS):
    """(languages, codes, table) from (text, lang) rows; rows with a null in either are passed over."""
    rows = labelled.where("lang is not null and text is not null")
    sizes = {r.lang: r["count"] for r in rows.groupBy("lang").count().collect()}
    codes = read_pieces(vocabulary)
    langs = sorted(sizes)
    if not langs:
        return langs, codes, np.zeros((len(codes), 0))
    spark = labelled.sparkSession
    share = F.broadcast(spark.createDataFrame(
        [(lang, min(1.0, train_docs / n)) for lang, n in sizes.items()], "lang string, share double"))
    chosen = rows.join(share, "lang").where(
        F.pmod(F.xxhash64("doc_id", "text"), F.lit(1_000_000)) < F.col("share") * 1_000_000)
    words = (chosen.select("lang", F.explode(F.regexp_extract_all(
                F.lower("text"), F.lit("([a-z\\x{80}-\\x{10FFFF}]+)"), 1)).alias("word"))
             .groupBy("lang", "word").count())
    counts: dict[str, dict[bytes, int]] = {lang: {} for lang in langs}
    for lang, word, n in words.toLocalIterator():
        counts[lang][word.encode()] = n
    table = np.stack([fit_pieces(codes, counts[lang]) for lang in langs], axis=1)
    return langs, codes, table


def identify(docs: DataFrame, model, names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """``docs`` with lang_pred and score (or other ``names``), the posterior of the predicted language (equal priors).

    Only ``text`` is read. A null text, or one without a letter, is ``und`` with score 0, as is
    every text where no language was learned. Of equally likely languages the first by
    code point wins. Other columns stay, but those that are called as the added ones.
    """
    langs, codes, table = model
    small_batches(docs.sparkSession)
    docs = docs.drop(*names)
    low, any_letter = "_text_lower_case", "_has_letter"
    rows = docs.withColumns({
        low: F.lower("text"),
        any_letter: F.coalesce(F.col("text").rlike("\\p{L}"), F.lit(False))})
    schema = docs.withColumns({names[0]: F.lit(""), names[1]: F.lit(0.0)}).schema

    def score(batches):
        scorer = Scorer(codes, table)
        for batch in batches:
            n = batch.num_rows
            best, top = ["und"] * n, np.zeros(n)
            if langs and n:
                logs = scorer.texts(batch.column(low))
                logs = np.exp(logs - logs.max(axis=1, keepdims=True))
                first = logs.argmax(axis=1)
                worded = np.array(batch.column(any_letter).to_pylist(), bool)
                best = [langs[i] if w else "und" for i, w in zip(first, worded)]
                top = np.where(worded, 1.0 / logs.sum(axis=1), 0.0)
            for name in (low, any_letter):
                batch = batch.remove_column(batch.schema.get_field_index(name))
            yield (batch.append_column(names[0], pa.array(best, pa.string()))
                   .append_column(names[1], pa.array(top, pa.float64())))

    return rows.mapInArrow(lean_batches(score), schema)


ship_by_value(__name__)
