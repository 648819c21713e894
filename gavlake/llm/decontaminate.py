"""Benchmark decontamination by SimHash of item-sized windows.

A document's words are lower-cased runs of letters and digits. Wherever a document shares a
5-word shingle with a benchmark item, the item-sized window in the same alignment is cut;
a window without a common shingle has similarity 0, so no other window can match. Each
window gets a 128-bit SimHash of its weighted shingles. A multi-index over the items' SimHashes
(16 blocks of 8 bits, each block probed with its value and all values one bit away) returns
every item within Hamming distance 31: of 31 differing bits, some block holds at most one.
Items that it returns are verified by their exact weighted-shingle similarity (sum of minima
over sum of maxima). A shingle weighs its count times ln(1 + items / items that hold it), items of the
whole benchmark: both numbers are counted once, and every pass has those of all shingles that
several items hold, as a document's window may hold shingles of other passes' items. So passes
do not change a result.

Two texts at similarity 0.8 differ in 19 of 128 bits on average (standard deviation 4), so
the radius lies three deviations above that.
"""

from __future__ import annotations

from array import array
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gavlake.llm.scratch import lean_batches, ship_by_value, small_batches
from gavlake.llm.text import SpanHasher, mix, runs, shingles, text_slices

SHINGLE_WORDS = 5
SIMILARITY = 0.8
BLOCKS = 16
RADIUS = 2 * BLOCKS - 1
#: Items compared in one pass over the documents; a larger benchmark takes several passes.
ITEMS_PER_PASS = 5_000


def _words(raw, offsets, hasher):
    table = np.zeros(256, bool)
    table[48:58] = table[65:91] = table[97:123] = True
    table[128:] = True
    starts, ends, first = runs(table[raw], offsets)
    return hasher(raw, starts, ends), first


def _fingerprint(hashes, weights):
    """128-bit SimHash, as 16 bytes, of weighted 64-bit hashes."""
    wide = np.stack([hashes, mix(hashes + np.uint64(0x9E3779B97F4A7C15))], axis=1)
    bits = np.unpackbits(wide.view(np.uint8).reshape(len(hashes), 16), axis=1)
    return np.packbits(weights @ (2.0 * bits - 1.0) > 0)


class Holders:
    """Items per shingle, of those that several items hold; 16 bytes a shingle."""

    def __init__(self, keys, counts):
        order = np.argsort(keys)
        self.keys, self.counts = keys[order], counts[order]

    def get(self, shingle, default):
        at = int(np.searchsorted(self.keys, np.uint64(shingle)))
        return int(self.counts[at]) if at < len(self.keys) and int(self.keys[at]) == shingle else default


class Benchmark:
    """Items of one pass, ready to be looked up."""

    def __init__(self, ids, texts, holders, total):
        """``holders``: items of the whole benchmark per shingle; ``total``: their number."""
        hasher = SpanHasher()
        self.ids, self.sizes, self.counts, prints = [], [], [], []
        self.total, self.holders = total, holders
        self.places: dict[int, list[tuple[int, int]]] = {}
        for first, raw, offsets in text_slices(pa.array(texts, pa.string())):
            words, at = _words(raw, offsets, hasher)
            h, row = shingles(words, at, SHINGLE_WORDS)
            for r in range(len(row) - 1):
                if at[r + 1] - at[r] < SHINGLE_WORDS:
                    continue
                i, own = len(self.ids), h[row[r]:row[r + 1]]
                self.ids.append(ids[first + r])
                self.sizes.append(int(at[r + 1] - at[r]))
                self.counts.append(Counter(own.tolist()))
                for o, x in enumerate(own.tolist()):
                    self.places.setdefault(x, []).append((i, o))
                prints.append(self.simhash(self.counts[-1]))
        self.prints = np.array(prints, np.uint8).reshape(-1, BLOCKS)
        self.known = np.array(sorted(self.places), np.uint64)
        self.filter = np.zeros(1 << 20, bool)
        self.filter[(self.known & np.uint64((1 << 20) - 1)).astype(np.int64)] = True
        near = [0, *(1 << b for b in range(8))]
        self.index = np.zeros((BLOCKS, 256, len(self.ids)), bool)
        for b in range(BLOCKS):
            for flip in near:
                self.index[b, self.prints[:, b] ^ flip, np.arange(len(self.ids))] = True

    def weight(self, shingle):
        return float(np.log1p(self.total / self.holders.get(shingle, 1)))

    def simhash(self, counts):
        keys = np.array(list(counts), np.uint64)
        return _fingerprint(keys, np.array([c * self.weight(k) for k, c in counts.items()]))

    def seeds(self, h):
        """Positions of shingles that an item holds."""
        maybe = np.flatnonzero(self.filter[(h & np.uint64((1 << 20) - 1)).astype(np.int64)])
        if not len(maybe):
            return maybe
        at = np.minimum(np.searchsorted(self.known, h[maybe]), len(self.known) - 1)
        return maybe[self.known[at] == h[maybe]]

    def within(self, fingerprint):
        """(item, distance) of all items within the radius."""
        hit = np.flatnonzero(self.index[np.arange(BLOCKS), fingerprint].any(axis=0))
        far = np.unpackbits(self.prints[hit] ^ fingerprint, axis=1).sum(axis=1)
        return [(int(i), int(d)) for i, d in zip(hit, far) if d <= RADIUS]

    def similarity(self, a, b):
        low = sum(min(c, b[k]) * self.weight(k) for k, c in a.items() if k in b)
        both = sum(c * self.weight(k) for x in (a, b) for k, c in x.items())
        return low / (both - low) if both > low else 1.0

    def matches(self, h):
        """item -> (similarity, distance, first word, words) of a document's shingles, the best."""
        windows = sorted({(max(0, int(p) - o), min(int(p) - o + self.sizes[i], len(h) + SHINGLE_WORDS - 1))
                          for p in self.seeds(h) for i, o in self.places[int(h[p])]})
        found: dict[int, tuple] = {}
        for start, end in windows:
            own = h[start:end - SHINGLE_WORDS + 1].tolist()
            if not own:
                continue
            counts = Counter(own)
            for i, far in self.within(self.simhash(counts)):
                s = self.similarity(counts, self.counts[i])
                if s >= SIMILARITY - 1e-12 and (i not in found or s > found[i][0] + 1e-12):
                    found[i] = (s, far, start, end - start)
        return found


def _items(benchmark: DataFrame) -> DataFrame:
    return benchmark.select("item_id", F.lower("text").alias("text")).where("text is not null")


def _passes(benchmark: DataFrame):
    """The benchmark in blocks of items, by item_id. Rows of null text or under 5 words match nothing."""
    block: list = []
    for row in _items(benchmark).orderBy("item_id", "text").toLocalIterator():
        block.append((row.item_id, row.text))
        if len(block) == ITEMS_PER_PASS:
            yield block
            block = []
    if block:
        yield block


def _holders(benchmark: DataFrame):
    """Broadcast items per shingle, and the number of items, of the whole benchmark.

    A shingle that one item holds weighs as one that no item holds, so only the others are kept.
    """

    def own(batches):
        hasher = SpanHasher()
        for batch in batches:
            for _, raw, offsets in text_slices(batch.column("text")):
                words, at = _words(raw, offsets, hasher)
                h, row = shingles(words, at, SHINGLE_WORDS)
                sets = [np.unique(h[row[r]:row[r + 1]]) for r in range(len(row) - 1)]
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(sets).view(np.int64))], ["shingle"])

    items = _items(benchmark)
    several = (items.select("text").mapInArrow(lean_batches(own), "shingle bigint")
               .groupBy("shingle").agg(F.count("*").alias("n")).where("n > 1"))
    keys, counts = array("q"), array("q")
    for row in several.toLocalIterator():
        keys.append(row.shingle)
        counts.append(row.n)
    held = Holders(np.array(keys, np.int64).view(np.uint64), np.array(counts, np.int64))
    return benchmark.sparkSession.sparkContext.broadcast(held), items.count()


def _found(column, benchmark):
    """(row, matches) of the texts with any."""
    hasher = SpanHasher()
    for first, raw, offsets in text_slices(column):
        words, at = _words(raw, offsets, hasher)
        h, row = shingles(words, at, SHINGLE_WORDS)
        hot = benchmark.seeds(h)
        for r in np.unique(np.searchsorted(row, hot, "right") - 1):
            if at[r + 1] - at[r] >= SHINGLE_WORDS:
                found = benchmark.matches(h[row[r]:row[r + 1]])
                if found:
                    yield first + int(r), found


def _once(block, holders, total):
    """The block's index, built at its first use in a task."""
    built: list = []

    def get():
        if not built:
            built.append(Benchmark([i for i, _ in block], [t for _, t in block], holders.value, total))
        return built[0]

    return get


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, similarity, distance, first_word, n_words): the best window per item.

    One row for each row of ``docs`` (doc_id, text) and item of ``benchmark`` (item_id, text)
    that match; of equally similar windows the first. Null and empty texts, and those under 5
    words, match nothing; repeated rows and items match each on their own; an empty
    benchmark or table gives no rows. Other columns are not read. Documents are not shuffled: every
    task holds the items of a pass, and of the whole benchmark the counts of ``Holders``.
    """
    schema = ("doc_id bigint, item_id bigint, similarity double, distance int, "
              "first_word bigint, n_words bigint")
    small_batches(docs.sparkSession)
    out = docs.sparkSession.createDataFrame([], schema)
    rows = docs.select("doc_id", F.lower("text").alias("text"))
    holders, total = _holders(benchmark)
    for k, block in enumerate(_passes(benchmark)):
        items = _once(block, holders, total)

        def search(batches, items=items):
            for batch in batches:
                ids, own = batch.column("doc_id").to_pylist(), []
                for r, found in _found(batch.column("text"), items()):
                    own += [(ids[r], items().ids[i], *v) for i, v in sorted(found.items())]
                cols = list(zip(*own)) if own else [[]] * 6
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.float64(),
                                                           pa.int32(), pa.int64(), pa.int64()))],
                    ["doc_id", "item_id", "similarity", "distance", "first_word", "n_words"])

        found = rows.mapInArrow(lean_batches(search), schema)
        out = found if k == 0 else out.unionByName(found)
    return out


def decontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the rows that match an item; all columns stay as they are."""
    small_batches(docs.sparkSession)
    low = "_text_lower_case"
    out = docs
    holders, total = _holders(benchmark)
    for block in _passes(benchmark):
        items = _once(block, holders, total)

        def clean(batches, items=items):
            for batch in batches:
                keep = np.ones(batch.num_rows, bool)
                for r, _ in _found(batch.column(low), items()):
                    keep[r] = False
                at = batch.schema.get_field_index(low)
                yield batch.remove_column(at).filter(pa.array(keep))

        out = out.withColumn(low, F.lower("text")).mapInArrow(lean_batches(clean), docs.schema)
    return out


ship_by_value(__name__)
