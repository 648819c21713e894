"""Spelling variants by dynamic programming over sorted word lists.

A word is compared with a sorted list by the edit matrix of both, of which only the three
diagonals within one edit are kept. Neighbours of the list share a prefix, and the matrix rows of that
prefix are reused; where all cells of a row are above one edit, every word with that prefix is skipped.

Two words that are one edit apart agree in the first half of the shorter one's length, or else in the
rest of it from the end. So there are two lists for each length m, of the words and of the reversed words
of m and m + 1 code points, and a word meets only those that share its half. The lists are cut
into blocks of bounded size; a half that fills several blocks is compared block by block,
but for blocks whose shared prefixes are more than one edit apart.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gavlake.llm.scratch import BATCH_BYTES, discard, shuffle_partitions, ship_by_value, small_batches, staged
from gavlake.llm.text import lower_ascii, runs, text_slices

#: Code points and occurrences of a word at least, and how much more often its form occurs.
MIN_CHARS, MIN_COUNT, RATIO = 7, 2, 10
#: One of so many (document, word) pairs loses a code point.
SLIPS = 31
#: Words and code points of a block of a sorted list at most (one word at least).
BLOCK_WORDS, BLOCK_CHARS = 2_000, 100_000
#: Tasks that compare blocks, for each shuffle partition of the session.
SCAN_TASKS = 4
#: Bytes up to which a checksum is continued for many words at once.
STEP_BYTES = 64


def _crc_table():
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1).astype(np.uint32)
    return table


_CRC = _crc_table()


def checksums(prefix, own, sizes, plain):
    """crc32 of prefix + word for pairs: the prefix's checksum of each pair, and which word is its
    ``own``; the words' sizes in bytes and checksums.

    A checksum is linear: that of the prefix, carried over as many zero bytes as the word has, xor
    the word's own.
    """
    state = prefix.copy()
    left = np.minimum(sizes[own], STEP_BYTES)
    going = np.arange(len(own))
    while len(going):
        s = state[going]
        state[going] = _CRC[s & 255] ^ (s >> np.uint32(8))
        left[going] -= 1
        going = going[left[going] > 0]
    for i in np.flatnonzero(sizes[own] > STEP_BYTES):
        rest = int(sizes[own[i]]) - STEP_BYTES
        # carried on by the rest: crc(state, zeros) without the checksum's own conditioning
        state[i] = zlib.crc32(bytes(rest), int(state[i])) ^ zlib.crc32(bytes(rest), 0)
    return state ^ plain[own]


def _words(batches):
    """(word, n): the words of each batch, where a slip has taken a code point without it."""
    for batch in batches:
        ids = pc.fill_null(batch.column(0).cast(pa.string()), "").to_pylist()
        start = np.array([zlib.crc32(f"{i}:".encode()) for i in ids], np.uint32)
        for begin, raw, offsets in text_slices(batch.column(1), BATCH_BYTES // 2):
            yield from _slice_words(raw, offsets, start[begin:begin + len(offsets) - 1])


def _slice_words(raw, offsets, start):
    low = lower_ascii(raw)
    letter = np.zeros(256, bool)
    letter[97:123] = True
    inside = letter[low]
    # U+00C0 to U+00FF are the characters of two bytes with the lead byte C3
    tail = np.zeros(len(low), bool)
    tail[1:] = low[:-1] == 0xC3
    inside |= (low == 0xC3) | tail
    starts, ends, first = runs(inside, offsets)
    tails = np.zeros(len(low) + 1, np.int64)
    np.cumsum(tail, out=tails[1:])
    chars = (ends - starts) - (tails[ends] - tails[starts])
    keep = chars >= MIN_CHARS
    if not keep.any():
        return
    data = low[inside][np.repeat(keep, ends - starts)]
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))[keep]
    at = np.zeros(len(row) + 1, np.int64)
    np.cumsum((ends - starts)[keep], out=at[1:])
    coded = pa.LargeStringArray.from_buffers(
        len(row), pa.py_buffer(at), pa.py_buffer(data.tobytes())).dictionary_encode()
    words = coded.dictionary
    cell, count = np.unique(row * len(words) + coded.indices.to_numpy(zero_copy_only=False), return_counts=True)
    row, own = cell // len(words), cell % len(words)
    sizes = pc.binary_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
    length = pc.utf8_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
    plain = np.array([zlib.crc32(w) for w in words.cast(pa.large_binary()).to_pylist()], np.uint32)
    h = checksums(start[row], own, sizes, plain).astype(np.int64)
    slip = h % SLIPS == 0
    changed: dict[str, int] = {}
    for i in np.flatnonzero(slip & (length[own] > MIN_CHARS)):
        word, k = words[int(own[i])].as_py(), int(h[i] % length[own[i]])
        word = word[:k] + word[k + 1:]
        changed[word] = changed.get(word, 0) + int(count[i])
    n = np.bincount(own[~slip], weights=count[~slip], minlength=len(words)).astype(np.int64)
    used = np.flatnonzero(n)
    yield pa.RecordBatch.from_arrays([words.take(pa.array(used)).cast(pa.string()), pa.array(n[used])], ["word", "n"])
    if changed:
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(changed), pa.string()), pa.array(list(changed.values()), pa.int64())], ["word", "n"])


def vocabulary(docs: DataFrame) -> DataFrame:
    """(word, n) of all texts."""
    small_batches(docs.sparkSession)
    parts = docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(
        _words, "word string, n bigint")
    return (parts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= MIN_COUNT)
            .where(F.length("word") >= MIN_CHARS))


def _common(a: str, b: str) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    low, high = 0, n
    while low < high:
        mid = (low + high + 1) // 2
        if a[:mid] == b[:mid]:
            low = mid
        else:
            high = mid - 1
    return low


def _row_steps():
    """Next row for a row (three cells that count to 2, as a number to base 3) and for whether the list word's
    code point differs from the query's at the row's three places; -1 where all cells are above 1."""
    steps = []
    for row in range(27):
        a, b, c = row // 9, row // 3 % 3, row % 3
        for differs in range(8):
            x = min(b + 1, a + (differs >> 2), 2)
            y = min(c + 1, b + (differs >> 1 & 1), x + 1, 2)
            z = min(c + (differs & 1), y + 1, 2)
            steps.append(-1 if min(x, y, z) > 1 else 9 * x + 3 * y + z)
    return steps


_STEPS = _row_steps()
#: The row of a prefix that both words share: 1, 0, 1.
_EQUAL = 10


def scan(query: str, words: list[str], shared: list[int], low: int, high: int, depth: int) -> list[int]:
    """Positions in ``words[low:high]`` (sorted) of the words one edit from ``query``.

    All of them share ``depth`` code points with the query; ``shared[i]`` is the prefix that word i
    has in common with the one before. A matrix row has the cells of the query's prefixes that are
    one shorter than, as long as and one longer than the list word's; it counts to 2.
    """
    n = len(query)
    query += "\0\0\0"  # cells beyond the query's end are never read for a distance
    rows = [_EQUAL]
    found = []
    i = low
    while i < high:
        word = words[i]
        end = len(word)
        d = depth + len(rows) - 1
        row = rows[-1]
        while d < end:
            ch = word[d]
            row = _STEPS[8 * row + 4 * (ch != query[d - 1]) + 2 * (ch != query[d]) + (ch != query[d + 1])]
            if row < 0:
                break
            d += 1
            rows.append(row)
        i += 1
        if row < 0:
            # the row of d + 1 is above one edit everywhere: skip all that share that prefix
            while i < high and shared[i] > d:
                i += 1
        elif -1 <= n - end <= 1 and row // (3, 1, 9)[n - end] % 3 == 1:
            found.append(i - 1)
        if i < high:
            del rows[max(shared[i] - depth, 0) + 1:]
    return found


def _sublist(words: list[str], size: int) -> tuple[list[int], list[str], list[int]]:
    """Positions and words of ``size`` code points, and what each shares with the one before."""
    at = [i for i, w in enumerate(words) if len(w) == size]
    kept = [words[i] for i in at]
    return at, kept, [0] + [_common(a, b) for a, b in zip(kept, kept[1:], strict=False)]


def _half(reverse: bool, m: int) -> int:
    """Code points that words of a list share: half of m, or of reversed words the rest."""
    return m - m // 2 if reverse else m // 2


def _blocks(batches):
    """Consecutive rows of a sorted list, as many as a block holds."""
    task, number = TaskContext.get().partitionId(), 0
    now, words, counts, chars = None, [], [], 0

    def block():
        half = _half(now[0], now[1])
        shared = words[0][:_common(words[0], words[-1])]
        return (task << 33 | number, now[0], now[1], words, counts, words[0][:half], words[-1][:half], shared)

    out = []
    for batch in batches:
        for reverse, m, word, n in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
            if words and (now != (reverse, m) or len(words) == BLOCK_WORDS or chars + len(word) > BLOCK_CHARS):
                out.append(block())
                number, words, counts, chars = number + 1, [], [], 0
            now = (reverse, m)
            words.append(word)
            counts.append(n)
            chars += len(word)
        if out:
            yield _block_rows(out)
            out = []
    if words:
        yield _block_rows([block()])


_BLOCK = [("block", pa.int64()), ("reverse", pa.bool_()), ("m", pa.int32()), ("words", pa.list_(pa.string())),
          ("counts", pa.list_(pa.int64())), ("first", pa.string()), ("last", pa.string()), ("shared", pa.string())]


def _block_rows(rows):
    return pa.RecordBatch.from_arrays(
        [pa.array([r[k] for r in rows], kind) for k, (_, kind) in enumerate(_BLOCK)], [n for n, _ in _BLOCK])


def _own_links(reverse, m, words, counts):
    """Links within a block: a word of m code points is scanned for in the rest of those and in those of
    m + 1 that share its half."""
    half = _half(reverse, m)
    low = 0
    while low < len(words):
        high = low + 1
        while high < len(words) and words[high].startswith(words[low][:half]):
            high += 1
        if high > low + 1:
            group = words[low:high]
            at, own, shared = _sublist(group, m)
            far, longer, shared_longer = _sublist(group, m + 1)
            for k, q in enumerate(own):
                near = [at[i] for i in scan(q, own, shared, k + 1, len(own), half)]
                near += [far[i] for i in scan(q, longer, shared_longer, 0, len(longer), half)]
                for i in near:
                    yield q, counts[low + at[k]], group[i], counts[low + i]
        low = high


def _cross_links(reverse, m, words, counts, others, other_counts, key):
    """Links between two blocks of one list, for the words that begin with ``key``."""
    lists = {size: _sublist([w if w.startswith(key) else "" for w in others], size) for size in (m, m + 1)}
    for q, n in zip(words, counts, strict=True):
        if not q.startswith(key):
            continue
        # a pair belongs to the list of its shorter word's length
        for size in (m, m + 1) if len(q) == m else (m,):
            at, listed, shared = lists[size]
            for i in scan(q, listed, shared, 0, len(listed), len(key)):
                yield q, n, listed[i], other_counts[at[i]]


def _links(batches, cross):
    """(word, near, near_n) in both directions, for blocks or for pairs of blocks."""
    for batch in batches:
        for row in batch.to_pylist():
            reverse, m = row["reverse"], row["m"]
            links = (_cross_links(reverse, m, row["words"], row["counts"], row["others"], row["other_counts"],
                                  row["key"]) if cross else _own_links(reverse, m, row["words"], row["counts"]))
            word, near, near_n = [], [], []
            for a, a_n, b, b_n in links:
                if reverse:
                    a, b = a[::-1], b[::-1]
                    if a[:m // 2] == b[:m // 2]:
                        continue  # the list of the words themselves has it
                word += (a, b)
                near += (b, a)
                near_n += (b_n, a_n)
            if word:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(word, pa.string()), pa.array(near, pa.string()), pa.array(near_n, pa.int64())],
                    ["word", "near", "near_n"])


_LINK = "word string, near string, near_n bigint"


def _within_one_edit(a: str, b: str) -> str:
    """SQL: words that begin with ``a`` and with ``b`` may be one edit apart.

    The shorter prefix, less a code point, is held against prefixes of the other.
    """
    n = f"(least(length({a}), length({b})) - 1)"
    near = [f"levenshtein(left({a}, {n}), left({b}, {n} + {k}), 1) >= 0" for k in (-1, 0, 1)]
    return f"({n} < 2 or {' or '.join(near)})"


def near_words(words: DataFrame) -> DataFrame:
    """(word, near, near_n): every ordered pair of words that are exactly one edit apart.

    ``words``: (word, n) with distinct words.
    """
    small_batches(words.sparkSession)
    size = F.length("word")
    lists = F.explode(F.array(*[
        F.struct(F.lit(reverse).alias("reverse"), (size - less).alias("m"),
                 (F.reverse("word") if reverse else F.col("word")).alias("word"))
        for reverse in (False, True) for less in (0, 1)])).alias("x")
    rows = (words.select(lists, "n").select("x.reverse", "x.m", "x.word", "n").where(F.col("m") >= MIN_CHARS)
            .repartitionByRange("reverse", "m", "word").sortWithinPartitions("reverse", "m", "word"))
    blocks = staged(rows.mapInArrow(
        _blocks, "block bigint, reverse boolean, m int, words array<string>, counts array<bigint>, "
                 "first string, last string, shared string"), "spelling_blocks")
    # a half that goes on in the next block: that of a block's first or last word
    edges = (blocks.select("block", "reverse", "m", F.explode(F.array_distinct(F.array("first", "last"))).alias("key"),
                           F.when(F.col("first") == F.col("last"), F.col("shared")).alias("shared"))
             .withColumn("shared", F.coalesce("shared", "key")))
    left = edges.select("reverse", "m", "key", F.col("block").alias("a"), F.col("shared").alias("sa"))
    right = edges.select("reverse", "m", "key", F.col("block").alias("b"), F.col("shared").alias("sb"))
    meet = left.join(right, ["reverse", "m", "key"]).where("a < b").where(_within_one_edit("sa", "sb"))
    cross = (meet.select("reverse", "m", "key", "a", "b")
             .join(blocks.select(F.col("block").alias("a"), "words", "counts"), "a")
             .join(blocks.select(F.col("block").alias("b"), F.col("words").alias("others"),
                                 F.col("counts").alias("other_counts")), "b"))
    # a block is much work for few bytes, so blocks are dealt out by number
    tasks = SCAN_TASKS * shuffle_partitions(words.sparkSession)
    own = blocks.select("block", "reverse", "m", "words", "counts").repartition(tasks, "block").drop("block").mapInArrow(lambda batches: _links(batches, False), _LINK)
    between = cross.select("reverse", "m", "key", "words", "counts", "others", "other_counts", "a", "b").repartition(
        tasks, "a", "b").drop("a", "b").mapInArrow(
        lambda batches: _links(batches, True), _LINK)
    links = staged(own.unionByName(between), "spelling_links")
    discard(blocks)
    return links


def spelling_variants(docs: DataFrame) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of the words of all texts.

    A null text has no words, a null doc_id counts as '' in the slips' checksum. Repeated rows
    count each. Words of equal n are ordered by code points, so forms are unique; a form occurs ten times as
    often as its word, so chains of forms end, after a step for each digit of n at most. Other
    columns than doc_id and text are not read; an empty table gives no rows.
    """
    words = staged(vocabulary(docs), "spelling_words")
    links = near_words(words)
    best = links.groupBy("word").agg(
        F.count("*").alias("n_near"),
        F.min(F.struct((-F.col("near_n")).alias("minus"), "near")).alias("best"))
    forms = staged(
        words.join(best, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
            F.when(-F.col("best.minus") >= RATIO * F.col("n"), F.col("best.near")).alias("form"),
            F.when(-F.col("best.minus") >= RATIO * F.col("n"), -F.col("best.minus")).alias("form_n")),
        "spelling_forms")
    # each round follows twice as many forms as the last
    up = forms.where("form is not null").select("word", F.col("form").alias("root"))
    tables = []
    while True:
        next_up = up.select(F.col("word").alias("root"), F.col("root").alias("further"))
        up = staged(up.join(next_up, "root", "left").select(
            "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")),
            "spelling_roots")
        tables.append(up)
        if up.where("moved").isEmpty():
            break
        up = up.drop("moved")
    result = staged(
        forms.join(up.select("word", "root"), "word", "left").select(
            "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"), "spelling")
    discard(words, links, forms, *tables)
    return result


ship_by_value(__name__)
