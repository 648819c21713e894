"""Array kernels over batches of UTF-8 texts.

They work on the bytes of a whole Arrow column: words and their hashes come from a few
array passes, not from a loop over words. Words are runs of bytes other than space and
\\t..\\r, all of them ASCII, so cutting bytes cuts code points as well.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from gavlake.llm.scratch import ship_by_value

SLICE_BYTES = 1 << 20
_U = np.uint64


def text_slices(column, limit=SLICE_BYTES):
    """(first row, bytes, offsets) of runs of rows, ``limit`` bytes or one row at most.

    Null texts count as empty.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    n = len(column)
    if not n:
        return
    _, off, data = column.buffers()
    offsets = np.frombuffer(off, np.int64)[column.offset:column.offset + n + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(n, max(last, first + 1))
        yield first, raw[offsets[first]:offsets[last]], offsets[first:last + 1] - offsets[first]
        first = last


def lower_ascii(raw):
    """Bytes with A-Z lower-cased."""
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table[raw]


def spaces():
    """Table of the six white-space bytes."""
    table = np.zeros(256, bool)
    table[[0x20, *range(0x09, 0x0E)]] = True
    return table


def runs(inside, offsets):
    """Starts and ends of the runs of true bytes; a run never crosses a row.

    Also the index of each row's first run.
    """
    begin = inside.copy()
    begin[1:] &= ~inside[:-1]
    end = inside.copy()
    end[:-1] &= ~inside[1:]
    full = np.flatnonzero(offsets[1:] > offsets[:-1])
    at = offsets[:-1][full]
    begin[at] = inside[at]
    at = offsets[1:][full] - 1
    end[at] = inside[at]
    starts = np.flatnonzero(begin)
    return starts, np.flatnonzero(end) + 1, np.searchsorted(starts, offsets)


def mix(h):
    """Finaliser of 64-bit hashes (murmur3's constants)."""
    h = h ^ (h >> _U(33))
    h = h * _U(0xFF51AFD7ED558CCD)
    h = h ^ (h >> _U(33))
    h = h * _U(0xC4CEB9FE1A85EC53)
    return h ^ (h >> _U(33))


def powers(base, n):
    """base**0 .. base**(n-1) modulo 2**64."""
    out = np.ones(max(n, 1), _U)
    done = 1
    step = _U(base)
    with np.errstate(over="ignore"):
        while done < n:
            more = min(done, n - done)
            out[done:done + more] = out[:more] * step
            done += more
            step = step * step
    return out


class SpanHasher:
    """64-bit polynomial hashes of byte spans, by prefix sums over blocks of bytes."""

    BASE = 0x9E3779B97F4A7C15
    INVERSE = pow(BASE, -1, 1 << 64)

    def __init__(self, block=1 << 18):
        self.block = block
        self.letters = mix(np.arange(1, 257, dtype=_U) * _U(self.BASE))
        self._tables(2 * block)

    def _tables(self, n):
        self.up, self.down = powers(self.BASE, n), powers(self.INVERSE, n)

    def __call__(self, raw, starts, ends):
        """Hash of each span; spans are in order of their starts and do not overlap."""
        out = np.empty(len(starts), _U)
        i = 0
        while i < len(starts):
            j = max(i + 1, int(np.searchsorted(starts, starts[i] + self.block)))
            lo, hi = int(starts[i]), int(ends[j - 1])
            if hi - lo > len(self.up):
                self._tables(hi - lo)
            sums = np.zeros(hi - lo + 1, _U)
            np.cumsum(self.letters[raw[lo:hi]] * self.up[:hi - lo], out=sums[1:])
            s, e = starts[i:j] - lo, ends[i:j] - lo
            out[i:j] = mix((sums[e] - sums[s]) * self.down[s] + (e - s).astype(_U))
            i = j
        return out


def shingles(words, first, size=5):
    """Hashes of each row's ``size``-word shingles, and each row's first one.

    A row with fewer words has its whole sequence as one shingle; one without words none.
    """
    counts = np.diff(first)
    n = np.where(counts >= size, counts - size + 1, (counts > 0).astype(counts.dtype))
    at = np.zeros(len(n) + 1, np.int64)
    np.cumsum(n, out=at[1:])
    if not at[-1]:
        return np.zeros(0, _U), at
    scale = powers(0xD6E8FEB86659FD93, size)
    # the words of shingle k of a row are first[row] + k ...
    row = np.repeat(np.arange(len(n)), n)
    start = np.arange(at[-1]) - at[row] + first[row]
    padded = np.concatenate([words, np.zeros(size, _U)])
    h = np.zeros(len(start), _U)
    for k in range(size):
        h += padded[start + k] * scale[k]
    for r in np.flatnonzero((counts > 0) & (counts < size)):
        seq = words[first[r]:first[r + 1]]
        h[at[r]] = (seq * scale[:len(seq)]).sum(dtype=_U) ^ _U(0x0123456789ABCDEF * len(seq))
    return mix(h), at


ship_by_value(__name__)
