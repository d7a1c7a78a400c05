"""Words and shingles of UTF-8 columns as numpy arrays, for use inside Arrow tasks.

A word is a run of bytes other than space and U+0009 to U+000D; these separators are single
bytes in UTF-8, so words are cut on bytes. Words are known by mixed 64-bit hashes.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = (512 << 10) - 16  # text bytes worked on at a time, unless one text is longer
_BASE = np.uint64(0x9E3779B97F4A7C15)
#: By byte: 0 for separators, and one kind for all others.
WORD = np.ones(256, dtype=np.uint8)
WORD[[0x20, *range(0x09, 0x0E)]] = 0
#: By byte: separators, letters and digits (all of UTF-8 above ASCII too), other signs.
WORD_OR_SIGNS = WORD * 2
for _a, _b in ((0x30, 0x3A), (0x41, 0x5B), (0x61, 0x7B), (0x80, 0x100)):
    WORD_OR_SIGNS[_a:_b] = 1
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


def slices(batch: pa.RecordBatch, text: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Row slices of a batch with at most `limit` bytes of text (or one row)."""
    n = batch.num_rows
    size = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(size.astype(np.int64))
    at = 0
    while at < n:
        base = ends[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, base + limit, side="right")))
        yield batch.slice(at, stop - at)
        at = stop


def raw_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and the n + 1 row offsets; NULL is empty."""
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    lengths = pc.binary_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    start = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset] if len(column) else 0
    data = column.buffers()[2]
    if data is None or not offsets[-1]:
        return np.zeros(0, dtype=np.uint8), offsets
    return np.frombuffer(data, dtype=np.uint8)[start : start + offsets[-1]], offsets


def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and its inverse for `size` places; tables for a slice are kept, longer ones are not."""
    return _kept_powers() if size < 1 << 19 else _make_powers(size.bit_length())


@functools.cache
def _kept_powers() -> tuple[np.ndarray, np.ndarray]:
    return _make_powers(19)


def _make_powers(log_size: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
    out = []
    for base in (_BASE, inverse):
        p = np.full(1 << log_size, base, dtype=np.uint64)
        p[0] = 1
        out.append(np.cumprod(p, dtype=np.uint64))
    return out[0], out[1]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every input bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def range_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of byte ranges; equal bytes give equal hashes wherever they stand."""
    if not len(starts):
        return np.zeros(0, dtype=np.uint64)
    power, inverse = _powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[: len(data)], out=sums[1:])
    return mix(((sums[ends] - sums[starts]) * inverse[starts]) ^ mix((ends - starts).astype(np.uint64)))


class Words:
    """The words of a slice of texts: `start`, `end` (bytes), `hash`, and `row` offsets into them.

    `kinds` gives each byte's kind; a word is a run of bytes of one kind other than 0.
    """

    def __init__(self, column: pa.Array, lower: bool = True, kinds: np.ndarray = WORD):
        data, self.offsets = raw_bytes(column)
        self.data = _LOWER[data] if lower else data
        kind = kinds[data]
        word = kind > 0
        first = word.copy()
        last = word.copy()
        if len(data):
            change = kind[1:] != kind[:-1]
            first[1:] &= change
            last[:-1] &= change
            cuts = self.offsets[1:-1]  # texts stand side by side, a word ends with its text
            cuts = cuts[(cuts > 0) & (cuts < len(data))]
            first[cuts] |= word[cuts]
            last[cuts - 1] |= word[cuts - 1]
        self.start = np.flatnonzero(first)
        self.end = np.flatnonzero(last) + 1
        self.row = np.searchsorted(self.start, self.offsets)
        self.hash = range_hashes(self.data, self.start, self.end)

    def spans(self, first: np.ndarray, stop: np.ndarray) -> Words:
        """The words of ranges of rows, each range as one row, without the bytes; ranges may overlap."""
        low, n = self.row[first], self.row[stop] - self.row[first]
        out = object.__new__(Words)
        out.row = np.concatenate([[0], np.cumsum(n)])
        at = np.arange(out.row[-1]) + np.repeat(low - out.row[:-1], n)
        out.hash, out.start, out.end = self.hash[at], self.start[at], self.end[at]
        return out

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.row)

    def row_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.row) - 1), self.counts)


def shingles(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of every run of n words; a text with fewer words is one run as a whole."""
    h, counts = words.hash, words.counts
    shift = [mix(h + np.uint64(0x632BE59BD9B4E019 * (k + 1) & (1 << 64) - 1)) for k in range(n)]
    total = max(0, len(h) - n + 1)
    runs = np.zeros(total, dtype=np.uint64)
    for k in range(n):
        runs = runs * np.uint64(0xD6E8FEB86659FD93) + shift[k][k : k + total]
    row = words.row_of()
    inside = row[:total] == row[n - 1 :] if total else np.zeros(0, dtype=bool)
    rows, out = row[:total][inside], mix(runs[inside])
    short = np.flatnonzero((counts > 0) & (counts < n))
    if len(short):
        whole = []
        for r in short:
            x = np.uint64(counts[r])
            with np.errstate(over="ignore"):
                for w in h[words.row[r] : words.row[r + 1]]:
                    x = mix(x * np.uint64(0xD6E8FEB86659FD93) + w)
            whole.append(x)
        rows, out = np.concatenate([rows, short]), np.concatenate([out, np.array(whole, dtype=np.uint64)])
    return rows, out


def sequence_ids(words: Words) -> np.ndarray:
    """A hash of each row's words in their order; 0 words give one value too."""
    h = words.hash
    power, back = _powers(len(h) + 1)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(h) * power[: len(h)])])
    start, end = words.row[:-1], words.row[1:]
    return mix(((sums[end] - sums[start]) * back[start]) ^ mix((end - start).astype(np.uint64)))


def distinct_sets(rows: np.ndarray, hashes: np.ndarray, n_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct hashes per row: (offsets of n_rows + 1, hashes in row order)."""
    order = np.lexsort((hashes, rows))
    rows, hashes = rows[order], hashes[order]
    keep = np.ones(len(rows), dtype=bool)
    keep[1:] = (rows[1:] != rows[:-1]) | (hashes[1:] != hashes[:-1])
    rows, hashes = rows[keep], hashes[keep]
    return np.searchsorted(rows, np.arange(n_rows + 1)), hashes
