"""Numpy helpers for whole batches of texts: words, rolling hashes, content anchors."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_rng = np.random.default_rng(20240607)
BYTE = _rng.integers(1, 2**63, 256, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
BASE = 0x9E3779B97F4A7C15
BASE_INV = pow(BASE, -1, 2**64)
BLANK = np.zeros(256, bool)
BLANK[[0x20, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Bytes of text whose words are hashed at once where a task holds little else: each costs some 50 bytes meanwhile.
SLICE = 1 << 18
SET_BITS, MOST_ROWS = 52, 4000
POS_BITS = 24
POS_MASK = np.uint64((1 << POS_BITS) - 1)

_powers: list[tuple[np.ndarray, np.ndarray]] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE ** i and its inverse modulo 2 ** 64, for i below n at least."""
    if not _powers or len(_powers[0][0]) < n:
        size = 1 << max(16, int(n).bit_length())
        out = []
        for base in (BASE, BASE_INV):
            p = np.ones(1, np.uint64)
            while len(p) < size:
                p = np.concatenate([p, p * np.uint64(pow(base, len(p), 2**64))])
            out.append(p)
        _powers[:] = [tuple(out)]
    return _powers[0]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads each bit over all."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def prefix_sums(values: np.ndarray) -> np.ndarray:
    """Prefix sums that span_hash() reads the hash of any span from."""
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(len(values))[0][: len(values)], out=out[1:])
    return out


def span_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return mix((sums[end] - sums[start]) * powers(len(sums))[1][start] + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def text_slices(batch: pa.RecordBatch, column: str, limit: int = 1 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row, bytes, offsets) of runs of rows with about `limit` bytes of text; null reads as empty."""
    col = pc.fill_null(batch.column(column), "").cast(pa.large_binary())
    offsets = np.frombuffer(col.buffers()[1], np.int64)[col.offset : col.offset + len(col) + 1]
    data = np.frombuffer(col.buffers()[2] or b"", np.uint8)
    a = 0
    while a < len(col):
        b = min(a + MOST_ROWS, max(a + 1, int(np.searchsorted(offsets, offsets[a] + limit, "right")) - 1))
        yield a, b, data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
        a = b


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, word_offsets): byte ranges of the words of all rows, and each row's range of words."""
    n = len(data)
    blank = BLANK[data]
    begin, stop = ~blank, ~blank
    begin[1:] &= blank[:-1] if n else blank
    stop[:-1] &= blank[1:] if n else blank
    heads = offsets[:-1][offsets[:-1] < n]
    begin[heads] = ~blank[heads]
    tails = offsets[1:][offsets[1:] > 0] - 1
    stop[tails] = ~blank[tails]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(stop) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, long: int = 1 << 20) -> np.ndarray:
    """Hash of each word; bytes of a long text are read in runs of about `long`, so the sums stay small."""
    out = np.empty(len(starts), np.uint64)
    a = 0
    while a < len(starts):
        b = max(a + 1, int(np.searchsorted(ends, starts[a] + long, "right")))
        from_ = starts[a]
        out[a:b] = span_hash(prefix_sums(BYTE[data[from_ : ends[b - 1]]]), starts[a:b] - from_, ends[a:b] - from_)
        a = b
    return out


def gram_hashes(values: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of k values, also across rows; the caller keeps those within a row."""
    if len(values) < k:
        return np.zeros(0, np.uint64)
    out = values[: len(values) - k + 1].copy()
    for j in range(1, k):
        out = mix(out) * np.uint64(BASE) + values[j : len(values) - k + 1 + j]
    return mix(out)


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    size = 1
    n = len(x) - w + 1
    while size * 2 <= w:
        x = np.minimum(x[:-size], x[size:])
        size *= 2
    return np.minimum(x[:n], x[w - size : w - size + n])


class Least:
    """Least value of any range of an array, by minima over powers of two."""

    def __init__(self, x: np.ndarray, longest: int):
        self.rows, width = [x], 1
        while width * 2 <= longest:
            self.rows.append(np.minimum(self.rows[-1][:-width], self.rows[-1][width:]))
            width *= 2

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        level = np.frexp((end - start).astype(float))[1] - 1
        out = np.empty(len(start), self.rows[0].dtype)
        for k in np.unique(level):
            m = level == k
            out[m] = np.minimum(self.rows[k][start[m]], self.rows[k][end[m] - (1 << k)])
        return out


def doubled(symbols: np.ndarray, cap: int) -> tuple[np.ndarray, np.ndarray]:
    """(suffix array, common prefix with the suffix before, at most cap) by doubling, in memory; the last symbol is its only one.

    Suffixes that agree in cap symbols may come in any order.
    """
    n = len(symbols)
    rank = np.unique(symbols, return_inverse=True)[1].astype(np.int32)
    order, width, ranks = np.argsort(rank, kind="stable"), 1, [rank]
    while width < cap and rank[order[-1]] < n - 1:
        key = rank * np.int64(n + 1)
        key[: max(0, n - width)] += rank[width:] + 1
        order = np.argsort(key, kind="stable")
        key = key[order]
        rank = np.empty(n, np.int32)
        rank[order] = np.cumsum(np.concatenate([[0], key[1:] != key[:-1]]))
        ranks.append(rank)
        width *= 2
    a, b = order[:-1].copy(), order[1:].copy()
    common = np.zeros(n, np.int64)
    for k in range(len(ranks) - 1, -1, -1):
        step = (ranks[k][np.minimum(a, n - 1)] == ranks[k][np.minimum(b, n - 1)]) & (np.maximum(a, b) < n)
        step = step.astype(np.int64) << k
        a += step
        b += step
        common[1:] += step
    return order, np.minimum(common, cap)


def shingle_sets(values: np.ndarray, word_offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, offsets): for each row the sorted distinct 52-bit hashes of its runs of k words; with fewer words, of the whole.

    Two different shingles of a pair of documents share a hash with a chance of their number squared over 2 ** 52.
    """
    rows = len(word_offsets) - 1
    n = np.diff(word_offsets)
    grams = gram_hashes(values, k)
    count = np.maximum(n - k + 1, 0)
    row = np.repeat(np.arange(rows), count)
    at = np.repeat(word_offsets[:-1] - (np.cumsum(count) - count), count) + np.arange(count.sum())
    got = grams[at]
    short = np.flatnonzero((n > 0) & (n < k))
    if len(short):
        whole = np.array([_whole(values[word_offsets[r] : word_offsets[r + 1]]) for r in short], np.uint64)
        row, got = np.concatenate([row, short]), np.concatenate([got, whole])
    packed = np.sort((row.astype(np.uint64) << np.uint64(SET_BITS)) | (got >> np.uint64(64 - SET_BITS)))
    keep = np.ones(len(packed), bool)
    keep[1:] = packed[1:] != packed[:-1]
    packed = packed[keep]
    offsets = np.searchsorted(packed, np.arange(rows + 1).astype(np.uint64) << np.uint64(SET_BITS))
    return packed & np.uint64((1 << SET_BITS) - 1), offsets


def _whole(values: np.ndarray) -> int:
    return int(gram_hashes(values, len(values))[0] ^ np.uint64(len(values)))
