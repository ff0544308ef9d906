"""Substring dedup with a compressed FM-index per shard.

A shard's index is the Burrows-Wheeler transform of its pieces in a wavelet matrix of packed bits with sampled ranks, the
common prefixes of neighbouring rows in a byte each, and the least document of any range of rows; the text and the suffix
array are dropped. Documents' pieces are streamed against it by backward search, one symbol a step, all at once. A match
counts only while an earlier document holds it; where one more symbol leaves none, the match is contracted to the
enclosing interval of rows and tried again. This gives the matching statistics of each place: the length of the longest
match in an earlier document that begins there, at most a window. Places with whole windows are reported as intervals.

Defined results: null and empty texts have no words; windows never cross documents; of a repeated doc_id the rows count
as one document, so none removes the other; texts shorter than a window lose nothing; rows without a doc_id are neither
before nor after any other, so they lose nothing and remove nothing; equal texts of different ids: all but the first go
as a whole; long texts are read in overlapping runs; an empty table gives an empty result; only the id and text columns
are read, so others may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .anchored import Cut, Owned, Shard, coverage, covered, runs_of, units
from .vectors import Least, doubled, text_slices

GRAM_SHARE = 3
BLOCK_WORDS = 400_000


class FMIndex:
    """Backward search over sequences of symbols from 1 up, each with the document it comes from."""

    def __init__(self, seqs: list[np.ndarray], docs: np.ndarray, cap: int):
        sizes = np.array([len(s) for s in seqs])
        ends = np.cumsum(sizes + 1) - 1
        self.n, self.cap = int(ends[-1]) + 1, cap
        body = np.ones(self.n, bool)
        body[ends] = False
        symbols = np.zeros(self.n, np.int64)
        symbols[body] = np.concatenate(seqs)
        apart = symbols + len(seqs)
        apart[ends] = np.arange(len(seqs))  # separators differ, so suffixes end with their piece
        order, common = doubled(apart, cap)
        bwt, top = symbols[order - 1], int(symbols.max(initial=0))
        self.bits = max(1, top.bit_length())
        self.words, self.ranks, self.zeros = [], [], []
        x = bwt
        for level in range(self.bits - 1, -1, -1):
            bit = (x >> level) & 1
            padded = np.zeros((self.n // 64 + 1) * 64, np.uint8)
            padded[: self.n] = bit
            words = np.packbits(padded, bitorder="little").view(np.uint64)
            self.words.append(words)
            self.ranks.append(np.concatenate([[0], np.cumsum(np.bitwise_count(words))]).astype(np.int32))
            self.zeros.append(int(self.n - bit.sum()))
            x = np.concatenate([x[bit == 0], x[bit == 1]])
        counts = np.bincount(bwt, minlength=top + 2)
        self.before = np.concatenate([[0], np.cumsum(counts)])
        self.start = self._descend(np.arange(top + 1), np.zeros(top + 1, np.int64))
        self.common = np.append(common, 0).astype(np.uint8 if cap < 256 else np.int32)
        self.near = Least(self.common, self.n)
        self.doc = Least(docs[np.searchsorted(ends, order)], self.n)

    def _descend(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        for level, words, ranks, zeros in zip(range(self.bits - 1, -1, -1), self.words, self.ranks, self.zeros, strict=True):
            ones = ranks[i >> 6] + np.bitwise_count(words[i >> 6] & ((np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)))
            i = np.where((symbol >> level) & 1 == 1, zeros + ones, i - ones)
        return i

    def extend(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row ranges of the matches after one more symbol to their left."""
        base = self.before[symbol] - self.start[symbol]
        return base + self._descend(symbol, low), base + self._descend(symbol, high)

    def contract(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(low, high, length) of the smallest larger interval of rows with a common prefix; all rows where there is none."""
        depth = np.maximum(self.common[low], self.common[high]).astype(np.int64)
        low, high = low.copy(), high.copy()
        for k in range(len(self.near.rows) - 1, -1, -1):
            row, width = self.near.rows[k], 1 << k
            at = low - width + 1
            step = (at >= 0) & (row[np.maximum(at, 0)] >= depth) & (depth > 0)
            low -= width * step
            step = (high + width <= self.n) & (row[np.minimum(high, len(row) - 1)] >= depth) & (depth > 0)
            high += width * step
        return np.where(depth > 0, low, 0), np.where(depth > 0, high, self.n), depth

    def matching_statistics(self, seqs: list[np.ndarray], docs: np.ndarray) -> list[np.ndarray]:
        """For each place of each sequence the longest match, at most cap, that begins there and that a document before the sequence's holds.

        Symbols that the index has not seen are 0.
        """
        sizes = np.array([len(s) for s in seqs])
        flat = np.concatenate(seqs)
        ends = np.cumsum(sizes)
        out = np.zeros(len(flat), np.int64)
        live = np.arange(len(seqs))
        low, high, length = np.zeros(len(seqs), np.int64), np.full(len(seqs), self.n, np.int64), np.zeros(len(seqs), np.int64)
        for step in range(int(sizes.max(initial=0))):
            live = live[sizes[live] > step]
            at = ends[live] - 1 - step
            todo = np.arange(len(live))
            while len(todo):
                who = live[todo]
                symbol = flat[at[todo]]
                a, b = self.extend(symbol, low[who], high[who])
                found = (b > a) & (symbol > 0)
                some = np.flatnonzero(found)
                found[some] = self.doc(a[some], b[some]) < docs[who[some]]
                good = who[found]
                low[good], high[good] = a[found], b[found]
                length[good] += 1
                todo = todo[~found & (length[who] > 0)]  # without a match left, the next symbol starts anew
                who = live[todo]
                low[who], high[who], length[who] = self.contract(low[who], high[who])
            out[at] = np.minimum(length[live], self.cap)
        return [out[e - n : e] for e, n in zip(ends, sizes, strict=True)]


class FMShard(Shard):
    """Pieces of a shard, in one index and streamed against it."""

    def __init__(self, window: int):
        self.window, self.parts = window, []

    def add(self, o: Owned) -> None:
        self.parts.append((o.values, o.offsets, o.first_doc))

    def close(self) -> list[np.ndarray]:
        values = np.unique(np.concatenate([v for v, _, _ in self.parts]), return_inverse=True)[1] + 1
        sizes = np.concatenate([np.diff(at) for _, at, _ in self.parts])
        seqs = np.split(values, np.cumsum(sizes)[:-1])
        docs = np.unique(np.concatenate([d for _, _, d in self.parts]), return_inverse=True)[1].astype(np.int32)
        index = FMIndex(seqs, docs, self.window)
        return [runs_of(m[: max(0, len(m) - self.window + 1)] >= self.window, self.window) for m in index.matching_statistics(seqs, docs)]


def seen_before(docs: DataFrame, window: int = 50, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(doc, twin, spans): word spans of docs (doc, twin, text) covered by windows that also start in a document with a smaller id."""
    cut = Cut(window, max(2, window // GRAM_SHARE), by_word=True)
    return covered(docs, cut, lambda: FMShard(window), later_only=True, block_units=block_words)


def remove_seen(docs: DataFrame, window: int = 50, id_col: str = "doc_id", text_col: str = "text", block_words: int = BLOCK_WORDS) -> DataFrame:
    """(id, text, n_words, n_removed): each text without its seen words, the rest joined by single spaces."""
    src = docs.select(F.col(id_col).cast("long").alias("doc"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).withColumn("twin", F.xxhash64("text"))
    spans = seen_before(src.where("doc is not null"), window, block_words)
    cut = Cut(window, 2, by_word=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in text_slices(batch, "text"):
                u = units(data, offsets, cut)
                gone = coverage(u.offsets, batch.column("spans").slice(a, b - a).to_pylist())
                raw = data.tobytes()
                texts, removed = [], []
                for r in range(b - a):
                    lo, hi = u.offsets[r], u.offsets[r + 1]
                    kept = np.flatnonzero(~gone[lo:hi]) + lo
                    texts.append(b" ".join(raw[s:e] for s, e in zip(u.starts[kept].tolist(), u.ends[kept].tolist(), strict=True)).decode())
                    removed.append(int(hi - lo) - len(kept))
                yield pa.RecordBatch.from_pydict({"doc": batch.column("doc").slice(a, b - a), "text": texts, "n_words": np.diff(u.offsets).astype(np.int64), "n_removed": pa.array(removed, pa.int64())})

    out = src.join(spans, ["doc", "twin"], "left").select("doc", "text", "spans").mapInArrow(run, "doc long, text string, n_words long, n_removed long")
    return out.withColumnRenamed("doc", id_col).withColumnRenamed("text", text_col)
