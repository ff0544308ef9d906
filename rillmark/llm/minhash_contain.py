"""Benchmark decontamination by size-partitioned MinHash containment search.

Items are partitioned by size (number of shingles, in powers of two). For each size class a long document is read as
overlapping windows of twice the class's size, so that an item held by the document has a high Jaccard similarity with
some window, however long the document is. A window whose MinHash agrees with an item's in any of a number of functions
is a candidate. Each class has so many functions, `perms` at least, that its smallest item, when just enough of it lies
anywhere in a document, misses all of them with a probability of at most 1e-6. Items of up to EXACT shingles miss
nothing: of n shingles of which s must be shared, any n - s + 1 hold a shared one, so the least n - s + 1 of each item
are looked up among all shingles of the document. Candidates are verified by exact containment of the item's shingle set
in the document's.

Items are the query set; they are read in blocks of bounded size, each broadcast to the documents, so documents are
never shuffled.

Defined results: an item shorter than k words counts as the one shingle of all its words; null and empty items match
nothing, nor do null and empty texts; repeated items and documents give repeated pairs only as often as the rows repeat,
with or without an id; an item that just reaches the threshold counts; texts are read as a whole, however long; an empty
table of either kind gives an empty result; only the id and text columns are read, so others may have any name, and
without_items() keeps them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .vectors import LOWER, SLICE, gram_hashes, mix, text_slices, word_hashes, words

BLOCK_BYTES = 4 << 20
PERMS = 48
#: Items of up to so many shingles are looked up without MinHash.
EXACT = 16
MISS = 1e-6


def _item_grams(texts: list[str], k: int) -> list[tuple[int, np.ndarray]]:
    """(shingle length, sorted distinct shingles) of each text."""
    out = []
    for t in texts:
        data = LOWER[np.frombuffer((t or "").encode(), np.uint8)]
        starts, ends, _ = words(data, np.array([0, len(data)]))
        size = min(k, len(starts))
        out.append((size, np.unique(gram_hashes(word_hashes(data, starts, ends), size)) if size else np.zeros(0, np.uint64)))
    return out


def functions(level: int, least: float) -> int:
    """How many functions the class of 2 ** (level - 1) + 1 to 2 ** level shingles needs.

    The least shingle of an item of n is shared, and is also the least of a window that holds it, with a chance of at
    least shared / (n + shingles of a window - 1), wherever the shared ones lie; that is lowest for the smallest item.
    """
    n = (1 << level >> 1) + 1
    return math.ceil(math.log(MISS) / math.log1p(-min(max(1, math.ceil(least * n)) / (n + (2 << level) - 1), 0.999)))


class Items:
    """One block of items: MinHash tables by shingle length and size class, and the least shingles of short items by length."""

    def __init__(self, ids: list, texts: list[str], k: int, perms: int, least: float):
        self.ids, self.sets = ids, _item_grams(texts, k)
        self.lengths = sorted({size for size, _ in self.sets if size})
        groups: dict[tuple[int, int], list[int]] = {}
        short: dict[int, list[tuple[np.ndarray, int]]] = {}
        for i, (size, grams) in enumerate(self.sets):
            if size and len(grams) <= EXACT:
                short.setdefault(size, []).append((grams[: len(grams) - max(1, math.ceil(least * len(grams))) + 1], i))
            elif size:
                groups.setdefault((size, int(len(grams) - 1).bit_length()), []).append(i)
        self.short: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for size, found in short.items():
            values, who = np.concatenate([g for g, _ in found]), np.repeat([i for _, i in found], [len(g) for g, _ in found])
            order = np.argsort(values, kind="stable")
            self.short[size] = values[order], who[order]
        counts = {key: max(perms, functions(key[1], least)) for key in groups}
        rng = np.random.default_rng(5)
        self.mult = rng.integers(1, 2**62, max(counts.values(), default=0)).astype(np.uint64) * np.uint64(2) + np.uint64(1)
        self.classes: dict[tuple[int, int], list[tuple[np.ndarray, np.ndarray]]] = {}
        for key, members in groups.items():
            tables = []
            for m in self.mult[: counts[key]]:
                mins = np.array([permuted(self.sets[i][1], m).min() for i in members], np.uint64)
                order = np.argsort(mins, kind="stable")
                tables.append((mins[order], np.array(members)[order]))
            self.classes[key] = tables


def permuted(x: np.ndarray, m: np.uint64) -> np.ndarray:
    """One of the random orders of shingles; the top bits decide."""
    return (x * m) ^ (m >> np.uint64(7))


def candidates(items: Items, grams: np.ndarray, bounds: np.ndarray, size: int) -> set[tuple[int, int]]:
    """(row, item) pairs where a window of the row agrees in a MinHash, or the row has one of a short item's least shingles; bounds: each row's range of grams."""
    found: set[tuple[int, int]] = set()
    if size in items.short and len(grams):
        values, who = items.short[size]
        a, b = np.searchsorted(values, grams, "left"), np.searchsorted(values, grams, "right")
        hit = np.flatnonzero(b > a)
        n = (b - a)[hit]
        item = who[np.repeat(a[hit] - np.cumsum(n) + n, n) + np.arange(n.sum())]
        pairs = np.unique(np.stack([np.repeat(np.searchsorted(bounds, hit, "right") - 1, n), item], 1), axis=0)
        found.update(map(tuple, pairs.tolist()))
    for (length, level), tables in items.classes.items():
        if length != size or not len(grams):
            continue
        width = 1 << level
        rows = len(bounds) - 1
        blocks = np.maximum(-(-np.diff(bounds) // width), 0)
        row = np.repeat(np.arange(rows), blocks)
        if not len(row):
            continue
        starts = np.repeat(bounds[:-1] - (np.cumsum(blocks) - blocks) * width, blocks) + np.arange(len(row)) * width
        # Rows' grams lie one after another, so the blocks cover them without a gap and reduceat sees each block alone.
        paired = np.flatnonzero(row[1:] == row[:-1])
        for (mins, who), m in zip(tables, items.mult[: len(tables)], strict=True):
            low = np.minimum.reduceat(permuted(grams, m), starts)
            low[paired] = np.minimum(low[paired], low[paired + 1])
            a, b = np.searchsorted(mins, low, "left"), np.searchsorted(mins, low, "right")
            for w in np.flatnonzero(b > a):
                found.update((int(row[w]), int(i)) for i in who[a[w] : b[w]])
    return found


def _matches(it: Items, ids: list, batch: pa.RecordBatch, least: float) -> Iterator[tuple]:
    """(row of the batch, item id, shingles of the item, shared ones) of each verified match."""
    for a, _, data, offsets in text_slices(batch, "text", SLICE):
        low = LOWER[data]
        starts, ends, at = words(low, offsets)
        hashes = word_hashes(low, starts, ends)
        for size in it.lengths:
            n = np.maximum(np.diff(at) - size + 1, 0)
            bounds = np.concatenate([[0], np.cumsum(n)])
            where = np.repeat(at[:-1] - bounds[:-1], n) + np.arange(bounds[-1])
            grams = gram_hashes(hashes, size)[where] if len(where) else np.zeros(0, np.uint64)
            known: dict[int, np.ndarray] = {}
            for r, i in sorted(candidates(it, grams, bounds, size)):
                if r not in known:
                    known[r] = np.sort(grams[bounds[r] : bounds[r + 1]])
                mine = it.sets[i][1]
                pos = np.minimum(np.searchsorted(known[r], mine), len(known[r]) - 1)
                shared = int((known[r][pos] == mine).sum())
                if shared >= least * len(mine):
                    yield a + r, ids[i], len(mine), shared


def item_blocks(items: DataFrame, k: int, perms: int, block_bytes: int, least: float) -> Iterator:
    """The query set as broadcast MinHash tables of block_bytes of text each."""
    spark = items.sparkSession
    sized = items.where("text is not null").select(F.col("item_id").cast("long").alias("item_id"), "text")
    total = sized.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    n = -(-int(total) // block_bytes)
    for b in range(n):
        part = sized if n == 1 else sized.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == b)
        got = part.toArrow().to_pydict()  # one block
        yield spark.sparkContext.broadcast(Items(got["item_id"], got["text"], k, perms, least))


def contained(docs: DataFrame, items: DataFrame, k: int = 5, least: float = 0.8, perms: int = PERMS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, item_id, n_item, n_shared, containment) of every document that holds at least `least` of an item's shingles."""
    schema = "doc_id long, item_id long, n_item long, n_shared long, containment double"
    out = None
    for table in item_blocks(items, k, perms, block_bytes, least):

        def search(batches: Iterator[pa.RecordBatch], table=table) -> Iterator[pa.RecordBatch]:
            it = table.value
            for batch in batches:
                doc = batch.column("doc_id").to_pylist()
                rows = [(doc[r], i, n, shared, shared / n) for r, i, n, shared in _matches(it, it.ids, batch, least)]
                if rows:
                    yield pa.RecordBatch.from_pydict(dict(zip(("doc_id", "item_id", "n_item", "n_shared", "containment"), map(list, zip(*rows, strict=True)), strict=True)))

        hits = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(search, schema)
        out = hits if out is None else out.unionByName(hits)
    return out if out is not None else docs.sparkSession.createDataFrame([], schema)


def without_items(docs: DataFrame, items: DataFrame, k: int = 5, least: float = 0.8, perms: int = PERMS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of docs, with all their columns, that hold no item; one pass a block of items, no shuffle."""
    for table in item_blocks(items, k, perms, block_bytes, least):

        def clean(batches: Iterator[pa.RecordBatch], table=table) -> Iterator[pa.RecordBatch]:
            it = table.value
            for batch in batches:
                keep = np.ones(batch.num_rows, bool)
                keep[[r for r, *_ in _matches(it, it.ids, batch, least)]] = False
                yield batch.filter(pa.array(keep))

        docs = docs.mapInArrow(clean, docs.schema)
    return docs
