"""Cutting texts into pieces that meet wherever they can repeat.

The substring operators look for windows of `window` units (words or bytes) that occur more than once. Each window is
owned by the least hash of its runs of `gram` units (the last of equal ones), so equal windows are owned alike; windows
of one document that follow each other under one owner form a piece. Pieces go to a shard by their owner's hash: a
shard holds all windows that could be equal, and shards need not be compared with each other. Equal pieces are kept once
with the first document and the number of their occurrences, so a group of copies costs one piece; where all pieces of an
owner are equal, nothing is left to search. A shard takes only pieces that share, around the owner's gram, a span with
another piece which every window on that side of the gram contains.

An owner with more distinct content than a shard or OWNER holds (a template with a different number in each document) is not
sent to one task: its windows are told apart one by one, each being its own owner, so equal ones meet by their hash.
A long text is cut in runs of LONG units that overlap by a window less one unit.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import forget, saved
from .vectors import BYTE, POS_MASK, mix, prefix_sums, sliding_min, span_hash, text_slices, word_hashes, words

#: Units of a text that are cut into pieces at a time; below 2 ** 24.
LONG = 1 << 20
#: Units of whole owners that a task reads before it looks for shared spans.
STEP = 1 << 19
#: Most units of one owner's distinct pieces that go to one task.
OWNER = 4 << 20
#: Parts of a window's places around its owner's gram; a span is looked up for each.
SIDES = 4


@dataclass(frozen=True)
class Cut:
    window: int
    gram: int
    by_word: bool


@dataclass
class Units:
    """The units of a run of rows: values (word hashes or bytes) and each row's range of them."""

    values: np.ndarray
    offsets: np.ndarray
    starts: np.ndarray | None = None
    ends: np.ndarray | None = None


def units(data: np.ndarray, offsets: np.ndarray, cut: Cut) -> Units:
    if not cut.by_word:
        return Units(data, offsets)
    starts, ends, at = words(data, offsets)
    return Units(word_hashes(data, starts, ends), at, starts, ends)


def pieces(u: Units, cut: Cut, long: int = LONG) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, first unit, end unit, owner hash, content hash) of each piece; units count from the start of the run of rows."""
    if len(u.offsets) > 2 or len(u.values) <= long + cut.window:
        return _pieces(u, cut)
    parts = []
    for a in range(0, len(u.values) - cut.window + 1, long):
        part = u.values[a : a + long + cut.window - 1]
        row, start, end, owner, content = _pieces(Units(part, np.array([0, len(part)])), cut)
        parts.append((row, start + a, end + a, owner, content))
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def _pieces(u: Units, cut: Cut) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    none = tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, np.uint64))
    n = len(u.values)
    if n < cut.window:
        return none
    sums = prefix_sums(u.values if cut.by_word else BYTE[u.values])
    at = np.arange(n - cut.gram + 1)
    grams = span_hash(sums, at, at + cut.gram)
    key = (grams & ~POS_MASK) | (POS_MASK - at.astype(np.uint64))
    low = sliding_min(key, cut.window - cut.gram + 1)
    owner = (POS_MASK - (low & POS_MASK)).astype(np.int64)
    sizes = np.diff(u.offsets)
    counts = np.maximum(sizes - cut.window + 1, 0)
    row = np.repeat(np.arange(len(sizes)), counts)
    if not len(row):
        return none
    begin = np.repeat(u.offsets[:-1] - (np.cumsum(counts) - counts), counts) + np.arange(len(row))
    mine = owner[begin]
    head = np.ones(len(row), bool)
    head[1:] = (row[1:] != row[:-1]) | (mine[1:] != mine[:-1])
    first = np.flatnonzero(head)
    last = np.append(first[1:], len(row)) - 1
    start, end = begin[first], begin[last] + cut.window
    return row[first], start, end, grams[mine[first]], span_hash(sums, start, end)


_OCC = pa.schema([("doc", pa.int64()), ("twin", pa.int64()), ("at", pa.int32()), ("size", pa.int32()), ("owner", pa.int64()), ("piece", pa.int64())])
_OCC_DDL = "doc long, twin long, at int, size int, owner long, piece long"


def occurrences(docs: DataFrame, cut: Cut) -> DataFrame:
    """(doc, twin, at, size, owner, piece) of each piece of each document; docs has doc, twin and text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, twins = batch.column("doc").to_numpy(), batch.column("twin").to_numpy()
            for a, _, data, offsets in text_slices(batch, "text"):
                u = units(data, offsets, cut)
                row, start, end, owner, content = pieces(u, cut)
                if len(row):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(ids[a + row]), pa.array(twins[a + row]), pa.array((start - u.offsets[row]).astype(np.int32)), pa.array((end - start).astype(np.int32)), pa.array(owner.view(np.int64)), pa.array(content.view(np.int64))], schema=_OCC
                    )

    return docs.select("doc", "twin", "text").mapInArrow(run, _OCC_DDL)


def _wanted(batch: pa.RecordBatch, a: int, b: int, u: Units) -> tuple[pa.StructArray, np.ndarray, np.ndarray, np.ndarray]:
    """(the pieces wanted of rows a to b, their rows, first units and sizes)."""
    want = batch.column("want").slice(a, b - a)
    flat = want.flatten()
    row = np.repeat(np.arange(b - a), pc.list_value_length(want).to_numpy())
    at, size = (flat.field(k).to_numpy() for k in ("at", "size"))
    return flat, row, u.offsets[row] + at, size.astype(np.int64)


def _ranges(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    return np.repeat(start - (np.cumsum(count) - count), count) + np.arange(count.sum())


def windows(docs: DataFrame, hot: DataFrame, cut: Cut) -> DataFrame:
    """The windows of the pieces of hot (doc, twin, at, size), each an owner and piece of its own, as occurrences() gives them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, twins = batch.column("doc").to_numpy(), batch.column("twin").to_numpy()
            for a, b, data, offsets in text_slices(batch, "text"):
                u = units(data, offsets, cut)
                _, row, start, size = _wanted(batch, a, b, u)
                count = size - cut.window + 1
                for k in range(0, len(start), 1024):
                    s, n, of = start[k : k + 1024], count[k : k + 1024], row[k : k + 1024]
                    body = _ranges(s, size[k : k + 1024])
                    values = u.values[body] if cut.by_word else BYTE[u.values[body]]
                    inner = np.concatenate([[0], np.cumsum(size[k : k + 1024])])[:-1]
                    at = _ranges(inner, n)
                    whole = span_hash(prefix_sums(values), at, at + cut.window).view(np.int64)
                    place = _ranges(s - u.offsets[of], n)
                    who = a + np.repeat(of, n)
                    yield pa.RecordBatch.from_arrays([pa.array(ids[who]), pa.array(twins[who]), pa.array(place.astype(np.int32)), pa.array(np.full(len(who), cut.window, np.int32)), pa.array(whole), pa.array(whole)], schema=_OCC)

    grouped = hot.groupBy("doc", "twin").agg(F.collect_set(F.struct("at", "size")).alias("want"))
    return docs.join(grouped, ["doc", "twin"]).select("doc", "twin", "text", "want").mapInArrow(run, _OCC_DDL)


def contents(docs: DataFrame, wanted: DataFrame, cut: Cut) -> DataFrame:
    """(owner, piece, first_doc, n, body) of the wanted pieces (doc, twin, at, size, owner, piece, n), read from their documents.

    body holds the piece's bytes, or 8 bytes a word with the word's hash. Rows that are alike give a piece once each.
    """
    schema = "owner long, piece long, first_doc long, n long, body binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in text_slices(batch, "text"):
                u = units(data, offsets, cut)
                flat, row, start, count = _wanted(batch, a, b, u)
                body = np.ascontiguousarray(u.values[_ranges(start, count)]).view(np.uint8)
                width = 8 if cut.by_word else 1
                bodies = pa.Array.from_buffers(pa.binary(), len(count), [None, pa.py_buffer(np.concatenate([[0], np.cumsum(count * width)]).astype(np.int32)), pa.py_buffer(body)])
                yield pa.RecordBatch.from_arrays([flat.field("owner"), flat.field("piece"), pa.array(batch.column("doc").to_numpy()[a + row]), flat.field("n"), bodies], names=["owner", "piece", "first_doc", "n", "body"])

    grouped = wanted.groupBy("doc", "twin").agg(F.collect_list(F.struct("at", "size", "owner", "piece", "n")).alias("want"))
    return docs.join(grouped, ["doc", "twin"]).select("doc", "text", "want").mapInArrow(run, schema)


@dataclass
class Owned:
    """Distinct pieces of some whole owners: one after another in values."""

    owner: np.ndarray
    piece: np.ndarray
    first_doc: np.ndarray
    n: np.ndarray
    values: np.ndarray
    offsets: np.ndarray

    def take(self, rows: np.ndarray) -> Owned:
        size = np.diff(self.offsets)[rows]
        return Owned(self.owner[rows], self.piece[rows], self.first_doc[rows], self.n[rows], self.values[_ranges(self.offsets[rows], size)], np.concatenate([[0], np.cumsum(size)]))


def _owners(batches: Iterator[pa.RecordBatch], by_word: bool, step: int) -> Iterator[Owned]:
    """Runs of whole owners with `step` units or more (the last: with what is left), from pieces in order of owner."""
    held: list[pa.RecordBatch] = []
    width, size, last = 8 if by_word else 1, 0, None

    def close() -> Owned:
        t = pa.Table.from_batches(held).combine_chunks()
        body = t.column("body").cast(pa.large_binary()).combine_chunks()
        body = body.chunk(0) if isinstance(body, pa.ChunkedArray) else body
        offsets = np.frombuffer(body.buffers()[1], np.int64)[body.offset : body.offset + len(body) + 1]
        data = np.frombuffer(body.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
        values = data.view(np.uint64) if by_word else data
        owner, piece, first, n = (t.column(c).to_numpy() for c in ("owner", "piece", "first_doc", "n"))
        all_ = Owned(owner, piece, first, n, values, (offsets - offsets[0]) // width)
        new = np.ones(len(owner), bool)
        new[1:] = (owner[1:] != owner[:-1]) | (piece[1:] != piece[:-1])  # rows that are alike gave the same piece
        return all_ if new.all() else all_.take(np.flatnonzero(new))

    for batch in batches:
        if not batch.num_rows:
            continue
        owner = batch.column("owner").to_numpy()
        sums = np.concatenate([[0], np.cumsum(pc.binary_length(batch.column("body")).to_numpy() // width)])
        a = 0
        for c in [0, *(np.flatnonzero(owner[1:] != owner[:-1]) + 1).tolist()]:
            if (c > 0 or owner[0] != last) and size + sums[c] - sums[a] >= step:
                if c > a:
                    held.append(batch.slice(a, c - a))
                yield close()
                held, size, a = [], 0, c
        held.append(batch.slice(a))
        size += int(sums[-1] - sums[a])
        last = owner[-1]
    if held:
        yield close()


def sharing(o: Owned, cut: Cut) -> np.ndarray:
    """Which pieces may have a window in common with another one of their owner.

    A window with x units left of the owner's gram, x from a to b, contains the span from a units left of the gram to
    window - b units right of the gram's start; pieces with such a window in common share that span.
    """
    sums = prefix_sums(o.values if cut.by_word else BYTE[o.values])
    n, start, end = len(o.values), o.offsets[:-1], o.offsets[1:]
    at = np.arange(n - cut.gram + 1)
    grams = span_hash(sums, at, at + cut.gram).view(np.int64)
    # The gram that a piece's windows share is the last one of its first window with the owner's hash.
    low, high = np.maximum(start, end - cut.window), start + cut.window - cut.gram
    count = high - low + 1
    place = _ranges(low, count)
    which = np.repeat(np.arange(len(start)), count)
    anchor = np.full(len(start), -1)
    hit = np.flatnonzero(grams[place] == o.owner[which])
    anchor[which[hit]] = place[hit]  # places rise within a piece, so the last one stays
    if (anchor < 0).any():
        raise AssertionError("a piece without its owner's gram")
    out = np.zeros(len(start), bool)
    cuts = np.linspace(0, cut.window - cut.gram + 1, SIDES + 1).astype(np.int64)
    for a, b in zip(cuts[:-1], cuts[1:] - 1, strict=True):
        x, y = anchor - a, anchor + cut.window - b
        has = np.flatnonzero((x >= start) & (y <= end))
        if not len(has):
            continue
        key = mix(span_hash(sums, x[has], y[has]) ^ o.owner[has].view(np.uint64))
        _, inverse, counts = np.unique(key, return_inverse=True, return_counts=True)
        out[has[counts[inverse] > 1]] = True
    return out


class Shard:
    """Pieces that are searched together; add() takes them in order of arrival, close() tells the covered spans of each."""

    def add(self, o: Owned) -> None:
        raise NotImplementedError

    def close(self) -> list[np.ndarray]:
        raise NotImplementedError


def solved(bodies: DataFrame, shard: Callable[[], Shard], cut: Cut, block_units: int, step: int = STEP) -> DataFrame:
    """(owner, piece, spans, first_doc) of the pieces with covered spans (start, end, start, end, ...), found shard by shard.

    A task reads its pieces in order of owner and closes a shard at the first change of owner after block_units units.
    """
    names = ["owner", "piece", "spans", "first_doc"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[Owned] = []
        now, size = shard(), 0

        def close() -> Iterator[pa.RecordBatch]:
            spans = now.close()
            full = np.array([i for i, s in enumerate(spans) if len(s)], np.int64)
            if len(full):
                owner, piece, first = (np.concatenate([getattr(o, k) for o in held])[full] for k in ("owner", "piece", "first_doc"))
                yield pa.RecordBatch.from_arrays([pa.array(owner), pa.array(piece), pa.array([spans[i].astype(np.int32) for i in full], pa.list_(pa.int32())), pa.array(first)], names=names)

        for o in _owners(batches, cut.by_word, step):
            o = o.take(np.flatnonzero(sharing(o, cut)))
            if len(o.owner):
                now.add(o)
                size += len(o.values)
                o.values = o.values[:0]
                held.append(o)
            if size >= block_units:
                yield from close()
                now, size, held = shard(), 0, []
        if held:
            yield from close()

    shards = bodies.repartition("owner").sortWithinPartitions("owner", "first_doc", "piece")
    return shards.mapInArrow(run, "owner long, piece long, spans array<int>, first_doc long")


def _distinct(found: DataFrame) -> DataFrame:
    return found.groupBy("owner", "piece").agg(
        F.min("doc").alias("doc"), F.min_by("twin", "doc").alias("twin"), F.min_by("at", "doc").alias("at"), F.min("size").alias("size"), F.count("*").alias("n")
    )


def covered(docs: DataFrame, cut: Cut, shard: Callable[[], Shard], later_only: bool, block_units: int) -> DataFrame:
    """(doc, twin, spans) of the documents with covered units; docs has doc, text and twin, which tells rows of one doc apart.

    later_only: only windows that also start in an earlier document count, so a piece seen before is covered whole.
    """
    found = saved(occurrences(docs, cut), "pieces")
    distinct = saved(_distinct(found), "distinct")
    owners = distinct.groupBy("owner").agg(F.count("*").alias("kinds"), F.sum("size").alias("units")).where("kinds > 1")
    owners = saved(owners.select("owner", (F.col("units") > min(block_units, OWNER)).alias("hot")), "owners")
    wanted = distinct.join(owners.where("not hot"), "owner", "left_semi").select("doc", "twin", "at", "size", "owner", "piece", "n")
    answers = saved(solved(contents(docs, wanted, cut), shard, cut, block_units), "answers")
    seen = ("owner", "piece", F.col("doc").alias("first_doc"), F.lit(None).cast("array<int>").alias("spans"))  # without spans: the whole piece
    again = [distinct.where("n > 1").select(*seen)]
    hot = owners.where("hot").select("owner")
    if hot.limit(1).count():
        each = saved(windows(docs, found.join(hot, "owner", "left_semi"), cut), "windows")
        again = [again[0].join(hot, "owner", "left_anti"), _distinct(each).where("n > 1").select(*seen)]
        found_all = found.join(hot, "owner", "left_anti").unionByName(each)
    else:
        each, found_all = None, found
    told = answers.select("owner", "piece", "first_doc", "spans")
    for part in again:
        told = told.unionByName(part)
    hits = found_all.join(told, ["owner", "piece"])
    if later_only:
        hits = hits.where(F.when(F.col("spans").isNull(), F.col("doc") > F.col("first_doc")).otherwise(F.col("doc") == F.col("first_doc")))
    spans = F.transform(F.coalesce("spans", F.array(F.lit(0), F.col("size"))), lambda x: x + F.col("at"))
    out = saved(hits.select("doc", "twin", spans.alias("spans")).groupBy("doc", "twin").agg(F.flatten(F.collect_set("spans")).alias("spans")), "spans")
    forget(found, distinct, owners, answers, *([each] if each is not None else []))
    return out


def coverage(offsets: np.ndarray, rows: list) -> np.ndarray:
    """For each unit of a run of rows whether one of its row's spans covers it."""
    step = np.zeros(offsets[-1] + 1, np.int32)
    for r, spans in enumerate(rows):
        if spans is not None and len(spans):
            s = np.asarray(spans).reshape(-1, 2) + offsets[r]
            np.add.at(step, s[:, 0], 1)
            np.add.at(step, s[:, 1], -1)
    return np.cumsum(step[:-1]) > 0


def runs_of(mask: np.ndarray, window: int) -> np.ndarray:
    """Spans (start, end, start, end, ...) that windows at the marked starts cover."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], mask.view(np.int8), [0]])))
    spans = edge.reshape(-1, 2).copy()
    spans[:, 1] += window - 1
    return spans.ravel()
