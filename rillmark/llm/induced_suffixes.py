"""Exact substring dedup with suffix arrays built by external induced sorting.

A shard's text lies on disk where it exceeds the memory that a shard may use. Its suffixes at local minima (LMS) are
named by a distribution sort of the LMS substrings, the string of names is sorted by the same method, recursively, until
it fits in memory, and the others are induced: each suffix that is read pushes its left neighbour into a priority queue.
The queue's order is (first symbol, rank of the suffix that pushed); its entries carry the suffix and its common prefix
with the entry before it under that symbol, one more than the least value read since that was pushed. One sweep in
ascending order gives the suffixes that are above their right neighbour, one in descending order the others. The common
prefixes of the LMS suffixes come from those of their names, which the recursion has induced, and the first names that
differ. The queue keeps its entries in bins of symbols; blocks of entries go to disk when they outgrow the memory.

Values saturate at the window, the only threshold needed, so suffixes that agree that far may come in any order. The
disk is the task's own (Spark's local folders, as for its own spills); files have no name and vanish with the task, and
a lost executor's tasks start anew elsewhere.

Defined results: null reads as empty; matches never cross documents; a string that repeats only within one document,
overlapping itself or not, counts; of repeated rows each makes the other's strings repeated, as do rows without an id;
texts shorter than a window lose nothing; long texts are read in overlapping runs; an empty table gives an empty result;
only the id and text columns are read, so others may have any name.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .anchored import Cut, Owned, Shard, coverage, covered, runs_of, units
from .vectors import Least, doubled, text_slices

#: Bytes of a shard, and the most bytes of its text, its queue or another of its arrays that are in memory; what is larger is on disk.
BLOCK_BYTES = 128 << 20
MEMORY = 64 << 20
END, BETWEEN, FIRST = 0, 1, 2
#: Most bins of a queue, and entries that are read at a time.
BINS, READ = 64, 8192


def _file():
    """A nameless file in Spark's local folder of this task; the system's own where there is none."""
    folder = os.environ.get("SPARK_LOCAL_DIRS", "").split(",")[0]
    return tempfile.TemporaryFile(dir=folder if os.path.isdir(folder) else None)


def _array(n: int, dtype, memory: int) -> np.ndarray:
    """Zeros, on disk where they exceed the memory."""
    return np.memmap(_file(), dtype, "w+", shape=(n,)) if n * np.dtype(dtype).itemsize > memory and n else np.zeros(n, dtype)


class Queue:
    """Entries (key, suffix, common prefix) in order of key and arrival, in bins of keys; blocks beyond the memory go to disk."""

    def __init__(self, counts: np.ndarray, memory: int):
        self.memory, self.held, self.spilled, self.file = memory, 0, 0, None
        total = np.cumsum(counts)
        cut = np.searchsorted(total, np.arange(1, BINS) * (total[-1] / BINS), "left") + 1
        self.starts = np.unique(np.concatenate([[0], cut]))  # the first key of each bin
        self.starts = self.starts[self.starts < len(counts)]
        self.bins: list[list] = [[] for _ in self.starts]

    def push(self, key: np.ndarray, at: np.ndarray, common: np.ndarray) -> None:
        """Add entries in ascending order of key."""
        bounds = np.searchsorted(key, self.starts)
        for b in np.flatnonzero(np.diff(np.append(bounds, len(key)))).tolist():
            x, y = bounds[b], bounds[b + 1] if b + 1 < len(bounds) else len(key)
            block = (key[x:y], at[x:y], common[x:y])
            size = sum(c.nbytes for c in block)
            if self.held + size > self.memory:
                self.file = self.file or _file()
                place = self.file.seek(0, 2)
                self.file.write(b"".join(c.tobytes() for c in block))
                self.spilled += size
                self.bins[b].append((place, y - x, tuple(c.dtype for c in block)))
            else:
                self.held += size
                self.bins[b].append(block)

    def pop(self, b: int) -> list[np.ndarray]:
        """All entries of a bin, by key and arrival."""
        parts = []
        for block in self.bins[b]:
            if isinstance(block[0], np.ndarray):
                self.held -= sum(c.nbytes for c in block)
                parts.append(block)
            else:
                place, n, types = block
                self.file.seek(place)
                parts.append(tuple(np.frombuffer(self.file.read(n * t.itemsize), t) for t in types))
        self.bins[b] = []
        if not parts:
            return [np.zeros(0, np.int32), np.zeros(0, np.int32), np.zeros(0, np.int16)]
        return _ordered([np.concatenate(c) for c in zip(*parts, strict=True)])


def _ordered(entries: list[np.ndarray]) -> list[np.ndarray]:
    order = np.argsort(entries[0], kind="stable")
    return [c[order] for c in entries]


class Sorter:
    """Suffixes of one text of symbols that ends in its only 0; cap: where common prefixes saturate."""

    def __init__(self, text: np.ndarray, cap: int, memory: int):
        self.text, self.cap, self.memory, self.n = text, cap, memory, len(text)
        self.chunk = min(1 << 20, max(256, memory // 16))
        self.symbols = 1 + max(int(text[a : a + self.chunk].max()) for a in range(0, self.n, self.chunk))
        self.counts = sum(np.bincount(text[a : a + self.chunk], minlength=self.symbols) for a in range(0, self.n, self.chunk))
        self.kind = np.uint8 if cap < 256 else np.uint16
        self.spilled = self.depth = 0
        self.rising = _array(self.n, bool, memory)  # whether a suffix is below its right neighbour's
        after, up = 0, True
        for a in range((self.n - 1) // self.chunk * self.chunk, -1, -self.chunk):
            here = text[a : a + self.chunk].astype(np.int64)
            right = np.append(here[1:], after if a + self.chunk < self.n else -1)
            out = np.arange(len(here))
            other = np.minimum.accumulate(np.where(here != right, out, len(here))[::-1])[::-1]  # the next place that differs
            mine = np.where(other < len(here), (here < right)[np.minimum(other, len(here) - 1)], up)
            if a + self.chunk >= self.n:
                mine[-1] = True
                last = np.flatnonzero(here[:-1] != here[1:])
                mine[(last[-1] + 1 if len(last) else 0) :] = True
            self.rising[a : a + self.chunk] = mine
            after, up = int(here[0]), bool(mine[0])

    def lms(self) -> np.ndarray:
        parts = []
        for a in range(0, self.n, self.chunk):
            here = self.rising[max(0, a - 1) : a + self.chunk]
            parts.append((np.flatnonzero(here[1:] & ~here[:-1]) + max(0, a - 1) + 1).astype(np.int32))
        out = _array(sum(map(len, parts)), np.int32, self.memory)
        np.concatenate(parts, out=out)
        return out

    def run(self) -> tuple[np.ndarray, np.ndarray]:
        """(suffix array, common prefix of each with the one before)."""
        seeds, common = self._seeds()
        falls, falls_common = self._sweep(seeds, common, False)
        order, back = self._sweep(falls[::-1], self._backward(falls, falls_common), True)
        del seeds, common, falls, falls_common
        out_at, out_common = _array(self.n, np.int32, self.memory), _array(self.n, self.kind, self.memory)
        out_at[0] = self.n - 1
        for a in range(0, self.n - 1, self.chunk):  # the sweep came down from the greatest
            z = min(self.n - 1, a + self.chunk)
            out_at[self.n - z : self.n - a] = order[a:z][::-1]
            if a + 1 < z:
                out_common[self.n - z + 1 : self.n - a] = back[a + 1 : z][::-1]
            if z < self.n - 1:
                out_common[self.n - z] = back[z]
        return out_at, out_common

    @staticmethod
    def _backward(at: np.ndarray, common: np.ndarray) -> np.ndarray:
        """The common prefixes of the entries with the ones before, when they are read from the last."""
        out = np.zeros_like(common)
        out[1:] = common[1:][::-1]
        return out

    def _seeds(self) -> tuple[np.ndarray, np.ndarray]:
        """The LMS suffixes in order, with their common prefixes, from the order of their names."""
        lms = self.lms()
        names, kinds = self._names(lms)
        cap = self.cap // 2 + 1  # each name but the last moves on by two symbols at least
        if kinds == len(lms):
            order, equal = np.argsort(names), np.zeros(len(lms), np.int64)
        elif len(lms) * 20 <= self.memory or len(lms) < 64:
            order, equal = doubled(np.asarray(names), cap)
        else:
            deeper = Sorter(names, cap, self.memory)
            order, equal = deeper.run()
            self.spilled, self.depth = self.spilled + deeper.spilled, deeper.depth + 1
        del names
        seeds, common = _array(len(lms), np.int32, self.memory), _array(len(lms), self.kind, self.memory)
        for a in range(0, len(lms), self.chunk):
            mine = order[a : a + self.chunk]
            before = np.concatenate([order[a - 1 : a] if a else mine[:1], mine[:-1]])
            seeds[a : a + len(mine)] = lms[mine]
            same = np.asarray(equal[a : a + len(mine)], np.int64)
            full = same >= cap
            same[full] = 0
            x, y = lms[mine + same].astype(np.int64), lms[before + same].astype(np.int64)
            got = np.where(full, self.cap, x - lms[mine])
            todo = np.flatnonzero(got < self.cap)
            while len(todo):  # the first names that differ
                p, q = x[todo], y[todo]
                todo = todo[(self.text[p] == self.text[q]) & (p != q)]
                got[todo] += 1
                x[todo] += 1
                y[todo] += 1
                todo = todo[got[todo] < self.cap]
            if a == 0:
                got[0] = 0
            common[a : a + len(mine)] = np.minimum(got, self.cap)
        return seeds, common

    def _names(self, lms: np.ndarray) -> tuple[np.ndarray, int]:
        """(the rank of each LMS substring, in order of the text, and how many there are)."""
        m = len(lms)
        bits = int(self.symbols + 1).bit_length()
        wide = 63 // bits  # symbols in a key
        none = (1 << bits) - 1  # beyond a substring's end; above all symbols, as what follows is larger than in a longer one
        def key(who: np.ndarray, skip: int) -> np.ndarray:
            start = lms[who].astype(np.int64) + skip
            end = lms[np.minimum(who + 1, m - 1)].astype(np.int64) + 1
            out = np.zeros(len(who), np.int64)
            for j in range(wide):
                at = start + j
                out = (out << bits) | np.where(at < end, self.text[np.minimum(at, self.n - 1)], none)
            return out

        names = _array(m, np.int32, self.memory)
        # Bins between keys of a sample; their number follows from the memory.
        parts = max(1, m * 48 // self.memory)
        sample = np.sort(key(np.unique(np.linspace(0, m - 1, min(m, 64 * parts)).astype(np.int64)), 0))
        cuts = np.unique(sample[np.arange(1, parts) * len(sample) // parts])
        queue = Queue(np.ones(len(cuts) + 1, np.int64), self.memory)
        queue.starts, queue.bins = np.arange(len(cuts) + 1), [[] for _ in range(len(cuts) + 1)]
        for a in range(0, m, self.chunk):
            who = np.arange(a, min(m, a + self.chunk), dtype=np.int32)
            place = np.searchsorted(cuts, key(who, 0), "right")
            queue.push(*_ordered([place.astype(np.int32), who, np.zeros(len(who), np.int8)]))
        kinds = 0
        for b in range(len(cuts) + 1):
            who = queue.pop(b)[1]
            if not len(who):
                continue
            order = np.argsort(first := key(who, 0), kind="stable")
            new = np.append(True, first[order[1:]] != first[order[:-1]])
            size = lms[np.minimum(who + 1, m - 1)] - lms[who] + 1
            skip = wide
            while True:  # equal keys so far whose substrings go on; one that has ended is above those
                group = np.cumsum(new) - 1
                todo = np.flatnonzero((np.bincount(group) > 1)[group] & np.logical_or.reduceat(size[order] > skip, np.flatnonzero(new))[group])
                if not len(todo):
                    break
                more = key(who[order[todo]], skip)
                again = np.lexsort((more, group[todo]))
                order[todo], more, of = order[todo][again], more[again], group[todo][again]
                new[todo] = np.append(True, (more[1:] != more[:-1]) | (of[1:] != of[:-1]))
                skip += wide
            rank = np.empty(len(who), np.int64)
            rank[order] = np.cumsum(new) - 1
            names[who] = kinds + rank
            kinds += int(rank.max()) + 1
        self.spilled += queue.spilled
        return names, kinds

    def _runs(self, at: np.ndarray) -> np.ndarray:
        """How many equal symbols follow from each place, itself included, at most cap."""
        out = np.ones(len(at), np.int64)
        todo = np.arange(len(at))
        while len(todo):
            far = at[todo] + out[todo]
            ok = (far < self.n) & (out[todo] < self.cap)
            todo = todo[ok]
            todo = todo[self.text[far[ok]] == self.text[at[todo]]]
            out[todo] += 1
        return out

    def _sweep(self, static: np.ndarray, static_common: np.ndarray, down: bool) -> tuple[np.ndarray, np.ndarray]:
        """Read the static entries and those that are pushed, in order; give the pushed ones, when going down all but the last.

        Going up, the left neighbours that are not rising are pushed, and precede the static entries of their symbol; going
        down, symbols count from the greatest, and the rising ones are pushed.
        """
        top = self.symbols - 1
        queue = Queue(self.counts[::-1] if down else self.counts, self.memory)
        text, n = self.text, self.n
        last, tail = np.full(self.symbols, -1, np.int32), np.zeros(self.symbols, self.kind)
        lows = np.zeros(1024, self.kind)  # of each read: the least value since it
        reads = 0
        size = n - 1 if down else int(n - np.count_nonzero(self.rising))
        out_at, out_common, done = _array(size, np.int32, self.memory), _array(size, self.kind, self.memory), 0

        def keys(at: np.ndarray) -> np.ndarray:
            k = text[at].astype(np.int32)
            return top - k if down else k

        def pushes(at: np.ndarray) -> np.ndarray:
            """The key under which the left neighbour is pushed; beyond all keys where it is not."""
            left = np.maximum(at - 1, 0)
            wanted = (at > 0) & (self.rising[left] if down else ~self.rising[left])
            return np.where(wanted, keys(left), self.symbols)

        def read(at: np.ndarray, common: np.ndarray, to: np.ndarray) -> list[np.ndarray]:
            """Entries that these push, by key and arrival."""
            nonlocal reads, lows
            if reads == len(lows):
                lows = np.concatenate([lows, np.zeros(len(lows), self.kind)])
            ok = np.flatnonzero(to < self.symbols)
            low = common.min()
            if len(ok):
                order = np.argsort(to[ok], kind="stable")
                ok = ok[order]
                key = to[ok].astype(np.int32)
                head = np.concatenate([[True], key[1:] != key[:-1]])
                begin = np.empty(len(ok), np.int64)
                begin[1:] = ok[:-1] + 1
                begin[head] = 0
                least = Least(common, int((ok + 1 - begin).max()))(begin, ok + 1)
                mine = key[head]
                since = last[mine]
                before = np.minimum(tail[mine], np.where(since + 1 < reads, lows[np.minimum(since + 1, max(reads - 1, 0))], self.cap))
                value = least.astype(np.int64)
                value[head] = np.where(since < 0, -1, np.minimum(value[head], before))
                ends = np.append(np.flatnonzero(head)[1:], len(ok)) - 1
                after = np.append(np.minimum.accumulate(common[::-1])[::-1], self.cap)
                last[mine], tail[mine] = reads, after[ok[ends] + 1]
                new = [key, (at[ok] - 1).astype(np.int32), np.minimum(value + 1, self.cap).astype(self.kind)]
            else:
                new = [np.zeros(0, np.int32), np.zeros(0, np.int32), np.zeros(0, self.kind)]
            np.minimum(lows[:reads], low, out=lows[:reads])
            lows[reads] = low
            reads += 1
            return new

        def give(at: np.ndarray, common: np.ndarray) -> None:
            nonlocal done
            out_at[done : done + len(at)], out_common[done : done + len(at)] = at, common
            done += len(at)

        s = 0  # static entries that are read
        m = len(static) - (1 if down and len(static) and static[-1] == n - 1 else 0)
        for b, first in enumerate(queue.starts.tolist()):
            end = int(queue.starts[b + 1]) if b + 1 < len(queue.starts) else self.symbols
            now = queue.pop(b)
            now.append(pushes(now[1]))

            def put(new: list[np.ndarray], end=end) -> list[np.ndarray]:
                """Queue what lies beyond this bin, and give the rest."""
                inside = int(np.searchsorted(new[0], end))
                if inside < len(new[0]):
                    queue.push(*(c[inside:] for c in new))
                return [c[:inside] for c in new]

            def join(now: list[np.ndarray], new: list[np.ndarray]) -> list[np.ndarray]:
                if not len(new[0]):
                    return now
                return _ordered([np.concatenate(c) for c in zip(now, [*new, pushes(new[1])], strict=True)])

            while True:
                take = static[s : min(m, s + READ)]
                take_key = keys(take) if len(take) else np.zeros(0, np.int32)
                k = int(np.searchsorted(take_key, end))
                more = k == len(take_key) and s + len(take) < m  # static entries of this bin may follow
                take, take_key = np.asarray(take[:k]), take_key[:k]
                if not len(now[0]) and not len(take):
                    break
                mine = [c[:READ] for c in now]
                # Both parts are complete below this key.
                bound = min(int(now[0][READ]) if len(now[0]) > READ else end, int(take_key[-1]) if more else end)
                to = pushes(take)
                x, y = int(np.searchsorted(mine[0], bound)), int(np.searchsorted(take_key, bound))
                key = np.concatenate([mine[0][:x], take_key[:y]])
                order = np.argsort(key, kind="stable")  # at a key, the pushed come before the static ones
                key, where = key[order], np.concatenate([mine[3][:x], to[:y]])[order]
                # As many whole keys as push nothing below the end of them.
                group = np.flatnonzero(np.append(key[1:] != key[:-1], True)) if len(key) else np.zeros(0, np.int64)
                good = np.flatnonzero(np.minimum.accumulate(where)[group] > key[group]) if len(key) else group
                if len(good):
                    upto = int(group[good[-1]]) + 1
                    pushed = order[:upto] < x
                    at = np.concatenate([mine[1][:x], take[:y]])[order[:upto]].astype(np.int32)
                    common = np.concatenate([mine[2][:x].astype(self.kind), static_common[s : s + y]])[order[:upto]]
                    common[np.concatenate([[0], group[good[:-1]] + 1])] = 0
                    x = int(pushed.sum())
                    y = upto - x
                    seam = np.flatnonzero(pushed[:-1] & ~pushed[1:] & (key[: upto - 1] == key[1:upto])) + 1
                    common[seam] = np.minimum(np.minimum(self._runs(at[seam - 1].astype(np.int64)), self._runs(at[seam].astype(np.int64))), self.cap)
                    new = put(read(at, common, where[:upto]))
                    if down:
                        give(at, common)
                    else:
                        give(at[pushed], common[pushed])
                    now, s = join([c[x:] for c in now], new), s + y
                    continue
                # One key with more entries than are read at a time, or with runs: in order, piece by piece.
                one = int(min(now[0][0] if len(now[0]) else end, take_key[0] if len(take_key) else end))
                end_at = None
                fresh = True
                while len(now[0]) and now[0][0] == one:
                    x = min(int(np.searchsorted(now[0], one, "right")), READ)
                    at, common, where = now[1][:x], now[2][:x].astype(self.kind), now[3][:x]
                    if fresh:
                        common = common.copy()
                        common[0], fresh = 0, False
                    give(at, common)
                    end_at = int(at[-1])
                    now = join([c[x:] for c in now], put(read(at, common, where)))
                while s < m:
                    take = np.asarray(static[s : min(m, s + READ)])
                    y = int(np.searchsorted(keys(take), one, "right"))
                    if not y:
                        break
                    common = np.array(static_common[s : s + y])
                    if end_at is not None:
                        common[0] = min(int(self._runs(np.array([end_at]))[0]), int(self._runs(take[:1].astype(np.int64))[0]), self.cap)
                    elif fresh:
                        common[0] = 0
                    fresh, end_at = False, None
                    new = put(read(take[:y], common, pushes(take[:y])))
                    if down:
                        give(take[:y], common)
                    now, s = join(now, new), s + y
        self.spilled += queue.spilled
        return out_at[:done], out_common[:done]


class SuffixShard(Shard):
    """Pieces of a shard, one after another in a text on disk, and which of their windows repeat."""

    def __init__(self, window: int, memory: int = MEMORY):
        self.window, self.memory = window, memory
        self.file, self.length, self.sizes, self.n = _file(), 0, [], []

    def add(self, o: Owned) -> None:
        size = np.diff(o.offsets)
        text = np.full(len(o.values) + len(size), BETWEEN, np.uint16)
        body = np.ones(len(text), bool)
        body[o.offsets[1:] + np.arange(len(size))] = False
        text[body] = o.values.astype(np.uint16) + FIRST
        self.file.write(text.tobytes())
        self.length += len(text)
        self.sizes.append(size)
        self.n.append(o.n)

    def close(self) -> list[np.ndarray]:
        self.file.write(np.array([END], np.uint16).tobytes())
        self.file.flush()
        text = np.memmap(self.file, np.uint16, "r", shape=(self.length + 1,))
        sizes, n = np.concatenate(self.sizes), np.concatenate(self.n)
        ends = np.cumsum(sizes + 1) - 1
        starts = ends - sizes
        sorter = Sorter(text, self.window, self.memory)
        order, common = sorter.run()
        again = _array(len(text), bool, self.memory)
        # A run of suffixes that share a window repeats if it stands for two occurrences at least; runs may cross chunks.
        held: list[np.ndarray] = []
        total = 0

        def settle() -> None:
            if total > 1:
                for at in held:
                    again[at] = True

        for a in range(0, len(order), sorter.chunk):
            at = np.asarray(order[a : a + sorter.chunk])
            piece = np.minimum(np.searchsorted(ends, at), len(ends) - 1)
            ok = (at + self.window <= ends[piece]) & (at < ends[-1])
            count = np.where(ok, n[piece], 0)
            head = np.flatnonzero(np.asarray(common[a : a + sorter.chunk]) < self.window)
            first = int(head[0]) if len(head) else len(at)
            held.append(at[:first][ok[:first]])
            total += int(count[:first].sum())
            if len(head):
                settle()
                sums = np.add.reduceat(count, head)
                size = np.diff(np.append(head, len(at)))
                whole = np.repeat(sums > 1, size) & ok[first:]
                whole[head[-1] - first :] = False
                again[at[first:][whole]] = True
                held, total = [at[head[-1] :][ok[head[-1] :]]], int(sums[-1])
        settle()
        return [runs_of(np.asarray(again[a : a + max(0, k - self.window + 1)]), self.window) for a, k in zip(starts, sizes, strict=True)]


def repeats(docs: DataFrame, window: int = 200, block_bytes: int = BLOCK_BYTES, memory: int = MEMORY) -> DataFrame:
    """(doc, twin, spans): byte spans of docs (doc, twin, text) covered by windows that start anywhere else too."""
    cut = Cut(window, max(4, window // 4), by_word=False)
    return covered(docs, cut, lambda: SuffixShard(window, memory), later_only=False, block_units=block_bytes)


def remove_repeats(docs: DataFrame, window: int = 200, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES, memory: int = MEMORY) -> DataFrame:
    """(id, body, n_bytes, n_removed, n_spans): the bytes of each text outside all repeated windows."""
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).withColumn("twin", F.xxhash64("text"))
    src = src.withColumn("doc", F.coalesce("id", F.lit(-(2**63))))  # rows without an id have texts to find, too
    spans = repeats(src, window, block_bytes, memory)
    cut = Cut(window, 4, by_word=False)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in text_slices(batch, "text"):
                u = units(data, offsets, cut)
                gone = coverage(u.offsets, batch.column("spans").slice(a, b - a).to_pylist())
                edge = gone.copy()
                edge[1:] &= ~gone[:-1]
                heads = u.offsets[:-1][u.offsets[:-1] < len(gone)]
                edge[heads] = gone[heads]
                upto = lambda m: np.concatenate([[0], np.cumsum(m)])[u.offsets]
                removed, spans_n = np.diff(upto(gone)), np.diff(upto(edge))
                bodies = [data[lo:hi][~gone[lo:hi]].tobytes() for lo, hi in zip(u.offsets[:-1], u.offsets[1:], strict=True)]
                yield pa.RecordBatch.from_pydict({"id": batch.column("id").slice(a, b - a), "body": pa.array(bodies, pa.binary()), "n_bytes": np.diff(u.offsets).astype(np.int64), "n_removed": removed.astype(np.int64), "n_spans": spans_n.astype(np.int64)})

    out = src.join(spans, ["doc", "twin"], "left").select("id", "text", "spans").mapInArrow(run, "id long, body binary, n_bytes long, n_removed long, n_spans long")
    return out.withColumnRenamed("id", id_col)
