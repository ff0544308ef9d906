"""Phrase collocations, mined level by level with broadcast double-array tries.

Words that are frequent in their language become symbols, and the corpus becomes runs of symbols, cut where a piece ends
or an infrequent word stands: no phrase with such a word is frequent (Apriori). For each length, the frequent phrases one
word shorter stand in a double-array trie that is broadcast. In each task numpy advances the states of all positions of a
run at once, one array operation a level; a position is a candidate where its state accepts and the state of the next
position does, so both shorter phrases within it are frequent. Candidates are the accepting states with the symbol that
follows: a task numbers them, bincounts them, and Spark sums the counts of all tasks. Candidates are those that occur, not
a joined list of what might, as the join of shorter phrases grows with the square of a common word's neighbours.

Sizes: a trie has at most STATES states and a piece of the vocabulary at most VOCABULARY words. Above these, the corpus is
read once for each piece: a vocabulary is cut by the order of its hashes, a trie by the first symbol, and then a phrase
whose second symbol lies in another piece passes without the second test, which only prunes. Results are the same.
Words are compared by 63-bit hashes of language and word, so a chance equality of words is possible in principle.

Defined results: a null or empty text has no words; a null language counts as `und`, with those that have that name; rows
that are alike count as often as they stand; of equal scores the greater count goes first, then the smaller phrase by bytes;
texts count as a whole, however long; an empty table gives an empty result; only the text and language columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from .common import forget, saved, with_rank
from .vectors import LOWER, mix, text_slices, word_hashes

#: Most words of a piece of the vocabulary (8 bytes each) and most states of a trie (about 16 bytes each).
VOCABULARY, STATES = 1 << 24, 1 << 22
#: Symbols of a run that is written as one row, and candidates that a task counts at once.
RUN, GATHERED = 1 << 18, 1 << 22

#: What each byte is: part of a word, blank, or the end of a piece.
_KIND = np.zeros(256, np.uint8)
_KIND[[0x20, 0x09]] = 1
_KIND[[*b".,;:!?", *range(0x0A, 0x0E)]] = 2


def _tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, row, fresh) of all words; fresh: whether a word begins a piece."""
    kind = _KIND[data]
    begin = kind == 0
    stop = begin.copy()
    begin[1:] &= kind[:-1] != 0
    stop[:-1] &= kind[1:] != 0
    heads = offsets[:-1][offsets[:-1] < len(data)]
    begin[heads] = kind[heads] == 0
    tails = offsets[1:][offsets[1:] > 0] - 1
    stop[tails] = kind[tails] == 0
    starts, ends = np.flatnonzero(begin), np.flatnonzero(stop) + 1
    row = np.searchsorted(offsets, starts, "right") - 1
    piece = np.cumsum(kind == 2)[starts] if len(starts) else starts
    fresh = np.ones(len(starts), bool)
    fresh[1:] = (row[1:] != row[:-1]) | (piece[1:] != piece[:-1])
    return starts, ends, row, fresh


def _keyed(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, lower-cased bytes, starts, ends, row, fresh, keys) of runs of rows; a key is negative and stands for language and word."""
    langs = pc.fill_null(batch.column("lang"), "und").dictionary_encode()
    names = [x.encode() for x in langs.dictionary.to_pylist()]
    ends = np.cumsum([len(x) for x in names], dtype=np.int64) if names else np.zeros(0, np.int64)
    starts = ends - np.array([len(x) for x in names], np.int64)
    of = mix(word_hashes(np.frombuffer(b"".join(names) + b"\0", np.uint8), starts, ends)) if names else np.zeros(0, np.uint64)
    lang = of[langs.indices.to_numpy(zero_copy_only=False)]
    for a, _, data, offsets in text_slices(batch, "text"):
        low = LOWER[data]
        starts, ends, row, fresh = _tokens(low, offsets)
        keys = -(mix(word_hashes(low, starts, ends) ^ lang[a + row]) >> np.uint64(1)).view(np.int64) - 1
        yield a, low, starts, ends, row, fresh, keys


def word_counts(docs: DataFrame) -> DataFrame:
    """(lang, word, key, f): how often each word occurs in each language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = pc.fill_null(batch.column("lang"), "und")
            for a, low, starts, ends, row, _, keys in _keyed(batch):
                if not len(keys):
                    continue
                each, first, count = np.unique(keys, return_index=True, return_counts=True)
                body = low.tobytes()
                words = [body[x:y] for x, y in zip(starts[first].tolist(), ends[first].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([langs.take(pa.array(a + row[first])), pa.array(words, pa.binary()).cast(pa.string()), pa.array(each), pa.array(count)], names=["lang", "word", "key", "f"])

    return docs.select("lang", "text").mapInArrow(run, "lang string, word string, key long, f long").groupBy("lang", "word").agg(F.first("key").alias("key"), F.sum("f").alias("f"))


def _resolved(values: np.ndarray, keys: np.ndarray, before: int, last: bool) -> np.ndarray:
    """values with the keys of this piece of the vocabulary replaced by symbols, from before + 1 on, and those that it shows to be infrequent by 0."""
    at = np.searchsorted(keys, values)
    known = (at < len(keys)) & (keys[np.minimum(at, len(keys) - 1)] == values) if len(keys) else np.zeros(len(values), bool)
    none = (values < 0) & (at < len(keys) if not last else True)
    return np.where(values >= 0, values, np.where(known, before + at + 1, np.where(none, 0, values)))


def _runs(ids: np.ndarray) -> Iterator[pa.RecordBatch]:
    """ids as rows of about RUN symbols, cut where a 0 stands, with one 0 for several in a row."""
    keep = ids != 0
    keep[1:] |= ids[:-1] != 0
    ids = ids[keep].astype(np.int32)
    cuts = np.flatnonzero(ids == 0)
    a = 0
    while a < len(ids):
        at = np.searchsorted(cuts, a + RUN)
        b = int(cuts[at]) + 1 if at < len(cuts) else len(ids)
        yield pa.RecordBatch.from_arrays([pa.array([ids[a:b].tobytes()], pa.binary())], names=["ids"])
        a = b


def symbol_runs(docs: DataFrame, words: DataFrame, n_words: int) -> DataFrame:
    """(ids): the corpus as runs of int32 symbols of the words (key, rank), 0 between what no phrase may span."""
    spark, table = docs.sparkSession, None
    for a in range(0, max(1, n_words), VOCABULARY):
        last = a + VOCABULARY >= n_words
        piece = np.sort(words.where(F.col("rank").between(a, a + VOCABULARY - 1)).select("key").toArrow().column("key").to_numpy())
        held = spark.sparkContext.broadcast(piece)

        def from_text(batches: Iterator[pa.RecordBatch], held=held, a=a, last=last) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for _, _, _, _, _, fresh, keys in _keyed(batch):
                    # A 0 before each word that begins a piece.
                    values = np.zeros(len(keys) + int(fresh.sum()), np.int64)
                    values[np.arange(len(keys)) + np.cumsum(fresh)] = keys
                    values = _resolved(values, held.value, a, last)
                    yield from _runs(values) if last else [pa.RecordBatch.from_arrays([pa.array([values.tobytes()], pa.binary())], names=["ids"])]

        def from_keys(batches: Iterator[pa.RecordBatch], held=held, a=a, last=last) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for x in batch.column("ids"):
                    values = _resolved(np.frombuffer(x.as_buffer(), np.int64), held.value, a, last)
                    yield from _runs(values) if last else [pa.RecordBatch.from_arrays([pa.array([values.tobytes()], pa.binary())], names=["ids"])]

        after = saved(docs.select("lang", "text").mapInArrow(from_text, "ids binary") if table is None else table.mapInArrow(from_keys, "ids binary"), "runs")
        held.destroy()
        if table is not None:
            forget(table)
        table = after
    return table


class DoubleArray:
    """A trie over symbols as a double array: the child of a state by a digit stands at base[state] + digit, if check there is the state.

    A symbol is a few digits below 256, high ones first, each a transition of its own, so the children of a state span
    256 places however many words there are. The root is state 0. number: what the accepting states stand for, else -1.
    """

    SPAN = 257

    def __init__(self, n_symbols: int):
        self.digits = max(1, -(-int(n_symbols).bit_length() // 8))
        self.base, self.check = np.zeros(self.SPAN, np.int64), np.full(self.SPAN, -1, np.int32)
        self.number = np.zeros(0, np.int64)

    def _codes(self, symbols: np.ndarray) -> list[np.ndarray]:
        return [((symbols >> (8 * d)) & 255) + 1 for d in range(self.digits - 1, -1, -1)]

    def _grow(self, slots: int) -> None:
        more = slots - len(self.check)
        if more > 0:
            self.base, self.check = np.pad(self.base, (0, more)), np.pad(self.check, (0, more), constant_values=-1)

    def _place(self, parents: np.ndarray, codes: np.ndarray, rng: np.random.Generator) -> np.ndarray:
        """The places of children (parent, code), which are distinct pairs in order; no parent has children before."""
        heads = np.flatnonzero(np.concatenate([[True], parents[1:] != parents[:-1]]))
        sizes = np.diff(np.append(heads, len(parents)))
        room = int((self.check >= 0).sum()) * 2 + 2 * len(parents) + self.SPAN  # at least half of the places stay free
        self._grow(room + self.SPAN)
        slot = np.empty(len(parents), np.int64)
        self.check[0] = 0  # the root's own place is taken
        for m in np.unique(sizes)[::-1]:
            own = heads[sizes == m]
            if m == 1:
                slot[own] = np.flatnonzero(self.check < 0)[: len(own)]
                self.base[parents[own]], self.check[slot[own]] = slot[own] - codes[own], parents[own]
                break
            for turn in range(1 << 30):  # displacements drawn at random, for all groups of a size at once; large ones come first, while nearly all is free
                if turn % 16 == 15:  # too full for these: new places behind all others
                    at = len(self.check) + self.SPAN * np.arange(len(own))
                    self._grow(len(self.check) + self.SPAN * (len(own) + 1))
                else:
                    at = rng.integers(0, len(self.check) - self.SPAN, len(own))
                places = at[:, None] + codes[own[:, None] + np.arange(m)]
                free = np.flatnonzero((self.check[places] < 0).all(axis=1))
                claim = np.empty(len(self.check), np.int64)
                claim[places[free]] = free[:, None]
                free = free[(claim[places[free]] == free[:, None]).all(axis=1)]
                self.base[parents[own[free]]] = at[free]
                self.check[places[free]] = parents[own[free]][:, None]
                slot[own[free][:, None] + np.arange(m)] = places[free]
                own = np.delete(own, free)
                if not len(own):
                    break
        self.check[0] = -1
        return slot

    def add(self, parents: np.ndarray, symbols: np.ndarray, seed: int = 7) -> np.ndarray:
        """The states of new children, in the given order. No parent has children before; pairs are distinct."""
        rng, states = np.random.default_rng(seed), parents.astype(np.int64)
        for codes in self._codes(symbols.astype(np.int64)):
            pairs, of = np.unique(states * self.SPAN + codes, return_inverse=True)
            states = self._place(pairs // self.SPAN, pairs % self.SPAN, rng)[of] if len(pairs) else states
        return states

    def accept(self, states: np.ndarray, numbers: np.ndarray) -> None:
        self.number = np.full(len(self.check), -1, np.int64)
        self.number[states] = numbers

    def walk(self, ids: np.ndarray, depth: int) -> np.ndarray:
        """The number that the state of each position accepts with after `depth` symbols, else -1; all positions advance at once."""
        codes = self._codes(ids)
        states = np.where(ids > 0, 0, -1)
        for d in range(depth):
            n = max(0, len(ids) - d)
            states = states[:n]
            for code in codes:
                to = self.base[np.maximum(states, 0)] + code[d:]
                live = (states >= 0) & (ids[d:] > 0) & (to >= 0) & (to < len(self.check))
                to = np.where(live, to, 0)
                states = np.where(live & (self.check[to] == states), to, -1)
        return np.where(states > 0, self.number[np.maximum(states, 0)], -1)


def _trie(levels: list[DataFrame], n_symbols: int, piece: int, pieces: int) -> DoubleArray:
    """The trie of the phrases whose first symbol is in this piece; only those of the last level accept."""
    trie, states = DoubleArray(n_symbols), None
    for depth, level in enumerate(levels, 1):
        rows = level.where(F.col("head") % pieces == piece).select("num", "prefix", "symbol").toArrow()
        num, prefix, symbol = (rows.column(c).to_numpy() for c in ("num", "prefix", "symbol"))
        at = trie.add(np.zeros(len(num), np.int64) if depth == 1 else states[1][np.searchsorted(states[0], prefix)], symbol)
        order = np.argsort(num, kind="stable")
        states = (num[order], at[order])
    trie.accept(states[1], states[0])
    return trie


def extensions(runs: DataFrame, levels: list[DataFrame], n_symbols: int, n_states: int, least: int) -> DataFrame:
    """(prefix, symbol, f): the phrases one word longer than the last level that occur `least` times."""
    spark, depth = runs.sparkSession, len(levels)
    pieces = -(-n_states // STATES) or 1
    tables = []
    for piece in range(pieces):
        held = spark.sparkContext.broadcast(_trie(levels, n_symbols, piece, pieces))

        def counted(keys: list[np.ndarray]) -> pa.RecordBatch:
            each, of = np.unique(np.concatenate(keys), return_inverse=True)
            return pa.RecordBatch.from_arrays([pa.array(each >> 32), pa.array((each & 0xFFFFFFFF).astype(np.int32)), pa.array(np.bincount(of, minlength=len(each)))], names=["prefix", "symbol", "f"])

        def run(batches: Iterator[pa.RecordBatch], held=held, piece=piece, counted=counted) -> Iterator[pa.RecordBatch]:
            trie, keys, n = held.value, [], 0
            for batch in batches:
                for x in batch.column("ids"):
                    ids = np.frombuffer(x.as_buffer(), np.int32)
                    accepted = trie.walk(ids, depth)
                    if len(accepted) < 2:
                        continue
                    after, nxt = ids[depth:], accepted[1:]
                    safe = (accepted[:-1] >= 0) & (after > 0) & ((nxt >= 0) | (ids[1 : len(nxt) + 1] % pieces != piece))
                    keys.append((accepted[:-1][safe] << 32) | after[safe])
                    n += len(keys[-1])
                    if n >= GATHERED:
                        yield counted(keys)
                        keys, n = [], 0
            if n:
                yield counted(keys)

        summed = runs.mapInArrow(run, "prefix long, symbol int, f long").groupBy("prefix", "symbol").agg(F.sum("f").alias("f"))
        tables.append(saved(summed.where(F.col("f") >= least), "grown"))
        held.destroy()
    out = saved(reduce(DataFrame.unionAll, tables), "grown") if pieces > 1 else tables[0]
    if pieces > 1:
        forget(*tables)
    return out


def frequent_phrases(docs: DataFrame, least: int = 100, longest: int = 5) -> tuple[DataFrame, DataFrame]:
    """(phrases, totals): (lang, words, f) of all phrases of 1 to `longest` words with f >= least; (lang, n), all word occurrences."""
    src = docs.select("lang", "text")
    counted = saved(word_counts(src), "words")
    totals = counted.groupBy("lang").agg(F.sum("f").alias("n"))
    words, n_symbols = with_rank(counted.where(F.col("f") >= least), "key")
    symbol = (F.col("rank") + 1).cast("int")
    spelled = words.select(symbol.alias("symbol"), F.col("lang").alias("lang_"), "word")
    first = saved(words.select(F.col("rank").alias("num"), F.lit(-1).cast("long").alias("prefix"), symbol.alias("symbol"), symbol.alias("head"), "lang", F.array("word").alias("words"), "f"), "level")
    levels, n_states, n = [first], n_symbols, n_symbols
    runs = symbol_runs(src, words, n_symbols)
    for _ in range(1, longest):
        if not n:
            break
        grown = extensions(runs, levels, n_symbols, n_states, least)
        ranked, n = with_rank(grown, "prefix", "symbol", name="num")
        before = levels[-1].select(F.col("num").alias("prefix"), "head", "lang", "words")
        level = ranked.join(before, "prefix").join(spelled, "symbol").select("num", "prefix", "symbol", "head", "lang", F.concat("words", F.array("word")).alias("words"), "f")
        levels.append(saved(level, "level"))
        n_states += n
        forget(grown)
    forget(runs)
    phrases = reduce(DataFrame.unionAll, (x.select("lang", "words", "f") for x in levels))
    return phrases, totals


def _part(phrases: DataFrame, words: str, f: str) -> DataFrame:
    return phrases.select("lang", F.col("words").alias(words), F.col("f").alias(f))


def collocations(docs: DataFrame, least: int = 100, longest: int = 5, top: int = 2000) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the first `top` phrases of each language, as the query's contract has them."""
    phrases, totals = frequent_phrases(docs, least, longest)
    many = phrases.where(F.size("words") >= 2).withColumnRenamed("f", "a")
    cut = F.explode(F.sequence(F.lit(1), F.size("words") - 1))
    cuts = many.withColumn("k", cut).withColumn("left", F.expr("slice(words, 1, k)")).withColumn("right", F.expr("slice(words, k + 1, size(words) - k)"))
    scored = cuts.join(_part(phrases, "left", "l"), ["lang", "left"]).join(_part(phrases, "right", "r"), ["lang", "right"]).join(totals, "lang")
    # Decimals of 38 digits hold the products; div is exact on them.
    score = F.expr("(1000 * cast(a as decimal(19, 0)) * cast(n as decimal(18, 0))) div (cast(l as decimal(19, 0)) * cast(r as decimal(19, 0)))")
    best = scored.withColumn("score", score).groupBy("lang", "words").agg(F.min(F.struct("score", "k", "a", "l", "r", "n")).alias("b")).select("lang", "words", "b.*")
    inner = many.where(F.size("words") >= 3).select("lang", F.col("a").alias("longer"), F.explode(_inner_parts(F.col("words"))).alias("words"))
    covered = inner.groupBy("lang", "words").agg(F.max("longer").alias("longer"))
    kept = best.join(covered, ["lang", "words"], "left").where(F.coalesce(F.col("longer") < F.col("a"), F.lit(True)))
    phrase = kept.withColumn("phrase", F.array_join("words", " "))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = phrase.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def _inner_parts(words: Column) -> Column:
    """The parts of two words or more within a phrase, but for the whole."""
    n = F.size(words)
    of_length = lambda m: F.transform(F.sequence(F.lit(1), n - m + 1), lambda i: F.slice(words, i, m))
    return F.array_distinct(F.flatten(F.transform(F.sequence(F.lit(2), n - 1), of_length)))
