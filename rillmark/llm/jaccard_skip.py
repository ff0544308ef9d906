"""N-gram Jaccard join with set-relation skipping.

Documents become sets of word shingles; equal sets are one set. Shingles are ordered from rare to common, by counts in
a fixed number of cells that cover the corpus, and each set is indexed under its prefix: two sets that link share a
shingle of both prefixes.

Index level: an index list is read in blocks of members that have one set size and one position of the shingle. At the
first shingle that two sets share, they cannot share more than the shorter of their two remainders, so pairs of blocks
whose remainders are too short are skipped as a whole, and members of blocks without a partner leave the index.

Answer level: the members of a list are first compared with one leader, the member that has the fewest shingles of its
own and so links with the most. Those within twice the distance of a link are its ball.
Their answers among each other derive from their differences from the leader: two members have as many shingles in
common as their sizes, the numbers of their differences and the number of common differences tell, and two that link
share a difference unless both link with the leader. So only members that share a difference are compared, by their
differences alone, in lists ordered from rare to common and skipped in blocks of size and position like the index; in
each list one of them is compared with all first, and what that joins needs no more comparing. A member that links with
the leader can link with none outside the ball and leaves the list. Large lists that still hold more than one component
choose further leaders among the rest. Of the pairs that are left, those in one component or one ball are skipped; if a
leader L is at the known Jaccard distances d(L, A) and d(L, B), A and B cannot link when these differ by more than the
distance allowed; and signatures rule others out: a signature counts a set's shingles in 256 cells, and two sets differ
by at least as many shingles as their counts do. The rest are verified by exact intersection, and only their sets are
fetched. No link between components is lost.

Defined results: null and empty texts have an empty set and stand alone; a text with fewer words than a shingle has one
shingle, its whole sequence; equal sets are one, however many rows have them; rows of one doc_id with different texts
are linked only if their sets are; rows without an id link like others, and the component of none but such rows has a
null id; of ties between leaders a hash decides, which changes no result; whole texts count, however long; an empty
table gives an empty result; only the id and text columns are read, so others may have any name.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.store import drop, write_buckets
from .common import components, forget, free_name, saved, scratch_dir
from .vectors import LOWER, SET_BITS, SLICE, mix, shingle_sets, text_slices, word_hashes, words

CELLS, CELL_BLOCK = 1 << 18, 1 << 14
#: Groups that the tasks' counts of a block of cells are summed in first.
SUM_PARTS = 1024
#: Keys of sets that a task remembers, so as not to index an equal set again; beyond that it starts anew.
REMEMBERED = 1 << 20
#: Cells of a set's signature, each one byte that stays at 255.
SIGNATURE = 256
#: Most leaders of a list, and the members that a list has more than to choose another one.
ROUNDS, LARGE = 4, 1000
#: Bits of the filter of rows that are looked for: 4 MB.
BITS = 1 << 25
#: Whether a join deals rows out anew that lie by some of its keys already.
_ALL_KEYS = "spark.sql.requireAllClusterKeysForCoPartition"


def set_hashes(batch: pa.RecordBatch, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    for a, _, data, offsets in text_slices(batch, "text", SLICE):
        low = LOWER[data]
        starts, ends, at = words(low, offsets)
        yield a, *shingle_sets(word_hashes(low, starts, ends), at, k)


def set_keys_of(hashes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each set; 0 for an empty one."""
    n = np.diff(offsets)
    out = np.zeros(len(n), np.uint64)
    full = np.flatnonzero(n)
    if len(full):
        sums = np.add.reduceat(mix(hashes + np.uint64(1)), offsets[full])
        out[full] = mix(sums + n[full].astype(np.uint64)) | np.uint64(1)
    return out


def packed(values: np.ndarray) -> bytes:
    """A sorted set as its steps, in as few bytes each as the largest needs: the number of bytes, then the low bytes of all, and so on."""
    steps = np.diff(values, prepend=np.uint64(0)).astype("<u8")
    width = max(1, (int(steps.max(initial=0)).bit_length() + 7) // 8)
    return bytes([width]) + np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()


def unpacked(body: np.ndarray) -> np.ndarray:
    width = int(body[0])
    out = np.zeros(((len(body) - 1) // width, 8), np.uint8)
    out[:, :width] = body[1:].reshape(width, -1).T
    return np.cumsum(out.view("<u8").ravel(), dtype=np.uint64)


def _signatures(hashes: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """How many shingles of each set fall in each of the SIGNATURE cells."""
    rows = len(offsets) - 1
    cell = ((hashes >> np.uint64(18)) & np.uint64(SIGNATURE - 1)).astype(np.int64)
    counts = np.bincount(np.repeat(np.arange(rows), np.diff(offsets)) * SIGNATURE + cell, minlength=rows * SIGNATURE)
    bounds = np.arange(rows + 1, dtype=np.int32) * SIGNATURE
    return pa.Array.from_buffers(pa.binary(), rows, [None, pa.py_buffer(bounds), pa.py_buffer(np.minimum(counts, 255).astype(np.uint8))])


def set_keys(docs: DataFrame, k: int) -> tuple[DataFrame, np.ndarray]:
    """(doc, n, key, signature) of each document, and how many shingles of the corpus fall in each of the CELLS."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros(CELLS, np.int64)
        names = ["doc", "n", "key", "signature", "block", "cells"]
        for batch in batches:
            ids = batch.column("doc")
            for a, hashes, offsets in set_hashes(batch, k):
                cells += np.bincount((hashes & np.uint64(CELLS - 1)).astype(np.int64), minlength=CELLS)
                rows = len(offsets) - 1
                yield pa.RecordBatch.from_arrays([ids.slice(a, rows), pa.array(np.diff(offsets).astype(np.int32)), pa.array(set_keys_of(hashes, offsets).view(np.int64)), _signatures(hashes, offsets), pa.nulls(rows, pa.int32()), pa.nulls(rows, pa.binary())], names=names)
        if cells.any():
            n = CELLS // CELL_BLOCK
            yield pa.RecordBatch.from_arrays([pa.nulls(n, pa.int64()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.binary()), pa.array(np.arange(n, dtype=np.int32)), pa.array([cells[i * CELL_BLOCK : (i + 1) * CELL_BLOCK].astype(np.uint32).tobytes() for i in range(n)], pa.binary())], names=names)

    table = saved(docs.select("doc", "text").mapInArrow(run, "doc long, n int, key long, signature binary, block int, cells binary"), "sets")

    def add(kind):
        def sums(pdf):
            import pandas as pd

            total = sum(np.frombuffer(x, kind).astype(np.int64) for x in pdf["cells"])
            return pd.DataFrame({"block": pdf["block"].iloc[:1], "cells": [total.tobytes()]})

        return sums

    # In two steps, so that no group has a row of every task; a task's own counts are half as wide.
    rows = table.where("block is not null").select("block", "cells")
    part = rows.groupBy("block", F.spark_partition_id() % SUM_PARTS).applyInPandas(add(np.uint32), "block int, cells binary")
    summed = part.groupBy("block").applyInPandas(add(np.int64), "block int, cells binary")
    counts = np.zeros(CELLS, np.int64)
    for r in summed.collect():  # CELLS numbers, whatever the input
        counts[r.block * CELL_BLOCK : (r.block + 1) * CELL_BLOCK] = np.frombuffer(r.cells, np.int64)
    members = table.where("block is null").select("doc", "n", "key", "signature")
    members._scratch_path = table._scratch_path
    return members, counts


def prefixes(docs: DataFrame, k: int, percent: int, counts: np.ndarray) -> DataFrame:
    """(token, key, n, at): the rarest shingles of each set, enough that linked sets share one, with their positions."""
    ranks = docs.sparkSession.sparkContext.broadcast(np.argsort(np.argsort(counts, kind="stable")).astype(np.uint64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank, seen = ranks.value, set()
        for batch in batches:
            for _, hashes, offsets in set_hashes(batch, k):
                n, keys = np.diff(offsets), set_keys_of(hashes, offsets).view(np.int64)
                fresh = np.zeros(len(n), bool)
                for i, key in enumerate(keys.tolist()):
                    if key not in seen:
                        seen.add(key)
                        fresh[i] = True
                if len(seen) > REMEMBERED:
                    seen.clear()
                row = np.repeat(np.arange(len(n)), n)
                # A token in the order of all: the rank of its cell, which stands for its last 18 bits, then the others.
                token = (rank[(hashes & np.uint64(CELLS - 1)).astype(np.int64)] << np.uint64(SET_BITS - 18)) | (hashes >> np.uint64(18))
                packed = np.sort((row.astype(np.uint64) << np.uint64(SET_BITS)) | token)
                take = np.where(fresh & (n > 0), n - (percent * n + 99) // 100 + 1, 0)
                place = np.arange(len(row)) - offsets[:-1][row]
                keep = place < take[row]
                mine = row[keep]
                yield pa.RecordBatch.from_arrays([pa.array((packed[keep] & np.uint64((1 << SET_BITS) - 1)).view(np.int64)), pa.array(keys[mine]), pa.array(n[mine].astype(np.int32)), pa.array(place[keep].astype(np.int32))], names=["token", "key", "n", "at"])

    return docs.select("text").mapInArrow(run, "token long, key long, n int, at int")


def _can_link(n: Column, at: Column, m: Column, to: Column, percent: int) -> Column:
    """Whether sets of n and m shingles can link whose first common one stands at these positions."""
    most = F.least(n - at, m - to).cast("long")
    return most * 100 >= (n + m - most) * percent


def block_pairs(blocks: DataFrame, percent: int) -> DataFrame:
    """(token, n, at, balls, n2, at2, balls2): pairs of an index list's blocks that can hold a link outside the balls; blocks has (token, n, at, balls, low, high), low and high the least and greatest label of the members, balls a bit for each leader whose ball they are in."""
    x, y = blocks.alias("x"), blocks.alias("y")
    once = F.struct("x.n", "x.at", "x.balls") <= F.struct("y.n", "y.at", "y.balls")
    open_ = (F.least("x.low", "y.low") < F.greatest("x.high", "y.high")) & (F.col("x.balls").bitwiseAND(F.col("y.balls")) == 0)
    pairs = x.join(y, (F.col("x.token") == F.col("y.token")) & once & open_ & _can_link(F.col("x.n"), F.col("x.at"), F.col("y.n"), F.col("y.at"), percent))
    return pairs.select("x.token", "x.n", "x.at", "x.balls", F.col("y.n").alias("n2"), F.col("y.at").alias("at2"), F.col("y.balls").alias("balls2"))


def _blocks(members: DataFrame, label: str) -> DataFrame:
    return members.groupBy("token", "n", "at", "balls").agg(F.min(label).alias("low"), F.max(label).alias("high"))


def index_lists(entries: DataFrame, percent: int) -> DataFrame:
    """(token, key, n, at): the entries without the members that no other one of their list can link with."""
    # Dealt out by token once, into buckets: counts, the join with them and the distinct rows need no other shuffle.
    index = write_buckets(entries, f"{scratch_dir(entries.sparkSession)}/index-{uuid.uuid4().hex}", ("token",))
    shared = index.groupBy("token").agg(F.count("*").alias("rows")).where("rows > 1").select("token")
    found = index.hint("merge").join(shared.hint("merge"), "token", "left_semi").distinct()
    lists = write_buckets(found, f"{scratch_dir(entries.sparkSession)}/lists-{uuid.uuid4().hex}", ("token",), deal=False)
    drop(index)
    ways = block_pairs(_blocks(lists.withColumn("balls", F.lit(0)), "key"), percent)
    # Both ends come from one join; a union of two would run it twice.
    able = ways.select("token", F.explode(F.array(F.struct("n", "at"), F.struct(F.col("n2").alias("n"), F.col("at2").alias("at")))).alias("end")).select("token", "end.n", "end.at").distinct()
    # Both sides lie in buckets by token, so a join on more than that needs no shuffle either.
    conf = entries.sparkSession.conf
    before = conf.get(_ALL_KEYS, "true")
    conf.set(_ALL_KEYS, "false")
    try:
        left = saved(lists.hint("merge").join(able.hint("merge"), ["token", "n", "at"], "left_semi").select("token", "key", "n", "at"), "able")
    finally:
        conf.set(_ALL_KEYS, before)
    drop(lists)
    return left


def bounded(pairs: DataFrame, signatures: DataFrame, percent: int) -> DataFrame:
    """(a, b, least, can): the distance that the pairs' signatures (key, n, signature) prove, and whether it allows a link."""
    left = signatures.select(F.col("key").alias("a"), F.col("n").alias("n_a"), F.col("signature").alias("of_a"))
    right = signatures.select(F.col("key").alias("b"), F.col("n").alias("n_b"), F.col("signature").alias("of_b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p, q = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, SIGNATURE).astype(np.int16) for c in ("of_a", "of_b"))
            both = batch.column("n_a").to_numpy().astype(np.int64) + batch.column("n_b").to_numpy()
            most = (both - np.abs(p - q).sum(axis=1, dtype=np.int64)) // 2
            least, can = 1 - most / (both - most), 100 * most >= percent * (both - most)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(least, pa.float64()), pa.array(can, pa.bool_())], names=["a", "b", "least", "can"])

    return pairs.join(left, "a").join(right, "b").select("a", "b", "n_a", "n_b", "of_a", "of_b").mapInArrow(run, "a long, b long, least double, can boolean")


#: Makes (a, b, least, can) of (pairs, signatures, percent), as bounded() does.
Bound = Callable[[DataFrame, DataFrame, int], DataFrame]


def verified(pairs: DataFrame, bodies: DataFrame, percent: int, near: int) -> DataFrame:
    """(a, b, distance, linked, n, apart) of the pairs, by exact intersection of their sets; n: the size of b's.

    apart: where the similarity is near % at least, the shingles that one of them has alone, times 2, and 1 more if that is b.
    """
    left = bodies.select(F.col("key").alias("a"), F.col("body").alias("body_a"))
    right = bodies.select(F.col("key").alias("b"), F.col("body").alias("body_b"))
    names = ["a", "b", "distance", "linked", "n", "apart"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            distance, linked, size, apart = [], [], [], []
            for x, y in zip(batch.column("body_a"), batch.column("body_b"), strict=True):
                p, q = unpacked(np.frombuffer(x.as_buffer(), np.uint8)), unpacked(np.frombuffer(y.as_buffer(), np.uint8))
                both = np.sort(np.concatenate([p << np.uint64(1), (q << np.uint64(1)) | np.uint64(1)]))
                same = np.flatnonzero(both[1:] ^ np.uint64(1) == both[:-1])
                same = same[both[same] & np.uint64(1) == 0]
                shared, union = len(same), len(both) - len(same)
                distance.append(1 - shared / union)
                linked.append(100 * shared >= percent * union)
                size.append(len(q))
                if near and 100 * shared >= near * union:
                    alone = np.ones(len(both), bool)
                    alone[same] = alone[same + 1] = False
                    apart.append(both[alone].view(np.int64))
                else:
                    apart.append(None)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(distance, pa.float64()), pa.array(linked, pa.bool_()), pa.array(size, pa.int32()), pa.array(apart, pa.list_(pa.int64()))], names=names)

    return pairs.join(left, "a").join(right, "b").select("a", "b", "body_a", "body_b").mapInArrow(run, "a long, b long, distance double, linked boolean, n int, apart array<long>")


def _pair(a: Column, b: Column) -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def marked(rows: DataFrame, wanted: DataFrame, id_col: str, mark: str) -> DataFrame:
    """rows with whether their id may be among those of wanted: false for almost all that are not, so these need no join.

    The filter is a bitmap of BITS bits, whatever the input; where it fills up, it only lets more rows through.
    """
    cell = F.pmod(F.xxhash64(id_col), F.lit(BITS))
    bits = wanted.select(cell.alias("cell")).groupBy(F.bitmap_bucket_number("cell").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("cell")).alias("bits"))
    at, bucket, held = (free_name(rows, n) for n in ("cell", "bucket", "bits"))
    bits = bits.select(F.col("bucket").alias(bucket), F.col("bits").alias(held))
    placed = rows.withColumn(at, cell).withColumn(bucket, F.bitmap_bucket_number(at)).join(F.broadcast(bits), bucket, "left")
    place = F.bitmap_bit_position(at)
    byte = F.conv(F.hex(F.substring(held, F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return placed.withColumn(mark, F.coalesce(F.floor(byte / F.pow(F.lit(2), place % 8)) % 2 == 1, F.lit(False))).drop(at, bucket, held)


def set_bodies(docs: DataFrame, members: DataFrame, keys: DataFrame, k: int) -> DataFrame:
    """(key, body): the sets of the keys, from one text of each, in buckets by key; a few others may be among them.

    Texts become sets where they are read, so only sets are dealt out, once.
    """

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()  # of the last REMEMBERED keys, for rows that are alike
        for batch in batches:
            for _, hashes, offsets in set_hashes(batch, k):
                own = set_keys_of(hashes, offsets).view(np.int64)
                mine = [i for i, x in enumerate(own.tolist()) if x not in seen and not seen.add(x)]
                if len(seen) > REMEMBERED:
                    seen.clear()
                if mine:
                    yield pa.RecordBatch.from_arrays([pa.array(own[mine]), pa.array([packed(hashes[offsets[i] : offsets[i + 1]]) for i in mine], pa.binary())], names=["key", "body"])

    # A null id is a value like others to the filter: all rows without one are read if one of them is wanted.
    wanted = saved(members.groupBy("key").agg(F.min("doc").alias("doc")).join(keys, "key", "left_semi"), "fetched")
    sets = marked(docs, wanted, "doc", "likely").where("likely").select("text").mapInArrow(fetch, "key long, body binary")
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Rows with the id of a wanted one may have other sets, and many rows without an id the same.
    once = sets.repartition(n, "key").dropDuplicates(["key"])
    out = write_buckets(once, f"{scratch_dir(docs.sparkSession)}/bodies-{uuid.uuid4().hex}", ("key",), deal=False)
    forget(wanted)
    return out


def settled(pairs: DataFrame, docs: DataFrame, members: DataFrame, signatures: DataFrame, k: int, percent: int, near: int = 0, bound: Bound = bounded) -> DataFrame:
    """(a, b, least, most, linked, n, apart): bounds of the pairs' distances, and whether they link; the bounds are equal where the sets were compared, and then n and apart are as verified() tells them. near: the similarity from which pairs are compared; percent if 0."""
    bounds = saved(bound(pairs, signatures, near or percent), "bounds")
    left = bounds.where("can").select("a", "b")
    bodies = set_bodies(docs, members, saved(left.select(F.col("a").alias("key")).union(left.select("b")).distinct(), "wanted"), k)
    exact = verified(left, bodies, percent, near).dropDuplicates(["a", "b"]).select("a", "b", F.col("distance").alias("least"), F.col("distance").alias("most"), "linked", "n", "apart")
    none = (F.lit(1.0).alias("most"), F.lit(False).alias("linked"), F.lit(None).cast("int").alias("n"), F.lit(None).cast("array<long>").alias("apart"))
    out = saved(bounds.where("not can").select("a", "b", "least", *none).union(exact), "settled")
    forget(bounds)
    drop(bodies)
    return out


def _alike(pairs: DataFrame, ball: DataFrame, percent: int) -> DataFrame:
    """(a, b, linked) of pairs (leader, a, b) of one ball, from their differences from the leader."""
    left = ball.select("leader", F.col("key").alias("a"), F.col("n").alias("n_a"), F.col("apart").alias("apart_a"))
    right = ball.select("leader", F.col("key").alias("b"), F.col("n").alias("n_b"), F.col("apart").alias("apart_b"))
    both = pairs.join(left, ["leader", "a"]).join(right, ["leader", "b"])
    differ = F.size("apart_a") + F.size("apart_b") - 2 * F.size(F.array_intersect("apart_a", "apart_b"))
    total = F.col("n_a") + F.col("n_b")
    return both.select("a", "b", ((total - differ).cast("long") * 100 >= (total + differ) * percent).alias("linked"))


def _rings(known: DataFrame) -> DataFrame:
    """(leader, key, n, apart, linked): the members of the balls that hold one that does not link with the leader."""
    ball = known.where("apart is not null").select(F.col("a").alias("leader"), F.col("b").alias("key"), "n", "apart", "linked")
    return saved(ball.join(ball.where("not linked").select("leader").distinct(), "leader", "left_semi"), "rings")


def _differences(ring: DataFrame) -> DataFrame:
    """(leader, token, key, n, size, at, linked): the differences that members of a ball, one not linked among them, share, from rare to common."""
    each = ring.select("leader", "key", "n", F.size("apart").alias("size"), "linked", F.explode("apart").alias("token"))
    often = each.groupBy("leader", "token").agg(F.count("*").alias("rows"), F.bool_and("linked").alias("done"))
    order = Window.partitionBy("leader", "key").orderBy("rows", "token")
    cells = each.join(often, ["leader", "token"]).withColumn("at", F.row_number().over(order) - 1)
    return saved(cells.where("rows > 1 and not done").drop("rows", "done"), "cells")


def _stars(cells: DataFrame) -> DataFrame:
    """(leader, a, b): in each list of a difference, one member against all; those that link with the leader need no other."""
    heads = cells.groupBy("leader", "token").agg(F.min_by(F.struct("key", "linked"), F.xxhash64("key")).alias("head"))
    pairs = cells.join(heads, ["leader", "token"]).where("key <> head.key and not (linked and head.linked)")
    return pairs.select("leader", F.col("head.key").alias("a"), F.col("key").alias("b")).distinct()


def _across(cells: DataFrame, comp: DataFrame, percent: int) -> DataFrame:
    """(leader, a, b): pairs of a ball's members of different components, where their places in a list of differences allow a link."""
    place = ["n", "size", "at"]
    now = saved(cells.join(comp, "key"), "now")
    blocks = now.groupBy("leader", "token", *place).agg(F.min("top").alias("low"), F.max("top").alias("high"))
    x, y = blocks.alias("x"), blocks.alias("y")
    common = F.least(F.col("x.size") - F.col("x.at"), F.col("y.size") - F.col("y.at"))
    differ, total = F.col("x.size") + F.col("y.size") - 2 * common, (F.col("x.n") + F.col("y.n")).cast("long")
    can = (total - differ) * 100 >= (total + differ) * percent
    several = F.least("x.low", "y.low") < F.greatest("x.high", "y.high")
    once = F.struct(*(f"x.{c}" for c in place)) <= F.struct(*(f"y.{c}" for c in place))
    ways = x.join(y, (F.col("x.leader") == F.col("y.leader")) & (F.col("x.token") == F.col("y.token")) & once & several & can)
    ways = ways.select("x.leader", "x.token", *(f"x.{c}" for c in place), *(F.col(f"y.{c}").alias(f"{c}2") for c in place))
    p = now.select("leader", "token", *place, F.col("key").alias("p"), F.col("top").alias("p_top"))
    q = now.select("leader", "token", *(F.col(c).alias(f"{c}2") for c in place), F.col("key").alias("q"), F.col("top").alias("q_top"))
    pairs = ways.join(p, ["leader", "token", *place]).join(q, ["leader", "token", *(f"{c}2" for c in place)])
    out = saved(pairs.where("p_top <> q_top").select("leader", *_pair(F.col("p"), F.col("q"))).distinct(), "across")
    forget(now)
    return out


def _answered(comp: DataFrame, known: DataFrame, percent: int) -> DataFrame:
    """comp with the links of the leaders and those within their balls."""
    links = known.where("linked").select("a", "b", "linked")
    ring = _rings(known)
    if ring.limit(1).count() == 0:
        forget(ring)
        return _joined(comp, links)
    cells = _differences(ring)
    stars = saved(_alike(_stars(cells), ring, percent), "stars")
    comp = _joined(comp, links.union(stars))
    pairs = _across(cells, comp, percent)
    comp = _joined(comp, _alike(pairs, ring, percent))
    forget(ring, cells, stars, pairs)
    return comp


def components_of_sets(docs: DataFrame, k: int = 4, percent: int = 85) -> tuple[DataFrame, DataFrame]:
    """(members, component): (doc, n, key) of each document, and (key, top) of the sets that link with another one."""
    members, counts = set_keys(docs, k)
    return components_of_lists(docs, members, index_lists(prefixes(docs, k, percent, counts), percent), k, percent)


def components_of_lists(docs: DataFrame, members: DataFrame, lists: DataFrame, k: int, percent: int, bound: Bound = bounded, lead: DataFrame | None = None, near: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(members, component) as of components_of_sets(), from the members (doc, n, key, signature) and lists (token, key, n, at) in which sets that link stand together.

    lead: (key, own), the members with the least own lead their lists; by default those with the fewest shingles of their
    own. near: the similarity to a leader from which a member is in its ball, at most that of twice the distance of a link.
    """
    if not 50 < percent <= 100:
        raise ValueError("percent must be above 50 and at most 100")
    # A set with few shingles of its own is a good leader, and one for all of its lists.
    own = saved(lead or lists.groupBy("key").agg(F.min("at").alias("own")), "own")
    comp = own.select("key", F.col("key").alias("top"))
    # In buckets by key, as the bounds of each round's pairs read them twice.
    signatures = members.join(comp, "key", "left_semi").select("key", "n", "signature").dropDuplicates(["key"])
    signatures = write_buckets(signatures, f"{scratch_dir(docs.sparkSession)}/signatures-{uuid.uuid4().hex}", ("key",), deal=False)
    members = members.drop("signature")
    near = min(near or 100, max(1, 2 * percent - 100))  # twice the distance of a link, at least

    rest = lists.withColumns({"balls": F.lit(0), "least": F.lit(0.0), "most": F.lit(1.0)})
    held, before = lists, None
    for r in range(ROUNDS):
        if r:
            several = rest.join(comp, "key").groupBy("token").agg(F.count("*").alias("rows"), F.min("top").alias("low"), F.max("top").alias("high"))
            large = saved(several.where((F.col("rows") > LARGE) & (F.col("low") < F.col("high"))).select("token", "rows"), "large")
            pairs_left = large.agg(F.sum(F.col("rows").cast("double") * F.col("rows"))).first()[0]
            if not pairs_left or before and pairs_left > before / 2:  # none, or the last leader had few near it: pairs of blocks are cheaper
                forget(large)
                break
            before = pairs_left
            chosen, others = rest.join(large, "token", "left_semi"), rest.join(large, "token", "left_anti")
        else:
            large, chosen, others = None, rest, None
        heads = chosen.join(own, "key").groupBy("token").agg(F.min(F.struct("own", F.xxhash64("key").alias("draw"), "key", "n", "at")).alias("head"))
        heads = saved(heads.select("token", F.col("head.key").alias("leader"), F.col("head.n").alias("n2"), F.col("head.at").alias("at2")), "leaders")
        pairs = chosen.join(heads, "token").where((F.col("key") != F.col("leader")) & _can_link(F.col("n"), F.col("at"), F.col("n2"), F.col("at2"), near))
        known = settled(pairs.select(F.col("leader").alias("a"), F.col("key").alias("b")).distinct(), docs, members, signatures, k, percent, near, bound)
        comp = _answered(comp, known, percent)
        told = known.select(F.col("a").alias("leader"), F.col("b").alias("key"), F.col("least").alias("least_"), F.col("most").alias("most_"), "linked", F.col("apart").isNotNull().alias("in"))
        after = chosen.join(heads.select("token", "leader"), "token").where("key <> leader").join(told, ["key", "leader"], "left").where("not coalesce(linked, false)")
        balls = F.when(F.col("in"), F.col("balls").bitwiseOR(F.lit(1 << r))).otherwise(F.col("balls"))
        after = after.select("token", "key", "n", "at", balls.alias("balls"), F.coalesce("least_", F.lit(0.0)).alias("least"), F.coalesce("most_", F.lit(1.0)).alias("most"))
        after = saved(after if others is None else after.unionByName(others), "rest")
        forget(held, heads, known, *([large] if large is not None else []))
        held = rest = after

    # What the leaders left open: blocks of members of more than one component, in no ball together.
    labelled = saved(rest.join(comp, "key"), "labelled")
    ways = saved(block_pairs(_blocks(labelled, "top"), percent), "ways")
    left = labelled.select("token", "n", "at", "balls", F.col("key").alias("p"), F.col("top").alias("p_top"), F.col("least").alias("p_least"), F.col("most").alias("p_most"))
    right = labelled.select("token", F.col("n").alias("n2"), F.col("at").alias("at2"), F.col("balls").alias("balls2"), F.col("key").alias("q"), F.col("top").alias("q_top"), F.col("least").alias("q_least"), F.col("most").alias("q_most"))
    apart = F.greatest(F.col("p_least") - F.col("q_most"), F.col("q_least") - F.col("p_most")) > 1 - percent / 100 + 1e-9
    one_block = (F.col("n") == F.col("n2")) & (F.col("at") == F.col("at2")) & (F.col("balls") == F.col("balls2"))
    pairs = ways.join(left, ["token", "n", "at", "balls"]).join(right, ["token", "n2", "at2", "balls2"])
    pairs = pairs.where((F.col("p_top") != F.col("q_top")) & ~apart & (~one_block | (F.col("p") < F.col("q"))))
    comp = _joined(comp, settled(pairs.select(*_pair(F.col("p"), F.col("q"))).distinct(), docs, members, signatures, k, percent, bound=bound))
    forget(held, labelled, ways)
    drop(signatures)
    if hasattr(comp, "_scratch_path"):  # else no set links, and comp is still read from own
        forget(own)
    return members, comp


def _joined(comp: DataFrame, told: DataFrame) -> DataFrame:
    """comp, with the components joined that a link of told connects."""
    links = told.where("linked").select("a", "b")
    if links.limit(1).count() == 0:
        return comp
    tops = comp.select("key", "top")
    edges = links.join(tops.select(F.col("key").alias("a"), F.col("top").alias("u")), "a").join(tops.select(F.col("key").alias("b"), F.col("top").alias("v")), "b")
    merged = components(edges.select("u", "v"))
    after = comp.join(merged.select(F.col("id").alias("top"), "component"), "top", "left").select("key", F.coalesce("component", "top").alias("top"))
    after = saved(after, "components")
    forget(comp, merged)
    return after


def linked_documents(docs: DataFrame, k: int = 4, percent: int = 85, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_shingles, component_id): the size of each document's set and the smallest id reachable by links."""
    src = docs.select(F.col(id_col).cast("long").alias("doc"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return by_document(*components_of_sets(src, k, percent), id_col)


def by_document(members: DataFrame, comp: DataFrame, id_col: str) -> DataFrame:
    """(id, n_shingles, component_id) of the members (doc, n, key) and the components (key, top) of sets."""
    rows = members.join(comp, "key", "left").withColumn("top", F.coalesce("top", "key"))
    least = rows.where("n > 0").groupBy("top").agg(F.min("doc").alias("least"))
    return rows.join(least, "top", "left").select(F.col("doc").alias(id_col), F.col("n").cast("long").alias("n_shingles"), F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("doc")).alias("component_id"))
