"""The trie of conversations by their turns, built from adaptive radix trees over fixed-width turn ids.

A turn is a 16-byte id of its role and text, read big-endian, so a conversation is a string of 16 bytes a turn. A task
inserts its conversations, in parts of bounded size, into adaptive radix trees: nodes of 4, 16, 48 and 256 children that
grow as they fill, and compressed paths. A path is read at the depths that are a whole number of turns; only these are
nodes of the result, whatever the tree branches on in between. A node's id is the chained hash of the turns above it, so
what trees of different tasks say of one node meets by an equal key, and a hot first turn arrives as one row a tree.

The first pass over the trees sums members and takes the smallest of each node. The smallest member of a node owns it: of
the nodes along a conversation it owns all below some depth. So sums over the distinct nodes of a subtree become sums over
conversations, and the second pass has them: a conversation adds the text of the turns that it does not own, which is
what sharing saves, and the owner of a leaf adds one leaf. Nothing is walked level by level between tasks.

The digest of a node's ends is one stream by its definition: ids meet in blocks of BLOCK ids, and a task reads a node's
blocks in order and holds one at a time.

Defined results: null roles and texts are empty; turns without a number come first, and turns of one number go by their
ids; rows that are alike are turns of their own; rows without a conv_id belong to no conversation and are left out, as the
rebuilding has nothing to go by; a conversation without turns is a member of the root; an empty table gives an empty
result; only conv_id, turn, role and text are read. A conversation has to fit in memory with 20 bytes a turn.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial
from os.path import commonprefix

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import forget, saved

WIDTH = 16
#: Bytes of keys that one tree takes, if not told otherwise, and ids that a row of a node's ends holds at most.
PART, BLOCK = 1 << 22, 1 << 12
ROOT = bytes(WIDTH)


class _Node:
    """A node with a compressed path before its children. Layouts: up to 4 and 16 children as two lists, up to 48 through an index of bytes, then an array by byte."""

    __slots__ = ("path", "layout", "keys", "kids", "ends", "shared", "leaves")

    def __init__(self, path: bytes):
        self.path, self.layout, self.keys, self.kids = path, 4, bytearray(), []
        self.ends, self.shared, self.leaves = [], 0, 0

    def _place(self, byte: int) -> int:
        """Where the child of a byte stands in kids; -1 if there is none."""
        if self.layout <= 16:
            return self.keys.find(byte)
        if self.layout == 48:
            return self.keys[byte] - 1
        return byte if self.kids[byte] is not None else -1

    def get(self, byte: int) -> _Node | None:
        at = self._place(byte)
        return None if at < 0 else self.kids[at]

    def put(self, byte: int, kid: _Node) -> None:
        at = self._place(byte)
        if at >= 0:
            self.kids[at] = kid
            return
        if len(self.kids) == self.layout < 256:
            self._grow()
        if self.layout == 256:
            self.kids[byte] = kid
            return
        self.kids.append(kid)
        if self.layout == 48:
            self.keys[byte] = len(self.kids)
        else:
            self.keys.append(byte)

    def _grow(self) -> None:
        held = list(self.items())
        self.layout = {4: 16, 16: 48, 48: 256}[self.layout]
        if self.layout >= 48:
            index, self.kids = bytearray(256), [None] * 256 if self.layout == 256 else [k for _, k in held]
            for i, (byte, kid) in enumerate(held):
                index[byte] = i + 1
                if self.layout == 256:
                    self.kids[byte] = kid
            self.keys = index

    def items(self) -> Iterator[tuple[int, _Node]]:
        if self.layout <= 16:
            yield from zip(self.keys, self.kids, strict=True)
        elif self.layout == 48:
            yield from ((b, self.kids[i - 1]) for b, i in enumerate(self.keys) if i)
        else:
            yield from ((b, k) for b, k in enumerate(self.kids) if k is not None)


class RadixTree:
    def __init__(self) -> None:
        self.root = _Node(b"")

    def place(self, key: bytes) -> _Node:
        """The node at which key ends, made if it is not there."""
        node, at = self.root, 0
        while at < len(key):
            byte, at = key[at], at + 1
            kid = node.get(byte)
            if kid is None:
                kid = _Node(key[at:])
                node.put(byte, kid)
                return kid
            rest = key[at : at + len(kid.path)]
            if rest != kid.path:  # the compressed path parts here
                m = len(commonprefix([rest, kid.path]))
                upper = _Node(kid.path[:m])
                upper.put(kid.path[m], kid)
                kid.path = kid.path[m + 1 :]
                node.put(byte, upper)
                kid = upper
            node, at = kid, at + len(kid.path)
        return node

    def turns(self, chars: dict[bytes, int]) -> Iterator[tuple]:
        """(id, parent's id, depth, code points, members, least member, members that do not own it, leaves, saved) of each node at a whole number of turns; below before above."""
        order, stack = [], [(self.root, -1, ROOT, b"", 0)]
        while stack:
            node, above, last, begun, depth = stack.pop()
            begun, here = begun + node.path, []
            for i in range(0, len(begun) - len(begun) % WIDTH, WIDTH):
                turn = begun[i : i + WIDTH]
                own, depth = hashlib.md5(last + turn, usedforsecurity=False).digest(), depth + 1
                here.append((own, last, depth, chars[turn]))
                last = own
            begun = begun[len(begun) - len(begun) % WIDTH :]
            stack += [(kid, len(order), last, begun + bytes((byte,)), depth) for byte, kid in node.items()]
            order.append((node, above, here))
        none = (0, None, 0, 0, 0)
        sums = [none] * len(order)
        for i in range(len(order) - 1, -1, -1):
            node, above, here = order[i]
            n, least, shared, leaves, kept = sums[i]
            n, shared, leaves = n + len(node.ends), shared + node.shared, leaves + node.leaves
            least = min((x for x in (least, min(node.ends, default=None)) if x is not None), default=None)
            for own, last, depth, size in reversed(here):
                kept += shared * size
                yield own, last, depth, size, n, least, shared, leaves, kept
            if above < 0:
                yield ROOT, None, 0, 0, n, least, shared, leaves, kept
            else:
                m, other, s, f, k = sums[above]
                least = other if least is None else least if other is None else min(least, other)
                sums[above] = (m + n, least, s + shared, f + leaves, k + kept)
            sums[i] = none

    def ends(self) -> Iterator[tuple[bytes, int]]:
        """(id of the node, member) of each member that ends there."""
        stack = [(self.root, ROOT, b"")]
        while stack:
            node, last, begun = stack.pop()
            begun += node.path
            for i in range(0, len(begun) - len(begun) % WIDTH, WIDTH):
                last = hashlib.md5(last + begun[i : i + WIDTH], usedforsecurity=False).digest()
            yield from ((last, c) for c in node.ends)
            begun = begun[len(begun) - len(begun) % WIDTH :]
            stack += [(kid, last, begun + bytes((byte,))) for byte, kid in node.items()]


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns): the turns of each conversation in order, as ids with their code points."""
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    turn_id = F.unhex(F.md5(F.concat(F.length(text("role")).cast("string"), F.lit(":"), text("role"), text("text")).cast("binary")))
    turn = F.struct(F.col("turn").isNotNull().alias("numbered"), F.coalesce("turn", F.lit(0)).alias("turn"), turn_id.alias("id"), F.length(text("text")).alias("chars"))
    rows = conversations.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), turn.alias("t"))
    bare = lambda x: F.struct(x["id"].alias("id"), x["chars"].alias("chars"))
    return rows.groupBy("conv_id").agg(F.transform(F.array_sort(F.collect_list("t")), bare).alias("turns"))


def rebuilt(conversations: DataFrame, every: int = 100, heads: int = 6) -> DataFrame:
    """(conv_id, ids, chars): each conversation with its first h turns from the one that its id rounds down to; h is crc32 of its id modulo heads."""
    own = saved(ordered_turns(conversations), "turns")
    first = own.where(F.col("conv_id") % every == 0).select(F.col("conv_id").alias("base"), F.slice("turns", 1, heads - 1).alias("lent"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads).cast("int")
    both = own.withColumn("base", F.col("conv_id") - F.col("conv_id") % every).withColumn("h", h).join(first, "base", "left")
    turns = F.concat(F.expr("slice(coalesce(lent, slice(turns, 1, 0)), 1, h)"), F.expr("slice(turns, h + 1, size(turns))"))
    out = saved(both.withColumn("turns", turns).select("conv_id", F.col("turns.id").alias("ids"), F.col("turns.chars").alias("chars")), "rebuilt")
    forget(own)
    return out


def _parts(batches: Iterator[pa.RecordBatch], columns: tuple[str, ...], most: int) -> Iterator[list[tuple]]:
    """Lists of (key, code points of the turns, columns...) with about `most` bytes of keys."""
    part, size = [], 0
    for batch in batches:
        ids = batch.column("ids")
        flat, offsets = ids.flatten(), np.diff(ids.offsets.to_numpy())
        body, stops = b"".join(flat.to_pylist()), np.cumsum(offsets) * WIDTH
        others = [batch.column(c).to_pylist() for c in columns]
        for stop, width, chars, *rest in zip(stops.tolist(), (offsets * WIDTH).tolist(), batch.column("chars").to_pylist(), *others, strict=True):
            part.append((body[stop - width : stop], chars, *rest))
            size += width + WIDTH
            if size >= most:
                yield part
                part, size = [], 0
    if part:
        yield part


def _told(key: bytes, chars: list[int], known: dict[bytes, int]) -> None:
    for i, size in enumerate(chars):
        known[key[i * WIDTH : (i + 1) * WIDTH]] = size


def _membership(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Rows of nodes, and with no depth, of members and the nodes where they end."""
    for part in _parts(batches, ("conv_id",), most):
        tree, known = RadixTree(), {}
        for key, chars, conv in part:
            _told(key, chars, known)
            tree.place(key).ends.append(conv)
        rows = [(own, above, depth, size, n, least) for own, above, depth, size, n, least, *_ in tree.turns(known)]
        rows += [(own, None, None, None, None, conv) for own, conv in tree.ends()]
        yield _batch(rows, ("node", "above", "depth", "chars", "n", "least"), (pa.binary(), pa.binary(), pa.int32(), pa.int32(), pa.int64(), pa.int64()))


def _subtrees(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    for part in _parts(batches, ("shared", "leaf"), most):
        tree, known = RadixTree(), {}
        for key, chars, shared, leaf in part:
            _told(key, chars, known)
            tree.place(key[: shared * WIDTH]).shared += 1
            if leaf:
                tree.place(key).leaves += 1
        rows = [(own, leaves, kept) for own, *_, leaves, kept in tree.turns(known) if leaves or kept]
        yield _batch(rows, ("node", "n_leaves", "saved"), (pa.binary(), pa.int64(), pa.int64()))


def _batch(rows: list[tuple], names: tuple[str, ...], kinds: tuple[pa.DataType, ...]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)], names=list(names))


def _digests(ends: DataFrame) -> DataFrame:
    """(node, ends_sha256): the digest of the ids that end at each node, in order."""
    inside = ends.groupBy("node", F.floor(F.col("conv_id") / BLOCK).alias("block")).agg(F.array_sort(F.collect_list("conv_id")).alias("ids"))
    blocks = inside.select("node", "block", F.array_join(F.col("ids").cast("array<string>"), ",").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, digest = None, None
        for batch in batches:
            done = []
            for own, text in zip(batch.column("node").to_pylist(), batch.column("text"), strict=True):
                if own != node:
                    if node is not None:
                        done.append((node, digest.hexdigest()))
                    node, digest = own, hashlib.sha256(text.as_buffer())
                else:
                    digest.update(b",")
                    digest.update(text.as_buffer())
            yield _batch(done, ("node", "ends_sha256"), (pa.binary(), pa.string()))
        if node is not None:
            yield _batch([(node, digest.hexdigest())], ("node", "ends_sha256"), (pa.binary(), pa.string()))

    return blocks.repartition("node").sortWithinPartitions("node", "block").mapInArrow(run, "node binary, ends_sha256 string")


def _sum(name: str) -> Column:
    return F.coalesce(name, F.lit(0).cast("long"))


def prefix_trie(conversations: DataFrame, every: int = 100, heads: int = 6, part: int = PART) -> DataFrame:
    """A row for each node of the trie of the rebuilt conversations; columns as the query's contract has them, and node, its id.

    part: bytes of keys that one tree takes.
    """
    convs = rebuilt(conversations, every, heads)
    kinds = "node binary, above binary, depth int, chars int, n long, least long"
    told = saved(convs.select("conv_id", "ids", "chars").mapInArrow(partial(_membership, most=part), kinds), "told")
    nodes = told.where("depth is not null").groupBy("node").agg(F.first("above").alias("above"), F.first("depth").alias("depth"), F.sum("n").alias("n_convs"), F.min("least").alias("conv_id"))
    nodes = saved(nodes, "nodes")
    children = nodes.where("above is not null").groupBy(F.col("above").alias("node")).agg(F.count("*").alias("n_children"))
    nodes_2 = saved(nodes.join(children, "node", "left").withColumn("n_children", _sum("n_children")), "nodes")
    owners = nodes_2.groupBy("conv_id").agg(F.greatest(F.min("depth") - 1, F.lit(0)).alias("shared"), F.max(F.col("n_children") == 0).alias("leaf"))
    shares = convs.join(owners, "conv_id", "left").select("ids", "chars", F.coalesce("shared", F.size("ids")).alias("shared"), F.coalesce("leaf", F.lit(False)).alias("leaf"))
    sums = shares.mapInArrow(partial(_subtrees, most=part), "node binary, n_leaves long, saved long").groupBy("node").agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))
    digests = _digests(told.where("depth is null").select("node", F.col("least").alias("conv_id")))
    above = nodes_2.select(F.col("node").alias("above"), F.col("conv_id").alias("parent_conv_id"))
    out = nodes_2.join(above, "above", "left").join(sums, "node", "left").join(digests, "node", "left")
    empty = hashlib.sha256(b"").hexdigest()
    return out.select("conv_id", F.col("depth").cast("long").alias("depth"), "parent_conv_id", "n_convs", "n_children", _sum("n_leaves").alias("n_leaves"), _sum("saved_tokens").alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(empty)).alias("ends_sha256"), F.lower(F.hex("node")).alias("node"))
