"""Near-duplicate groups by HyperMinHash.

A set of word shingles becomes REGISTERS registers of one byte: each shingle falls in a bucket, and the bucket keeps its
least value as the count of leading zeros (5 bits) and the bits after the first one (3 bits). A bucket without a shingle
takes the register of another one, which a fixed order for that bucket picks among those that have one, so two sets agree
in a register with their Jaccard similarity as the chance, small sets too. Bands of WIDTH registers are the keys of lists:
two sets at 0.85 miss each other in all BANDS lists with a chance of 2.6e-7, and more similar ones with less.

Within a list no pairs of all are made: members are compared with a leader first, and what is left is told apart by the
distances to it (see jaccard_skip, whose work on lists is used). Before sets are fetched, registers estimate their
similarity: the share of equal registers, less the share that are equal by chance, which the two sizes tell, as a register
holds few bits. Pairs that are estimated more than six deviations below what is asked are let go, with a chance of 1e-9
to be wrong; of sets below SMALL shingles none is. All links are confirmed by exact intersection of the whole sets.

Defined results: null and empty texts have an empty set and stand alone; a text with fewer words than a shingle has one
shingle, its whole sequence; equal sets are one, however many rows have them; rows of one doc_id with different texts are
linked only if their sets are; rows without an id link like others, and the component of none but such rows has a null id;
ties are broken by hashes, which changes no result; whole texts count, however long; an empty table gives an empty result;
only the id and text columns are read, so others may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved
from .jaccard_skip import REMEMBERED, by_document, components_of_lists, index_lists, set_hashes, set_keys_of
from .vectors import mix

BANDS, WIDTH = 32, 6
REGISTERS = BANDS * WIDTH
#: Bits of a value, of a register's mantissa, and the most leading zeros that a register tells.
VALUE, MANTISSA, MOST_ZEROS = 40, 3, 31
#: Sets with fewer shingles have few registers of their own; no estimate rules them out.
SMALL = 64
DEVIATIONS = 6
#: Similarity in % to a leader from which members are compared by their differences from it: wide, as a band says nothing of
#: the order of shingles that would rule pairs out.
NEAR = 50
#: In which order an empty bucket asks the others.
_ORDER = np.argsort(np.random.default_rng(20250311).random((REGISTERS, REGISTERS)), axis=1).argsort(axis=1).astype(np.int16)


def registers(hashes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The registers of each set, a row each; zeros for an empty one."""
    rows = len(offsets) - 1
    x = mix(hashes * np.uint64(0x9E3779B97F4A7C15) + np.uint64(0x632BE59BD9B4E019))
    bucket = ((x >> np.uint64(VALUE)) * np.uint64(REGISTERS)) >> np.uint64(64 - VALUE)
    least = np.full(rows * REGISTERS, np.uint64(1) << np.uint64(VALUE), np.uint64)
    np.minimum.at(least, np.repeat(np.arange(rows), np.diff(offsets)) * REGISTERS + bucket.astype(np.int64), x & np.uint64((1 << VALUE) - 1))
    least = least.reshape(rows, REGISTERS)
    empty = least >> np.uint64(VALUE) != 0
    for r in np.flatnonzero(empty.any(axis=1) & (np.diff(offsets) > 0)):
        have, want = np.flatnonzero(~empty[r]), np.flatnonzero(empty[r])
        least[r, want] = least[r, have[_ORDER[np.ix_(want, have)].argmin(axis=1)]]
    part, exponent = np.frexp(np.maximum(least, np.uint64(1)).astype(float))
    zeros = np.minimum(VALUE - exponent, MOST_ZEROS)
    out = (zeros << MANTISSA) + ((2 * part - 1) * (1 << MANTISSA)).astype(np.int64)
    return np.where(np.diff(offsets)[:, None] > 0, out, 0).astype(np.uint8)


def chance(n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """The chance that registers of two sets of these sizes with nothing in common are equal.

    A least value among r a bucket has the density r exp(-r x). The values with i leading zeros make 2 ** MANTISSA steps,
    each 2 ** -(MANTISSA + i + 1) wide, and within a step both densities are nearly even.
    """
    a, b = np.maximum(n_a / REGISTERS, 1.0), np.maximum(n_b / REGISTERS, 1.0)
    i = np.arange(VALUE)[:, None]
    mass = a * b / (a + b) * (np.exp(-(a + b) * 0.5 ** (i + 1)) - np.exp(-(a + b) * 0.5**i))
    return np.minimum((mass * 0.5 ** (MANTISSA + i + 1)).sum(axis=0), 0.5)


def estimate(p: np.ndarray, q: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(Jaccard similarity from registers, corrected for equality by chance; that chance)."""
    by_chance = chance(n_a, n_b)
    return np.clip(((p == q).mean(axis=1) - by_chance) / (1 - by_chance), 0, 1), by_chance


def register_rows(docs: DataFrame, k: int) -> DataFrame:
    """(doc, n, key, signature) of each document; signature has the registers of its set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, hashes, offsets in set_hashes(batch, k):
                rows = len(offsets) - 1
                bounds = np.arange(rows + 1, dtype=np.int32) * REGISTERS
                held = pa.Array.from_buffers(pa.binary(), rows, [None, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(registers(hashes, offsets)))])
                yield pa.RecordBatch.from_arrays([batch.column("doc").slice(a, rows), pa.array(np.diff(offsets).astype(np.int32)), pa.array(set_keys_of(hashes, offsets).view(np.int64)), held], names=["doc", "n", "key", "signature"])

    return docs.select("doc", "text").mapInArrow(run, "doc long, n int, key long, signature binary")


def bands(members: DataFrame, percent: int) -> DataFrame:
    """(token, key, n, at): the bands of each set that another set can link with; at is 0, as a band says nothing of order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()  # of the last REMEMBERED keys, for rows that are alike
        band = np.arange(BANDS, dtype=np.int64) << (8 * WIDTH)
        for batch in batches:
            keys, n = batch.column("key").to_numpy(), batch.column("n").to_numpy()
            mine = np.array([i for i, x in enumerate(keys.tolist()) if x not in seen and not seen.add(x)], np.int64)
            if len(seen) > REMEMBERED:
                seen.clear()
            mine = mine[n[mine].astype(np.int64) * 100 >= percent * (n[mine].astype(np.int64) + 1)]  # else only its equals reach it
            if not len(mine):
                continue
            held = np.frombuffer(b"".join(batch.column("signature").take(pa.array(mine)).to_pylist()), np.uint8).reshape(-1, BANDS, WIDTH)
            token = np.zeros(held.shape[:2], np.int64)
            for j in range(WIDTH):
                token |= held[:, :, j].astype(np.int64) << (8 * j)
            yield pa.RecordBatch.from_arrays([pa.array((token | band).ravel()), pa.array(np.repeat(keys[mine], BANDS)), pa.array(np.repeat(n[mine], BANDS)), pa.array(np.zeros(len(mine) * BANDS, np.int32))], names=["token", "key", "n", "at"])

    return members.select("key", "n", "signature").mapInArrow(run, "token long, key long, n int, at int")


def estimated(pairs: DataFrame, signatures: DataFrame, percent: int) -> DataFrame:
    """(a, b, least, can): the distance that the pairs have at least by their registers, and whether they may have the similarity."""
    left = signatures.select(F.col("key").alias("a"), F.col("n").alias("n_a"), F.col("signature").alias("of_a"))
    right = signatures.select(F.col("key").alias("b"), F.col("n").alias("n_b"), F.col("signature").alias("of_b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p, q = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, REGISTERS) for c in ("of_a", "of_b"))
            n_a, n_b = (batch.column(c).to_numpy().astype(float) for c in ("n_a", "n_b"))
            got, by_chance = estimate(p, q, n_a, n_b)
            small = np.minimum(n_a, n_b) < SMALL
            slack = lambda j, c=by_chance: DEVIATIONS * np.sqrt((e := j + (1 - j) * c) * (1 - e) / REGISTERS) / (1 - c)
            can = small | (got >= percent / 100 - slack(percent / 100))
            least = np.where(small, 0.0, np.maximum(0.0, 1 - got - slack(0.5)))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(least), pa.array(can)], names=["a", "b", "least", "can"])

    return pairs.join(left, "a").join(right, "b").select("a", "b", "n_a", "n_b", "of_a", "of_b").mapInArrow(run, "a long, b long, least double, can boolean")


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_shingles, component_id, kept): the size of each document's set, the smallest id reachable by links, and whether that is its own."""
    src = docs.select(F.col(id_col).cast("long").alias("doc"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    members = saved(register_rows(src, k), "registers")
    lists = index_lists(bands(members, percent), percent)
    # Who shares most lists with others is in the middle of its group, and a leader for all of its lists.
    crowd = lists.groupBy("token").agg(F.count("*").alias("rows"))
    lead = lists.join(crowd, "token").groupBy("key").agg((-F.sum("rows")).alias("own"))
    members, comp = components_of_lists(src, members, lists, k, percent, estimated, lead, NEAR)
    return by_document(members, comp, id_col).withColumn("kept", F.col(id_col).eqNullSafe(F.col("component_id")))
