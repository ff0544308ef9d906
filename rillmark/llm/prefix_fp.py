"""Document fingerprints from prefix polynomial hashes.

A modular prefix array over the code points of a text answers the hash of any span in constant time, so spans are
compared without reading them, and the longest common extension of two positions is found by binary search. A
fingerprint holds the hash of the whole text, those of its beginnings and ends of a ladder of lengths, each an eighth
longer than the one before, and a bottom sketch of the hashes of its spans of `span` code points.

The likeness of two fingerprints estimates the Jaccard similarity of the texts' spans: by the sketch, with a standard error
of at most 0.5 / sqrt(KEEP), or by what the common extensions from both ends prove if that is more. These are found by
binary search on the ladders: a beginning agrees if and only if all shorter ones do. Where they cover a share e of the
longer text, about e / (2 - e) of the spans at least are common.

Defined results: null reads as empty; an empty text has an empty sketch and is like only another empty one (likeness 1);
a text shorter than a span counts as one span; equal texts have equal fingerprints and likeness 1. Rows without a
doc_id come after all others; rows that share one are in order of the hash of their text, and rows that are alike in
both are interchangeable. A single row follows itself. Texts count as a whole, however long; an empty table gives an
empty result; only the columns doc_id and text are read, so others may have any name.
"""

from __future__ import annotations

import bisect
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .vectors import mix

#: Two primes below 2 ** 31, so that products of residues fit in 64 bits, and a base for each.
PRIMES = (2147483647, 2147483629)
BASES = (911382323, 972663749)
SPAN, KEEP = 24, 64
#: Bytes of text in a range of documents, and the most ranges.
RANGE_BYTES, RANGES = 32 << 20, 20_000
_powers: list[list[tuple[np.ndarray, np.ndarray]]] = []


def _power_tables(n: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each prime the powers of its base and of the base's inverse."""
    if not _powers or len(_powers[0][0][0]) < n:
        size = 1 << max(14, int(n).bit_length())
        tables = []
        for p, b in zip(PRIMES, BASES, strict=True):
            pair = []
            for base in (b, pow(b, -1, p)):
                t = np.ones(1, np.uint64)
                while len(t) < size:
                    t = np.concatenate([t, t * np.uint64(pow(base, len(t), p)) % np.uint64(p)])
                pair.append(t)
            tables.append(tuple(pair))
        _powers[:] = [tables]
    return _powers[0]


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)


class Prefix:
    """Prefix arrays of one sequence of code points, modulo each prime."""

    def __init__(self, points: np.ndarray):
        self.n = len(points)
        self.tables = _power_tables(self.n + 1)
        self.sums = []
        for p, (up, _) in zip(PRIMES, self.tables, strict=True):
            s = np.zeros(self.n + 1, np.uint64)
            np.cumsum((points + np.uint64(1)) * up[: self.n] % np.uint64(p), out=s[1:])  # 2 ** 33 terms fit in 64 bits
            self.sums.append(s % np.uint64(p))

    def spans(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """62-bit hashes of the spans [start, end), the same wherever a span stands."""
        out = np.zeros(len(start), np.uint64)
        for p, s, (_, down) in zip(PRIMES, self.sums, self.tables, strict=True):
            q = np.uint64(p)
            out = (out << np.uint64(31)) | ((s[end] + q - s[start]) % q * down[start] % q)
        return out

    def hash(self, start: int, end: int) -> int:
        return int(self.spans(np.array([start]), np.array([end]))[0])


def equal(a: Prefix, i: int, b: Prefix, j: int, length: int) -> bool:
    """Whether the spans of the length at i and j agree, up to a chance of about 2 ** -61."""
    return a.hash(i, i + length) == b.hash(j, j + length)


def common_extension(a: Prefix, i: int, b: Prefix, j: int) -> int:
    """Length of the longest common run from i in a and j in b, by binary search on equality of spans."""
    low, high = 0, min(a.n - i, b.n - j)
    while low < high:
        mid = (low + high + 1) // 2
        low, high = (mid, high) if equal(a, i, b, j, mid) else (low, mid - 1)
    return low


def sketch(p: Prefix) -> np.ndarray:
    """The KEEP least span hashes, distinct and sorted."""
    if not p.n:
        return np.zeros(0, np.uint64)
    k = min(SPAN, p.n)
    at = np.arange(p.n - k + 1)
    low = mix(p.spans(at, at + k)) >> np.uint64(16)
    want = 4 * KEEP
    while True:
        if len(low) <= want:
            return np.unique(low)[:KEEP]
        least = np.unique(np.partition(low, want)[:want])  # spans may repeat
        if len(least) >= KEEP:
            return least[:KEEP]
        want *= 4


def ladder(n: int) -> np.ndarray:
    """Lengths up to n, each an eighth longer than the one before."""
    steps = 1 + int(np.log(max(n, 2)) / np.log(1.125))
    rungs = np.unique(np.ceil(1.125 ** np.arange(steps + 1)).astype(np.int64))
    return rungs[rungs <= n]


def fingerprint(p: Prefix) -> str:
    rungs = ladder(p.n)
    ends = (p.spans(np.zeros_like(rungs), rungs), p.spans(p.n - rungs, np.full_like(rungs, p.n)))
    hexed = lambda x, kind: x.astype(kind).tobytes().hex()
    return f"{p.n:x}:{p.hash(0, p.n):016x}:{hexed(ends[0], '>u4')}:{hexed(ends[1], '>u4')}:{hexed(sketch(p), '>u8')}"


def parse(fp: str) -> tuple[int, str, np.ndarray, np.ndarray, np.ndarray]:
    """(length, whole hash, hashes of beginnings, of ends, sketch)."""
    size, whole, head, tail, low = fp.split(":")
    return int(size, 16), whole, *(np.frombuffer(bytes.fromhex(x), k).astype(np.uint64) for x, k in ((head, ">u4"), (tail, ">u4"), (low, ">u8")))


def agreed(a: np.ndarray, b: np.ndarray) -> int:
    """How many rungs of two ladders agree, by binary search."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        mid = (low + high + 1) // 2
        low, high = (mid, high) if a[mid - 1] == b[mid - 1] else (low, mid - 1)
    return low


def likeness(a: tuple, b: tuple) -> float:
    """Jaccard similarity of the spans of two parsed fingerprints."""
    if a[:2] == b[:2]:
        return 1.0
    if not len(a[4]) or not len(b[4]):
        return 0.0
    union = np.union1d(a[4], b[4])[:KEEP]
    told = float((np.isin(union, a[4]) & np.isin(union, b[4])).sum() / len(union))
    rungs, longer, shorter = ladder(min(a[0], b[0])), max(a[0], b[0]), min(a[0], b[0])
    common = sum(int(rungs[k - 1]) if k else 0 for k in (agreed(a[2], b[2]), agreed(a[3], b[3])))
    spans = min(common, shorter) - 2 * SPAN  # of the beginning and of the end, those wholly inside
    share = max(0.0, spans / longer)
    return max(told, share / (2 - share))


def with_range(docs: DataFrame, range_bytes: int = RANGE_BYTES) -> tuple[DataFrame, int]:
    """(doc_id, text, down, tie, part, head) and the number of parts: ranges of descending doc_id, each row's range and
    whether it is the first of it. down rises as doc_id falls; rows of one doc_id go on by tie, the hash of their text.

    Ranges have about range_bytes of text, as far as RANGES allow; of each, one key is collected.
    """
    doc_id = F.col("doc_id").cast("long")
    placed = docs.select(doc_id.alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    placed = placed.withColumn("down", F.coalesce(F.bitwise_not("doc_id"), F.lit(2**63 - 1))).withColumn("tie", F.xxhash64("text"))
    total = placed.agg(F.sum(F.octet_length("text") + 64)).first()[0]
    if total is None:
        return placed, 0
    n = min(RANGES, -(-total // range_bytes))
    keys = placed.select("down", "tie")
    first = F.min(F.struct("down", "tie")).alias("first")
    firsts = keys.repartitionByRange(n, "down", "tie").groupBy(F.spark_partition_id()).agg(first).collect() if n > 1 else [keys.agg(first).first()]
    cuts = sorted({tuple(r["first"]) for r in firsts})
    downs = np.array([d for d, _ in cuts], np.int64)

    @F.pandas_udf("part int, head boolean")
    def place(down: pd.Series, tie: pd.Series) -> pd.DataFrame:
        d, t = down.to_numpy(), tie.to_numpy()
        low, high = np.searchsorted(downs, d, "left"), np.searchsorted(downs, d, "right")
        for i in np.flatnonzero(high > low):  # a range begins among the rows of this doc_id
            high[i] = bisect.bisect_right(cuts, (int(d[i]), int(t[i])), int(low[i]), int(high[i]))
        part = high - 1
        return pd.DataFrame({"part": part.astype(np.int32), "head": [cuts[k] == (x, y) for k, x, y in zip(part, d.tolist(), t.tolist(), strict=True)]})

    return placed.withColumn("placed", place("down", "tie")).select("doc_id", "text", "down", "tie", "placed.part", "placed.head"), len(cuts)


def fingerprints_with_edits(docs: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) of every document.

    The edited text has its last half replaced by as much of the beginning of the next document in descending doc_id.
    Texts are shuffled once, by range of doc_id; the first document of each range is also sent to the range before it,
    whose last document it follows, and that of the first range to the last one.
    """
    placed, parts = with_range(docs, range_bytes)
    if not parts:
        return docs.sparkSession.createDataFrame([], _SCHEMA)
    here = F.struct(F.col("part"), F.lit(0).alias("after"))
    before = F.struct(F.pmod(F.col("part") - 1, F.lit(parts)).cast("int").alias("part"), F.lit(1).alias("after"))
    sent = placed.select(F.explode(F.when(F.col("head"), F.array(here, before)).otherwise(F.array(here))).alias("to"), "doc_id", "text", "down", "tie")
    ordered = sent.select("to.part", "to.after", "doc_id", "text", "down", "tie").repartitionById(parts, "part").sortWithinPartitions("part", "after", "down", "tie")
    return ordered.select("part", "after", "doc_id", "text").mapInArrow(_run, _SCHEMA)


_SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows: list[tuple] = []
    held = None  # (part, after, id, text, code points, fingerprint)
    for batch in batches:
        for part, after, doc_id, text in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
            points = code_points(text)
            fp = fingerprint(Prefix(points))
            if held and held[0] == part and not held[1]:
                rows.append(_row(held, points, fp))
            # The first document of another range serves as the next one only; of rows that are alike the first does.
            held = (part, after or (held[1] if held and held[0] == part else 0), doc_id, text, points, fp)
        if rows:
            yield _batch(rows)
            rows = []


def _row(held: tuple, following: np.ndarray, next_fp: str) -> tuple:
    _, _, doc_id, _, points, fp = held
    half = len(points) // 2
    edited = np.concatenate([points[: len(points) - half], following[:half]])
    text = edited.astype(np.uint32).tobytes().decode("utf-32-le", "surrogatepass")
    edited_fp = fingerprint(Prefix(edited))
    mine = parse(fp)
    sha = hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()
    return doc_id, len(points), sha, fp, edited_fp, likeness(mine, parse(edited_fp)), likeness(mine, parse(next_fp))


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    names = [x.split()[0] for x in _SCHEMA.split(", ")]
    return pa.RecordBatch.from_pydict(dict(zip(names, map(list, zip(*rows, strict=True)), strict=True)))
