"""Sharding along a Hilbert curve.

Several metadata dimensions are quantised, each row gets its index on the Hilbert curve through the grid of cells, and
the rows in curve order are cut into runs: a shard covers a compact box in all dimensions, so min/max statistics of its
files prune filters on any of them.

The values of a dimension are spread over its whole axis: up to as many values as cells get cells at equal distances, in
their order; more get cells that hold about equal numbers of rows. Text counts as a whole, in its order by code point.
Bits say how fine an axis is; one with fewer bits than the others only orders rows that agree in the others' high bits.

Defined results: a null dimension takes the first cell, as the least value; rows in the same cell follow the tie-break
columns, and rows equal in all of those too are interchangeable, so repeated rows stay and lie side by side; empty and
very long texts only differ in size; an empty table gives an empty result. Other columns stay, whatever their names; of
columns named shard or slot the new ones take the place.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import with_rank

#: Runs of values of a text dimension that are counted apart.
RUNS = 256


def curve_index(cells: np.ndarray, bits: int) -> np.ndarray:
    """Index on the Hilbert curve of each row of an (n, dims) array of cells below 2 ** bits (Skilling's transform)."""
    x = cells.astype(np.int64).T.copy()
    dims = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(dims):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & p)
            x[0] ^= np.where(high, p, swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        t ^= np.where((x[-1] & q) != 0, q - 1, 0)
        q >>= 1
    x ^= t
    out = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            out = (out << 1) | ((x[i] >> b) & 1)
    return out


def _spread(counts: np.ndarray, bits: int) -> np.ndarray:
    """The cell of each value, by the rows of each, in order."""
    n = len(counts)
    if n <= 1 << bits:
        return np.arange(n) * (1 << bits) // max(n, 1)
    return np.minimum((np.cumsum(counts) - counts / 2) / counts.sum() * (1 << bits), (1 << bits) - 1).astype(np.int64)


def _edges(df: DataFrame, name: str, bits: int) -> tuple[list, np.ndarray]:
    """(the values at which another cell begins, the cell of each, led by the cell of what is below all)."""
    if isinstance(df.schema[name].dataType, T.StringType):
        values = df.where(F.col(name).isNotNull()).groupBy(name).agg(F.count("*").alias("rows"))
        placed = values.repartitionByRange(RUNS, name).groupBy(F.spark_partition_id().alias("part"))
        runs = sorted(tuple(r) for r in placed.agg(F.min(name).alias("low"), F.sum("rows").alias("rows")).select("low", "rows").collect())  # RUNS rows at most
        low, cells = [x for x, _ in runs], _spread(np.array([n for _, n in runs], float), bits)
    else:
        cuts = [i / 2**bits for i in range(1, 2**bits)]
        least, cut = df.agg(F.min(F.col(name).cast("double")), F.percentile_approx(F.col(name).cast("double"), cuts, 2000)).first()  # 2 ** bits numbers
        low = [] if least is None else sorted({least, *cut})
        cells = _spread(np.ones(len(low)), bits)
    return low, np.concatenate([[0], cells]).astype(np.int64)


def with_curve(df: DataFrame, dims: list[str], bits: tuple[int, ...] | int = 5, name: str = "curve") -> DataFrame:
    """df with its index on the Hilbert curve over the columns dims, of the bits each."""
    each = (bits,) * len(dims) if isinstance(bits, int) else bits
    axes = [_edges(df, d, b) for d, b in zip(dims, each, strict=True)]

    @F.pandas_udf("long")
    def index(values: pd.DataFrame) -> pd.Series:
        cells = []
        for i, (low, cell) in enumerate(axes):
            column = values.iloc[:, i]
            place = np.zeros(len(column), np.int64)
            have = column.notna().to_numpy()
            place[have] = np.searchsorted(np.array(low, object if column.dtype == object else float), column[have].to_numpy(), "right")
            cells.append(cell[place])
        return pd.Series(curve_index(np.stack(cells, 1), max(each)))

    text = [isinstance(df.schema[d].dataType, T.StringType) for d in dims]
    return df.withColumn(name, index(F.struct(*(F.col(d).cast("string" if t else "double").alias(f"d{i}") for i, (d, t) in enumerate(zip(dims, text, strict=True))))))


def cut_runs(df: DataFrame, dims: list[str], ties: list[str], n_shards: int, bits: tuple[int, ...] | int = 5) -> DataFrame:
    """df with shard and slot: runs of the curve order whose row counts differ by one at most, and the place in the run."""
    ranked, total = with_rank(with_curve(df, dims, bits), "curve", *ties)
    n, k = F.lit(max(total, 1)), F.lit(n_shards)
    shard = F.floor(F.col("rank") * k / n)
    # rank * k / n goes through double; both are exact far below 2 ** 53, and the floor is then put right.
    shard = F.when(shard * n > F.col("rank") * k, shard - 1).when((shard + 1) * n <= F.col("rank") * k, shard + 1).otherwise(shard)
    return ranked.withColumn("shard", shard.cast("int")).withColumn("slot", F.col("rank") - F.floor((F.col("shard").cast("long") * n + k - 1) / k)).drop("rank")


def write_shards(sharded: DataFrame, path: str, per_file: int = 1_000_000) -> DataFrame:
    """Write one folder a shard, its rows in curve order in files of about per_file rows, and return the (shard, rows) written."""
    placed = sharded.repartitionByRange("shard", F.floor(F.col("slot") / per_file)).sortWithinPartitions("shard", "slot")
    placed.write.option("maxRecordsPerFile", per_file).partitionBy("shard").parquet(path)
    return sharded.sparkSession.read.parquet(path).groupBy("shard").agg(F.count("*").alias("rows"))


DIMS, BITS = ["source", "lang", "size"], (5, 5, 2)


def _measured(docs: DataFrame, *extra: Column) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select("doc_id", "source", "lang", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"), *extra)


def shard_documents(docs: DataFrame, n_shards: int = 8) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot, source, lang) of each document, along the curve over source, language and length."""
    return cut_runs(_measured(docs), DIMS, ["doc_id", "text_crc32"], n_shards, BITS)


def with_shards(docs: DataFrame, n_shards: int = 8) -> DataFrame:
    """docs with shard and slot, along the curve over source, language and size; all columns stay."""
    held = cut_runs(_measured(docs, F.struct("*").alias("row")), DIMS, ["doc_id", "text_crc32"], n_shards, BITS)
    return held.select(*(F.col("row").getField(c).alias(c) for c in docs.columns if c not in ("shard", "slot")), "shard", "slot")
