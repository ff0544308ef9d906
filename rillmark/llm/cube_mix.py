"""Mixing sources to target weights by the cube method.

Each source's target over its size is the expected number of times that its documents are taken. The whole part is
taken outright. The fraction is a balanced sample: inclusion probabilities move through the null space of the
constraints (word total, document total) until at most two units of a block are undecided, and those of all blocks are
balanced again. In the last flight of a source HELD units of all sizes stay behind and are decided with the last two
(landing): of all choices the one whose words come nearest to what is expected of them, then its documents.

Blocks hold a bounded number of documents, rows that are alike too, as these are told apart by their rank among
themselves; so a source or a row with a third of all rows is spread over many tasks. Random choices come from a seed, the
source and the block: reruns agree.

Defined results: a null or wordless text has size 0 and a null source is a source of its own, the last; a source
without words has target 0; repeated rows are separate documents, also without an id; of rows that are alike it does not
matter which are taken; whole texts count, however long; an empty table gives an empty result; only doc_id, source, text
and the carried columns are read, so others may have any name.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, forget, saved

BLOCK = 8_000
#: Units that the last flight of a source leaves to the landing.
HELD = 12


def targets(sizes: dict, weights: tuple = (5, 2, 1), share: float = 1.5, cap: float = 2.0) -> dict:
    """Target words of each source: share of all words by weight, at most cap times its own, the excess dealt again by weight."""
    names = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, total = set(names), share * sum(sizes.values())
    out: dict = {}
    while left:
        unit = total / sum(weight[s] for s in left)
        over = {s for s in left if weight[s] * unit > cap * sizes[s]}
        if not over:
            return out | {s: weight[s] * unit for s in left}
        out |= {s: cap * sizes[s] for s in over}
        total -= sum(cap * sizes[s] for s in over)
        left -= over
    return out


def flight(p: np.ndarray, size: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Move p (each in 0..1) along null vectors of the two balancing sums until at most two entries are strictly between."""
    p = p.astype(float).tolist()
    draws, used = rng.random(4096), 0
    active: list[int] = []
    todo = iter(range(len(p)))
    eps = 1e-9
    while True:
        while len(active) < 3:
            i = next(todo, None)
            if i is None:
                return np.array(p)
            if eps < p[i] < 1 - eps:
                active.append(i)
        # All units of a source have one first probability f, so (1 / f, size / f) has the null space of (1, size).
        a, b, c = active
        u = [size[b] - size[c], size[c] - size[a], size[a] - size[b]]
        if not any(u):
            u = [1.0, -1.0, 0.0]
        up = min((1 - p[i]) / v if v > 0 else -p[i] / v for i, v in zip(active, u, strict=True) if v)
        down = min(p[i] / v if v > 0 else (p[i] - 1) / v for i, v in zip(active, u, strict=True) if v)
        if used == len(draws):
            draws, used = rng.random(4096), 0
        step = up if draws[used] < down / (up + down) else -down
        used += 1
        for i, v in zip(active, u, strict=True):
            p[i] = min(1.0, max(0.0, p[i] + step * v))
        active = [i for i in active if eps < p[i] < 1 - eps]


def landing(p: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Decide the last HELD + 2 entries at most: the whole choice whose words come nearest to the expected ones, then its documents."""
    open_ = np.flatnonzero((p > 1e-9) & (p < 1 - 1e-9))
    if not len(open_):
        return np.round(p)
    choice = (np.arange(2 ** len(open_))[:, None] >> np.arange(len(open_))) & 1
    words, docs = np.abs(choice @ size[open_] - (p[open_] * size[open_]).sum()), np.abs(choice.sum(axis=1) - p[open_].sum())
    out = np.round(p)
    out[open_] = choice[np.lexsort((docs, np.round(words, 6)))[0]]
    return out


def kept_behind(p: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places of HELD undecided units, from the smallest to the largest at even steps."""
    open_ = np.flatnonzero((p > 1e-9) & (p < 1 - 1e-9))
    by_size = open_[np.argsort(size[open_], kind="stable")]
    return by_size[np.unique(np.linspace(0, len(by_size) - 1, min(HELD, len(by_size))).astype(int))] if len(by_size) else open_


def _fly(land: bool):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["doc_id", "size", "twin", "turn"], kind="stable")
        head = pdf.iloc[0]
        rng = np.random.default_rng(zlib.crc32(f"{head.source!r}/{head.block}/{head.level}".encode()))
        order = rng.permutation(len(pdf))
        size, p = pdf["size"].to_numpy(float)[order], pdf["p"].to_numpy(float)[order]
        if land:
            fly = np.ones(len(p), bool)
            fly[kept_behind(p, size)] = False
            p[fly] = flight(p[fly], size[fly], rng)
            p = landing(p, size)
        else:
            p = flight(p, size, rng)
        pdf["p"] = p[np.argsort(order)]
        return pdf

    return run


def _ranked(units: DataFrame) -> DataFrame:
    """units with turn, the rank of a row among those of its twin. Ranks within a partition and the counts of those before it make it, so no task has all of a hot twin."""
    counts = units.groupBy("twin", "part").agg(F.count("*").alias("rows"))
    before = F.sum("rows").over(Window.partitionBy("twin").orderBy("part")) - F.col("rows")
    within = F.row_number().over(Window.partitionBy("twin", "part").orderBy("number_")) - 1
    return units.join(counts.select("twin", "part", before.alias("before")), ["twin", "part"]).withColumn("turn", F.col("before") + within).drop("before", "part", "number_")


def mix_sources(docs: DataFrame, weights: tuple = (5, 2, 1), share: float = 1.5, cap: float = 2.0, carried: tuple = ()) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies) and the carried columns: how often the mix takes each row."""
    size = F.size(F.regexp_extract_all(F.coalesce(F.col("text"), F.lit("")), F.lit(WORD), F.lit(0))).cast("long")
    units = saved(docs.select("doc_id", "source", size.alias("size"), F.xxhash64("doc_id", "text").alias("twin"), F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("number_"), *carried), "units")
    spark = docs.sparkSession
    totals = {r.source: (r.words, r.docs) for r in units.groupBy("source").agg(F.sum("size").alias("words"), F.count("*").alias("docs")).collect()}  # one row per source
    goal = targets({s: t[0] for s, t in totals.items()}, weights, share, cap)
    plan = [(s, t[0], float(goal[s]), min(cap, goal[s] / t[0]) if t[0] else 0.0, max(1, -(-t[1] // BLOCK))) for s, t in totals.items()]
    rates = spark.createDataFrame(plan, "src string, source_size long, target double, rate double, blocks long")
    rated = _ranked(units).join(rates, F.col("source").eqNullSafe(rates.src)).drop("src")
    rated = rated.withColumn("whole", F.floor(F.col("rate") + 1e-9)).withColumn("p", F.greatest(F.col("rate") - F.col("whole"), F.lit(0.0)))
    rated = rated.withColumn("block", F.pmod(F.xxhash64("twin", "turn", F.lit(17)), "blocks")).withColumn("level", F.lit(0))
    schema = rated.schema
    blocks = max([b for *_, b in plan], default=1)
    done, level = [], 0
    while True:
        last = blocks <= 1
        flown = saved(rated.groupBy("source", "block").applyInPandas(_fly(land=last), schema), "flown")
        if last:
            done.append(flown)
            break
        between = "p > 1e-9 and p < 1 - 1e-9"
        done.append(flown.where(f"not ({between})"))
        level += 1
        blocks = -(-blocks * 2 // BLOCK)  # two undecided units a block at most
        rated = flown.where(between).withColumn("level", F.lit(level)).withColumn("block", F.pmod(F.xxhash64("twin", "turn", F.lit(17 + level)), F.lit(blocks)))
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    forget(units)
    return out.select("doc_id", "source", "size", "source_size", "target", "twin", (F.col("whole") + F.round("p")).cast("long").alias("copies"), *carried)
