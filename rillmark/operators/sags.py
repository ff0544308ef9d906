"""Low points of profiles: minima, prominence, greedy suppression."""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType


def minima(p: DataFrame, group: tuple[str, ...] = ("street", "run"), order: tuple[str, ...] = ("path_idx",), d: str = "d", z: str = "smooth", edge: float = 10.0) -> DataFrame:
    """The rows with a value, with pos, their number within their group, and low: whether they are an interior minimum.

    A minimum is not above the row before and below the row after, and at least `edge` from both ends of its group.
    """
    ok = p.where(F.col(z).isNotNull())
    w, whole = Window.partitionBy(*group).orderBy(*order), Window.partitionBy(*group)
    ok = ok.withColumn("pos", F.row_number().over(w)).withColumn("_prev", F.lag(z).over(w)).withColumn("_next", F.lead(z).over(w)).withColumn("_lo", F.min(d).over(whole)).withColumn("_hi", F.max(d).over(whole))
    low = (F.col(z) <= F.col("_prev")) & (F.col(z) < F.col("_next")) & (F.col(d) - F.col("_lo") >= edge) & (F.col("_hi") - F.col(d) >= edge)
    return ok.withColumn("low", F.coalesce(low, F.lit(False))).drop("_prev", "_next", "_lo", "_hi")


class _Ground:
    """The rows of a group so far that no later one is below, from low to high, each with what later rows need of those between.

    An entry is [value, greatest value since the entry before, minima of this value that wait for lower ground]; such a
    minimum is [row, climb before it, greatest value from it to the next of its value].
    """

    def __init__(self, least: float):
        self.least, self.stack, self.found = least, [], []

    def _leave(self, top: float) -> float:
        """The last entry goes: top is the greatest value after it. The greatest value since the entry before it."""
        value, since, waiting = self.stack.pop()
        after = top
        for row, before, between in reversed(waiting):
            after = max(after, between)
            climb = min(before, after) - value
            if climb >= self.least:
                self.found.append(row | {"prom": climb})
        return max(top, since)

    def add(self, value: float, row: dict | None) -> None:
        """The next row; row is given for a minimum."""
        top, stack = float("-inf"), self.stack
        while stack and stack[-1][0] > value:
            top = self._leave(top)
        if not stack or stack[-1][0] < value:
            stack.append([value, max(top, value), [] if row is None else [[row, top, value]]])
            return
        entry = stack[-1]
        if entry[2]:
            entry[2][-1][2] = max(entry[2][-1][2], top)
        if row is not None:
            entry[2].append([row, max(entry[1], top), value])
        entry[1] = max(entry[1], top)

    def end(self) -> None:
        top = float("-inf")
        while self.stack:
            top = self._leave(top)


def _climbs(batches: Iterator[pa.RecordBatch], z: str, least: float) -> Iterator[pa.RecordBatch]:
    ground, schema = _Ground(least), None
    for batch in batches:
        schema = batch.schema.append(pa.field("prom", pa.float64()))
        low = batch.column("low")
        rows = iter(batch.filter(low).to_pylist())
        for first, value, is_low in zip(batch.column("_first").to_pylist(), batch.column(z).to_pylist(), low.to_pylist(), strict=True):
            if first:
                ground.end()
            ground.add(value, next(rows) if is_low else None)
        if ground.found:
            yield pa.RecordBatch.from_pylist(ground.found, schema)
            ground.found = []
    ground.end()
    if ground.found:
        yield pa.RecordBatch.from_pylist(ground.found, schema)


def prominence(rows: DataFrame, group: tuple[str, ...] = ("street", "run"), z: str = "smooth", least: float = 0.2) -> DataFrame:
    """The minima among rows (see minima) with prom, the smaller climb to either side before lower ground, where it is `least` at least.

    One pass over each group in order, with a stack of the rows that no later one is below. It is carried over from batch
    to batch, so neither a group nor its minima have to fit in memory: only the stack, and each row enters and leaves it once.
    """
    w = Window.partitionBy(*group).orderBy("pos")
    ordered = rows.withColumn("_first", F.row_number().over(w) == 1)
    schema = StructType([*ordered.schema.fields, StructField("prom", DoubleType())])
    return ordered.mapInArrow(partial(_climbs, z=z, least=least), schema).drop("_first", "low")


def _apart(batches: Iterator[pa.RecordBatch], separation: float) -> Iterator[pa.RecordBatch]:
    """Of each stretch the rows kept; a stretch begins where _new holds."""
    stretch: list[dict] = []

    def kept() -> list[dict]:
        at, out = [], []
        for row in sorted(stretch, key=lambda x: (-x["prom"], x["_order"])):
            i = bisect_left(at, row["_d"])
            if (i == 0 or row["_d"] - at[i - 1] >= separation) and (i == len(at) or at[i] - row["_d"] >= separation):
                insort(at, row["_d"])
                out.append(row)
        stretch.clear()
        return out

    schema = None
    for batch in batches:
        schema, done = batch.schema, []
        for row in batch.to_pylist():
            if row["_new"]:
                done += kept()
            stretch.append(row)
        if done:
            yield pa.RecordBatch.from_pylist(done, schema)
    if stretch:
        yield pa.RecordBatch.from_pylist(kept(), schema)


def suppress(cands: DataFrame, group: str = "street", d: str = "d", order: str = "path_idx", separation: float = 10.0, keep: tuple[str, ...] = ("smooth",)) -> DataFrame:
    """The candidates kept from the most prominent down, each at least `separation` from all kept before it, numbered along d.

    An ordered pass over stretches of candidates; where two that follow each other are `separation` apart, those before
    and after cannot suppress each other and a new stretch begins, so only a stretch is held, never a whole group. The
    places kept are in order, and a candidate is held against its two neighbours among them.
    """
    along = Window.partitionBy(group).orderBy(d, order)
    near = cands.select(group, d, order, "prom", *keep, F.col(d).alias("_d"), F.col(order).alias("_order"))
    near = near.withColumn("_new", F.coalesce(F.col(d) - F.lag(d).over(along) >= separation, F.lit(True)))
    rows = near.mapInArrow(partial(_apart, separation=separation), near.schema).drop("_d", "_order", "_new")
    return rows.withColumn("sag_num", F.row_number().over(along).cast("int"))


def find_sags(p: DataFrame, least: float = 0.2, separation: float = 10.0, edge: float = 10.0) -> DataFrame:
    rows = minima(p.select("street", "run", "path_idx", "d", "smooth", "easting", "northing"), edge=edge)
    return suppress(prominence(rows, least=least), separation=separation, keep=("smooth", "easting", "northing"))
