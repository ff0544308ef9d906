"""Street profiles: segments chained to a path, chainage, smoothing."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geo


def segment_ends(points: DataFrame, street: str = "street", oid: str = "oid", at: str = "dist_along_m", e: str = "easting", n: str = "northing") -> DataFrame:
    """(street, oid, e0, n0, e1, n1, span of the segment): first and last point of each segment of a named street."""
    return points.where(F.col(street).isNotNull()).groupBy(street, oid).agg(
        F.min_by(e, at).alias("e0"), F.min_by(n, at).alias("n0"), F.max_by(e, at).alias("e1"), F.max_by(n, at).alias("n1"),
        F.min(e).alias("w"), F.max(e).alias("x"), F.min(n).alias("s"), F.max(n).alias("t"),
    )


def _segments(ends: DataFrame) -> DataFrame:
    """(street, segments): the segments of each street in order of oid."""
    return ends.groupBy("street").agg(F.array_sort(F.collect_list(F.struct("oid", "e0", "n0", "e1", "n1"))).alias("segments"))


def _ends_of(segments: pa.ListScalar) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(oid, x, y) of a street's segment ends, start before end."""
    s = segments.values
    at = lambda a, b: np.column_stack([s.field(a).to_numpy(), s.field(b).to_numpy()]).ravel()
    return s.field("oid").to_numpy(), at("e0", "e1"), at("n0", "n1")


def _nodes_of(x: list[float], y: list[float], tol: float) -> list[tuple[float, float, int]]:
    """(x, y, degree) of the nodes; an end looks for earlier nodes in the nine squares of side tol around it."""
    cells: dict[tuple[int, int], list[int]] = {}
    nodes: list[list] = []
    for ex, ey in zip(x, y, strict=True):
        cx, cy = math.floor(ex / tol), math.floor(ey / tol)
        near = [k for i in (-1, 0, 1) for j in (-1, 0, 1) for k in cells.get((cx + i, cy + j), ()) if math.sqrt((nodes[k][0] - ex) * (nodes[k][0] - ex) + (nodes[k][1] - ey) * (nodes[k][1] - ey)) < tol]
        if near:
            node = nodes[min(near)]
            node[2], node[3], node[4] = node[2] + ex, node[3] + ey, node[4] + 1
        else:
            cells.setdefault((cx, cy), []).append(len(nodes))
            nodes.append([ex, ey, ex, ey, 1])
    return [(sx / n, sy / n, n) for _, _, sx, sy, n in nodes]


def _all_nodes(batches: Iterator[pa.RecordBatch], tol: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        street, node, rows = [], [], []
        for name, segments in zip(batch.column("street").to_pylist(), batch.column("segments"), strict=True):
            _, x, y = _ends_of(segments)
            found = _nodes_of(x.tolist(), y.tolist(), tol)
            street += [name] * len(found)
            node += range(len(found))
            rows += found
        xs, ys, degrees = zip(*rows, strict=True) if rows else ((), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(street, pa.string()), pa.array(node, pa.int32()), pa.array(xs, pa.float64()), pa.array(ys, pa.float64()), pa.array(degrees, pa.int64())], names=["street", "node", "x", "y", "degree"])


def junctions(ends: DataFrame, tol: float = 2.0) -> DataFrame:
    """(street, node, x, y, degree): segment ends that meet, one row a node.

    An ordered fold over the ends of a street: each end joins the earliest node whose first end is within tol, so nodes
    never grow along a chain of ends; a node lies at the mean of its ends. Nodes are looked up in a grid.
    """
    return _segments(ends).mapInArrow(partial(_all_nodes, tol=tol), "street string, node int, x double, y double, degree long")


def origins(nodes: DataFrame, ends: DataFrame) -> DataFrame:
    """(street, x, y, label): the westmost terminal of a street that runs mostly E-W, else the northmost."""
    size = ends.groupBy("street").agg((F.max("x") - F.min("w") >= F.max("t") - F.min("s")).alias("wide"))
    loop = F.max((F.col("degree") == 1).cast("int")).over(Window.partitionBy("street")) == 0
    cand = nodes.withColumn("ok", (F.col("degree") == 1) | loop).where("ok").join(size, "street")
    key = F.struct(F.when(F.col("wide"), F.col("x")).otherwise(-F.col("y")), F.col("node"))
    return cand.groupBy("street").agg(F.min_by("x", key).alias("x"), F.min_by("y", key).alias("y"), F.when(F.first("wide"), "W").otherwise("N").alias("label"))


class _Free:
    """The free ends of a street in a grid; an end is 2 * segment, or 1 more for the segment's end."""

    FEW, RINGS, CROWD = 48, 6, 6.0

    def __init__(self, x: np.ndarray, y: np.ndarray):
        self.xs, self.ys, self.alive, self.few = x, y, np.ones(len(x), bool), len(x) <= self.FEW
        if self.few:
            return
        self.x, self.y, self.side = x.tolist(), y.tolist(), max(float(np.ptp(x)), float(np.ptp(y)), 1e-6)
        while True:  # halved until an end shares its cell with few others, wherever ends crowd
            cell = np.floor(np.column_stack([x, y]) / self.side).astype(np.int64)
            _, of, count = np.unique(cell, axis=0, return_inverse=True, return_counts=True)
            crowd = count[of.ravel()].mean()
            if crowd <= self.CROWD or self.side < 1e-3:
                break
            self.side /= 2
        self.cells: dict[tuple[int, int], list[int]] = {}
        for i, at in enumerate(map(tuple, cell.tolist())):
            self.cells.setdefault(at, []).append(i)

    def nearest(self, px: float, py: float) -> tuple[float, int]:
        """(gap, end): the nearest free end, of equally near ones the first; rings of cells around the place, and all ends where these are bare."""
        if not self.few:
            best, end, x, y, cells = math.inf, -1, self.x, self.y, self.cells
            cx, cy = math.floor(px / self.side), math.floor(py / self.side)
            for r in range(self.RINGS):
                for i in range(cx - r, cx + r + 1):
                    for j in range(cy - r, cy + r + 1) if abs(i - cx) == r else (cy - r, cy + r):
                        for k in cells.get((i, j), ()):
                            dx, dy = x[k] - px, y[k] - py
                            gap = math.sqrt(dx * dx + dy * dy)
                            if gap < best or gap == best and k < end:
                                best, end = gap, k
                if best < r * self.side * (1 - 1e-9):  # what lies further out is not as near
                    return best, end
        left = np.flatnonzero(self.alive)
        dx, dy = self.xs[left] - px, self.ys[left] - py
        gaps = np.sqrt(dx * dx + dy * dy)
        at = int(np.argmin(gaps))
        return float(gaps[at]), int(left[at])

    def take(self, end: int) -> None:
        for k in (end, end ^ 1):
            self.alive[k] = False
            if not self.few:
                self.cells[math.floor(self.x[k] / self.side), math.floor(self.y[k] / self.side)].remove(k)


def _all_chains(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for street, segments, px, py, label in zip(batch.column("street").to_pylist(), batch.column("segments"), batch.column("x").to_pylist(), batch.column("y").to_pylist(), batch.column("label").to_pylist(), strict=True):
            oid, x, y = _ends_of(segments)
            free = _Free(x, y)
            for seq in range(len(oid)):
                gap, end = free.nearest(px, py)
                free.take(end)
                rows.append((street, int(oid[end // 2]), seq, end % 2 == 1, gap if seq else 0.0, label))
                px, py = float(x[end ^ 1]), float(y[end ^ 1])
        columns = zip(*rows, strict=True) if rows else [()] * 6
        kinds = (pa.string(), pa.int64(), pa.int32(), pa.bool_(), pa.float64(), pa.string())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["street", "oid", "seq", "flip", "gap_m", "origin"])


def chain(ends: DataFrame, tol: float = 2.0) -> DataFrame:
    """(street, oid, seq, flip, gap_m, origin): the segments along each street, nearest free end next, from the origin on.

    A fold over the segments of a street, not its points, which take the result by join; each step looks for the next end
    in a grid. Of ends equally near the one of the smaller oid wins, and of one segment's the start.
    """
    held = _segments(ends).join(origins(junctions(ends, tol), ends), "street")
    return held.select("street", "segments", "x", "y", "label").mapInArrow(_all_chains, "street string, oid long, seq int, flip boolean, gap_m double, origin string")


def with_runs(chained: DataFrame, gap_break: float = 40.0) -> DataFrame:
    """chained with run: one more at each gap above gap_break."""
    w = Window.partitionBy("street").orderBy("seq")
    return chained.withColumn("run", F.sum((F.col("gap_m") > gap_break).cast("int")).over(w).cast("int"))


def _along_street(points: DataFrame, chained: DataFrame, drop_null_z: bool) -> DataFrame:
    """path() with _along, the place in the direction of the path; a street is in order of run, seq and _along.

    A point finds its segment by number among the street's, in order of oid, so both sides meet by street alone.
    """
    held = chained.groupBy("street").agg(F.array_sort(F.collect_list(F.struct("oid", "seq", "flip", "run", "origin"))).alias("_segments"))
    p = points.where(F.col("street").isNotNull() & F.col("oid").isNotNull()).withColumn("_k", F.dense_rank().over(Window.partitionBy("street").orderBy("oid")) - 1)
    p = p.where(F.col("elev_m").isNotNull()) if drop_null_z else p
    p = p.join(held, "street").withColumn("_of", F.get("_segments", F.col("_k"))).drop("_segments", "_k")
    p = p.select("street", "oid", *(c for c in points.columns if c not in ("street", "oid")), "_of.seq", "_of.flip", "_of.run", "_of.origin")
    p = p.withColumn("_along", F.when(F.col("flip"), -F.col("dist_along_m")).otherwise(F.col("dist_along_m")))
    w = Window.partitionBy("street").orderBy("run", "seq", "_along")
    step = geo.planar(F.col("easting") - F.lag("easting").over(w), F.col("northing") - F.lag("northing").over(w))
    p = p.withColumn("path_idx", (F.row_number().over(w) - 1).cast("int")).withColumn("_step", F.coalesce(step, F.lit(0.0)))
    return p.withColumn("d", F.sum("_step").over(w)).drop("_step")


def path(points: DataFrame, chained: DataFrame, drop_null_z: bool = False) -> DataFrame:
    """points in path order with path_idx, run, origin and chainage d, which runs on over gaps.

    One running pass over each street, as smoothing makes one over each run. Points that are dealt out by street already
    are sent nowhere, else they are once.
    """
    return _along_street(points, chained, drop_null_z).drop("_along")


def smooth(p: DataFrame, window: float, group: tuple[str, ...] = ("street", "run"), order: tuple[str, ...] = ("path_idx",), z: str = "elev_m", out: str = "smooth") -> DataFrame:
    """Centred moving mean within a run; null where fewer than a third of the window is there."""
    w = max(3, round(window))
    ahead = (w - 1) // 2
    frame = Window.partitionBy(*group).orderBy(*order).rowsBetween(-(w - 1 - ahead), ahead)
    return p.withColumn(out, F.when(F.count(z).over(frame) >= max(3, w // 3), F.avg(z).over(frame)))


def profiles(points: DataFrame, window: float = 25.0, gap_break: float = 40.0, drop_null_z: bool = False, also: dict[str, float] | None = None, ends: DataFrame | None = None) -> DataFrame:
    """The smoothed path of every street; also: further columns with windows of their own. Points are put in order once.

    ends: the segments' ends (see segment_ends), where points are dear to make and their ends are known without.
    """
    p = _along_street(points, with_runs(chain(segment_ends(points) if ends is None else ends), gap_break), drop_null_z)
    for name, width in {"smooth": window, **(also or {})}.items():
        p = smooth(p, width, order=("seq", "_along"), out=name)
    return p.drop("_along")
