"""Linear referencing of polylines: cumulative distance, points at a distance, resampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geo


def cumulative(vertices: DataFrame, line: str | list[str] = "oid", order: str = "vertex_index", lon: str = "lon", lat: str = "lat", out: str = "dist_along_m") -> DataFrame:
    """vertices with the distance along their line, from 0."""
    w = Window.partitionBy(line).orderBy(order)
    step = geo.ground_distance(F.lag(lon).over(w), F.lag(lat).over(w), F.col(lon), F.col(lat))
    return vertices.withColumn(out, F.coalesce(step, F.lit(0.0))).withColumn(out, F.sum(out).over(w))


def as_lines(vertices: DataFrame, line: str = "oid", order: str = "vertex_index") -> DataFrame:
    """(line, path): one row a line; path is its ordered vertices with their distances."""
    v = cumulative(vertices, line, order)
    return v.groupBy(line).agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("i"), "lon", "lat", F.col("dist_along_m").alias("d")))).alias("path"))


def point_at(path: Column, target: Column) -> Column:
    """struct(lon, lat) at a distance along a path: the ends beyond it, else linear before the first vertex at or past it."""
    last = F.element_at(path, -1)
    after = F.element_at(F.filter(path, lambda v: (v["d"] >= target) & (v["i"] > path[0]["i"])), 1)
    before = F.element_at(F.filter(path, lambda v: v["i"] < after["i"]), -1)
    span = after["d"] - before["d"]
    t = F.when(span == 0, F.lit(0.0)).otherwise((target - before["d"]) / span)
    inner = F.struct((before["lon"] + t * (after["lon"] - before["lon"])).alias("lon"), (before["lat"] + t * (after["lat"] - before["lat"])).alias("lat"))
    ends = lambda v: F.struct(v["lon"].alias("lon"), v["lat"].alias("lat"))
    return F.when(target <= 0, ends(path[0])).when(target >= last["d"], ends(last)).otherwise(inner)


def _ends_and_steps(vertices: DataFrame, line: str | list[str], order: str) -> DataFrame:
    """The vertices in order with d, the next one as b, and the ends and length of their line; windows only, one sort a line."""
    w = Window.partitionBy(line).orderBy(order)
    v = cumulative(vertices, line, order).withColumn("_v", F.struct("lon", "lat", F.col("dist_along_m").alias("d")))
    v = v.withColumn("_b", F.lead("_v").over(w)).withColumn("_i", F.row_number().over(w))
    whole = Window.partitionBy(line)
    return v.withColumn("_first", F.min_by("_v", "_i").over(whole)).withColumn("_last", F.max_by("_v", "_i").over(whole))


def _between(a: Column, b: Column, target: Column) -> Column:
    """struct(lon, lat) at a distance between two vertices."""
    span = b["d"] - a["d"]
    t = F.when(span == 0, F.lit(0.0)).otherwise((target - a["d"]) / span)
    return F.struct((a["lon"] + t * (b["lon"] - a["lon"])).alias("lon"), (a["lat"] + t * (b["lat"] - a["lat"])).alias("lat"))


def _end(v: Column) -> Column:
    return F.struct(v["lon"].alias("lon"), v["lat"].alias("lat"))


def points_at(vertices: DataFrame, targets: DataFrame, at: str = "t", line: str = "oid", order: str = "vertex_index") -> DataFrame:
    """targets (line, at, ...) with pt, struct(lon, lat) at that distance along their line: the ends beyond it, else linear before the first vertex at or past it.

    An as-of merge: targets and vertices stand in one order by distance, from the far end, and each target takes the last
    vertex that it has passed with the one before that. So a line costs its vertices and targets once, not their product.
    Targets of lines without vertices are left out.
    """
    v = _ends_and_steps(vertices, line, order)
    w = Window.partitionBy(line).orderBy(order)
    known = v.select(line, F.col("dist_along_m").alias("_d"), F.lit(0).alias("_kind"), F.col("_i"), F.when(F.col("_i") > 1, F.struct(F.lag("_v").over(w).alias("a"), F.col("_v").alias("b"))).alias("_step"), F.lit(None).cast(targets.schema.simpleString()).alias("_row"))
    wanted = targets.select(line, F.col(at).alias("_d"), F.lit(1).alias("_kind"), F.lit(None).cast("int").alias("_i"), F.lit(None).cast(known.schema["_step"].dataType).alias("_step"), F.struct(*targets.columns).alias("_row"))
    # From the far end: vertices before targets at the same distance, and of those the first one last.
    back = Window.partitionBy(line).orderBy(F.desc("_d"), "_kind", F.desc("_i")).rowsBetween(Window.unboundedPreceding, 0)
    met = known.unionByName(wanted).withColumn("_step", F.last("_step", True).over(back)).where("_kind = 1")
    ends = v.where("_i = 1").select(line, "_first", "_last")
    t = F.col("_d")
    pt = F.when(t <= 0, _end(F.col("_first"))).when(t >= F.col("_last.d"), _end(F.col("_last"))).otherwise(_between(F.col("_step.a"), F.col("_step.b"), t))
    return met.join(ends, line).select(*(F.col(f"_row.{c}").alias(c) for c in targets.columns), pt.alias("pt"))


def resample(vertices: DataFrame, spacing: float, line: str | list[str] = "oid", order: str = "vertex_index") -> DataFrame:
    """Points about `spacing` apart, both ends among them, quantised to 7 and 2 decimals.

    Each step between two vertices makes the points that lie on it, so nothing is joined and no path is searched: a point
    k of n lies at length * k / n, which tells the first and the last k of a step. line: also several columns; vertices
    that are dealt out by one of them are sent nowhere.
    """
    keys = [line] if isinstance(line, str) else line
    length = F.col("_last.d")
    n = F.greatest(F.rint(length / spacing), F.lit(1.0)).cast("int")
    v = _ends_and_steps(vertices, line, order).withColumn("_n", n)
    # One more on either side, for the rounding of the division; the exact test follows.
    low = F.greatest(F.floor(F.col("_v.d") * F.col("_n") / length) - 1, F.lit(1)).cast("int")
    high = F.least(F.ceil(F.col("_b.d") * F.col("_n") / length) + 1, F.col("_n")).cast("int")
    none = F.array().cast("array<int>")
    on_step = F.when(F.col("_b").isNotNull() & (length > 0) & (low <= high), F.sequence(low, high)).otherwise(none)
    first = F.when((F.col("_i") == 1) & (length > 0), F.array(F.lit(0))).when(F.col("_i") == 1, F.sequence(F.lit(0), F.col("_n"))).otherwise(none)
    last = F.when(F.col("_b").isNull() & (length > 0), F.array(F.col("_n"))).otherwise(none)
    kind = lambda a, k: F.transform(a, lambda i: F.struct(i.alias("i"), F.lit(k).alias("kind")))
    p = v.withColumn("_p", F.explode(F.concat(kind(first, 0), kind(on_step, 1), kind(last, 2)))).withColumn("_t", length * F.col("_p.i") / F.col("_n"))
    t, k = F.col("_t"), F.col("_p.kind")
    p = p.where((k == 0) | ((k == 1) & (t < length) & (t > F.col("_v.d")) & (t <= F.col("_b.d"))) | ((k == 2) & (t >= length)))
    pt = F.when(k == 0, _end(F.col("_first"))).when(k == 2, _end(F.col("_last"))).otherwise(_between(F.col("_v"), F.col("_b"), t))
    p = p.select(*keys, F.col("_p.i").alias("point_index"), pt.alias("pt"), t.alias("at"))
    return p.select(*keys, "point_index", F.bround("pt.lat", 7).alias("lat"), F.bround("pt.lon", 7).alias("lon"), F.bround("at", 2).alias("dist_along_m"))


def endpoints(vertices: DataFrame, line: str = "oid", order: str = "vertex_index") -> DataFrame:
    """One row a line: ends, middle, length, vertex count and chord bearing."""
    p = as_lines(vertices, line, order).withColumn("a", F.col("path")[0]).withColumn("b", F.element_at("path", -1))
    p = p.withColumn("mid", point_at(F.col("path"), F.col("b.d") / 2))
    r7 = lambda c, n: F.bround(c, 7).alias(n)
    return p.select(
        line, r7("a.lat", "start_lat"), r7("a.lon", "start_lon"), r7("b.lat", "end_lat"), r7("b.lon", "end_lon"), r7("mid.lat", "mid_lat"), r7("mid.lon", "mid_lon"),
        F.bround("b.d", 2).alias("length_m"), F.size("path").alias("n_vertices"),
        F.bround(geo.chord_bearing(F.col("a.lon"), F.col("a.lat"), F.col("b.lon"), F.col("b.lat")), 1).alias("bearing_deg"),
    )


def step_heading(points: DataFrame, line: str = "oid", order: str = "point_index", e: str = "easting", n: str = "northing", out: str = "bearing_deg") -> DataFrame:
    """Heading of the step to the next point; the last point of a line repeats the one before."""
    w = Window.partitionBy(line).orderBy(order)
    ahead = geo.heading(F.lead(e).over(w) - F.col(e), F.lead(n).over(w) - F.col(n))
    behind = geo.heading(F.col(e) - F.lag(e).over(w), F.col(n) - F.lag(n).over(w))
    return points.withColumn(out, F.coalesce(ahead, behind, F.lit(0.0)))


def value_at(known: DataFrame, wanted: DataFrame, group: str, at: str, *values: str) -> DataFrame:
    """wanted (group, at) with the values interpolated between the known rows before and after, clamped at the ends.

    An as-of join on the union of both: the last known row before and the first after, in one pass over the group.
    """
    k = known.select(group, at, *values, F.lit(1).alias("_known"))
    w = wanted.select(group, at, *(F.lit(None).cast("double").alias(v) for v in values), F.lit(0).alias("_known")).distinct()
    both = k.unionByName(w)
    back = Window.partitionBy(group).orderBy(at, F.desc("_known")).rowsBetween(Window.unboundedPreceding, 0)
    ahead = Window.partitionBy(group).orderBy(F.desc(at), F.desc("_known")).rowsBetween(Window.unboundedPreceding, 0)
    seen = F.when(F.col("_known") == 1, F.struct(at, *values))
    out = both.withColumn("_a", F.last(seen, True).over(back)).withColumn("_b", F.last(seen, True).over(ahead)).where("_known = 0")

    def between(v: str) -> Column:
        a, b = F.col("_a"), F.col("_b")
        span = b[at] - a[at]
        t = F.when(span == 0, F.lit(0.0)).otherwise((F.col(at) - a[at]) / span)
        return F.when(a.isNull(), b[v]).when(b.isNull(), a[v]).otherwise(a[v] + t * (b[v] - a[v]))

    return out.select(group, at, *(between(v).alias(v) for v in values))
