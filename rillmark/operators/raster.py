"""Terrain as a table of cells: sampling by equal-key joins, mosaics, hillshade, statistics."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geo
from .order import quantiles


def cell_ids(points: DataFrame, e: str = "easting", n: str = "northing") -> DataFrame:
    """points with cell_e, cell_n and the distance to the cell's centre."""
    ce, cn = F.floor(e).cast("int"), F.floor(n).cast("int")
    return points.withColumn("cell_e", ce).withColumn("cell_n", cn).withColumn("cell_center_dist_m", F.bround(geo.planar(F.col(e) - ce - 0.5, F.col(n) - cn - 0.5), 4))


def same_cell_as_before(points: DataFrame, line: str | list[str] = "oid", order: str = "point_index") -> DataFrame:
    w = Window.partitionBy(line).orderBy(order)
    same = (F.col("cell_e") == F.lag("cell_e").over(w)) & (F.col("cell_n") == F.lag("cell_n").over(w))
    return points.withColumn("same_cell_as_prev", F.coalesce(same, F.lit(False)))


def window(cells: DataFrame, west: float, south: float, east: float, north: float) -> DataFrame:
    """The cells of a half-open box that are there; the range filters reach the scan."""
    return cells.where((F.col("cell_e") >= west) & (F.col("cell_e") < east) & (F.col("cell_n") >= south) & (F.col("cell_n") < north))


def boundless_window(cells: DataFrame, west: int, south: int, east: int, north: int, nodata: float | None = None) -> DataFrame:
    """(cell_e, cell_n, elev): every cell of a half-open box of one raster, nodata where the raster has none or does not reach.

    The lattice is generated by Spark and meets the cells on equal keys. A value that equals nodata reads as null first.
    """
    wide, high = max(0, east - west), max(0, north - south)
    at = cells.sparkSession.range(wide * high)
    lattice = at.select((F.lit(west) + F.col("id") % max(1, wide)).cast("int").alias("cell_e"), (F.lit(south) + F.floor(F.col("id") / max(1, wide))).cast("int").alias("cell_n"))
    inside = window(cells, west, south, east, north).select("cell_e", "cell_n", "elev")
    elev = F.col("elev") if nodata is None else F.coalesce(F.nullif(F.col("elev"), F.lit(nodata)), F.lit(nodata))
    return lattice.join(inside, ["cell_e", "cell_n"], "left").select("cell_e", "cell_n", elev.alias("elev"))


def _bordered(cells: DataFrame, side: int) -> DataFrame:
    """cells with be and bn, the blocks whose own they are or whose border."""
    own = lambda c: F.floor(F.col(c) / side).cast("int")
    reach = lambda c: F.array_compact(F.array(own(c), F.when(F.pmod(c, F.lit(side)) == 0, own(c) - 1), F.when(F.pmod(c, F.lit(side)) == side - 1, own(c) + 1)))
    return cells.withColumn("be", F.explode(reach("cell_e"))).withColumn("bn", F.explode(reach("cell_n")))


def blocks(cells: DataFrame, side: int = 64, by: tuple[str, ...] = ("dem_tile",)) -> DataFrame:
    """(by..., be, bn, at, z): the raster in square blocks of side cells with a border of one cell from the blocks around.

    z has the values in order of their place, (cell_e - be * side + 1) * (side + 2) + cell_n - bn * side + 1; at has the
    places, and is null where a block is full and a value stands at its place. A cell goes to its block, and if it lies at
    an edge, once to each neighbour: that is all that is ever sent between blocks.
    """
    placed = _bordered(cells.select(*by, "cell_e", "cell_n", "elev"), side)
    grouped = placed.groupBy(*by, "be", "bn").agg(F.array_sort(F.collect_list(F.struct(_place(F.col("cell_e"), F.col("cell_n"), side).alias("at"), F.col("elev").alias("z")))).alias("of"))
    return grouped.select(*by, "be", "bn", F.when(F.size("of") < (side + 2) ** 2, F.col("of.at")).alias("at"), F.col("of.z").alias("z"))


def _place(e: Column, n: Column, side: int) -> Column:
    return ((e - F.col("be") * side + 1) * (side + 2) + n - F.col("bn") * side + 1).cast("int")


def _found(place: Column) -> Column:
    """Where in z the value of a place stands, from 0; -1 or null if it is not there."""
    return F.when(F.col("at").isNull(), place).otherwise(F.array_position("at", place) - 1).cast("int")


def _value(place: Column) -> Column:
    return F.get("z", _found(place))


def on_blocks(points: DataFrame, held: DataFrame, side: int = 64) -> DataFrame:
    """points (with dem_tile) beside the block that holds the four cells around them, or nulls: one join, whatever is read from it.

    The raster is never broadcast: Spark does not see that cells explode from few rows and takes their blocks for small.
    """
    return _in_blocks(points, side).join(held.hint("merge"), ["dem_tile", "be", "bn"], "left")


def _in_blocks(points: DataFrame, side: int) -> DataFrame:
    """points with be and bn, the block that holds the four cells around them."""
    key = lambda c: F.floor(F.floor(F.col(c) - 0.5) / side).cast("int")
    return points.withColumn("be", key("easting")).withColumn("bn", key("northing"))


def _read(met: DataFrame, columns: list[str], side: int) -> DataFrame:
    """The columns of points beside their block, with what they read from it: elev_m and elev_cell_m."""
    fx, fy = F.col("easting") - 0.5, F.col("northing") - 0.5
    c0, r0 = F.floor(fx).cast("int"), F.floor(fy).cast("int")
    u, v = fx - c0, fy - r0
    cell = lambda i, j: _value(_place(c0 + i, r0 + j, side))
    elev = (1 - u) * (1 - v) * cell(0, 0) + u * (1 - v) * cell(1, 0) + (1 - u) * v * cell(0, 1) + u * v * cell(1, 1)
    near = _value(_place(F.rint(fx).cast("int"), F.rint(fy).cast("int"), side))
    return met.select(*columns, elev.alias("elev_m"), near.alias("elev_cell_m"))


def sample(placed: DataFrame, held: DataFrame, side: int = 64) -> DataFrame:
    """placed with elev_m, bilinear from the four cells around (null if one of them is missing or null), and elev_cell_m, the nearest cell; held has the blocks of the tiles."""
    return _read(on_blocks(placed, held, side), placed.columns, side)


def sample_made(points: DataFrame, surface: Callable[[Column, Column], Column], by: str, side: int = 4) -> DataFrame:
    """points with elev_m and elev_cell_m as sample() reads them, from a raster that is made where points lie: surface(cell_e, cell_n).

    The points of one value of `by` in one block are a group, and the block with its border is made once, in the group's
    row. So no cell is ever sent, nor are points that are dealt out by `by`. A block is as small as side, as a raster that
    is made has no reason to be larger than what is read from it.
    """
    carried = [c for c in points.columns if c != by]
    held = _in_blocks(points, side).groupBy(by, "be", "bn").agg(F.collect_list(F.struct(*carried)).alias("_points"))
    first = lambda c: F.col(c) * side - 1
    z = F.array(*(surface(first("be") + i, first("bn") + j) for i in range(side + 2) for j in range(side + 2)))
    met = held.select(by, "be", "bn", F.lit(None).cast("array<int>").alias("at"), z.alias("z"), F.explode("_points").alias("_point"))
    return _read(met.select(by, "be", "bn", "at", "z", "_point.*"), points.columns, side)


def in_tiles(points: DataFrame, tiles: DataFrame, inset: float = 1.0, grid: float = 10_000.0) -> DataFrame:
    """points with each tile that they lie inside of by inset; both meet in squares of a coarse grid, so the join is on equal keys."""
    square = lambda c: F.floor(c / grid)
    t = tiles.withColumn("_ge", F.explode(F.sequence(square(F.col("left_e")), square(F.col("right_e"))))).withColumn("_gn", F.explode(F.sequence(square(F.col("bottom_n")), square(F.col("top_n")))))
    inside = (F.col("easting") >= F.col("left_e") + inset) & (F.col("easting") < F.col("right_e") - inset) & (F.col("northing") >= F.col("bottom_n") + inset) & (F.col("northing") < F.col("top_n") - inset)
    met = points.withColumn("_ge", square(F.col("easting"))).withColumn("_gn", square(F.col("northing"))).join(t, ["_ge", "_gn"])
    return met.where(inside).drop("_ge", "_gn", "left_e", "right_e", "bottom_n", "top_n")


def in_bounds(cells: DataFrame, tiles: DataFrame) -> DataFrame:
    """The cells that reach into the bounds of their tile; no point inside of a tile has others around it."""
    t = F.broadcast(tiles.select("dem_tile", "left_e", "right_e", "bottom_n", "top_n"))  # a row a tile
    inside = (F.col("cell_e") + 1 > F.col("left_e")) & (F.col("cell_e") < F.col("right_e")) & (F.col("cell_n") + 1 > F.col("bottom_n")) & (F.col("cell_n") < F.col("top_n"))
    return cells.join(t, "dem_tile").where(inside).select(*cells.columns)


def bilinear(placed: DataFrame, cells: DataFrame, side: int = 64) -> DataFrame:
    """placed with elev_m from the four cells around; null if one of them is missing or null."""
    return sample(placed, blocks(cells, side), side).drop("elev_cell_m")


def nearest(placed: DataFrame, cells: DataFrame, side: int = 64) -> DataFrame:
    """placed with elev_cell_m, the cell at the rounded shifted index."""
    return sample(placed, blocks(cells, side), side).drop("elev_m")


def first_tile(sampled: DataFrame, *key: str) -> DataFrame:
    """Of the tiles tried in order the first with a value gives it; without one, the last that was tried."""
    rank = F.when(F.col("elev_m").isNotNull(), F.col("tile_rank")).otherwise(1_000_000 - F.col("tile_rank"))
    return sampled.withColumn("_n", F.row_number().over(Window.partitionBy(*key).orderBy(rank))).where("_n = 1").drop("_n")


def discontinuity(elev: Column, cell: Column) -> Column:
    return F.bround(F.abs(elev - cell) * 100, 2)


def overlapping(tiles: DataFrame, west: float, south: float, east: float, north: float) -> DataFrame:
    """The tiles whose bounds share more than an edge with a box."""
    return tiles.where((F.col("left_e") < east) & (F.col("right_e") > west) & (F.col("bottom_n") < north) & (F.col("top_n") > south))


def mosaic(cells: DataFrame, tiles: DataFrame, box: tuple[float, float, float, float] | None = None, side: int = 64) -> DataFrame:
    """(cell_e, cell_n, elev): the first tile with a value wins. box (west, south, east, north): only its cells, from the tiles that overlap it.

    Cells of all tiles meet at their place in one aggregate; side is no longer used.
    """
    if box:
        cells, tiles = window(cells, *box), overlapping(tiles, *box)
    ranked = cells.where(F.col("elev").isNotNull()).join(F.broadcast(tiles.select("dem_tile", "tile_rank")), "dem_tile")  # a row a tile
    return ranked.groupBy("cell_e", "cell_n").agg(F.min_by("elev", "tile_rank").alias("elev"))


def coarsen(cells: DataFrame, tiles: DataFrame, res: int = 10) -> DataFrame:
    """The mosaic of the cells that hold the centres of res-metre cells; the filter runs before the mosaic."""
    half = res // 2
    kept = cells.where((F.pmod("cell_e", F.lit(res)) == half) & (F.pmod("cell_n", F.lit(res)) == half))
    return mosaic(kept, tiles).withColumn("col", F.floor(F.col("cell_e") / res)).withColumn("row", F.floor(F.col("cell_n") / res)).select("col", "row", "elev")


def hillshade(grid: DataFrame, azimuth: float = 315.0, altitude: float = 45.0, exaggeration: float = 3.0, dx: float = 1.0, by: tuple[str, ...] = (), side: int = 64) -> DataFrame:
    """(by..., cell_e, cell_n, shade): light from azimuth and altitude on the slope; gaps take the median, edges one-sided steps.

    A stencil over blocks: the border of a block has the cells beside its own, so each cell reads its four neighbours in
    its own row of the block table. by: columns of grids that are shaded apart, each with its own median, such as the tile.
    """
    mid = quantiles(grid, "elev", (0.5,), by).withColumnRenamed("q0", "_mid")
    held = blocks(grid.select(*by, "cell_e", "cell_n", "elev"), side, by)
    g = held.join(F.broadcast(mid), list(by), "left") if by else held.crossJoin(mid)  # a row a grid
    g = g.select(*by, "be", "bn", "at", "z", "_mid", F.posexplode("z").alias("i", "elev")).withColumn("p", F.coalesce(F.get("at", F.col("i")), F.col("i")))
    e, n = F.floor(F.col("p") / (side + 2)).cast("int"), F.col("p") % (side + 2)
    g = g.where((e > 0) & (e <= side) & (n > 0) & (n <= side))

    def beside(step: int) -> Column:
        """The neighbour's value, the median in a gap; null where there is no cell."""
        at = _found(F.col("p") + step)
        return F.when(at >= 0, F.coalesce(F.get("z", at), F.col("_mid")) * exaggeration)

    z = F.coalesce("elev", "_mid") * exaggeration
    g = g.withColumn("zz", z).withColumn("w", beside(-side - 2)).withColumn("o", beside(side + 2)).withColumn("s", beside(-1)).withColumn("t", beside(1))

    def slope(prev: Column, nxt: Column) -> Column:
        return F.when(prev.isNotNull() & nxt.isNotNull(), (nxt - prev) / 2).when(nxt.isNotNull(), nxt - F.col("zz")).when(prev.isNotNull(), F.col("zz") - prev).otherwise(0.0) / dx

    az, alt = math.radians(90 - azimuth), math.radians(altitude)
    light = (math.cos(az) * math.cos(alt), math.sin(az) * math.cos(alt), math.sin(alt))
    g = g.withColumn("gx", slope(F.col("w"), F.col("o"))).withColumn("gy", slope(F.col("s"), F.col("t")))
    dot = (-F.col("gx") * light[0] - F.col("gy") * light[1] + light[2]) / F.sqrt(F.col("gx") * F.col("gx") + F.col("gy") * F.col("gy") + 1)
    return g.select(*by, (F.col("be") * side + e - 1).alias("cell_e"), (F.col("bn") * side + n - 1).alias("cell_n"), F.bround(dot, 6).alias("shade"))


def percentiles(cells: DataFrame, *shares: float) -> DataFrame:
    return quantiles(cells, "elev", shares).select(*(F.bround(f"q{i}", 6).alias(f"p{round(s * 100)}") for i, s in enumerate(shares)))


def join_attributes(points: DataFrame, attributes: DataFrame, key: str, columns: tuple[str, ...]) -> DataFrame:
    """points with columns of the line that they lie on, null where it has none."""
    return points.join(attributes.select(key, *columns), key, "left")


def window_stats(points: DataFrame, west: float, south: float, east: float, north: float, by: str, disc: str = "elev_disc_cm", threshold: float = 20.0) -> DataFrame:
    """(by, lo, hi, relief, n_points, n_flagged, n_cells) of the points in a half-open box."""
    inside = points.where((F.col("easting") >= west) & (F.col("easting") < east) & (F.col("northing") >= south) & (F.col("northing") < north))
    return cell_ids(inside).groupBy(by).agg(
        F.min("elev_m").alias("lo"), F.max("elev_m").alias("hi"), (F.max("elev_m") - F.min("elev_m")).alias("relief"), F.count("*").alias("n_points"),
        F.count_if(F.col(disc) > threshold).alias("n_flagged"), F.count_distinct("cell_e", "cell_n").alias("n_cells"),
    )
