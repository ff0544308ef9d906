"""Point assets on streets: cleaning, snapping to paths, numbering, serving of sags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geo
from .order import quantiles

#: Metres in a foot, the vertical datum shift, and the feet taken as sane.
FOOT, DATUM_SHIFT = 0.3048, 0.794
GRATE_FT, INVERT_FT = (300.0, 900.0), (250.0, 900.0)
#: Marker and colour of each inlet type, and of all others.
STYLES = (
    ("Curb Inlet", "o", "#2e86c1"), ("Grated Inlet", "s", "#e08e45"), ("Slotted Drain", "D", "#7b3294"),
    ("Trench Drain", "P", "#1a9850"), ("Standard", "^", "#c9a227"), ("Unknown", "X", "#888888"),
)
OTHER_STYLE = ("v", "#555555")
VIEW_URL = "https://www.google.com/maps/@?api=1&map_action=pano&viewpoint=%.6f,%.6f&heading=%.0f"


def to_metres(feet: Column, shift: float = DATUM_SHIFT) -> Column:
    return feet * FOOT + shift


def clean(inlets: DataFrame, shift: float = DATUM_SHIFT) -> DataFrame:
    """grate_m and invert_m in metres, null outside the sane bands, and the type with a default."""
    sane = lambda c, band: F.when(F.col(c).between(*band), to_metres(F.col(c), shift))
    return inlets.withColumn("grate_m", sane("top_of_grate_ft", GRATE_FT)).withColumn("invert_m", sane("invert_ft", INVERT_FT)).withColumn("type", F.coalesce("type_description", F.lit("Unknown")))


def styled(inlets: DataFrame) -> DataFrame:
    """inlets, cleaned, with marker and colour by type."""
    dimension = inlets.sparkSession.createDataFrame(list(STYLES), "type string, marker string, colour string")
    known = inlets.join(F.broadcast(dimension), "type", "left")  # the rows of STYLES
    return known.withColumn("marker", F.coalesce("marker", F.lit(OTHER_STYLE[0]))).withColumn("colour", F.coalesce("colour", F.lit(OTHER_STYLE[1])))


def datum_offset(pairs: DataFrame) -> DataFrame:
    """(median_offset, std_offset, n): how far surveyed grates lie above the terrain, over typed pairs; one row."""
    x = F.col("grate_m") - F.col("dem_m")
    spread = pairs.agg(F.bround(F.stddev_samp(x), 6).alias("std_offset"), F.count(x).alias("n"))
    return spread.join(quantiles(pairs.select(x.alias("x")), "x", (0.5,)), how="left").select(F.bround("q0", 6).alias("median_offset"), "std_offset", "n")  # one row each


def view_links(pairs: DataFrame, p: DataFrame, inlets: DataFrame) -> DataFrame:
    """(street, inlet_id, heading, url): the look from the road point that each inlet snapped to, towards the inlet."""
    at = pairs.select("street", "inlet_id", "path_idx").join(p.select("street", "path_idx", "easting", "northing"), ["street", "path_idx"]).join(inlets.select("inlet_id", "x", "y"), "inlet_id")
    (lon, lat), (to_lon, to_lat) = geo.from_utm(F.col("easting"), F.col("northing")), geo.from_utm(F.col("x"), F.col("y"))
    out = at.select("street", "inlet_id", lon.alias("lon"), lat.alias("lat"), geo.great_circle_bearing(lat, lon, to_lat, to_lon).alias("heading"))
    return out.select("street", "inlet_id", "heading", F.format_string(VIEW_URL, "lat", "lon", "heading").alias("url"))


def in_shares(left: DataFrame, right: DataFrame, cell: tuple[str, ...], id_left: str, id_right: str, most: int) -> tuple[DataFrame, DataFrame]:
    """left and right with columns _l and _r, so that a join on cell, _l and _r pairs the rows of a cell as a join on cell does, in parts of about `most` rows a side.

    A cell with more rows is split on that side by a hash of its id, and the other side is repeated for each part; cells
    are counted with one aggregate a side, and where none has more, nothing is repeated. The list of crowded cells is
    broadcast, a row for `most` rows at the most, so either side is sent once, for the join itself.
    """
    parts = lambda df, name: df.groupBy(*cell).agg(F.ceil(F.count("*") / most).cast("int").alias(name)).where(F.col(name) > 1)
    split = parts(left, "_pl").join(parts(right, "_pr"), list(cell), "full").select(*cell, F.coalesce("_pl", F.lit(1)).alias("_pl"), F.coalesce("_pr", F.lit(1)).alias("_pr"))
    split = F.broadcast(split)
    one = lambda c: F.coalesce(c, F.lit(1))
    own = lambda key, n: F.pmod(F.xxhash64(key), one(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), one(n) - 1))
    a = left.join(split, list(cell), "left").withColumn("_l", own(id_left, "_pl")).withColumn("_r", each("_pr"))
    b = right.join(split, list(cell), "left").withColumn("_r", own(id_right, "_pr")).withColumn("_l", each("_pl"))
    return a.drop("_pl", "_pr"), b.drop("_pl", "_pr")


def snap(inlets: DataFrame, p: DataFrame, reach: float = 30.0, most: int = 4096, also: tuple[str, ...] = (), parts: int | None = None) -> DataFrame:
    """(street, inlet_id, path_idx, chainage, offset_m, dem_m, smooth_m, also...): the nearest path point of each street within reach.

    Both sides meet in grid cells of the reach's size, the inlet in the nine around it, so the join is on equal keys; a
    cell with more than `most` inlets or points is split, so no task pairs all of a crowded place. Of equally near points
    the first on the path wins. An inlet can belong to several streets. also: further columns of the point; parts: over
    how many tasks cells are dealt out, as many as a shuffle has by default. A path without elev_m gives no dem_m.
    """
    terrain = ("elev_m",) if "elev_m" in p.columns else ()
    cell = lambda c: F.floor(F.col(c) / reach)
    around = F.explode(F.sequence(F.lit(-1), F.lit(1)))
    i = inlets.where("x is not null and y is not null").select("inlet_id", "x", "y").withColumn("dx", around)
    i = i.withColumn("dy", around).select("inlet_id", "x", "y", (cell("x") + F.col("dx")).alias("gx"), (cell("y") + F.col("dy")).alias("gy"))
    q = p.select("street", "path_idx", "d", "easting", "northing", *terrain, "smooth", *also).withColumn("gx", cell("easting")).withColumn("gy", cell("northing"))
    box = p.groupBy("street").agg(F.min("easting").alias("w"), F.max("easting").alias("e"), F.min("northing").alias("s"), F.max("northing").alias("n"))
    i, q = in_shares(i, q, ("gx", "gy"), "inlet_id", "path_idx", most)
    i, q = (df.repartition(parts, "gx", "gy", "_l", "_r") if parts else df for df in (i, q))
    near = i.join(q, ["gx", "gy", "_l", "_r"]).withColumn("d2", (F.col("x") - F.col("easting")) ** 2 + (F.col("y") - F.col("northing")) ** 2).where(F.col("d2") <= reach * reach)
    best = near.groupBy("street", "inlet_id").agg(F.min(F.struct("d2", "path_idx", "d", *terrain, "smooth", "x", "y", *also)).alias("b"))
    inside = (F.col("b.x") > F.col("w") - reach) & (F.col("b.x") < F.col("e") + reach) & (F.col("b.y") > F.col("s") - reach) & (F.col("b.y") < F.col("n") + reach)
    return best.join(box, "street").where(inside).select("street", "inlet_id", "b.path_idx", F.col("b.d").alias("chainage"), F.sqrt("b.d2").alias("offset_m"), *(F.col(f"b.{c}").alias("dem_m") for c in terrain), F.col("b.smooth").alias("smooth_m"), *(F.col(f"b.{c}").alias(c) for c in also))


def number(pairs: DataFrame) -> DataFrame:
    """pairs with num, 1.. along each street."""
    return pairs.withColumn("num", F.row_number().over(Window.partitionBy("street").orderBy("chainage", "inlet_id")).cast("int"))


def candidates(sags: DataFrame, pairs: DataFrame, window: float = 60.0, tolerance: float = 0.2) -> DataFrame:
    """(street, sag_num, pick): the nearest numbered inlet of each sag within the window and the height tolerance.

    Both meet in stretches of the window's length, the sag also in those beside its own.
    """
    slot = lambda c: F.floor(c / window)
    s = sags.select("street", "sag_num", F.col("d").alias("sag_d"), F.col("smooth").alias("sag_z"), F.explode(F.sequence(slot(F.col("d")) - 1, slot(F.col("d")) + 1)).alias("slot"))
    ok = s.join(pairs.withColumn("slot", slot(F.col("chainage"))), ["street", "slot"]).withColumn("gap", F.abs(F.col("chainage") - F.col("sag_d")))
    ok = ok.where((F.col("gap") <= window) & (F.abs(F.col("smooth_m") - F.col("sag_z")) <= tolerance))
    return ok.groupBy("street", "sag_num").agg(F.min(F.struct("gap", "num")).alias("b")).select("street", "sag_num", F.col("b.num").alias("pick"))


def served(picks: DataFrame) -> DataFrame:
    """picks whose inlet no earlier sag has picked; a pick never depends on earlier sags, so a rank decides."""
    first = Window.partitionBy("street", "pick").orderBy("sag_num")
    return picks.withColumn("_n", F.row_number().over(first)).where("_n = 1").drop("_n")


def unserved(sags: DataFrame, served_sags: DataFrame, pairs: DataFrame) -> DataFrame:
    """The other sags with the nearest inlet along the street, however far, and their place in lon and lat."""
    rest = sags.join(served_sags.select("street", "sag_num"), ["street", "sag_num"], "left_anti")
    # The inlets before and after each sag, from one order of both along the street.
    least = pairs.groupBy("street", "chainage").agg(F.min(F.struct("num", "inlet_id", "smooth_m")).alias("i"))
    both = rest.select("street", F.col("d").alias("at"), F.lit(1).alias("kind"), F.struct("sag_num", "d", "smooth", "easting", "northing").alias("sag")).unionByName(
        least.select("street", F.col("chainage").alias("at"), F.lit(0).alias("kind"), F.struct(F.col("chainage").alias("at"), "i.*").alias("inlet")), allowMissingColumns=True
    )
    w = Window.partitionBy("street").orderBy("at", "kind")
    back = Window.partitionBy("street").orderBy(F.desc("at"), F.desc("kind"))  # running as well, so each row is met once
    both = both.withColumn("l", F.last("inlet", True).over(w)).withColumn("r", F.last("inlet", True).over(back)).where("kind = 1").select("street", "sag.*", "l", "r")
    reach = lambda c: F.when(F.col(c).isNotNull(), F.struct(F.abs(F.col(f"{c}.at") - F.col("d")).alias("gap"), f"{c}.num", f"{c}.inlet_id", f"{c}.smooth_m"))
    near = both.withColumn("b", F.array_min(F.array_compact(F.array(reach("l"), reach("r")))))
    lon, lat = geo.from_utm(F.col("easting"), F.col("northing"))
    return near.select("street", "sag_num", "d", "smooth", lon.alias("lon"), lat.alias("lat"), F.col("b.num").alias("near_num"), F.col("b.gap").alias("gap_m"), (F.col("b.smooth_m") - F.col("smooth")).alias("lift_m"), F.col("b.inlet_id").alias("near_inlet"))


def report(sags: DataFrame, served_sags: DataFrame, missing: DataFrame) -> DataFrame:
    """One row a sag with its status."""
    a = sags.join(served_sags, ["street", "sag_num"]).select("street", "sag_num", F.col("d").alias("sag_chainage"), F.col("smooth").alias("sag_elev"), F.lit("served").alias("status"), F.col("pick").alias("num"))
    b = missing.select("street", "sag_num", F.col("d").alias("sag_chainage"), F.col("smooth").alias("sag_elev"), F.lit("no inlet").alias("status"), "near_num", "gap_m", "lift_m")
    return a.unionByName(b, allowMissingColumns=True)
