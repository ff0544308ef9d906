"""The arithmetic of chart and map scales: metres per pixel, sizes, paddings, zooms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geo

#: Metres per pixel to choose from, sizes in pixels, padding.
H_LADDER = (0.1, 0.2, 0.5, 1.0, 2.0, 5.0, 10.0, 20.0, 50.0, 100.0, 200.0)
MAP_LADDER = (0.25, 0.5, 1.0, 2.0, 5.0, 10.0, 20.0, 50.0, 100.0)
PROFILE_W, PROFILE_H, MAP_W, MAP_H = (420.0, 1400.0), (200.0, 900.0), (420.0, 1200.0), (320.0, 1000.0)
V_MPP, PAD_SHARE, PAD = 0.02, 0.6, (60.0, 250.0)
EQUATOR = 40075016.686


def value_range(p: DataFrame, pairs: DataFrame) -> DataFrame:
    """(street, length, lo, hi): chainage and elevations of each street, its typed inlets' included."""
    near = pairs.groupBy("street").agg(F.min(F.least("grate_m", "invert_m")).alias("a"), F.max(F.greatest("grate_m", "invert_m")).alias("b"))
    own = p.groupBy("street").agg(F.max("d").alias("length"), F.min("elev_m").alias("z0"), F.max("elev_m").alias("z1"))
    return own.join(near, "street", "left").select("street", "length", F.least("z0", "a").alias("lo"), F.greatest("z1", "b").alias("hi"))


def profile_scale(ranges: DataFrame) -> DataFrame:
    """Horizontal and vertical scale, size and limits of each profile, and the page's padded limits."""
    r = ranges.withColumn("h_mpp", geo.first_step(H_LADDER, lambda t: F.col("length") / t <= PROFILE_W[1]))
    r = r.withColumn("need", F.greatest(F.col("hi") - F.col("lo"), F.lit(0.05)) * 1.06).withColumn("px", geo.clip(F.col("need") / V_MPP, *PROFILE_H))
    r = r.withColumn("v", F.when(F.col("need") / V_MPP <= PROFILE_H[1], F.lit(V_MPP)).otherwise(F.col("need") / F.col("px")))
    mid, half, pad = (F.col("lo") + F.col("hi")) / 2, F.col("px") * F.col("v") / 2, F.greatest((F.col("hi") - F.col("lo")) * 0.06, F.lit(0.15))
    width = geo.clip(F.col("length") / F.col("h_mpp"), *PROFILE_W)
    return r.select("street", "h_mpp", width.alias("width_px"), F.col("v").alias("v_mpp"), F.col("px").alias("height_px"), (mid - half).alias("y_low"), (mid + half).alias("y_high"), (F.col("lo") - pad).alias("page_low"), (F.col("hi") + pad).alias("page_high"))


def mercator_box(p: DataFrame) -> DataFrame:
    """(street, x0, x1, y0, y1, scale): the box of each path in Mercator metres, and the ground metres in one of them."""
    lon, lat = geo.from_utm(F.col("easting"), F.col("northing"))
    g = p.select("street", lon.alias("lon"), lat.alias("lat"))
    mx, my = geo.to_mercator(F.col("lon"), F.col("lat"))
    return g.select("street", "lat", mx.alias("mx"), my.alias("my")).groupBy("street").agg(F.min("mx").alias("x0"), F.max("mx").alias("x1"), F.min("my").alias("y0"), F.max("my").alias("y1"), F.cos(F.radians(F.avg("lat"))).alias("scale"))


def _pad(w: Column, h: Column) -> Column:
    return geo.clip(F.greatest(w, h) * PAD_SHARE, *PAD)


def map_scale(boxes: DataFrame) -> DataFrame:
    """Padding in ground metres, metres per pixel, size and basemap zoom of each street's map."""
    e = boxes.withColumn("gx", F.greatest((F.col("x1") - F.col("x0")) * F.col("scale"), F.lit(1.0))).withColumn("gy", F.greatest((F.col("y1") - F.col("y0")) * F.col("scale"), F.lit(1.0)))
    e = e.withColumn("pad_m", _pad(F.col("gx"), F.col("gy"))).withColumn("ex", F.col("gx") + F.col("pad_m") * 2).withColumn("ey", F.col("gy") + F.col("pad_m") * 2)
    e = e.withColumn("m_mpp", geo.first_step(MAP_LADDER, lambda t: (F.col("ex") / t <= MAP_W[1]) & (F.col("ey") / t <= MAP_H[1])))
    zoom = geo.clip(F.rint(F.log2(F.lit(3 * EQUATOR) / F.greatest("ex", "ey"))), 12.0, 18.0).cast("int")
    return e.select("street", "pad_m", "m_mpp", geo.clip(F.col("ex") / F.col("m_mpp"), *MAP_W).alias("width_px"), geo.clip(F.col("ey") / F.col("m_mpp"), *MAP_H).alias("height_px"), zoom.alias("zoom"))


def page_box(boxes: DataFrame) -> DataFrame:
    """(street, x_low, x_high, y_low, y_high): the page's map range, padded in Mercator metres."""
    pad = _pad(F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0"))
    return boxes.select("street", (F.col("x0") - pad).alias("x_low"), (F.col("x1") + pad).alias("x_high"), (F.col("y0") - pad).alias("y_low"), (F.col("y1") + pad).alias("y_high"))


def fit_zoom(w: Column, e: Column, s: Column, n: Column, width: float = 1400.0, height: float = 800.0) -> Column:
    """The zoom at which a box of lon and lat fits a view of so many pixels, a little less."""
    sx = F.greatest(e - w, F.lit(1e-9))
    sy = F.greatest(n - s, F.lit(1e-9)) / F.cos(F.radians((s + n) / 2))
    fit = lambda px, span: F.log2(F.lit(px * 360) / (span * 256))
    return F.least(fit(width, sx), fit(height, sy)) - 0.6


def street_window(points: DataFrame, pad: float = 60.0) -> DataFrame:
    """(street, w, s, e, n, tall): whole metres around each street, and whether that is much higher than wide."""
    b = points.groupBy("street").agg(F.min("easting").alias("a"), F.min("northing").alias("b"), F.max("easting").alias("c"), F.max("northing").alias("d"))
    down, up = (lambda c: F.floor(F.col(c) - pad).cast("double")), (lambda c: F.ceil(F.col(c) + pad).cast("double"))
    return b.select("street", down("a").alias("w"), down("b").alias("s"), up("c").alias("e"), up("d").alias("n"), (F.col("d") - F.col("b") + 2 * pad > (F.col("c") - F.col("a") + 2 * pad) * 1.6).alias("tall"))
