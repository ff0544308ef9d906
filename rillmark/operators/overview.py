"""The city overview: classes, polylines, boxes, sag bins, legends, lookups; clustering of flagged cells."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import geo
from .order import quantiles

UNCLASSIFIED = "(unclassified)"
#: Classes in draw order with line widths; sag bins by least count with label, colour, least width.
CLASSES = (
    ("Local", 1.1), ("Minor Collector", 1.6), ("Major Collector", 2.0), ("Minor Arterial", 2.2), ("Principal Arterial", 2.6),
    ("Other Freeway or Expressway", 3.0), ("Interstate", 3.4), ("Ramp", 1.5), (UNCLASSIFIED, 1.0),
)
SAG_BINS = ((0, "no sag", "#aeb8c2", 0.0), (1, "1", "#fcc44e", 1.8), (2, "2", "#f99331", 2.2), (3, "3–4", "#ef6420", 2.6), (5, "5–9", "#cf2d16", 3.0), (10, "10+", "#8c0308", 3.4))
MAP_ASPECT = 1240 / 700


def class_bucket(name: Column) -> Column:
    return F.when(name.isin(*(c for c, _ in CLASSES)), name).otherwise(UNCLASSIFIED)


def class_dimension(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(c, i, w) for i, (c, w) in enumerate(CLASSES)], "cls string, draw_rank int, width double")


def class_points(points: DataFrame, name: str) -> DataFrame:
    """(cls, draw_rank, n): points of each class in draw order; null is unclassified, but a class that is not known is not drawn."""
    p = points.select(F.coalesce(name, F.lit(UNCLASSIFIED)).alias("cls"))
    known = F.broadcast(class_dimension(points.sparkSession).select("cls", "draw_rank"))  # nine rows
    return p.join(known, "cls").groupBy("cls", "draw_rank").agg(F.count("*").alias("n")).orderBy("draw_rank")


def sag_bin(n: Column) -> Column:
    """struct(bin, label, colour, floor) of a sag count."""
    out = None
    for i, (least, label, colour, floor) in enumerate(SAG_BINS):
        s = F.struct(F.lit(i).alias("bin"), F.lit(label).alias("label"), F.lit(colour).alias("colour"), F.lit(floor).alias("floor"))
        out = s if out is None else F.when(n >= least, s).otherwise(out)
    return out


def in_all(index: DataFrame, street: str = "street", variant: str = "variant") -> DataFrame:
    """Streets that every variant has."""
    n = index.agg(F.count_distinct(variant).alias("_all"))
    return index.groupBy(street).agg(F.count_distinct(variant).alias("_n")).join(F.broadcast(n), F.col("_n") == F.col("_all")).select(street)  # one row


def not_in_all(index: DataFrame, street: str = "street", variant: str = "variant") -> DataFrame:
    """(street, variants): streets that some variant lacks, with those that have it, in order of name."""
    n = index.agg(F.count_distinct(variant).alias("_all"))
    held = index.groupBy(street).agg(F.array_sort(F.collect_set(variant)).alias("variants"))  # variants are few
    return held.join(F.broadcast(n), F.size("variants") < F.col("_all")).select(street, F.array_join("variants", ",").alias("variants")).orderBy(street)


def polylines(vertices: DataFrame, line: str = "oid") -> DataFrame:
    """(line, path): the ordered Mercator vertices of each segment."""
    mx, my = geo.to_mercator(F.col("lon"), F.col("lat"))
    v = vertices.select(line, F.struct(F.col("vertex_index").alias("i"), F.bround(mx, 3).alias("mx"), F.bround(my, 3).alias("my")).alias("v"))
    return v.groupBy(line).agg(F.array_sort(F.collect_list("v")).alias("path"))


def boxes(vertices: DataFrame, key: str) -> DataFrame:
    mx, my = geo.to_mercator(F.col("lon"), F.col("lat"))
    v = vertices.select(key, mx.alias("mx"), my.alias("my"))
    return v.groupBy(key).agg(F.min("mx").alias("x0"), F.min("my").alias("y0"), F.max("mx").alias("x1"), F.max("my").alias("y1"))


def viewport(x0: Column, y0: Column, x1: Column, y1: Column, aspect: float = MAP_ASPECT) -> list[Column]:
    """The box padded by a quarter or 120, then grown on its short side to the aspect."""
    px, py = F.greatest((x1 - x0) * 0.25, F.lit(120.0)), F.greatest((y1 - y0) * 0.25, F.lit(120.0))
    w, h, cx, cy = x1 - x0 + px * 2, y1 - y0 + py * 2, (x0 + x1) / 2, (y0 + y1) / 2
    hw, hh = F.greatest(w, h * aspect) / 2, F.greatest(h, w / aspect) / 2
    return [(cx - hw).alias("vx0"), (cy - hh).alias("vy0"), (cx + hw).alias("vx1"), (cy + hh).alias("vy1")]


def wide_variants(index: DataFrame, variants: list[str]) -> DataFrame:
    """One row a street with n_sags_<variant>; inlets and length from the first variant only."""
    p = index.groupBy("street").pivot("variant", variants).agg(F.first("n_sags")).select("street", *(F.col(v).alias(f"n_sags_{v}") for v in variants))
    return p.join(index.where(F.col("variant") == variants[0]).select("street", "n_inlets", "length_m"), "street", "left")


def search(index: DataFrame, pattern: str, street: str = "street") -> DataFrame:
    """Streets whose name holds the pattern in any case; patterns below two characters find nothing."""
    return index.where(F.lower(street).contains(pattern.lower()) & F.lit(len(pattern) >= 2))


def islands(flagged: DataFrame, gap: float = 5.0) -> DataFrame:
    """(street, oid, island, n, x, y): flagged points of a segment with no gap above `gap` between them."""
    w = Window.partitionBy("street", "oid").orderBy("dist_along_m")
    new = F.coalesce((F.col("dist_along_m") - F.lag("dist_along_m").over(w) > gap).cast("int"), F.lit(1))
    f = flagged.withColumn("_new", new).withColumn("island", F.sum("_new").over(w).cast("int"))
    return f.groupBy("street", "oid", "island").agg(F.count("*").alias("n"), F.avg("easting").alias("x"), F.avg("northing").alias("y"))


def with_fallback(centres: DataFrame, points: DataFrame) -> DataFrame:
    """centres (street, x, y, n), and the median point with n 0 of each street without one."""
    rest = points.join(centres.select("street").distinct(), "street", "left_anti")
    middle = lambda c, name: quantiles(rest, c, (0.5,), ("street",)).withColumnRenamed("q0", name)
    return centres.select("street", "x", "y", "n").unionByName(middle("easting", "x").join(middle("northing", "y"), "street").withColumn("n", F.lit(0).cast("long")))


def merge_centres(centres: DataFrame, window: float = 40.0, keep: int = 3) -> DataFrame:
    """(street, rank, x, y, n): centres from the largest down, each merged by weight into the first within the window.

    An ordered fold over the few centres of a street.
    """
    item = F.struct((-F.col("n")).alias("key"), F.col("x"), F.col("y"), F.col("n").cast("double").alias("n"))
    folded = centres.groupBy("street").agg(F.array_sort(F.collect_list(item)).alias("c"))
    point = lambda x, y, n: F.struct(x.alias("x"), y.alias("y"), n.alias("n"))
    near = lambda m, c: geo.planar(m["x"] - c["x"], m["y"] - c["y"]) < window

    def step(acc: Column, c: Column) -> Column:
        hit = F.filter(F.sequence(F.lit(0), F.size(acc) - 1), lambda i: near(F.get(acc, i), c))
        first = F.when(F.size(acc) > 0, F.get(hit, F.lit(0)))
        mean = lambda m, v: (m[v] * m["n"] + c[v] * c["n"]) / (m["n"] + c["n"])
        merged = F.transform(acc, lambda m, i: F.when(i == first, point(mean(m, "x"), mean(m, "y"), m["n"] + c["n"])).otherwise(m))
        return F.when(first.isNull(), F.concat(acc, F.array(point(c["x"], c["y"], c["n"])))).otherwise(merged)

    start = F.transform(F.filter("c", lambda x: F.lit(False)), lambda x: point(x["x"], x["y"], x["n"]))
    out = folded.select("street", F.posexplode(F.slice(F.aggregate("c", start, step), 1, keep)).alias("rank", "m"))
    return out.select("street", "rank", "m.x", "m.y", F.col("m.n").cast("long").alias("n"))
