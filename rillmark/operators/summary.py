"""Tables per street and for the whole network."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .order import quantiles


def profile_index(p: DataFrame, flag_cm: float = 20.0) -> DataFrame:
    """Length, gaps, elevations, grade and flagged points of each street, longest first."""
    out = p.groupBy("street").agg(
        F.count_distinct("oid").alias("n_segments"), F.max("d").alias("length"), F.max("run").cast("int").alias("n_gaps"), F.first("origin").alias("origin"),
        F.min_by("elev_m", "path_idx").alias("a"), F.max_by("elev_m", "path_idx").alias("b"), F.min("elev_m").alias("lo"), F.max("elev_m").alias("hi"),
        F.count_if(F.col("elev_disc_cm") > flag_cm).alias("pts_flagged_disc"),
    )
    change = F.col("b") - F.col("a")
    return out.select(
        "street", "n_segments", F.bround("length", 1).alias("length_m"), "n_gaps", "origin", F.bround("a", 3).alias("elev_start_m"), F.bround("b", 3).alias("elev_end_m"),
        F.bround("lo", 3).alias("elev_min_m"), F.bround("hi", 3).alias("elev_max_m"), F.bround(change, 3).alias("net_change_m"),
        F.bround(F.when(F.col("length") > 0, change / F.col("length") * 100).otherwise(0.0), 3).alias("mean_grade_pct"), "pts_flagged_disc",
    ).orderBy(F.desc("length_m"), "street")


def drain_index(p: DataFrame, pairs: DataFrame) -> DataFrame:
    """Points and inlets of each street, most inlets first."""
    near = pairs.groupBy("street").agg(F.count("*").alias("n_inlets"), F.count("grate_m").alias("n_grate_elev"), F.count("invert_m").alias("n_invert_elev"))
    near = near.join(quantiles(pairs, "offset_m", (0.5,), ("street",)), "street", "left").withColumn("median_offset_m", F.bround("q0", 1)).drop("q0")
    out = p.groupBy("street").agg(F.count("*").alias("n_points")).join(near, "street", "left")
    return out.fillna(0, ["n_inlets", "n_grate_elev", "n_invert_elev"]).orderBy(F.desc("n_inlets"), "street")


def street_index(p: DataFrame, pairs: DataFrame, sags: DataFrame, served: DataFrame) -> DataFrame:
    """Points, inlets, sags, served and unserved sags and length of each street."""
    count = lambda df, name: df.groupBy("street").agg(F.count("*").alias(name))
    out = p.groupBy("street").agg(F.count("*").alias("n_points"), F.bround(F.max("d"), 1).alias("length_m"))
    for df, name in ((pairs, "n_inlets"), (sags, "n_sags"), (served, "n_served")):
        out = out.join(count(df, name), "street", "left")
    out = out.fillna(0, ["n_inlets", "n_sags", "n_served"])
    return out.select("street", "n_points", "n_inlets", "n_sags", "n_served", (F.col("n_sags") - F.col("n_served")).alias("n_unserved"), "length_m")


def totals(index: DataFrame) -> DataFrame:
    return index.agg(
        F.count("*").alias("streets"), F.count_if(F.col("n_inlets") > 0).alias("with_inlets"), F.count_if(F.col("n_inlets") == 0).alias("without_inlets"),
        F.sum("n_inlets").alias("inlets"), F.sum("n_sags").alias("sags"), F.sum("n_served").alias("served"), F.sum("n_unserved").alias("unserved"),
    )


def select_streets(index: DataFrame, min_length: float = 0.0, min_inlets: int = 0, unserved_only: bool = False) -> DataFrame:
    keep = (F.col("length_m") >= min_length) & (F.col("n_inlets") >= min_inlets)
    return index.where(keep & (F.col("n_unserved") > 0) if unserved_only else keep)


def sample_candidates(points: DataFrame, inlets: DataFrame, reach: float = 30.0, least: int = 3) -> DataFrame:
    """(street, n_near): streets whose box, grown by reach, holds at least `least` inlets (borders included).

    Both meet in cells of a grid as coarse as the box is long, so the join has equal keys, a box lies in four cells at
    most whatever its size, and an inlet in one cell of each coarseness that occurs.
    """
    box = points.where(F.col("street").isNotNull()).groupBy("street").agg((F.min("easting") - reach).alias("w"), (F.max("easting") + reach).alias("e"), (F.min("northing") - reach).alias("s"), (F.max("northing") + reach).alias("n"))
    # Twofold cells, so that rounding never makes a box longer than one.
    box = box.withColumn("level", F.greatest(F.ceil(F.log2(F.greatest(F.col("e") - F.col("w"), F.col("n") - F.col("s"), F.lit(500.0)))), F.lit(0)).cast("int") + 1)
    place = lambda c: F.floor(F.col(c) / F.pow(F.lit(2.0), F.col("level")))
    span = lambda a, b: F.explode(F.sequence(place(a), place(b)))
    cells = box.withColumn("gx", span("w", "e")).withColumn("gy", span("s", "n"))
    levels = F.broadcast(box.select("level").distinct())  # a row a power of two
    i = inlets.where("x is not null and y is not null").select("inlet_id", "x", "y").crossJoin(levels).withColumn("gx", place("x")).withColumn("gy", place("y"))
    hits = i.join(cells, ["level", "gx", "gy"]).where(F.col("x").between(F.col("w"), F.col("e")) & F.col("y").between(F.col("s"), F.col("n")))
    return hits.groupBy("street").agg(F.count("*").alias("n_near")).where(F.col("n_near") >= least)


def sample_streets(candidates: DataFrame, n: int, seed: int = 0) -> DataFrame:
    """n of the candidates, the same for the same seed, in any engine: the first ones by the digest of seed and name."""
    return candidates.orderBy(F.md5(F.concat(F.lit(f"{seed}:"), "street").cast("binary")), "street").limit(n)


def safe_names(streets: DataFrame, name: str = "street") -> DataFrame:
    """(street, file_key): names fit for files, made unique in order of name."""
    base = F.regexp_replace(F.regexp_replace(name, "[^A-Za-z0-9]+", "_"), "^_|_$", "")
    s = streets.withColumn("_base", F.substring(F.when(base == "", "UNNAMED").otherwise(base), 1, 80))
    k = F.row_number().over(Window.partitionBy("_base").orderBy(name)) - 1
    return s.withColumn("_k", k).select(name, F.when(F.col("_k") > 0, F.concat("_base", F.lit("__"), "_k")).otherwise(F.col("_base")).alias("file_key"))


def variant_diff(a: DataFrame, b: DataFrame) -> DataFrame:
    """Totals of two street indexes and the number of streets whose sags differ."""
    cols = lambda df, x: df.select("street", *(F.col(c).alias(f"{c}_{x}") for c in ("n_sags", "n_unserved")))
    both = cols(a, "a").join(cols(b, "b"), "street", "full")
    differ: Column = ~F.col("n_sags_a").eqNullSafe(F.col("n_sags_b")) | ~F.col("n_unserved_a").eqNullSafe(F.col("n_unserved_b"))
    return both.agg(F.sum("n_sags_a").alias("sags_a"), F.sum("n_sags_b").alias("sags_b"), F.sum("n_unserved_a").alias("unserved_a"), F.sum("n_unserved_b").alias("unserved_b"), F.count_if(differ).alias("streets_differ"))


def type_breakdown(pairs: DataFrame) -> DataFrame:
    """Inlets of each street and type: with grate, without, with invert, with both; offsets."""
    middle = quantiles(pairs, "offset_m", (0.5,), ("street", "type"))
    out = pairs.groupBy("street", "type").agg(
        F.count("*").alias("n"), F.count("grate_m").alias("n_grate"), F.count_if(F.col("grate_m").isNull()).alias("n_unsurveyed"), F.count("invert_m").alias("n_invert"),
        F.count_if(F.col("grate_m").isNotNull() & F.col("invert_m").isNotNull()).alias("n_stem"), F.bround(F.max("offset_m"), 6).alias("max_offset"),
    )
    return out.join(middle, ["street", "type"], "left").withColumn("median_offset", F.bround("q0", 6)).drop("q0")


def frequency(df: DataFrame, *cols: str) -> DataFrame:
    """How often each value occurs, the most frequent first; null is a value."""
    return df.groupBy(*cols).agg(F.count("*").alias("n")).orderBy(F.desc("n"), *cols)


def populated(df: DataFrame, cols: tuple[str, ...], x: str, y: str) -> DataFrame:
    """How many rows have each column, and how many lack a place; one row."""
    return df.agg(F.count("*").alias("n_rows"), *(F.count(c).alias(f"n_{c}") for c in cols), F.count_if(F.col(x).isNull() | F.col(y).isNull()).alias("n_missing_geometry"))


def extent(vertices: DataFrame, lon: str = "lon", lat: str = "lat") -> DataFrame:
    """(w, s, e, n, n_vertices); one row."""
    return vertices.agg(F.min(lon).alias("w"), F.min(lat).alias("s"), F.max(lon).alias("e"), F.max(lat).alias("n"), F.count("*").alias("n_vertices"))


#: Metres in a degree of latitude, and of longitude at the equator.
METRES_LAT, METRES_LON = 110574.0, 111320.0


def buffered(box: DataFrame, metres: float = 500.0) -> DataFrame:
    """An extent grown by metres on each side."""
    dy, dx = F.lit(metres / METRES_LAT), F.lit(metres) / (F.cos(F.radians((F.col("s") + F.col("n")) / 2)) * METRES_LON)
    return box.select((F.col("w") - dx).alias("w"), (F.col("s") - dy).alias("s"), (F.col("e") + dx).alias("e"), (F.col("n") + dy).alias("n"))
