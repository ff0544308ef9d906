"""Landed feature pages, GeoJSON and catalogues: JSON text rows in, typed rows out, and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

LINE_FEATURE = "type string, properties map<string,string>, geometry struct<type:string,coordinates:array<array<double>>>"
POINT_FEATURE = "attributes map<string,string>, geometry struct<x:double,y:double>"
PAGE = "features array<string>, exceededTransferLimit boolean, properties struct<exceededTransferLimit:boolean>, error struct<code:int,message:string>"


def _clean(json: Column) -> Column:
    return F.regexp_replace(json, "^﻿", "")


_BAD = "_corrupt_record"


def _split(rows: DataFrame, parsed: Column) -> tuple[DataFrame, DataFrame]:
    f = rows.withColumn("f", parsed)
    bad = F.col("f").isNull() | F.col("f")[_BAD].isNotNull()
    return f.where(~bad).withColumn("f", F.col("f").dropFields(_BAD)), f.where(bad).drop("f")


def checked_json(rows: DataFrame, schema: str, json: str = "json") -> tuple[DataFrame, DataFrame]:
    """(rows with f, the record read with the schema; rows as they came whose text is null, empty, no JSON or not of the schema).

    The readers below give nulls for such rows; a load that has to account for each record takes both tables.
    """
    return _split(rows, F.from_json(_clean(F.col(json)), f"{schema}, {_BAD} string", {"columnNameOfCorruptRecord": _BAD}))


def checked_csv(lines: DataFrame, schema: str, line: str = "value", header: str | None = None) -> tuple[DataFrame, DataFrame]:
    """The same for lines of CSV, one record a line: too few or too many fields and values that are not of their type are rejected.

    header: a line that is left out of both.
    """
    rows = lines if header is None else lines.where(~F.col(line).eqNullSafe(header))
    full, blank = F.from_csv(line, f"{schema}, {_BAD} string", {"columnNameOfCorruptRecord": _BAD}), F.trim(line) == ""
    return _split(rows, F.when(~blank, full))


def write_rejects(rejects: DataFrame, path: str, stage: str) -> None:
    """Rejected rows as they came, with the stage that rejected them, beside those of other stages."""
    rejects.withColumn("stage", F.lit(stage)).write.mode("append").partitionBy("stage").json(path)


def geometry_types(rows: DataFrame, json: str = "json", wanted: str = "LineString") -> DataFrame:
    """(kind, n, n_stray): features by type of geometry, null where they have none, and how many are not of the wanted type."""
    kinds = features_of(rows, json).select(F.from_json("json", LINE_FEATURE)["geometry"]["type"].alias("kind"))
    return kinds.groupBy("kind").agg(F.count("*").alias("n"), F.count_if(~F.col("kind").eqNullSafe(wanted)).alias("n_stray"))


def read_json_documents(spark: SparkSession, path: str) -> DataFrame:
    """(json): the text of each file of a folder, one document a file."""
    return spark.read.text(path, wholetext=True).select(F.col("value").alias("json"))


def features_of(documents: DataFrame, json: str = "json") -> DataFrame:
    """(json): one row a feature; a FeatureCollection gives all of its features, any other document itself."""
    d = documents.select(_clean(F.col(json)).alias("json"))
    many = F.from_json("json", "type string, features array<string>")
    return d.select("json", many.alias("m")).select(F.explode(F.when(F.col("m.type") == "FeatureCollection", F.coalesce("m.features", F.array().cast("array<string>"))).otherwise(F.array("json"))).alias("json"))


def geojson_lines(rows: DataFrame, json: str = "json") -> DataFrame:
    """(oid, properties, coords) of the LineString features of JSON text rows, each a feature or a FeatureCollection; a byte-order mark is tolerated."""
    f = features_of(rows, json).select(F.from_json("json", LINE_FEATURE).alias("f"))
    return f.where("f.geometry.type = 'LineString'").select(
        F.col("f.properties")["OBJECTID"].cast("long").alias("oid"),
        F.col("f.properties").alias("properties"),
        F.transform("f.geometry.coordinates", lambda c: F.struct(c[0].alias("lon"), c[1].alias("lat"))).alias("coords"),
    )


#: The attributes of a centerline, all of them and those that points carry.
FULL_ATTRIBUTES = ("OBJECTID", "FullStreetName", "StreetName", "StreetType", "PrefixDir", "SuffixDir", "FunctionalClass", "RoadType", "GlobalID")
SLIM_ATTRIBUTES = ("OBJECTID", "FullStreetName")


def with_attributes(lines: DataFrame, names: tuple[str, ...] = SLIM_ATTRIBUTES) -> DataFrame:
    """lines with the named attributes as columns instead of the map of all."""
    return lines.select("*", *(F.col("properties")[n].alias(n) for n in names)).drop("properties")


def read_csv(spark: SparkSession, path: str, schema: str, columns: tuple[str, ...] = ()) -> DataFrame:
    """A CSV file with a header and the schema given, nothing inferred; only the columns, if any are named."""
    df = spark.read.option("header", True).schema(schema).csv(path)
    return df.select(*columns) if columns else df


def read_parquet(spark: SparkSession, path: str, columns: tuple[str, ...] = (), schema: str | None = None) -> DataFrame:
    """A Parquet table, with the schema if it is given; only the columns, if any are named, reach the scan."""
    reader = spark.read.schema(schema) if schema else spark.read
    df = reader.parquet(path)
    return df.select(*columns) if columns else df


def esri_points(rows: DataFrame, fields: dict[str, str], json: str = "json") -> DataFrame:
    """The named attributes with lon and lat of Esri point features; a missing geometry gives nulls."""
    f = rows.select(F.from_json(_clean(F.col(json)), POINT_FEATURE).alias("f"))
    return f.select(*(F.col("f.attributes")[n].cast(t).alias(n) for n, t in fields.items()), F.col("f.geometry.x").alias("lon"), F.col("f.geometry.y").alias("lat"))


def audit_pages(pages: DataFrame, offset: str = "page_offset", json: str = "json", source: str = "source") -> DataFrame:
    """One row a page: features, whether more follow, whether it starts where the one before ended, whether it is an error."""
    p = pages.select(source, offset, F.from_json(_clean(F.col(json)), PAGE).alias("p"))
    p = p.select(
        source, offset,
        F.coalesce(F.size("p.features"), F.lit(0)).cast("long").alias("n_features"),
        F.coalesce("p.exceededTransferLimit", "p.properties.exceededTransferLimit", F.lit(False)).alias("more"),
        F.col("p.error").isNotNull().alias("failed"),
    )
    before = Window.partitionBy(source).orderBy(offset).rowsBetween(Window.unboundedPreceding, -1)
    return p.withColumn("expected_offset", F.coalesce(F.sum("n_features").over(before), F.lit(0))).withColumn("contiguous", F.col(offset) == F.col("expected_offset"))


def pages_features(pages: DataFrame, offset: str = "page_offset", json: str = "json") -> DataFrame:
    """The features of all pages without an error, with their place."""
    p = pages.select(offset, F.from_json(_clean(F.col(json)), PAGE).alias("p")).where("p.error is null")
    return p.select(offset, F.posexplode("p.features").alias("pos", "json"))


def catalogue_tiles(items: DataFrame, project: str = "") -> DataFrame:
    """The first item of each URL whose title holds the project name ("" takes all), with sizes null as 0."""
    chosen = items.where(F.col("url").isNotNull() & (F.col("url") != ""))
    if project:
        chosen = chosen.where(F.coalesce(F.col("title"), F.lit("")).contains(project))
    first = Window.partitionBy("url").orderBy("pos")
    return chosen.withColumn("_n", F.row_number().over(first)).where("_n = 1").drop("_n").withColumn("bytes", F.coalesce("bytes", F.lit(0)))


def catalogue_total(tiles: DataFrame) -> DataFrame:
    """(tiles, bytes) of chosen tiles; one row."""
    return tiles.agg(F.count("*").alias("tiles"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"))


def run_metadata(points: DataFrame, crs: str, tile: str = "dem_tile", notes: tuple[str, ...] = (), columns: dict[str, str] | None = None, stamp: bool = False) -> DataFrame:
    """One row that describes a table of points: rows, CRS, tiles used, notes, what its columns hold, and when, in UTC."""
    documented = F.create_map(*(F.lit(x) for pair in (columns or {}).items() for x in pair)) if columns else F.create_map().cast("map<string,string>")
    row = points.agg(F.count("*").alias("rows"), F.sort_array(F.collect_set(tile)).alias("tiles"))  # tiles are few
    row = row.withColumn("crs", F.lit(crs)).withColumn("notes", F.array(*map(F.lit, notes)).cast("array<string>")).withColumn("columns", documented)
    return row.withColumn("written_utc", F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'")) if stamp else row


def write_metadata(metadata: DataFrame, path: str) -> None:
    """One JSON document, beside the table that it describes."""
    metadata.coalesce(1).write.json(path)  # one row


def geojson_features(points: DataFrame, lon: str, lat: str, *properties: str) -> DataFrame:
    """One GeoJSON Feature a row as text; rows without coordinates are left out."""
    feature = F.struct(
        F.lit("Feature").alias("type"),
        F.struct(*properties).alias("properties"),
        F.struct(F.lit("Point").alias("type"), F.array(lon, lat).alias("coordinates")).alias("geometry"),
    )
    return points.where(F.col(lon).isNotNull() & F.col(lat).isNotNull()).select(F.to_json(feature).alias("feature"))


def write_csv(df: DataFrame, path: str) -> None:
    df.write.option("header", True).csv(path)


def write_parquet(df: DataFrame, path: str) -> None:
    """A new path each time: a path that is being read cannot be overwritten."""
    df.write.option("compression", "zstd").parquet(path)


def write_run(points: DataFrame, index: DataFrame, metadata: DataFrame, path: str) -> None:
    """A whole run under a new path: the points, the street index and the sidecar that describes the points."""
    write_parquet(points, f"{path}/points")
    write_csv(index, f"{path}/index")
    write_metadata(metadata, f"{path}/metadata")
