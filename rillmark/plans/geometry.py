"""Queries on polylines, projections and landed features, with their SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import geo
from ..operators import lines as G
from ..operators import summary as S
from ..sources import landed as A
from ..sources.fixtures import ctes, table, view
from ..sources.store import scratch
from ._register import Register

query = Register()
QUERIES, ORACLES = query.queries, query.oracles


V = f"with {ctes('fx_vertices')}"
DIST = "sqrt(({x})*({x})+({y})*({y}))*6371008.8e0"


def dist(lon1: str, lat1: str, lon2: str, lat2: str) -> str:
    return DIST.format(x=f"radians({lon2}-{lon1})*cos(radians(({lat1}+{lat2})/2))", y=f"radians({lat2}-{lat1})")


CUM = f"""{V}, st as (select *, coalesce({dist("lag(lon) over w", "lag(lat) over w", "lon", "lat")},0e0) as step from fx_vertices window w as (partition by oid order by vertex_index)),
cum as (select *, sum(step) over (partition by oid order by vertex_index) as d from st),
ln as (select oid, list({{'lon': lon, 'lat': lat, 'd': d}} order by vertex_index) as p, max(d) as len from cum group by oid)"""


def at(t: str) -> str:
    """SQL for the point of path p at distance t, as fields lon and lat of a struct."""
    i = f"list_position(list_transform(p[2:], lambda v: v.d >= {t}), true)"
    f = f"(case when p[{i}+1].d=p[{i}].d then 0e0 else ({t}-p[{i}].d)/(p[{i}+1].d-p[{i}].d) end)"
    inner = ", ".join(f"'{c}': p[{i}].{c}+{f}*(p[{i}+1].{c}-p[{i}].{c})" for c in ("lon", "lat"))
    return f"case when {t}<=0 then {{'lon': p[1].lon, 'lat': p[1].lat}} when {t}>=len then {{'lon': p[-1].lon, 'lat': p[-1].lat}} else {{{inner}}} end"


def utm(lon: str, lat: str) -> tuple[str, str]:
    s, l = f"sin(radians({lat}))", f"radians({lon}+123e0)"
    t = f"sinh(atanh({s})-{geo.ECC!r}*atanh({geo.ECC!r}*{s}))"
    xi, eta = f"atan2({t},cos({l}))", f"atanh(sin({l})/sqrt(1+({t})*({t})))"
    e = "+".join([eta, *(f"{a!r}*cos({2 * j}*{xi})*sinh({2 * j}*{eta})" for j, a in enumerate(geo.ALPHA, 1))])
    n = "+".join([xi, *(f"{a!r}*sin({2 * j}*{xi})*cosh({2 * j}*{eta})" for j, a in enumerate(geo.ALPHA, 1))])
    k = geo.SCALE * geo.RECTIFYING
    return f"(500000e0+{k!r}*({e}))", f"({k!r}*({n}))"


def lonlat(e: str, n: str) -> tuple[str, str]:
    k = geo.SCALE * geo.RECTIFYING
    x, y = f"(({n})/{k!r})", f"((({e})-500000e0)/{k!r})"
    xi = "(" + x + "".join(f"-({b!r})*sin({2 * j}*{x})*cosh({2 * j}*{y})" for j, b in enumerate(geo.BETA, 1)) + ")"
    eta = "(" + y + "".join(f"-({b!r})*cos({2 * j}*{x})*sinh({2 * j}*{y})" for j, b in enumerate(geo.BETA, 1)) + ")"
    chi = f"asin(sin({xi})/cosh({eta}))"
    lat = chi + "".join(f"+({d!r})*sin({2 * j}*{chi})" for j, d in enumerate(geo.DELTA, 1))
    return f"(degrees(atan2(sinh({eta}),cos({xi})))-123e0)", f"degrees({lat})"


def mercator(lon: str, lat: str) -> tuple[str, str]:
    return f"(radians({lon})*6378137e0)", f"(ln(tan(pi()/4+radians({lat})/2))*6378137e0)"


def _r(*cols, k=3):
    return [F.bround(c, k).alias(n) for n, c in cols]


@query(f"{V} select oid, vertex_index, round_even({dist('lag(lon) over w', 'lag(lat) over w', 'lon', 'lat')},4) as step_m from fx_vertices window w as (partition by oid order by vertex_index)")
def g1_step_distance(spark, sf):
    w = Window.partitionBy("oid").orderBy("vertex_index")
    step = geo.ground_distance(F.lag("lon").over(w), F.lag("lat").over(w), F.col("lon"), F.col("lat"))
    return view(spark, sf, "fx_vertices").select("oid", "vertex_index", F.bround(step, 4).alias("step_m"))


@query(f"{CUM} select oid, vertex_index, round_even(d,4) as d from cum")
def g2_cumulative(spark, sf):
    return G.cumulative(view(spark, sf, "fx_vertices")).select("oid", "vertex_index", F.bround("dist_along_m", 4).alias("d"))


@query(f"{CUM}, t as (select oid, p, len, unnest([-5e0, 0e0, 33e0, 150e0, len/3, len, len+9]) as t from ln), q as (select oid, t, {at('t')} as x from t) select oid, round_even(t,4) as t, round_even(x.lon,7) as lon, round_even(x.lat,7) as lat from q")
def g3_point_at(spark, sf):
    v = view(spark, sf, "fx_vertices")
    length = G.cumulative(v).groupBy("oid").agg(F.max("dist_along_m").alias("len"))
    t = length.select("oid", F.explode(F.array(F.lit(-5.0), F.lit(0.0), F.lit(33.0), F.lit(150.0), F.col("len") / 3, F.col("len"), F.col("len") + 9)).alias("t"))
    p = G.points_at(v, t).withColumn("x", F.col("pt"))
    return p.select("oid", *_r(("t", F.col("t")), k=4), *_r(("lon", F.col("x.lon")), ("lat", F.col("x.lat")), k=7))


@query(f"""{CUM}, n as (select *, cast(greatest(1, round_even(len/10,0)) as int) as n from ln), q as (select oid, p, len, n, unnest(range(0, n+1)) as i from n), z as (select oid, cast(i as int) as point_index, len*i/n as t, p, len from q),
x as (select oid, point_index, t, {at('t')} as x from z) select oid, point_index, round_even(x.lat,7) as lat, round_even(x.lon,7) as lon, round_even(t,2) as dist_along_m from x""")
def g4_resample(spark, sf):
    return G.resample(view(spark, sf, "fx_vertices"), 10.0)


BEAR = "fmod(degrees(atan2({x},{y}))+360,360)"


@query(f"""{CUM}, x as (select oid, p, len, {at('len/2')} as m from ln) select oid, round_even(p[1].lat,7) as start_lat, round_even(p[1].lon,7) as start_lon, round_even(p[-1].lat,7) as end_lat, round_even(p[-1].lon,7) as end_lon,
 round_even(m.lat,7) as mid_lat, round_even(m.lon,7) as mid_lon, round_even(len,2) as length_m, cast(len(p) as int) as n_vertices, round_even({BEAR.format(x="(p[-1].lon-p[1].lon)*cos(radians((p[1].lat+p[-1].lat)/2))", y="p[-1].lat-p[1].lat")},1) as bearing_deg from x""".replace("len(p)", "length(p)"))
def g5_endpoints(spark, sf):
    return G.endpoints(view(spark, sf, "fx_vertices"))


@query(f"{CUM} select oid, vertex_index, round_even(lat,7) as lat, round_even(lon,7) as lon, round_even(d,2) as dist_along_m from cum")
def g6_vertices(spark, sf):
    v = G.as_lines(view(spark, sf, "fx_vertices")).select("oid", F.explode("path").alias("v"))
    return v.select("oid", F.col("v.i").alias("vertex_index"), *_r(("lat", F.col("v.lat")), ("lon", F.col("v.lon")), k=7), F.bround("v.d", 2).alias("dist_along_m"))


@query("select p_partkey, concat(replace(case when x=floor(x) then cast(cast(x as bigint) as varchar) else cast(x as varchar) end,'.','p'),'m') as label from (select p_partkey, p_size/4e0 as x from part)")
def g8_label(spark, sf):
    return table(spark, sf, "part").select("p_partkey", geo.spacing_label(F.col("p_size") / 4).alias("label"))


GC = "fmod(degrees(atan2(sin(radians(lon2-lon))*cos(radians(lat2)),cos(radians(lat))*sin(radians(lat2))-sin(radians(lat))*cos(radians(lat2))*cos(radians(lon2-lon))))+360,360)"


@query(f"{V}, n as (select *, lead(lon) over w as lon2, lead(lat) over w as lat2 from fx_vertices window w as (partition by oid order by vertex_index)) select oid, vertex_index, round_even({GC},4) as bearing from n where lon2 is not null")
def g9_bearing(spark, sf):
    w = Window.partitionBy("oid").orderBy("vertex_index")
    n = view(spark, sf, "fx_vertices").withColumn("lon2", F.lead("lon").over(w)).withColumn("lat2", F.lead("lat").over(w)).where("lon2 is not null")
    return n.select("oid", "vertex_index", F.bround(geo.great_circle_bearing(F.col("lat"), F.col("lon"), F.col("lat2"), F.col("lon2")), 4).alias("bearing"))


@query(f"""with {ctes("fx_points")}, n as (select oid, point_index, coalesce(lead(easting) over w - easting, easting - lag(easting) over w) as de, coalesce(lead(northing) over w - northing, northing - lag(northing) over w) as dn from fx_points window w as (partition by oid order by point_index))
select oid, point_index, round_even({BEAR.format(x="de", y="dn")},4) as bearing_deg from n""")
def g10_heading(spark, sf):
    return G.step_heading(view(spark, sf, "fx_points")).select("oid", "point_index", F.bround("bearing_deg", 4).alias("bearing_deg"))


@query(f"""with {ctes("fx_points")}, k as (select oid, dist_along_m as t, easting, northing from fx_points), w as (select oid, t from (select distinct oid from fx_points), (select unnest([-3e0, 0e0, 125e-1, 50e0, 9975e-2, 100e0, 120e0]) as t)),
x as (select w.oid, w.t, max(k.t) filter (k.t<=w.t) as a, min(k.t) filter (k.t>=w.t) as b from w join k on w.oid=k.oid group by all)
select x.oid, x.t, round_even(case when ka.easting is null then kb.easting when kb.easting is null or a=b then ka.easting else ka.easting+(x.t-a)/(b-a)*(kb.easting-ka.easting) end,6) as easting,
 round_even(case when ka.northing is null then kb.northing when kb.northing is null or a=b then ka.northing else ka.northing+(x.t-a)/(b-a)*(kb.northing-ka.northing) end,6) as northing
from x left join k ka on ka.oid=x.oid and ka.t=a left join k kb on kb.oid=x.oid and kb.t=b""")
def g11_interp_at(spark, sf):
    k = view(spark, sf, "fx_points").select("oid", F.col("dist_along_m").alias("t"), "easting", "northing")
    w = k.select("oid").distinct().withColumn("t", F.explode(F.array(*map(F.lit, (-3.0, 0.0, 12.5, 50.0, 99.75, 100.0, 120.0)))))
    return G.value_at(k, w, "oid", "t", "easting", "northing").select("oid", "t", *_r(("easting", F.col("easting")), ("northing", F.col("northing")), k=6))


@query(f"{V} select oid, vertex_index, round_even({utm('lon', 'lat')[0]},3) as easting, round_even({utm('lon', 'lat')[1]},3) as northing from fx_vertices")
def p1_to_utm(spark, sf):
    e, n = geo.to_utm(F.col("lon"), F.col("lat"))
    return view(spark, sf, "fx_vertices").select("oid", "vertex_index", *_r(("easting", e), ("northing", n)))


P = f"with {ctes('fx_points')}"


@query(f"{P} select oid, point_index, round_even({lonlat('easting', 'northing')[0]},8) as lon, round_even({lonlat('easting', 'northing')[1]},8) as lat from fx_points")
def p2_from_utm(spark, sf):
    lon, lat = geo.from_utm(F.col("easting"), F.col("northing"))
    return view(spark, sf, "fx_points").select("oid", "point_index", *_r(("lon", lon), ("lat", lat), k=8))


@query(f"{V} select oid, vertex_index, round_even({mercator('lon', 'lat')[0]},3) as mx, round_even({mercator('lon', 'lat')[1]},3) as my from fx_vertices")
def p3_to_mercator(spark, sf):
    mx, my = geo.to_mercator(F.col("lon"), F.col("lat"))
    return view(spark, sf, "fx_vertices").select("oid", "vertex_index", *_r(("mx", mx), ("my", my)))


@query(f"{P}, g as (select oid, point_index, {lonlat('easting', 'northing')[0]} as lon, {lonlat('easting', 'northing')[1]} as lat from fx_points) select oid, point_index, round_even({mercator('lon', 'lat')[0]},2) as mx, round_even({mercator('lon', 'lat')[1]},2) as my from g")
def p4_utm_to_mercator(spark, sf):
    mx, my = geo.utm_to_mercator(F.col("easting"), F.col("northing"))
    return view(spark, sf, "fx_points").select("oid", "point_index", *_r(("mx", mx), ("my", my), k=2))


@query(f"{V}, m as (select oid, vertex_index, {mercator('lon', 'lat')[0]} as mx, {mercator('lon', 'lat')[1]} as my from fx_vertices) select oid, vertex_index, round_even(degrees(mx/6378137e0),7) as lon, round_even(degrees(2*atan(exp(my/6378137e0))-pi()/2),7) as lat from m")
def p5_from_mercator(spark, sf):
    mx, my = geo.to_mercator(F.col("lon"), F.col("lat"))
    lon, lat = geo.from_mercator(F.col("mx"), F.col("my"))
    return view(spark, sf, "fx_vertices").select("oid", "vertex_index", mx.alias("mx"), my.alias("my")).select("oid", "vertex_index", *_r(("lon", lon), ("lat", lat), k=7))


# ---- landed features, made from the tables as JSON text and read again ----


def _geojson(spark, sf):
    """Every customer a feature: polylines as LineString, one in seven a Point, one in eleven without geometry."""
    v = view(spark, sf, "fx_vertices").groupBy("oid").agg(F.array_sort(F.collect_list(F.struct("vertex_index", F.array("lon", "lat").alias("c")))).alias("v"))
    kind = F.when(F.col("oid") % 7 == 3, "Point").otherwise("LineString")
    geometry = F.when(F.col("oid") % 11 != 5, F.struct(kind.alias("type"), F.transform("v", lambda x: x["c"]).alias("coordinates")))
    feature = F.struct(F.lit("Feature").alias("type"), F.create_map(F.lit("OBJECTID"), F.col("oid").cast("string"), F.lit("FunctionalClass"), F.concat(F.lit("class "), (F.col("oid") % 5).cast("string"))).alias("properties"), geometry.alias("geometry"))
    return v.select("oid", F.concat(F.when(F.col("oid") % 13 == 0, "﻿").otherwise(""), F.to_json(feature)).alias("json"))


KIND = "case when oid%11=5 then null when oid%7=3 then 'Point' else 'LineString' end"


@query(f"{V}, k as (select oid, {KIND} as kind, count(*) as n, min(lon) as w from fx_vertices group by oid) select oid, concat('class ', oid%5) as cls, cast(n as int) as n_vertices, w as min_lon from k where kind='LineString'")
def a1_geojson_lines(spark, sf):
    f = A.geojson_lines(_geojson(spark, sf))
    return f.select("oid", F.col("properties")["FunctionalClass"].alias("cls"), F.size("coords").alias("n_vertices"), F.array_min(F.transform("coords", lambda c: c["lon"])).alias("min_lon"))


@query(f"{V}, k as (select oid, {KIND} as kind, count(*) as n, min(lon) as w from fx_vertices group by oid) select oid, concat('class ', oid%5) as cls, cast(n as int) as n_vertices, w as min_lon from k where kind='LineString'")
def a1_feature_collections(spark, sf):
    many = _geojson(spark, sf).groupBy((F.col("oid") % 40).alias("doc")).agg(F.collect_list(F.regexp_replace("json", "^\ufeff", "")).alias("f"))
    documents = many.select(F.concat(F.lit('\ufeff{"type":"FeatureCollection","features":['), F.array_join("f", ","), F.lit("]}")).alias("json"))
    f = A.geojson_lines(documents)
    return f.select("oid", F.col("properties")["FunctionalClass"].alias("cls"), F.size("coords").alias("n_vertices"), F.array_min(F.transform("coords", lambda c: c["lon"])).alias("min_lon"))


@query(f"""{V}, k as (select oid, {KIND} as kind from fx_vertices group by oid) select cast(oid as varchar) as "OBJECTID", null::varchar as "FullStreetName", null::varchar as "StreetName", null::varchar as "StreetType", null::varchar as "PrefixDir", null::varchar as "SuffixDir",
 concat('class ', oid%5) as "FunctionalClass", null::varchar as "RoadType", null::varchar as "GlobalID" from k where kind='LineString'""")
def g7_full_attributes(spark, sf):
    return A.with_attributes(A.geojson_lines(_geojson(spark, sf)), A.FULL_ATTRIBUTES).select(*A.FULL_ATTRIBUTES)


@query(f"{V}, k as (select distinct oid from fx_vertices) select oid, case when oid%10 in (1,2,3) then 'rejected' else 'accepted' end as status from k")
def a1_rejects(spark, sf):
    """One line in ten cut off, one in ten empty, one in ten with text in the place of numbers."""
    cut = F.when(F.col("oid") % 10 == 1, F.expr("substring(json, 1, length(json) - 9)")).when(F.col("oid") % 10 == 2, F.lit("")).otherwise(F.regexp_replace("json", "\\[\\[-?[0-9.]+", '[["west"'))
    planted = _geojson(spark, sf).withColumn("json", F.when(F.col("oid") % 10 <= 3, F.when(F.col("oid") % 10 > 0, cut).otherwise(F.col("json"))).otherwise(F.col("json")))
    planted = planted.withColumn("json", F.when((F.col("oid") % 10 == 3) & ~F.col("json").contains("west"), "{").otherwise(F.col("json")))  # those without geometry
    good, bad = A.checked_json(planted, A.LINE_FEATURE)
    return good.select("oid", F.lit("accepted").alias("status")).unionByName(bad.select("oid", F.lit("rejected").alias("status")))


@query("select p_partkey, case when p_partkey%10 in (3,4,5) then null else p_size end as size, p_partkey%10 in (3,4,5) as rejected from part")
def a4_csv_rejects(spark, sf):
    """Lines of CSV, one in ten with a word for a number, one in ten a field short, one in ten with one too many."""
    size = F.when(F.col("p_partkey") % 10 == 3, "x1").otherwise(F.col("p_size").cast("string"))
    line = F.concat_ws(",", F.col("p_partkey").cast("string"), F.when(F.col("p_partkey") % 10 != 4, size), F.concat(F.lit('"'), "p_name", F.lit(', "')), F.when(F.col("p_partkey") % 10 == 5, "more"))
    good, bad = A.checked_csv(table(spark, sf, "part").select("p_partkey", line.alias("value")), "part long, size int, name string")
    return good.select("p_partkey", "f.size", F.lit(False).alias("rejected")).unionByName(bad.select("p_partkey", F.lit(None).cast("int").alias("size"), F.lit(True).alias("rejected")))


def _esri(spark, sf):
    i = view(spark, sf, "fx_inlets")
    geometry = F.when(F.col("inlet_id") % 9 != 4, F.struct("x", "y"))
    attributes = F.create_map(F.lit("OBJECTID"), F.col("inlet_id").cast("string"), F.lit("TopOfGrate"), F.col("top_of_grate_ft").cast("string"), F.lit("TypeDescription"), F.col("type_description"))
    return i.select("inlet_id", F.to_json(F.struct(attributes.alias("attributes"), geometry.alias("geometry"))).alias("json"))


@query(f"with {ctes('fx_inlets')} select inlet_id as \"OBJECTID\", top_of_grate_ft as \"TopOfGrate\", type_description as \"TypeDescription\", case when inlet_id%9<>4 then x end as lon, case when inlet_id%9<>4 then y end as lat from fx_inlets")
def a2_esri_flatten(spark, sf):
    return A.esri_points(_esri(spark, sf), {"OBJECTID": "long", "TopOfGrate": "double", "TypeDescription": "string"})


def _pages(spark, sf):
    """Inlets landed in pages of 50 features for each of three sources; the last page of a source has no flag, one in 17 fails."""
    i = _esri(spark, sf).withColumn("source", F.concat(F.lit("s"), (F.col("inlet_id") % 3).cast("string"))).withColumn("page", F.floor(F.col("inlet_id") / 150))
    last = F.max("page").over(Window.partitionBy("source"))
    i = i.withColumn("more", F.col("page") < last)
    p = i.groupBy("source", "page", "more").agg(F.sort_array(F.collect_list("json")).alias("features"))
    flag = F.when(F.col("page") % 2 == 0, F.format_string('"exceededTransferLimit":%s', F.col("more").cast("string"))).otherwise(F.format_string('"properties":{"exceededTransferLimit":%s}', F.col("more").cast("string")))
    ok = F.concat(F.lit('{"features":['), F.array_join("features", ","), F.lit("],"), flag, F.lit("}"))
    return p.select("source", (F.col("page") * 50).alias("page_offset"), F.when(F.col("page") % 17 == 11, F.lit('{"error":{"code":500,"message":"failed"}}')).otherwise(ok).alias("json"))


@query(f"""with {ctes("fx_inlets")}, i as (select concat('s', inlet_id%3) as source, cast(floor(inlet_id/150e0) as bigint) as page from fx_inlets), c as (select source, page, count(*) as n, page < max(page) over (partition by source) as m from i group by source, page),
e as (select source, page*50 as page_offset, case when page%17=11 then 0 else n end as n_features, page%17<>11 and m as more, page%17=11 as failed from c),
x as (select *, cast(coalesce(sum(n_features) over (partition by source order by page_offset rows between unbounded preceding and 1 preceding),0) as bigint) as expected_offset from e)
select *, page_offset=expected_offset as contiguous from x""")
def a3_page_audit(spark, sf):
    return A.audit_pages(_pages(spark, sf))


_ITEMS = "with i as (select p_partkey as pos, concat(p_name,' ',p_type) as title, case when p_partkey%23=0 then '' else concat('http://x/',p_name,'/',p_partkey%400) end as url, case when p_partkey%5=0 then null else cast(p_retailprice*100 as bigint) end as bytes from part)"


@query(f"{_ITEMS} select count(*) as tiles, cast(sum(coalesce(bytes,0)) as bigint) as bytes from (select *, row_number() over (partition by url order by pos) as n from i where url<>'' and contains(title,'ring')) where n=1")
def a7_total(spark, sf):
    return A.catalogue_total(a7_tile_catalogue(spark, sf))


@query("""with i as (select p_partkey as pos, concat(p_name,' ',p_type) as title, case when p_partkey%23=0 then '' else concat('http://x/',p_name,'/',p_partkey%400) end as url, case when p_partkey%5=0 then null else cast(p_retailprice*100 as bigint) end as bytes from part)
select pos, title, url, coalesce(bytes,0) as bytes from (select *, row_number() over (partition by url order by pos) as n from i where url<>'' and contains(title,'ring')) where n=1""")
def a7_tile_catalogue(spark, sf):
    p = table(spark, sf, "part")
    size = F.when(F.col("p_partkey") % 5 != 0, F.rint(F.col("p_retailprice") * 100).cast("long"))
    url = F.when(F.col("p_partkey") % 23 == 0, "").otherwise(F.concat(F.lit("http://x/"), "p_name", F.lit("/"), (F.col("p_partkey") % 400).cast("string")))
    return A.catalogue_tiles(p.select(F.col("p_partkey").alias("pos"), F.concat("p_name", F.lit(" "), "p_type").alias("title"), url.alias("url"), size.alias("bytes")), "ring").select("pos", "title", "url", "bytes")


@query(f"""with {ctes("fx_inlets")} select concat('{{"type":"Feature","properties":{{"inlet_id":', inlet_id, '}},"geometry":{{"type":"Point","coordinates":[', cast(inlet_id%100 as double), ',', cast(inlet_id%7 as double), ']}}}}') as feature from fx_inlets where inlet_id%9<>4""")
def k3_geojson_features(spark, sf):
    i = view(spark, sf, "fx_inlets").select("inlet_id", F.when(F.col("inlet_id") % 9 != 4, (F.col("inlet_id") % 100).cast("double")).alias("lon"), (F.col("inlet_id") % 7).cast("double").alias("lat"))
    return A.geojson_features(i, "lon", "lat", "inlet_id")


@query(f"with {ctes('fx_cells')} select count(*) as rows, 'EPSG:26910' as crs, (select string_agg(distinct dem_tile, ',' order by dem_tile) from fx_cells) as tiles, 'one row a cell' as notes, 'metres' as elev from fx_cells")
def k4_run_meta(spark, sf):
    m = A.run_metadata(view(spark, sf, "fx_cells"), "EPSG:26910", notes=("one row a cell",), columns={"elev": "metres"})
    return m.select("rows", "crs", F.array_join("tiles", ",").alias("tiles"), F.array_join("notes", ";").alias("notes"), F.col("columns")["elev"].alias("elev"))


def _new_path(spark, name):
    """A new folder for files that a query writes and reads back."""
    return f"{scratch(spark) or spark.conf.get('spark.sql.warehouse.dir')}/{name}-{uuid.uuid4().hex}"


@query(f"with {ctes('fx_inlets')} select inlet_id, x, top_of_grate_ft, type_description from fx_inlets")
def k1_csv_round_trip(spark, sf):
    path = _new_path(spark, "csv")
    A.write_csv(view(spark, sf, "fx_inlets"), path)
    schema = "inlet_id long, s int, x double, y double, top_of_grate_ft double, invert_ft double, type_description string"
    return A.read_csv(spark, path, schema, ("inlet_id", "x", "top_of_grate_ft", "type_description"))


@query(f"with {ctes('fx_points')} select oid, point_index, street, elev_m from fx_points")
def k2_parquet_round_trip(spark, sf):
    path, p = _new_path(spark, "parquet"), view(spark, sf, "fx_points")
    A.write_parquet(p, path)
    return A.read_parquet(spark, path, ("oid", "point_index", "street", "elev_m"), p.schema.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " "))


@query(f"""with {ctes('fx_points')}, i as (select street, count(*) as n_points from fx_points group by street)
select (select count(*) from fx_points) as points, (select count(*) from i) as streets, (select cast(sum(n_points) as bigint) from i) as points_of_streets, (select count(*) from fx_points) as told, 'ground, in metres' as elev""")
def k_run_bundle(spark, sf):
    """Points, index and sidecar of a run, written together and read back."""
    path, p = _new_path(spark, "run"), view(spark, sf, "fx_points")
    A.write_run(p, p.groupBy("street").agg(F.count("*").alias("n_points")), A.run_metadata(p.withColumn("dem_tile", F.lit("t")), "EPSG:26910", columns={"elev_m": "ground, in metres"}), path)
    points = A.read_parquet(spark, f"{path}/points", ("oid",)).agg(F.count("*").alias("points"))
    index = A.read_csv(spark, f"{path}/index", "street string, n_points long").agg(F.count("*").alias("streets"), F.sum("n_points").alias("points_of_streets"))
    told = spark.read.schema("rows long, columns map<string,string>").json(f"{path}/metadata").select(F.col("rows").alias("told"), F.col("columns")["elev_m"].alias("elev"))
    return points.crossJoin(index).crossJoin(told)  # one row each


@query(f"{V}, k as (select distinct oid, {KIND} as kind from fx_vertices) select kind, count(*) as n, count(*) filter (kind is distinct from 'LineString') as n_stray from k group by kind")
def q1_geom_types(spark, sf):
    return A.geometry_types(_geojson(spark, sf))


@query(f"with {ctes('fx_inlets')} select type_description, count(*) as n from fx_inlets group by all")
def q2_value_freq(spark, sf):
    return S.frequency(view(spark, sf, "fx_inlets"), "type_description")


@query("select p_type, p_brand, count(*) as n from part group by all")
def q3_pair_freq(spark, sf):
    return S.frequency(table(spark, sf, "part"), "p_type", "p_brand")


@query(f"with {ctes('fx_inlets')} select count(*) as n_rows, count(top_of_grate_ft) as n_top_of_grate_ft, count(invert_ft) as n_invert_ft, count(type_description) as n_type_description, count(*) filter (x is null or y is null) as n_missing_geometry from fx_inlets")
def q4_populated(spark, sf):
    return S.populated(view(spark, sf, "fx_inlets"), ("top_of_grate_ft", "invert_ft", "type_description"), "x", "y")


@query(f"{V} select min(lon) as w, min(lat) as s, max(lon) as e, max(lat) as n, count(*) as n_vertices from fx_vertices")
def q5_extent(spark, sf):
    return S.extent(view(spark, sf, "fx_vertices"))


@query(f"{V}, b as (select min(lon) as w, min(lat) as s, max(lon) as e, max(lat) as n from fx_vertices), d as (select *, 500/110574e0 as dy, 500/(111320e0*cos(radians((s+n)/2))) as dx from b) select round_even(w-dx,7) as w, round_even(s-dy,7) as s, round_even(e+dx,7) as e, round_even(n+dy,7) as n from d")
def q6_buffered_extent(spark, sf):
    b = S.buffered(S.extent(view(spark, sf, "fx_vertices")), 500.0)
    return b.select(*_r(*((c, F.col(c)) for c in "wsen"), k=7))
