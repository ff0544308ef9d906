"""Queries of the city overview, chart scales and flagged-cell clusters, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import geo
from ..operators import charts as V_
from ..operators import overview as O
from ..operators import summary as S
from ..operators.order import every_nth
from ..sources.fixtures import ctes, view
from ._register import Register
from .geometry import V, lonlat, mercator
from .streets import CAND, INDEX, PAIRS, SM, TWO, _index, _profile, _typed_pairs, variants

query = Register()
QUERIES, ORACLES = query.queries, query.oracles

NAMES = dict(enumerate(("Local", "Minor Collector", "Major Collector", "Alley", "Principal Arterial", "Other Freeway or Expressway", "Interstate", "Ramp")))
CLS = "case cls " + " ".join(f"when {k} then '{v}'" for k, v in NAMES.items()) + " end"
BUCKET = f"case when {CLS} in ({', '.join(repr(c) for c, _ in O.CLASSES)}) then {CLS} else '(unclassified)' end"
SEG = f"with {ctes('fx_segments')}"


def _named(df):
    """df with the class name of its code."""
    out = None
    for k, v in NAMES.items():
        out = F.when(F.col("cls") == k, v) if out is None else out.when(F.col("cls") == k, v)
    return df.withColumn("class_name", out)


def _long(spark, sf):
    """Both variants; streets whose number ends in 9 are missing from the second."""
    return variants(spark, sf).where("not (variant = 'm10' and street like '%9')")


LONG = f"{TWO}, lng as (select *, 'm25' as variant from idx union all select *, 'm10' as variant from idxb where not street like '%9')"


@query(f"{SEG} select street, coalesce(t.n_near,0) as n_near, s.oid from fx_segments s left join ({CAND}) t using (street)")
def j1_left_fill(spark, sf):
    cand = S.sample_candidates(view(spark, sf, "fx_points"), view(spark, sf, "fx_inlets"))
    return view(spark, sf, "fx_segments").select("oid", "street").join(cand, "street", "left").select("street", F.coalesce("n_near", F.lit(0)).alias("n_near"), "oid")


@query(f"{INDEX} select s.oid, s.street, n_sags, n_unserved from fx_segments s left join idx on idx.street=s.street and s.oid%4<>1")
def j2_stats_lookup(spark, sf):
    idx = _index(spark, sf).select("street", "n_sags", "n_unserved")
    seg = view(spark, sf, "fx_segments").select("oid", "street", F.when(F.col("oid") % 4 != 1, F.col("street")).alias("key"))
    return seg.join(idx.withColumnRenamed("street", "key"), "key", "left").select("oid", "street", "n_sags", "n_unserved")


@query(f"{LONG}, m as (select street from lng where variant='m10') select street, 'kept' as side from idx where street in (select street from m) union all select street, 'dropped' from idx where street not in (select street from m)")
def j3_semi_anti(spark, sf):
    a = view(spark, sf, "fx_points").select("street").distinct()
    m = _long(spark, sf).where("variant = 'm10'").select("street")
    return a.join(m, "street", "left_semi").withColumn("side", F.lit("kept")).unionByName(a.join(m, "street", "left_anti").withColumn("side", F.lit("dropped")))


@query(f"{LONG} select street from lng group by street having count(distinct variant)=2")
def j4_all_variants(spark, sf):
    return O.in_all(_long(spark, sf))


@query(f"{LONG} select street, string_agg(distinct variant, ',' order by variant) as variants from lng group by street having count(distinct variant)<2")
def j4_dropped(spark, sf):
    return O.not_in_all(_long(spark, sf))


@query(f"{SEG} select oid, {BUCKET} as cls from fx_segments")
def o1_class_bucket(spark, sf):
    return _named(view(spark, sf, "fx_segments")).select("oid", O.class_bucket(F.col("class_name")).alias("cls"))


@query(f"{V}, m as (select oid, vertex_index, round_even({mercator('lon', 'lat')[0]},3) as mx, round_even({mercator('lon', 'lat')[1]},3) as my from fx_vertices) select oid, count(*)::int as n_vertices, round_even(sum(mx*vertex_index),2) as check_x, round_even(sum(my*vertex_index),2) as check_y from m group by oid")
def o3_polylines(spark, sf):
    p = O.polylines(view(spark, sf, "fx_vertices"))
    total = lambda f: F.bround(F.aggregate("path", F.lit(0.0), lambda a, v: a + v[f] * v["i"]), 2)
    return p.select("oid", F.size("path").alias("n_vertices"), total("mx").alias("check_x"), total("my").alias("check_y"))


BOX = f"{V}, m as (select oid%50 as grp, {mercator('lon', 'lat')[0]} as mx, {mercator('lon', 'lat')[1]} as my from fx_vertices), b as (select grp, min(mx) as x0, min(my) as y0, max(mx) as x1, max(my) as y1 from m group by grp)"


def _boxes(spark, sf):
    return O.boxes(view(spark, sf, "fx_vertices").withColumn("grp", F.col("oid") % 50), "grp")


@query(f"{BOX}, c as (select min(x0) as a, min(y0) as b, max(x1) as c, max(y1) as d from b) select 'group' as kind, grp, round_even(x0,3) as x0, round_even(y0,3) as y0, round_even(x1,3) as x1, round_even(y1,3) as y1 from b union all select 'city', null, round_even(a-0.02e0*(c-a),3), round_even(b-0.02e0*(d-b),3), round_even(c+0.02e0*(c-a),3), round_even(d+0.02e0*(d-b),3) from c")
def o4_bbox(spark, sf):
    b = _boxes(spark, sf)
    c = b.agg(F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1"))
    px, py = (F.col("x1") - F.col("x0")) * 0.02, (F.col("y1") - F.col("y0")) * 0.02
    city = c.select((F.col("x0") - px).alias("x0"), (F.col("y0") - py).alias("y0"), (F.col("x1") + px).alias("x1"), (F.col("y1") + py).alias("y1"))
    both = b.withColumn("kind", F.lit("group")).unionByName(city.withColumn("kind", F.lit("city")).withColumn("grp", F.lit(None).cast("long")))
    return both.select("kind", "grp", *(F.bround(k, 3).alias(k) for k in ("x0", "y0", "x1", "y1")))


BINS = "case when n>=10 then 5 when n>=5 then 4 when n>=3 then 3 when n>=2 then 2 when n>=1 then 1 else 0 end"
FLOOR = "case when n>=10 then 3.4e0 when n>=5 then 3e0 when n>=3 then 2.6e0 when n>=2 then 2.2e0 when n>=1 then 1.8e0 else 0e0 end"
WIDTH = f"case {BUCKET} " + " ".join(f"when '{c}' then {w}e0" for c, w in O.CLASSES) + " end"


@query(f"{INDEX}, x as (select s.oid, cls, coalesce(n_sags,0) as n from fx_segments s left join idx on s.street=idx.street) select oid, cast({BINS} as int) as bin, case when n>=10 then '10+' when n>=5 then '5–9' when n>=3 then '3–4' when n>=2 then '2' when n>=1 then '1' else 'no sag' end as label, greatest({WIDTH}, {FLOOR}) as width from x")
def o5_sag_bins(spark, sf):
    s = _named(view(spark, sf, "fx_segments").select("oid", "street", "cls")).withColumn("bucket", O.class_bucket(F.col("class_name")))
    s = s.join(F.broadcast(O.class_dimension(spark).select(F.col("cls").alias("bucket"), "width")), "bucket")  # a dimension of nine rows
    s = s.join(_index(spark, sf).select("street", "n_sags"), "street", "left").withColumn("b", O.sag_bin(F.coalesce("n_sags", F.lit(0))))
    return s.select("oid", "b.bin", "b.label", F.greatest("width", "b.floor").alias("width"))


@query(f"{LONG}, x as (select variant, street, n_sags as n from lng) select variant, cast({BINS} as int) as bin, count(distinct street) as n_streets from x group by all")
def o6_legend(spark, sf):
    return _long(spark, sf).groupBy("variant", O.sag_bin(F.col("n_sags"))["bin"].alias("bin")).agg(F.count_distinct("street").alias("n_streets"))


@query(f"{SEG} select {BUCKET} as cls, count(*) as n_segments from fx_segments group by 1")
def o6_class_legend(spark, sf):
    return _named(view(spark, sf, "fx_segments")).groupBy(O.class_bucket(F.col("class_name")).alias("cls")).agg(F.count("*").alias("n_segments"))


@query(f"{LONG}, w as (select street, max(case when variant='m25' then n_sags end) as n_sags_m25, max(case when variant='m10' then n_sags end) as n_sags_m10, max(case when variant='m25' then n_inlets end) as n_inlets, max(case when variant='m25' then length_m end) as length_m from lng group by street) select * from w")
def o7_pivot(spark, sf):
    return O.wide_variants(_long(spark, sf), ["m25", "m10"])


@query(f"{LONG} select street, variant, n_sags, n_unserved, n_inlets, length_m from lng where lower(street) like '%et 001%'")
def o8_search(spark, sf):
    return O.search(_long(spark, sf), "Et 001").select("street", "variant", "n_sags", "n_unserved", "n_inlets", "length_m")


@query(f"with {ctes('fx_points')}, c as (select coalesce({CLS}, '(unclassified)') as cls from fx_points) select cls, cast(case cls " + " ".join(f"when '{c}' then {i}" for i, (c, _) in enumerate(O.CLASSES)) + " end as int) as draw_rank, count(*) as n from c where cls <> 'Alley' group by 1, 2")
def o9_class_points(spark, sf):
    return O.class_points(_named(view(spark, sf, "fx_points")), "class_name")


@query(f"with {ctes('fx_points')} select oid, point_index from (select *, row_number() over (order by oid, point_index)-1 as n from fx_points) where n%25=0")
def o10_every_nth(spark, sf):
    return every_nth(view(spark, sf, "fx_points").select("oid", "point_index"), 25, "oid", "point_index")


ASPECT = repr(O.MAP_ASPECT)


@query(f"{BOX}, p as (select grp, x0-greatest(0.25e0*(x1-x0),120) as a, y0-greatest(0.25e0*(y1-y0),120) as b, x1+greatest(0.25e0*(x1-x0),120) as c, y1+greatest(0.25e0*(y1-y0),120) as d from b), q as (select *, (c-a)/(d-b)<{ASPECT} as thin, (a+c)/2 as cx, (b+d)/2 as cy from p) select grp, round_even(case when thin then cx-(d-b)*{ASPECT}/2 else a end,3) as vx0, round_even(case when thin then b else cy-(c-a)/{ASPECT}/2 end,3) as vy0, round_even(case when thin then cx+(d-b)*{ASPECT}/2 else c end,3) as vx1, round_even(case when thin then d else cy+(c-a)/{ASPECT}/2 end,3) as vy1 from q")
def o11_viewport(spark, sf):
    v = _boxes(spark, sf).select("grp", *O.viewport(F.col("x0"), F.col("y0"), F.col("x1"), F.col("y1")))
    return v.select("grp", *(F.bround(c, 3).alias(c) for c in ("vx0", "vy0", "vx1", "vy1")))


# ---- chart scales ----

def ladder_sql(ladder: tuple[float, ...], test: str) -> str:
    return f"coalesce(list_filter([{', '.join(f'{x}e0' for x in ladder)}], lambda t: {test})[1], {ladder[-1]}e0)"


RANGE = """rng as (select sm.street, max(d) as length, least(min(elev_m), min(c.lo)) as lo, greatest(max(elev_m), max(c.hi)) as hi from sm
  left join (select street, min(least(grate_m, invert_m)) as lo, max(greatest(grate_m, invert_m)) as hi from pairs join clean on pairs.inlet_id=clean.inlet_id group by street) c on c.street=sm.street group by sm.street)"""
CLEANED = """clean as (select inlet_id, case when top_of_grate_ft between 300 and 900 then top_of_grate_ft*0.3048e0+0.794e0 end as grate_m, case when invert_ft between 250 and 900 then invert_ft*0.3048e0+0.794e0 end as invert_m from fx_inlets)"""


@query(f"""{PAIRS}, {CLEANED}, {RANGE}, a as (select street, length, lo, hi, {ladder_sql(V_.H_LADDER, "length/t<=1400")} as h, greatest(hi-lo,0.05e0)*1.06e0 as need from rng),
b as (select *, least(greatest(need/0.02e0,200),900) as px from a), c as (select *, case when need/0.02e0<=900 then 0.02e0 else need/px end as v from b)
select street, h as h_mpp, round_even(least(greatest(length/h,420),1400),3) as width_px, round_even(v,6) as v_mpp, round_even(px,3) as height_px, round_even((lo+hi)/2-px*v/2,6) as y_low, round_even((lo+hi)/2+px*v/2,6) as y_high,
 round_even(lo-greatest(0.06e0*(hi-lo),0.15e0),6) as page_low, round_even(hi+greatest(0.06e0*(hi-lo),0.15e0),6) as page_high from c""")
def v1_profile_scale(spark, sf):
    r = V_.profile_scale(V_.value_range(_profile(spark, sf), _typed_pairs(spark, sf)))
    places = {"width_px": 3, "v_mpp": 6, "height_px": 3, "y_low": 6, "y_high": 6, "page_low": 6, "page_high": 6}
    return r.select("street", "h_mpp", *(F.bround(c, k).alias(c) for c, k in places.items()))


G4 = lonlat("easting", "northing")
M4 = mercator("lon", "lat")


@query(f"""{SM}, g as (select street, {G4[0]} as lon, {G4[1]} as lat from sm), m as (select street, lat, {M4[0]} as mx, {M4[1]} as my from g),
e as (select street, greatest((max(mx)-min(mx))*cos(radians(avg(lat))),1) as gx, greatest((max(my)-min(my))*cos(radians(avg(lat))),1) as gy from m group by street),
p as (select *, least(greatest(0.6e0*greatest(gx,gy),60),250) as pad from e), x as (select street, pad, gx+2*pad as ex, gy+2*pad as ey from p), y as (select *, {ladder_sql(V_.MAP_LADDER, "ex/t<=1200 and ey/t<=1000")} as mpp from x)
select street, round_even(pad,2) as pad_m, mpp as m_mpp, round_even(least(greatest(ex/mpp,420),1200),1) as width_px, round_even(least(greatest(ey/mpp,320),1000),1) as height_px, cast(least(greatest(round_even(log2(3*40075016.686e0/greatest(ex,ey)),0),12),18) as int) as zoom from y""")
def v3_map_scale(spark, sf):
    m = V_.map_scale(V_.mercator_box(_profile(spark, sf)))
    return m.select("street", F.bround("pad_m", 2).alias("pad_m"), "m_mpp", F.bround("width_px", 1).alias("width_px"), F.bround("height_px", 1).alias("height_px"), "zoom")


@query(f"""{SM}, g as (select street, {G4[0]} as lon, {G4[1]} as lat from sm), m as (select street, {M4[0]} as mx, {M4[1]} as my from g),
e as (select street, min(mx) as x0, max(mx) as x1, min(my) as y0, max(my) as y1 from m group by street), p as (select *, least(greatest(0.6e0*greatest(x1-x0,y1-y0),60),250) as pad from e)
select street, round_even(x0-pad,3) as x_low, round_even(x1+pad,3) as x_high, round_even(y0-pad,3) as y_low, round_even(y1+pad,3) as y_high from p""")
def v6_page_box(spark, sf):
    b = V_.page_box(V_.mercator_box(_profile(spark, sf)))
    return b.select("street", *(F.bround(c, 3).alias(c) for c in ("x_low", "x_high", "y_low", "y_high")))


@query(f"{V}, b as (select oid%20 as grp, min(lon) as a, max(lon) as b, min(lat) as c, max(lat) as d from fx_vertices group by 1) select grp, round_even(least(log2(1400e0*360/(256*greatest(b-a,1e-9))), log2(800e0*360/(256*greatest(d-c,1e-9)/cos(radians((c+d)/2)))))-0.6e0,6) as zoom from b")
def v5_fit_zoom(spark, sf):
    b = view(spark, sf, "fx_vertices").groupBy((F.col("oid") % 20).alias("grp")).agg(F.min("lon").alias("a"), F.max("lon").alias("b"), F.min("lat").alias("c"), F.max("lat").alias("d"))
    return b.select("grp", F.bround(V_.fit_zoom(F.col("a"), F.col("b"), F.col("c"), F.col("d")), 6).alias("zoom"))


# ---- flagged-cell clusters ----

ISL = f"""with {ctes("fx_points")}, f as (select street, oid, dist_along_m, easting, northing from fx_points where elev_disc_cm>20),
i0 as (select *, case when lag(oid) over w is null or dist_along_m-lag(dist_along_m) over w>5 then 1 else 0 end as new from f window w as (partition by street, oid order by dist_along_m)),
i1 as (select *, sum(new) over (partition by street, oid order by dist_along_m) as island from i0),
isl as (select street, oid, cast(island as int) as island, count(*) as n, avg(easting) as x, avg(northing) as y from i1 group by street, oid, island)"""


def _islands(spark, sf):
    return O.islands(view(spark, sf, "fx_points").where("elev_disc_cm > 20"))


@query(f"{ISL} select street, oid, island, n, round_even(x,6) as x, round_even(y,6) as y from isl")
def l1_islands(spark, sf):
    return _islands(spark, sf).select("street", "oid", "island", "n", F.bround("x", 6).alias("x"), F.bround("y", 6).alias("y"))


@query(f"""{ISL}, c as (select street, x, y, n from isl union all select street, median(easting), median(northing), 0 from fx_points where street not in (select street from isl) group by street),
l as (select street, list([{{'x': x, 'y': y, 'n': cast(n as double)}}] order by -n, x, y) as c from c group by street),
m as (select street, list_reduce(c, lambda a, b: case when list_position(list_transform(a, lambda k: sqrt((k.x-b[1].x)*(k.x-b[1].x)+(k.y-b[1].y)*(k.y-b[1].y))<40), true) is null or list_position(list_transform(a, lambda k: sqrt((k.x-b[1].x)*(k.x-b[1].x)+(k.y-b[1].y)*(k.y-b[1].y))<40), true)=0 then list_concat(a, b)
  else list_transform(a, lambda k, i: case when i=list_position(list_transform(a, lambda q: sqrt((q.x-b[1].x)*(q.x-b[1].x)+(q.y-b[1].y)*(q.y-b[1].y))<40), true) then {{'x': (k.x*k.n+b[1].x*b[1].n)/(k.n+b[1].n), 'y': (k.y*k.n+b[1].y*b[1].n)/(k.n+b[1].n), 'n': k.n+b[1].n}} else k end) end) as r from l)
select street, cast(i-1 as int) as rank, round_even(r[i].x,6) as x, round_even(r[i].y,6) as y, cast(r[i].n as bigint) as n from (select street, r, unnest(range(1, least(3, len(r))+1)) as i from m)""")
def l3_merge(spark, sf):
    c = O.with_fallback(_islands(spark, sf), view(spark, sf, "fx_points"))
    return O.merge_centres(c).select("street", "rank", F.bround("x", 6).alias("x"), F.bround("y", 6).alias("y"), "n")


@query(f"with {ctes('fx_points')} select street, floor(min(easting)-60) as w, floor(min(northing)-60) as s, ceil(max(easting)+60) as e, ceil(max(northing)+60) as n, max(northing)-min(northing)+120>1.6e0*(max(easting)-min(easting)+120) as tall from fx_points group by street")
def l4_street_window(spark, sf):
    return V_.street_window(view(spark, sf, "fx_points"))
