"""Queries on street profiles, sags and inlets, with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import inlets as I
from ..operators import profile as C
from ..operators import sags as D
from ..operators import summary as S
from ..sources.fixtures import ctes, parts, table, view
from ..sources.store import Kept
from ._register import Register
from .geometry import lonlat

query = Register()
QUERIES, ORACLES = query.queries, query.oracles


PATH = ctes("fx_points", "fx_inlets") + """,
path0 as (select p.*, g.k, g.rev, cast(row_number() over (partition by p.street order by g.k, case when g.rev=1 then -p.point_index else p.point_index end)-1 as int) as path_idx,
  cast(case when p.s%7=0 and g.k>=3 then 1 else 0 end as int) as run, case when g.ew=1 then 'W' else 'N' end as origin
  from fx_points p join fx_segments g on p.oid=g.oid),
path1 as (select *, coalesce(sqrt((easting-lag(easting) over o)*(easting-lag(easting) over o)+(northing-lag(northing) over o)*(northing-lag(northing) over o)),0e0) as step
  from path0 window o as (partition by street order by path_idx)),
path as (select *, sum(step) over (partition by street order by path_idx) as d from path1)"""


def smoothed(back: int, ahead: int, least: int, name: str = "sm") -> str:
    return f"""{name} as (select *, case when count(elev_m) over f >= {least} then avg(elev_m) over f end as smooth
  from path window f as (partition by street, run order by path_idx rows between {back} preceding and {ahead} following))"""


def sag_sql(sm: str = "sm", x: str = "") -> str:
    return f"""ok{x} as (select *, row_number() over w as pos, lag(smooth) over w as pv, lead(smooth) over w as nx, min(d) over g as lo, max(d) over g as hi, count(*) over g as cnt
  from {sm} where smooth is not null window w as (partition by street, run order by path_idx), g as (partition by street, run)),
low{x} as (select * from ok{x} where cnt>=3 and smooth<=pv and smooth<nx and d-lo>=10 and hi-d>=10),
lr{x} as (select c.street, c.run, c.pos, c.path_idx, c.d, c.smooth, c.easting, c.northing,
  coalesce(max(case when r.smooth<c.smooth and r.pos<c.pos then r.pos end),0) as l, coalesce(min(case when r.smooth<c.smooth and r.pos>c.pos then r.pos end),2147483647) as rr
  from low{x} c join ok{x} r on c.street=r.street and c.run=r.run group by all),
pr{x} as (select lr{x}.*, max(case when o.pos<lr{x}.pos then o.smooth end) as ma, max(case when o.pos>lr{x}.pos then o.smooth end) as mb
  from lr{x} join ok{x} o on o.street=lr{x}.street and o.run=lr{x}.run and o.pos>l and o.pos<rr group by all),
cand{x} as (select *, least(ma, mb)-smooth as prom from pr{x} where ma is not null and mb is not null and least(ma, mb)-smooth>=0.2),
sags{x} as (select *, cast(row_number() over (partition by street order by d, path_idx) as int) as sag_num from cand{x})"""


def snap_sql(sm: str = "sm", x: str = "") -> str:
    return f"""box{x} as (select street, min(easting)-30 as w, max(easting)+30 as e, min(northing)-30 as so, max(northing)+30 as no from {sm} group by street),
near{x} as (select p.street, i.inlet_id, p.path_idx, p.d, p.elev_m, p.smooth, (i.x-p.easting)*(i.x-p.easting)+(i.y-p.northing)*(i.y-p.northing) as d2
  from fx_inlets i join box{x} b on i.x>b.w and i.x<b.e and i.y>b.so and i.y<b.no join {sm} p on p.street=b.street),
pairs{x} as (select *, cast(row_number() over (partition by street order by chainage, inlet_id) as int) as num from (
  select street, inlet_id, path_idx, d as chainage, sqrt(d2) as offset_m, elev_m as dem_m, smooth as smooth_m
  from (select *, row_number() over (partition by street, inlet_id order by d2, path_idx) as n from near{x} where d2<=900) where n=1))"""


def serve_sql(x: str = "") -> str:
    return f"""picks{x} as (select street, sag_num, num as pick from (select s.street, s.sag_num, p.num, row_number() over (partition by s.street, s.sag_num order by abs(p.chainage-s.d), p.num) as n
  from sags{x} s join pairs{x} p on p.street=s.street and abs(p.chainage-s.d)<=60 and abs(p.smooth_m-s.smooth)<=0.2) where n=1),
served{x} as (select * from (select *, row_number() over (partition by street, pick order by sag_num) as n from picks{x}) where n=1)"""


def index_sql(sm: str = "sm", x: str = "") -> str:
    return f"""idx{x} as (select a.street, n_points, coalesce(n_inlets,0) as n_inlets, coalesce(n_sags,0) as n_sags, coalesce(n_served,0) as n_served, coalesce(n_sags,0)-coalesce(n_served,0) as n_unserved, length_m
  from (select street, count(*) as n_points, round_even(max(d),1) as length_m from {sm} group by street) a
  left join (select street, count(*) as n_inlets from pairs{x} group by street) b on a.street=b.street
  left join (select street, count(*) as n_sags from sags{x} group by street) c on a.street=c.street
  left join (select street, count(*) as n_served from served{x} group by street) e on a.street=e.street)"""


SM = f"with {PATH},\n{smoothed(12, 12, 8)}"
SAGS = f"{SM},\n{sag_sql()}"
PAIRS = f"{SM},\n{snap_sql()}"
SERVE = f"{SAGS},\n{snap_sql()},\n{serve_sql()}"
INDEX = f"{SERVE},\n{index_sql()}"
CLEAN = """clean as (select *, case when top_of_grate_ft between 300 and 900 then top_of_grate_ft*0.3048e0+0.794e0 end as grate_m,
  case when invert_ft between 250 and 900 then invert_ft*0.3048e0+0.794e0 end as invert_m, coalesce(type_description,'Unknown') as type from fx_inlets)"""


def _points(spark: SparkSession, sf: str) -> DataFrame:
    return view(spark, sf, "fx_points")


_kept = Kept()
release = _kept.release


def keep(spark: SparkSession, sf: str, name: tuple, make: Callable[[], DataFrame], order: tuple[str, ...] = (), deal: bool = True) -> DataFrame:
    """A table derived from the tables of sf, by street, that is derived once a session; release() lets all go."""
    return _kept.get(spark, (sf, *name), make, tuple(f"{sf}/{t}.parquet" for t in ("customer", "nation", "region", "part")), order=order, buckets=parts(spark, sf), deal=deal)


def _profile(spark: SparkSession, sf: str, window: float = 25.0, also: dict[str, float] | None = None) -> DataFrame:
    """The smoothed path, read once. Points are dealt out by street, so chaining and smoothing send none of them."""
    return C.profiles(_points(spark, sf), window, also=also)


#: What inlets, low points and the index read of a profile.
READ = ("street", "run", "path_idx", "d", "smooth", "elev_m", "easting", "northing")


def _kept_profile(spark: SparkSession, sf: str, window: float = 25.0, shared: bool = False) -> DataFrame:
    """The profile, kept. shared: with 25 and 10 m of smoothing, both in one table, as one pass over the path makes them."""
    if not shared:
        return keep(spark, sf, ("profile", window), lambda: _profile(spark, sf, window).select(*READ), ("path_idx",), deal=False)
    both = keep(spark, sf, ("profile",), lambda: _profile(spark, sf, 25.0, {"smooth_10": 10.0}).select(*READ, "smooth_10"), ("path_idx",), deal=False)
    return both if window == 25.0 else both.withColumn("smooth", F.col("smooth_10"))


def _pairs(spark: SparkSession, sf: str, window: float = 25.0, shared: bool = False) -> DataFrame:
    """Numbered pairs, kept. shared: which point an inlet snaps to does not depend on smoothing, so both windows have one table."""
    also = ("smooth_10",) if shared else ()
    snapped = lambda: I.number(I.snap(view(spark, sf, "fx_inlets"), _kept_profile(spark, sf, 25.0 if shared else window, shared), also=also, parts=parts(spark, sf)))
    pairs = keep(spark, sf, ("pairs", "both" if shared else window), snapped, ("num",))
    return pairs.withColumn("smooth_m", F.col("smooth_10")) if shared and window != 25.0 else pairs


def _sags(spark: SparkSession, sf: str, window: float = 25.0, shared: bool = False) -> DataFrame:
    return keep(spark, sf, ("sags", window), lambda: D.find_sags(_kept_profile(spark, sf, window, shared)), ("sag_num",))


def _typed_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return _pairs(spark, sf).join(I.clean(view(spark, sf, "fx_inlets")).select("inlet_id", "grate_m", "invert_m", "type"), "inlet_id")


def _analysis(spark: SparkSession, sf: str, window: float = 25.0, shared: bool = False) -> tuple[DataFrame, ...]:
    """(profile, numbered pairs, sags, served sags), all in the same buckets by street, so what joins and counts them shuffles nothing."""
    pairs, sags = _pairs(spark, sf, window, shared), _sags(spark, sf, window, shared)
    return _kept_profile(spark, sf, window, shared), pairs, sags, I.served(I.candidates(sags, pairs))


def _index(spark: SparkSession, sf: str, window: float = 25.0, shared: bool = False) -> DataFrame:
    return S.street_index(*_analysis(spark, sf, window, shared))


def variants(spark: SparkSession, sf: str) -> DataFrame:
    """The street index with 25 and 10 m of smoothing, in long form."""
    return _index(spark, sf, 25.0, True).withColumn("variant", F.lit("m25")).unionByName(_index(spark, sf, 10.0, True).withColumn("variant", F.lit("m10")))


@query(f"with {PATH} select street, oid, min_by(easting, point_index) as e0, min_by(northing, point_index) as n0, max_by(easting, point_index) as e1, max_by(northing, point_index) as n1 from fx_points group by street, oid")
def c1_seg_ends(spark, sf):
    return C.segment_ends(_points(spark, sf)).select("street", "oid", "e0", "n0", "e1", "n1")


@query(f"""with {ctes("fx_segments")}, e as (select street, k, n0, e0, ew, a0 as a from fx_segments union all select street, k, n0, e0, ew, a0+100 from fx_segments),
x as (select street, case when ew=1 then e0+a else e0 end as x, case when ew=1 then n0 else n0-a end as y from e)
select street, x, y, count(*) as degree from x group by street, x, y""")
def c2_nodes(spark, sf):
    return C.junctions(C.segment_ends(_points(spark, sf))).select("street", "x", "y", "degree")


@query(f"""with {ctes("fx_segments")} select street, case when ew=1 then e0+a0 else e0 end as x, case when ew=1 then n0 else n0-a0 end as y, case when ew=1 then 'W' else 'N' end as label from fx_segments where k=0""")
def c4_origin(spark, sf):
    ends = C.segment_ends(_points(spark, sf))
    return C.origins(C.junctions(ends), ends)


@query(f"""with {ctes("fx_segments")} select street, oid, k as seq, rev=1 as flip, case when s%7=0 and k=3 then 60e0 else 0e0 end as gap_m, case when ew=1 then 'W' else 'N' end as origin from fx_segments""")
def c5_chain(spark, sf):
    return C.chain(C.segment_ends(_points(spark, sf)))


@query(f"""with {ctes("fx_segments")} select street, oid, cast(case when s%7=0 and k>=3 then 1 else 0 end as int) as run from fx_segments""")
def c6_runs(spark, sf):
    return C.with_runs(C.chain(C.segment_ends(_points(spark, sf)))).select("street", "oid", "run")


@query(f"with {PATH} select street, oid, point_index, path_idx from path")
def c7_path_index(spark, sf):
    return _profile(spark, sf).select("street", "oid", "point_index", "path_idx")


@query(f"with {PATH} select street, path_idx, round_even(d,6) as d from path")
def c8_chainage(spark, sf):
    return _profile(spark, sf).select("street", "path_idx", F.bround("d", 6).alias("d"))


@query(f"{SM} select street, path_idx, round_even(smooth,6) as smooth from sm")
def c9_smooth_25(spark, sf):
    return _profile(spark, sf, 25).select("street", "path_idx", F.bround("smooth", 6).alias("smooth"))


@query(f"with {PATH},\n{smoothed(5, 4, 3)} select street, path_idx, round_even(smooth,6) as smooth from sm")
def c9_smooth_10(spark, sf):
    return _profile(spark, sf, 10).select("street", "path_idx", F.bround("smooth", 6).alias("smooth"))


@query(f"""with {PATH.replace("from fx_points p join", "from (select * from fx_points where elev_m is not null) p join")} select street, oid, point_index, path_idx, round_even(d,6) as d from path""")
def c10_known_elevations(spark, sf):
    p = _points(spark, sf)
    return C.path(p, C.with_runs(C.chain(C.segment_ends(p))), drop_null_z=True).select("street", "oid", "point_index", "path_idx", F.bround("d", 6).alias("d"))


EVENTS = """with ev as (select user_id, cast(row_number() over (partition by user_id order by ts, event_id) as double) as d, row_number() over (partition by user_id order by ts, event_id) as pos, value from events),
ok as (select *, lag(value) over w as pv, lead(value) over w as nx, count(*) over (partition by user_id) as cnt from ev window w as (partition by user_id order by pos)),
low as (select * from ok where cnt>=3 and value<=pv and value<nx and d-1>=5 and cnt-d>=5)"""
EVENTS_PROM = EVENTS + """, lr as (select c.user_id, c.pos, c.d, c.value, coalesce(max(case when r.value<c.value and r.pos<c.pos then r.pos end),0) as l, coalesce(min(case when r.value<c.value and r.pos>c.pos then r.pos end),2147483647) as rr
  from low c join ok r on c.user_id=r.user_id group by all),
pr as (select lr.*, max(case when o.pos<lr.pos then o.value end) as ma, max(case when o.pos>lr.pos then o.value end) as mb from lr join ok o on o.user_id=lr.user_id and o.pos>l and o.pos<rr group by all),
cand as (select user_id, pos, d, value, least(ma, mb)-value as prom from pr where ma is not null and mb is not null and least(ma, mb)-value>=20)"""


def _event_rows(spark, sf):
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    ev = table(spark, sf, "events").select("user_id", "ts", "event_id", "value", F.row_number().over(w).cast("double").alias("d"))
    return D.minima(ev, group=("user_id",), order=("ts", "event_id"), d="d", z="value", edge=5.0)


@query(f"{SAGS} select street, path_idx, round_even(smooth,6) as smooth from low")
def d2_minima(spark, sf):
    return D.minima(_profile(spark, sf)).where("low").select("street", "path_idx", F.bround("smooth", 6).alias("smooth"))


@query(f"{SAGS} select street, path_idx, round_even(prom,6) as prom from cand")
def d4_prominence(spark, sf):
    return D.prominence(D.minima(_profile(spark, sf))).select("street", "path_idx", F.bround("prom", 6).alias("prom"))


@query(f"{EVENTS_PROM} select user_id, d, round_even(prom,6) as prom from cand")
def d4_prominence_events(spark, sf):
    return D.prominence(_event_rows(spark, sf), group=("user_id",), z="value", least=20.0).select("user_id", "d", F.bround("prom", 6).alias("prom"))


@query(f"{SAGS} select street, sag_num, path_idx, round_even(d,6) as d, round_even(smooth,6) as elev, round_even(prom,6) as prom from sags")
def d5_sags(spark, sf):
    return D.find_sags(_profile(spark, sf)).select("street", "sag_num", "path_idx", F.bround("d", 6).alias("d"), F.bround("smooth", 6).alias("elev"), F.bround("prom", 6).alias("prom"))


@query(f"""{EVENTS_PROM}, f as (select user_id, list_reduce(list([{{'d': d, 'prom': prom}}] order by -prom, pos), lambda a, b: case when len(list_filter(a, lambda k: abs(k.d-b[1].d)<10))>0 then a else list_concat(a, b) end) as kept from cand group by user_id)
select user_id, x.d as d, round_even(x.prom,6) as prom, cast(row_number() over (partition by user_id order by x.d) as int) as sag_num from (select user_id, unnest(kept) as x from f)""")
def d5_suppress_events(spark, sf):
    cands = D.prominence(_event_rows(spark, sf), group=("user_id",), z="value", least=20.0)
    return D.suppress(cands, group="user_id", order="pos", keep=("value",)).select("user_id", "d", F.bround("prom", 6).alias("prom"), "sag_num")


@query(f"with {ctes('fx_inlets')}, {CLEAN} select inlet_id, round_even(grate_m,6) as grate_m, round_even(invert_m,6) as invert_m, type from clean")
def i1_clean(spark, sf):
    return I.clean(view(spark, sf, "fx_inlets")).select("inlet_id", F.bround("grate_m", 6).alias("grate_m"), F.bround("invert_m", 6).alias("invert_m"), "type")


@query(f"""with {ctes('fx_inlets')}, {CLEAN}, style(type, marker, colour) as (values ('Curb Inlet','o','#2e86c1'), ('Grated Inlet','s','#e08e45'), ('Slotted Drain','D','#7b3294'), ('Trench Drain','P','#1a9850'), ('Standard','^','#c9a227'), ('Unknown','X','#888888'))
select inlet_id, clean.type, coalesce(marker,'v') as marker, coalesce(colour,'#555555') as colour from clean left join style on style.type=clean.type""")
def i3_type_style(spark, sf):
    return I.styled(I.clean(view(spark, sf, "fx_inlets"))).select("inlet_id", "type", "marker", "colour")


@query(f"{PAIRS} select street, inlet_id, path_idx, round_even(chainage,6) as chainage, round_even(offset_m,6) as offset_m from pairs")
def i4_snap(spark, sf):
    return I.snap(view(spark, sf, "fx_inlets"), _kept_profile(spark, sf), parts=parts(spark, sf)).select("street", "inlet_id", "path_idx", F.bround("chainage", 6).alias("chainage"), F.bround("offset_m", 6).alias("offset_m"))


@query(f"{PAIRS} select street, inlet_id, num, dem_m from pairs")
def i5_number(spark, sf):
    return _pairs(spark, sf).select("street", "inlet_id", "num", "dem_m")


@query(f"""{PAIRS}, {CLEAN} select street, type, count(*) as n, count(grate_m) as n_grate, count(*) filter (grate_m is null) as n_unsurveyed, count(invert_m) as n_invert, count(*) filter (grate_m is not null and invert_m is not null) as n_stem,
 round_even(median(offset_m),6) as median_offset, round_even(max(offset_m),6) as max_offset from pairs join clean on pairs.inlet_id=clean.inlet_id group by street, type""")
def i7_type_breakdown(spark, sf):
    return S.type_breakdown(_typed_pairs(spark, sf))


@query(f"{PAIRS}, {CLEAN} select round_even(median(grate_m-dem_m),6) as median_offset, round_even(stddev_samp(grate_m-dem_m),6) as std_offset, count(grate_m-dem_m) as n from pairs join clean on pairs.inlet_id=clean.inlet_id")
def i8_datum_offset(spark, sf):
    return I.datum_offset(_typed_pairs(spark, sf))


_LO, _LA = lonlat("s.easting", "s.northing")
_ILO, _ILA = lonlat("i.x", "i.y")
_BEARING = "atan2(sin(radians(b.lon2-b.lon))*cos(radians(b.lat2)), cos(radians(b.lat))*sin(radians(b.lat2))-sin(radians(b.lat))*cos(radians(b.lat2))*cos(radians(b.lon2-b.lon)))"


@query(f"""{PAIRS}, b as (select p.street, p.inlet_id, {_LO} as lon, {_LA} as lat, {_ILO} as lon2, {_ILA} as lat2 from pairs p join sm s on s.street=p.street and s.path_idx=p.path_idx join fx_inlets i on i.inlet_id=p.inlet_id),
h as (select *, case when degrees({_BEARING})<0 then degrees({_BEARING})+360e0 else degrees({_BEARING}) end as h from b)
select street, inlet_id, round_even(h,3) as heading, printf('https://www.google.com/maps/@?api=1&map_action=pano&viewpoint=%.6f,%.6f&heading=%.0f', lat, lon, h) as url from h""")
def i9_view_link(spark, sf):
    return I.view_links(_pairs(spark, sf), _kept_profile(spark, sf), view(spark, sf, "fx_inlets")).select("street", "inlet_id", F.bround("heading", 3).alias("heading"), "url")


@query(f"{SERVE} select street, sag_num, pick from picks")
def d6_candidates(spark, sf):
    _, pairs, sags, _ = _analysis(spark, sf)
    return I.candidates(sags, pairs)


@query(f"""{SERVE}, {CLEAN} select v.street, v.sag_num, v.pick as num, round_even(coalesce(c.grate_m, p.dem_m),6) as elev from served v join pairs p on p.street=v.street and p.num=v.pick join clean c on c.inlet_id=p.inlet_id""")
def d7_served(spark, sf):
    _, pairs, sags, got = _analysis(spark, sf)
    inlets = I.clean(view(spark, sf, "fx_inlets")).select("inlet_id", "grate_m")
    out = got.withColumnRenamed("pick", "num").join(pairs.select("street", "num", "inlet_id", "dem_m"), ["street", "num"]).join(inlets, "inlet_id")
    return out.select("street", "sag_num", "num", F.bround(F.coalesce("grate_m", "dem_m"), 6).alias("elev"))


UNSERVED = """miss as (select s.street, s.sag_num, s.d, s.smooth, s.easting, s.northing, p.num as near_num, abs(p.chainage-s.d) as gap_m, p.smooth_m-s.smooth as lift_m, p.inlet_id as near_inlet,
  row_number() over (partition by s.street, s.sag_num order by abs(p.chainage-s.d), p.num) as n
  from sags s left join served v on v.street=s.street and v.sag_num=s.sag_num left join pairs p on p.street=s.street where v.street is null)"""


@query(f"{SERVE}, {UNSERVED} select street, sag_num, near_num, round_even(gap_m,6) as gap_m, round_even(lift_m,6) as lift_m, near_inlet from miss where n=1")
def d8_unserved(spark, sf):
    _, pairs, sags, got = _analysis(spark, sf)
    return I.unserved(sags, got, pairs).select("street", "sag_num", "near_num", F.bround("gap_m", 6).alias("gap_m"), F.bround("lift_m", 6).alias("lift_m"), "near_inlet")


@query(f"""{SERVE}, {UNSERVED} select s.street, s.sag_num, round_even(s.d,6) as sag_chainage, round_even(s.smooth,6) as sag_elev, 'served' as status, v.pick as num, null::int as near_num, null::double as gap_m from sags s join served v on v.street=s.street and v.sag_num=s.sag_num
union all select street, sag_num, round_even(d,6), round_even(smooth,6), 'no inlet', null, near_num, round_even(gap_m,6) from miss where n=1""")
def d9_sag_report(spark, sf):
    _, pairs, sags, got = _analysis(spark, sf)
    r = I.report(sags, got, I.unserved(sags, got, pairs))
    return r.select("street", "sag_num", F.bround("sag_chainage", 6).alias("sag_chainage"), F.bround("sag_elev", 6).alias("sag_elev"), "status", "num", "near_num", F.bround("gap_m", 6).alias("gap_m"))


@query(f"""with {PATH}, a as (select street, count(distinct oid) as n_segments, max(d) as length, max(run) as n_gaps, min(origin) as origin, arg_min_null(elev_m, path_idx) as a, arg_max_null(elev_m, path_idx) as b, min(elev_m) as lo, max(elev_m) as hi, count(*) filter (elev_disc_cm>20) as pts_flagged_disc from path group by street)
select street, n_segments, round_even(length,1) as length_m, n_gaps, origin, round_even(a,3) as elev_start_m, round_even(b,3) as elev_end_m, round_even(lo,3) as elev_min_m, round_even(hi,3) as elev_max_m, round_even(b-a,3) as net_change_m,
 round_even(case when length>0 then (b-a)/length*100 else 0e0 end,3) as mean_grade_pct, pts_flagged_disc from a""")
def s1_profile_index(spark, sf):
    return S.profile_index(_profile(spark, sf))


@query(f"""{PAIRS}, {CLEAN}, q as (select street, count(*) as n_inlets, count(grate_m) as n_grate_elev, count(invert_m) as n_invert_elev, round_even(median(offset_m),1) as median_offset_m from pairs join clean on pairs.inlet_id=clean.inlet_id group by street)
select a.street, n_points, coalesce(n_inlets,0) as n_inlets, coalesce(n_grate_elev,0) as n_grate_elev, coalesce(n_invert_elev,0) as n_invert_elev, median_offset_m from (select street, count(*) as n_points from sm group by street) a left join q on a.street=q.street""")
def s2_drain_index(spark, sf):
    return S.drain_index(_profile(spark, sf), _typed_pairs(spark, sf))


@query(f"{INDEX} select * from idx")
def s3_street_index(spark: SparkSession, sf: str) -> DataFrame:
    return _index(spark, sf)


@query(f"""{INDEX} select count(*) as streets, count(*) filter (n_inlets>0) as with_inlets, count(*) filter (n_inlets=0) as without_inlets, cast(sum(n_inlets) as bigint) as inlets, cast(sum(n_sags) as bigint) as sags, cast(sum(n_served) as bigint) as served, cast(sum(n_unserved) as bigint) as unserved from idx""")
def s4_totals(spark, sf):
    return S.totals(_index(spark, sf))


@query(f"{INDEX} select street from idx where length_m>=505 and n_inlets>=5 and n_unserved>0")
def s5_filters(spark, sf):
    return S.select_streets(_index(spark, sf), 505.0, 5, True).select("street")


CAND = f"""with {ctes("fx_points", "fx_inlets")}, b as (select street, min(easting)-30 as w, max(easting)+30 as e, min(northing)-30 as s, max(northing)+30 as n from fx_points group by street)
select street, count(*) as n_near from b join fx_inlets i on i.x between w and e and i.y between b.s and b.n group by street having count(*)>=3"""


@query(CAND)
def s6_candidates(spark, sf):
    return S.sample_candidates(_points(spark, sf), view(spark, sf, "fx_inlets"))


@query(f"select * from ({CAND}) c order by md5(concat('7:', street)), street limit 8")
def s6_sample(spark, sf):
    return S.sample_streets(S.sample_candidates(_points(spark, sf), view(spark, sf, "fx_inlets")), 8, seed=7)


NAMES = "select distinct concat(p_name, ' ', p_type, case when p_partkey%3=0 then '-' when p_partkey%3=1 then ' ' else '/' end, p_brand) as street from {part}"


@query(f"""with n as ({NAMES.format(part="part")}), b as (select street, case when trim(regexp_replace(street,'[^A-Za-z0-9]+','_','g'),'_')='' then 'UNNAMED' else substr(trim(regexp_replace(street,'[^A-Za-z0-9]+','_','g'),'_'),1,80) end as base from n)
select street, case when k>0 then concat(base,'__',k) else base end as file_key from (select *, row_number() over (partition by base order by street)-1 as k from b)""")
def s7_safe_name(spark, sf):
    return S.safe_names(spark.sql(NAMES, part=table(spark, sf, "part")))


TWO = f"""with {PATH},\n{smoothed(12, 12, 8, "sm")},\n{smoothed(5, 4, 3, "smb")},\n{sag_sql()},\n{sag_sql("smb", "b")},\n{snap_sql()},\n{snap_sql("smb", "b")},\n{serve_sql()},\n{serve_sql("b")},\n{index_sql()},\n{index_sql("smb", "b")}"""


@query(f"""{TWO} select cast(sum(a.n_sags) as bigint) as sags_a, cast(sum(b.n_sags) as bigint) as sags_b, cast(sum(a.n_unserved) as bigint) as unserved_a, cast(sum(b.n_unserved) as bigint) as unserved_b,
 count(*) filter (a.n_sags is distinct from b.n_sags or a.n_unserved is distinct from b.n_unserved) as streets_differ from idx a full join idxb b on a.street=b.street""")
def s8_variant_diff(spark, sf):
    return S.variant_diff(_index(spark, sf, 25.0, True), _index(spark, sf, 10.0, True))
