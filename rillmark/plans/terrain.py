"""Queries on the cell table, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import raster as R
from ..sources.fixtures import ctes, view
from ._register import Register

query = Register()
QUERIES, ORACLES = query.queries, query.oracles


BASE = f"with {ctes('fx_rpoints', 'fx_tiles', 'fx_cells')}"
PLACED = "placed as (select p.*, t.dem_tile, t.tile_rank from fx_rpoints p join fx_tiles t on easting>=left_e+1 and easting<right_e-1 and northing>=bottom_n+1 and northing<top_n-1)"
BIL = f"""{PLACED}, sh as (select *, cast(floor(easting-0.5) as int) as c0, cast(floor(northing-0.5) as int) as r0, easting-5e-1-floor(easting-5e-1) as u, northing-5e-1-floor(northing-5e-1) as v from placed),
four as (select oid, point_index, dem_tile, tile_rank, c0+dc as ce, r0+dr as cn, case when dc=1 then u else 1-u end*case when dr=1 then v else 1-v end as wt from sh, (select unnest([0,1]) as dc), (select unnest([0,1]) as dr)),
bil as (select f.oid, f.point_index, f.dem_tile, f.tile_rank, case when count(elev)=4 then sum(wt*elev) end as elev_m from four f left join fx_cells c on c.dem_tile=f.dem_tile and c.cell_e=f.ce and c.cell_n=f.cn group by all)"""
NEAR = f"""{PLACED}, near as (select p.oid, p.point_index, p.dem_tile, elev as elev_cell_m from placed p left join fx_cells c on c.dem_tile=p.dem_tile and c.cell_e=round_even(easting-0.5,0) and c.cell_n=round_even(northing-0.5,0))"""
MOSAIC = "mos as (select cell_e, cell_n, arg_min(elev, tile_rank) as elev from fx_cells c join fx_tiles t on c.dem_tile=t.dem_tile where elev is not null group by all)"


def _views(spark, sf):
    return tuple(view(spark, sf, v) for v in ("fx_rpoints", "fx_tiles", "fx_cells"))


def _bilinear(spark, sf):
    p, t, c = _views(spark, sf)
    return R.bilinear(R.in_tiles(p, t), R.in_bounds(c, t))


@query(f"""{BASE}, box as (select cast(e as int) as cell_e, cast(n as int) as cell_n from (select unnest(range(600100, 600400)) as e), (select unnest(range(4169000, 4170500)) as n))
select b.cell_e, b.cell_n, c.elev from box b left join (select * from fx_cells where dem_tile='tile_a') c on c.cell_e=b.cell_e and c.cell_n=b.cell_n""")
def a6_dem_window(spark, sf):
    return R.boundless_window(view(spark, sf, "fx_cells").where("dem_tile = 'tile_a'"), 600100, 4169000, 600400, 4170500)


@query(f"with {ctes('fx_rpoints')}, c as (select *, floor(easting) as ce, floor(northing) as cn from fx_rpoints) select oid, point_index, cast(ce as int) as cell_e, cast(cn as int) as cell_n, round_even(sqrt((easting-ce-5e-1)*(easting-ce-5e-1)+(northing-cn-5e-1)*(northing-cn-5e-1)),4) as cell_center_dist_m from c")
def r1_cell_id(spark, sf):
    return R.cell_ids(view(spark, sf, "fx_rpoints")).select("oid", "point_index", "cell_e", "cell_n", "cell_center_dist_m")


@query(f"with {ctes('fx_rpoints')} select oid, point_index, coalesce(floor(easting)=lag(floor(easting)) over w and floor(northing)=lag(floor(northing)) over w, false) as same_cell_as_prev from fx_rpoints window w as (partition by oid order by point_index)")
def r2_same_cell(spark, sf):
    return R.same_cell_as_before(R.cell_ids(view(spark, sf, "fx_rpoints")), ["street", "oid"]).select("oid", "point_index", "same_cell_as_prev")


@query(f"{BASE}, {BIL} select oid, point_index, dem_tile, round_even(elev_m,6) as elev_m from (select *, row_number() over (partition by oid, point_index order by case when elev_m is not null then tile_rank else 1000000-tile_rank end) as n from bil) where n=1")
def r3_tile_assign(spark, sf):
    return R.first_tile(_bilinear(spark, sf), "oid", "point_index").select("oid", "point_index", "dem_tile", F.bround("elev_m", 6).alias("elev_m"))


@query(f"{BASE}, {BIL} select oid, point_index, dem_tile, round_even(elev_m,6) as elev_m from bil")
def r4_bilinear(spark, sf):
    return _bilinear(spark, sf).select("oid", "point_index", "dem_tile", F.bround("elev_m", 6).alias("elev_m"))


@query(f"{BASE}, {NEAR} select * from near")
def r5_nearest(spark, sf):
    p, t, c = _views(spark, sf)
    return R.nearest(R.in_tiles(p, t), R.in_bounds(c, t)).select("oid", "point_index", "dem_tile", "elev_cell_m")


@query(f"""{BASE}, {BIL.replace("bil as (", "bil as materialized (")}, {NEAR.removeprefix(PLACED + ", ").replace("near as (", "near as materialized (")},
d as (select b.oid, b.point_index, b.dem_tile, round_even(abs(elev_m-elev_cell_m)*100,2) as elev_disc_cm from bil b join near n on b.oid=n.oid and b.point_index=n.point_index and b.dem_tile=n.dem_tile)
select *, coalesce(elev_disc_cm>20,false) as flagged from d""")
def r6_discontinuity(spark, sf):
    p, t, c = _views(spark, sf)
    s = R.sample(R.in_tiles(p, t), R.blocks(R.in_bounds(c, t))).withColumn("elev_disc_cm", R.discontinuity(F.col("elev_m"), F.col("elev_cell_m")))
    return s.select("oid", "point_index", "dem_tile", "elev_disc_cm", F.coalesce(F.col("elev_disc_cm") > 20, F.lit(False)).alias("flagged"))


@query(f"with {ctes('fx_rpoints')} select r.oid, r.point_index, s.cls from fx_rpoints r left join (select oid, cls from fx_segments where oid%10<>0) s on r.oid=s.oid")
def r7_attr_join(spark, sf):
    attrs = view(spark, sf, "fx_segments").where("oid % 10 <> 0")
    return R.join_attributes(view(spark, sf, "fx_rpoints"), attrs, "oid", ("cls",)).select("oid", "point_index", "cls")


@query(f"{BASE}, {MOSAIC} select * from mos")
def r8_mosaic(spark, sf):
    _, t, c = _views(spark, sf)
    return R.mosaic(c, t)


@query(f"""{BASE}, {MOSAIC.replace("fx_tiles t on", "(select * from fx_tiles where left_e<610300 and right_e>609900 and bottom_n<4175000 and top_n>4169000) t on").replace("where elev", "where cell_e>=609900 and cell_e<610300 and cell_n>=4169000 and cell_n<4175000 and elev")} select * from mos""")
def j9_window_mosaic(spark, sf):
    _, t, c = _views(spark, sf)
    return R.mosaic(c, t, (609900, 4169000, 610300, 4175000))


@query(f"{BASE}, {MOSAIC} select cast(floor(cell_e/10e0) as bigint) as col, cast(floor(cell_n/10e0) as bigint) as row, elev from mos where cell_e%10=5 and cell_n%10=5")
def r9_coarsen(spark, sf):
    _, t, c = _views(spark, sf)
    return R.coarsen(c, t)


@query(f"""{BASE}, mid as (select dem_tile, median(elev) as m from fx_cells group by dem_tile), g as (select c.dem_tile, cell_e, cell_n, 3*coalesce(elev,m) as z from fx_cells c join mid on c.dem_tile=mid.dem_tile),
n as (select *, case when lag(cell_e) over x=cell_e-1 then lag(z) over x end as zw, case when lead(cell_e) over x=cell_e+1 then lead(z) over x end as ze, case when lag(cell_n) over y=cell_n-1 then lag(z) over y end as zs, case when lead(cell_n) over y=cell_n+1 then lead(z) over y end as zn
 from g window x as (partition by dem_tile, cell_n order by cell_e), y as (partition by dem_tile, cell_e order by cell_n)),
s as (select dem_tile, cell_e, cell_n, coalesce((ze-zw)/2, ze-z, z-zw, 0) as gx, coalesce((zn-zs)/2, zn-z, z-zs, 0) as gy from n)
select dem_tile, cell_e, cell_n, round_even((-gx*cos(radians(-225))*cos(radians(45))-gy*sin(radians(-225))*cos(radians(45))+sin(radians(45)))/sqrt(gx*gx+gy*gy+1),6) as shade from s""")
def r10_hillshade(spark, sf):
    return R.hillshade(view(spark, sf, "fx_cells"), by=("dem_tile",))


@query(f"{BASE} select round_even(quantile_cont(elev,0.02),6) as p2, round_even(quantile_cont(elev,0.5),6) as p50, round_even(quantile_cont(elev,0.98),6) as p98 from fx_cells")
def r11_percentiles(spark, sf):
    return R.percentiles(view(spark, sf, "fx_cells"), 0.02, 0.5, 0.98)


@query(f"""with {ctes("fx_points")} select street, min(elev_m) as lo, max(elev_m) as hi, max(elev_m)-min(elev_m) as relief, count(*) as n_points, count(*) filter (elev_disc_cm>20) as n_flagged, count(distinct (floor(easting), floor(northing))) as n_cells
from fx_points where easting>=600000 and easting<605000 and northing>=4170000 and northing<4174000 group by street""")
def r12_window_stats(spark, sf):
    return R.window_stats(view(spark, sf, "fx_points"), 600000, 4170000, 605000, 4174000, "street")
