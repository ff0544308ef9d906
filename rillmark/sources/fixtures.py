"""Streets, inlets, polylines and terrain derived from the given tables, in SQL that Spark and DuckDB read alike."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

VIEWS = {
    "fx_segments": """
select c_custkey as oid, s, k, concat('STREET ', lpad(cast(s as varchar(10)),cast(greatest(4,length(cast(s as varchar(10)))) as int),'0')) as street,
 case when s%2=0 then 1 else 0 end as ew,
 600000e0 + (b%20)*1000e0 as e0,
 4170000e0 + floor(b/20e0)*1000e0 + case when s%10=2 then 24e0 else 0e0 end as n0,
 100*k + case when s%7=0 and k>=3 then 60 else 0 end as a0,
 case when c_custkey%3=0 then 1 else 0 end as rev,
 case when c_nationkey%9<8 then c_nationkey%9 end as cls
from (select *, case when s%10=2 then s-2 else s end as b
      from (select c_custkey, c_nationkey, cast((c_custkey*3)%5 as int) as k,
                   cast(floor(c_custkey/5e0) as int) as s from {customer}) x) y""",
    "fx_points": """
select oid, street, s, i as point_index, 1e0*i as dist_along_m, cls,
 case when ew=1 then e0+a else e0 end as easting,
 case when ew=1 then n0 else n0-a end as northing,
 case when oid%11=0 and i between 40 and 43 then null
      else 120e0 + (s%5)/128e0*abs((a%(80+20*(s%3)))-(40+10*(s%3))) end as elev_m,
 case when oid%4=0 and i%50=0 then 25e0 else 15e-1 end as elev_disc_cm
from (select f.*, g.i, a0 + case when rev=1 then 100-g.i else g.i end as a
      from {fx_segments} f cross join
        (select n_nationkey*5+r_regionkey as i from {nation} cross join {region}
         where n_nationkey*5+r_regionkey<=100) g) p""",
    "fx_inlets": """
select inlet_id, s,
 case when s%2=0 then e0+a else e0+off end as x,
 case when s%2=0 then n0+off else n0-a end as y,
 case when inlet_id%3=0 then null when inlet_id%50=1 then 125e-1 else 390e0+p_size end as top_of_grate_ft,
 case when inlet_id%4=0 then null else 386e0+p_size-inlet_id%9 end as invert_ft,
 case when inlet_id%7=0 then null when inlet_id%7<4 then 'Curb Inlet'
      when inlet_id%7<6 then 'Grated Inlet' else 'Trench Drain' end as type_description
from (select q.*, 600000e0+(b%20)*1000e0 as e0,
        4170000e0+floor(b/20e0)*1000e0+case when s%10=2 then 24e0 else 0e0 end as n0
      from (select *, case when s%10=2 then s-2 else s end as b
            from (select p_partkey as inlet_id, p_size, cast(p_partkey%m.ns as int) as s,
                         (p_partkey*37)%500+25e-2 as a,
                         case when p_partkey%2=0 then 75e-2 else -75e-2 end*p_size as off
                  from {part} cross join
                    (select cast(floor(count(*)/5e0) as int) as ns from {customer}) m) r) q) t""",
    "fx_vertices": """
select c_custkey as oid, r_regionkey as vertex_index,
 -122e0 + (c_custkey%100)/256e0 + r_regionkey/1024e0 as lon,
 375e-1 + floor(c_custkey/100e0)/256e0 + (r_regionkey%2)/2048e0 as lat
from {customer} cross join {region} where r_regionkey < 4""",
    "fx_rpoints": """
select oid, street, point_index, easting + 125e-3 + (oid%4)*25e-2 as easting,
 northing + 375e-3 as northing from {fx_points}""",
    "fx_tiles": """
select case when r_regionkey=0 then 'tile_a' else 'tile_b' end as dem_tile,
 cast(r_regionkey+1 as int) as tile_rank,
 case when r_regionkey=0 then 599000e0 else 609994e0 end as left_e,
 case when r_regionkey=0 then 610006e0 else 621000e0 end as right_e,
 4160000e0 as bottom_n, 4490000e0 as top_n
from {region} where r_regionkey < 2""",
    "fx_cells": """
select dem_tile, cell_e, cell_n,
 case when (cell_e+cell_n)%997=0 then null
      else 100e0 + ((cell_e*7+cell_n*13)%64)/64e0 + case when dem_tile='tile_b' then 5e-1 else 0e0 end end as elev
from (select distinct t.dem_tile, cast(floor(p.easting) as int)+dx.d as cell_e,
             cast(floor(p.northing) as int)+dy.d as cell_n
      from {fx_rpoints} p
      cross join (select r_regionkey-1 as d from {region} where r_regionkey<3) dx
      cross join (select r_regionkey-1 as d from {region} where r_regionkey<3) dy
      join {fx_tiles} t on p.easting >= t.left_e and p.easting < t.right_e) c""",
}

_NEEDS = {v: [n for n in VIEWS if "{%s}" % n in VIEWS[v]] for v in VIEWS}
#: What is dealt out before a view multiplies its rows; by street or line, so windows along one need no further shuffle.
_DEALT = {"fx_points": {"fx_segments": "street"}, "fx_vertices": {"customer": "c_custkey"}}
#: Customers a task; each makes a segment of 101 points.
SEGMENTS = 2000
_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of VIEWS as a DataFrame."""
    sql = VIEWS[name]
    needed = {t: table(spark, sf_dir, t) for t in _TABLES if "{%s}" % t in sql}
    needed |= {v: view(spark, sf_dir, v) for v in _NEEDS[name]}
    for small, key in _DEALT.get(name, {}).items():
        needed[small] = needed[small].repartition(parts(spark, sf_dir), key)
    return spark.sql(sql, **needed)


def parts(spark: SparkSession, sf_dir: str) -> int:
    """Over how many tasks customers are dealt out: one each SEGMENTS of them, as many as a shuffle has and two a core at least.

    Their file is small and would be read by one task, which would make all that its rows multiply to; and a task stays
    as small as it is, however many rows there are.
    """
    customers = table(spark, sf_dir, "customer").count()
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * spark.sparkContext.defaultParallelism, -(-customers // SEGMENTS))


def ctes(*names: str) -> str:
    """The named views, with those they need, as the body of a WITH clause."""
    order: list[str] = []

    def add(v: str) -> None:
        for n in _NEEDS[v]:
            add(n)
        if v not in order:
            order.append(v)

    for n in names:
        add(n)
    plain = {n: n for n in (*_TABLES, *VIEWS)}
    return ",\n".join(f"{v} as ({VIEWS[v].format(**plain)})" for v in order)
