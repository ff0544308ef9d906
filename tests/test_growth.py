"""Queries on tables that are larger, or numbered higher, than the smallest ones."""

import duckdb
import pytest
from pyspark.sql import functions as F

from rillmark.plans.registry import ORACLES, QUERIES

TABLES = "region nation customer part".split()


@pytest.fixture(scope="module")
def high(tiny, tmp_path_factory):
    """Customers around 5,000 and 50,000, whose streets have numbers of four and five digits that begin alike."""
    at = tmp_path_factory.mktemp("high")
    d = duckdb.connect()
    for t in TABLES:
        rows = f"'{tiny}/{t}.parquet'"
        if t == "customer":
            rows = f"(select * replace (c_custkey+i as c_custkey) from {rows}, (select unnest([4995, 49995]) as i))"
        d.sql(f"copy (select * from {rows}) to '{at}/{t}.parquet' (format parquet)")
    return str(at)


@pytest.mark.parametrize("name", ["c10_known_elevations", "c4_origin", "c5_chain", "c6_runs", "c7_path_index", "c8_chainage", "c9_smooth_25", "d2_minima", "d4_prominence", "d5_sags", "s1_profile_index"])
def test_streets_of_five_digits_are_not_mixed_up(spark, high, name):
    d = duckdb.connect()
    for t in TABLES:
        d.sql(f"create view {t} as select * from '{high}/{t}.parquet'")
    got, want = QUERIES[name](spark, high), d.sql(ORACLES[name])
    cols = sorted(got.columns)
    a = sorted(repr([r[c] for c in cols]) for r in got.collect())
    b = sorted(repr([r[want.columns.index(c)] for c in cols]) for r in want.fetchall())
    assert a == b and a
    assert got.select("street").distinct().where(F.length("street") > len("STREET 0000")).count() > 0


def test_scales_beyond_the_ladder_take_its_last_step(spark):
    from rillmark.operators import charts

    r = spark.createDataFrame([("A", 300.0, 1.0, 2.0), ("B", 1e6, 1.0, 2.0)], "street string, length double, lo double, hi double")
    assert {x.street: (x.h_mpp, x.width_px) for x in charts.profile_scale(r).collect()} == {"A": (0.5, 600.0), "B": (200.0, 1400.0)}
    b = spark.createDataFrame([("A", 0.0, 100.0, 0.0, 100.0, 1.0), ("B", 0.0, 1e6, 0.0, 10.0, 1.0)], "street string, x0 double, x1 double, y0 double, y1 double, scale double")
    assert {x.street: x.m_mpp for x in charts.map_scale(b).collect()} == {"A": 0.25, "B": 100.0}


def test_a_street_across_the_country_meets_few_cells(spark):
    from rillmark.operators import summary

    # A box of 1e8 by 1e8 m has 4e10 squares of 500 m.
    ends = {"A": (0.0, 0.0, 1e8, 1e8), "B": (1e3, 1e3, 1.2e3, 1e3), "C": (-64.0, -64.0, 64.0, 64.0), "D": (0.0, 2e4, 4.1e3, 2e4)}
    p = spark.createDataFrame([(s, x, y) for s, (a, b, c, d) in ends.items() for x, y in ((a, b), (c, d))], "street string, easting double, northing double")
    at = [(-30.0, -30.0), (94.0, 94.0), (1e3, 1.03e3), (1e3, 1030.5), (1.23e3, 970.0), (1.1e3, 1e3), (1e8 + 30, 5e7), (1e8 + 31, 5e7), (4.13e3, 2e4), (0.0, 2e4), (2e3, 19971.0), (-94.0, 0.0)]
    i = spark.createDataFrame([(k, x, y) for k, (x, y) in enumerate(at)], "inlet_id int, x double, y double")
    want = {s: sum(a - 30 <= x <= c + 30 and b - 30 <= y <= d + 30 for x, y in at) for s, (a, b, c, d) in ends.items()}
    got = {r.street: r.n_near for r in summary.sample_candidates(p, i, least=1).collect()}
    assert got == {s: n for s, n in want.items() if n}


def test_rows_are_dealt_out_before_they_multiply(spark, tiny):
    from rillmark.sources.fixtures import view

    for name in ("fx_points", "fx_vertices"):
        assert view(spark, tiny.replace("sf0.001", "sf0.1"), name).rdd.getNumPartitions() >= 2 * spark.sparkContext.defaultParallelism


def test_a_raster_is_not_broadcast(spark):
    from rillmark.operators import raster as R

    p = spark.createDataFrame([(1, 5.2, 5.7, "t", 1)], "oid int, easting double, northing double, dem_tile string, tile_rank int")
    cells = spark.range(100).selectExpr("'t' as dem_tile", "cast(id / 10 as int) as cell_e", "cast(id % 10 as int) as cell_n", "cast(id as double) as elev")
    plan = R.bilinear(p, cells)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_cells_that_no_point_of_their_tile_can_meet_are_left_out(spark):
    from rillmark.operators import raster as R

    tile = spark.createDataFrame([("t", 1, 2.0, 8.5, 3.0, 7.0)], "dem_tile string, tile_rank int, left_e double, right_e double, bottom_n double, top_n double")
    cells = spark.range(100).selectExpr("'t' as dem_tile", "cast(id / 10 as int) as cell_e", "cast(id % 10 as int) as cell_n", "cast(id as double) as elev")
    kept = {(r.cell_e, r.cell_n) for r in R.in_bounds(cells, tile).collect()}
    assert kept == {(e, n) for e in range(2, 9) for n in range(3, 7)}
    p = spark.range(4000).selectExpr("id as oid", "id % 63 / 6.3 as easting", "id / 400 as northing")
    placed = R.in_tiles(p, tile)
    read = lambda c: sorted(map(tuple, R.sample(placed, R.blocks(c)).select("oid", "elev_m", "elev_cell_m").collect()))
    assert read(R.in_bounds(cells, tile)) == read(cells) and placed.count() > 100


def test_quantiles_of_few_groups_are_spread(spark):
    from rillmark.operators.order import SPREAD, quantiles

    df = spark.range(9000).selectExpr("id % 2 as g", "cast(id as double) as v")
    assert {r.g: r.q0 for r in quantiles(df, "v", (0.5,), ("g",)).collect()} == {0: 4499.0, 1: 4500.0}
    plan = quantiles(df, "v", (0.5,), ("g",))._jdf.queryExecution().optimizedPlan().toString()
    assert SPREAD > 1 and "_part" in plan


def test_points_that_lie_by_street_are_sent_nowhere(spark, tiny):
    """F35 and what shares its step: no point meets its segment by street and line, or its run by street and run."""
    import re

    for name in ("c9_smooth_10", "d2_minima"):
        plan = QUERIES[name](spark, tiny)._jdf.queryExecution().executedPlan().toString()
        assert re.search(r"hashpartitioning\(street#\d+, \d+\), REPARTITION_BY_NUM", plan) and not re.search(r"hashpartitioning\(street#\d+, run#|Join \[street#\d+, oid#", plan)


def test_tasks_are_as_many_as_customers_need(spark, tiny, monkeypatch):
    from rillmark.sources import fixtures

    few = fixtures.parts(spark, tiny)
    monkeypatch.setattr(fixtures, "SEGMENTS", 2)
    assert fixtures.parts(spark, tiny) == 75 > few


def test_points_are_sent_once_to_meet_inlets(spark):
    import re

    from rillmark.operators import inlets as I

    p = spark.createDataFrame([("A", k, float(k), float(k), 0.0, 1.0, 1.0) for k in range(9)], "street string, path_idx int, d double, easting double, northing double, elev_m double, smooth double")
    i = spark.createDataFrame([(1, 3.2, 1.0), (2, 99.0, 0.0)], "inlet_id long, x double, y double")
    got = I.snap(i, p.withColumn("other", p.d + 0.5), also=("other",), parts=7)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert [(r.inlet_id, r.path_idx, r.other) for r in got.collect()] == [(1, 3, 3.5)]
    assert len(re.findall(r"hashpartitioning\(gx#\w+, gy#\w+, _l#", plan)) == 2 and not re.search(r"SortMergeJoin \[gx#\w+, gy#\w+\], \[[^]]*\], LeftOuter", plan)


def test_a_place_among_many_cuts_is_found_by_halving(spark):
    from rillmark.operators.order import _among, every_nth

    cuts = [float(c) for c in range(0, 300, 3)]
    got = spark.range(-2, 310).select("id", _among(F.col("id"), cuts).alias("n")).collect()
    assert all(r.n == sum(c < r.id for c in cuts) for r in got)
    df = spark.range(1000).selectExpr("id div 7 as a", "id % 7 as b")
    assert sorted((r.a, r.b) for r in every_nth(df, 25, "a", "b").collect()) == [(k // 7, k % 7) for k in range(0, 1000, 25)]


def test_a_segment_without_heights_keeps_the_others_in_place(spark):
    """Points find their segment by number, also where all points of an earlier one are left out."""
    from rillmark.operators import profile as C

    rows = [("A", oid, float(i), 10.0 * k + i, 0.0, None if oid == 5 else 1.0) for k, oid in enumerate((9, 5, 7)) for i in range(11)]
    p = spark.createDataFrame(rows, "street string, oid long, dist_along_m double, easting double, northing double, elev_m double")
    got = C.path(p, C.with_runs(C.chain(C.segment_ends(p))), drop_null_z=True).orderBy("path_idx").collect()
    assert [(r.oid, r.seq) for r in got] == [(9, 0)] * 11 + [(7, 2)] * 11 and [r.easting for r in got] == sorted(r.easting for r in got)


def test_terrain_that_is_made_is_read_as_a_raster_is(spark):
    """sample_made() against sample() on the same cells, also below zero, on borders of blocks, where cells are null and where points repeat."""
    from rillmark.operators import raster as R

    height = lambda e, n: F.when(F.pmod(e * 3 + n, F.lit(11)) != 0, e * 0.25 + F.pmod(n, F.lit(7)))
    p = spark.range(3000).selectExpr("concat('S', id % 3) as street", "id as oid", "round(id % 61 / 3.05e0 - 10, 3) as easting", "round(id % 47 / 2.35e0 - 9, 3) as northing")
    p = p.unionByName(p.where("oid < 50")).unionByName(spark.createDataFrame([("S0", 9000, None, 1.0), (None, 9001, 2.5, 4.0)], "street string, oid long, easting double, northing double"))
    cells = spark.range(60 * 60).selectExpr("'t' as dem_tile", "cast(id / 60 as int) - 30 as cell_e", "cast(id % 60 as int) - 30 as cell_n").withColumn("elev", height(F.col("cell_e"), F.col("cell_n")))
    rows = lambda df: sorted(map(repr, df.select(*p.columns, "elev_m", "elev_cell_m").collect()))
    want = rows(R.sample(p.withColumn("dem_tile", F.lit("t")), R.blocks(cells)))
    assert all(rows(R.sample_made(p, height, "street", side)) == want for side in (1, 4)) and len(want) == 3052
    assert any("elev_m=None" in r for r in want) and any("elev_m=None" not in r for r in want)
    plan = R.sample_made(p.repartition(5, "street"), height, "street")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning(") == 1 and "Join" not in plan


def test_the_lineage_sends_no_cells(spark, tiny, monkeypatch):
    """lines are dealt out by street before they make points, and neither points nor cells are sent to get their height."""
    import re

    from rillmark.plans import lineage

    made = {}
    monkeypatch.setattr(lineage, "keep", lambda spark, sf, name, make, *rest, **more: made.setdefault(name, make()))
    QUERIES["lineage_street_index"](spark, tiny)
    for df in made.values():
        plan = df._jdf.queryExecution().executedPlan().toString()
        dealt = set(re.findall(r"hashpartitioning\((.*?), \d+\)", plan))
        assert dealt and all(re.fullmatch(r"street#\d+L?|c_custkey#\d+L?", d) for d in dealt), dealt


def test_the_lineage_has_the_terrain_of_its_sql_south_of_the_equator(spark):
    from rillmark.plans import lineage

    at = [(e, n) for e in (-401, -5, 0, 7, 399, 612345) for n in (-7_500_001, -301, -7, 0, 8, 4_170_000)]
    got = spark.createDataFrame(at, "e int, n int").select("e", "n", lineage.surface(F.col("e"), F.col("n")).alias("z")).collect()
    want = {(e, n): duckdb.sql(f"select {lineage.WAVE.format(e=f'({e})', n=f'({n})')}").fetchall()[0][0] for e, n in at}
    assert {(r.e, r.n): r.z for r in got} == want
