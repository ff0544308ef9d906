"""Small cases worked out by hand, and properties."""

import math
import random

import pytest
from pyspark.sql import functions as F

from rillmark.functions import geo
from rillmark.operators import inlets as I
from rillmark.operators import lines as G
from rillmark.operators import overview as O
from rillmark.operators import profile as C
from rillmark.operators import raster as R
from rillmark.operators import sags as D
from rillmark.operators import summary as S
from rillmark.sources import landed

M = math.degrees(1 / geo.MEAN_RADIUS)  # a metre of latitude in degrees


def line(spark, *metres):
    return spark.createDataFrame([(1, i, 10.0, m * M) for i, m in enumerate(metres)], "oid long, vertex_index int, lon double, lat double")


@pytest.mark.parametrize("metres,want", [((0, 1, 2.5), [0, 1.25, 2.5]), ((0, 0.4), [0, 0.4]), ((0, 0), [0, 0])])
def test_resample(spark, metres, want):
    assert [r.dist_along_m for r in G.resample(line(spark, *metres), 1.0).orderBy("point_index").collect()] == want


def test_points_along_odd_lines(spark):
    """Repeated vertices, one vertex, no length: resampling and points at distances, against the rule written as a loop."""
    rng = random.Random(8)
    lines = {1: [0, 0, 3, 3, 3, 10], 2: [0], 3: [0, 0, 0], 4: [0, 0.2], 5: sorted(rng.uniform(0, 40) for _ in range(30)), 6: [0, 7, 7, 21]}
    v = spark.createDataFrame([(o, i, 10.0, m * M) for o, ms in lines.items() for i, m in enumerate(ms)], "oid long, vertex_index int, lon double, lat double").repartition(5)
    d = {o: [r.dist_along_m for r in G.cumulative(v).where(F.col("oid") == o).orderBy("vertex_index").collect()] for o in lines}

    def at(o, t):
        lat = [m * M for m in lines[o]]
        if t <= 0 or t >= d[o][-1]:
            return lat[0] if t <= 0 else lat[-1]
        j = next(i for i in range(1, len(lat)) if d[o][i] >= t)
        span = d[o][j] - d[o][j - 1]
        return lat[j - 1] + ((t - d[o][j - 1]) / span if span else 0) * (lat[j] - lat[j - 1])

    got = sorted((r.oid, r.point_index, r.lat, r.dist_along_m) for r in G.resample(v, 1.5).collect())
    want = [(o, k, d[o][-1] * k / n) for o in lines for n in [max(1, round(d[o][-1] / 1.5))] for k in range(n + 1)]
    assert [g[:2] for g in got] == sorted(w[:2] for w in want)
    assert all(abs(g[2] - at(o, t)) < 6e-8 and abs(g[3] - t) < 6e-3 for g, (o, _, t) in zip(got, sorted(want)))
    targets = [(o, t) for o in lines for t in (-1.0, 0.0, 0.1, *d[o], d[o][-1] / 3, d[o][-1] + 5)]
    told = sorted((r.oid, r.t, r.pt.lat) for r in G.points_at(v, spark.createDataFrame(targets, "oid long, t double")).collect())
    assert len(told) == len(targets) and all(z == pytest.approx(at(o, t), abs=1e-12) for o, t, z in told)


def test_a_line_of_many_vertices(spark):
    """A hundred thousand vertices resampled to about as many points, which an array search a point would not end."""
    import time

    v = spark.range(100_000).select(F.lit(1).alias("oid"), F.col("id").cast("int").alias("vertex_index"), F.lit(10.0).alias("lon"), (F.col("id") * M).alias("lat"))
    began = time.time()
    r = G.resample(v, 1.0).agg(F.count("*").alias("n"), F.max("dist_along_m").alias("d")).first()
    assert r.n == 100_000 and abs(r.d - 99_999) < 1 and time.time() - began < 30


def test_label(spark):
    got = spark.createDataFrame([(10.0,), (1.0,), (0.5,)], "s double").select(geo.spacing_label(F.col("s")).alias("x")).collect()
    assert [r.x for r in got] == ["10m", "1m", "0p5m"]


def test_heading_repeats_last(spark):
    p = spark.createDataFrame([(1, 0, 0.0, 0.0), (1, 1, 1.0, 0.0), (1, 2, 2.0, 1.0)], "oid long, point_index int, easting double, northing double")
    assert [r.bearing_deg for r in G.step_heading(p).orderBy("point_index").collect()] == pytest.approx([90, 45, 45])


def ends(spark, *rows):
    p = [("S", o, float(i), float(x), 0.0) for o, xs in rows for i, x in enumerate(xs)]
    return C.segment_ends(spark.createDataFrame(p, "street string, oid long, dist_along_m double, easting double, northing double"))


def test_nodes_are_not_transitive(spark):
    got = C.junctions(ends(spark, (1, (0, 1.5)), (2, (3.0, 50.0)))).orderBy("x").collect()
    assert [(r.x, r.degree) for r in got] == [(0.75, 2), (3.0, 1), (50.0, 1)]
    assert C.junctions(ends(spark, (1, (0, 2.0)))).count() == 2


def test_chain_and_runs(spark):
    got = C.chain(ends(spark, (1, (0, 100)), (2, (200, 100)))).orderBy("seq").collect()
    assert [(r.oid, r.flip, r.gap_m, r.origin) for r in got] == [(1, False, 0, "W"), (2, True, 0, "W")]
    for far, runs in ((140.0, [0, 0]), (140.01, [0, 1])):
        got = C.with_runs(C.chain(ends(spark, (1, (0, 100)), (2, (far, 300))))).orderBy("seq").collect()
        assert [r.run for r in got] == runs


def test_closed_loop_has_an_origin(spark):
    p = [("S", o, float(i), *xy) for o, a, b in ((1, (0.0, 0.0), (9.0, 50.0)), (2, (9.0, 50.0), (90.0, 0.0)), (3, (90.0, 0.0), (0.0, 0.0))) for i, xy in enumerate((a, b))]
    got = C.chain(C.segment_ends(spark.createDataFrame(p, "street string, oid long, dist_along_m double, easting double, northing double"))).orderBy("seq").collect()
    assert [r.oid for r in got] == [1, 2, 3] and got[0].origin == "W"


def rows(spark, zs, step=1.0):
    return spark.createDataFrame([("S", 0, i, i * step, None if z is None else float(z)) for i, z in enumerate(zs)], "street string, run int, path_idx int, d double, smooth double")


def test_smooth(spark):
    got = C.smooth(rows(spark, [1, 2, 3, 4, 5]).withColumnRenamed("smooth", "elev_m"), 3).orderBy("path_idx").collect()
    assert [r.smooth for r in got] == [None, 2, 3, 4, None]


@pytest.mark.parametrize("zs,want", [((3, 1, 1, 3), {2: 2}), ((5, 1, 3, 0, 6), {1: 2, 3: 5}), ((5, 1, 4, 1, 6), {1: 4, 3: 4})])
def test_minima_and_prominence(spark, zs, want):
    assert {x.path_idx: x.prom for x in D.prominence(D.minima(rows(spark, zs), edge=0.0), least=0.0).collect()} == want


def test_prominence_and_suppression_against_brute_force(spark):
    rng = random.Random(4)
    zs = [rng.randint(0, 12) + rng.random() for _ in range(400)]
    low = D.prominence(D.minima(rows(spark, zs), edge=10.0), least=2.0)
    got = {x.path_idx: round(x.prom, 9) for x in D.suppress(low, separation=10.0).collect()}
    cands = []
    for i in range(10, 390):
        if zs[i] <= zs[i - 1] and zs[i] < zs[i + 1]:
            climb = []
            for way in (-1, 1):
                j, top = i + way, zs[i]
                while 0 <= j < 400 and zs[j] >= zs[i]:
                    top, j = max(top, zs[j]), j + way
                climb.append(top)
            if min(climb) - zs[i] >= 2:
                cands.append((-(min(climb) - zs[i]), i))
    kept = {}
    for key, i in sorted(cands):
        if all(abs(i - k) >= 10 for k in kept):
            kept[i] = round(-key, 9)
    assert got == kept and len(kept) > 5


@pytest.mark.parametrize("shape", ["random", "few values", "falling", "rising"])
def test_prominence_of_many_groups_over_many_batches(spark, shape):
    """The stack is carried from batch to batch and starts anew with each group; equal values and long slopes included."""
    rng, data = random.Random(shape), []
    for run in range(5):
        n = rng.randrange(3, 700)
        slope = {"falling": -0.7, "rising": 0.7}.get(shape, 0.0)
        data += [("S", run, i, float(i), float(rng.randrange(4)) if shape == "few values" else round(i * slope + rng.uniform(0, 9), 3)) for i in range(n)]
    df = spark.createDataFrame(data, "street string, run int, path_idx int, d double, smooth double").repartition(6)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = {(r.run, r.path_idx): r.prom for r in D.prominence(D.minima(df, edge=2.0), least=0.0).collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    want = {}
    for run in range(5):
        z = [x[4] for x in data if x[1] == run]
        for i in range(2, len(z) - 2):
            if z[i] <= z[i - 1] and z[i] < z[i + 1]:
                left = next((j for j in range(i - 1, -1, -1) if z[j] < z[i]), -1)
                right = next((j for j in range(i + 1, len(z)) if z[j] < z[i]), len(z))
                want[run, i] = min(max(z[left + 1 : i]), max(z[i + 1 : right])) - z[i]
    assert got == want and len(want) > 50


def test_prominence_of_one_long_run(spark):
    """A million rows and two hundred thousand minima in one run, of which many wait for lower ground at once."""
    import time

    n = 1_000_000
    wave = F.pmod(F.col("id") * 7919, F.lit(5)) * 1.0 + F.abs(F.col("id") - n // 2) * 1e-4
    df = spark.range(n).select(F.lit("S").alias("street"), F.lit(0).alias("run"), F.col("id").cast("int").alias("path_idx"), F.col("id").cast("double").alias("d"), wave.alias("smooth"))
    began = time.time()
    rows = D.minima(df)
    found = D.prominence(rows, least=0.2)
    kept = D.suppress(found, separation=10.0)
    a, b = found.count(), kept.count()
    assert a > 150_000 and 50_000 < b <= n / 10 and time.time() - began < 60


def test_suppression_order(spark):
    c = lambda *x: spark.createDataFrame([("S", i, d, p, 0.0) for i, (d, p) in enumerate(x)], "street string, path_idx int, d double, prom double, smooth double")
    assert [r.d for r in D.suppress(c((100.0, 0.5), (105.0, 0.6), (115.0, 0.3), (120.0, 0.4))).orderBy("d").collect()] == [105, 120]
    assert [r.d for r in D.suppress(c((100.0, 0.5), (110.0, 0.4))).orderBy("d").collect()] == [100, 110]


def serve(spark, sags, pairs):
    s = spark.createDataFrame(sags, "street string, sag_num int, d double, smooth double, easting double, northing double")
    p = spark.createDataFrame(pairs, "street string, num int, inlet_id long, chainage double, smooth_m double")
    got = I.served(I.candidates(s, p))
    return {r.sag_num: r.pick for r in got.collect()}, {r.sag_num: (r.near_num, r.gap_m, r.lift_m) for r in I.unserved(s, got, p).collect()}


def test_serving(spark):
    at = (600000.0, 4170000.0)
    got, rest = serve(spark, [("S", 1, 100.0, 5.0, *at), ("S", 2, 110.0, 5.0, *at), ("T", 1, 5.0, 5.0, *at)], [("S", 3, 9, 104.0, 5.0), ("S", 4, 8, 130.0, 5.0)])
    assert got == {1: 3} and rest[2] == (3, 6.0, 0.0) and (None, None, None) in rest.values()
    assert serve(spark, [("S", 1, 100.0, 5.0, *at)], [("S", 1, 9, 110.0, 4.75)])[0] == {}


@pytest.mark.parametrize("y,inside", [(30.0, False), (29.99, True)])
def test_snap_border_is_strict(spark, y, inside):
    p = spark.createDataFrame([("S", i, float(i), float(i), 0.0, 1.0, 1.0) for i in range(11)], "street string, path_idx int, d double, easting double, northing double, elev_m double, smooth double")
    i = spark.createDataFrame([(1, 5.0, y), (2, None, None), (3, 0.5, 0.0)], "inlet_id long, x double, y double")
    got = {r.inlet_id: r.path_idx for r in I.snap(i, p).collect()}
    assert got == ({1: 5, 3: 0} if inside else {3: 0})


@pytest.mark.parametrize("most", [3, 4096])
def test_snap_in_crowded_cells(spark, most):
    """Cells that are split by count on either side give the pairs that a plain search gives."""
    rng = random.Random(9)
    points = [(f"S{k % 3}", k, float(k), round(rng.uniform(0, 70), 2), round(rng.uniform(0, 70), 2), 1.0, 1.0) for k in range(150)]
    inlets = [(k, round(rng.uniform(20, 40), 2), round(rng.uniform(20, 40), 2)) for k in range(200)]
    p = spark.createDataFrame(points, "street string, path_idx int, d double, easting double, northing double, elev_m double, smooth double")
    got = {(r.street, r.inlet_id): r.path_idx for r in I.snap(spark.createDataFrame(inlets, "inlet_id long, x double, y double"), p, most=most).collect()}
    want = {}
    for i, x, y in inlets:
        for s in ("S0", "S1", "S2"):
            near = [((x - e) ** 2 + (y - n) ** 2, k) for t, k, _, e, n, *_ in points if t == s]
            if min(near)[0] <= 900:
                want[s, i] = min(near)[1]
    assert got == want


def test_a_crowded_cell_is_dealt_out(spark):
    """Two hundred thousand inlets and a thousand points in one cell: no part of it has more than 4096 of either."""
    i = spark.range(200_000).select(F.col("id").alias("inlet_id"), F.lit(1).alias("gx"), F.lit(1).alias("gy"))
    q = spark.range(10_000).select(F.col("id").alias("path_idx"), F.lit(1).alias("gx"), F.lit(1).alias("gy"))
    a, b = I.in_shares(i, q, ("gx", "gy"), "inlet_id", "path_idx", 4096)
    for df, n in ((a, 200_000 * 3), (b, 10_000 * 49)):
        parts = [r["count"] for r in df.groupBy("_l", "_r").count().collect()]
        assert sum(parts) == n and len(parts) == 49 * 3 and max(parts) < 1.15 * 4096


def test_clean(spark):
    i = spark.createDataFrame([(1, 299.9, 249.9, None), (2, 300.0, 250.0, "x"), (3, 900.0, None, "x")], "inlet_id long, top_of_grate_ft double, invert_ft double, type_description string")
    got = I.clean(i).orderBy("inlet_id").collect()
    assert [r.grate_m for r in got] == [None, pytest.approx(92.234), pytest.approx(275.114)]
    assert [r.invert_m for r in got] == [None, pytest.approx(76.994), None] and got[0].type == "Unknown"


def test_same_cell_and_bilinear(spark):
    p = spark.createDataFrame([(1, 0, 1.2, 1.2), (1, 1, 1.8, 1.1), (1, 2, 2.5, 1.5), (2, 0, 2.6, 1.6)], "oid long, point_index int, easting double, northing double")
    assert [r.same_cell_as_prev for r in R.same_cell_as_before(R.cell_ids(p)).orderBy("oid", "point_index").collect()] == [False, True, False, False]
    cells = [("t", x, y, z) for y in (0, 1) for x, z in ((0, 10.0), (1, 14.0))]
    at = spark.createDataFrame([(1, 0.75, 0.5, "t", 1)], "oid long, easting double, northing double, dem_tile string, tile_rank int")
    for c, want in ((cells, 11.0), ([*cells[:3], ("t", 1, 1, None)], None)):
        df = spark.createDataFrame(c, "dem_tile string, cell_e int, cell_n int, elev double")
        assert R.bilinear(at, df).first().elev_m == want


@pytest.mark.parametrize("side", [1, 3, 8, 64])
def test_blocks_of_any_size_read_alike(spark, side):
    """Full and ragged blocks, gaps, seams and corners: sampling, mosaic and shade as from the cells themselves."""
    import numpy as np

    rng = random.Random(side)
    z = {("a", e, n): None if rng.random() < 0.05 else round(rng.uniform(90, 110), 2) for e in range(-9, 17) for n in range(-5, 12) if rng.random() < 0.97}
    z |= {("b", e, n): round(rng.uniform(90, 110), 2) for e in range(12, 30) for n in range(-5, 12)}
    cells = spark.createDataFrame([(*k, v) for k, v in z.items()], "dem_tile string, cell_e int, cell_n int, elev double")
    where = [(i, rng.choice("ab"), rng.uniform(-11, 31), rng.uniform(-6, 13)) for i in range(300)]
    points = spark.createDataFrame(where, "oid int, dem_tile string, easting double, northing double")
    got = {r.oid: (r.elev_m, r.elev_cell_m) for r in R.sample(points, R.blocks(cells, side), side).collect()}
    assert len(got) == 300
    for i, t, e, n in where:
        c, r = math.floor(e - 0.5), math.floor(n - 0.5)
        u, v = e - 0.5 - c, n - 0.5 - r
        four = [z.get((t, c + a, r + b)) for a, b in ((0, 0), (1, 0), (0, 1), (1, 1))]
        want = None if None in four else sum(w * x for w, x in zip(((1 - u) * (1 - v), u * (1 - v), (1 - u) * v, u * v), four, strict=True))
        assert got[i][0] == (None if want is None else pytest.approx(want, abs=1e-9)) and got[i][1] == z.get((t, round(e - 0.5), round(n - 0.5)))
    tiles = spark.createDataFrame([("a", 1), ("b", 2)], "dem_tile string, tile_rank int")
    one = {(r.cell_e, r.cell_n): r.elev for r in R.mosaic(cells, tiles, side=side).collect()}
    first = {}
    for (t, e, n), v in sorted(z.items()):
        if v is not None:
            first.setdefault((e, n), v)
    assert one == first
    shade = {(r.dem_tile, r.cell_e, r.cell_n): r.shade for r in R.hillshade(cells, by=("dem_tile",), side=side).collect()}
    assert set(shade) == set(z)
    mid = {t: float(np.median([v for k, v in z.items() if k[0] == t and v is not None])) for t in "ab"}
    full = {k: 3 * (mid[k[0]] if v is None else v) for k, v in z.items()}
    for (t, e, n), v in full.items():
        step = lambda p, q: (q - p) / 2 if p is not None and q is not None else q - v if q is not None else v - p if p is not None else 0.0  # noqa: B023, E731
        gx, gy = step(full.get((t, e - 1, n)), full.get((t, e + 1, n))), step(full.get((t, e, n - 1)), full.get((t, e, n + 1)))
        az, alt = math.radians(-225), math.radians(45)
        want = (-gx * math.cos(az) * math.cos(alt) - gy * math.sin(az) * math.cos(alt) + math.sin(alt)) / math.sqrt(gx * gx + gy * gy + 1)
        assert shade[t, e, n] == pytest.approx(want, abs=2e-6)
    plan = R.hillshade(cells, by=("dem_tile",), side=side)._jdf.queryExecution().optimizedPlan().toString()
    assert "lag(" not in plan and "lead(" not in plan


def test_boundless_window(spark):
    cells = spark.createDataFrame([(0, 0, 1.0), (1, 0, -9.0), (1, 1, None), (5, 5, 7.0)], "cell_e int, cell_n int, elev double")
    got = {(r.cell_e, r.cell_n): r.elev for r in R.boundless_window(cells, -1, 0, 2, 2, nodata=-9.0).collect()}
    assert got == {(e, n): 1.0 if (e, n) == (0, 0) else -9.0 for e in (-1, 0, 1) for n in (0, 1)}
    got = [r.elev for r in R.boundless_window(cells, -1, 0, 2, 2).collect()]
    assert len(got) == 6 and sorted(x for x in got if x is not None) == [-9.0, 1.0]
    assert R.boundless_window(cells, 3, 3, 3, 9).count() == 0


def test_names_bins_islands_centres(spark):
    n = S.safe_names(spark.createDataFrame([("A ST",), ("A-ST",), ("***",)], "street string")).collect()
    assert {r.street: r.file_key for r in n} == {"A ST": "A_ST", "A-ST": "A_ST__1", "***": "UNNAMED"}
    b = spark.createDataFrame([(k,) for k in (0, 1, 2, 3, 4, 5, 9, 10, 29)], "n int").select(O.sag_bin(F.col("n"))["bin"].alias("b"))
    assert [r.b for r in b.collect()] == [0, 1, 2, 3, 3, 4, 4, 5, 5]
    f = spark.createDataFrame([("S", 1, d, 0.0, 0.0) for d in (10.0, 15.0, 21.0)] + [("S", 2, 21.0, 0.0, 0.0)], "street string, oid long, dist_along_m double, easting double, northing double")
    assert sorted((r.oid, r.n) for r in O.islands(f).collect()) == [(1, 1), (1, 2), (2, 1)]
    c = spark.createDataFrame([("S", 0.0, 0.0, 3), ("S", 30.0, 0.0, 1)], "street string, x double, y double, n long")
    assert [tuple(r) for r in O.merge_centres(c).collect()] == [("S", 0, 7.5, 0.0, 4)]


def test_projection_round_trip(spark):
    p = spark.createDataFrame([(-121.768, 37.6819), (-124.5, 40.0), (-120.1, 33.3)], "lon double, lat double")
    e, n = geo.to_utm(F.col("lon"), F.col("lat"))
    q = p.select("lon", "lat", e.alias("e"), n.alias("n"))
    lon, lat = geo.from_utm(F.col("e"), F.col("n"))
    got = q.select("lon", "lat", "e", "n", lon.alias("lon2"), lat.alias("lat2")).collect()
    assert (round(got[0].e, 3), round(got[0].n, 3)) == (608633.998, 4171236.123)
    assert all(abs(r.lon - r.lon2) < 1e-11 and abs(r.lat - r.lat2) < 1e-11 for r in got)


def test_sinks_and_pages(spark, tmp_path):
    df = spark.createDataFrame([(1, 2.5), (2, None)], "a int, b double")
    landed.write_csv(df, f"{tmp_path}/c")
    landed.write_parquet(df, f"{tmp_path}/p")
    assert spark.read.schema("a int, b double").option("header", True).csv(f"{tmp_path}/c").orderBy("a").collect() == df.orderBy("a").collect()
    assert spark.read.parquet(f"{tmp_path}/p").count() == 2
    page = '{"features":[{"attributes":{"OBJECTID":1},"geometry":{"x":1.0,"y":2.0}},{"attributes":{"OBJECTID":2}}],"properties":{"exceededTransferLimit":true}}'
    pages = spark.createDataFrame([("s", 0, page), ("s", 2, '{"error":{"code":1,"message":"x"}}'), ("s", 9, '{"features":[]}')], "source string, page_offset long, json string")
    got = landed.audit_pages(pages).orderBy("page_offset").collect()
    assert [(r.n_features, r.more, r.failed, r.contiguous) for r in got] == [(2, True, False, True), (0, False, True, True), (0, False, False, False)]
    pts = landed.esri_points(landed.pages_features(pages), {"OBJECTID": "long"}).orderBy("OBJECTID").collect()
    assert [tuple(r) for r in pts] == [(1, 1.0, 2.0), (2, None, None)]


def test_rejects(spark, tmp_path):
    rows = spark.createDataFrame([(1, '{"type":"Feature","properties":{"OBJECTID":"1"}}'), (2, "{"), (3, ""), (4, None), (5, '{"type":"Feature","geometry":{"type":"LineString","coordinates":"x"}}'), (6, '\ufeff{"type":"Feature"}')], "k int, json string")
    good, bad = landed.checked_json(rows, landed.LINE_FEATURE)
    assert sorted(r.k for r in good.collect()) == [1, 6] and sorted(r.k for r in bad.collect()) == [2, 3, 4, 5] and "_corrupt_record" not in good.schema["f"].dataType.names
    lines = spark.createDataFrame([("a,b",), ("1,2.5",), ("x,2",), ("3",), ("4,5,6",), (None,), ("",), ("7,",)], "value string")
    good, bad = landed.checked_csv(lines, "a int, b double", header="a,b")
    assert sorted((r.f.a, r.f.b) for r in good.collect()) == [(1, 2.5), (7, None)] or sorted((r.f.a, r.f.b or 0) for r in good.collect()) == [(1, 2.5), (7, 0)]
    assert sorted(r.value or "" for r in bad.collect()) == ["", "", "3", "4,5,6", "x,2"]
    for stage in ("csv", "json"):
        landed.write_rejects(bad if stage == "csv" else landed.checked_json(rows, landed.LINE_FEATURE)[1].select(F.col("json").alias("value")), f"{tmp_path}/rejects", stage)
    back = {r.stage: r["count"] for r in spark.read.json(f"{tmp_path}/rejects").groupBy("stage").count().collect()}
    assert back == {"csv": 5, "json": 4}


def test_bucketed_store(spark, tmp_path):
    """Written and opened again by keys alone: groups, windows and joins on the key read it without an exchange."""
    from rillmark.sources import store

    df = spark.range(1000).select((F.col("id") % 37).cast("string").alias("street"), F.col("id").alias("path_idx"), (F.col("id") * 1.5).alias("d"))
    a = store.write_buckets(df, f"file://{tmp_path}/a", ("street",), ("path_idx",), 5)
    b = store.open_buckets(spark.newSession(), f"file://{tmp_path}/a", "street string, path_idx long, d double", ("street",), ("path_idx",), 5)
    assert sorted(b.collect()) == sorted(df.collect())
    joined = a.groupBy("street").agg(F.max("d").alias("m")).join(C.smooth(a.withColumn("run", F.lit(0)), 3, z="d"), "street")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and joined.count() == 1000
    twice = a.unionByName(store.write_buckets(df, f"file://{tmp_path}/b", ("street",), ("path_idx",), 5)).groupBy("street").count()
    assert twice.count() == 37 and {r.street for r in twice.collect()} == {str(i) for i in range(37)}  # a union of bucketed tables is grouped as a whole
    store.drop(a)
    assert not (tmp_path / "a").exists()


def test_kept_tables_outlive_the_cache_and_follow_their_sources(spark, tmp_path):
    from rillmark.sources.store import Kept

    kept, made = Kept(), []
    source = f"file://{tmp_path}/s"

    def make():
        made.append(1)
        return spark.read.parquet(source)

    def get():
        return kept.get(spark, ("x",), make, (source,))

    spark.createDataFrame([("a", 1)], "street string, v int").write.parquet(source)
    assert get().count() == 1
    spark.catalog.clearCache()
    assert get().count() == 1 and len(made) == 1 and "store_" in get()._store[0]
    spark.createDataFrame([("b", 2)], "street string, v int").write.mode("append").parquet(source)
    assert get().count() == 2 and len(made) == 2
    kept.release()
    assert get().count() == 2 and len(made) == 3
    kept.release()


def test_path_modes(spark, tiny):
    from rillmark.sources.fixtures import view

    points = view(spark, tiny, "fx_points").where("s < 4")
    chained = C.with_runs(C.chain(C.segment_ends(points)))
    every, known = C.path(points, chained), C.path(points, chained, drop_null_z=True)
    assert every.count() == points.count() and known.count() == points.where("elev_m is not null").count()
    back = points.withColumn("dist_along_m", 100 - F.col("dist_along_m")).withColumn("point_index", 100 - F.col("point_index"))
    a, b = (S.street_index(p, g, s, v).orderBy("street").collect() for p, g, s, v in (analysis(spark, tiny, x) for x in (points, back)))
    assert a == b  # segments stored backwards change nothing
    steps = every.groupBy("street").agg(F.array_sort(F.collect_list(F.struct("path_idx", "d"))).alias("x")).collect()
    assert all(p.d <= q.d for r in steps for p, q in zip(r.x, r.x[1:], strict=False))


def analysis(spark, tiny, points):
    from rillmark.sources.fixtures import view

    p = C.profiles(points)
    pairs, sags = I.number(I.snap(view(spark, tiny, "fx_inlets"), p)), D.find_sags(p)
    return p, pairs, sags, I.served(I.candidates(sags, pairs))


def test_exact_quantiles_by_groups(spark):
    import numpy as np

    from rillmark.operators.order import quantiles

    rng = np.random.default_rng(3)
    rows = [("a", float(x)) for x in rng.normal(size=301)] + [("b", float(x)) for x in rng.integers(0, 4, 500)] + [("c", 7.0), ("d", None), ("e", 1e9), ("e", -1e9)]
    df = spark.createDataFrame(rows, "g string, v double")
    shares = (0.0, 0.02, 0.5, 0.77, 1.0)
    for bins in (1, 7, 1024):
        got = {r[0]: list(r)[1:] for r in quantiles(df, "v", shares, ("g",), bins=bins).collect()}
        for g in "abce":
            want = np.quantile([v for k, v in rows if k == g], shares)
            assert np.allclose(got[g], want)
        assert "d" not in got
        whole = list(quantiles(df, "v", shares, bins=bins).first())
        assert np.allclose(whole, np.quantile([v for _, v in rows if v is not None], shares))


def test_every_nth_is_the_nth_of_the_order(spark):
    from rillmark.operators.order import every_nth

    rows = [(i % 37, i) for i in range(500)]
    df = spark.createDataFrame(rows, "a int, b int").repartition(7)
    for bins in (1, 4, 256):
        got = sorted((r.a, r.b) for r in every_nth(df, 9, "a", "b", bins=bins).collect())
        assert got == sorted(rows)[::9]


def test_chain_and_junctions_against_plain_loops(spark):
    """Random segments, with ties and near ends, against the rules written as loops."""
    import math
    import random

    from rillmark.operators import profile as C

    rng = random.Random(6)
    streets, rows = {}, []
    for s in range(12):
        segments = []
        for oid in rng.sample(range(1000), rng.randrange(1, 12)):
            x, y = (round(rng.uniform(0, 60)) + rng.choice((0.0, 0.0, 0.5, 1.5)) for _ in range(2))
            u, v = x + rng.choice((-20, 0, 20)), y + rng.choice((-20, 0, 20, 1))
            segments.append((oid, x, y, u, v))
            rows += [(f"s{s}", oid, 0.0, x, y), (f"s{s}", oid, 30.0, u, v)]
        streets[f"s{s}"] = sorted(segments)
    points = spark.createDataFrame(rows, "street string, oid long, dist_along_m double, easting double, northing double")
    ends = C.segment_ends(points)
    nodes, chained = {}, {}
    for r in C.junctions(ends).orderBy("street", "node").collect():
        nodes.setdefault(r.street, []).append((r.x, r.y, r.degree))
    for r in C.chain(ends).orderBy("street", "seq").collect():
        chained.setdefault(r.street, []).append((r.oid, r.flip, r.gap_m))
    for name, segments in streets.items():
        seeds = []
        for oid, x, y, u, v in segments:
            for p in ((x, y), (u, v)):
                home = next((g for g in seeds if math.sqrt((g[0][0] - p[0]) ** 2 + (g[0][1] - p[1]) ** 2) < 2.0), None)
                if home is None:
                    seeds.append([p])
                else:
                    home.append(p)
        want = [(sum(p[0] for p in g) / len(g), sum(p[1] for p in g) / len(g), len(g)) for g in seeds]
        assert nodes[name] == want
        xs, ys = [c for _, x, _, u, _ in segments for c in (x, u)], [c for _, _, y, _, v in segments for c in (y, v)]
        open_ = [w for w in want if w[2] == 1] or want
        here = (min(open_, key=lambda w: w[0]) if max(xs) - min(xs) >= max(ys) - min(ys) else max(open_, key=lambda w: w[1]))[:2]
        left, out = list(segments), []
        while left:
            best = None
            for s in left:
                for end, p in ((0, s[1:3]), (1, s[3:5])):
                    d = math.sqrt((p[0] - here[0]) ** 2 + (p[1] - here[1]) ** 2)
                    if best is None or d < best[0]:
                        best = (d, s, end)
            d, s, end = best
            out.append((s[0], end == 1, d if out else 0.0))
            here = s[1:3] if end else s[3:5]
            left.remove(s)
        assert chained[name] == out


def test_a_street_of_many_segments(spark):
    """Twenty thousand segments, in clusters with long ways between them, against the rule as a plain loop over all free ends."""
    import time

    import numpy as np

    n, rng = 20_000, np.random.default_rng(4)
    cluster = rng.integers(0, 12, n)
    x, y = np.round(rng.uniform(0, 900, n) + cluster % 4 * 60_000, 1), np.round(rng.uniform(0, 900, n) + cluster // 4 * 90_000, 1)
    u, v = x + rng.choice([-8.0, 0.0, 8.0], n), y + rng.choice([-8.0, 0.0, 8.0], n)
    ends = spark.createDataFrame([("S", i, *map(float, (x[i], y[i], u[i], v[i], min(x[i], u[i]), max(x[i], u[i]), min(y[i], v[i]), max(y[i], v[i])))) for i in range(n)], "street string, oid long, e0 double, n0 double, e1 double, n1 double, w double, x double, s double, t double")
    began = time.time()
    got = C.chain(ends).orderBy("seq").collect()
    took = time.time() - began
    start = C.origins(C.junctions(ends), ends).first()
    ex, ey = np.column_stack([x, u]).ravel(), np.column_stack([y, v]).ravel()
    free, here, want = np.ones(2 * n, bool), (start.x, start.y), []
    for seq in range(n):
        dx, dy = ex - here[0], ey - here[1]
        gap = np.where(free, np.sqrt(dx * dx + dy * dy), np.inf)
        end = int(np.argmin(gap))
        want.append((end // 2, end % 2 == 1, float(gap[end]) if seq else 0.0))
        free[[end, end ^ 1]] = False
        here = (ex[end ^ 1], ey[end ^ 1])
    assert [(r.oid, r.flip, r.gap_m) for r in got] == want and took < 60
