"""Every query with SQL against DuckDB on the smallest tables, and the totals stated for the fixture."""

import re

import duckdb
import pytest

from rillmark.plans.registry import FLAGSHIP, ORACLES, QUERIES

TABLES = "region nation customer supplier part orders lineitem events".split()
KINDS = {"BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DOUBLE": "double", "BOOLEAN": "boolean"}


@pytest.fixture(scope="module")
def duck(tiny):
    d = duckdb.connect()
    for t in TABLES:
        d.sql(f"create view {t} as select * from '{tiny}/{t}.parquet'")
    return d


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_as_sql(spark, tiny, duck, name):
    got = QUERIES[name](spark, tiny)
    want = duck.sql(ORACLES[name])
    assert sorted(got.columns) == sorted(want.columns)
    cols = sorted(got.columns)
    assert [got.schema[c].dataType.simpleString() for c in cols] == [KINDS.get(str(want.types[want.columns.index(c)])) for c in cols]
    a = sorted(repr([r[c] for c in cols]) for r in got.collect())
    b = sorted(repr([r[want.columns.index(c)] for c in cols]) for r in want.fetchall())
    spark.catalog.clearCache()
    assert a == b and a


def test_totals(spark, tiny):
    t = QUERIES["s4_totals"](spark, tiny).first()
    assert (t.streets, t.inlets, t.sags, t.served, t.unserved) == (30, 184, 117, 61, 56)
    d = QUERIES["s8_variant_diff"](spark, tiny).first()
    assert (d.sags_b, d.unserved_b) == (117, 63)
    assert QUERIES["s6_sample"](spark, tiny).collect() == QUERIES["s6_sample"](spark, tiny).collect()
    assert all(re.search(r"viewpoint=37\.\d{6},-121\.\d{6}&heading=\d+$", r.url) for r in QUERIES["i9_view_link"](spark, tiny).collect())


def test_lineage_fits_together(spark, tiny):
    from rillmark.plans import lineage

    got = {r.street: r for r in QUERIES["lineage_street_index"](spark, tiny).collect()}
    p = lineage.points(spark, tiny)
    n = {r.street: r["count"] for r in p.groupBy("street").count().collect()}
    ends = {r.street: r.total for r in p.groupBy("street", "oid").agg({"dist_along_m": "max"}).groupBy("street").agg({"max(dist_along_m)": "sum"}).toDF("street", "total").collect()}
    assert {s: r.n_points for s, r in got.items()} == n
    assert all(r.length_m >= 0.98 * ends[s] and r.n_served + r.n_unserved == r.n_sags for s, r in got.items())
    assert sum(r.n_sags for r in got.values()) > 10 and sum(r.n_served for r in got.values()) > 0


def test_sample_is_drawn_from_the_candidates(spark, tiny):
    sample = [r.street for r in QUERIES["s6_sample"](spark, tiny).collect()]
    among = {r.street for r in QUERIES["s6_candidates"](spark, tiny).collect()}
    assert len(sample) == len(set(sample)) == min(8, len(among)) and set(sample) <= among


def test_no_cross_product_or_python_on_the_point_path(spark, tiny):
    """But for the two ordered passes of the low points, no Python runs."""
    plan = QUERIES[FLAGSHIP](spark, tiny)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and set(re.findall(r"MapInArrow (\w+)", plan)) <= {"_climbs", "_apart", "func", "partial"}
    spark.catalog.clearCache()
