"""The curve against its definition, and how many shards a filter must read."""

import itertools
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from rillmark.llm import hilbert


@pytest.mark.parametrize(("dims", "bits"), [(2, 1), (2, 4), (3, 3), (4, 2)])
def test_curve_visits_each_cell_once_by_single_steps(dims, bits):
    cells = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
    index = hilbert.curve_index(cells, bits)
    assert sorted(index.tolist()) == list(range(len(cells)))
    walk = cells[np.argsort(index)]
    assert (np.abs(np.diff(walk, axis=0)).sum(1) == 1).all()  # neighbours on the curve touch: a Hilbert curve
    # Every aligned run of 2 ** (dims * level) indices fills one cube.
    for level in range(1, bits):
        blocks = walk.reshape(-1, 1 << dims * level, dims) >> level
        assert (blocks == blocks[:, :1]).all()


def test_plane_curve_by_its_recursive_rule():
    def rule(n):
        if n == 0:
            return [(0, 0)]
        a, h = rule(n - 1), 1 << (n - 1)
        return [(y, x) for x, y in a] + [(x, y + h) for x, y in a] + [(x + h, y + h) for x, y in a] + [(2 * h - 1 - y, h - 1 - x) for x, y in a]

    want = rule(4)
    got = hilbert.curve_index(np.array(want), 4).tolist()
    mirrored = hilbert.curve_index(np.array([(y, x) for x, y in want]), 4).tolist()
    assert list(range(256)) in (got, mirrored)


def test_values_are_spread_over_the_axis(spark):
    df = spark.createDataFrame([(f"http://host/{c}", i) for i, c in enumerate("abcd" * 20)], "s string, x int")
    low, cells = hilbert._edges(df, "s", 5)
    assert low == [f"http://host/{c}" for c in "abcd"] and cells.tolist() == [0, 0, 8, 16, 24]  # a common prefix of any length
    low, cells = hilbert._edges(df, "x", 5)
    assert cells.max() == 31 and (np.diff(cells) >= 0).all()
    many = spark.createDataFrame([(f"v{i:04}",) for i in range(1000)], "s string")
    low, cells = hilbert._edges(many, "s", 3)
    assert cells[1] == 0 and cells[-1] == 7


def test_filters_read_few_shards(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = hilbert.shard_documents(docs, 8).collect()
    read = {k: defaultdict(set) for k in ("source", "lang")}
    share = {k: defaultdict(int) for k in read}
    for r in rows:
        for k in read:
            read[k][r[k]].add(r.shard)
            share[k][r[k]] += 1
    mean = sum(len(v) for v in read["source"].values()) / len(read["source"])
    assert mean < 4, mean  # less than half of the shards
    for k, shards in read["lang"].items():
        assert len(shards) <= 8 * share["lang"][k] / len(rows) + 4, (k, shards)
    rare = [len(v) for k, v in read["lang"].items() if share["lang"][k] < len(rows) / 4]
    assert rare and sum(rare) / len(rare) <= 4


def test_written_shards_keep_their_order(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    placed = hilbert.with_shards(docs, 4)
    counts = {r.shard: r.rows for r in hilbert.write_shards(placed, str(tmp_path / "out"), per_file=20).collect()}
    assert sum(counts.values()) == docs.count() and max(counts.values()) - min(counts.values()) <= 1
    back = spark.read.parquet(str(tmp_path / "out")).withColumn("file", F.input_file_name())
    files = back.groupBy("shard", "file").agg(F.min("slot").alias("a"), F.max("slot").alias("b"), F.count("*").alias("n")).orderBy("shard", "a").collect()
    assert all(r.b - r.a + 1 == r.n for r in files) and len(files) > 4


def test_odd_tables(spark):
    schema = "doc_id long, text string, lang string, source string, rank int, curve int, shard string, slot int, row string, _at int"
    assert hilbert.with_shards(spark.createDataFrame([], schema)).count() == 0
    rows = [(None, None, None, None, 1, 2, "a", 3, "r", 4), (1, "", "en", "s", 1, 2, "a", 3, "r", 4), (1, "", "en", "s", 1, 2, "a", 3, "r", 4), (2, "x" * 3_000_000, "de", None, 1, 2, "a", 3, "r", 4)]
    got = hilbert.with_shards(spark.createDataFrame(rows, schema), 2)
    assert got.columns == ["doc_id", "text", "lang", "source", "rank", "curve", "row", "_at", "shard", "slot"]
    assert sorted((r.shard, r.slot) for r in got.collect()) == [(0, 0), (0, 1), (1, 0), (1, 1)]
    assert {(r["rank"], r.curve, r.row, r._at) for r in got.collect()} == {(1, 2, "r", 4)}


def test_small_sources_come_near_their_targets(spark):
    """Sources of fifty documents, one with a third of its words in one document: each within 1 % of its target."""
    import random

    from rillmark.llm import cube_mix

    rng = random.Random(3)
    rows = [(s * 1000 + i, f"s{s:02}", "w " * (4000 if i == 0 else rng.randrange(20, 400))) for s in range(12) for i in range(50)]
    got = cube_mix.mix_sources(spark.createDataFrame(rows, "doc_id long, source string, text string")).collect()
    for s in range(12):
        of = [r for r in got if r.source == f"s{s:02}"]
        assert abs(sum(r.copies * r["size"] for r in of) - of[0].target) <= 0.01 * of[0].target and len(of) == 50


def test_rows_that_are_alike_are_spread_over_blocks(spark, monkeypatch):
    from pyspark.sql import functions as F

    from rillmark.llm import cube_mix

    seen = []
    real = cube_mix._fly
    monkeypatch.setattr(cube_mix, "_fly", lambda land: seen.append(land) or real(land))
    df = spark.range(100_000).select(F.lit(7).cast("long").alias("doc_id"), F.lit("s").alias("source"), F.lit("a b c").alias("text")).union(spark.range(2000).select(F.col("id"), F.lit("t"), F.lit("d " * 5)))
    got = cube_mix.mix_sources(df)
    rows = got.groupBy("source").agg(F.count("*").alias("n"), F.sum(F.col("copies") * F.col("size")).alias("taken"), F.first("target").alias("target"), F.max("copies").alias("most")).collect()
    assert sorted(r.n for r in rows) == [2000, 100_000] and all(abs(r.taken - r.target) <= 5 and r.most <= 2 for r in rows) and seen == [False, True]
    units = df.select("doc_id", F.xxhash64("doc_id", "text").alias("twin"), F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("number_"))
    turns = cube_mix._ranked(units).where("doc_id = 7").groupBy(F.pmod(F.xxhash64("twin", "turn", F.lit(17)), F.lit(13)).alias("b")).count().collect()
    assert len(turns) == 13 and max(r["count"] for r in turns) < 8_500
    ranks = cube_mix._ranked(units).where("doc_id = 7").agg(F.count_distinct("turn").alias("n"), F.max("turn").alias("m")).first()
    assert (ranks.n, ranks.m) == (100_000, 99_999)
