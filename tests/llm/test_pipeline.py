"""The stages on rows that share ids or have none, on repeated rows, and with columns of any name."""

from collections import Counter

import pytest

import corpus_pipeline

EXTRA = ("row", "number", "copies", "copy", "curve", "shard", "slot", "half", "rank", "first", "component_id", "_row", "item_id", "twin")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in EXTRA)


def table(spark, rows):
    return spark.createDataFrame([(d, t, "en", s, len(t or ""), *EXTRA) for d, t, s in rows], SCHEMA)


def sentence(i, n=30):
    return " ".join(f"the {w} of the {(i * 7 + k) % 97}th house" for k, w in enumerate(("garden", "window", "door", "roof", "wall", "street") * n))[: 40 * n]


def test_columns_of_any_name_and_rows_of_any_kind(spark, tiny):
    rows = [(i, sentence(i), f"s{i % 3}") for i in range(60)]
    rows += [rows[5]] * 4 + [(None, sentence(70), "s0"), (None, sentence(71), None), (5, sentence(72), "s1")]
    docs = table(spark, rows)
    kept = docs
    counts = []
    for name, stage in corpus_pipeline.STAGES[:4]:
        kept = stage(spark, kept, tiny)
        assert kept.columns == docs.columns, name
        got = kept.collect()
        assert all(tuple(r[c] for c in EXTRA) == EXTRA for r in got), name
        counts.append(len(got))
        kept = spark.createDataFrame(got, SCHEMA)
    assert counts[0] == len(rows)  # no junk among them
    near = corpus_pipeline.near(spark, docs, tiny).collect()
    assert Counter(r.text for r in near) == Counter({t: 1 for _, t, _ in rows})  # of repeated rows one stays
    assert sum(r.doc_id is None for r in near) == 2 and sum(r.doc_id == 5 for r in near) == 2
    out = corpus_pipeline.shards(spark, docs, tiny)
    assert out.columns == [*(c for c in docs.columns if c not in ("shard", "slot")), "shard", "slot"]
    got = out.collect()
    assert len(got) == len(rows) and {(r["row"], r["curve"]) for r in got} == {("row", "curve")}


def test_mix_takes_rows_of_one_id_apart(spark, tiny):
    rows = [(1, "w " * n, "a") for n in (10, 20, 30, 40)] * 20 + [(None, "w " * 25, "a")] * 20
    docs = table(spark, rows)
    got = corpus_pipeline.mix(spark, docs, tiny).collect()
    total = sum(len(t.split()) for _, t, _ in rows)
    assert abs(sum(len(r.text.split()) for r in got) - 1.5 * total) <= 40
    per = Counter(r.text for r in got)
    assert all(20 <= n <= 40 for n in per.values())


def test_null_and_empty_texts(spark, tiny):
    docs = table(spark, [(1, None, "s"), (2, "", "s"), (3, " 12 ", None), (4, sentence(4), "s"), (None, None, None)])
    assert [r.doc_id for r in corpus_pipeline.language(spark, docs, tiny).collect()] == [4]
    assert corpus_pipeline.near(spark, docs, tiny).count() == 5
    assert corpus_pipeline.benchmark(spark, docs, tiny).count() == 5
    assert {r.doc_id for r in corpus_pipeline.mix(spark, docs, tiny).collect()} >= {4}
    assert corpus_pipeline.shards(spark, docs, tiny).count() == 5


def test_tables_between_the_stages_are_deleted(spark, tiny):
    from pathlib import Path

    from rillmark.llm.common import scratch_dir

    folder = Path(scratch_dir(spark).removeprefix("file:").replace("//", "/"))
    before = {p.name for p in folder.glob("stage-*")}
    assert corpus_pipeline.run(spark, tiny).count()
    assert len({p.name for p in folder.glob("stage-*")} - before) == 1


def test_scratch_folder_must_be_shared_on_a_cluster():
    from types import SimpleNamespace

    from rillmark.llm.common import scratch_dir

    bare = SimpleNamespace(conf=SimpleNamespace(get=lambda *a: None), sparkContext=SimpleNamespace(master="spark://host:7077"))
    with pytest.raises(RuntimeError):
        scratch_dir(bare)
