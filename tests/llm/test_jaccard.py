"""Families of near copies: exact components, and far fewer comparisons than pairs."""

import random

import numpy as np
import pytest

from rillmark.llm import jaccard_skip


def shingles(text, k):
    w = text.split()
    return frozenset(tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset()


def brute(rows, k, percent):
    sets = {}
    for d, t in rows:
        sets.setdefault(shingles(t, k), []).append(d)
    keys, top = list(sets), {}

    def find(x):
        while top.setdefault(x, x) != x:
            x = top[x]
        return x

    for i, a in enumerate(keys):
        for b in keys[:i]:
            both = len(a & b)
            if a and b and 100 * both >= percent * (len(a) + len(b) - both):
                top[find(a)] = find(b)
    least = {}
    for s, ids in sets.items():
        least[find(s)] = min(least.get(find(s), 1 << 60), *ids) if s else 0
    return {(d, least[find(s)] if s else d) for s, ids in sets.items() for d in ids}


@pytest.fixture
def compared(monkeypatch):
    """The pairs that are compared, by whole sets or by differences."""
    seen = []
    for name in ("verified", "_alike"):
        real = getattr(jaccard_skip, name)

        def counting(pairs, *a, real=real):
            seen.append(pairs.count())
            return real(pairs, *a)

        monkeypatch.setattr(jaccard_skip, name, counting)
    return seen


def components(spark, rows, **kw):
    return {(r.doc_id, r.component_id) for r in jaccard_skip.linked_documents(spark.createDataFrame(rows, "doc_id long, text string"), **kw).collect()}


def template(n, places, seed=1):
    rng = random.Random(seed)
    base = [f"t{i}" for i in range(100)]
    rows = []
    for i in range(n):
        w = list(base)
        w[rng.choice(places)] = f"own{i}"
        rows.append((i, " ".join(w)))
    return rows


def test_template_with_one_word_replaced(spark, compared):
    rows = template(1680, range(100))
    assert components(spark, rows) == {(i, 0) for i in range(1680)}
    assert sum(compared) < 50_000


def test_template_whose_groups_do_not_link(spark, compared):
    rows = template(600, range(10, 90, 8))
    got = components(spark, rows)
    assert got == brute(rows, 4, 85) and len({c for _, c in got}) == 10
    assert sum(compared) < 600 * 600 / 8


@pytest.mark.parametrize("seed", range(3))
def test_random_edits_of_several_families(spark, seed, monkeypatch):
    """Several families on each list, with exact answers also where lists choose further leaders."""
    monkeypatch.setattr(jaccard_skip, "LARGE", 4)
    rng = random.Random(seed)
    shared = [f"s{i}" for i in range(12)]
    bases = [shared + [f"f{f}w{i}" for i in range(60)] for f in range(4)]
    rows = []
    for i in range(260):
        w = list(rng.choice(bases))
        for _ in range(rng.choice((0, 1, 1, 2, 2, 3))):
            w[rng.randrange(len(w))] = rng.choice((f"own{i}", "x", "y"))
        if rng.random() < 0.2:
            w = w[rng.randrange(6) :]
        rows.append((i, " ".join(w)))
    rows += [(300, ""), (301, None or ""), (302, "two words"), (303, "two words")]
    for k, percent in ((4, 85), (5, 80)):
        assert components(spark, rows, k=k, percent=percent) == brute(rows, k, percent)


def test_low_limits_are_refused(spark):
    with pytest.raises(ValueError):
        components(spark, [(1, "a")], percent=50)


def test_packed_sets():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 300, 5000):
        x = np.unique(rng.integers(0, 1 << 52, n).astype(np.uint64))
        b = jaccard_skip.packed(x)
        assert (jaccard_skip.unpacked(np.frombuffer(b, np.uint8)) == x).all() and (n < 300 or len(b) <= 6 * len(x) + 1)


def test_lists_and_sets_are_dealt_out_once(spark, monkeypatch):
    """Index lists are read where they lie, and a set's body is sent to its bucket and with one side of a pair only."""
    plans, saved = {}, jaccard_skip.saved

    def seen(df, name):
        plans.setdefault(name, df._jdf.queryExecution().executedPlan().toString())
        return saved(df, name)

    monkeypatch.setattr(jaccard_skip, "saved", seen)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = [(i, " ".join(f"w{j}" if j != i + 20 else "x" for j in range(60))) for i in range(8)]
        assert components(spark, rows, k=2, percent=85) == {(i, 0) for i in range(8)}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "Exchange hashpartitioning" not in plans["able"]
    assert spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition") == "true"
    keys = [x.split("hashpartitioning(")[1].split("#")[0] for x in plans["settled"].splitlines() if "Exchange hashpartitioning" in x]
    assert keys.count("key") == 0, plans["settled"]


def test_workers_hash_little_text_at_once(spark, monkeypatch):
    import pyarrow as pa

    sizes, words = [], jaccard_skip.words
    monkeypatch.setattr(jaccard_skip, "words", lambda low, offsets: sizes.append(len(low)) or words(low, offsets))
    batch = pa.RecordBatch.from_arrays([pa.array(["one two three four " * 50] * 2000)], names=["text"])
    got = [len(offsets) - 1 for _, _, offsets in jaccard_skip.set_hashes(batch, 3)]
    assert sum(got) == 2000 and max(sizes) <= 1 << 18
