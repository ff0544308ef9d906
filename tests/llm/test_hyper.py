"""HyperMinHash: its estimate, its bands, and whole components of near copies."""

import random

import numpy as np
import pytest

from rillmark.llm import hyper_minhash as hm

from test_jaccard import brute


def pair(rng, shared, alone_a, alone_b):
    x = rng.choice(1 << 52, shared + alone_a + alone_b, replace=False).astype(np.uint64)
    return np.sort(x[: shared + alone_a]), np.sort(np.concatenate([x[:shared], x[shared + alone_a :]]))


def told(sets):
    return hm.registers(np.concatenate(sets), np.cumsum([0, *map(len, sets)]))


@pytest.mark.parametrize("shared, alone", [(17, 3), (170, 30), (1700, 300), (40_000, 10_000), (0, 500)])
def test_estimate(shared, alone):
    """Within six deviations of the truth, and without bias over many pairs, also for sets smaller than the registers."""
    rng, want = np.random.default_rng(1), shared / (shared + alone)
    pairs = [pair(rng, shared, alone // 2, alone - alone // 2) for _ in range(60 if shared < 10_000 else 8)]
    p, q = told([a for a, _ in pairs]), told([b for _, b in pairs])
    n = np.full(len(pairs), shared + alone / 2)
    got, by_chance = hm.estimate(p, q, n, n)
    error = np.sqrt(max(want * (1 - want), 0.02) / hm.REGISTERS)
    assert abs(got.mean() - want) < 6 * error / np.sqrt(len(pairs)) + 0.01 and (shared < 100 or np.abs(got - want).max() < 7 * error)
    assert (by_chance > 0).all() and (by_chance < 0.1).all()


def test_chance_is_what_sets_with_nothing_in_common_show():
    rng = np.random.default_rng(2)
    for n, m in ((3000, 3000), (3000, 30_000)):
        pairs = [(rng.integers(0, 1 << 52, n).astype(np.uint64), rng.integers(0, 1 << 52, m).astype(np.uint64)) for _ in range(60)]
        seen = (told([np.sort(a) for a, _ in pairs]) == told([np.sort(b) for _, b in pairs])).mean()
        want = float(hm.chance(np.array([n]), np.array([m]))[0])
        assert abs(seen - want) < 6 * np.sqrt(want / (60 * hm.REGISTERS))


@pytest.mark.parametrize("n", [6, 7, 20, 100, 1000])
def test_bands_meet(n):
    """Sets at the least similarity that links share a band."""
    rng = np.random.default_rng(n)
    apart = max(1, n * 15 // 100)
    pairs = [pair(rng, n - apart, apart, 0) for _ in range(300)]
    p, q = told([a for a, _ in pairs]), told([b for _, b in pairs])
    same = (p == q).reshape(len(pairs), hm.BANDS, hm.WIDTH).all(axis=2)
    assert same.any(axis=1).all()


def test_components_as_brute_force(spark):
    rng = random.Random(5)
    rows, base = [], [[f"w{rng.randrange(4000)}" for _ in range(n)] for n in (8, 30, 120, 120, 400)]
    for d in range(160):
        words = list(base[d % 5])
        for _ in range(rng.randrange(0, 1 + len(words) // 30 + 1)):
            words[rng.randrange(len(words))] = f"x{rng.randrange(50)}"
        rows.append((d, " ".join(words)))
    rows += [(500, None), (501, ""), (502, "two words"), (503, "Two  WORDS"), (504, "a b c"), (505, rows[7][1])]
    low = [(d, (t or "").lower()) for d, t in rows]
    got = hm.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), 3, 85).collect()
    want = brute(low, 3, 85)
    assert {(r.doc_id, r.component_id) for r in got} == want and len(got) == len(rows)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got) and 20 < sum(r.kept for r in got) < 160
