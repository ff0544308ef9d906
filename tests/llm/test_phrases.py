"""Phrase mining against a plain count, and the double-array trie against a dictionary."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from rillmark.llm import phrase_trie

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, least, longest, top):
    total, f = Counter(), {}
    for lang, text in rows:
        of = f.setdefault(lang or "und", Counter())
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(UPPER)):
            w = [x for x in re.split("[ \t]+", piece) if x]
            total[lang or "und"] += len(w)
            of.update(tuple(w[i : i + k]) for k in range(1, longest + 1) for i in range(len(w) - k + 1))
    out = set()
    for lang, of in f.items():
        cands, n = {p: a for p, a in of.items() if len(p) > 1 and a >= least}, total[lang]
        inner = {p[i:j] for p, a in cands.items() for i in range(len(p)) for j in range(i + 2, len(p) + 1) if j - i < len(p) and of[p[i:j]] <= a}
        scored = []
        for p, a in cands.items():
            if p not in inner:
                score, k = min((1000 * a * n // (of[p[:k]] * of[p[k:]]), k) for k in range(1, len(p)))
                scored.append((-score, -a, " ".join(p).encode(), a, of[p[:k]], of[p[k:]], score))
        out |= {(lang, i, p.decode(), a, l, r, n, score) for i, (_, _, p, a, l, r, score) in enumerate(sorted(scored)[:top], 1)}
    return out


def mined(spark, rows, **kw):
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    return {(r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in phrase_trie.collocations(docs, **kw).collect()}


def corpus(seed, n=60):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(12)] + ["Eins", "zwei\u00e9", "x-y"]
    text = lambda: "".join(rng.choice(vocabulary) + rng.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", " ! "]) for _ in range(rng.randrange(80)))
    return [(rng.choice(["en", "de", None]), text()) for _ in range(n)] + [("en", None), ("en", ""), ("fr", " . "), ("de", "eins zwei eins zwei " * 30)]


@pytest.mark.parametrize("seed, pieces", [(1, False), (2, True)])
def test_as_a_plain_count(spark, monkeypatch, seed, pieces):
    if pieces:  # vocabulary and tries in many pieces
        monkeypatch.setattr(phrase_trie, "VOCABULARY", 7)
        monkeypatch.setattr(phrase_trie, "STATES", 11)
    rows = corpus(seed)
    want = plain(rows, 4, 5, 25)
    assert want == mined(spark, rows, least=4, longest=5, top=25) and len(want) > 30


def test_products_beyond_64_bits(spark):
    """Scores are floors of exact quotients, also where 1000 a n passes 64 bits."""
    q = "(1000 * cast(a as decimal(19, 0)) * cast(n as decimal(18, 0))) div (cast(l as decimal(19, 0)) * cast(r as decimal(19, 0)))"
    a, n, l, r = 9_000_000_000_007, 80_000_000_000_003, 9_000_000_000_011, 9_100_000_000_001
    got = spark.sql(f"select {q} as x from (select {a}L as a, {n}L as n, {l}L as l, {r}L as r)").first().x
    assert got == 1000 * a * n // (l * r)


def test_nothing_frequent_and_nothing_at_all(spark):
    assert mined(spark, [("en", "a b c"), (None, None)]) == set()
    assert phrase_trie.collocations(spark.createDataFrame([], "lang string, text string")).collect() == []


@pytest.mark.parametrize("n", [40, 300, 70_000])
def test_double_array(n):
    """Symbols of one, two and three digits; states with hundreds of children beside many with one."""
    rng = np.random.default_rng(3)
    trie, symbols = phrase_trie.DoubleArray(n), np.unique(np.append(rng.integers(1, n + 1, 900), n))
    states = trie.add(np.zeros(len(symbols), np.int64), symbols)
    level = {(int(s),): int(x) for s, x in zip(symbols, states)}
    for _ in range(3):
        wide = next(iter(level))
        pairs = sorted({(p, int(s)) for p in list(level)[:900] for s in rng.choice(symbols, rng.integers(0, 4))} | {(wide, int(s)) for s in symbols})
        states = trie.add(np.array([level[p] for p, _ in pairs]), np.array([s for _, s in pairs]))
        level = {(*p, s): int(x) for (p, s), x in zip(pairs, states)}
    trie.accept(np.array(list(level.values())), np.arange(len(level)))
    assert len(set(level.values())) == len(level) > 200
    number = {p: i for i, p in enumerate(level)}
    ids = np.concatenate([rng.choice(np.append(symbols, 0), 5000), *(np.array(p) for p in list(level)[:500])]).astype(np.int32)
    got = trie.walk(ids, 4)
    assert got.tolist() == [number.get(tuple(ids[i : i + 4].tolist()), -1) for i in range(len(ids) - 3)] and (got >= 0).sum() >= min(500, len(level))
