"""Fingerprints against exact span sets, and ranges of documents."""

import random

import numpy as np
from pyspark.sql import functions as F

from rillmark.llm import prefix_fp as P


def spans(t):
    k = min(P.SPAN, len(t))
    return {t[i : i + k] for i in range(len(t) - k + 1)} if t else set()


def test_likeness_against_exact_span_sets():
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abcdefgé中") for _ in range(rng.randrange(2, 9)))
    errors = []
    for _ in range(300):
        w = [word() for _ in range(rng.randrange(30, 500))]
        v = list(w)
        for _ in range(rng.randrange(0, 12)):
            v[rng.randrange(len(v))] = word()
        if rng.random() < 0.5:
            cut = rng.randrange(len(v))
            v = v[:cut] + [word() for _ in range(len(v) - cut)]
        a, b = " ".join(w), " ".join(v)
        exact = len(spans(a) & spans(b)) / len(spans(a) | spans(b))
        fa, fb = (P.parse(P.fingerprint(P.Prefix(P.code_points(x)))) for x in (a, b))
        got = P.likeness(fa, fb)
        assert got == P.likeness(fb, fa) and 0 <= got <= 1 and (got == 1.0 or a != b)
        errors.append(got - exact)
    errors = np.array(errors)
    assert np.sqrt((errors**2).mean()) < 0.5 / np.sqrt(P.KEEP) and np.abs(errors).max() < 0.25 and abs(errors.mean()) < 0.02


def test_sketch_is_the_least_spans():
    from rillmark.llm.vectors import mix

    for t in ("", "a", "ab" * 300, "the quick brown fox jumps over the lazy dog " * 3, "x" * 500):
        p = P.Prefix(P.code_points(t))
        k = min(P.SPAN, len(t))
        want = sorted({int(mix(p.spans(np.array([i]), np.array([i + k])))[0]) >> 16 for i in range(len(t) - k + 1)}) if t else []
        assert P.sketch(p).tolist() == want[: P.KEEP]


def test_common_extensions_from_the_ladders():
    a = "".join(chr(97 + i % 23) for i in range(4000))
    for at in (0, 1, 5, 100, 3000):
        b = a[:at] + "#" + a[at + 1 :]
        fa, fb = (P.parse(P.fingerprint(P.Prefix(P.code_points(x)))) for x in (a, b))
        rungs = P.ladder(4000)
        k = P.agreed(fa[2], fb[2])
        assert (rungs[k - 1] if k else 0) <= at < rungs[k]
        k = P.agreed(fa[3], fb[3])
        assert (rungs[k - 1] if k else 0) <= 3999 - at and (k == len(rungs) or rungs[k] > 3999 - at)


def test_ranges_with_a_hot_id_and_without_ids(spark):
    rows = [(7, f"text {i} " * 9) for i in range(80)] + [(None, f"none {i} " * 5) for i in range(60)] + [(i, f"own {i}") for i in range(20)] + [(7, "text 3 " * 9), (None, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    order = [r.text for r in docs.orderBy(F.desc_nulls_last("doc_id"), F.xxhash64("text")).collect()]
    want = sorted((t, t[: len(t) - len(t) // 2] + u[: len(t) // 2]) for t, u in zip(order, order[1:] + order[:1]))
    import hashlib

    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    for size in (1 << 20, 700):
        placed, parts = P.with_range(docs, size)
        assert parts == 1 or placed.where("doc_id = 7").select("part").distinct().count() > 2
        got = P.fingerprints_with_edits(docs, size).collect()
        assert sorted(r.edited_sha256 for r in got) == sorted(sha(e) for _, e in want) and len(got) == len(rows)


def test_a_single_row_and_odd_columns(spark):
    docs = spark.createDataFrame([(1, "abcdef", "x", "y", "z")], "doc_id long, text string, part string, tie string, head string")
    r = P.fingerprints_with_edits(docs).collect()[0]
    assert r.n_chars == 6 and r.near_next == 1.0
