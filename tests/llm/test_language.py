"""Calibration of the language models: scores as probabilities, limits by length, tables without labels."""

import random

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from rillmark.llm import kn_langid as K

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def test_probabilities_against_a_plain_model():
    """Interpolated Kneser-Ney by its formula, over dictionaries, with one discount an order."""
    text = "the cat sat on the mat and the rat sat on the cat"
    codes, offsets = K.symbols([text])
    at = K._scored(offsets)
    seq = codes.tolist()
    grams = {}
    for i in at.tolist():
        g = tuple(seq[i - K.ORDER + 1 : i + 1])
        grams[g] = grams.get(g, 0) + 1
    counts = {K.ORDER: grams}
    for n in range(K.ORDER - 1, 0, -1):
        shorter = {}
        for g in counts[n + 1]:
            shorter[g[1:]] = shorter.get(g[1:], 0) + 1
        counts[n] = shorter

    def p(g):
        n = len(g)
        if n == 0:
            return 1 / 200_000
        c = counts[n]
        once, twice = sum(v == 1 for v in c.values()), sum(v == 2 for v in c.values())
        d = once / (once + 2 * twice) if once and twice else 0.5
        same = [v for h, v in c.items() if h[:-1] == g[:-1]]
        if not same:
            return p(g[1:])
        return max(c.get(g, 0) - d, 0) / sum(same) + d * len(same) / sum(same) * p(g[1:])

    keys = list(grams)
    model = K.build({"en": (np.array(keys, np.int32), np.array([grams[g] for g in keys]))})
    other, where = K.symbols(["the bat sat"])
    places = K._scored(where)
    got = model.score(other, places)[:, 0]
    want = [np.log(p(tuple(other[i - K.ORDER + 1 : i + 1].tolist()))) for i in places.tolist()]
    assert np.allclose(got, want, atol=1e-4)
    e, letters = K.entropies(model, ["the bat sat"])
    assert abs(e[0, 0] + np.mean(want)) < 1e-4 and letters[0] == 9


def test_the_curve_is_a_probability():
    rng = np.random.default_rng(1)
    letters = rng.integers(5, 3000, 20_000)
    gap = rng.exponential(0.3, 20_000)
    true = 1 / (1 + np.exp(-(0.2 + 3 * gap + 0.5 * gap * np.log1p(letters))))
    good = rng.random(20_000) < true
    got = 1 / (1 + np.exp(-K._traits(gap, letters) @ K.fit_curve(gap, letters, good)))
    for low in (0.5, 0.7, 0.9):
        some = (got >= low) & (got < low + 0.1)
        assert abs(good[some].mean() - got[some].mean()) < 0.03
    sure = K._traits(gap, letters) @ K.fit_curve(gap, letters, np.ones(20_000, bool))
    assert np.isfinite(sure).all() and (1 / (1 + np.exp(-sure))).min() < 1


def test_limits_follow_the_length_and_the_rate():
    rng = np.random.default_rng(2)
    letters = rng.choice([10, 100, 1000, 10_000], 8000)
    best = 1.4 + rng.standard_t(6, 8000) * 0.6 / np.sqrt(letters)
    told = rng.integers(0, 2, 8000)
    found = K.limits(told, best, letters, 3)
    assert found[0, K._class(np.array([10]))[0]] > found[0, K._class(np.array([10_000]))[0]]
    over = (best > found[told, K._class(letters)]).mean()
    assert over <= K.FALSE * 1.5
    best[:400] = 6.0  # a twentieth is odd
    assert K.limits(told, best, letters, 2)[:, K._class(np.array([100]))[0] :].max() < 4.0


def test_scores_are_calibrated_on_held_out_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    model = K.train(docs, F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 != 2)
    held = docs.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2)
    short = held.withColumn("text", F.substring("text", 1, 9))  # so short that some are wrong
    joined = K.identify(short, model).join(held.select("doc_id", "lang"), "doc_id").where("lang is not null and lang_pred <> 'und'").collect()
    right, score = np.array([r.lang == r.lang_pred for r in joined]), np.array([r.score for r in joined])
    assert 0.6 < right.mean() < 0.999 and abs(right.mean() - score.mean()) < 0.06
    low, high = right[score < np.median(score)], right[score >= np.median(score)]
    assert low.mean() < high.mean()


def test_stage_rejects_planted_junk_and_keeps_clean_rows(spark, tiny):
    rng = random.Random(5)
    noise = lambda n: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz    ") for _ in range(n))
    clean = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    junk = [(90_000 + i, noise(400), "en", "src0", 400) for i in range(6)] + [(91_000, "漢字だけの文章です" * 9, None, None, 1), (91_001, "4711 !!", "en", None, 7), (None, noise(900), None, None, 0)]
    docs = clean.union(spark.createDataFrame(junk, SCHEMA))
    kept = corpus_pipeline.language(spark, docs, tiny).select("doc_id", "text").collect()
    texts = {r.text for r in kept}
    assert not texts & {j[1] for j in junk}
    letters = [r for r in clean.collect() if any(c.isalpha() for c in r.text or "")]
    assert len(kept) >= 0.99 * len(letters)  # of the made-up documents a few are mixtures of languages or mostly codes


def test_a_table_without_labels_keeps_its_rows(spark, tiny):
    rows = [(i, f"some words of row {i}", None, None, 9) for i in range(40)] + [(99, "123", None, None, 3), (None, "no id", None, None, 3)]
    docs = spark.createDataFrame(rows, SCHEMA)
    kept = corpus_pipeline.language(spark, docs, tiny).collect()
    assert sorted(-1 if r.doc_id is None else r.doc_id for r in kept) == [-1, *range(40)]
    assert {r.lang_pred for r in K.identify(docs, K.train(docs, F.lit(True))).collect()} == {"und"}
