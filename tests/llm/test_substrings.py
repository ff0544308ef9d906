"""Substring dedup in its parts: the external sort, matching statistics, hot owners, long texts, rows that are alike."""

import random

import numpy as np
import pytest

from rillmark.llm import induced_suffixes
from rillmark.llm.anchored import Cut, Owned, Units, pieces
from rillmark.llm.fm_index import FMIndex, FMShard, remove_seen
from rillmark.llm.induced_suffixes import Sorter, SuffixShard, remove_repeats


def texts(rng, n):
    for trial in range(n):
        sigma = rng.integers(1, 6) if trial % 2 else rng.integers(5, 250)
        t = rng.integers(1, sigma + 1, rng.integers(1, 1500))
        if trial % 3 == 1:
            t = np.concatenate([t[: len(t) // 3 + 1]] * 4)
        if trial % 3 == 2:
            t = np.repeat(t, rng.integers(1, 9, len(t)))
        yield np.append(t, 0).astype(np.uint16)


@pytest.mark.parametrize("memory", [64, 2000, 1 << 22])
def test_external_sort_with_common_prefixes(memory, monkeypatch):
    monkeypatch.setattr(induced_suffixes, "READ", 32 if memory < 10_000 else 8192)
    rng, depth, spilled = np.random.default_rng(1), 0, 0
    for t in texts(rng, 60):
        cap = int(rng.integers(2, 60))
        s = Sorter(t, cap, memory)
        order, common = (np.asarray(x).tolist() for x in s.run())
        depth, spilled = max(depth, s.depth), spilled + s.spilled
        assert sorted(order) == list(range(len(t)))
        for i, (a, b) in enumerate(zip(order, order[1:]), 1):
            k = 0
            while k < cap and t[a + k] == t[b + k]:
                k += 1
            assert k == common[i] and (k == cap or t[a + k] < t[b + k])
    assert memory > 2000 or (depth >= 1 and spilled > 0)  # the recursion and the disk are used


def owned(seqs, first, n, dtype):
    at = np.concatenate([[0], np.cumsum([len(s) for s in seqs])])
    i = np.arange(len(seqs))
    return Owned(i, i, np.array(first), np.array(n), np.concatenate(seqs).astype(dtype), at)


def test_suffix_shard_on_disk_finds_all_repeats():
    rng = np.random.default_rng(4)
    base = rng.integers(0, 4, 400)
    seqs = [np.concatenate([rng.integers(0, 250, 20), base[a : a + 90]]) for a in rng.integers(0, 300, 60)]
    n = [1 + int(i % 7 == 0) for i in range(60)]
    shard = SuffixShard(40, memory=3000)
    for a in range(0, 60, 20):
        shard.add(owned(seqs[a : a + 20], range(20), n[a : a + 20], np.uint8))
    got = shard.close()
    count = {}
    for s, k in zip(seqs, n):
        for i in range(len(s) - 39):
            count[bytes(s[i : i + 40])] = count.get(bytes(s[i : i + 40]), 0) + k
    for s, spans in zip(seqs, got):
        want = {j for i in range(len(s) - 39) if count[bytes(s[i : i + 40])] > 1 for j in range(i, i + 40)}
        assert {j for a, b in zip(spans[::2], spans[1::2]) for j in range(a, b)} == want


def test_matching_statistics_against_brute_force():
    rng = np.random.default_rng(2)
    for _ in range(15):
        base = rng.integers(1, 6, 120)
        seqs = [np.concatenate([base[a : a + k], rng.integers(1, 9, 12)]) for a, k in zip(rng.integers(0, 80, 14), rng.integers(5, 40, 14))]
        docs = rng.integers(0, 6, 14).astype(np.int32)
        index = FMIndex(seqs, docs, 25)
        foreign = [np.concatenate([base[30:70], [0, 0], base[:20]])]
        for some, of in ((seqs, docs), (foreign, np.array([3], np.int32))):
            for s, d, got in zip(some, of, index.matching_statistics(some, of)):
                before = [x.tolist() for x, y in zip(seqs, docs) if y < d]
                for i in range(len(s)):
                    k = 0
                    while k < 25 and i + k < len(s) and any(s[i : i + k + 1].tolist() == b[j : j + k + 1] for b in before for j in range(len(b) - k)):
                        k += 1
                    assert got[i] == k


def test_fm_shard_takes_its_answers_from_the_index(monkeypatch):
    """Without the index's answers no interval comes out: nothing else finds them."""
    seqs = [np.arange(60), np.concatenate([np.arange(5, 58), [99]])]
    shard = FMShard(50)
    shard.add(owned(seqs, [1, 2], [1, 1], np.uint64))
    assert [s.tolist() for s in shard.close()] == [[], [0, 53]]
    monkeypatch.setattr(FMIndex, "matching_statistics", lambda self, seqs, docs: [np.zeros(len(s), np.int64) for s in seqs])
    shard = FMShard(50)
    shard.add(owned(seqs, [1, 2], [1, 1], np.uint64))
    assert [s.tolist() for s in shard.close()] == [[], []]


def brute(rows, window, unit, later):
    seen = {}
    data = [(d, unit(t or "")) for d, t in rows]
    for d, u in data:
        for i in range(len(u) - window + 1):
            k = tuple(u[i : i + window])
            n, low = seen.get(k, (0, d))
            seen[k] = n + 1, min(low, d)
    out = []
    for d, u in data:
        gone = set()
        for i in range(len(u) - window + 1):
            n, low = seen[tuple(u[i : i + window])]
            if (low < d) if later else n > 1:
                gone.update(range(i, i + window))
        out.append((d, len(u), len(gone)))
    return sorted(out)


def template(rng, n):
    """n documents that share a text but for a number each, in a group that no shard holds, and a few others."""
    words = [f"w{rng.randrange(500)}" for _ in range(70)]
    rows = [(i, " ".join([*words[:35], str(rng.randrange(60)), *words[35:], *(f"u{i}x{j}" for j in range(10))])) for i in range(n)]
    return rows + [(n, None), (n + 1, ""), (n + 2, rows[3][1]), (n + 2, rows[3][1]), (n + 3, "one two")]


@pytest.mark.parametrize("block", [200, 1 << 20])
def test_hot_owners_are_split(spark, block):
    rows = template(random.Random(5), 90)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = remove_seen(docs, window=20, block_words=block).collect()
    assert sorted((r.doc_id, r.n_words, r.n_removed) for r in got) == brute(rows, 20, str.split, True)
    got = remove_repeats(docs, window=60, block_bytes=block, memory=5000).collect()
    assert sorted((r.doc_id, r.n_bytes, r.n_removed) for r in got) == brute(rows, 60, str.encode, False)


def test_long_texts_are_cut_in_overlapping_runs():
    rng = np.random.default_rng(3)
    values = rng.integers(0, 256, 3000).astype(np.uint8)
    values[2000:2400] = values[100:500]
    cut = Cut(40, 10, False)
    row, start, end, owner, content = pieces(Units(values, np.array([0, 3000])), cut, long=256)
    windows = [(i, o) for s, e, o in zip(start, end, owner) for i in range(s, e - 39)]
    assert sorted(i for i, _ in windows) == list(range(3000 - 39))
    of = dict(windows)
    assert all(of[100 + i] == of[2000 + i] for i in range(400 - 39))


def test_word_hashes_of_long_texts():
    from rillmark.llm.vectors import word_hashes, words

    data = np.frombuffer(b" ".join(b"word%d" % (i % 97) for i in range(2000)), np.uint8)
    starts, ends, _ = words(data, np.array([0, len(data)]))
    assert (word_hashes(data, starts, ends) == word_hashes(data, starts, ends, long=64)).all()


def test_rows_that_are_alike_and_rows_without_an_id(spark):
    text = " ".join(f"w{i}" for i in range(80))
    rows = [(1, text)] * 20 + [(None, text + " end")] + [(None, "other")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = remove_seen(docs, window=20).collect()
    assert len(got) == 22 and sum(r.n_removed for r in got) == 0
    got = remove_repeats(docs, window=60).collect()
    assert sorted((r.doc_id or -1, r.n_removed) for r in got) == sorted([(1, len(text))] * 20 + [(-1, len(text)), (-1, 0)])


def test_repeated_rows_cost_one_span_each(spark):
    from pyspark.sql import functions as F

    text = " ".join(f"w{i}" for i in range(400))
    for k in (5, 40):
        docs = spark.createDataFrame([(1, text)] * k + [(2, text + " x")], "doc long, text string").withColumn("twin", F.xxhash64("text"))
        sizes = [len(r.spans) for r in induced_suffixes.repeats(docs, 200).collect()]
        assert max(sizes) < 120  # whatever k is


def test_clashing_column_names(spark):
    text = " ".join(f"w{i}" for i in range(80))
    names = ("owner", "piece", "twin", "doc", "want", "spans", "n", "at", "size")
    docs = spark.createDataFrame([(1, text, *names), (2, text, *names)], "doc_id long, text string, " + ", ".join(f"{n} string" for n in names))
    assert sorted(r.n_removed for r in remove_seen(docs, window=20).collect()) == [0, 80]
    assert sorted(r.n_removed for r in remove_repeats(docs, window=60).collect()) == [len(text)] * 2
