"""The trie of conversations against a plain one over tuples, and the radix tree's layouts."""

import hashlib
import random
import zlib

import pytest

from rillmark.llm import turn_trie


def plain(rows):
    convs = {}
    for c, t, role, text in rows:
        if c is not None:
            convs.setdefault(c, []).append((t is not None, t or 0, role or "", text or ""))
    convs = {c: [x[2:] for x in sorted(v)] for c, v in convs.items()}
    again = {c: convs.get(c - c % 100, [])[: (h := zlib.crc32(str(c).encode()) % 6)] + v[h:] for c, v in convs.items()}
    members = {}
    for c, v in again.items():
        for d in range(len(v) + 1):
            members.setdefault(tuple(v[:d]), []).append(c)
    below = {p: [q for q in members if q[: len(p)] == p] for p in members}
    children = {p: sum(len(q) == len(p) + 1 for q in below[p]) for p in members}
    out = set()
    for p, m in members.items():
        ends = ",".join(map(str, sorted(c for c in m if len(again[c]) == len(p))))
        saved = sum((len(members[q]) - 1) * len(q[-1][1]) for q in below[p] if q)
        out.add((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), children[p], sum(not children[q] for q in below[p]), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return out


def built(spark, rows, **kw):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)
    return [(r.conv_id, r.depth, r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256) for r in turn_trie.prefix_trie(df, **kw).collect()]


def talk(seed, convs=160):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(420), convs):
        rows += [(c, t if t else None, rng.choice(["user", "assistant", None]) if rng.random() < 0.2 else ["user", "assistant"][t % 2], rng.choice(["yes", "no", "\u00e9\U0001f600", "", None])) for t in range(rng.randrange(1, 9))]
    return rows + [(400, t, "user", "yes") for t in range(60)] + [(None, 1, "user", "lost")]


@pytest.mark.parametrize("seed, part, block", [(1, 1 << 22, 1 << 12), (2, 300, 2)])
def test_as_a_plain_trie(spark, monkeypatch, seed, part, block):
    """Also with many small trees a task, so that what they say of one node has to meet."""
    rows = talk(seed)
    monkeypatch.setattr(turn_trie, "BLOCK", block)
    got = built(spark, rows, part=part)
    assert len(got) == len(set(got)) and set(got) == plain(rows)


def test_nothing(spark):
    assert built(spark, []) == [] and built(spark, [(None, 1, "user", "x")]) == []


def test_only_the_root(spark):
    """Conversation 1 has one turn and takes more than that from a base that is not there."""
    assert zlib.crc32(b"1") % 6 > 0
    assert built(spark, [(1, 0, "user", "x")]) == [(1, 0, None, 1, 0, 1, 0, hashlib.sha256(b"1").hexdigest())]


@pytest.mark.parametrize("n, layout", [(4, 4), (5, 16), (17, 48), (48, 48), (49, 256), (256, 256)])
def test_layouts(n, layout):
    tree = turn_trie.RadixTree()
    rng = random.Random(n)
    keys = [bytes([b]) + rng.randbytes(15) + (rng.randbytes(16) if b % 2 else b"") for b in rng.sample(range(256), n)]
    nodes = [tree.place(k) for k in keys]
    assert tree.root.layout == layout and [tree.place(k) for k in keys] == nodes and len({id(x) for x in nodes}) == n
    assert sorted(b for b, _ in tree.root.items()) == sorted(k[0] for k in keys)


def test_paths_part_between_turns():
    """Turns that share bytes part in the middle of a turn; only whole turns are told."""
    tree, shared = turn_trie.RadixTree(), bytes(range(12))
    a, b = shared + b"aaaa", shared + b"bbbb"
    for conv, key in enumerate([a + b, a + a, a, b + a + b]):
        tree.place(key).ends.append(conv)
    told = list(tree.turns({a: 5, b: 7}))
    assert sorted((depth, n, least) for _, _, depth, _, n, least, *_ in told) == sorted([(0, 4, 0), (1, 3, 0), (2, 1, 0), (2, 1, 1), (1, 1, 3), (2, 1, 3), (3, 1, 3)])
    assert {depth for _, _, depth, *_ in told} == {0, 1, 2, 3} and len(dict(tree.ends())) == 4
