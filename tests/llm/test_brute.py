"""Each corpus query against a brute-force version of its contract, on the smallest tables and on awkward ones."""

import binascii
import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

import corpus_pipeline
from rillmark.llm import jaccard_skip
from rillmark.llm.queries import QUERIES

BLANK = re.compile(r"[\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, extra string"


def words(t):
    return [w for w in BLANK.split(t or "") if w]


def sha(x):
    return hashlib.sha256(x if isinstance(x, bytes) else x.encode()).hexdigest()


AWKWARD = [
    None, "", " \t\n ", "one", "one", "one two three", "a " * 400, "abc" * 500, "x\n\ny\n", " éß 中文 \U0001f600 text",
    "the quick brown fox " * 30, "The Quick brown fox " * 30, "z" * 5000, "1234 5678 !!", "line\r\nline \n LINE", *["Shared Line\nown %d" % i for i in range(12)],
]


@pytest.fixture(scope="module")
def cases(spark, tiny, tmp_path_factory):
    """(folder, documents as tuples) of the smallest tables with awkward rows added, repeated rows and equal ids among them."""
    base = spark.read.parquet(f"{tiny}/documents.parquet").limit(120).select("doc_id", "text", "lang", "source", "n_chars").collect()
    rows = [(*tuple(r), "e") for r in base]
    rows += [(1000 + i, t, "en" if i % 3 else None, "src0" if i % 2 else None, None, None) for i, t in enumerate(AWKWARD)]
    rows += [rows[3], rows[3]]
    out = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{out}/documents.parquet")
    for t in ("benchmark", "pages"):
        spark.read.parquet(f"{tiny}/{t}.parquet").write.parquet(f"{out}/{t}.parquet")
    return out, rows


def run(spark, name, folder):
    q = next(f for n, f in QUERIES.items() if n.startswith(name))
    return [r.asDict() for r in q(spark, folder).collect()]


def same(got, want, *cols):
    assert Counter(tuple(r[c] for c in cols) for r in got) == Counter(want)


def test_op1(spark, cases):
    folder, rows = cases
    first = {}
    split = [(r[0], words(r[1])) for r in rows]
    for d, w in split:
        for i in range(len(w) - 49):
            k = tuple(w[i : i + 50])
            first[k] = min(first.get(k, d), d)
    want = []
    for d, w in split:
        gone = set()
        for i in range(len(w) - 49):
            if first[tuple(w[i : i + 50])] < d:
                gone.update(range(i, i + 50))
        want.append((d, len(w), len(gone), sha(" ".join(x for i, x in enumerate(w) if i not in gone))))
    same(run(spark, "op1_", folder), want, "doc_id", "n_words", "n_removed", "kept_sha256")
    assert sum(w[2] for w in want)


def test_op2(spark, cases):
    folder, rows = cases
    key = lambda x: "".join(c.lower() if "A" <= c <= "Z" else c for c in x.strip(" \t\n\x0b\x0c\r"))
    docs = defaultdict(set)
    for n, r in enumerate(rows):
        for x in (r[1] or "").split("\n"):
            docs[key(x)].add(n)
    want = []
    for r in rows:
        lines = (r[1] or "").split("\n")
        kept = [x for x in lines if not (key(x) and len(docs[key(x)]) >= 10)]
        want.append((r[0], len(lines), len(lines) - len(kept), sha("\n".join(kept))))
    same(run(spark, "op2_", folder), want, "doc_id", "n_lines", "n_dropped", "kept_sha256")
    assert sum(w[2] for w in want) >= 12


def test_op3(spark, cases):
    folder, rows = cases
    got = run(spark, "op3_", folder)
    same(got, [(r[0], len((r[1] or "").encode()) + 1, binascii.crc32((r[1] or "").encode())) for r in rows], "doc_id", "size", "text_crc32")
    slots = defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
    assert sorted(slots) == list(range(8)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1


def test_op5(spark, cases):
    folder, rows = cases
    seen = Counter()
    data = [(r[0], (r[1] or "").encode()) for r in rows]
    for _, b in data:
        seen.update(b[i : i + 200] for i in range(len(b) - 199))
    want = []
    for d, b in data:
        gone = bytearray(len(b))
        for i in range(len(b) - 199):
            if seen[b[i : i + 200]] > 1:
                gone[i : i + 200] = b"\1" * 200
        spans = len(re.findall(b"\1+", gone))
        want.append((d, len(b), sum(gone), spans, sha(bytes(x for x, g in zip(b, gone, strict=True) if not g))))
    same(run(spark, "op5_", folder), want, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def groups(rows, k, percent):
    low = lambda t: "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
    sets = []
    for r in rows:
        w = words(low(r[1]))
        sets.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set()))
    top = list(range(len(rows)))

    def find(i):
        while top[i] != i:
            i = top[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                top[find(i)] = find(j)
    least = {}
    for i, r in enumerate(rows):
        least[find(i)] = min(least.get(find(i), r[0]), r[0])
    return [(r[0], len(sets[i]), least[find(i)]) for i, r in enumerate(rows)]


def test_op6(spark, cases):
    folder, rows = cases
    want = groups(rows, 4, 85)
    same(run(spark, "op6_", folder), want, "doc_id", "n_shingles", "component_id")
    assert len({w[2] for w in want}) < len(want)


def test_op6_chain(spark, tmp_path):
    """Sets that link only in a chain, and a large group of near copies, give one component each."""
    base = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(base[i : i + 50]), None, None, None, None) for i in range(10)]
    rows += [(100 + i, " ".join(f"v{j}" if j != i else f"edit{i}" for j in range(90)), None, None, None, None) for i in range(80)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    same(run(spark, "op6_", str(tmp_path)), groups(rows, 4, 85), "doc_id", "n_shingles", "component_id")


def test_op6_signatures_never_rule_out_a_link(spark):
    rng = np.random.default_rng(6)
    whole = np.unique(rng.integers(0, 1 << 52, 100_000, dtype=np.uint64))  # beyond 255 a cell
    sets = [whole, whole[:-9_000], whole[:70_000], whole[:300], whole[:250], whole[200:500], whole[:1], whole[1:2]]
    offsets = np.cumsum([0, *map(len, sets)])
    signatures = jaccard_skip._signatures(np.concatenate(sets), offsets).to_pylist()
    rows = spark.createDataFrame([(i, len(x), bytearray(s)) for i, (x, s) in enumerate(zip(sets, signatures, strict=True))], "key long, n int, signature binary")
    pairs = spark.createDataFrame([(i, j) for i in range(8) for j in range(i + 1, 8)], "a long, b long")
    got = jaccard_skip.bounded(pairs, rows, 80).collect()
    assert len(got) == 28
    for r in got:
        both = len(np.intersect1d(sets[r.a], sets[r.b]))
        union = len(sets[r.a]) + len(sets[r.b]) - both
        assert r.least <= 1 - both / union + 1e-12
        assert r.can or 100 * both < 80 * union
    assert not all(r.can for r in got)


def test_op7(spark, cases, tiny):
    folder, rows = cases
    grams = lambda w, k: {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}
    low = lambda t: t.translate({c: c + 32 for c in range(65, 91)})
    want = []
    for item in spark.read.parquet(f"{tiny}/benchmark.parquet").collect():
        w = words(low(item.text))
        mine = grams(w, min(5, len(w)))
        for r in rows:
            both = len(mine & grams(words(low(r[1] or "")), min(5, len(w))))
            if mine and both >= 0.8 * len(mine):
                want.append((r[0], item.item_id, len(mine), both))
    assert want
    same(run(spark, "op7_", folder), want, "doc_id", "item_id", "n_item", "n_shared")


def test_op7_short_items_and_blocks(spark):
    from rillmark.llm.minhash_contain import contained

    docs = spark.createDataFrame([(1, "say HELLO world to all"), (2, "hello there"), (3, None), (4, "")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "hello world"), (2, None), (3, ""), (4, "there"), (5, "hello world")], "item_id long, text string")
    want = {(1, 1), (1, 5), (2, 4)}
    for size in (1 << 20, 20):
        assert {(r.doc_id, r.item_id) for r in contained(docs, items, block_bytes=size).collect()} == want
    assert contained(docs, items.limit(0)).count() == 0


def test_op8(spark, tiny):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{tiny}/documents.parquet").collect()}
    got = run(spark, "op8_", tiny)
    assert len(got) == len(docs)
    held = [r for r in got if r["held_out"] and docs[r["doc_id"]].lang]
    assert all(r["held_out"] == (binascii.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in got)
    assert sum(r["lang_pred"] == docs[r["doc_id"]].lang for r in held) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 for r in got)


def test_op8_odd_texts(spark, cases):
    folder, rows = cases
    got = {(r["doc_id"], r["lang_pred"] == "und") for r in run(spark, "op8_", folder)}
    assert got == {(r[0], not any(c.isalpha() for c in r[1] or "")) for r in rows}


def test_kneser_ney_sums_to_one():
    import numpy as np

    from rillmark.llm import kn_langid as k

    text = ["the cat sat on the mat and the rat sat on the cat " * 3]
    codes, offsets = k.symbols(text)
    at = k._scored(offsets)
    grams = np.stack([codes[at - j] for j in range(k.ORDER - 1, -1, -1)], 1).astype(np.int32)
    uniq, n = np.unique(grams, axis=0, return_counts=True)
    model = k.build({"en": (uniq, n)})
    alphabet = np.unique(codes)
    for head in (" th", "zzz", "at "):
        ctx = k._letters()[[ord(c) for c in head]]
        seqs = np.concatenate([np.append(ctx, c) for c in [*alphabet, ord("ß")]]).astype(np.uint32)
        p = np.exp(model._lookup(seqs, np.arange(3, len(seqs), 4), k.ORDER).astype(float))[:, 0]
        assert abs(p[:-1].sum() + p[-1] * (200_000 - len(alphabet)) - 1) < 1e-4  # each symbol never seen gets the same


def test_op9(spark, cases):
    folder, rows = cases
    got = run(spark, "op9_", folder)
    size = Counter()
    for r in rows:
        size[r[3]] += len(words(r[1]))
    names = sorted(s for s in size if s is not None) + [None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    target, left, total = {}, set(names), 1.5 * sum(size.values())
    while True:
        unit = total / sum(weight[s] for s in left)
        over = [s for s in left if weight[s] * unit > 2 * size[s]]
        if not over:
            target |= {s: weight[s] * unit for s in left}
            break
        for s in over:
            target[s] = 2 * size[s]
            total -= target[s]
            left.remove(s)
    src = {r[0]: r[3] for r in rows}
    taken, most = Counter(), Counter()
    same(got, [(r[0], len(words(r[1])), size[r[3]]) for r in rows], "doc_id", "size", "source_size")
    for r in got:
        s = src[r["doc_id"]]
        assert abs(r["target"] - target[s]) < 1e-6 * max(1, target[s]) and 0 <= r["taken"] <= 2 * r["size"]
        taken[s] += r["taken"]
        most[s] = max(most[s], r["size"])
    assert all(abs(taken[s] - target[s]) <= most[s] for s in names)
    assert sorted(map(str, got)) == sorted(map(str, run(spark, "op9_", folder)))


def test_flight_keeps_both_totals():
    import numpy as np

    from rillmark.llm.cube_mix import flight

    rng = np.random.default_rng(2)
    size = rng.integers(1, 500, 400).astype(float)
    p = flight(np.full(400, 0.3), size, rng)
    assert ((p > 1e-9) & (p < 1 - 1e-9)).sum() <= 2
    assert abs(p.sum() - 120) < 1e-6 and abs((p * size).sum() - 0.3 * size.sum()) < 1e-3


def test_op10(spark, cases):
    folder, rows = cases
    got = run(spark, "op10_", folder)
    text = {r[0]: r[1] or "" for r in rows}
    ids = sorted((r[0] for r in rows), reverse=True)
    want = []
    for d, nxt in zip(ids, ids[1:] + ids[:1], strict=True):
        half = len(text[d]) // 2
        want.append((d, len(text[d]), sha(text[d][: len(text[d]) - half] + text[nxt][:half])))
    same(got, want, "doc_id", "n_chars", "edited_sha256")
    by_text = defaultdict(set)
    for r in got:
        by_text[text[r["doc_id"]]].add(r["fingerprint"])
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
    assert all(len(v) == 1 for v in by_text.values()) and len({next(iter(v)) for v in by_text.values()}) == len(by_text)


def test_op10_many_ranges(spark, tiny):
    from rillmark.llm.prefix_fp import fingerprints_with_edits

    docs = spark.read.parquet(f"{tiny}/documents.parquet")
    a = {r.doc_id: r.edited_sha256 for r in fingerprints_with_edits(docs).collect()}
    for per in (9, 2):
        b = fingerprints_with_edits(docs, range_bytes=per * 1000).collect()
        assert {r.doc_id: r.edited_sha256 for r in b} == a and len(b) == len(a)


def test_prefix_extension():
    from rillmark.llm import prefix_fp as p

    a, b = "hello brave new world", "say: hello brave old world"
    x, y = p.Prefix(p.code_points(a)), p.Prefix(p.code_points(b))
    assert p.common_extension(x, 0, y, 5) == len("hello brave ") and p.equal(x, 16, y, 21, 5) and not p.equal(x, 0, y, 0, 3)


def test_pipeline(spark, cases):
    """Each stage on its own input: what it keeps, and that all but the last keep the columns."""
    folder, rows = cases
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)

    def ids(df):
        return Counter(r.doc_id for r in df.select("doc_id").collect())

    accepted = stages["language"](spark, docs, folder)
    letters = Counter(r[0] for r in rows if any(c.isalpha() for c in r[1] or ""))
    assert accepted.columns == docs.columns and not ids(accepted) - letters
    assert not {d for d in letters - ids(accepted) if d < 1000}  # clean texts stay
    near = stages["near"](spark, docs, folder)
    assert near.columns == docs.columns and set(ids(near)) == {c for _, _, c in groups(rows, 5, 80)}
    clean = stages["benchmark"](spark, docs, folder)
    leaks = {r["doc_id"] for r in run(spark, "op7_", folder)}
    assert clean.columns == docs.columns and ids(clean) == Counter({d: n for d, n in ids(docs).items() if d not in leaks}) and leaks
    mixed = stages["mix"](spark, near, folder)
    had = ids(near)
    assert mixed.columns == docs.columns and all(n <= 2 * had[d] for d, n in ids(mixed).items())
    total = sum(len(words(r.text)) for r in near.collect())
    assert abs(sum(len(words(r.text)) for r in mixed.collect()) - 1.5 * total) < 0.05 * total
    out = corpus_pipeline.run(spark, folder).collect()
    assert out and set(docs.columns) | {"shard", "slot"} == set(out[0].asDict())
    per = Counter(r.shard for r in out)
    assert max(per.values()) - min(per.values()) <= 1 and len({(r.shard, r.slot) for r in out}) == len(out)


@pytest.mark.parametrize("name", [n for n in QUERIES])
def test_empty_tables(spark, cases, tiny, name, tmp_path_factory):
    folder, _ = cases
    out = str(tmp_path_factory.mktemp("empty"))
    for t in ("documents", "benchmark", "pages"):
        spark.read.parquet(f"{folder}/{t}.parquet").limit(0).write.parquet(f"{out}/{t}.parquet")
    spark.read.parquet(f"{tiny}/conversations.parquet").limit(0).write.parquet(f"{out}/conversations.parquet")
    assert QUERIES[name](spark, out).collect() == []


def test_a_store_of_line_runs_opens_again(spark, tmp_path):
    """Three sessions add their documents one after the other; what each drops counts all before, runs are compacted, and merges shuffle nothing."""
    from rillmark.llm import line_runs
    from rillmark.llm.line_runs import LineRuns, drop_frequent_lines

    store, seen = f"file://{tmp_path}/store", {}
    for k in range(3):
        rows = [(k * 100 + i, f"all\nmod {i % 7}\nown {k} {i}\nof session {k}") for i in range(20)]
        for _, t in rows:
            for x in set(t.split("\n")):
                seen[x] = seen.get(x, 0) + 1
        session = spark.newSession()
        got = drop_frequent_lines(session.createDataFrame(rows, "doc_id long, text string"), min_docs=8, store_path=store, batches=4).collect()
        assert {r.doc_id: r.text for r in got} == {d: "\n".join(x for x in t.split("\n") if seen[x] < 8) for d, t in rows}
    held = LineRuns(spark.newSession(), store, 8)
    assert held.version == 12 and sorted(level for level, _ in held.runs) == [-1, 2, 3]
    a, b = [r for level, r in held.runs if level > 0]
    with line_runs._in_order(held.spark):
        for plan in (line_runs.merge(a, b), a.hint("merge").join(held.level(-1)[0].hint("merge"), ["h1", "h2"], "left_anti")):
            plan = plan._jdf.queryExecution().executedPlan().toString()
            assert "SortMergeJoin" in plan and "Exchange" not in plan and "Sort [" not in plan
    assert held.frequent().count() == sum(n >= 8 for n in seen.values()) == held.frequent().distinct().count()
    for _, r in held.runs:
        assert r.count() == r.select("h1", "h2").distinct().count()
