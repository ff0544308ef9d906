"""What a review found missing: long chains, short items, rows that share an id or have none, odd training texts, class words."""

import random

from rillmark.llm import jaccard_skip
from rillmark.llm.common import components


def test_components_of_long_shuffled_chains(spark):
    ids = random.Random(3).sample(range(10_000), 700)
    chains = [ids[:500], sorted(ids[500:])]
    edges = [(a, b) for c in chains for a, b in zip(c, c[1:])]
    got = {r.id: r.component for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {i: min(c) for c in chains for i in c}


def test_op6_long_chain_of_revisions(spark):
    text = [f"w{i}" for i in range(1600)]
    docs = spark.createDataFrame([(i, " ".join(text[3 * i : 3 * i + 50])) for i in range(500)], "doc_id long, text string")
    assert {(r.doc_id, r.component_id) for r in jaccard_skip.linked_documents(docs).collect()} == {(i, 0) for i in range(500)}


def test_op7_short_items_in_long_documents(spark):
    from rillmark.llm.minhash_contain import contained

    rng = random.Random(7)
    texts = [[f"w{rng.randrange(3000)}" for _ in range(3000)] for _ in range(12)]
    items = []
    for n in (2, 3, 4, 5, 6, 7, 8, 20, 37):
        for j in range(60):
            at = rng.randrange(4) if j % 2 else rng.randrange(2900)
            items.append(texts[j % 12][at : at + n])
    grams = lambda w, k: {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}
    have = {k: [grams(t, k) for t in texts] for k in range(2, 6)}
    want = set()
    for i, w in enumerate(items):
        mine = grams(w, min(5, len(w)))
        want |= {(d, i, len(mine & have[min(5, len(w))][d])) for d in range(12) if len(mine & have[min(5, len(w))][d]) >= 0.8 * len(mine)}
    docs = spark.createDataFrame([(d, " ".join(t)) for d, t in enumerate(texts)], "doc_id long, text string")
    table = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(items)], "item_id long, text string")
    assert {(r.doc_id, r.item_id, r.n_shared) for r in contained(docs, table).collect()} == want


def _rows(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, len(t)) for i, t, s in rows], "doc_id long, text string, lang string, source string, n_chars long").repartition(3)


def test_near_and_mix_decide_on_rows(spark):
    import corpus_pipeline

    text = lambda x: " ".join(f"{x}{j}" for j in range(60))
    rows = [(1, text("a"), "s")] * 3 + [(2, text("a"), "s"), (2, text("b"), "s"), (3, text("b") + " end", "s"), (None, text("a"), "s"), (None, text("c"), "s"), (None, text("c"), "s")]
    near = corpus_pipeline.near(spark, _rows(spark, rows), "")
    assert sorted((r.doc_id or 0, r.text) for r in near.collect()) == [(0, text("c")), (1, text("a")), (2, text("b"))]
    many = [(i % 4 or None, f"{i} " + "w " * (20 + i % 7), "s") for i in range(200)]
    mixed = [r.text for r in corpus_pipeline.mix(spark, _rows(spark, many), "").collect()]
    assert set(mixed) == {t for _, t, _ in many}  # each row is taken once or twice
    total = sum(len(t.split()) for _, t, _ in many)
    assert abs(sum(len(t.split()) for t in mixed) - 1.5 * total) < 60


def test_op6_links_through_a_row_without_id(spark):
    w = [f"w{i}" for i in range(60)]
    docs = _rows(spark, [(5, " ".join(w[:50]), "s"), (None, " ".join(w[3:53]), "s"), (9, " ".join(w[6:56]), "s")])
    assert {(r.doc_id, r.component_id) for r in jaccard_skip.linked_documents(docs).collect()} == {(5, 5), (None, 5), (9, 5)}


def test_op10_rows_without_id(spark):
    import hashlib

    from pyspark.sql import functions as F
    from rillmark.llm.prefix_fp import fingerprints_with_edits

    docs = _rows(spark, [(i if i % 3 else None, f"text {i} " * (3 + i), "s") for i in range(30)])
    order = [r.text for r in docs.orderBy(F.desc_nulls_last("doc_id"), F.xxhash64("text")).collect()]
    want = []
    for t, nxt in zip(order, order[1:] + order[:1]):
        half = len(t) // 2
        want.append(hashlib.sha256((t[: len(t) - half] + nxt[:half]).encode()).hexdigest())
    for per in (4000, 300):
        assert sorted(r.edited_sha256 for r in fingerprints_with_edits(docs, range_bytes=per).collect()) == sorted(want)


def test_op8_rejects_gibberish_and_learns_rare_languages(spark, tiny):
    from pyspark.sql import functions as F
    from rillmark.llm import kn_langid

    rng = random.Random(8)
    noise = lambda n: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(n))
    clean = spark.read.parquet(f"{tiny}/documents.parquet").select("doc_id", "text", "lang")
    greek = "η γλώσσα αυτή μιλιέται από λίγους ανθρώπους και γράφεται με δικά της γράμματα"
    odd = [(5000 + i, noise(300), "en") for i in range(4)] + [(6000, "привет мир как дела сегодня " * 5, "en")] + [(7000 + i, greek, x) for i, x in enumerate(("el", "g2", "g3", "g4", "g5", "g6"))]
    docs = clean.union(spark.createDataFrame(odd, clean.schema))
    model = kn_langid.train(docs, F.lit(True))
    assert {"el", "g2", "g3", "g4", "g5", "g6"} <= set(model.langs)
    tests = [(1, noise(300), None), (2, "ここに日本語の文章があります", None), (3, greek, None)]
    got = {r.doc_id: r.rejected for r in kn_langid.identify(spark.createDataFrame(tests, clean.schema), model).collect()}
    assert got == {1: True, 2: True, 3: False}
    letters = {r.doc_id for r in clean.collect() if any(c.isalpha() for c in r.text or "")}
    assert letters == {r.doc_id for r in kn_langid.keep_accepted(clean, model).collect()}


def test_op8_one_labelled_document(spark):
    from pyspark.sql import functions as F
    from rillmark.llm import kn_langid

    docs = spark.createDataFrame([(1, "a single text with a label and some letters", "en"), (2, "another text", None)], "doc_id long, text string, lang string")
    model = kn_langid.train(docs, F.lit(True))
    assert model.langs == ["en"] and {r.lang_pred for r in kn_langid.identify(docs, model).collect()} == {"en"}


def test_op4_class_words_on_the_frame_of_a_page():
    from rillmark.llm.html_blocks import main_text, train

    tree = train()
    story = "<p>The storm came in the night and took the old pier with it, and nobody in the whole town saw it go.</p>"
    text = "The storm came in the night and took the old pier with it, and nobody in the whole town saw it go."
    side = "<div class='sidebar'><p>Ten more stories of the sea that our readers have liked a lot this week</p></div>"
    assert main_text(f"<body class='right-sidebar'>{story}{side}</body>", tree) == text
    assert main_text(f"<body class='has-sidebar home'><article>{story}</article>{side}</body>", tree) == text
    assert main_text(f"<body><div id='page' class='with-header'><article>{story}</article>{side}</div></body>", tree) == text
    assert main_text(f"<body><div id='page' class='with-header'>{story * 3}</div>{side}</body>", tree) == "\n\n".join([text] * 3)
    assert main_text(f"<body><article class='post widget'>{story}</article>{side}</body>", tree) == text
    for head in ("div class='article-header'", "header class='entry-header'"):
        assert main_text(f"<body><article><{head}><h1>The old pier is gone</h1></{head.split()[0]}>{story}</article>{side}</body>", tree) == f"The old pier is gone\n\n{text}"
    remarks = "<div id='comments'>" + "<article class='comment-body'><p>I liked that pier very much and have walked on it for years, so thanks to all.</p></article>" * 5 + "</div>"
    teasers = "<div class='sidebar'><article><p>Ten more stories of the sea that our readers have liked.</p></article></div>"
    assert main_text(f"<body><article>{story}</article>{teasers}{remarks}</body>", tree) == text
