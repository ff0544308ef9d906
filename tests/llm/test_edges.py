"""Every operator on rows that are null, empty, very long, alike or tied, and beside columns whose names it uses itself."""

import pytest

from rillmark.llm.queries import QUERIES

CLASHING = "owner piece twin doc want spans n at size body first_doc key token top balls signature block cells row number half rank curve shard slot part head tie down lines gone id h1 h2 rows copies p level whole target item_id fingerprint label component_id score _at _part".split()
LONG = " ".join(f"word{i % 5003} of line {i // 9}" + ("\n" if i % 9 == 8 else "") for i in range(130_000))  # about 3 MB


@pytest.fixture(scope="module")
def awkward(spark, tmp_path_factory):
    words = " ".join(f"w{i}" for i in range(120))
    rows = [(1, words), (1, words), (1, words + " other"), (2, words), (3, None), (4, ""), (5, " \n "), (6, LONG), (7, LONG[: len(LONG) // 2]), (None, words), (None, None), (8, "tie"), (9, "tie")]
    rows = [(d, t, "en" if d and d % 2 else None, None if d == 2 else "s", None, *CLASHING) for d, t in rows]
    out = str(tmp_path_factory.mktemp("awkward"))
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASHING)
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(f"{out}/documents.parquet")
    items = [(1, " ".join(f"w{i}" for i in range(40, 60)), "x"), (2, None, "x"), (3, "", "x"), (4, "tie", "x"), (4, "tie", "x")]
    spark.createDataFrame(items, "item_id long, text string, doc_id string").write.parquet(f"{out}/benchmark.parquet")
    page = "<body><article><p>" + "A sentence of a very long page, with words enough to count. " * 40_000 + "</p></article></body>"
    pages = [(1, "u", page, "x"), (None, None, None, "x"), (2, "u", "", "x"), (2, "u", "", "x"), (3, "u", "<p>Short", "x")]
    spark.createDataFrame(pages, "page_id long, url string, html string, text string").write.parquet(f"{out}/pages.parquet")
    turns = [(1, 0, "user", "hi", "x"), (1, 0, "user", "hi", "x"), (1, None, None, None, "x"), (None, 1, "user", "lost", "x"), (100, None, "", "", "x"), (101, 3, "user", LONG, "x"), (102, 1, "user", "hi", "x")]
    spark.createDataFrame(turns, "conv_id long, turn long, role string, text string, node string").repartition(3).write.parquet(f"{out}/conversations.parquet")
    return out


def ids(rows, name="doc_id"):
    return sorted(-1 if r[name] is None else r[name] for r in rows)


ALL = [-1, -1, 1, 1, 1, 2, 3, 4, 5, 6, 7, 8, 9]


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in ("op4_html_blocks", "op7_minhash_contain", "op11_turn_trie", "op12_phrase_tries", "pipeline")])
def test_each_document_gives_a_row(spark, awkward, name):
    got = QUERIES[name](spark, awkward).collect()
    assert ids(got) == ALL
    if name.startswith("op10"):
        same = {r.fingerprint for r in got if r.doc_id in (8, 9)}
        assert len(same) == 1
    if name.startswith(("op6", "op13")):
        of = {}
        for r in got:
            of.setdefault(r.doc_id, set()).add(r.component_id)
        assert of[2] == {1} and of[9] == {8} and of[None] == {1, None} and of[3] == {3}
    if name.startswith("op9"):
        assert all(r.taken <= 2 * r["size"] for r in got)
    if name.startswith("op8"):
        assert {r.doc_id for r in got if r.lang_pred == "und"} >= {3, 4, 5}


def test_op4(spark, awkward):
    got = QUERIES["op4_html_blocks"](spark, awkward).collect()
    assert ids(got, "page_id") == [-1, 1, 2, 2, 3] and max(r.n_chars for r in got) == 40_000 * 60 - 1


def test_op7(spark, awkward):
    got = QUERIES["op7_minhash_contain"](spark, awkward).collect()
    assert sorted((r.doc_id or -1, r.item_id) for r in got) == sorted([(-1, 1), (1, 1), (1, 1), (1, 1), (2, 1), *[(d, 4) for d in (8, 8, 9, 9)]])


def test_pipeline(spark, awkward):
    got = QUERIES["pipeline"](spark, awkward).collect()
    assert {r.doc_id for r in got} <= {1, 6, 7, None} and {c for c in CLASHING if c not in ("shard", "slot")} <= set(got[0].asDict())


def test_op11(spark, awkward):
    got = QUERIES["op11_turn_trie"](spark, awkward).collect()
    root = [r for r in got if r.depth == 0]
    assert [(r.conv_id, r.parent_conv_id, r.n_convs) for r in root] == [(1, None, 4)]
    assert len({(r.conv_id, r.depth) for r in got}) == len(got) and all(r.n_leaves >= 1 and r.saved_tokens >= 0 for r in got)


def test_op12(spark, awkward):
    """The long text counts in both of its rows; phrases that end at a line end only."""
    got = {(r.lang, r.phrase): r for r in QUERIES["op12_phrase_tries"](spark, awkward).collect()}
    assert got["und", "of line"].a == sum(x.count("of line") for x in (LONG,)) and got["en", "of line"].a == LONG[: len(LONG) // 2].count("of line")
    assert all(r.a >= 100 and r.l >= r.a and r.r >= r.a for r in got.values())
