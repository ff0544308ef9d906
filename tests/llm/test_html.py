"""The extractor against the makers' own layout and hand-written pages."""

import re
import time

import pytest

from rillmark.llm.html_blocks import main_text, train
from rillmark.llm.queries import QUERIES


def test_pages_against_article(spark, tiny):
    import html

    pages = {r.page_id: r.html for r in spark.read.parquet(f"{tiny}/pages.parquet").collect()}
    got = QUERIES["op4_html_blocks"](spark, tiny).collect()
    assert len(got) == len(pages)
    for r in got:
        article = re.search(r"<article>(.*?)</article>", pages[r.page_id], re.S)[1]
        parts = re.split(r"</?(?:p|h1)\b[^>]*>", article.replace("<br>", " "))
        want = [" ".join(html.unescape(re.sub(r"<[^>]+>", "", x)).split()) for x in parts]
        assert r.text == "\n\n".join(x for x in want if x) and r.n_chars == len(r.text)


def test_odd_pages():
    tree = train()
    assert main_text(None, tree) == "" and main_text("", tree) == "" and main_text("<<<>>>", tree) is not None
    page = "<html><head><title>T</title><script>if (a < b) document.write('<p>no</p>')</script></head><body><header>Site name</header><article><h1>Tea &amp; time</h1><p>It is\n  four &#111;'clock &eacute; now<br>and the tea is ready for all of us to drink.</p><p>One.</p></article><div class='comments'><p>I like tea a lot and drink it all day long at work.</p></div><form><p>Send your name</p></form><footer>&copy; us</footer>"
    assert main_text(page, tree) == "Tea & time\n\nIt is four o'clock é now and the tea is ready for all of us to drink.\n\nOne."
    assert main_text("<body><p>" + "word " * 100_000, tree).count("word") == 100_000


STORY = "<p>The storm came in the night and took the old pier with it, and nobody in the whole town saw it go.</p>"
TEXT = "The storm came in the night and took the old pier with it, and nobody in the whole town saw it go."


@pytest.mark.parametrize(
    ("page", "want"),
    [
        (f"<body class='single no-sidebar'><article>{STORY}</article></body>", TEXT),
        (f"<body><div class='content has-sidebar'>{STORY}</div></body>", TEXT),
        (f"<body><section class='social policy'>{STORY}</section></body>", TEXT),
        (f"<body><article id='share-prices'>{STORY}</article></body>", TEXT),
        (f"<html><head><title>No</title><meta charset=utf-8><body>{STORY}", TEXT),
        (f"<html><head><title>No</title><div>{STORY}</div>", TEXT),
        (f"<body><article>{STORY}<p class=ad>Buy now<p>Then it was quiet again, and in the morning the sea was flat.</article>", f"{TEXT}\n\nThen it was quiet again, and in the morning the sea was flat."),
        (f"<body><article>{STORY}<p><a href=x>The whole report of the harbour master</a></p>{STORY}</article>", f"{TEXT}\n\nThe whole report of the harbour master\n\n{TEXT}"),
        ("<body><article><p>The pier <button>Show</button><select><option>1<option>2</select>was built by hand, in the year of the great comet.</p></article>", "The pier was built by hand, in the year of the great comet."),
        (f"<body><article title=it's>{STORY}</article>", TEXT),
        ("<body><article><ul><li>One stone, laid by the mayor<li>Two stones, laid by the priest</ul></article>", "One stone, laid by the mayor\n\nTwo stones, laid by the priest"),
        (f"<body><article><!-- <p>no</p> -->{STORY}<script>var a='</p><p>no';</script><style>p{{}}</style></article>", TEXT),
        ("<body><article><p>5 &lt; 6 &amp;&amp; x&nbsp;y &#x41; &nosuch; in the sum that they have done at school today</p></article>", "5 < 6 && x y A &nosuch; in the sum that they have done at school today"),
        (f"<body><article><b><p>The one half of the pier went first</b>, the other an hour later.</p>{STORY}</article>", f"The one half of the pier went first, the other an hour later.\n\n{TEXT}"),
        (f"<body><p hidden>Not shown to anyone who reads this page in the usual way</p><article>{STORY}</article>", TEXT),
        (f"<body><article>{STORY}</article><p>Cut <b", TEXT),
        (f"<body><div class='wrap'><div class='post-content'>{STORY}</div><div class='comments'><p>I was there and saw all of it, whatever they say in the town, for we had gone out to look after our boat, and then it was far too late to go home again.</p><p>Me too.</p></div></div></body>", TEXT),
        (f"<body><article><div class='top'>{STORY}</div>{STORY}</article></body>", f"{TEXT}\n\n{TEXT}"),
        (f"<body><article>{STORY}<section class='news menu-card'>{STORY}</section></article></body>", f"{TEXT}\n\n{TEXT}"),
        (f"<body><article>{STORY}<div class='gdpr-wall'>We would like to keep some files on your device from now on.</div>{STORY}<div class='sponsorblock'>All of this comes to you from the bank of the valley, since 1880.</div>{STORY}</article></body>", f"{TEXT}\n\n{TEXT}\n\n{TEXT}"),
        (f"<body><main>{STORY}</main><section class='respond commentlist'><article><p>{'I saw it go and told them so. ' * 20}</p></article></section></body>", TEXT),
    ],
)
def test_pages_as_people_write_them(page, want):
    assert main_text(page, train()) == want


def test_the_tree_uses_word_counts_and_link_densities_of_neighbours():
    from rillmark.llm.html_blocks import LABELLED_PAGES, blocks, features

    tree = train()
    used = tree.used()
    assert {"words", "links"} <= used and used & {"words_before", "words_after"} and used & {"links_before", "links_after"}
    for page in LABELLED_PAGES:
        found = blocks(page)
        assert [b[0][0] == "+" for b in found] == tree.keep(features(found, tree.odds)).tolist()
    # Without any words of classes, and without an article.
    page = "<body><div><a>Home</a></div><div><a>Sports</a></div><h2>The pier</h2>" + STORY + "<p>It rained.</p>" + STORY + "<div><a>More of this</a></div><div><a>Older news</a></div></body>"
    assert main_text(page, tree) == f"The pier\n\n{TEXT}\n\nIt rained.\n\n{TEXT}"


@pytest.mark.parametrize("piece", ["<a ", "<li>", "<div><p>", "</b>", "<!--", "<a x=\"", "<a x='y' z=\"", "<", "</", "<script>", "<td><table>", "<a>", "<p class=ad>", "&", "<head><div>", "<button></p>", "<div class=a>x", "<article>x", "<article class=top><p>x", "<main><div id=a><article>x y"])
def test_reading_takes_time_in_proportion_to_the_page(piece):
    tree = train()
    seconds = []
    for size in (125_000, 1_000_000):
        page = piece * (size // len(piece))
        began = time.process_time()
        main_text(page, tree)
        seconds.append(time.process_time() - began)
    assert seconds[1] < 1 if piece == "<a " else seconds[1] < 24 * max(seconds[0], 0.02)


def test_deep_pages_take_memory_in_proportion():
    import tracemalloc

    tree, held = train(), []
    for n in (7_000, 70_000):
        page = "<div class=a>x" * n
        began = time.process_time()
        main_text(page, tree)
        assert time.process_time() - began < 15
        tracemalloc.start()
        assert main_text(page, tree).count("x") in (0, n)
        held.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
    assert held[1] < 14 * held[0] and held[1] < 300e6
