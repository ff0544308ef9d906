"""Main text of web pages from flat text blocks.

A page is cut into flat blocks at block-level tags, with the end tags that HTML implies. Each block has its word count and
link density, those of the blocks before and after it, whether it stands in boilerplate elements, in or beside the
article, and how the class, id and role words around it are spread over the labelled blocks. A decision tree, trained on
the blocks of a small table of labelled pages, keeps or drops each block.

Words mark an element, but never the page's frame: not html, body, main or article; not an element that encloses the
article or main with the most words, or that holds half of its words; nor, on a page without these, one that holds two
thirds of the words that no comments hold. An article among comments is not the page's. What a word says is learned from
the labelled pages, as log odds that add up over the elements around a block, apart for elements inside and outside an
article; what it says elsewhere counts half, a word that they do not have says what the longest of theirs within it says,
or nothing. Which words lists of readers' comments have is learned likewise.

Reading takes time and memory in proportion to the page: no part of it is searched again, whatever is left open, and a
block knows the innermost marked element around it, an element the next one around itself.

Defined results: null and empty pages give an empty text; a page cut off anywhere is read as far as it goes, and an
attribute's value that is never closed ends the page; unknown references stay as written; elements with the attribute
hidden are not shown; repeated rows give repeated results, pages without an id or url keep null there; an empty table
gives an empty result; only page_id, url and the html column are read, so others may have any name. Very long pages are
read as a whole.
"""

from __future__ import annotations

import html as _html
import math
import re
from collections import Counter
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Element names of HTML by what they do to the flow of text.
BLOCK_TAGS = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre search section summary table caption tbody td tfoot th thead title tr ul".split())
HIDDEN_TAGS = frozenset("template svg object canvas math select datalist button head audio video".split())
ASIDE_TAGS = frozenset("nav footer aside form menu dialog search".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW_TAGS = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
HEAD_TAGS = frozenset("base basefont bgsound link meta title script style template noscript head html".split())
FRAME_TAGS = frozenset("html body main article".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: What a start tag closes, as far up as the nearest of the second.
IMPLIED = {
    "li": ("li", "ul ol menu dir"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"), "option": ("option", "select"), "optgroup": ("option optgroup", "select"),
    "td": ("td th", "tr table"), "th": ("td th", "tr table"), "tr": ("tr", "tbody thead tfoot table"), "tbody": ("tbody thead tfoot caption", "table"), "thead": ("tbody thead tfoot caption", "table"), "tfoot": ("tbody thead tfoot caption", "table"),
}
IMPLIED = {k: tuple(x.split() for x in v) for k, v in IMPLIED.items()}
#: Elements whose end tags outside, and paragraphs outside, nothing inside closes.
SCOPES = frozenset("td th caption table button object template".split())
ENDS_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section summary table ul".split())
_NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
_ATTR = re.compile(r"[\s/]*([^\s/>=]?[^\s/>=]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"'][^\s>]*)|([\"'])))?")
_RAW_END = {t: re.compile(rf"</{t}(?=[\s/>])", re.I) for t in RAW_TAGS}
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
FEATURES = ("words", "links", "words_before", "links_before", "words_after", "links_after", "aside", "article", "said")


@cache
def class_words(value: str) -> tuple[str, ...]:
    """The words of a class, id or role, without plural s or numbers."""
    parts = (w.strip("0123456789").lower() for w in re.split(r"[^A-Za-z0-9]+", _CAMEL.sub(" ", value)))
    return tuple(dict.fromkeys(w[:-1] if w.endswith("s") and len(w) > 3 else w for w in parts if w))


def _tags(page: str) -> Iterator[tuple[int, int, str, bool, dict]]:
    """(start, end, name, whether it is an end tag, attributes) of each tag; comments and the like have no name."""
    at, n = 0, len(page)
    while True:
        i = page.find("<", at)
        if i < 0 or i + 1 >= n:
            return
        m = _NAME.match(page, i)
        if not m:
            if page.startswith("<!--", i):
                end = page.find("-->", i + 4)
                at = end + 3 if end >= 0 else n
            elif page[i + 1] in "!?" or page.startswith("</", i):
                end = page.find(">", i + 1)
                at = end + 1 if end >= 0 else n
            else:
                at = i + 1  # a character like any other
                continue
            yield i, at, "", False, {}
            continue
        found: dict[str, str] = {}
        at = m.end()
        while True:
            while at < n and page[at] in " \t\n\r\f/":
                at += 1
            if at >= n or page[at] == ">":
                break
            a = _ATTR.match(page, at)
            if a[5]:  # an open quote that nothing closes
                at = n
                break
            found.setdefault(a[1].lower(), a[2] or a[3] or a[4] or "")
            at = max(a.end(), at + 1)
        name = m[1].lower()
        if at >= n:
            yield i, n, "", False, {}
            return
        at += 1
        yield i, at, name, page[i + 1] == "/", found
        if name in RAW_TAGS and page[i + 1] != "/":
            end = _RAW_END[name].search(page, at)
            at = end.start() if end else n


class _Open:
    """The open elements, with the places of each name, so that no look-up walks through them."""

    def __init__(self):
        self.stack: list[tuple] = []
        self.places: dict[str, list[int]] = {}
        self.scopes: list[int] = [-1]
        self.block: list[int] = [-1]

    def last(self, names) -> int:
        return max((self.places[x][-1] for x in names if self.places.get(x)), default=-1)

    def push(self, name: str, *flags) -> None:
        self.places.setdefault(name, []).append(len(self.stack))
        if name in SCOPES:
            self.scopes.append(len(self.stack))
        if name in BLOCK_TAGS:
            self.block.append(len(self.stack))
        self.stack.append((name, *flags))

    def pop(self) -> tuple:
        top = self.stack.pop()
        self.places[top[0]].pop()
        if top[0] in SCOPES:
            self.scopes.pop()
        if top[0] in BLOCK_TAGS:
            self.block.pop()
        return top


class Page(list):
    """The flat blocks of a page, (text, words, words in links, in a boilerplate element, place, mark), in page order.

    place is 1 in the article or main with the most words, -1 outside of it on a page that has one, else 0. A mark is the
    number of the innermost element around the block that has class words, -1 without one; said has the words of each mark,
    with whether it is inside an article, above the mark around it, and frame the marks that are the page's frame.
    """

    said: list[tuple]
    above: list[int]
    frame: set[int]

    def around(self, mark: int, frame: bool = False) -> Iterator[tuple]:
        """The words of a mark and of those around it; those of the frame only if asked for."""
        while mark >= 0:
            if frame or mark not in self.frame:
                yield from self.said[mark]
            mark = self.above[mark]


class Odds:
    """What class words say: log odds by (word, whether inside an article)."""

    def __init__(self, log_odds: dict[tuple[str, bool], float]):
        self.log_odds, self.told = log_odds, {}
        self.words = sorted({w for w, _ in log_odds if len(w) >= 4}, key=lambda w: (-len(w), w))

    def __call__(self, word: str, inside: bool) -> float:
        if (word, inside) not in self.told:
            known = next((w for w in (word, *(x for x in self.words if x in word)) if (w, inside) in self.log_odds or (w, not inside) in self.log_odds), None)
            say = self.log_odds.get((known, inside))
            if len(self.told) > 100_000:
                self.told.clear()
            self.told[word, inside] = self.log_odds.get((known, not inside), 0.0) / 2 if say is None else say
        return self.told[word, inside]


def blocks(page: str, comments: Odds | None = None) -> Page:
    """The flat blocks of a page. comments: which words mark lists of readers' comments; as the labelled pages tell by default."""
    comments = comments or _comment_odds()
    out: list[tuple] = []
    text: list[str] = []
    linked: list[str] = []
    open_ = _Open()
    asides = hidden = links = 0
    mark = article = -1  # the innermost marked element and article or main
    said: list[tuple] = []  # of each marked element, the words
    above: list[int] = []
    outer: list[int] = []  # of each article or main, the one around it
    around: list[int] = []  # and the mark around it

    def flush() -> None:
        if text:
            t = " ".join(_html.unescape("".join(text)).split())
            if t:
                inside = len(_html.unescape("".join(linked)).split())
                out.append((t, t.count(" ") + 1, inside, asides > 0, mark, article))
        text.clear()
        linked.clear()

    def take(piece: str) -> None:
        if piece and not hidden:
            text.append(piece)
            if links:
                linked.append(piece)

    def close(upto: int) -> None:
        nonlocal asides, hidden, links, mark, article
        while len(open_.stack) > upto:
            name, aside, marked, covered = open_.pop()
            if name in BLOCK_TAGS:
                flush()
            asides -= aside
            hidden -= covered
            links -= name == "a"
            if marked:
                mark = above[mark]
            if name in ("article", "main"):
                article = outer[article]

    at = 0
    for start, end, tag, closing, found in _tags(page):
        if start > at:
            piece = page[at:start]
            head = open_.last(("head",))
            if head >= 0 and len(open_.stack) == head + 1 and not piece.isspace():
                close(head)
            if open_.stack and open_.stack[-1][0] in RAW_TAGS:
                close(len(open_.stack) - 1)
            else:
                take(piece)
        at = end
        if not tag:
            continue
        if tag in BLOCK_TAGS:
            flush()
        elif tag == "br":
            take(" ")
        if closing:
            place = open_.last((tag,))
            within = open_.scopes[-1] if tag not in SCOPES and tag not in FRAME_TAGS else -1
            if place > within and (tag in BLOCK_TAGS or tag == "a" or place > open_.block[-1]):  # <b><p></b> leaves the p open
                close(place)
            continue
        if tag not in HEAD_TAGS and (head := open_.last(("head",))) >= 0:
            close(head)
        if tag in ENDS_P and (place := open_.last(("p",))) > open_.scopes[-1]:
            close(place)
        if tag in IMPLIED:
            names, upto = IMPLIED[tag]
            if (place := open_.last(names)) > open_.last(upto):
                close(place)
        elif tag in HEADINGS and open_.stack and open_.stack[-1][0] in HEADINGS:
            close(len(open_.stack) - 1)
        elif tag == "a" and (place := open_.last(("a",))) > open_.scopes[-1] and place > open_.block[-1]:
            close(place)
        if tag in VOID_TAGS:
            continue
        words = tuple(w for k in ("class", "id", "role") if k in found for w in class_words(found[k]))
        marked = bool(words) and tag not in FRAME_TAGS
        aside = tag in ASIDE_TAGS or (tag == "header" and article < 0)
        covered = tag in HIDDEN_TAGS or "hidden" in found
        open_.push(tag, aside, marked, covered)
        asides += aside
        hidden += covered
        links += tag == "a"
        if marked:
            said.append(tuple((w, article >= 0) for w in words))
            above.append(mark)
            mark = len(said) - 1
        if tag in ("article", "main"):
            around.append(mark)
            outer.append(article)
            article = len(around) - 1
    if at < len(page) and not (open_.stack and open_.stack[-1][0] in RAW_TAGS):
        take(page[at:-1] if page.endswith("<") else page[at:])
    flush()
    return _placed(out, said, above, outer, around, comments)


def _placed(found: list[tuple], said: list[tuple], above: list[int], outer: list[int], around: list[int], comments: Odds) -> Page:
    """The page of blocks (text, words, words in links, in a boilerplate element, mark, article); each list is gone through once."""
    remark = [False] * len(said)  # whether a mark is in readers' comments
    for k, words in enumerate(said):
        remark[k] = above[k] >= 0 and remark[above[k]] or sum(comments(*w) for w in words) > 0
    read, held = [0] * len(around), [0] * len(said)
    total = 0
    for _, n, _, _, mark, article in found:
        if article >= 0:
            read[article] += n
        if mark < 0 or not remark[mark]:
            total += n
            if mark >= 0:
                held[mark] += n
    for k in range(len(around) - 1, -1, -1):
        if outer[k] >= 0:
            read[outer[k]] += read[k]
    for k in range(len(said) - 1, -1, -1):
        if above[k] >= 0:
            held[above[k]] += held[k]
    texts = [k for k, mark in enumerate(around) if read[k] and not (mark >= 0 and remark[mark])]
    out = Page()
    out.said, out.above, out.frame = said, above, set()
    if not texts:
        out.frame = {k for k, n in enumerate(held) if not remark[k] and 3 * n >= 2 * total}
        out.extend((t, n, inside, aside, 0, mark) for t, n, inside, aside, mark, _ in found)
        return out
    main = max(texts, key=read.__getitem__)
    within = [False] * len(around)
    for k in range(len(around)):
        within[k] = k == main or outer[k] >= 0 and within[outer[k]]
    own = [0] * len(said)
    for _, n, _, _, mark, article in found:
        if mark >= 0 and article >= 0 and within[article]:
            own[mark] += n
    for k in range(len(said) - 1, -1, -1):
        if above[k] >= 0:
            own[above[k]] += own[k]
    # Words are around the article in an element around it, and in the article in one that holds half of it.
    out.frame = {k for k, n in enumerate(own) if n and 2 * n >= read[main] and not remark[k]}
    mark = around[main]
    while mark >= 0:
        out.frame.add(mark)
        mark = above[mark]
    out.extend((t, n, inside, aside, 1 if article >= 0 and within[article] else -1, mark) for t, n, inside, aside, mark, article in found)
    return out


# Small labelled pages. Blocks that begin with + are main text, those with - are not, and those with ~ are
# readers' comments.
LABELLED_PAGES = (
    "<body><nav><ul><li><a>-Home</a></li><li><a>-World news</a></li><li><a>-Sports</a></li></ul></nav><div class='ad'>-Buy now and save a lot on all new things today.</div><article><h1>+A report from the coast</h1><p>+The storm came in the night and took the old pier with it, and nobody saw it go.</p><p>+No one was hurt.</p><p>+Work on a new pier, which the <a>town council</a> had planned for years, will begin in spring, said the mayor.</p></article><footer>-Copyright 2020 by the paper. All rights are reserved everywhere.</footer></body>",
    "<body><header>-The Daily Paper</header><main><h1>+Soup</h1><p>+Cut the leeks.</p><p>+Boil.</p><p>+Serve with bread and a little of the oil that is left over from the pan.</p></main><aside>-More recipes that our readers have liked a lot this week</aside><form>-Leave your address here to get our letter</form><footer><p>-Imprint</p></footer></body>",
    "<body><div id='menu'><a>-Start</a> <a>-Shop</a></div><div><p>+All cats of the city are fed by a small group of people who walk its streets at night, in rain and in snow, and ask for nothing.</p><p>+They have done so for more than thirty years, and want to go on for as long as they can walk.</p></div><div class='comments'><p>~I like cats very much and have fed three of them for years, so thanks to all of you.</p><p>~Me too.</p></div><div><a>-About us</a> <a>-Contact us</a> <a>-Imprint</a></div></body>",
    "<body><div class='cookie'>-We use files on your device to know you again. Please agree to that now.</div><div><a>-News</a></div><div><a>-Weather and roads</a></div><h2>+How rivers freeze</h2><p>+Water is heaviest at four degrees, so a river cools as a whole before any ice forms upon its face, and then the ice grows downward from there.</p><p>+In <a>cold years</a> it bears a cart by the end of January in most of the towns that lie along its upper course.</p><div><a>-Read more about ice</a></div><div><a>-Read more about rivers</a></div></body>",
    "<body><article><h1>+Results</h1><p>+None.</p><p>+See below for what the others have found, and for the list of all that was seen.</p><div class='share'>-Share this</div><p>+Two.</p></article><section class='related'><h2>-You may also like</h2><p>-Ten things that nobody had told you about the sea and its many ships</p></section></body>",
    "<body class='has-sidebar home'><div id='page' class='with-header'><div id='header'>-The Evening News</div><article class='post widget'><div class='entry-header'><h1>+Old bridge reopens</h1></div><p>+The bridge over the mill stream carries carts again after two years of work that cost far more than anyone had thought.</p><p>+It rained.</p><p><a>+The full report of the builders, with all its tables</a></p><p>+Carts pay nothing until the end of the year.</p></article><div class='sidebar'><p>-Most read this week by all those who live near the mill stream</p></div></div></body>",
    # Pages without words that help: only the blocks and their neighbours tell.
    "<body><div><a>-Home</a></div><div><a>-Archive</a></div><div><a>-About</a></div><div>+A walk along the old canal</div><div>+The path begins behind the station and follows the water for two hours, past four locks and a mill that has lost its wheel.</div><div>+Bring boots.</div><div>+Beyond the third lock the path is often under water in spring, so ask the keeper, who lives in the white house, before you go on.</div><div><a>-Next walk</a></div><div><a>-All walks</a></div><div>-Made with care</div></body>",
    "<body><table><tr><td><a>-Start page</a></td><td><a>-Prices</a></td><td><a>-Where we are</a></td></tr></table><p>+Our mill has ground rye and wheat for the bakers of the valley since the year in which the railway came.</p><p>+It is open to all.</p><p>+On Sundays the miller shows the stones, the gears and the old wheel, and tells how the flood of that June took the weir away.</p><p><a>-Start page</a> <a>-Prices</a> <a>-Terms</a></p><p>-All rights reserved</p></body>",
    "<body><div><a>-Log in</a> or <a>join us</a></div><div>-Today</div><div><a>-Letters</a></div><h1>+Letters from the north</h1><div>+My dear sister, the boat was late and the sea was high, yet all of us are well and the children have seen a whale.</div><div>+Write soon.</div><div>+We shall stay until the herring leave, and then come home by the coast road if the snow allows it at all.</div><div><a>-Older letters</a></div><div><a>-Newer letters</a></div></body>",
    "<body><ul><li><a>-One</a></li><li><a>-Two and three</a></li></ul><p>+She had kept the light for forty years and had never once let it go out, not in the worst of the storms.</p><ul><li>+A can of oil</li><li>+Two wicks</li><li>+Matches</li></ul><p>+That was all that a night took, and of that there was always enough in the lower room of the tower.</p><p><a>+Her own account of the great storm, as she wrote it down</a></p><p>+It was printed in the year after, and has been read in every school of the island since that time.</p><ul><li><a>-Lights of the east</a></li><li><a>-Lights of the west</a></li><li><a>-Wrecks</a></li></ul></body>",
    "<body><p>-Site of the year</p><p><a>-Forum</a> <a>-Help</a></p><h2>+Keeping bees in a town</h2><p>+Bees find more to eat in a town than in most fields, since gardens bloom from March until the first frost.</p><p>+A roof will do.</p><p>+Put the hives where nobody walks past the holes, and give them water nearby, or they will drink from the pools of your neighbours.</p><p><a>-Tell a friend</a></p><p><a>-Print this page</a></p></body>",
    "<body><article><p><a>+A list of all the ships that were lost</a></p><p>+It was drawn up by the harbour master in the winter after the war.</p><p>+Nine.</p><p>+Of these, four were raised again and sailed for many years more under other flags and other names.</p></article><p><a>-Back</a></p><p>-Page 1 of 3</p></body>",
    "<body><div><a>-Snow closes the upper pass for the third time this week</a></div><div><a>-Council votes on the new bridge in the spring</a></div><div><a>-Read</a></div><article><p>+Bread.</p><p>+It is made of what the land gives: rye in the north, wheat in the south, maize where it is wet and warm.</p><p><a>+Read on here</a></p><p>+So every valley has its own loaf.</p><p>+Salt.</p></article><div><a>-Why the baker of the old square rises at two</a></div><div><a>-Ten mills that you can visit by train or on foot</a></div><div>-Printed by hand</div></body>",
    "<body><article><p>+Why is the sea salt?</p><p><a>+Rain</a> +takes salt out of the rocks, rivers carry it down, and the sun takes only the water back.</p><p>+Slowly.</p><p><a>+Tables of all the seas and of the salt in them, by depth</a></p></article></body>",
    "<body><h1>+Rules of the library</h1><p>+Books may be kept for four weeks and then for two more, if nobody else has asked for them.</p><ol><li>+Be quiet.</li><li>+Do not eat.</li><li>+Leave the chairs as they were when you came.</li></ol><p>+Whoever loses a book pays for it.</p></body>",
    "<body><p><a>-Contents</a></p><p>+Chapter one</p><p>+There was a house at the end of the road, and in the house there lived a man who had been a pilot.</p><p>+He said little.</p><p>+On Mondays he walked to the town and bought bread, cheese, a newspaper and three pears, whatever the season.</p><p><a>-Chapter two</a></p></body>",
    "<body><div><a>-Sea and coast: all that we have written about them so far</a></div><div><a>-Towns of the river, in the order in which it meets them</a></div><div>+The ferry runs from May until the leaves fall, and takes carts and cattle as well as those on foot.</div><div><a>-The ferry man of the lower town, and what he has seen</a></div><div><a>-Tolls and fares of the last two hundred years</a></div></body>",
    "<body><article><p>+The first to climb it was a shepherd who looked for a lamb, and he told nobody for a year.</p><p><a>+His letter to the club</a></p><p>+The second was a colonel.</p><p><a>+The answer of the club</a></p><p>+No.</p><p>+So it was.</p></article></body>",
    "<body><article><h2>+Notes</h2><p>+No.</p><p><a>+The first letter of the shepherd</a></p><p>+It was found in the wall of the club house when the stove was moved, and hangs there in a frame now.</p></article></body>",
    "<body><article><p><a>+What he wrote</a></p><p>+True.</p></article></body>",
    "<body><header>-News of the harbour and of all who live by it</header><p>+Three boats came in last night with more cod than the cold house can hold, so it is sold from the deck today.</p><p>+Bring a bag.</p><p>+The fourth boat is still out, but has been heard by wireless and is well.</p><aside>-Those who sell from the deck must show their paper to the master of the harbour at any time.</aside><form>-Tell us what you have seen on the water and we shall print it here in the next week.</form><footer>-The harbour news is made by the people of the harbour. Nothing in it may be copied.</footer></body>",
    # What stands around an article on most pages, by the words that makers of pages use.
    "<body><div class='cookie-consent notice'>-This site keeps small files on your device so that it can tell you from others. You can refuse that at any time.</div><div class='top-banner advert'>-Your bank for all of life and for all that comes after it, since the days of your grandfather.</div><div class='breadcrumbs'><a>-Home</a> <a>-Science</a></div><div id='masthead'>-The journal of the river and its people</div><div class='content main-text'><p>+Eels cross the whole ocean to spawn, and nobody has ever seen them do it or found an egg.</p><p>+They come back as glass.</p></div><div class='newsletter subscribe'>-Get the best of the week in one letter, each Friday, at no cost, and leave it whenever you like.</div><div class='promo sponsored sponsor'>-A ring for life, from the house that has made rings for a hundred years and more.</div><div class='social sharing toolbar'>-Pass it on</div><div class='related-posts recommended'><p>-Why the salmon leaps, and what the old fishers of the upper valley knew of it</p></div><div id='disqus' class='replies reply responses'><p>~I have seen eels in our well, and my father says that they came through the rock from the sea.</p></div><div class='footer copyright legal'>-All of this belongs to the journal. Nothing may be taken.</div></body>",
    "<body><div class='popup modal overlay'>-Do you want to hear from us first? Say yes and you will never miss a thing.</div><div class='navbar navigation'><a>-Home</a></div><div class='widget search'>-Find what you look for</div><main><div class='post-content entry body text story'><h1>+Glass from sand</h1><p>+Sand melts at a heat that no common fire reaches, so the makers of old added ash to it.</p><div class='inline ad ads advertisement'>-The best windows of the whole land, now at half the price until the end of the month.</div><p>+The ash of beech was thought the best.</p></div><div class='author-bio tags meta'>-Written by a friend of the house</div><div class='share-buttons'>-Send</div></main><div class='comments-area'><article class='comment'><p>~My uncle made glass for all his life and would have told you quite another story about the ash of beech and of oak.</p></article></div><div class='sidebar secondary complementary'>-What others read at this hour</div><div class='skip-link hidden login account'>-Sign in</div></body>",
    "<body><div class='gdpr privacy wall'>-We and our partners would like to know where you go from here and what you buy there.</div><article><h1>+The salt road</h1><div class='top'><p>+Salt came up from the sea on mules, nine days from the pans to the market of the upper town.</p><p>+It paid for the walls.</p></div><section class='news menu card'><p>+The mules went home with cheese, wool and the letters of all who had children at the coast.</p></section><div class='sponsor ad'>-Mules for hire</div><p>+The railway ended it within one summer.</p></article><section class='comments responses'><p>~My great-grandfather led the last train of mules, and we still have the bell of the first of them.</p></section></body>",
    "<body><div class='page'><div class='post content'><h1>+Wells of the plain</h1><p>+Nobody dug deeper than twelve metres, since below that the water is as salt as the sea.</p><p>+So they dug wide.</p></div><div class='comments'><p>~There is one on our farm that is fourteen metres deep, and its water is sweet all the year, so this cannot be quite true.</p><p>~Ours is salt.</p></div></div></body>",
)


def features(found: Page, odds: Odds) -> np.ndarray:
    """One row of FEATURES for each block of one page."""
    n = np.array([b[1] for b in found], float)
    d = np.array([b[2] / b[1] for b in found])
    shift = lambda x, k: np.concatenate([[0.0], x[:-1]] if k else [x[1:], [0.0]])
    said = [0.0] * (len(found.said) + 1)  # of each mark, with those around it; the last is none
    for k, words in enumerate(found.said):
        said[k] = said[found.above[k]] + (0.0 if k in found.frame else sum(odds(*w) for w in words))
    return np.stack([n, d, shift(n, 1), shift(d, 1), shift(n, 0), shift(d, 0), np.array([b[3] for b in found], float), np.array([b[4] for b in found], float), np.array([said[b[5]] for b in found])], 1)


class Tree:
    """A small decision tree: nodes (feature, threshold, left, right) or a leaf's label; odds: what class words say."""

    def __init__(self, x: np.ndarray, y: np.ndarray, odds: Odds, depth: int = 8):
        self.nodes: list[tuple] = []
        self.odds = odds
        self._grow(x, y, depth)

    def _grow(self, x: np.ndarray, y: np.ndarray, depth: int) -> int:
        me = len(self.nodes)
        self.nodes.append(("leaf", bool(y.mean() >= 0.5)))
        best = None
        if depth and 0 < y.sum() < len(y):
            for f in range(x.shape[1]):
                values = np.unique(x[:, f])
                for cut in (values[1:] + values[:-1]) / 2:
                    left = x[:, f] < cut
                    impurity = sum(m.sum() * 2 * y[m].mean() * (1 - y[m].mean()) for m in (left, ~left))
                    if best is None or impurity < best[0] - 1e-12:
                        best = (impurity, f, float(cut))
        if best and best[0] < len(y) * 2 * y.mean() * (1 - y.mean()) - 1e-12:
            left = x[:, best[1]] < best[2]
            a = self._grow(x[left], y[left], depth - 1)
            b = self._grow(x[~left], y[~left], depth - 1)
            self.nodes[me] = (best[1], best[2], a, b)
        return me

    def used(self) -> set[str]:
        return {FEATURES[n[0]] for n in self.nodes if n[0] != "leaf"}

    def keep(self, x: np.ndarray) -> np.ndarray:
        out = np.zeros(len(x), bool)
        todo = [(0, np.arange(len(x)))]
        while todo:
            node, rows = todo.pop()
            if self.nodes[node][0] == "leaf":
                out[rows] = self.nodes[node][1]
                continue
            f, cut, a, b = self.nodes[node]
            left = x[rows, f] < cut
            todo += [(a, rows[left]), (b, rows[~left])]
        return out


def alone(pages: tuple[str, ...]) -> Iterator[str]:
    """Pages that hold nothing but main text of the labelled pages: each block, and all of a page, in an article and without."""
    for page in pages:
        good = [f"<p>{b[0].split('-')[0]}</p>" for b in blocks(page) if b[0].startswith("+") and not b[2]]
        for text in [*good, "".join(good), *("".join(good[a : a + 2]) for a in range(len(good) - 1))]:
            yield from (f"<body><article>{text}</article></body>", f"<body>{text}</body>")


def _log_odds(for_: Counter, against: Counter) -> Odds:
    return Odds({w: math.log((for_[w] + 0.5) / (against[w] + 0.5)) for w in for_ | against})


@cache
def _comment_odds(pages: tuple[str, ...] = LABELLED_PAGES) -> Odds:
    """What class words say of readers' comments: their log odds among the blocks that they are around, wherever they stand."""
    comments, others = Counter(), Counter()
    for page in pages:
        found = blocks(page, Odds({}))
        for b in found:
            (comments if b[0].startswith("~") else others).update({(w, inside) for w, _ in found.around(b[5], frame=True) for inside in (False, True)})
    return _log_odds(comments, others)


def train(pages: tuple[str, ...] = LABELLED_PAGES) -> Tree:
    """The tree for labelled pages, and for each class word the log odds of boilerplate among the blocks that it is around."""
    comments = _comment_odds(pages)
    read = [blocks(page, comments) for page in (*pages, *alone(pages))]
    labels = [np.array([b[0].startswith("+") for b in found], float) for found in read]
    main, other = Counter(), Counter()
    for found, y in zip(read, labels, strict=True):
        for b, good in zip(found, y, strict=True):
            (main if good else other).update(set(found.around(b[5])))
    odds = _log_odds(other, main)
    return Tree(np.concatenate([features(f, odds) for f in read]), np.concatenate(labels), odds)


def main_text(page: str | None, tree: Tree) -> str:
    found = blocks(page or "")
    if not found:
        return ""
    return "\n\n".join(b[0] for b, k in zip(found, tree.keep(features(found, tree.odds)), strict=True) if k)


def extract(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """pages' page_id and url with the main text and its number of code points; one pass, no shuffle."""
    tree = train()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(p, tree) for p in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_pydict({"page_id": batch.column("page_id"), "url": batch.column("url"), "text": texts, "n_chars": pa.array([len(t) for t in texts], pa.int64())})

    return pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col(html_col).cast("string").alias("html")).mapInArrow(run, "page_id long, url string, text string, n_chars long")
