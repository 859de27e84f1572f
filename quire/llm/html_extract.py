"""Main text of web pages by two-pass block rules.

A page is cut into blocks at block-level tags. Markup, comments, scripts and
styles give no text. Each block knows its words, the share of stop words, the
share of its characters inside links, and what it stands in.

Pass 1 decides a block on its own:

* other: it stands in a part that its tag, role, class or id names as something
  else than the article (menu, page header or footer, sidebar, notice, advert,
  form, reader comments, ...). Names are read on containers; a line, heading or
  inline element needs a name that leaves no doubt (``SURE_PART``). The others
  are doubtful: an article inside such a part is an article, and a block inside
  an article that is good by its own text stays;
* bad: most of it is links;
* good: long, few links, and many stop words; or any text of some length with
  few links inside an ``article`` or ``main`` element;
* near: some stop words or middling length, few links;
* short: too little text to tell;
* bad: long text with hardly a stop word.

Pass 2 lets the undecided blocks inherit from the nearest decided blocks before
and after them, in blocks of distance: those of the same part of the page (its
innermost container), else those of the same article or outside any. A heading
follows what comes after it. Near blocks come first and then count as decided. A
near block is bad only if no neighbour is good; a
short block takes the label of the nearer one, and is bad on a tie between good
and bad. Parts named as something else do not vote. Without any decided
neighbour a near block is good, and a short one only if it stands in an article.

A page without any good block falls back on the part with the most text outside
links: its blocks that are not mostly links are the main text.

White space is what ``str.split`` splits at, no-break spaces included.

Scale. One pass over the pages, no shuffle; a page is parsed in linear time,
however many tags it leaves open or closes twice.

Edge cases: null, empty or text-free html gives the empty text; unclosed or
stray tags are tolerated, a ``<`` that opens no tag is text; very long pages
and blocks are processed whole; repeated rows give equal results; ``text`` and
``blocks`` replace columns of those names.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship_package
from .common import drop_clashes, quoted

# Frequent function words of English, German, French and Spanish.
STOP_WORDS = frozenset("""
a an and are as at be by for from he in is it of on or that the this to was with
als auch auf aus das dem den der des die ein eine einen er für ich im in ist mit nicht sich sie und von zu
au aux avec dans de des du elle en est et il la le les pas par pour que qui sur un une
al como con de del el en es la las lo los no para por que se su un una y
""".split())

# Elements of HTML.
SILENT = frozenset("script style noscript template iframe object svg math canvas select textarea button "
                   "audio video datalist head title".split())
RAW = frozenset("script style textarea title noscript iframe template".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby "
                   "s samp small span strike strong sub sup time tt u var wbr img".split())
ASIDE = frozenset("nav header footer aside form menu dialog fieldset figure".split())
BODY = frozenset("article main".split())
HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
LINES = frozenset("p li dt dd tr td th tbody blockquote pre".split())  # blocks of the part they stand in

# Parts that a class, id or role names; whole words of the attribute, split at
# anything but letters. The first list is sure, the second doubtful.
SURE_PART = frozenset("""
ad ads advert adverts advertisement advertising sponsor sponsored
nav navbar navigation breadcrumb breadcrumbs pagination
footer sidebar sidebars cookie cookies consent gdpr
comment comments reply replies disqus newsletter complementary contentinfo
""".split())
DOUBTFUL_PART = frozenset("""
promo promotion banner menu menus toolbar topbar pager header masthead aside widget widgets rail
notice notices alert popup modal overlay disclaimer copyright legal respond discussion
form login signup subscribe subscription search
share sharing social related recommended teaser trending tags dialog
""".split())
SURE, DOUBTFUL = 2, 1

LAYOUT = frozenset("has no with without".split())  # "has-sidebar" is said of the page around it

GOOD_CHARS, SHORT_CHARS = 140, 40
HIGH_STOPS, LOW_STOPS = 0.20, 0.08
MAX_LINKS = 0.4

# a quote counts after "=" only, and a tag always ends, at the page's end if not before
_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|"
                  r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:=\s*(?:\"[^\"]*\"|'[^']*')|[^>])*+)(?:>|\Z)", re.DOTALL)
_ATTRIBUTE = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
_WORD = re.compile(r"[^\W\d_]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


class Block:
    __slots__ = ("text", "links", "aside", "body", "heading", "part", "label")

    def __init__(self, text: str, links: int, aside: int, body: int, heading: bool, part: int):
        self.text, self.links, self.aside, self.body, self.heading = text, links, aside, body, heading
        self.part, self.label = part, ""


def other_part(tag: str, attributes: str) -> int:
    """How surely class, id or role name a part other than the article."""
    if "=" not in attributes:
        return 0
    line, found = tag in INLINE or tag in HEADING or tag in LINES, 0
    for name, *values in _ATTRIBUTE.findall(attributes):
        name = name.lower()
        if name != "class" and (line or name not in ("id", "role")):
            continue
        for item in "".join(values).split():
            parts = re.split(r"[^a-z]+", _CAMEL.sub(" ", item).lower())
            if LAYOUT.isdisjoint(parts):
                if not SURE_PART.isdisjoint(parts):
                    return SURE
                if not line and not DOUBTFUL_PART.isdisjoint(parts):
                    found = DOUBTFUL
    return found


def blocks(page: str) -> list[Block]:
    """The text blocks of a page in order, white space joined."""
    out: list[Block] = []
    pieces: list[str] = []
    links = 0                       # characters inside links of the open block
    # open elements: tag, inside another part (how surely), article, silent, part (its number)
    open_: list[tuple[str, int, int, bool, int]] = []
    counts: Counter[str] = Counter()   # of open_ by tag
    outside = ("", 0, 0, False, 0)
    state = outside                    # the innermost of open_
    depth_a, bodies, parts, heading = 0, 0, 0, False
    at, n = 0, len(page)

    def close_block() -> None:
        nonlocal pieces, links
        text = " ".join(entities.unescape("".join(pieces)).split())
        if text:
            out.append(Block(text, links, state[1], state[2], heading, state[4]))
        pieces, links = [], 0

    def add(raw: str) -> None:
        nonlocal links
        if raw and not state[3]:
            pieces.append(raw)
            if depth_a:
                links += len("".join(raw.split()))

    def enter(*element) -> None:
        nonlocal state
        open_.append(element)
        counts[element[0]] += 1
        state = element

    def leave(tag: str) -> None:
        """Close the innermost ``tag`` and what it holds."""
        nonlocal state
        while open_:
            last = open_.pop()[0]
            counts[last] -= 1
            if last == tag:
                break
        state = open_[-1] if open_ else outside

    while at < n:
        found = _TAG.search(page, at)
        if not found:
            add(page[at:])
            break
        add(page[at:found.start()])
        at = found.end()
        tag = (found[2] or "").lower()
        if not tag:
            continue
        if found[1]:                # a closing tag
            if tag == "a":
                depth_a = max(0, depth_a - 1)
            if tag in INLINE and not counts[tag]:
                continue
            close_block()
            if tag in HEADING:
                heading = False
            if counts[tag]:
                leave(tag)
            if tag in ("p", "li", "td", "th", "div", "section", "article"):
                depth_a = 0
            continue
        if tag == "a":
            depth_a += 1
        if tag in VOID:             # has no content, whatever its name
            if tag not in INLINE:
                close_block()
            continue
        named = other_part(tag, found[3])
        if tag in INLINE and not named:
            continue
        if tag in RAW:              # its content is no markup
            close_block()
            end = re.compile(rf"</{tag}\s*>", re.IGNORECASE).search(page, at)
            at = end.end() if end else n
            continue
        if tag in INLINE:           # an inline element that names another part
            close_block()
            enter(tag, named, state[2], state[3], state[4])
            continue
        close_block()
        if tag == "body":           # ends whatever the head left open
            open_, state = [], outside
            counts.clear()
        if found[3].rstrip().endswith("/"):
            continue
        if tag in HEADING:
            heading, depth_a = True, 0
        if tag == "p" and open_ and open_[-1][0] == "p":
            leave("p")              # an open paragraph ends at the next one
        if tag in BODY:
            bodies += 1
        if tag in BODY or tag in ("html", "body"):
            named = named if named == SURE else 0
        elif tag in ASIDE and not (tag in ("header", "figure") and state[2] and not named):
            named = SURE            # but the article's own heading or picture
        aside = max(state[1], named)
        if tag in BODY and aside == DOUBTFUL:
            aside = 0
        parts += 1
        enter(tag, aside, bodies if tag in BODY else state[2], state[3] or tag in SILENT,
              state[4] if tag in HEADING or tag in LINES else parts)
    close_block()
    return out


def decide(found: list[Block]) -> None:
    """Pass 1: label each block on its own."""
    for b in found:
        chars = len(b.text)
        words = _WORD.findall(b.text.lower())
        stops = sum(w in STOP_WORDS for w in words) / len(words) if words else 0.0
        links = b.links / max(1, chars - b.text.count(" "))
        prose = chars >= GOOD_CHARS and stops >= HIGH_STOPS and links <= MAX_LINKS
        if b.aside == SURE or b.aside and not (b.body and prose):
            b.label = "other"
        elif links > MAX_LINKS:
            b.label = "bad"
        elif prose or b.body and not b.heading and chars >= SHORT_CHARS:
            b.label = "good"
        elif chars < SHORT_CHARS:
            b.label = "short"
        elif stops >= LOW_STOPS or b.body or chars < GOOD_CHARS:
            b.label = "near"
        else:
            b.label = "bad"


def inherit(found: list[Block]) -> None:
    """Pass 2: undecided blocks take the label of their nearest decided neighbours,
    near ones first, so that they count as neighbours of the short ones."""
    voting = [b for b in found if b.label != "other"]
    for kind in ("near", "short"):
        same, close = neighbours(voting, True), neighbours(voting, False)
        for i, b in enumerate(voting):
            if b.label != kind:
                continue
            p, q = same[i] if any(same[i]) else close[i]
            if b.heading and q:
                b.label = q[1]
            elif kind == "near":
                b.label = "bad" if (p or q) and "good" not in (p and p[1], q and q[1]) else "good"
            elif p and q and p[1] != q[1] and p[0] == q[0]:
                b.label = "bad"
            elif p or q:
                b.label = (p if not q or p and p[0] <= q[0] else q)[1]
            else:
                b.label = "good" if b.body else "bad"


def neighbours(voting: list[Block], same_part: bool) -> list[tuple]:
    """For each block the nearest decided blocks (distance, label) before and after
    it, in its own part of the page or in its article (or outside any)."""
    sides = []
    for order in (range(len(voting)), range(len(voting) - 1, -1, -1)):
        last: dict[int, tuple[int, str]] = {}
        side: list[tuple[int, str] | None] = [None] * len(voting)
        for i in order:
            where = voting[i].part if same_part else voting[i].body
            if where in last:
                side[i] = (abs(i - last[where][0]), last[where][1])
            if voting[i].label in ("good", "bad"):
                last[where] = (i, voting[i].label)
        sides.append(side)
    return list(zip(*sides))


def fall_back(found: list[Block]) -> None:
    """On a page without a good block: the unlinked blocks of the part with the
    most text outside links; doubtful parts only if there is no other."""
    for sure_of in (0, DOUBTFUL):
        weight: Counter[int] = Counter()
        rest = [b for b in found if b.aside <= sure_of and b.links <= MAX_LINKS * (len(b.text) - b.text.count(" "))]
        for b in rest:
            weight[b.part] += len(b.text) - b.links
        if weight:
            best = max(weight, key=lambda part: (weight[part], -part))
            for b in rest:
                if b.part == best:
                    b.label = "good"
            return


def main_blocks(page: str | None) -> list[str]:
    """The article's blocks of one page."""
    if not page:
        return []
    found = blocks(page)
    decide(found)
    inherit(found)
    if not any(b.label == "good" for b in found):
        fall_back(found)
    return [b.text for b in found if b.label == "good"]


def extract(pages: DataFrame, html: str = "html") -> DataFrame:
    """``pages`` without ``html`` and with ``text`` (the blocks joined by one
    space) and ``blocks`` (their texts in page order)."""
    ship_package(pages.sparkSession)

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for found in batches:
            yield pd.Series([main_blocks(p) for p in found])

    kept = [c for c in drop_clashes(pages, "text", "blocks").columns if c != html]
    found = F.pandas_udf(run, "array<string>").asNondeterministic()(F.col(quoted(html)))
    kept = [F.col(quoted(c)) for c in kept]
    return (pages.select(*kept, found.alias("blocks"))
            .select(*kept, F.array_join("blocks", " ").alias("text"), "blocks"))
