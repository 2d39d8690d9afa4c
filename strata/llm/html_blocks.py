"""Main text of HTML pages by flat text blocks and a trained decision tree.

A page becomes a flat list of text blocks (Kohlschuetter et al., "Boilerplate
Detection using Shallow Text Features", 2010). A block's features are its own
and its neighbours' word counts and link densities, and what stands around it:
whether it is inside an article, inside a page part that is never article text
(menu, header, footer, sidebar, form, notice, advert, comments), or a heading.
A decision tree, trained by Spark on the small labelled table that
TRAINING_PAGES spells out, says which blocks are main text.

A class, id, role or label marks such a page part only as a whole name: every
word of it is one of _NEVER_WORDS or a neutral word ("cookie-banner",
"widget-area"; not "no-sidebar", "has-share-buttons", "tags-news"). Names on
html, body, main and article never do. A name, or a form, around a whole article
or main counts only if the page has an article or main of its own beside it (so
comments that are articles stay out, and a wrapper never empties a page).

Scripts, styles, titles and other parts without reading text never make blocks.
Character references are decoded, white space inside a block becomes one
space, blocks are joined in page order by one space.

Defined results: null or empty html gives the empty text; an unclosed tag,
comment or script at the end of a cut page is markup, not text; repeated pages
give equal texts; an empty table gives an empty result; extra columns are
carried unchanged.
"""

from __future__ import annotations

import html
import itertools
import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .common import ROW, packed

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)"                                     # comment
    r"|<title\b[^>]*(?:>.*?(?:</title\s*>|(?=</head\b|<body\b)|\Z)|\Z)"  # text of the head
    r"|<(script|style|noscript|template|svg|iframe|object|textarea|select)"
    r"\b[^>]*(?:/>|>.*?(?:</\1\s*>|\Z)|\Z)"                   # no reading text
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)"
    r"|<[!?/][^>]*(?:>|\Z)"                                   # doctype, stray ends
    r"|<[a-zA-Z][^>]*(?:>|\Z)",                               # tag with broken quotes
    re.S | re.I)
_HINT = re.compile(r"(?<![\w-])(class|id|role|aria-label)\s*=\s*"
                   r"(?:\"([^\"]*)\"?|'([^']*)'?|([^\s\"'>]+))", re.I)
_SPACE = re.compile(r"\s+")
_TOKEN = re.compile(r"[a-z]+")

#: Inline elements: they neither end nor start a block.
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big button cite code data del dfn em font i img ins kbd label mark "
    "math mfrac mi mn mo mover mroot mrow ms mspace msqrt mstyle msub msubsup msup mtext munder "
    "munderover q s samp semantics small span strike strong sub sup time tt u var wbr".split())
_VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split())
_MAIN = frozenset("article main".split())
_NEVER = frozenset("nav header footer aside form fieldset menu dialog".split())
#: Around a whole article these say no more than a class name does.
_WRAPPERS = frozenset("form fieldset".split())
_UNNAMED = frozenset("html body main article".split())
_HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Words of a class, id or role that mark a page part as no article text.
_NEVER_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising alert alerts banner breadcrumb breadcrumbs comment "
    "comments consent contentinfo cookie cookies disqus footer gdpr masthead menu modal nav "
    "navbar navigation newsletter notice notification pagination popup promo promoted "
    "recommended related reply replies respond search share sharing sidebar signup skip social "
    "sponsor sponsored subscribe tags toolbar widget complementary".split())
#: Words that settle it whatever else the name holds, unless it says that there is none.
_SURE_WORDS = frozenset(
    "adbanner adbox adsbygoogle adsense adslot adslots adunit disqus newsletter response responses "
    "sponsor sponsored".split())
_SURE_STEMS = ("advert", "comment")
_DENIALS = frozenset("closed count disabled enabled has have hide no not off on open with without".split())
_MAIN_WORDS = frozenset("article articlebody content entry main post story".split())
_NEUTRAL_WORDS = frozenset(
    "area article bar block box buttons container entry form inner item items links list outer "
    "post posts section site wrap wrapper".split())
#: Words of a block that shows that an article or main holds text of its own.
_OWN_WORDS = 10

FEATURES = ("words", "words_before", "words_after", "links", "links_before", "links_after",
            "in_main", "in_never", "heading")


class Block(NamedTuple):
    text: str
    words: int
    links: float
    in_main: bool
    in_never: bool
    heading: bool
    label: str | None


def _hints(name: str, attributes: str) -> tuple[bool, bool]:
    """(marks main text, marks no article text) for an opening tag."""
    main, never = name in _MAIN, name in _NEVER
    if attributes and not never:
        names = []
        for kind, *values in _HINT.findall(attributes):
            value = "".join(values).lower()
            names += [value] if kind.lower() == "aria-label" else value.split()
        words = [set(_TOKEN.findall(n)) for n in names]
        if name not in _UNNAMED:
            never = any(w & _NEVER_WORDS and w <= _NEVER_WORDS | _NEUTRAL_WORDS or _sure(w)
                        for w in words)
        main = main or not never and any(w & _MAIN_WORDS and not w & _NEVER_WORDS for w in words)
    return main, never


def _sure(words: set[str]) -> bool:
    return not words & _DENIALS and any(
        w in _SURE_WORDS or w.startswith(_SURE_STEMS) for w in words)


def blocks(page: str | None) -> list[Block]:
    """The page's flat text blocks, in order."""
    page = page or ""
    out: list[Block] = []
    stack: list[tuple[str, bool, bool, str | None]] = []  # name, main, never, label
    parts: list[str] = []
    linked: list[str] = []
    around: list[int] = []
    owned = False
    in_link = 0

    def flush() -> None:
        nonlocal parts, linked, owned
        text = _SPACE.sub(" ", "".join(parts)).strip()
        if text:
            n = len(text.split())
            # What only a name or a form around the innermost article or main says.
            inner = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] in _MAIN), 0)
            never = [i for i, s in enumerate(stack) if s[2]]
            sure = any(i >= inner or stack[i][0] in _NEVER - _WRAPPERS for i in never)
            if never and not sure:
                around.append(len(out))
            elif not sure and n >= _OWN_WORDS and stack and stack[inner][0] in _MAIN:
                owned = True
            out.append(Block(text, n, len(" ".join(linked).split()) / n,
                             any(s[1] for s in stack), sure,
                             any(s[0] in _HEADING for s in stack),
                             next((s[3] for s in reversed(stack) if s[3]), None)))
        parts, linked = [], []

    def add(raw: str) -> None:
        text = html.unescape(raw)
        parts.append(text)
        if in_link:
            linked.append(text)

    last = 0
    for tag in _MARKUP.finditer(page):
        if tag.start() > last:
            add(page[last:tag.start()])
        last = tag.end()
        name = (tag[3] or "").lower()
        if not name:
            continue
        if name == "a":
            in_link = 0 if tag[2] else 1
        if name in _INLINE:
            continue
        flush()
        if tag[2]:
            names = [s[0] for s in stack]
            if name in names:  # also closes what was left open inside
                del stack[len(names) - 1 - names[::-1].index(name):]
                in_link = 0
        elif name not in _VOID and not tag[4].endswith("/"):
            if name in ("p", "li") and stack and stack[-1][0] == name:
                stack.pop()  # an open paragraph or item ends where the next begins
            main, never = _hints(name, tag[4])
            label = re.search(r'data-label="(\w+)"', tag[4]) if "data-label" in tag[4] else None
            stack.append((name, main, never, label and label[1]))
    if last < len(page):
        add(page[last:])
    flush()
    for i in around if owned else ():
        out[i] = out[i]._replace(in_never=True)
    return out


def block_features(found: list[Block]) -> list[list[float]]:
    rows = []
    for i, b in enumerate(found):
        before = found[i - 1] if i else None
        after = found[i + 1] if i + 1 < len(found) else None
        rows.append([float(b.words), float(before.words if before else 0),
                     float(after.words if after else 0), b.links,
                     before.links if before else 0.0, after.links if after else 0.0,
                     float(b.in_main and not b.in_never), float(b.in_never), float(b.heading)])
    return rows


_LONG = ("The committee met on Tuesday to discuss the plan and heard from several residents who "
         "had lived near the river for many years before the flood came through the valley.")
_MIDDLE = "Officials said on Friday that the bridge would open again before the summer."
#: The labelled table, as pages whose blocks carry their label: main or other.
TRAINING_PAGES = (
    f"""<nav data-label="other"><ul><li><a>Home</a></li><li><a>News and weather</a></li></ul></nav>
    <article data-label="main"><h1>Bridge opens</h1><p>{_LONG}</p><p>{_MIDDLE}</p><p>Yes.</p>
    <p>See <a>the report</a> for more.</p><div class="ad" data-label="other">Buy two shoes now and
    get one more pair for free at our shop in the town centre today.</div><p>{_LONG}</p></article>
    <footer data-label="other">All rights reserved. {_MIDDLE}</footer>""",
    f"""<header data-label="other">The Daily Example, since 1901. {_MIDDLE}</header>
    <main data-label="main"><h1>Title</h1><p>Short.</p><h2>Part two</h2><p>{_LONG}</p><ul>
    <li>One item of a list</li><li>Two</li></ul></main>
    <aside data-label="other"><h3>More</h3><p>{_LONG}</p></aside>""",
    f"""<div class="menu" data-label="other"><a>Start</a> <a>About us</a> <a>Contact</a></div>
    <div data-label="main"><h1>A long walk along the northern coast</h1><p>{_LONG}</p>
    <p>{_LONG} {_MIDDLE}</p><p>{_MIDDLE}</p></div>
    <div class="comments" data-label="other"><p>{_MIDDLE}</p><p>{_LONG}</p></div>
    <form data-label="other"><label>Your name</label><p>Leave your mail address here.</p></form>""",
    f"""<div class="cookie-notice" data-label="other">{_LONG}</div>
    <div class="content" data-label="main"><p>{_LONG}</p><p>Why?</p><p>{_MIDDLE}</p></div>
    <div data-label="other"><a>Next page</a> <a>Older posts</a></div>
    <div data-label="other"><p><a>Ten things to see in the old town</a></p>
    <p><a>How the harbour was built</a></p></div>""",
    f"""<div data-label="other"><a>Home</a> | <a>Sport</a> | <a>Politics</a></div>
    <div data-label="main"><p>{_MIDDLE} {_LONG}</p><p>{_LONG}</p><p>{_MIDDLE} {_MIDDLE}</p></div>
    <div data-label="other">Copyright 2020</div><div data-label="other"><a>Imprint</a></div>""",
    f"""<article data-label="main"><p>Only one short line.</p></article>
    <div class="sidebar" data-label="other"><p>{_LONG}</p><p>Hi.</p></div>
    <div class="newsletter" data-label="other"><p>{_MIDDLE}</p></div>""",
    f"""<article data-label="main"><h1>Heading</h1><p><a>A paragraph that is one link</a></p>
    <p>{_MIDDLE}</p></article><div class="related" data-label="other"><h2>Related</h2>
    <p>{_MIDDLE}</p></div><footer data-label="other"><a>Terms</a><p>Example Ltd.</p></footer>""",
    f"""<div data-label="other">Menu</div><div data-label="other"><a>Log in</a></div>
    <div data-label="main"><p>{_LONG} {_LONG}</p><p>{_LONG}</p></div>
    <div data-label="other">12 likes</div><div data-label="other"><a>Top</a></div>""",
)

#: Plain pages, in which no name says what is main: short blocks go with the long ones they stand
#: between, and so does a heading above one; those beside links or other short ones do not.
_SHORT = ("Why now?", "It opens again.", "Bridge", "Not quite.", "A second look at it")
_MENUS = ('<div data-label="other"><a>Home</a> <a>News</a> <a>Sport</a></div>',
          '<div data-label="other">The Daily Example</div><div data-label="other"><a>Log in</a></div>',
          '<div data-label="other"><a>Start</a></div><div data-label="other"><a>About us</a></div>')
_ENDS = ('<div data-label="other">12 likes</div><div data-label="other"><a>Share</a></div>',
         '<div data-label="other"><a>Next page</a></div><div data-label="other">Copyright 2020</div>',
         '<div data-label="other"><h3>More</h3></div><div data-label="other"><a>The old town</a></div>'
         '<div data-label="other"><a>How the harbour was built</a></div>')
TRAINING_PAGES += tuple(
    f"""{menu}<div data-label="main"><{head}>{_SHORT[n % 5]}</{head}><p>{_LONG}</p><p>{_SHORT[(n + 1) % 5]}</p>
    <p>{_MIDDLE}</p><p>{_SHORT[(n + 2) % 5]}</p><p>{_LONG} {_LONG}</p></div>{end}"""
    for n, (menu, end, head) in enumerate(
        (m, e, h) for m in _MENUS for e in _ENDS for h in ("h1", "h2")))

#: Inside an article every block is main, short or long, alone, first or last.
_BODIES = (_SHORT[0], _SHORT[2] + " 2", _MIDDLE, _LONG, _LONG + " " + _MIDDLE)
TRAINING_PAGES += tuple(
    f'{_MENUS[0] if n % 2 else ""}<article data-label="main">' + "".join(f"<p>{b}</p>" for b in parts)
    + f'</article>{_ENDS[n % 3] if n % 3 else ""}'
    for n, parts in enumerate(p for k in (1, 2, 3) for p in itertools.product(_BODIES, repeat=k)))

#: Page parts around an article, each with a short, a middle and a long text.
_PARTS = ("<nav{}>{}</nav>", "<header{}>{}</header>", "<footer{}>{}</footer>",
          "<aside{}>{}</aside>", "<form{}>{}</form>", '<div class="ad"{}>{}</div>',
          '<section id="comments"{}>{}</section>')
TRAINING_PAGES += tuple(
    part.format(' data-label="other"', text)
    + f'<article data-label="main"><h1>Title</h1><p>{body}</p></article>'
    + part.format(' data-label="other"', text)
    for part in _PARTS for text in ("Short.", _MIDDLE, _LONG) for body in (_MIDDLE, _LONG * 2))

Tree = tuple  # ("leaf", is_main) or (feature, threshold, left, right)


def labelled_table(spark: SparkSession) -> DataFrame:
    rows = []
    for page in TRAINING_PAGES:
        found = blocks(page)
        rows += [(values, 1.0 if b.label == "main" else 0.0)
                 for b, values in zip(found, block_features(found))]
    return spark.createDataFrame(rows, "values array<double>, label double")


def train(spark: SparkSession, max_depth: int = 8) -> Tree:
    """Decision tree learned by Spark from the labelled table, as nested tuples."""
    data = labelled_table(spark).coalesce(1).withColumn("features", array_to_vector("values"))
    model = DecisionTreeClassifier(maxDepth=max_depth, minInstancesPerNode=1, seed=1).fit(data)

    def export(node) -> Tree:
        if node.subtreeDepth() == 0:
            return ("leaf", node.prediction() == 1.0)
        split = node.split()
        return (split.featureIndex(), split.threshold(), export(node.leftChild()),
                export(node.rightChild()))

    return export(model._java_obj.rootNode())


def _is_main(tree: Tree, values: list[float]) -> bool:
    while tree[0] != "leaf":
        tree = tree[2] if values[tree[0]] <= tree[1] else tree[3]
    return tree[1]


def main_text(page: str | None, tree: Tree) -> str:
    found = blocks(page)
    return " ".join(b.text for b, values in zip(found, block_features(found))
                    if _is_main(tree, values))


def extract(pages: DataFrame, tree: Tree, html_col: str = "html") -> DataFrame:
    """``row`` (the source row) and main_text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([main_text(p.as_py(), tree) for p in batch.column(1)],
                                           pa.string())], names=[ROW, "main_text"])

    source = packed(pages, page=F.col(html_col))
    schema = StructType([source.schema[ROW], StructField("main_text", StringType())])
    return source.mapInArrow(run, schema)
