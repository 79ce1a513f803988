"""Main text of web pages.

A page becomes a flat list of text blocks. Each block is described by its word
count and link density, those of its neighbours, and what the tags around it
say; a decision tree, grown on a few labelled pages, keeps or drops it.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grantlens.llm.common import load, map_steps, raw_text

# Elements whose content is never text of the page.
SILENT = "script style noscript template title textarea select option button svg iframe object canvas audio video math datalist"
BLOCKS = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form frameset h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol p pre section summary "
    "table tbody td tfoot th thead tr ul".split()
)
CONTAINERS = BLOCKS - set("p hr h1 h2 h3 h4 h5 h6 html body".split())
SPACES = {"br", "wbr"}
# Words of class, id and role that name parts beside the article.
FRAME_WORDS = set(
    "banner breadcrumb breadcrumbs contentinfo copyright foot footer header login masthead menu menubar nav navbar "
    "navigation pager pagination search searchbox sidebar sitemap skip skiplink toolbar topbar".split()
)
ASIDE_WORDS = set(
    "ad ads adslot advert advertisement adverts carousel comment commentary commentlist comments complementary "
    "consent cookie cookies disqus gdpr hidden modal newsletter notice notices notification outbrain overlay popup "
    "promo promoted promotion recommended related signup sponsor sponsored subscribe subscription taboola teaser "
    "trending".split()
)
# Words that also name subjects and page parts of all kinds: a hint, no more.
FRAME_HINTS = set("banner header login search".split())
HINT_WORDS = set("alert dialog discussion feedback reply replies respond share sharing social widget".split())
FRAME_TAGS = {"nav", "header", "footer", "menu"}
ASIDE_TAGS = {"aside", "form", "dialog", "fieldset"}
CONTENT_TAGS = {"article", "main"}
CONTENT_WORDS = set("article articlebody content entry maincontent post postbody story storybody".split())

# Elements without an end, of which nothing can be inside.
VOID = set("area base col embed img input link meta param source track".split())

PARTS = re.compile(
    r"<!--.*?(?:--!?>|\Z)"
    r"|<(?:svg|math)(?=[\s/])[^>]*/>"
    r"|<(?P<mute>" + SILENT.replace(" ", "|") + r")(?=[\s/>])[^>]*(?:>.*?(?:</(?P=mute)(?=[\s/>])[^>]*>?|\Z)|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-z][^\s/>]*)(?P<attrs>(?:[^>\"']+|\"[^\"]*\"|'[^']*')*+)(?:>|\Z)"
    r"|</?[a-z!?/][^>]*(?:>|\Z)",
    re.I | re.S,
)
ATTRIBUTE = re.compile(r"(class|id|role|style|hidden|aria-hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
NAME = re.compile(r"[a-z]+")
# How strongly an element's names speak: not at all, by a vague word, by a clear one or its tag.
NONE, HINT, SURE = 0, 1, 2
Marks = tuple[int, int, int]

FEATURES = (
    "in content", "in frame", "in aside", "heading", "list item",
    "words", "links", "words before", "links before", "words after", "links after",
)


@dataclass
class Block:
    text: list[str] = field(default_factory=list)
    linked: list[str] = field(default_factory=list)
    held: list[str] = field(default_factory=list)
    flags: tuple[int, ...] = ()


def _level(names: list[str], words: set[str], hints: set[str] = frozenset()) -> int:
    """hints speak vaguely; those that are words, too, do so as a part of a name."""
    parts = {part for n in names for part in NAME.findall(n)}
    if any(n in words for n in names) or parts & (words - hints):
        return SURE
    return HINT if parts & hints else NONE


def _marks(tag: str, attrs: str) -> Marks:
    """How strongly an element's tag and attributes say content, page frame, and aside."""
    content, frame, aside = (SURE * (tag in tags) for tags in (CONTENT_TAGS, FRAME_TAGS, ASIDE_TAGS))
    if attrs and not attrs.isspace():
        for m in ATTRIBUTE.finditer(attrs):
            name, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
            if name == "hidden" or (name == "aria-hidden" and value == "true"):
                aside = SURE
            elif name == "style":
                aside = max(aside, SURE * ("display:none" in value.replace(" ", "")))
            elif name in ("class", "id", "role"):
                names = [n.strip("0123456789_-") for n in value.split()]
                content = max(content, SURE if value == "main" else _level(names, CONTENT_WORDS))
                frame = max(frame, _level(names, FRAME_WORDS, FRAME_HINTS))
                aside = max(aside, _level(names, ASIDE_WORDS, HINT_WORDS))
    return content, frame, aside


def _both(outer: Marks, inner: Marks) -> Marks:
    return tuple(map(max, outer, inner))


def blocks(page: str) -> list[tuple[str, np.ndarray]]:
    """(text, features) of each block that has text, in page order."""
    found: list[Block] = []
    now = Block()
    # Open elements with the marks that hold inside them, the marks of a paragraph
    # or heading, and an inline element set apart with its own marks.
    stack: list[tuple[str, Marks]] = [("", (NONE, NONE, NONE))]
    own: Marks = (NONE, NONE, NONE)
    apart: tuple[str, int, Marks] | None = None
    heading, item, link = 0, 0, 0

    def close() -> None:
        nonlocal now, own, apart
        marks = _both(stack[-1][1], own)
        for block, flags in ((now.text, marks), (now.held, _both(marks, apart[2] if apart else marks))):
            if block:
                linked = now.linked if block is now.text else []
                found.append(Block(block, linked, [], (*flags, heading > 0, item > 0)))
        now, own, apart = Block(), (NONE, NONE, NONE), None

    def add(raw: str) -> None:
        if raw:
            if apart:
                now.held.append(raw)
                return
            now.text.append(raw)
            if link:
                now.linked.append(raw)

    at = 0
    for m in PARTS.finditer(page):
        add(page[at : m.start()])
        at = m.end()
        tag = m["tag"]
        if tag is None:
            continue
        tag, ends = tag.lower(), bool(m["end"])
        if tag in SPACES:
            add(" ")
        elif tag in BLOCKS:
            close()
            if tag[0] == "h" and tag[1:].isdigit():
                heading = 0 if ends else 1
            elif tag == "p":
                heading = 0
            if tag == "li":
                item = 0 if ends else 1
            if tag in CONTAINERS:
                if not ends:
                    marks, held = _marks(tag, m["attrs"]), stack[-1][1]
                    if tag in CONTENT_TAGS and held[2] < SURE:
                        # An article or main part ends what a wrapper around it said.
                        stack.append((tag, (SURE if marks[2] < SURE else NONE, NONE, marks[2])))
                    else:
                        stack.append((tag, _both(held, marks)))
                elif any(t == tag for t, _ in stack):
                    while stack.pop()[0] != tag:
                        pass
                    link = 0
            elif not ends:
                own = _marks(tag, m["attrs"])
        else:
            if tag == "a":
                link = 0 if ends else 1
            if apart:
                # The inline element ends with its own end, or at the latest with its block.
                name, depth, marks = apart
                depth += (tag == name) * (-1 if ends else 1)
                if not depth:
                    now.held.append(" ")
                    found.append(Block(now.held, [], [], (*_both(_both(stack[-1][1], own), marks), heading > 0, item > 0)))
                    now.held = []
                apart = (name, depth, marks) if depth else None
            elif not ends and tag not in VOID and m["attrs"]:
                marks = _marks(tag, m["attrs"])
                if max(marks[1:]) == SURE:
                    apart = (tag, 1, marks)
                    now.text.append(" ") if now.text else None
    add(page[at:])
    close()
    out, facts = [], []
    for b in found:
        text = " ".join(html.unescape("".join(b.text)).split())
        if text:
            words = len(text.split())
            linked = len(html.unescape(" ".join(b.linked)).split())
            out.append(text)
            facts.append((min(words, 100), min(linked / words, 1.0), *b.flags))
    if not out:
        return []
    own = np.array(facts, dtype=float)
    edge = np.zeros((1, 2))
    before = np.vstack([edge, own[:-1, :2]])
    after = np.vstack([own[1:, :2], edge])
    return list(zip(out, np.hstack([own[:, 2:], own[:, :2], before, after])))


class Tree:
    """Binary decision tree grown by Gini impurity."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        self.value = int(2 * y.sum() >= len(y))
        self.split: tuple[int, float, Tree, Tree] | None = None
        if 0 < y.sum() < len(y):
            best = min(
                (
                    (self._impurity(y[x[:, k] <= t]) + self._impurity(y[x[:, k] > t]), k, t)
                    for k in range(x.shape[1])
                    for t in self._thresholds(x[:, k])
                ),
                default=None,
            )
            if best and best[0] < self._impurity(y):
                _, k, t = best
                low = x[:, k] <= t
                self.split = (k, t, Tree(x[low], y[low]), Tree(x[~low], y[~low]))

    @staticmethod
    def _thresholds(column: np.ndarray) -> np.ndarray:
        values = np.unique(column)
        return (values[1:] + values[:-1]) / 2

    @staticmethod
    def _impurity(y: np.ndarray) -> float:
        return float(y.sum() * (1 - y.mean())) if len(y) else 0.0

    def keeps(self, row: np.ndarray) -> int:
        node = self
        while node.split:
            k, t, low, high = node.split
            node = low if row[k] <= t else high
        return node.value


LONG = "the words of a long paragraph that goes on and on with more words in it than any menu has, and still goes on"
# Small labelled pages: a mark in front of each block says whether it is main text (1) or not (0).
LABELLED = [
    f"<body><nav><ul><li><a>0 home</a></li><li><a>0 news</a></li></ul></nav><article><h1>1 a title</h1><p>1 {LONG}</p>"
    f"<p>1 short.</p><p>1 {LONG}</p></article><footer>0 copyright and some more</footer></body>",
    f"<header><h1>0 site name</h1><p>0 its motto</p></header><main><h2>1 a title</h2><p>1 {LONG}</p><ul><li>1 point one</li><li>1 point two</li>"
    f"</ul><div class=ad>0 buy this now</div><p>1 {LONG} <a>with a link</a></p><p><a>1 one linked line</a></p></main>"
    f"<aside><h3>0 more to read</h3><p>0 {LONG}</p></aside><footer><h4>0 contact</h4><p>0 mail us</p></footer>",
    f"<div class=menu><a>0 one</a></div><div class=content><h1>1 title here</h1><p>1 {LONG}</p><p>1 brief</p><p>1 {LONG}</p></div>"
    f"<div class=comments><h3>0 two comments</h3><p>0 {LONG}</p><p>0 nice</p></div><div id=footer><h3>0 about</h3><p>0 {LONG}</p></div>",
    f"<div><p>1 {LONG}</p><p>1 {LONG}</p><p>1 {LONG}</p></div><div><a>0 a link</a></div><div><a>0 another link</a></div>",
    f"<div><a>0 top</a></div><div><a>0 list</a></div><div><a>0 about us</a></div><div><h1>1 a heading</h1><p>1 {LONG}</p></div>",
    f"<div class=cookie><p>0 we use cookies</p></div><article><p>1 one line only.</p></article><form><p>0 your mail</p></form>",
    f"<div class=sidebar><h2>0 popular</h2><p>0 {LONG}</p><ul><li><a>0 more</a></li></ul></div><div><p>1 {LONG}</p><p>1 {LONG}</p></div>",
    f"<article><p>1 {LONG}</p><section class=comments><article><p>0 {LONG}</p></article></section></article>",
    f"<div class=notice>0 {LONG}</div><div class=header>0 {LONG}</div><article><p>1 yes.</p><p>1 no.</p></article>",
    "<div>0 all rights reserved</div><div><a>0 privacy</a></div><div><a>0 terms</a></div>",
    f"<div class=social-science><h1>1 a title</h1><p>1 {LONG}</p><p>1 brief.</p><p>1 {LONG}</p></div><div class=share-bar><a>0 share</a> <a>0 more</a></div>",
    f"<ul class=social><li><a>0 one</a></li><li><a>0 two</a></li></ul><main><p>1 {LONG}</p></main><ul><li><a>0 three</a></li></ul>",
    f"<ul><li><a>0 one</a></li><li><a>0 two</a></li></ul><div><h1>1 a title</h1><p>1 {LONG}</p><p>1 {LONG}</p></div><p><a>0 on</a> <a>0 back</a></p>",
    f"<article><section class='post-type widget'><p>1 {LONG}</p><p>1 {LONG}</p></section></article><div class=widget><a>0 one</a></div>",
    f"<article><div class=article-header><h1>1 a title</h1><p>1 by someone</p></div><p>1 {LONG}</p><p class=advert>0 {LONG}</p>"
    f"<div class=social-links><a>0 here</a></div><p>1 {LONG}</p></article>",
    f"<div class=site-footer><p>0 some words of a firm</p></div><div class=comment-list><p>0 {LONG}</p></div><div class=main-content><p>1 {LONG}</p></div>",
    f"<main><div class=discussion><h2>1 a title</h2><p>1 {LONG}</p></div><div class=cookie-bar><p>0 we use them</p></div></main>",
]


@lru_cache(maxsize=1)
def tree() -> Tree:
    rows = [(f, int(t[0])) for page in LABELLED for t, f in blocks(page)]
    return Tree(np.array([f for f, _ in rows]), np.array([y for _, y in rows]))


def main_blocks(page: str) -> list[str]:
    grown = tree()
    return [text for text, row in blocks(page) if grown.keeps(row)]


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_blocks, n_kept) for each page.

    text joins the kept blocks with line ends; it is empty for a null or empty
    page and where no block is kept. Nothing else is dropped or cut. Repeated
    rows give repeated results.
    """

    def run(batch):
        every = [blocks(p.decode("utf-8", "replace")) for p in batch.column("html").to_pylist()]
        kept = [[t for t, row in page if tree().keeps(row)] for page in every]
        return {
            "page_id": batch.column("page_id"),
            "url": batch.column("url"),
            "text": ["\n".join(k) for k in kept],
            "n_blocks": list(map(len, every)),
            "n_kept": list(map(len, kept)),
        }

    chosen = pages.select("page_id", "url", raw_text("html").alias("html"))
    return map_steps(chosen, run, "page_id bigint, url string, text string, n_blocks int, n_kept int", "html")


def op6_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = extract(load(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.char_length("text").cast("bigint").alias("n_chars"))
