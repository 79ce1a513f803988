from __future__ import annotations

import html as entities
import re

import numpy as np
import pytest

from grantlens.llm import html
from tests.llm.helpers import SF, table


def text_of(page):
    return "\n".join(html.main_blocks(page))


def plain_article(page):
    """The article's blocks, cut by a rule that fits the given pages only."""
    inner = re.search(r"<article>(.*?)</article>", page, re.S)[1]
    parts = re.split(r"</?(?:p|h1)>", re.sub(r"</?b>", "", inner.replace("<br>", " ")))
    return "\n".join(x for x in (" ".join(entities.unescape(p).split()) for p in parts) if x)


def test_query_against_plain_rule(spark):
    want = table("pages").set_index("page_id")
    rows = html.op6_html(spark, SF).collect()
    assert len(rows) == len(want)
    for r in rows:
        assert r.text == plain_article(want.html[r.page_id]) and r.n_chars == len(r.text)
        assert r.url == want.url[r.page_id]


def test_tree_learns_its_table():
    for page in html.LABELLED:
        for text, row in html.blocks(page):
            assert html.tree().keeps(row) == int(text[0])


def test_unseen_layouts():
    page = """<html><head><title>T</title><style>p{}</style></head><body>
    <header><h1>Site</h1><nav><a href=/>Home</a></nav></header>
    <div id="cookie-consent" class="notice"><p>We use cookies on this site to make it better for you.</p></div>
    <main><article><h2>Head &amp; line</h2><p>First <em>para</em>graph,<br>two lines &lt;b&gt;.</p>
    <div class="advert"><p>Buy now, it is cheap and good and here today.</p></div>
    <ul><li>One</li><li>Two&nbsp;3</li></ul><form><label>Mail</label><input></form>
    <table><tr><td>a</td><td>b</td></tr></table>
    <section id="comments"><article class="comment"><p>I like this one very much, thanks.</p></article></section>
    </article></main><aside class="sidebar"><p>Other things that you may read next on this site.</p></aside>
    <script>if (a < b) { x = "</p><p>no"; }</script><!-- <p>hidden</p> --><footer><p>All rights</p></footer></body>"""
    assert text_of(page) == "Head & line\nFirst paragraph, two lines <b>.\nOne\nTwo 3\na\nb"


SAY = "what this paragraph says goes on for a good many words, as main text mostly does, until it comes to its end"


@pytest.mark.parametrize(
    "page, want",
    [
        ("<article><p>before</p><svg viewBox='0 0 1 1'/><p>after</p><math/><p>end</p></article>", "before\nafter\nend"),
        ("<article><p>a<svg><path d='x'/>no</svg>b</p><p>c</p></article>", "ab\nc"),
        (f"<article><p>{SAY}</p><p class=advert>{SAY}</p><p>{SAY}</p></article>", f"{SAY}\n{SAY}"),
        (f"<article><p>one <span class='advert'>buy <span>this</span> now</span> two <b class=x>three</b></p><p>{SAY}</p></article>", f"one two three\n{SAY}"),
        (f"<article><p>one <span hidden>never closed</p><p>{SAY}</p></article>", f"one\n{SAY}"),
        (f"<article><p>one <img class=ad src=x> two</p><p>{SAY}</p></article>", f"one two\n{SAY}"),
        (f"<div class=social-science><h1>Title</h1><p>{SAY}</p><p>{SAY}</p></div>", f"Title\n{SAY}\n{SAY}"),
        (f"<article class='post-type widget'><p>{SAY}</p><p>{SAY}</p></article>", f"{SAY}\n{SAY}"),
        (f"<article><section class='widget post'><p>{SAY}</p><p>{SAY}</p></section></article>", f"{SAY}\n{SAY}"),
        (f"<article><header class=article-head><h1>Title</h1></header><p>{SAY}</p></article>", f"Title\n{SAY}"),
        (f"<div><p>{SAY}</p><p>{SAY}</p></div><div class=comments><p>{SAY}</p></div>", f"{SAY}\n{SAY}"),
        (f"<div class=sidebar><p>{SAY}</p></div><article><p>{SAY}</p></article>", SAY),
        (f"<div id=comment-12><p>{SAY}</p></div><article><p>{SAY}</p><p>Brief.</p></article>", f"{SAY}\nBrief."),
        (f"<ul class=share><li><a>Here</a></li><li><a>There</a></li></ul><main><p>{SAY}</p></main>", SAY),
    ],
)
def test_held_out_layouts(page, want):
    assert text_of(page) == want


def test_no_text_is_lost_before_the_tree_decides():
    page = "<p>a</p><span class=ad>b</span> c <div class=ad>d<p hidden>e</p></div><svg/>f<b class=advert>g</b>"
    assert sorted("".join(t for t, _ in html.blocks(page)).replace(" ", "")) == list("abcdefg")


@pytest.mark.parametrize(
    "page",
    ["", "<", "<p", "<!--", "<script>x", "a < b > c", "</article></p></div>", "<p>x<p>y", "&#xD800;&bogus;&amp", "<a href='x", "<" * 3000, "<p a=\"" * 3000],
)
def test_broken_pages_do_not_fail(page):
    assert isinstance(text_of(page), str)


def test_long_page_is_whole():
    body = "".join(f"<p>paragraph number {i} with some words in it</p>" for i in range(20000))
    assert text_of(f"<article>{body}</article>").count("\n") == 19999


def test_nulls_repeats_and_extra_columns(spark):
    frame = spark.createDataFrame(
        [(1, "u", None, "x"), (2, None, "", "x"), (None, "u", "<article><p>a b</p></article>", "x"), (3, "u", "<nav>a</nav>", "x")],
        "page_id bigint, url string, html string, text string",
    )
    got = {r.page_id: (r.url, r.text) for r in html.extract(frame.union(frame)).collect()}
    assert got == {1: ("u", ""), 2: (None, ""), None: ("u", "a b"), 3: ("u", "")}
    assert html.extract(frame.limit(0)).count() == 0


def test_tree_on_ties_and_one_class():
    x = np.ones((4, 2))
    assert html.Tree(x, np.array([1, 1, 1, 0])).keeps(x[0]) == 1 and html.Tree(x, np.zeros(4)).keeps(x[0]) == 0
