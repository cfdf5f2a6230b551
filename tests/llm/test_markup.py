"""Wrappers around articles and elements without an end tag."""

from __future__ import annotations

import pytest

from rallymart.llm import extract


def _text(page, monkeypatch=None):
    zones = extract.blocks(page)
    return " ".join(b for b, z in zones if z in (extract.ARTICLE, extract.NAMED))


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("<body><form runat=server><nav>m</nav><article>x y</article></form>", "x y"),
        ("<body class='right-sidebar'><div>n</div><article>x y</article>", "x y"),
        ("<div id='content-sidebar-wrap'><main>x y</main><aside>z</aside></div>", "x y"),
        ("<div class='social page'><article>x</article><p>y</p></div>", "x"),
        ("<article>a<section id='related-work'><p>b</p></section><p class='share-price'>c</p></article>", "a b c"),
        ("<div class='comments'><article>x</article></div><article>y</article>", "y"),
        ("<div class='ads-box'><article>x</article></div><article>y</article>", "y"),
        ("<article>y<form>f</form><div class='sidebar'>z</div></article>", "y"),
    ],
)
def test_articles_in_wrappers(page, text):
    assert _text(page) == text


def test_a_class_word_counts_with_repeats(spark):
    notice = "this part of the page is the same on all of them"
    page = "<article>story{0}<div class='share-row'>{1}</div></article>"
    rows = [(i, "http://a.b/", page.format(i, notice if i else "its own text")) for i in range(6)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = {r.page_id: r.text for r in extract.main_texts(pages).collect()}
    assert found == {0: "story0 its own text"} | {i: f"story{i}" for i in range(1, 6)}


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("<article>a<svg class='i'/>b<p>c</p></article>", "ab c"),
        ("<article>a<svg/>b<svg><path/><text>t</text></svg>c</article>", "abc"),
        ("<article>a <math><mi>x</mi><mo>=</mo><mn>1</mn></math> b<math/>c</article>", "a x=1 bc"),
        ("<article>a<noscript>b<p>c</p></article>", "ab c"),
        ("<article>a<svg>b</article><article>c</article>", "ab c"),
        ("<article>a<script>b</article>", "a"),
    ],
)
def test_rest_of_the_page_stays(page, text):
    assert _text(page) == text


def test_unclosed_elements_take_time_in_proportion():
    assert _text("<article>" + "<noscript>x" * 100_000).count("x") == 100_000
