"""Main text in and under elements whose attributes only look like marks of boilerplate."""

from __future__ import annotations

import time

import numpy as np
import pytest

from corpuswright.llm import html_text
from tests.llm.pages import pages

TEXT = "The text of the page is here, and it is long enough to be read by anyone."
LONG = " ".join([TEXT] * 6)


@pytest.mark.parametrize("attribute", ['style="overflow:hidden"', 'title="a hidden gem"', 'data-hidden="false"', "data-x='hidden'", 'class="layout has-sidebar"', 'class="no-sidebar with_menu"', 'class="sidebar-left layout"', 'data-role="navigation"', "style=overflow:hidden", 'data-class="menu"', 'hidden-x'])
def test_wrappers_of_an_article(attribute):
    assert html_text.main_text(f"<body><div {attribute}><article><p>{TEXT}</p></article></div><nav>Menu</nav></body>") == TEXT
    assert html_text.main_text(f"<main><div class=body><p>{TEXT}</p></div><p>See <a title=\"hidden\" href=\"/hidden/page\">this page</a> too.</p></main>") == f"{TEXT}\nSee this page too."


@pytest.mark.parametrize("attribute", ["hidden", 'HIDDEN=""', "class=x hidden", 'aria-hidden="true"'])
def test_hidden_stays_hidden(attribute):
    assert html_text.main_text(f"<article><p>{TEXT}</p><p {attribute}>{LONG}</p></article>") == TEXT


def test_article_classes():
    assert html_text.main_text(f'<article class="post has-comments"><p>{TEXT}</p></article>') == TEXT
    assert html_text.main_text(f'<article><p>{TEXT}</p></article><article class="comment"><p>{LONG}</p></article>') == TEXT


def test_boilerplate_by_class_beside_an_article():
    page = f'<div class="sidebar"><article><p>{LONG}</p></article></div><article><p>{TEXT}</p><div class="related"><article><p>{LONG}</p></article></div><div class="promo"><p>{LONG}</p></div></article><div class=comments><p>{LONG}</p></div>'
    assert html_text.main_text(page) == TEXT


def test_class_is_overruled_where_nothing_else_is_text():
    assert html_text.main_text(f'<div class="notice"><p>{LONG}</p><p>{LONG}</p></div><div class="menu"><a href=/>Home</a></div>') == f"{LONG}\n{LONG}"


def test_weights_are_fitted():
    made = pages(1500, 1)
    assert html_text.fit(made) == html_text.WEIGHTS
    unseen = pages(500, 2)
    assert sum(html_text.main_text(p) == text for p, text in unseen) > 0.8 * len(unseen)
    lines = [(line, set(html_text.main_text(p).split("\n"))) for p, text in unseen for line in text.split("\n")]
    assert sum(line in got for line, got in lines) > 0.98 * len(lines)


@pytest.mark.parametrize("page", [f'<div class="content with-sidebar"><article><p>{TEXT}</p></article></div>', f'<div class="site menu-fixed"><main><p>{TEXT}</p></main></div>', f'<main><div class="tags-open"><p>{TEXT}</p></div></main>', f'<div class="tags-open"><p>{TEXT}</p></div>'])
def test_ordinary_class_names(page):
    assert html_text.main_text(page) == TEXT


@pytest.mark.parametrize("cut", ['<a href="http://x', "<a href='x", "<a", "<a href", "<a href=", "</a", "</", "<!-- x", "<!d", "<img src=\"x>words words", "<p class='a b", "<a b='\"' c"])
def test_cut_markup_is_not_text(cut):
    assert html_text.main_text(f"<article><p>{TEXT}</p>{cut}") == TEXT


def test_quotes_in_attributes():
    page = f'<article><p title="a > b" data-x=\'"<p>\'>{TEXT}</p><p>{LONG} <a href="x>y">This</a> and <a href=/a/b/>that</a> too.</p><p>3 < 4 and a<b</p></article>'
    assert html_text.main_text(page) == f"{TEXT}\n{LONG} This and that too.\n3 < 4 and a"


@pytest.mark.parametrize("page", ["<a b" * 50_000, '<p>x <a href="' + "x" * 200_000, "<p>x</p>" + "<a b='\"" * 30_000, "<div>x" * 34_000, "<div>a line of text.<p>" * 9000, "<div>" * 30_000 + "</b>" * 30_000, "<p><button>" + "<div>" * 40_000, "<b>x<br>" * 25_000, "<ul>" + "<li>x" * 40_000, "<" * 200_000, "<div>text.<nav>x</nav>" * 9000])
def test_time_is_linear(page):
    began = time.process_time()
    html_text.main_text(page)
    assert time.process_time() - began < 6


def test_parts_give_the_same_cut_as_the_whole():
    random = np.random.default_rng(9)
    for _ in range(200):
        n = int(random.integers(1, 14))
        content = random.integers(-40, 40, n).tolist()
        edges = [(i, i + 1, int(random.integers(1, 40))) for i in range(n - 1)] + [(int(min(a, b)), int(max(a, b)), int(random.integers(1, 20))) for a, b in random.integers(0, n, (4, 2)) if a != b]
        assert html_text.labels(content, edges) == html_text.minimum_cut(content, edges)
