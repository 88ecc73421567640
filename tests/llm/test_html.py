"""Names that wrap articles, deep nesting, repeated pages, clashing columns; tree sums against a walk over all ancestors."""

from __future__ import annotations

import random
import time

import pytest

from fleetfeatures.llm import html

ARTICLE = "<h1>Title</h1><p>" + "A long sentence of the article stands here. " * 8 + "</p><p>" + "Another one follows it. " * 6 + "</p>"
TEXT = "Title " + ("A long sentence of the article stands here. " * 8 + "Another one follows it. " * 6).strip()
COMMENTS = "<section class='comments'><article><p>" + "I disagree at length with all. " * 40 + "</p></article></section>"
NOTICE = "<div class='cookie-notice'>We use cookies on this page, see our terms.</div>"


@pytest.mark.parametrize("name", ["no-sidebar", "with-sidebar", "has-cookie-banner", "search-results", "post related", "entry share",
                                  "comments-open single"])
@pytest.mark.parametrize("around", ["{}", "<article>{}</article>", "<main><div class='widget'>{}</div></main>"])
def test_a_name_around_the_article_does_not_remove_it(name, around):
    page = f"<nav><a href=x>Home</a></nav><div class='{name}'>{around.format(ARTICLE)}</div>{NOTICE}{COMMENTS}<footer>c</footer>"
    assert html.main_text(page) == TEXT


def test_named_blocks_beside_the_article_go():
    beside = "<div class='related'><article><h3><a href=x>Read this too</a></h3></article></div><div class='promo'>Buy it now.</div>"
    assert html.main_text(f"<div id=content>{ARTICLE}{beside}</div>{NOTICE}{COMMENTS}") == TEXT
    # comments longer than the article, and pages of furniture alone
    assert html.main_text(NOTICE) == html.main_text(COMMENTS) == html.main_text(NOTICE + COMMENTS) == ""


@pytest.mark.parametrize("unit", ["<div>x ", "<center>x ", "<p>x<span>", "<ul><li>x ", "<article>x ", "<form>x "])
def test_nesting_costs_no_more_than_its_length(unit):
    def seconds(n: int) -> float:
        start = time.perf_counter()
        html.main_text(unit * n + "</b>" * n)
        return time.perf_counter() - start

    seconds(500)
    assert seconds(32_000) < 16 * max(seconds(4_000), 0.02)  # a square would give 64


def test_tree_sums_against_all_ancestors():
    rng = random.Random(7)
    page = html._Page()
    page.feed("".join(rng.choice(["<div>", "</div>", "<p>", "<ul>", "<li>", "</ul>", "<b>", "</b>", "<td>", "x y "]) for _ in range(2000)))
    page.flush()
    values = {e: rng.randrange(9) for e in range(len(page.tags))}
    want = [0] * len(page.tags)
    for e in range(len(page.tags)):
        at = e
        while at:
            want[at] += values[e]
            at = page.parents[at]
        want[0] += values[e]
    assert page.sums(values) == want
    chosen = {e for e in values if e and rng.random() < 0.1}
    for e, got in enumerate(page.inside(chosen)):
        at = e
        while at and at not in chosen:
            at = page.parents[at]
        assert got == (at in chosen)


def test_repeated_pages_and_clashing_columns(spark):
    rows = [(1, "u", f"<div class='no-sidebar'>{ARTICLE}</div>", "t", 5)] * 3 + [(2, None, None, None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars long")
    got = sorted(tuple(r) for r in html.extract_pages(pages).collect() if r.page_id == 1)
    assert got == [(1, "u", TEXT, len(TEXT))] * 3
    assert [tuple(r) for r in html.extract_pages(pages).collect() if r.page_id == 2] == [(2, None, "", 0)]
