"""HTML extraction: layouts that carry class words, very long pages, long runs of copies, differencing."""

import time

import pytest

from tallyhouse.llm import pages as P


def body(html):
    found = P.lines(html)
    return [x.text for x, k in zip(found, P._body(found)) if k]


@pytest.mark.parametrize("html, want", [
    ('<body class="page has-sidebar"><div><p>one</p><p>two</p></div>', ["one", "two"]),
    ('<div class="layout with-sidebar"><article><p>text</p></article><div class="sidebar">links</div></div>', ["text"]),
    ('<div class="with-sidebar"><div><p>the whole of a page without an article</p></div></div>', ["the whole of a page without an article"]),
    ("<form><main><p>text</p></main></form>", ["text"]),
    ("<form><div><p>a page inside one form, as some servers write it</p></div><nav>menu</nav></form>", ["a page inside one form, as some servers write it"]),
    ('<article><p>a long enough beginning</p><div class="related-work"><p>prior art</p></div><div class="related-posts">x</div></article>',
     ["a long enough beginning", "prior art"]),
    ('<div class="comments"><article><p>a comment</p></article></div><article><p>the longer article</p></article>', ["the longer article"]),
    ("<head><title>t</title><div>seen", ["seen"]),
    ('<article><p>long text of an article</p><div class="share-buttons">x</div><div class="comment-list"><article class="comment">y</article></div>'
     '<div id="ad-box">z</div></article>', ["long text of an article"]),
    ("<nav><ul><li>menu<article><p>text</p></article>", ["text"]),
])
def test_class_words_are_judged_by_the_layout(html, want):
    assert body(html) == want


@pytest.mark.parametrize("html", ["<div><p>x" * 110_000, "<b>x</i>" * 130_000, "<a " * 350_000, "<span>" * 150_000 + "</div>" * 20_000,
                                  "<nav>" * 100_000 + "y", "<head>" * 100_000 + "<p>x", "<td><b>" * 140_000, '<i class="ad">' * 70_000 + "<p>z"])
def test_a_megabyte_of_unclosed_tags_takes_seconds(html):
    start = time.time()
    P.lines(html)
    assert time.time() - start < 20


def test_a_long_run_of_copies_is_linear_and_held_once():
    page = P.lines("<p>the same long line of text that stands in every copy of this page</p><p>one more of the kind</p>")
    differ, out, start = P.Differencer(), [], time.time()
    for i in range(100_000):
        out += differ.add(page, i, 1)
    for k in range(200):
        out += differ.add(P.lines(f"<p>another page, number {k}, with words of its own: {'x' * k}</p>"), 100_000 + k, 2 + k)
    out += differ.end()
    assert [d for d, _ in out] == list(range(100_200)) and len({t for d, t in out if d < 100_000}) == 1
    assert time.time() - start < 60


def test_lines_shared_with_neighbours_go_without_any_class():
    shared = "<div>Read our daily letter and follow the paper on every channel there is</div>"
    own = [f"<p>The story of day {k} tells of {w * 12} and how it all went on from there.</p>" for k, w in enumerate(("rain ", "sun ", "snow ", "wind "))]
    found = [P.lines(f"<body><div>Home</div>{shared}{o}{shared}</body>") for o in own]
    texts = [P.main_text(p, found[:k] + found[k + 1:]) for k, p in enumerate(found)]
    assert all("daily letter" not in t and "Home" not in t and f"day {k}" in t for k, t in enumerate(texts))
    assert "daily letter" in P.main_text(found[0], [])  # the neighbours decide, not the element
