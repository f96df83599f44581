"""Names of classes and ids are weighed against the text; deep pages take linear time."""

import time

import pytest

from wiremap.llm.main_text import main_text

LONG = "many plain words of an article that goes on and on " * 8
TEXTS = [f"{i} {LONG}".strip() for i in range(5)]
BODY = "".join(f"<p>{t}</p>" for t in TEXTS)
NAV = "<nav><a href=/>Home</a> <a href=/b>About</a></nav>"
FOOT = "<footer>Made with care</footer>"
COMMENTS = f"<div class=comments><p>Reader: {LONG}</p><p>Other: {LONG}</p></div>"


@pytest.mark.parametrize("page", [
    f'<div class="row has-sidebar">{BODY}</div>',
    f'<div class="elementor-widget elementor-widget-text-editor">{BODY}</div>',
    "".join(f'<div class="elementor-widget elementor-widget-text-editor"><p>{t}</p></div>' for t in TEXTS),
    f'<div id=page class="layout-sidebar-right"><article>{BODY}</article></div>',
    f'<form action=/ method=post>{BODY}<input name=x></form>',
    f'<article><p>{TEXTS[0]}</p><section class="market-share"><p>{TEXTS[1]}</p></section>'
    + "".join(f"<p>{t}</p>" for t in TEXTS[2:]) + "</article>",
    f'<div class="has-sidebar"><div class="page-widget">{BODY}</div><div class=sidebar><p>See also {LONG[:90]}</p></div></div>',
    f'<div class="comments-open"><article>{BODY}</article>{COMMENTS}</div>',
    f'<form><div class="with-banner"><main>{BODY}</main></div></form>',
    f'<article>{BODY}<div class="share">Share this: <a>one</a> <a>two</a></div></article>',
    f'<article>{BODY}</article>{COMMENTS}',
    f'<div>{BODY}</div><div class="cookie-notice">We use cookies. {LONG[:150]}</div>',
    f'<div>{BODY}</div><div class=related><article><p>Teaser one</p></article></div>',
    f'<div>{BODY}</div><form><p>Write to us</p><input></form>',
])
def test_the_article_and_nothing_else(page):
    assert main_text(f"<html><body>{NAV}{page}{FOOT}</body></html>").split("\n") == TEXTS


def test_long_comments_under_a_short_article():
    long = f"<div class=comments>{'<p>Reader: ' + LONG + '</p>'}{BODY}{BODY}</div>"
    page = f"<body>{NAV}<div><p>{TEXTS[0]}</p></div>{long}{FOOT}</body>"
    assert main_text(page) == TEXTS[0]


@pytest.mark.parametrize("tag", ["div", "span", "article", "a"])
def test_deep_pages(tag):
    start = time.perf_counter()
    out = main_text("".join(f"<{tag}>word{i} and more </b>" for i in range(20_000)) + "</section>" * 5_000)
    assert out.count("word") == 20_000 or tag == "a"
    assert time.perf_counter() - start < 8
