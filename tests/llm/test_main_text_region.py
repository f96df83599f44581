"""The content lines choose the region of a page, with and without semantic tags."""

import re

import duckdb

from wiremap.llm.main_text import main_text

LONG = "many plain words of an article that goes on and on " * 8


def lines(n):
    return [f"{i} {LONG}".strip() for i in range(n)]


def test_generated_pages_without_semantic_tags():
    for (page,) in duckdb.sql("select html from '/root/testdata/sf0.01/pages.parquet'").fetchall():
        assert main_text(re.sub(r"(</?)article\b", r"\1div", page)) == main_text(page)


def test_an_article_without_content_lines_does_not_decide():
    short = "".join(f"<div>{w}</div>" for w in ("one", "two", "three", "four"))
    text = "".join(f"<p>{t}</p>" for t in lines(3))
    page = f"<body><div><article><p>Read on</p></article>{short}</div><div id=text>{text}</div></body>"
    assert main_text(page).split("\n") == lines(3)


def test_a_short_line_beside_the_article_stays_out():
    text = "".join(f"<p>{t}</p>" for t in lines(3))
    page = f"<body><article>{text}</article><div>Made with care</div></body>"
    assert main_text(page).split("\n") == lines(3)


def test_every_content_line_is_in_the_region():
    lead, text = "lead " * 60, "text " * 800
    page = f"<body><div id=lead>{lead}</div><div id=text>{text}</div></body>"
    assert main_text(page).split("\n") == [lead.strip(), text.strip()]


def test_all_articles_with_content_lines_are_kept():
    parts = [f"<article><h2>Part {i}</h2><p>{t}</p><p>end</p></article>" for i, t in enumerate(lines(3))]
    want = [x for i, t in enumerate(lines(3)) for x in (f"Part {i}", t, "end")]
    assert main_text(f"<body><div>Site</div>{''.join(parts)}<div>Made with care</div></body>").split("\n") == want
    assert main_text(f"<main><h1>All</h1>{''.join(parts)}</main>").split("\n") == ["All", *want]
