"""Names of elements may not hide an article; depth costs no more than length."""

import time

import pytest

from stratamart.llm import html_text

PARTS = [f"Paragraph {i} of the article " + "with a good deal of running text in it " * 8 + "so it ends." for i in range(3)]
BODY = "".join(f"<p>{p}</p>" for p in PARTS)
ARTICLE = f"<article>{BODY}</article>"
FOOT = '<div class="site-footer"><p>All rights reserved by someone or other</p></div>'
LINKS = "<div>" + "<div><a href='/x'>go</a></div>" * 9 + "</div>"
WHOLE = " ".join(PARTS)


@pytest.mark.parametrize(
    "page",
    [
        f'<div class="layout has-sidebar">{ARTICLE}</div>{FOOT}',
        f'<article class="post comments-open">{BODY}</article>{FOOT}',
        f'<div id="search-page">{ARTICLE}</div>{FOOT}',
        f'<form id="aspnetForm">{ARTICLE}{FOOT}</form>',
        f'<div class="form"><main>{BODY}</main></div>',
        f'<body class="comments"><div class="layout has-sidebar"><div>{BODY}</div>{LINKS}</div>{FOOT}',
        f"<form>{LINKS}<div>{BODY}</div></form>",
        f'<div class="related-posts"><article><h3>Read on</h3></article></div><main>{BODY}</main>',
        f'{ARTICLE}<div class="comments"><article><p>{PARTS[0]}</p></article></div>',
        f'{ARTICLE}<div id="comment-list"><p>{PARTS[0]}</p></div>',
        f'<article>{BODY}<form class="newsletter-signup"><p>Your mail address please</p></form></article>',
        f'<article>{BODY[:-4]}<span class="ad">buy this</span></p></article>',
    ],
)
def test_the_article_and_no_more(page):
    assert html_text.main_text(page) == WHOLE


def test_the_ratio_decides_where_names_and_tags_do_not():
    page = f"{LINKS}<div>{BODY}</div>{LINKS}"
    assert html_text.main_text(page) == WHOLE
    lines = html_text.read_lines(page)
    every = html_text.shown(lines, [False] * len(lines.names))
    assert sum(text == "go" for text, _, _ in every) == 18  # without it these would come too


@pytest.mark.parametrize("unit", ["<div>text here", "<div>text</b> here<hr>", "<b>text here", "<p><b>x</p>", "</div></p>x<br>"])
def test_nesting_is_linear(unit):
    def took(n):
        started = time.process_time()
        html_text.main_text(unit * n)
        return time.process_time() - started

    took(100)
    assert took(20_000) < 40 * took(1_000) + 1


def test_tables_of_odd_pages(spark):
    shape = "page_id long, url string, html string, text string, n_chars long"
    rows = [(1, "u", ARTICLE, "mine", 7), (1, "u", ARTICLE, "mine", 7), (None, None, None, None, None),
            (3, "v", "<p>" * 3 + "word " * 100_000, "", 0), (4, "w", "<div>" * 20_000 + "deep", "", 0)]
    out = html_text.extract(spark.createDataFrame(rows, shape)).collect()
    assert [r.text for r in out][:3] == [WHOLE, WHOLE, ""]
    assert len(out[3].text) == 499_999 and out[4].text == "deep"
    assert html_text.extract(spark.createDataFrame([], shape)).count() == 0
