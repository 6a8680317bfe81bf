"""Pages with left-out end tags, odd names, other scripts, and markup that never ends."""

import time

import pytest

from riskstream.llm import html_text

LONG = "The text of the article is here and it is long. " * 8
BODY = LONG.strip()


@pytest.mark.parametrize(
    "html, lines",
    [
        (f"<article><p class='ad'>buy<p>{LONG}</article>", [BODY]),
        (f"<article><ul><li class=share>tweet<li>{LONG}</ul></article>", [BODY]),
        (f"<article><table><tr><td class=ad>buy<td>{LONG}<tr><td>{LONG}</table></article>", [BODY, BODY]),
        (f"<article><dl><dt class=ads>x<dd>{LONG}</dl></article>", [BODY]),
        (f"<article><select><option>one<option>two</select><p>{LONG}</article>", [BODY]),
        (f"<article><section id=discussion><p>{LONG}</p></section></article>", [BODY]),
        (f"<article><h2 id=search>How to search</h2><p>{LONG}</p></article>", ["How to search", BODY]),
        (f"<article><div class=post-header><h1>Title</h1></div><p>{LONG}</p></article>", ["Title", BODY]),
        (f"<div class='social-history related-work'><p>{LONG}</p></div>", [BODY]),
        (f"<article><p><a href=x>A paragraph that is one link</a></p><p>{LONG}</p></article>", ["A paragraph that is one link", BODY]),
        (f"<article><p>Energy <math>E</math> is <noscript>well</noscript> known.</p><p>{LONG}</p></article>", ["Energy E is well known.", BODY]),
        (f"<nav><a href=x>home</a></nav><h1>Short title</h1><p>{LONG}</p><p>The end.</p><footer>c</footer>", ["Short title", BODY, "The end."]),
        (f"<p>{LONG}</p><div>Menu of the day</div>", [BODY]),
    ],
)
def test_text_of_the_article_is_kept(html, lines):
    assert html_text.extract(html) == "\n".join(lines)


@pytest.mark.parametrize("name", ["ad", "ad-banner", "site-header", "adBanner", "comment-list", "share-buttons", "ad-728x90", "user_comments"])
@pytest.mark.parametrize("attribute", ["class", "id"])
def test_elements_named_as_something_else_go(name, attribute):
    html = f"<article><p>{LONG}</p><div {attribute}='x {name}'><p>{LONG}</p></div></article>"
    kept = f"<article><p>{LONG}</p><div {attribute}='{name}ition-x'><p>{LONG}</p></div></article>"
    if attribute == "class":
        assert html_text.extract(html) == BODY
    assert html_text.extract(kept) == f"{BODY}\n{BODY}"


@pytest.mark.parametrize(
    "text",
    [
        "这是一个关于历史的故事，它讲述了很多事情。" * 6,
        "Это рассказ о том, как люди жили раньше, и о том, что было потом. " * 4,
        "Il testo parla di una storia lunga, e non finisce mai; qualcuno legge ancora. " * 4,
    ],
)
def test_languages_without_stop_words(text):
    page = f"<nav><a href=x>a</a></nav><div><p>{text}</p></div><footer>f</footer>"
    assert html_text.extract(page) == text.strip()
    assert html_text.extract(f"<article>{page}</article>") == text.strip()


@pytest.mark.parametrize(
    "page",
    ["<i>" * 100_000 + "</u>" * 100_000, "<b>" * 50_000 + "<a href=x>t</a>" * 50_000, "<p>" * 100_000, "<div>" * 100_000 + "x",
     "<ul><li>" * 50_000, "<a>" * 100_000, "<td>" * 100_000, "<div class=ad>" * 50_000 + "</p>" * 50_000],
)
def test_markup_that_never_ends_takes_linear_time(page):
    start = time.process_time()
    html_text.extract(page)
    assert time.process_time() - start < 5


def test_very_long_and_repeated_pages(spark):
    page = f"<article>{'<p>' + LONG + '</p>'}</article>" + "<div>x</div>" * 10
    huge = "<article>" + f"<p>{LONG}</p>" * 3000 + "</article>"
    rows = spark.createDataFrame([(1, "u", page, 1), (1, "u", page, 1), (2, None, huge, 2)], "page_id long, url string, html string, n_chars int")
    found = sorted((r.page_id, r.n_chars) for r in html_text.extract_pages(rows).collect())
    assert found == [(1, len(BODY)), (1, len(BODY)), (2, 3000 * (len(BODY) + 1) - 1)]
