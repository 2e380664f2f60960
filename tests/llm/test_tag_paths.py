from __future__ import annotations

import html
import re

import pytest
from orderloom.llm import tag_paths
from orderloom.llm.queries import registered

BODY = "".join(f"<p>Sentence number {i}, with commas, and an end. It goes on for a while here.</p>" for i in range(6))
TEXT = "\n".join(f"Sentence number {i}, with commas, and an end. It goes on for a while here." for i in range(6))


def page(main: str, before: str = "", after: str = "") -> str:
    return f"<html><head><title>T</title><style>p{{}}</style></head><body>{before}{main}{after}</body></html>"


@pytest.mark.parametrize(
    "noise",
    [
        "<nav><ul><li><a href='/a'>Menu, one. Two, three.</a></li></ul></nav>",
        "<header><h2>Site, name. Here it is.</h2></header>",
        f"<footer><p>{'Long, long, long footer. With, many, points. ' * 5}</p></footer>",
        "<aside><p>Side, text. More, of, it.</p></aside>",
        "<div class='ad'>Buy, now. Cheap, good.</div>",
        "<div id='cookie-notice'><p>We use cookies, many of them. Accept, please.</p></div>",
        "<div class='sideBar'><p>Other, things. To, read.</p></div>",
        "<form><p>Name, please. And, age.</p><input value='x'><button>Send, it.</button></form>",
        f"<section class='comments'><p>{'Nice, article. I, liked, it. ' * 9}</p></section>",
        "<script>var t = '<p>no, not this.</p>';</script>",
        "<!-- <p>nor, this.</p> -->",
        "<div role='alert'><p>Warning, all. Stop, now.</p></div>",
        "<div style='display: none'><p>Hidden, text. Not, seen.</p></div>",
    ],
)
@pytest.mark.parametrize("where", ["before", "after", "inside"])
@pytest.mark.parametrize("holder", ["article", "main", "div"])
def test_only_the_article_is_left(noise, where, holder):
    if where == "inside" and "header" in noise and holder != "div":
        pytest.skip("headings of an article's own header belong to it")
    if where == "inside":
        half = len(BODY) // 2 - len(BODY) // 2 % len("<p>Sentence number 0, with commas, and an end. It goes on for a while here.</p>")
        html_text = page(f"<{holder}>{BODY[:half]}{noise}{BODY[half:]}</{holder}>")
    else:
        html_text = page(f"<{holder}>{BODY}</{holder}>", **{where: noise})
    assert tag_paths.extract(html_text) == TEXT


def test_blocks_references_and_white_space():
    got = tag_paths.extract(page("<article><h1>A &amp; B</h1><p>one\n  two<br>three &lt;b&gt; &#233;&nbsp;x,<b> bold</b>ly.<p>next, one. Open</article>"))
    assert got == "A & B\none two three <b> é x, boldly.\nnext, one. Open"


@pytest.mark.parametrize("empty", [None, "", "   ", "<html><body></body></html>", "<script>x</script>", "<!-- x", "<!doctype", "<p"])
def test_no_text(empty):
    assert tag_paths.extract(empty) == ""


def test_paragraphs_without_a_holder():
    menu = "<ul><li><a href='/'>Home</a></li><li><a href='/x'>Other</a></li></ul>"
    assert tag_paths.extract(page(f"{menu}<h1>Title here</h1>{BODY}{menu}")) == f"Title here\n{TEXT}"


@pytest.mark.parametrize(
    "wrap",
    [
        "<form id='aspnetForm'>", "<form role='form'>", "<div class='content has-sidebar'>", "<div class='no-header'>",
        "<div class='entry share-enabled'>", "<div id='page-form'>", "<form><div class='no-header'>", "<article><div class='entry share-enabled'>",
    ],
)
@pytest.mark.parametrize("headline", ["inside", "before", ""])
def test_a_mark_around_the_article_is_lifted(wrap, headline):
    """Also beside a longer footer and longer comments; marks inside the wrapper stay."""
    close = "".join(f"</{t}>" for t in reversed(re.findall(r"<(\w+)", wrap)))
    title = "<h1>Title here</h1>"
    comments = f"<section class='comments'>{'<div class=comment><p>Nice, article. I, liked, it.</p></div>' * 40}</section>"
    inside = f"{title if headline == 'inside' else ''}{BODY}{comments}"
    got = tag_paths.extract(page(f"{title if headline == 'before' else ''}{wrap}{inside}{close}", "<nav>Menu, one</nav>", f"<footer><p>{'Foot, foot. ' * 99}</p></footer>"))
    assert got.removeprefix("Title here\n") == TEXT


def test_alike_wrappers_are_lifted_together():
    parts = [f"<div class='section no-header'><p>{t}</p></div>" for t in TEXT.split("\n")]
    assert tag_paths.extract(page("".join(parts))) == TEXT


@pytest.mark.parametrize("holder", ["article", "div"])
def test_long_comments_stay_out(holder):
    comments = f"<section class='comments'><p>{'Nice, article. I, liked, it. ' * 100}</p></section>"
    assert tag_paths.extract(page(f"<article><h1>T</h1>{BODY}</article>{comments}")) == f"T\n{TEXT}"
    few = f"<section class='comments'><p>{'Nice, article. I, liked, it. ' * 40}</p></section>"
    assert tag_paths.extract(page(f"<{holder}><h1>T</h1>{BODY}{few}</{holder}>")) == f"T\n{TEXT}"


def test_lists_quotes_and_tables_of_a_flat_page():
    menu = "<ul><li><a href='/'>Home</a></li></ul>"
    parts = "<ul><li>one</li><li>two</li></ul><blockquote>said</blockquote><table><tr><td>cell</td></tr></table><pre>code</pre>"
    assert tag_paths.extract(page(f"{menu}<h1>Title</h1>{BODY}{parts}{BODY}{menu}")) == f"Title\n{TEXT}\none\ntwo\nsaid\ncell\ncode\n{TEXT}"


@pytest.mark.parametrize(
    "block",
    [
        "<p class='side-effects'>{}</p>", "<section id='response-rates'><p>{}</p></section>", "<div class='search-results'>{}</div>",
        "<div class='top-speed alert-levels'><p>{}</p></div>", "<p id='readerExperience'>{}</p>",
    ],
)
@pytest.mark.parametrize("holder", ["article", "main"])
def test_names_that_only_begin_like_a_part(block, holder):
    text = "These, too, are sentences. They belong here, all of them."
    assert tag_paths.extract(page(f"<{holder}>{BODY}{block.format(text)}</{holder}>")) == f"{TEXT}\n{text}"


@pytest.mark.parametrize("name", ["side-bar", "search-box", "related-stories", "sideColumn2", "response-form", "site-notice", "social-media-links", "alert", "reader-comments"])
def test_names_of_parts(name):
    noise = f"<div class='{name}'><p>Other, things. To, read, here.</p></div>"
    assert tag_paths.extract(page(f"<article>{BODY}{noise}</article>")) == TEXT


def test_a_bad_declaration_does_not_end_the_page():
    assert tag_paths.extract("<article><p>A, one.</p><![foo[ x ]]><p>B, two.</p></article>") == "A, one.\nB, two."
    assert tag_paths.extract("<article><p>A, one.</p><![if IE]><p>B, two.</p><![endif]><p>C, three.</p></article>") == "A, one.\nB, two.\nC, three."
    assert tag_paths.extract("<article><p>A, one.</p><![foo[ x") == "A, one."


def test_broken_and_deep_pages():
    assert tag_paths.extract("<div>" * 5000 + "deep, text. here" + "</div>" * 100) == "deep, text. here"
    assert tag_paths.extract("<article><p>cut, off. here &am") == "cut, off. here &am"
    assert tag_paths.extract("<article><p>cut, off. here</p><p class='a") == "cut, off. here"
    assert tag_paths.extract("<article><p>1 < 2, said. they</p></art") == "1 < 2, said. they"
    assert tag_paths.extract("</p></div>stray, ends. only") == "stray, ends. only"


def test_table_with_odd_rows(spark):
    rows = [(1, "u", None), (2, None, ""), (3, "u", page(f"<article>{BODY}</article>")), (3, "u", page(f"<article>{BODY}</article>")), (None, "u", "x, y. z")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "url AS text", "1 AS n_chars")
    got = {(r.page_id, r.url): (r.text, r.n_chars) for r in tag_paths.main_text(pages).collect()}
    assert got == {(1, "u"): ("", 0), (2, None): ("", 0), (3, "u"): (TEXT, len(TEXT)), (None, "u"): ("x, y. z", 7)}
    assert tag_paths.main_text(pages).count() == 5
    assert tag_paths.main_text(pages.limit(0)).collect() == []


def test_given_pages(spark, sf_dir, table):
    """The given pages have one article each; a plain cut of it must agree."""
    want = {}
    for r in table("pages").collect():
        article = re.search(r"<article>(.*?)(</article>|$)", r.html, re.S).group(1)
        blocks = [re.sub(r"\s+", " ", html.unescape(re.sub("<[^>]*>", " ", b))).strip() for b in re.split("</?(?:p|h1)>", article)]
        want[r.page_id] = "\n".join(b for b in blocks if b)
    got = registered()["op1_tag_paths"](spark, sf_dir)
    assert got.columns[:4] == ["page_id", "url", "text", "n_chars"]
    assert {r.page_id: r.text for r in got.collect()} == want
