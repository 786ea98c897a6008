import html
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tradewake.llm.html_text import extract, main_text

LONG = "A sentence of ordinary prose that is long enough to be read as an article by anyone who passes. "


@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("   ", ""), ("<html><head><title>t</title></head><body></body></html>", ""), ("plain &amp; simple", "plain & simple"),
    ("<p>one<p>two <b>bold</b>", "one\ntwo bold"),
    ("<p>a&nbsp;&lt;b&gt; &#233;&#x41; &copy  x</p>", "a <b> éA © x"),
    ("<div><br>line<br/>break</div>", "line break"),
    ("<p>a</p><![foo[x]]><p>b</p>", "a\nb"), ("<p>a<![CDATA[x]]>b</p>", "ab"), ("<p>a</p><!-- c --!><p>b</p>", "a\nb"), ("<!--><p>a</p>", "a"), ("<p>a</p><!-- never closed <p>b</p>", "a"),
    ("<!DOCTYPE html [<!ELEMENT x (y)>]><p>a</p>", "a"), ("<!doctype html><p>a</p><!x y><p>b", "a\nb"), ("<p>a</p><?pi x", "a"), ("<p>a</p><!", "a"), ("<p>a <b", "a"),
    ("<p>x</p><!-- not <p>this</p> --><script>var a='</p><p>no';</script><style>p{}</style>", "x"),
    ("<ul><li>a<li>b</ul>", "a\nb"), ("<table><tr><td>c<td>d</table>", "c\nd"), ("<p>unclosed <i>tag", "unclosed tag"), ("</div></p>stray", "stray"),
])
def test_markup(page, text):
    assert main_text(page) == text


def test_article_without_what_surrounds_it():
    page = f"""<html><body class="has-sidebar"><header class="site">Site name</header><nav><ul><li><a href=/a>Home</a><li><a href=/b>News</a></ul></nav>
    <div class="cookie-notice">{LONG}</div><div id="adBanner">{LONG}</div>
    <main><article><header><h1>Title</h1></header><p>{LONG}</p><p>{LONG} <a href=x>a link</a></p><form><input><label>Your mail</label></form>
    <aside>{LONG}</aside><div class="comments-list"><p>{LONG}</p></div></article></main>
    <div class="sidebar">{LONG}</div><footer>&copy; someone</footer></body></html>"""
    assert main_text(page) == f"Title\n{LONG.strip()}\n{LONG.strip()} a link"


def test_density_finds_the_text_without_any_hint():
    links = "".join(f"<div><a href=/{k}>Section {k}</a></div>" for k in range(30))
    page = f"<body><div>{links}</div><div><div><p>{LONG * 3}</p><p>{LONG * 2}</p><p>{LONG * 4}</p></div></div><div>{links}</div></body>"
    assert main_text(page) == "\n".join((LONG * k).strip() for k in (3, 2, 4))


def test_main_bounds_the_search():
    links = "<div>" + "".join(f"<a href=/{k}>l{k}</a>" for k in range(9)) + "</div>"
    page = f"<body><div><p>{LONG * 9}</p></div><main>{links}<div><h1>Title</h1></div><h2>Part</h2><div><p>{LONG * 2}</p><p>{LONG}</p></div></main></body>"
    assert main_text(page) == "\n".join(["Title", "Part", (LONG * 2).strip(), LONG.strip()])
    assert main_text(f"<main><h1>Title</h1><p>{LONG}</p></main>") == f"Title\n{LONG.strip()}"


@settings(max_examples=300, deadline=None)
@given(st.text("<>!-[]&;#x/= '\"apdivmain?CDATA\n\0", max_size=120) | st.lists(st.sampled_from(
    ["<p>", "</p>", "<main>", "</main>", "<article>", "<a href=x>", "</a>", "<!--", "-->", "--!>", "<![", "]]>", "<!DOCTYPE", "[", "<script>", "</script>", "text ", "&#x110000;", "<table>", "<td>", "<"])).map("".join))
def test_no_page_fails(page):
    assert isinstance(main_text(page), str)


def test_deep_and_long_pages():
    assert main_text("<div>" * 20_000 + "deep") == "deep"
    assert main_text(f"<article>{'<p>' + LONG + '</p>'}" + f"<p>{LONG}</p>" * 5000) == "\n".join([LONG.strip()] * 5001)


def test_frame_keeps_rows_and_replaces_the_column(frame):
    rows = [(1, "<p>a</p>", "old"), (1, "<p>a</p>", "old"), (None, None, None)]
    got = extract(frame(rows, "page_id long, html string, text string"))
    assert got.columns == ["page_id", "html", "text"]
    assert sorted(got.collect(), key=str) == sorted([(1, "<p>a</p>", "a"), (1, "<p>a</p>", "a"), (None, None, "")], key=str)
    assert extract(frame([], "html string")).collect() == []


def test_articles_of_the_tables(spark):
    """Beside a plain reading of the tables' own markup: the blocks of the article element."""
    for row in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect():
        article = row["html"][row["html"].index("<article>") : row["html"].index("</article>")]
        blocks = (" ".join(html.unescape(re.sub("<[^>]*>", " ", b)).split()) for b in re.split("</?(?:p|h1|article)>", article))
        assert main_text(row["html"]) == "\n".join(b for b in blocks if b)
