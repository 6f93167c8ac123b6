from __future__ import annotations

import html
import re

import pytest

from farekit.llm import extract, queries
from farekit.llm.extract import main_text

PAGE = """<!doctype html><html><head><title>T</title><style>p{}</style></head><body class="has-menu">
<header><h1>Site</h1><p>We sell, and sell, and sell, many things, every day.</p></header>
<nav><ul><li><a href="/">Home</a><li><a href="/b">B</a></ul></nav>
<div class="cookie-notice"><p>We use cookies, and more cookies, to serve you.</p></div>
<div id=main><div class=article-body><h2>The headline</h2>
<p>First &amp; foremost, a long   paragraph,
with commas, and <a href="x">one link</a>, and more.<p>A second<br>paragraph&nbsp;follows, without an end tag.
<ul><li>item one<li>item two</ul><p>Short.</p>
<form><p>Give us, please, your mail.</p></form><aside><p>Related, or not, who knows.</p></aside>
<script>document.write("<p>no, no, no</p>")</script></div>
<div class="comments"><p>Nice, very nice, so nice, I say, really nice indeed.</p></div></div>
<div class="sidebar"><p>Buy this, and that, and those, right now.</p></div>
<footer><p>Copyright, all rights, reserved, forever.</p></footer></body></html>"""


def test_article_without_its_surroundings():
    assert main_text(PAGE).split("\n") == [
        "The headline", "First & foremost, a long paragraph, with commas, and one link, and more.",
        "A second paragraph follows, without an end tag.", "item one", "item two", "Short.",
    ]


@pytest.mark.parametrize(
    ("source", "text"),
    [
        (None, ""), ("", ""), ("   ", ""), ("<", "<"), ("just text", "just text"), ("<p>a<b>b</b>c", "abc"),
        ("<p>open <a href='>'>x</a>", "open x"), ("<!-- <p>no</p> -->", ""), ("<script>x", ""), ("<p>1 &lt; 2 &#8364;</p>", "1 < 2 €"),
        ("</div></p></x>", ""), ("<nav><p>only a menu, here</p></nav>", ""),
    ],
)
def test_odd_pages(source, text):
    assert main_text(source) == text


def test_deep_and_long_pages_end():
    assert main_text("<div>x, y " * 20_000).count("x, y") == 20_000
    assert main_text("<p>x, y</b></q></li>" * 30_000).count("\n") == 29_999


def test_every_page_gives_its_article(spark, data_dir):
    rows = queries.QUERIES["op2_extract_text"](spark, data_dir).collect()
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{data_dir}/pages.parquet").collect()}
    assert len(rows) == len(pages)
    for r in rows:
        inside = re.search(r"<article>(.*?)(?:</article>|$)", pages[r.page_id], re.S)[1].replace("<br>", " ")
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>", inside)]
        assert r.text == "\n".join(b for b in blocks if b) and r.n_chars == len(r.text)


def test_odd_rows(spark):
    rows = [(1, None, None), (None, "u", "<p>x"), (2, "u", PAGE), (2, "u", PAGE)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'mine' AS text", "1 AS n_chars")
    found = extract.with_text(pages).collect()
    assert sorted(r.n_chars for r in found)[:2] == [0, 1] and len(found) == 4
    assert extract.with_text(pages.limit(0)).count() == 0


LINE = "A paragraph, with commas, of some length, so that it has points, and then some more of them, to be sure."


@pytest.mark.parametrize(
    ("source", "lines"),
    [
        # The first section alone outweighs the article; heading and second section belong to it all the same.
        (
            f"<article><h1>Head</h1><section>{f'<p>{LINE}</p>' * 12}</section><section><p>{LINE}</p></section></article>",
            ["Head", *[LINE] * 13],
        ),
        (f"<div><h1>Head</h1><p>Lede.</p><div>{f'<p>{LINE}</p>' * 9}</div></div>", ["Head", "Lede.", *[LINE] * 9]),
        (f"<div class='post'><div>By me</div><div>{f'<p>{LINE}</p>' * 9}</div><div>End.</div></div>", ["By me", *[LINE] * 9, "End."]),
        (f"<article><p>{LINE}</p><ul><li><a href=x>Source</a></ul><div><a href=y>More</a></div></article>", [LINE, "Source", "More"]),
        # A second article like the first stays, and a title above them.
        (f"<main><h1>Head</h1>{f'<article><div><p>{LINE}</p></div><p>End.</article>' * 2}</main>", ["Head", *[LINE, "End."] * 2]),
        # What stands outside the article, or is foreign inside it, stays out.
        (
            f"<main><div>Outside</div><article><h1>H</h1><div>{f'<p>{LINE}</p>' * 3}</div><nav>Menu</nav></article><p>Tail</main>",
            ["H", *[LINE] * 3],
        ),
    ],
)
def test_the_whole_article_is_kept(source, lines):
    assert main_text(f"<html><body><nav><a href=z>Home</a></nav>{source}<footer><p>Foot</p></footer></body></html>").split("\n") == lines


BODY = f"<h1>Head</h1>{f'<p>{LINE}</p>' * 4}"
ALL = ["Head", *[LINE] * 4]


@pytest.mark.parametrize(
    "source",
    [
        f'<div class="content has-sidebar">{BODY}</div>',
        f'<div class="elementor-widget elementor-widget-text"><div class="elementor-widget-container">{BODY}</div></div>',
        f'<div class="social-policy">{BODY}</div>',
        f'<form id="aspnetForm"><div>{BODY}</div></form>',
        f'<form><nav><a href=a>Menu</a></nav><main>{BODY}</main></form>',
        f'<article><header class="entry-header"><h1>Head</h1></header>{BODY[13:]}</article>',
        f'<div class="post"><header class="post-header"><h1>Head</h1></header><div>{BODY[13:]}</div></div>',
        f'<div class="widget"><div>{BODY}</div></div>',
        f'<div class="page no-sidebar with-comments"><div class="ad-slot"><p>{LINE}</p></div>{BODY}</div>',
        f'<article class="related">{BODY}</article>',
        f'<div class="modal">{BODY}</div><div class="cookie-notice"><p>We use cookies, many of them, for you.</p></div>',
        f'<div id="sidebar"><article>{BODY}</article></div>',
        f'<article>{BODY}<section class="comments"><article><p>{LINE}</p></article></section></article>',
        f'<main>{BODY}<div class="share-buttons"><p>Share, please, this.</p></div><div class="related-posts"><p>{LINE}</p></div></main>',
        f'<div class="site-header"><p>Welcome, all of you, to us.</p></div><div>{BODY}</div><div class="site-footer"><p>{LINE}</p></div>',
        f'<div>{BODY}</div><div class="comment-list"><div class="comment"><p>{LINE}</p></div></div><div id="disqus_thread"><p>{LINE}</p></div>',
        f'<div class="main-content">{BODY}<aside><p>{LINE}</p></aside><form class="newsletter-form"><p>Your mail, please.</p></form></div>',
    ],
)
def test_no_article_is_lost_by_a_name_or_a_form(source):
    page = f"<html><body class='has-menu'><nav><a href=z>Home</a></nav>{source}<footer><p>Foot, foot, foot.</p></footer></body></html>"
    assert main_text(page).split("\n") == ALL


@pytest.mark.parametrize(
    "source",
    [
        f'<div class="ad"><p>{LINE}</p></div>', f'<div class="cookie-banner"><p>{LINE}</p></div>', f"<div hidden><p>{LINE}</p></div>",
        f'<section id="comments"><p>{LINE}</p></section>', f'<div role="navigation">{LINE}</div>', f"<footer>{LINE}</footer>",
    ],
)
def test_a_page_without_an_article_has_no_text(source):
    assert main_text(f"<html><body>{source}</body></html>") == ""
