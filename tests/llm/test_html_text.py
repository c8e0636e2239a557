import html as html_lib
import re

import numpy as np
import pytest
from pyspark.sql import types as T

from asterloom.llm import html_text as h
from tests.llm.cases import CLASHING

PROSE = "The quick brown fox, as ever, jumps over the lazy dog. It does so again; and nobody minds!"
PAGE = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()), T.StructField("html", T.StringType())])

CASES = {
    "article": (f"<nav><a href=x>Home</a></nav><article><h1>Title</h1><p>{PROSE}<p>Two &amp; three&nbsp;four<br>five</article><footer>Foot.</footer>", f"Title {PROSE} Two & three four five"),
    "inline tags join": ("<article><p>un<b>believ</b>able <i>thing</i>.</p></article>", "unbelievable thing."),
    "unclosed inline": (f"<article><p><b>{PROSE}<br><p>Next one, here.</p></article>", f"{PROSE} Next one, here."),
    "scripts and comments": (f"<article><p>{PROSE}</p><script>var x = '<p>no</p>';</script><!-- <p>no</p> --><style>p{{}}</style></article>", PROSE),
    "reader comments": (f"<main><p>{PROSE}</p><section class='comments'><article><p>{PROSE} I agree.</p></article></section></main>", PROSE),
    "notices and adverts": (f"<div id=cookie-consent>{PROSE}</div><article><div class='ad'>{PROSE}</div><p>{PROSE}</p><aside>{PROSE}</aside></article>", PROSE),
    "forms": (f"<article><p>{PROSE}</p><form><label>Name, please.</label><input value=x><button>Go</button></form></article>", PROSE),
    "no article": (f"<div class=top><ul><li><a href=1>One</a><li><a href=2>Two</a></ul></div><div class=body><p>{PROSE}</p><p>{PROSE}</p></div><div>(c) Us</div>", f"{PROSE} {PROSE}"),
    "lists in the article": (f"<article><p>{PROSE}</p><ul><li>First, of all.<li>Second, of all.</ul><p>{PROSE}</p></article>", f"{PROSE} First, of all. Second, of all. {PROSE}"),
    "cut off": (f"<article><p>{PROSE}<p>Cut", f"{PROSE} Cut"),
    "no tags": ("just  text\n here.", "just text here."),
    "empty": ("", ""),
    "no text": ("<html><body><nav>a</nav></body></html>", ""),
    "void and self closing": ("<article><p>a<img src='>'>b</p><hr/><p>c<br/>d</p></article>", "a b c d"),
    "deep": ("<div>" * 400 + PROSE, PROSE),
}


@pytest.mark.parametrize("name", CASES)
def test_cases(name):
    page, expected = CASES[name]
    assert h.main_text(page) == expected


def test_query_shape(spark):
    rows = [(1, "u", CASES["article"][0]), (2, None, None), (None, "u", ""), (1, "u", CASES["article"][0])]
    pages = spark.createDataFrame(rows, PAGE).selectExpr("*", "'x' AS text", "'y' AS n_chars", f"'z' AS {CLASHING[0]}")
    out = h.extract_text(pages)
    assert out.columns == ["page_id", "url", "text", "n_chars", "chunk", "text", "n_chars"]
    found = out.toDF("page_id", "url", "a", "b", "c", "text", "n").collect()
    assert sorted((r.text, r.n) for r in found) == sorted([(CASES["article"][1], len(CASES["article"][1]))] * 2 + [("", 0)] * 2)
    assert h.extract_text(spark.createDataFrame([], PAGE)).collect() == []


def test_whole_articles_of_the_test_pages(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    html = {r.page_id: r.html for r in pages.collect()}
    for r in h.extract_text(pages).collect():
        article = re.search("<article>(.*?)</article>", html[r.page_id], re.S)[1]
        parts = [html_lib.unescape(re.sub("</?b>", "", x)).split() for x in re.split("</?(?:p|h1|br)>", article)]
        assert r.text == " ".join(" ".join(x) for x in parts if x)


def test_smoothing_keeps_constants():
    assert np.allclose(h.smoothed(np.full(9, 3.0)), 3) and np.allclose(h.smoothed(np.array([2.0])), 2)


@pytest.mark.parametrize(
    "page",
    [
        f"<div class='layout has-sidebar'><article><p>{PROSE}</p></article></div>",
        f"<div class='content with-comments'><article><p>{PROSE}</p></article></div>",
        f"<div class='page no-header'><article><p>{PROSE}</p></article></div>",
        f"<div class='widget'><article><p>{PROSE}</p></article></div><div>Us</div>",
        f"<main><div class='sidebar'><article><p>{PROSE}</p></article></div></main>",
        f"<div id=search><p>{PROSE}</p></div>",
        f"<form id=aspnet><article><p>{PROSE}</p></article></form>",
        f"<article><p>{PROSE}</p></article><div class='comment-list'><article><p>{PROSE} {PROSE}</p></article></div>",
        f"<article><p>{PROSE}</p><div class=related_posts><p>{PROSE}</p></div></article>",
        f"<article><p>{PROSE}</p><p><span class=ad>No.</span></p></article>",
    ],
)
def test_wrappers_are_no_boilerplate(page):
    assert h.main_text(page) == PROSE


def test_parts_of_an_article_are_kept():
    for title in ("<div class='article-header'><h1>Title</h1></div>", "<header><h1>Title</h1></header>", "<div class=banner><h1>Title</h1></div>"):
        assert h.main_text(f"<article>{title}<p>{PROSE}</p></article>") == f"Title {PROSE}"
    assert h.main_text(f"<article><p>{PROSE}</p><section id='related-work'><h2 id=search>Search</h2><p>{PROSE}</p></section></article>") == f"{PROSE} Search {PROSE}"


LONG = f"{PROSE} {PROSE} {PROSE} {PROSE}"
ITEMS = " ".join(f"<li>item number {i:02}" for i in range(20))
LINKS = " ".join(f"<li><a href={i}>Reference {i:02}</a>" for i in range(20))
CELLS = "".join(f"<tr><td>cell{i}a<td>cell{i}b<td>cell{i}c" for i in range(8))
PARTS = {
    "long list": f"<p>{LONG}</p><ul>{ITEMS}</ul><p>{LONG}</p>",
    "list at the end": f"<p>{LONG}</p><p>{LONG}</p><ul>{ITEMS}</ul>",
    "table": f"<p>{LONG}</p><table>{CELLS}</table><p>{LONG}</p>",
    "table in a wrapper": f"<p>{LONG}</p><div class=scrolls><table>{CELLS}</table></div><p>{LONG}</p>",
    "headings": f"<h1>Title</h1><p>{LONG}</p><h2>Part one</h2><p>{LONG}</p><h2>Part two</h2><h3>Start</h3><p>{LONG}</p>",
    "links only": f"<p>{LONG}</p><ul>{LINKS}</ul><p>{LONG}</p>",
    "links at the end": f"<p>{LONG}</p><p>{LONG}</p><h2>References</h2><ol>{LINKS}</ol>",
}


@pytest.mark.parametrize("wrapper", ["<article>%s</article>", "<main><div>%s</div></main>", "<div class=text>%s</div>", "%s"])
@pytest.mark.parametrize("name", PARTS)
def test_nothing_of_the_text_is_dropped(name, wrapper):
    page = "<div class=top><ul><li><a href=1>One</a><li><a href=2>Two</a></ul></div>" + wrapper % PARTS[name] + "<div>(c) Us</div>"
    assert h.main_text(page) == " ".join(re.sub("<[^>]*>", " ", PARTS[name]).split())


def test_title_apart_from_the_text():
    assert h.main_text(f"<div><h1>Title</h1></div><div><p>{LONG}</p><p>{LONG}</p></div>") == f"Title {LONG} {LONG}"


def test_teaser_card_is_not_the_page():
    card = "<article><h3>Teaser</h3><p>Read on, here.</p></article>"
    assert LONG + " " + LONG in h.main_text(f"<div class=text><p>{LONG}</p><p>{LONG}</p></div><div class=cards>{card}</div>")
    assert h.main_text(f"<article><p>{LONG}</p></article><div><p>{PROSE}</p></div>") == LONG


@pytest.mark.parametrize("start", ["<body>", "<div>", "<p>", "<b>", ""])
def test_head_without_an_end(start):
    page = f"<html><head><meta charset=utf-8><title>No</title><script>no()</script><noscript><img></noscript>\n{start}{PROSE}"
    assert h.main_text(page) == PROSE


def test_deleted_text_is_kept():
    assert h.main_text(f"<article><p>{PROSE} <del>Gone</del>by.</p><del><p>{PROSE}</p></del></article>") == f"{PROSE} Goneby. {PROSE}"


@pytest.mark.parametrize("page, expected", [
    ("<div>" * 100_000, 0),
    ("<font>" * 100_000 + "x", 1),
    ("<div>x" * 100_000, 199_999),
    ("<a>x" * 100_000, 100_000),
    ("<li><div>" * 50_000 + "x", 1),
    ("<div>" * 100_000 + "<li>x</li>" * 50_000, 99_999),
    ("<font>" * 100_000 + "<p>x</p>" * 50_000, 99_999),
    ("<table>" * 50_000 + "<td>x" * 50_000, 99_999),
    ("<div class=ad>x " * 50_000, 49_999),
], ids=["blocks", "inline", "text", "links", "items", "items below", "paragraphs below", "cells", "marked"])
def test_time_and_memory_follow_the_length(page, expected):
    """100,000 open elements: seconds and 200 MB, where time or memory by depth would take minutes or GB."""
    import time
    import tracemalloc

    begun = time.process_time()
    assert abs(len(h.main_text(page)) - expected) <= 50_000 * (expected == 49_999)
    assert time.process_time() - begun < 30
    tracemalloc.start()
    h.main_text(page)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 200e6


@pytest.mark.parametrize("piece", ["<!--", "<!-- x>", "<a ", "</", "<?", "<a b='", '<a b="x', "<![CDATA["])
@pytest.mark.parametrize("end", ["", ">"])
def test_markup_that_never_ends(piece, end):
    """What is begun and never ended is no text, and is not searched for from every beginning."""
    import time

    begun = time.process_time()
    h.main_text(f"<p>{PROSE}</p>" + piece * 20_000 + end)
    assert time.process_time() - begun < 10
    assert h.main_text(f"<p>{PROSE}</p><p>a < b</p>" + piece) == f"{PROSE} a < b"
