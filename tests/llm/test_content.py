"""Main text of pages: given pages against a plain reading of their markup, and written ones with known articles."""

from __future__ import annotations

import html
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfcast.llm.content import content_lines, extract_main_text, main_text, marked, op12_html_extraction, smoothed


def plain_article(page):
    """Text between the article tags of the test tables' pages, read with patterns."""
    inner = re.search(r"<article>(.*)</article>", page, re.S).group(1)
    inner = re.sub(r"<[^>]*>", "", re.sub(r"<br>", " ", re.sub(r"</?(p|h1)>", "\0", inner)))
    return "\n".join(t for t in (" ".join(html.unescape(x).split()) for x in inner.split("\0")) if t)


def test_every_page_of_the_table(spark, sf_dir):
    want = {
        r.page_id: (r.url, plain_article(r.html)) for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()
    }
    got = op12_html_extraction(spark, sf_dir).collect()
    assert {r.page_id: (r.url, r.text) for r in got} == want and len(got) == len(want)
    assert all(r.n_chars == len(r.text) for r in got)


LONG = "A sentence of the article that goes on for quite some words, so that it counts as running text. " * 3


def test_page_without_semantic_elements():
    page = f"""<html><head><title>T</title><body>
      <div class="topnav"><a href=/>Home</a> <a href=/a>About</a></div>
      <div id="wrap"><div class="navbar"><ul><li><a href=1>One</a><li><a href=2>Two</a></ul></div>
      <div class="content no-sidebar"><h1>Title &eacute;&nbsp;&#8212; x</h1><p>{LONG}<p>Short.
      <div class="ad-slot">Buy now</div><p>One<br>two <b>bold</b>text</p><script>var a = "<p>no</p>";</script>
      <ul><li>first point<li>second point</ul><!-- gone --><p>{LONG}</div>
      <div class="left"><ul><li><a href=3>Three</a></li><li><a href=4>Four</a></li></ul></div>
      <div id="comments"><p>{LONG}</p></div></div><div class="page-footer">&copy; 2020</div>"""
    long = " ".join(LONG.split())
    assert main_text(page).split("\n") == [
        "Title é — x", long, "Short.", "One two boldtext", "first point", "second point", long,
    ]


def test_parts_inside_an_article():
    page = f"""<body><header><h2>Site</h2></header><main><article><header class=entry-header><h1>Head</h1>
      <p>By someone</p></header><p hidden>no</p><p class=ad>no<p>{LONG}</p><form><p>no</p></form>
      <aside>no</aside><section class="reader-comments"><article><p>{LONG}</p></article></section>
      <table><tr><td>a<td>b<tr><td>c</table><footer>no</footer><p>end</article></main><footer>no</footer>"""
    assert main_text(page).split("\n") == ["Head", " ".join(LONG.split()), "a", "b", "c", "end"]


@pytest.mark.parametrize(
    ("page", "want"),
    [
        (None, ""), ("", ""), ("  ", ""), ("no markup &amp; text", "no markup & text"), ("<p>a<p>b", "a\nb"),
        ("<nav>a</nav>", ""), ("<p>a &am", "a &am"), ("<p>x<", "x<"), ("<form><p>whole page</form>", "whole page"),
        ("</div></p>x</article>", "x"), ("<head><title>t</title><p>x", "x"), ("<script src=a /><p>x", "x"),
        ("<p>a  b\n\tc</p>", "a b c"), ("<pre>a\n  b</pre>c", "a b\nc"),
    ],
)
def test_odd_pages(page, want):
    assert main_text(page) == want


def test_marks():
    assert marked("comment-list") and marked("x pageFooter") and marked("adBox") and marked("side sidebar-1")
    assert not marked("no-sidebar") and not marked("main-sidebar-wide") and marked("text header-image")
    assert not marked("article-body") and not marked("shadow") and not marked("readme") and not marked("")


def test_smoothing_against_a_plain_sum():
    ratios = np.array([1.0, 50.0, 2.0, 0.0, 80.0, 90.0, 3.0])
    for i, got in enumerate(smoothed(ratios)):
        near = [(j, np.exp(-((j - i) ** 2) / 2)) for j in range(max(0, i - 2), min(len(ratios), i + 3))]
        assert np.isclose(got, sum(ratios[j] * w for j, w in near) / sum(w for _, w in near))
    assert content_lines(np.array([5.0])).tolist() == [True] and content_lines(ratios)[4:6].all()
    assert not len(content_lines(np.zeros(0)))


def test_very_long_and_deep_pages_end_in_time():
    words = "word " * 300_000
    assert main_text(f"<article><p>{words}</p></article>") == words.strip()
    assert main_text("<div>" * 20_000 + "x" + "</div>" * 20_000) == "x"
    assert main_text("<p>a" * 50_000).count("\n") == 49_999
    assert main_text("<ul><li>" * 5_000 + "x").endswith("x")
    assert main_text("</b>" * 50_000 + "x") == "x"


def test_rows_nulls_and_clashing_columns(spark):
    rows = [(1, "u", "<p>a</p>", 5), (1, "u", "<p>a</p>", 5), (None, None, "<p>b</p>", 5), (2, "v", None, 5), (3, "w", "", 5)]
    table = spark.createDataFrame(rows, "page_id long, url string, html string, n_chars int").withColumn("text", F.lit("x"))
    got = extract_main_text(table)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == sorted(
        [(1, "u", "a", 1), (1, "u", "a", 1), (None, None, "b", 1), (2, "v", "", 0), (3, "w", "", 0)], key=str
    )
    assert extract_main_text(table.limit(0)).collect() == []
