from __future__ import annotations

import os
import re
from html import unescape

import pytest

from framegate.llm import html

FOLDER = "/root/testdata/sf0.01"


def test_articles():
    text = lambda page: html.main_text(page, set())
    assert text("<nav>menu</nav><article><h1>T</h1><p>a <b>b</b>c &amp; d<br>e<p>f</article><footer>x</footer>") == "T a bc & d e f"
    assert text("<body><div class='ad box'>buy</div><div id=main>one\n\ttwo</div><aside>x</aside><form>y<input></form>") == "one two"
    assert text("<script>var t='</p><article>no';</script><main>yes<!-- no --></main>out") == "yes"
    assert text("<article>a<div class=comments>b</div><style>c</style></article> z <article>d</article>") == "a d"
    assert text("") == "" and text("no markup &lt;x&gt;  y") == "no markup <x> y"
    assert text("<article><p title='a > b'>x</p><p title=\"open>y</p>") == "x y"
    assert text("<ul><li>a<li>b</ul><table><tr><td>c<td>d</table>") == "a b c d"
    assert text("<article>" + "<div>" * 3000 + "deep") == "deep"


def test_boxes_that_sound_like_furniture():
    """Names that speak of what stands beside a box, teasers beside the text, and boxes that hold all a page says."""
    text = lambda page: html.main_text(page, set())
    long = "<p>The text of the page.</p><p>And more of it.</p>"
    says = "The text of the page. And more of it."
    assert text(f"<div class='content with-sidebar'>{long}</div><div class=sidebar>x</div>") == says
    assert text(f"<div class='no-comments'>{long}</div>") == says
    assert text(f"<h1>T</h1><div class='social-history'>{long}</div><div class=ad>buy</div><div class=cookies><p>ok?</p></div><footer><p>f</p></footer>") == "T " + says
    assert text(f"<div class=post>{long}</div><article class=card>Teaser one</article><article class=card><h3>Two</h3></article>") == says
    assert text(f"<main><div>{long}</div><article>Teaser</article></main><div>{long}{long}</div>") == says
    # what is still furniture
    assert text(f"<article><h1>T</h1><p>s</p></article><div class=box>{long}</div>") == "T s"
    assert text(f"<article></article><div class=ad>{long}</div>") == "" and text("<nav>a</nav><div class=ad>buy</div>") == ""
    assert text(f"<article><p>a</p><div class='reader-comments'>{long}</div></article>") == "a"
    assert text(f"<div class=post>short</div><div class=comments>{long}</div>") == "short"
    assert text("<article>" + "<p>x" * 40_000 + "</article>") == " ".join("x" * 40_000)


def test_styles_of_a_site(spark):
    """A block that every page of a host has goes, wherever it stands; paragraphs stay, also those that some pages share."""
    page = lambda k: (
        f"<div class=top>Site {k % 2}</div><article><div class=claim>All rights</div><p>own text {k}</p><p>shared</p></article>"
    )
    rows = [(k, "https://Host.example/a/%d" % k, page(k)) for k in range(40)] + [(99, "https://small.example/", page(7)), (100, None, page(8)), (101, "x", None), (102, "x", "")]
    pages = spark.createDataFrame([(*r, "low", 1) for r in rows], "page_id long, url string, html string, low string, host int")
    got = {r.page_id: r.text for r in html.extract(pages).collect()}
    assert got == {k: f"own text {k} shared" for k in range(40)} | {99: "All rights own text 7 shared", 100: "All rights own text 8 shared", 101: "", 102: ""}
    tree = html.style_tree(spark.createDataFrame([("h", page(k)) for k in range(40)], "host string, html string"))
    least = sorted(r.importance for r in tree.filter("pages = 40").collect())
    assert least[0] < 0.2 and least[-1] > 0.5
    assert html.extract(pages.limit(0)).collect() == []


def test_hosts(spark):
    rows = [("HTTP://u:p@A.b:80/x", "a.b"), ("https://c.d?x", "c.d"), ("/path", ""), (None, "")]
    df = spark.createDataFrame(rows, "url string, want string")
    assert df.filter(html.host(df.url) != df.want).count() == 0


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="driver tables are not there")
def test_driver_pages(spark):
    pages = spark.read.parquet(f"{FOLDER}/pages.parquet")
    got = {r.page_id: r.text for r in html.extract(pages).collect()}
    for r in pages.collect():
        inner = re.search("<article>(.*?)</article>", r.html, re.S)[1]
        inner = re.sub("<[^>]*>", " ", re.sub("</?b>", "", inner))
        assert got[r.page_id] == " ".join(unescape(inner).split())
