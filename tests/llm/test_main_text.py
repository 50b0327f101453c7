"""Main texts by consensus against what their pages were made of, and against a plain extraction of the given tables."""

from __future__ import annotations

import html
import re
import time

import pytest
from pyspark.sql import functions as F

from cardmill.llm import main_text
from cardmill.llm.store import written

from .conftest import words


def sentence(seed: int, n: int = 25) -> str:
    return " ".join(words(seed, n)).capitalize() + "."


def own(text: str) -> str:
    return main_text.extracted(text, [])


def plain(page: str) -> str:
    """The article of a page of the given tables by patterns alone."""
    inner = re.sub(r"<[^>]+>", "", re.sub(r"</?(p|h1)>", "\x01", re.search(r"(?s)<article>(.*?)</article>", page)[1]).replace("<br>", " "))
    return "\n".join(x for x in (" ".join(y.split()) for y in html.unescape(inner).split("\x01")) if x)


def run(spark, pages, c=main_text.Consensus()):
    winning = written(main_text.winning_paths(written(main_text.votes(pages), "votes"), c), "winning")
    return winning, main_text.main_texts(pages, winning, c)


def test_given_pages(spark, small):
    pages = spark.read.parquet(f"{small}/pages.parquet")
    winning, out = run(spark, pages)
    want = sorted((r.page_id, r.url, plain(r.html), len(plain(r.html))) for r in pages.collect())
    assert sorted(map(tuple, out.collect())) == want
    assert {tuple(r.paths) for r in winning.collect()} == {("article",)}


A, B, C = sentence(1), sentence(2), sentence(3)
NOISE = sentence(9)
LAYOUTS = {
    "article": f"<body><header><h1>Site</h1></header><nav><a href=/>Home</a></nav><article><h1>Title</h1><p>{A}</p><p>{B}</p></article><footer>{NOISE}</footer>",
    "divs": f'<div class="site-header">Site {NOISE}</div><div id="nav"><ul><li><a href=1>One</a></ul></div><div class="col"><h1>Title</h1><p>{A}<p>{B}</div><div class="sidebar"><p>{NOISE}</div><div class="footer">x</div>',
    "wrapped": f'<div class="page has-sidebar"><div class="main-col"><div class="body"><h1>Title</h1><p>{A}</p><div class="share-buttons">Share this</div><p>{B}</p></div></div><aside>{NOISE}</aside></div>',
    "comments": f'<main><article><h1>Title</h1><p>{A}</p><p>{B}</p></article><section id="comments"><h3>Comments</h3><article><p>{NOISE}</p></article></section></main>',
    "inner header": f'<article class=post><header><nav>menu</nav><p>By someone</p><h1>Title</h1></header><p>{A}</p><footer>tags</footer><p>{B}</p></article>',
    "form around all": f'<form action="/"><div class="top-nav"><a href=1>x</a></div><article><h1>Title</h1><p>{A}</p><p>{B}</p></article></form>',
    "form inside": f"<article><h1>Title</h1><p>{A}</p><form><p>{NOISE}</p><input></form><p>{B}</p></article>",
    "unclassed menu": f"<div><ul><li><a href=1>{NOISE}</a><li><a href=2>{NOISE}</a></ul></div><div><h1>Title</h1><p>{A}</p><p>{B}</p></div>",
    "table layout": f'<table><tr><td class="menu"><a href=1>x</a><td><h1>Title</h1><p>{A}<p>{B}</table>',
    "hidden": f'<article><h1>Title</h1><p>{A}</p><p style="display: none">{NOISE}</p><p hidden>{NOISE}</p><div aria-hidden="true">{NOISE}</div><p>{B}</p></article>',
    "cookie notice": f'<div role="dialog"><p>{NOISE}</p></div><div class="cookie-notice"><p>{NOISE}</p></div><article><h1>Title</h1><p>{A}</p><div class="notice">{NOISE}</div><p>{B}</p></article>',
    "adverts inline": f'<article><h1>Title</h1><p>{A}</p><div class="ad-slot">{NOISE}</div><p>{B}<span class="sponsored"> {NOISE}</span></p><script>x("</p>")</script><style>p{{}}</style></article>',
    "odd marks": f"<!-- <article> --><!DOCTYPE html><?xml x?><ARTICLE title=it's data-x='<p>'><H1 class=\"a>b\">Title</H1\n><P>{A}</p></b></i><p><b><i>{B}<br></P></ARTICLE>",
}


@pytest.mark.parametrize("name", LAYOUTS)
def test_layouts(name):
    assert own(LAYOUTS[name]) == f"Title\n{A}\n{B}"


def test_white_space_and_references():
    assert own("<article><p> a&nbsp;\n\t<b>b</b>c &amp;amp; &#233;&eacute; &lt;p&gt; &copy &unknown; d<br>e</p>text<ul><li>x<li>y</ul></article>") == "a bc &amp; éé <p> © &unknown; d e\ntext\nx\ny"
    assert own("") == own("<p>") == own("<script>x") == own("<nav>x</nav>") == ""
    assert own("no markup at all < 3 > 2") == "no markup at all < 3 > 2"
    assert own("<p>short</p>") == "short"
    assert own(f"<article><p>{A}<!-- open {B}") == A


def test_consensus_decides(spark, small):
    """A page whose own choice is its long digression follows its host; a page of another layout keeps its text."""
    page = lambda a, b: f'<body><div class="text t{len(a)}"><p>{a}</p></div><div class="extra"><p>{b}</p></div>'
    rows = [(i, f"https://Host.example:80/{i}", page(sentence(i, 60), sentence(100 + i, 10))) for i in range(8)]
    rows.append((8, "https://user@host.example/8?x", page(sentence(8, 40), sentence(108, 50))))
    rows.append((9, "http://host.example", f"<section><p>{A}</p></section>"))
    rows.append((10, "https://other.example/", page(sentence(10, 5), sentence(110, 60))))
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    winning, out = run(spark, pages, main_text.Consensus(share=0.2))
    assert {r.host: tuple(r.paths) for r in winning.collect()} == {"host.example": ("div.t#.text",), "other.example": ("div.extra",)}
    text = {r.page_id: r.text for r in out.collect()}
    assert [text[i] for i in range(8)] == [sentence(i, 60) for i in range(8)]
    assert text[8] == sentence(8, 40) and text[9] == A and text[10] == sentence(110, 60)


def test_edges(spark, monkeypatch):
    rows = [(None, None, None, "x"), (1, "not a url", "", "y"), (1, "not a url", "", "y"), (2, None, LAYOUTS["divs"], "z"), (3, "http://h/", "x" * 3_000_000, None), (4, "http://h/", LAYOUTS["article"], None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, host string").withColumns({"path": F.lit(1), "winning": F.lit("w"), "hash": F.lit(None), "pages": F.lit(0)})
    want = sorted([(-1, None, ""), (1, "not a url", ""), (1, "not a url", ""), (2, None, f"Title\n{A}\n{B}"), (3, "http://h/", "x" * 3_000_000), (4, "http://h/", f"Title\n{A}\n{B}")], key=repr)
    for hosts in (main_text.HOSTS, 0):  # all hosts by broadcast, and by lookup
        monkeypatch.setattr(main_text, "HOSTS", hosts)
        _, out = run(spark, pages)
        got = [(-1 if r.page_id is None else r.page_id, r.url, r.text) for r in out.collect()]
        assert sorted(got, key=repr) == want
    assert all(r.n_chars == len(r.text) for r in out.collect())
    assert run(spark, pages.limit(0))[1].collect() == []


def test_hot_host_is_counted_before_it_moves(spark):
    rows = spark.range(2000).select(F.col("id").alias("page_id"), F.lit("http://hot/").alias("url"), F.lit(LAYOUTS["article"]).alias("html"))
    voted = written(main_text.votes(rows), "votes")
    assert [(r.host, r.pages) for r in voted.collect()] == [("hot", 2000)]
    plan = main_text.winning_paths(voted)._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan


@pytest.mark.parametrize("odd", ['<a "', "<b>", "<div>", "<p><b>", "<!--", "</p>", "<a href=x>", "<h1>", '<div class="ad">', "<td>", "<li>", "< ", "<a\n", "<ul><li><p>x", "&amp", "<form><h1>", "<script>"])
def test_odd_pages_take_linear_time(odd):
    began = time.perf_counter()
    main_text.vote(odd * 100_000)
    own(f"<article><p>{A}</p></article>" + odd * 100_000)
    assert time.perf_counter() - began < 20
