import itertools
import random
import time

import numpy as np
import pyarrow.parquet as pq
import pytest
from conftest import SF

from tidemark.llm import html_mincut as op

PAGE = """<!DOCTYPE html><html><head><title>no</title><style>p{}</style></head><body class="has-sidebar">
<header class="site-header"><a href="/">Site</a><nav><ul><li>Home<li>News</ul></nav></header>
<div class="cookie-notice">We use cookies, as most pages do, and hope you agree. <button>OK</button></div>
<div id="wrap"><div class="sidebar"><h3>Related</h3><ul><li><a href=x>One more story</a><li>Two</ul></div>
<main><article class="post"><h1>Title &amp; more</h1><p>First   paragraph<br>with break &eacute;&#8364;.
<p>Second <b>one</b>, un<i>broken</i>.<ul><li>item a<li>item b</ul><aside>Pull quote of some length.</aside>
<form>Email <input><label>sub</label></form><div class="ad-slot">Buy this now, it is cheap and good!</div>
<script>var a = "</p><p>";</script><p>Third.<div hidden>secret</div></article></main>
<section class="comments"><h2>Comments</h2><article class="comment"><p>Nice post, I really liked it a lot,
thanks for sharing all this.</p></article></section></div><footer>&copy; 2020 Someone, somewhere.</footer></body></html>"""
TEXT = "Title & more\nFirst paragraph with break é€.\nSecond one, unbroken.\nitem a\nitem b\nThird."


def test_page():
    for weights in (op.PRIOR, op.fit([PAGE] * 3)):
        assert op.main_text(PAGE, weights) == TEXT


def test_page_without_an_article():
    long = "A paragraph of many words, with commas, that goes on for a while and then comes to its end at last."
    page = f"<body><div><a href=a>Home</a> <a href=b>About</a></div><div><div>{long}</div><div>{long}</div></div><div><a href=c>Terms</a></div>"
    assert op.main_text(page, op.PRIOR) == f"{long}\n{long}"


PARAGRAPH = "Words that tell of something, one after another, and go on until the sentence comes to its end, number {}."


@pytest.mark.parametrize(
    "tag",
    ['div class="legal"', 'div class="survey"', 'div class="feedback"', 'div class="popular"',
     'div class="content legal"', 'div class="post social"', "form", 'div id="sidebar-layout"'],
)
def test_an_article_in_a_misleading_container(tag):
    """Names and forms are outweighed where they hold all that reads like an article, and only there."""
    paragraphs = [PARAGRAPH.format(i) for i in range(6)]
    inside = "".join(f"<p>{p}</p>" for p in paragraphs)
    nav, foot = "<nav><ul><li><a href=a>Home</a><li><a href=b>News</a></ul></nav>", "<footer>Imprint, all rights reserved.</footer>"
    box = f"<{tag}>{inside}</{tag.split()[0]}>"
    pages = pq.read_table(f"{SF}/pages.parquet", columns=["html"]).column(0).to_pylist()
    for weights in (op.PRIOR, op.fit(pages)):
        assert op.main_text(f"<body>{nav}{box}{foot}</body>", weights) == "\n".join(paragraphs)
        other = "".join(f"<p>{PARAGRAPH.format(i)}</p>" for i in range(10, 30))
        article = "\n".join(PARAGRAPH.format(i) for i in range(10, 30))
        small = f"<{tag}><p>{PARAGRAPH.format(0)}</p></{tag.split()[0]}>"
        if "content" not in tag and "post" not in tag:
            assert op.main_text(f"<body>{nav}<article>{other}{small}</article>{foot}</body>", weights) == article
        assert op.main_text(f"<body>{nav}<article>{other}</article>{small}{foot}</body>", weights) == article


def test_unmatched_tags_take_linear_time():
    for odd in ("</b>" * 200_000, "<i>" * 50_000 + "<p>x" * 2000, "<li>" * 50_000, "</p><span>" * 50_000):
        start = time.process_time()
        op.blocks("<article>text" + odd)
        assert time.process_time() - start < 20


def test_odd_pages():
    for page in (None, "", "<", "<!--", "<p", "</p></div>", "<script>x", "<nav>a</nav>", "&amp;&bogus;", "<a b='", "\x00"):
        assert isinstance(op.main_text(page, op.PRIOR), str)
    assert op.main_text("<article>a<p>b &lt;c&gt; &nbsp; d</article>", op.PRIOR) == "a\nb <c> d"
    deep = "<div>" * 3000 + "<article>" + "<p>Some text. " * 3000
    assert op.main_text(deep, op.PRIOR).count("\n") == 2999


def cost(score, links, label):
    out = sum(abs(s) for s, y in zip(score, label) if s != 0 and (s > 0) != bool(y))
    return out + sum(c for i, j, c in links if label[i] != label[j])


def test_cut_is_the_least_of_all_labellings():
    rnd = random.Random(3)
    for _ in range(500):
        n = rnd.randrange(1, 9)
        score = np.array([rnd.choice([-3, -1, -0.5, 0, 0.5, 1, 2.5]) for _ in range(n)])
        links = [(rnd.randrange(n), rnd.randrange(n), rnd.choice([0.25, 0.5, 1, 2])) for _ in range(rnd.randrange(12))]
        links = [e for e in links if e[0] != e[1]]
        best = min(cost(score, links, x) for x in itertools.product((0, 1), repeat=n))
        assert abs(cost(score, links, op.cut(score, links)) - best) < 1e-9


def test_frames(spark):
    schema = "page_id bigint, url string, html string, text string, page_html string, `a.b` int"
    rows = [(1, "u", PAGE, "old", "h", 1), (1, "u", PAGE, "old", "h", 1), (2, None, None, None, None, None), (3, "v", "", "", "", 2)]
    df = spark.createDataFrame(rows, schema)
    out = op.extract(df, op.train(df))
    assert out.columns == ["page_id", "url", "page_html", "a.b", "text"]
    assert sorted((r.page_id, r.text) for r in out.collect()) == [(1, TEXT), (1, TEXT), (2, ""), (3, "")]
    empty = spark.createDataFrame([], schema)
    assert op.extract(empty, op.train(empty)).collect() == []
