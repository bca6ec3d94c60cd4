import html
import itertools
import re

import numpy as np
import pytest

from brute import SF
from transitlens.llm import html_extract as H
from transitlens.llm.html_pages import PAGES
from transitlens.llm.storage import read


def article(page):
    """The blocks of a generated page's article, by hand."""
    body = re.search(r"<article>(.*?)</article>", page, re.S)[1]
    out = [" ".join(html.unescape(re.sub(r"<[^>]*>", " " if False else "", re.sub(r"<br>", " ", x))).split())
           for x in re.split(r"</?(?:h1|p)>", body)]
    return "\n".join(x for x in out if x)


def test_query_equals_the_articles(spark):
    pages = {r.page_id: r for r in read(spark, SF, "pages").collect()}
    got = H.op8_html_extraction(spark, SF).collect()
    assert len(got) == len(pages)
    for r in got:
        assert r.text == article(pages[r.page_id].html)
        assert r.n_chars == len(r.text) and r.url == pages[r.page_id].url


@pytest.mark.parametrize("left_out", range(len(PAGES)))
def test_held_out_pages(left_out):
    """Each labelled page by a model that has not seen it."""
    model = H.Model.train([H.labelled(p) for i, p in enumerate(PAGES) if i != left_out])
    nodes, y = H.labelled(PAGES[left_out])
    plain = re.sub(r' data-y="1"', "", PAGES[left_out])
    want = "\n".join(n.text for n, l in zip(nodes, y) if n.run and l)
    assert model.text(plain) == want


def test_marginals_are_exact():
    """Messages against the sum over all labellings of a small tree."""
    model = H.Model.train([H.labelled(p) for p in PAGES])
    nodes = H.dom("<div><p>One two three.</p><ul class=nav><li><a href=x>y</a></ul></div>")
    score = H.features(nodes) @ model.weights
    total, on = 0.0, np.zeros(len(nodes))
    for labels in itertools.product((0, 1), repeat=len(nodes)):
        w = np.exp(sum(s for s, l in zip(score, labels) if l)
                   + sum(model.edge[labels[n.parent], labels[i]] for i, n in enumerate(nodes) if i))
        total += w
        on += w * np.array(labels)
    assert np.allclose(model.marginals(nodes), on / total)


def test_parsing_and_odd_pages(spark):
    model = H.trained()
    assert model.text(None) == "" and model.text("") == ""
    page = ("<body><article><h1>A &amp; B &am c&nbsp;d</h1><script>var t='</p>';if(a<b){}</script><p><b>One <br>two<br><p>Three <i>x</i>y</p>"
            "<!-- <p>no</p> --><p title='a>b'>1 < 2 &lt;b&gt;</p><ul><li>i<li>j</ul><div class=\"comments\"><p>Nice text, I like it.</p></div>"
            "<form><p>Your name, please.</p></form></article><footer>end")
    assert model.text(page) == "A & B &am c d\nOne two\nThree xy\n1 < 2 <b>\ni\nj"
    rows = [(1, None, None), (None, "u", page), (2, "v", "<p>" * 3000 + "deep"), (2, "v", "<a href='" * 2000), (3, "w", "x " * 50_000)]
    df = spark.createDataFrame([(a, b, c, "t") for a, b, c in rows], "page_id bigint, url string, html string, text string")
    got = H.extracted(df).collect()
    assert len(got) == len(rows) and {r.page_id for r in got} == {1, 2, 3, None}
    assert H.extracted(df.limit(0)).count() == 0


#: Pages that no model is trained on, with their main text.
HELD_OUT = {
    "comments are articles": ("""<body><div class="content"><h1>Tides</h1><p>The tide comes in twice a day.</p><p>It leaves shells behind.</p></div>
        <div id="comments"><article class="comment"><p>I like shells very much, and I collect them.</p></article></div></body>""",
                              "Tides\nThe tide comes in twice a day.\nIt leaves shells behind."),
    "one comment is the only article": ("""<body><div class="content"><p>The story is here. It has two sentences.</p></div>
        <article class="comment"><p>Nice story, thank you for it.</p></article></body>""", "The story is here. It has two sentences."),
    "a formula": ("""<body><main><p>We know that <math><mi>a</mi><mo>=</mo><msup><mi>b</mi><mn>2</mn></msup></math> holds.</p><p>So we are done.</p></main></body>""",
                  "We know that a=b2 holds.\nSo we are done."),
    "noscript": ("""<body><article><h1>Map</h1><p>The map shows the town. <noscript>It lies on a hill.</noscript></p><p>Walk to see it.</p></article>
        <footer>Imprint and contact.</footer></body>""", "Map\nThe map shows the town. It lies on a hill.\nWalk to see it."),
    "object": ("""<body><article><p>The plan is below.</p><object data="plan.pdf"><p>The plan has three rooms.</p></object><p>It is old.</p></article></body>""",
               "The plan is below.\nThe plan has three rooms.\nIt is old."),
    "footnotes": ("""<body><article><h1>Kings</h1><p>The king had two sons.</p><section class="footnotes"><ol><li>The elder one died young.</li></ol></section></article>
        <div class="footer">All rights reserved.</div></body>""", "Kings\nThe king had two sons.\nThe elder one died young."),
    "related work": ("""<body><article><h1>Sorting</h1><p>We sort numbers fast.</p><section class="related-work"><h2>Related work</h2><p>Others sort them slowly.</p>
        </section></article><div class="related-posts"><p>Read also how to count numbers.</p></div></body>""",
                     "Sorting\nWe sort numbers fast.\nRelated work\nOthers sort them slowly."),
    "a frame that names a sidebar": ("""<body><div class="wrapper has-sidebar"><div class="content"><h1>Oak</h1><p>The oak is a tree that grows old.</p><p>Its wood is hard, and
        ships were made of it.</p></div></div><div class="sidebar"><p>Trees of the month.</p></div></body>""",
                                     "Oak\nThe oak is a tree that grows old.\nIts wood is hard, and ships were made of it."),
    "a form around all": ("""<body><form id="page"><div class="main"><h1>Rules</h1><p>Wash your hands first. Then sit down at the table.</p><p>Wait for the others.</p></div>
        <div class="menu"><a href="/">Home</a></div></form></body>""", "Rules\nWash your hands first. Then sit down at the table.\nWait for the others."),
    "a heading named header": ("""<body><article><h2 class="section-header">First part</h2><p>It begins slowly, as such stories do.</p>
        <h2 class="section-header">Second part</h2><p>It ends well.</p></article></body>""", "First part\nIt begins slowly, as such stories do.\nSecond part\nIt ends well."),
    "tags of a story": ("""<body><article><p>The sea was calm that day, and the boat went out.</p><div class="tags"><p>Filed under the sea.</p></div></article></body>""",
                        "The sea was calm that day, and the boat went out.\nFiled under the sea."),
    "teasers are articles": ("""<body><div class="content"><h1>Snow</h1><p>Snow fell over night on all the hills around the town, and it stayed for weeks. Nobody went out much.</p>
        <p>Children built a house of it, with two rooms and a door, and lived there until the evening came.</p></div>
        <div class="related"><article><a href="/a">Ice</a></article><article><a href="/b">Rain</a></article></div></body>""",
                             "Snow\nSnow fell over night on all the hills around the town, and it stayed for weeks. Nobody went out much.\n"
                             "Children built a house of it, with two rooms and a door, and lived there until the evening came."),
}


@pytest.mark.parametrize("name", HELD_OUT)
def test_pages_of_other_make(name):
    page, text = HELD_OUT[name]
    assert H.trained().text(page) == text


def test_the_sample_is_that_of_least_hashes(spark):
    from pyspark.sql import functions as F
    pages = spark.range(5000).select((F.col("id") % 4000).alias("page_id"), F.format_string("<p>%d</p>", "id").alias("html"))
    want = pages.orderBy(F.xxhash64("page_id"), F.length("html")).limit(20).select("html").collect()
    got = H._least(pages, 20, "page_id", "html")
    assert len(got) == 20 and {t for t in got[:18]} <= {r.html for r in pages.orderBy(F.xxhash64("page_id"), F.length("html")).limit(24).collect()}
    assert len(want) == 20
    same = spark.range(3000).select(F.lit(7).alias("page_id"), F.lit("<p>x</p>").alias("html"))
    assert len(H._least(same, 20, "page_id", "html")) == 20
    assert H._least(same.limit(0), 20, "page_id", "html") == []
