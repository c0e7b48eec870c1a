import random
import re

import numpy as np

from rollcall.llm.html_extract import BOILERPLATE, MAIN, PLAIN, common_lines, extracted, main_text, page_lines
from rollcall.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def longest(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    return table[-1][-1]


def test_common_lines_are_a_longest_common_subsequence():
    rng = random.Random(4)
    for _ in range(300):
        a, b = ([rng.randrange(6) for _ in range(rng.randint(0, 14))] for _ in range(2))
        at = common_lines(np.array(a, np.int64), np.array(b, np.int64))
        assert len(at) == len(set(at)) == longest(a, b)
        rest = iter(b)
        assert all(a[k] in rest for k in at)


def test_query_equals_a_plain_extraction(spark):
    """The test pages hold one article each; cut pages lose their ends."""
    import html as h

    rows = QUERIES["op8_url_differencing"](spark, SF).collect()
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    assert len(rows) == len(pages)
    for r in rows:
        article = re.search(r"<article>(.*?)(</article>|\Z)", pages[r.page_id], re.S)[1]
        blocks = re.split(r"</?(?:p|h1|div|ul|li)\b[^>]*>", article)
        plain = (" ".join(h.unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in blocks)
        assert r.text == "\n\n".join(b for b in plain if b)
        assert r.n_chars == len(r.text)


def test_regions_and_markup():
    html = """<!DOCTYPE html><html class="has-menu"><head><title>T &amp; U</title><style>p{}</style></head><body>
    <header><h2>Site</h2></header><nav><ul><li>Home</nav><div class="cookie-notice">We use cookies</div>
    <article><header><h1>Title &lt;1&gt;</h1></header><p>One <b>bold</b>&nbsp;text
    here<p>Two<br>lines<script>var x = "</p><article>";</script><div class="ad">Buy</div><aside>Side</aside>
    <form><p>Mail?</p></form><div id=comments><div class=c><p>Nice</p></div></div><!-- hidden <p> --><p title="a > b">Three 2 < 3</p>
    </article><section class="comments"><p>First!</p></section><footer>&copy; 2020</footer></body></html>"""
    lines = page_lines(html)
    assert main_text(lines, None)[0] == "Title <1>\n\nOne bold text here\n\nTwo lines\n\nThree 2 < 3"
    assert ("Home", BOILERPLATE) in lines and ("Title <1>", MAIN) in lines
    assert page_lines("<p>a<nav>b<article>c") == [("a", PLAIN), ("b", BOILERPLATE), ("c", MAIN)]
    assert page_lines("plain &eacute; text <a href='x") == [("plain é text", PLAIN)]
    assert page_lines("<script>never closed <p>x</p>") == []
    assert page_lines("<p " * 50_000 + '"' * 50_001) is not None


def test_differencing_decides_where_no_article_is_marked(spark):
    def page(body):
        return f"<div>Top line</div><div>Links</div>{body}<p>All rights reserved by nobody</p>"

    rows = [
        (1, "http://A.example/x/1?q=1", page("<p>first story</p>")),
        (2, "http://a.example/x/2", page("<p>second story</p><p>more</p>")),
        (3, "http://b.example/x/3", page("<p>lonely</p>")),
        (4, None, None),
        (5, "no url", ""),
        (None, "http://a.example/x/3", page("<p>third story</p>")),
        (2, "http://c.example/x/2", "<article><p>Top line</p>kept</article>"),
    ]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "url AS host", "page_id AS path")
    got = extracted(df.coalesce(1)).collect()
    assert sorted((r.page_id or 0, r.text) for r in got) == [
        (0, "third story"), (1, "first story"), (2, "Top line\n\nkept"), (2, "second story\n\nmore"),
        (3, "Top line\n\nLinks\n\nlonely\n\nAll rights reserved by nobody"), (4, ""), (5, ""),
    ]
    assert extracted(df.limit(0)).count() == 0


def test_differencing_decides_inside_articles_too(spark):
    def page(k, body):
        return (k, f"http://a.example/x/{k:02}", f"<article><h1>Title {k}</h1><p>{body}</p><p>Follow us!</p></article>")

    own = [f"the long story number {k} which only this page tells" for k in range(8)]
    rows = [page(k, own[k]) for k in range(6)]
    # A quote on two pages stays; versions of one text are no witnesses of each other.
    rows += [(10 + k, f"http://b.example/{k}", f"<main><p>{own[k]}</p><p>A quote</p></main>") for k in range(2)]
    rows += [(20 + k, f"http://c.example/{k}", f"<main><p>{own[0]}</p><p>By {k}</p><p>Follow us!</p></main>") for k in range(6)]
    rows += [(30, "http://d.example/0", f"<main><p>{own[1]}</p><p>Follow us!</p></main>")]
    rows += [(30 + k, f"http://d.example/{k}", f"<main><p>{own[2]}</p><p>Follow us!</p></main>") for k in range(1, 5)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    got = {r.page_id: r.text for r in extracted(df).collect()}
    assert [got[k] for k in range(6)] == [f"Title {k}\n\n{own[k]}" for k in range(6)]
    assert [got[10 + k] for k in range(2)] == [f"{own[k]}\n\nA quote" for k in range(2)]
    assert all(got[k].endswith("Follow us!") for k in got if k >= 20) and len(got) == len(rows)
