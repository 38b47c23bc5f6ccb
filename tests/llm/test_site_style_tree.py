from __future__ import annotations

import html
import re

from llm.tables import pages

from fiscalflow.llm import site_style_tree as st

BLOCK = r"</?(?:p|h1|h2|h3|li|ul|ol|div|article|blockquote|table|tr)\b[^>]*>"


def brute(page):
    """Article text of the given tables' pages, whose noise lies outside the article."""
    inner = re.search(r"<article>(.*?)</article>", page, re.S)[1]
    parts = re.split(BLOCK, inner)
    parts = [" ".join(html.unescape(re.sub(r"<[^>]*>", lambda m: " " if m[0].startswith("<br") else "", x)).split()) for x in parts]
    return "\n".join(x for x in parts if x)


def test_pages(spark):
    df = pages(spark, "sf0.01")
    want = {r["page_id"]: brute(r["html"]) for r in df.collect()}
    got = {r["page_id"]: r["text"] for r in st.extract(df).collect()}
    assert got == want


def template(i, n):
    """A site without article elements: only the statistics tell its noise."""
    body = "".join(f"<div class='x1'><span>Body {i} part {k}</span></div>" for k in range(n))
    return (f"<html><body><div class='x7'><div class='x8'>Welcome to the site</div><div class='x8'>Best offers</div></div>"
            f"<div class='x2'>{body}</div><div class='x9'>Since {1990 + i % 2}</div></body></html>")


def test_statistics_remove_what_pages_of_a_host_share(spark):
    rows = [(i, "http://s.example/" + str(i), template(i, 1 + i % 5)) for i in range(30)]
    rows += [(1000 + i, "http://other.example/" + str(i), template(0, 2)) for i in range(30)]  # copies count once
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in st.extract(df).collect()}
    for i in range(30):
        assert got[i] == "\n".join(f"Body {i} part {k}" for k in range(1 + i % 5))
        assert got[1000 + i] == "Welcome to the site\nBest offers\nBody 0 part 0\nBody 0 part 1\nSince 1990"
    assert {r["page_id"]: r["text"] for r in st.extract(df, broadcast_rows=0).collect()} == got


def test_importance_follows_its_definition(spark):
    df = spark.createDataFrame([(i, "http://s.example/", f"<div class=a>same</div><div class=b>own {i}</div>") for i in range(9)],
                               "page_id long, url string, html string")
    rows = st.tree_rows(df, "url", "html")
    got = {r["node"]: r for r in st.node_importance(rows).collect()}
    a, b = got[st.node_key("s.example", "/div.a")], got[st.node_key("s.example", "/div.b")]
    assert a["pages"] == b["pages"] == 9
    assert abs(a["importance"]) < 1e-9 and abs(b["importance"] - 1) < 1e-9 and abs(a["presentation"]) < 1e-9


def test_noise_of_many_kinds(spark):
    page = """<html><head><title>T</title><style>p{}</style></head><body><header><h1>Site</h1></header><div id="cookie-notice">We use cookies</div>
    <ul class="menu"><li>Home</ul><main><article><header><h1>Title &amp; more</h1></header><p>First <b>bold
    text</b>.<p>Second<br>line<script>x="<p>"</script></p><aside>See also</aside><div class="advert">Buy</div><ul><li>one<li>two</ul>
    <form><input><button>Send</button></form><blockquote>said</blockquote></article><section id="comments"><p>Nice!</p></section></main>
    <div class="sidebar">Side</div><footer>Foot</footer></body></html>"""
    df = spark.createDataFrame([(1, None, page)], "page_id long, url string, html string")
    assert st.extract(df).first()["text"] == "Title & more\nFirst bold text.\nSecond line\none\ntwo\nsaid"


def test_layout_names_and_comments(spark):
    pages = {
        1: "<form><div class='page has-sidebar header'><div class='sidebar'>links</div><article><p>Body</p><div id=comments><article><p>Nice</p></article></div></article></div></form>",
        2: "<main><h1>Title</h1><p>Text</p><section class='reader-comments'><article class=comment>Me too</article></section></main>",
        3: "<aside><article>Teaser</article></aside><article class='post'><h2>Real</h2></article><article class='comment'>First!</article>",
        4: "<div class='with-sidebar'><p>Plain page</p></div><div class='site-header'>Logo</div>",
    }
    df = spark.createDataFrame([(k, None, v) for k, v in pages.items()], "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in st.extract(df).collect()}
    assert got == {1: "Body", 2: "Title\nText", 3: "Real", 4: "Plain page"}


def test_names_inside_articles_that_only_contain_a_noise_word(spark):
    page = """<article><header class='entry-header'><h1>Title</h1></header><h2 class='section-header'>Part</h2><div class='article-header'>Head</div>
    <h2 id='search-trees'>Search trees</h2><h3 id='copyright'>Copyright</h3><section id='related-work'><p>Work</p></section>
    <div id='legal-notice'>Law</div><div class='ad'>Buy</div><div class='post-comments'>Nice</div><section id='comments'>More</section></article>"""
    # a weak name is noise where its text is the same on all pages of the host
    rows = [(0, "http://one.example/", page)] + [
        (i, f"http://s.example/{i}", f"<article><p>Body {i}</p><div id='legal-notice' class='page-notice'>All rights</div></article>") for i in range(1, 12)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in st.extract(df).collect()}
    assert got.pop(0) == "Title\nPart\nHead\nSearch trees\nCopyright\nWork\nLaw"
    assert got == {i: f"Body {i}" for i in range(1, 12)}


def test_odd_rows(odd_pages, no_pages):
    rows = st.extract(odd_pages).collect()
    assert len(rows) == odd_pages.count() and all(r["text"] is not None for r in rows)
    assert "deep" in {r["text"] for r in rows} and "one two" in {r["text"] for r in rows}
    assert st.extract(no_pages).count() == 0


def texts(spark, pages):
    df = spark.createDataFrame([(k, u, v) for k, (u, v) in pages.items()], "page_id long, url string, html string")
    return {r["page_id"]: r["text"] for r in st.extract(df).collect()}


def test_article_and_main_are_a_prior(spark):
    pages = {
        1: "<main><h1>Title</h1><p>Lede</p><article><p>Body</p></article></main>",
        2: "<div class='text'><p>The text of this page is in a division of its own, and long.</p></div><article>Teaser</article>",
        3: "<div class='legal'><p>Terms of use as a text</p></div>",
        4: "<article><p>Before</p><section class='comments-policy'><p>What may be said</p></section><section class='post-comments'>Nice</section></article>",
        5: "<div class='related-guide'>x</div><article class='ad-slot'>Buy</article><article><p>Body</p></article>",
    }
    assert texts(spark, {k: (None, v) for k, v in pages.items()}) == {
        1: "Title\nLede\nBody", 2: "The text of this page is in a division of its own, and long.\nTeaser", 3: "Terms of use as a text",
        4: "Before\nWhat may be said", 5: "Body"}


def test_a_paragraph_that_all_articles_of_a_host_share(spark):
    pages = {i: (f"http://s.example/{i}", f"<article><h1>Title {i}</h1><p>Body {i}</p><p>Same in {i % 3}</p><p>Subscribe to our newsletter</p></article>")
             for i in range(10)}
    pages |= {100 + i: (f"http://few.example/{i}", f"<article><p>Own {i}</p><p>Subscribe to our newsletter</p></article>") for i in range(3)}
    got = texts(spark, pages)
    for i in range(10):
        assert got[i] == f"Title {i}\nBody {i}\nSame in {i % 3}"
    assert all(got[100 + i].endswith("newsletter") for i in range(3))      # too few pages to tell


def test_all_given_pages(spark):
    df = pages(spark, "sf0.1")
    want = {r["page_id"]: brute(r["html"]) for r in df.collect()}
    assert {r["page_id"]: r["text"] for r in st.extract(df).collect()} == want
