from __future__ import annotations

import pytest

SF = "/root/testdata/sf0.001"

# texts that each operator has to survive: null, empty, blank, tiny, very long, non-ASCII, ties
ODD_TEXTS = [None, "", "  \n\t ", "a", "a", "ab c", "É" * 40, "word " * 30_000, "x" * 50_000, "the The THE the The THE the",
             "line one\nline one\nline two", "\x00\x01 a\x00b", "MIT License apache license"]


@pytest.fixture()
def odd_documents(spark):
    """Nulls in every column, repeated rows, and columns that clash with results."""
    rows = [(i, t, "en", "s", 1) for i, t in enumerate(ODD_TEXTS)]
    rows += [(None, "null id", None, None, None), (None, None, None, None, None), (3, "a", "en", "s", 1), (3, "a", "en", "s", 1)]
    return spark.createDataFrame(
        [r + (7, "mine", 0.5) for r in rows],
        "doc_id long, text string, lang string, source string, n_chars long, shard int, quality string, score double")


@pytest.fixture()
def no_documents(odd_documents):
    return odd_documents.limit(0)


@pytest.fixture()
def odd_pages(spark):
    """Nulls in every column, equal payloads, repeated rows, broken markup and clashing columns."""
    rows = [(i, f"https://h{i % 2}.example/p/{i}?q=%20é", t) for i, t in enumerate(
        [None, "", "", "<p>x", "<p>x", "<p>x", "no markup & more", "<div><div><article><p>a<p>b&nbsp;&amp;c", "<script>var x='</p>'",
         "<" * 500, "<div>" * 3000 + "deep", "é" * 30_000, "a > b < c", "<!-- open", "<p>one<br>two</p><nav>menu</nav>"])]
    rows += [(None, None, None), (None, None, "<p>x"), (3, "https://h1.example/p/3", "<p>x"), (3, "https://h1.example/p/3", "<p>x"), (99, "::bad url[", "<p>y")]
    return spark.createDataFrame([r + ("f", 1, 2) for r in rows], "page_id long, url string, html string, file string, page long, text int")


@pytest.fixture()
def no_pages(odd_pages):
    return odd_pages.limit(0)
