import pytest

from logweave.llm import html_extraction as h


@pytest.fixture(scope="module")
def model():
    return h.trained()


def text(model, source):
    return h.main_texts([source], model)[0]


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body>
<header class="site-header"><a href="/">Home of things</a><nav><ul><li><a href=/a>One</a></li><li><a href=/b>Two</a></li></ul></nav></header>
<div class="cookie-notice"><p>We use cookies on this site.</p><button>Fine</button></div>
<article><h1>A title &amp; more</h1><p>First   paragraph of the text, with <b>bold</b> and a <a href=/x>link</a>.<br>It goes on for a while.
<p>Second paragraph that was never closed, it has several sentences. This is one of them.
<script>var x = "</p><p>not text</p>";</script><!-- a comment <p>hidden</p> --><ul><li>First item of a list.</li><li>Second item of a list.</li></ul></article>
<section id="comments"><h3>Comments</h3><div class="comment"><b>Joe</b><p>I do not agree at all with this text.</p></div></section>
<aside class="sidebar"><h3>Related</h3><ul><li><a href=/1>Other story</a></li><li><a href=/2>Another story</a></li></ul></aside>
<form class="newsletter"><p>Get our letter.</p><input name=e></form><div class="ad">Buy this now.</div>
<footer>&copy; 2024 things &middot; all rights</footer></body></html>"""


def test_an_ordinary_page(model):
    assert text(model, PAGE).split("\n\n") == [
        "A title & more",
        "First paragraph of the text, with bold and a link. It goes on for a while.",
        "Second paragraph that was never closed, it has several sentences. This is one of them.",
        "First item of a list.",
        "Second item of a list.",
    ]


def test_held_out_layouts(model):
    pages = [h.parse(x) for x in h.labelled_pages(150, 991)]
    marginal, base, right, total = model.messages(h.forest(pages))[0][:, 1], 0, 0, 0
    for p in pages:
        for k, t in enumerate(p.text):
            if t is not None:
                total += 1
                right += (marginal[base + k] >= 0.5) == p.marked[k]
        base += len(p.parent)
    assert right / total > 0.98


def test_messages_are_exact(model):
    """Marginals of a small tree against the sum over all states."""
    import itertools

    import numpy as np

    p = h.parse("<div><p>one two three.</p><ul><li><a href=/>x</a></li></ul></div>tail")
    f = h.forest([p])
    n = len(p.parent)
    unary = np.bincount(f.node, model.weight[f.place], n)
    total, on = 0.0, np.zeros(n)
    for s in itertools.product((0, 1), repeat=n):
        e = sum(unary[k] * s[k] for k in range(n)) + sum(model.edge[f.kind[k], s[p.parent[k]], s[k]] for k in range(1, n))
        total += np.exp(e)
        on += np.exp(e) * np.array(s)
    assert np.allclose(model.messages(f)[0][:, 1], on / total)


@pytest.mark.parametrize("source", ["", "<", "</", "<p", "<!--", "plain text only", "<p>a<p>b<div", "<div " + 'a="' * 5000, "<div>" * 3000, "</div>" * 3000, "<a href='x>y", "a < b & c > d &#x41; &nbsp;", "<script>", "<table><tr><td>a<td>b<tr><td>c</table>", "\x00<p>\x00"])
def test_broken_pages_do_not_crash(model, source):
    assert isinstance(text(model, source), str)


def test_query(spark, model):
    df = spark.createDataFrame([(1, "u", PAGE, 1, "x"), (1, "u", PAGE, 1, "x"), (2, None, None, 1, "x"), (3, "v", "", 1, "x")], "page_id long, url string, html string, n_chars long, text string")
    got = h.extract(df, model).collect()
    assert sorted((r["page_id"], r["n_chars"], len(r["text"])) for r in got) == sorted([(1, len(text(model, PAGE)), len(text(model, PAGE)))] * 2 + [(2, 0, 0), (3, 0, 0)])
    assert h.extract(df.limit(0), model).count() == 0


def test_pages_of_the_tables(spark, model):
    """Their articles' blocks, and nothing else."""
    import html
    import re

    for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect():
        article = re.search(r"(?s)<article>(.*?)</article>", r["html"])[1].replace("<br>", " ")
        blocks = (" ".join(html.unescape(re.sub("<[^>]*>", "", x)).split()) for x in re.split(r"</?(?:p|h1)>", article))
        assert text(model, r["html"]) == "\n\n".join(b for b in blocks if b)


@pytest.mark.parametrize("tag", ['<svg viewBox="0 0 1 1"/>', "<math/>", "<noscript>", "<select>", "<svg>", "<template>", "<svg><path d='M0 0'/><text>no</text></svg>", "<noscript><p>no</p></noscript>"])
def test_embedded_markup_ends_where_it_can(model, tag):
    """Embedded elements that close themselves, or never close, hide nothing of the article."""
    assert text(model, PAGE.replace("Second paragraph", tag + " Second paragraph")) == text(model, PAGE)


def test_fallback_of_an_object_is_read(model):
    assert text(model, PAGE.replace("<a href=/x>link</a>", '<object data="x">link</object>')).count("link") == 1


def test_very_long_page(model):
    long = "Another sentence of the same text, and it goes on. " * 40_000
    assert text(model, PAGE.replace("Second paragraph", long + "Second paragraph")).count("Another sentence") == 40_000
