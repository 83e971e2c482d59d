import itertools
import time

import numpy as np
import pytest
from tickerloom.llm import html_tree


def test_messages_equal_enumeration():
    tree = html_tree.parse("<body><nav><li><a>x</a></li></nav><article><h1>T</h1><p>Some words here.</p></article></body>")
    forest = html_tree.Forest([tree, html_tree.parse("just text")])
    rng = np.random.default_rng(3)
    model = html_tree.Model(rng.standard_normal(html_tree.FEATURES), rng.standard_normal((2, 2, 2)))
    got, _ = forest.marginals(model)
    n = len(forest.parent)
    total, content = 0.0, np.zeros(n)
    for states in itertools.product((0, 1), repeat=n):
        score = sum(model.unary[f] for i, f in zip(forest.node, forest.feature) if states[i])
        score += sum(model.pair[forest.leaf[i], states[p], states[i]] for i, p in enumerate(forest.parent) if p >= 0)
        total += np.exp(score)
        content += np.array(states) * np.exp(score)
    assert np.allclose(got, content / total)


def test_held_out_pages():
    model = html_tree.default_model()
    pages = html_tree.labelled_pages(150, seed=77)
    right = sum(html_tree.main_texts([source], model)[0] == " ".join(texts) for source, texts in pages)
    assert right / len(pages) > 0.9


PAGE = """<html><head><title>No</title><style>p{}</style><script>var t="</p><p>no</p>";</script></head><body>
<header><h1>Site</h1></header><nav><ul><li><a href=/a>Home</a><li><a href=/b>More</a></ul></nav>
<div class="cookie-notice"><p>We use cookies here. Accept them all.</p></div>
<article><h1>A   title</h1><p><b>First &amp; foremost,<br>it is &lt;b&gt; said.<p>A second paragraph follows
 with more than a few words in it.</p><ul><li>One point made here.<li>Another point made here.</ul></article>
<aside class=sidebar><h3>Related</h3><ul><li><a href=/c>Other things</a></li></ul></aside>
<section class="comments"><h3>Comments</h3><div class=comment><p>I liked this article very much, thank you.</p></div></section>
<form class="newsletter"><label>Mail</label><p>Subscribe to our letter.</p></form><footer>&copy; Site</footer></body></html>"""


def test_a_page():
    got = html_tree.main_texts([PAGE], html_tree.default_model())[0]
    assert got == "A title First & foremost, it is <b> said. A second paragraph follows with more than a few words in it. One point made here. Another point made here."


@pytest.mark.parametrize("source", [None, "", "<", "<p", "<!-- open", "<script>never closed", "</p></div>", "<p>" * 3000, "&#xffffffff;&bogus;", "<a href='x>y", "\x00<p>\x00", "a" * 200_000])
def test_broken_pages_do_not_fail(source):
    assert isinstance(html_tree.main_texts([source], html_tree.default_model())[0], str)


@pytest.mark.parametrize(
    "source",
    [
        "<head><title>x</title><article><p>{}</p></article>",
        "<title>x</title><article><p>{}</p></article>",
        "<html><head><meta charset=u><noscript><link rel=a><article><p>{}</p></article>",
        "<body><div class=menu><ul><li><a href=/>Home</a></ul><noscript>no</div><article><p>{}</p></article>",
        "<body><article><p title=don't>{}</p></article><!-- ' -->",
        "<body><article><p title=\"a > b\" data-x='<p>'>{}</p></article>",
        "<body><article><p class = \"a\" title=\"open>{}</p></article>",
    ],
)
@pytest.mark.parametrize("text", ["It isn't long, but it is a whole sentence.", "A sum <math><mi>x</mi> + 1</math> stands here, in the middle."])
def test_pages_that_leave_out_tags_or_quotes(source, text):
    got = html_tree.main_texts([source.format(text)], html_tree.default_model())[0]
    assert got == text.replace("<math><mi>", "").replace("</mi>", "").replace("</math>", "")


@pytest.mark.parametrize("source", ["<div title=\"a" * 30_000, "<p title='x>" * 30_000 + "'", "<div>" * 30_000, "<x>" * 20_000 + "<li></li>" * 20_000, "<svg>" * 30_000 + "</p>" * 30_000, "<svg>" * 30_000 + "<p></object>" * 30_000, "<!--" * 90_000, "<" * 300_000, "<p>x" * 30_000])
def test_time_is_linear(source):
    html_tree.default_model()
    started = time.process_time()
    html_tree.main_texts([source], html_tree.default_model())
    assert time.process_time() - started < 20


def test_extract_keeps_rows_and_columns(spark):
    rows = [(1, "u", PAGE, "old", 3), (1, "u", PAGE, "old", 3), (None, None, None, None, None), (2, "v", "", "x", None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars int")
    got = html_tree.extract(pages).collect()
    assert len(got) == 4 and got[0].text == got[1].text and sorted(r.text == "" for r in got) == [False, False, True, True]
    assert html_tree.extract(pages.where("false")).count() == 0
