"""Pages written by hand, with the text that a reader of the tree finds in them."""

import time

import pytest
from pyspark.sql import functions as F
from tickerloom.functions import web

LONG = "A paragraph with more than thirty characters"


@pytest.fixture(scope="module")
def values(spark):
    def run(inputs, make):
        frame = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], "i int, v string")
        return [r[0] for r in frame.orderBy("i").select(make(F.col("v")).alias("x")).collect()]

    return run


PAGES = [
    # a container ends with its element: the footer's paragraph stays out
    (f'<div class="story-content"><div><p>{LONG} one</p></div></div><footer><p>{LONG} footer</p></footer>', f"{LONG} one"),
    # single quotes, several classes, a class that only begins like one
    (f"<p>{LONG} no</p><div class='wide article-content'><p>{LONG} 'quoted'</p></div><div class=article-contents><p>{LONG} no</p></div>", f"{LONG} 'quoted'"),
    # two articles and what stands between them
    (f"<article><p>{LONG} 1</p></article><p>{LONG} between</p><article><div><p>{LONG} 2</p></div></article>", f"{LONG} 1 {LONG} 2"),
    # character references of all kinds
    (f"<p>{LONG} caf&eacute; &#8217;&#x20AC;&euro;&nbsp;&amp;amp; &notin; AT&T</p>", f"{LONG} café ’€€\xa0&amp; ∉ AT&T"),
    # ">" and quotes in attributes, upper-case names, a line break in a tag
    (f'<P title="a > b" data-x=\'"\'\n>{LONG}</P>', LONG),
    # classes in order of preference; an article without paragraphs is passed over
    (f"<article><b>x</b></article><div class=post-content><p>{LONG} post</p></div><div class=story-content><p>{LONG} story</p></div>", f"{LONG} story"),
    # short ones go, nested text nodes are trimmed and joined without a gap, comments and scripts are not text
    (f"<p>short</p><p> {LONG} <b> bold </b><!-- <p>no</p> --><script>'</p>no'</script><style>p{{}}</style> end</p>", f"{LONG}boldend"),
    # exactly thirty characters are too few
    ("<p>" + "x" * 30 + "</p><p>" + "y" * 31 + "</p>", "y" * 31),
    # an unclosed paragraph ends at the next, one in a cell is inside of the paragraph around the table
    (f"<p>{LONG} 1<p>{LONG} 2<table><tr><td><p>{LONG} 3</p></td></tr></table>", f"{LONG} 1 {LONG} 2{LONG} 3 {LONG} 3"),
    # end tags that nothing opened, tags left open, no tags, nothing
    (f"</div></p><div><p>{LONG}</span></div> after", LONG),
    ("no tags at all, though it is long enough to be one", ""),
    ("", ""),
    (None, None),
]


def test_paragraphs(values):
    assert values([p for p, _ in PAGES], web.paragraphs) == [want for _, want in PAGES]


def test_headings(values):
    pages = [
        "<h3 class='news-t'><a href='/x'>One</a></h3><h3><a href='/y'>Two</a></h3>",
        '<h3 data-x="1>0"><a href="/y" title="<b>">T &gt; <i> U</i></a></h3>',
        "<h3>a<h3 class=TITLE><span><a>no link target</a><a href=/2>second</a></span></h3></h3>",
        "<h3 class=title>no link</h3><h3 class=x><b><a href=/only>only</a></b></h3>",
        "<h2 class=title><a href=/a>not this tag</a></h2>",
        None,
    ]
    want = [[("One", "/x")], [("T >U", "/y")], [("no link target", "")], [("only", "/only")], [], None]
    # the third page: the outer heading has no class, the inner one has
    assert [None if r is None else [(h.title, h.href) for h in r] for r in values(pages, web.headings)] == want


def test_abstract(values, spark):
    rows = [
        ("<div><h3>T</h3><div class='c-Abstract x'>One <div>two <i>three</i></div> four</div></div>", "T", "Onetwothreefour"),
        ("<h3>Title</h3><span class=c-span9> short </span><div class=content>later</div>", "Title", "short"),
        ("<h3>Title</h3><span class=C-SPAN9>text</span>", "Title", "text"),
        ("<h3>Title</h3> Title again " + "x" * 300, "Title", "Title again " + "x" * 188),
        ("<b>no title</b>", None, "no title"),
        (None, "x", None),
    ]
    frame = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, parent string, title string, want string")
    got = frame.orderBy("i").select(web.abstract(F.col("parent"), F.col("title")).alias("x"), "want").collect()
    assert [r.x for r in got] == [r.want for r in got]


RESULT = """<div class="result"><h3 class="news-title"><a href="/link?url=http%3A%2F%2Fa%2F%E4%BD%A0&x=1">First news</a></h3><span class="c-span9">About <b>it</b></span></div>
<div class="result"><h3 class="news-title"><a href="http://b">百度百科 entry</a></h3></div>
<div class="C-RESULT"><h3><a href="http://c">Second news</a></h3><div class="content">Body <p>of two</p></div></div>
<article class="newsbox"><h3><a href="http://d">First news</a></h3></article>
<article class="newsbox"><div><h3><a href="http://e">Third news</a></h3></div></article>
<div class="result"><h3><a href="http://f">ab</a></h3></div>"""


def test_news_results(values):
    first = ("First news", "http://a/你", "Aboutit", 1)
    second, third = ("Second news", "http://c", "Bodyof two", 2), ("Third news", "http://e", "", 2)
    rows = lambda most: [tuple(r) for r in values([RESULT], lambda v: web.news_results(v, most))[0]]
    assert rows(10) == [first, second, third]
    assert rows(2) == [first, second]
    assert rows(1) == [first]  # the first way gives enough
    plain = "".join(f"<h3><a href=/{i}>News {i}</a></h3>" for i in range(9))
    assert [r.title for r in values([plain], lambda v: web.news_results(v, 2))[0]] == [f"News {i}" for i in range(4)]


def test_redirects_are_never_errors(values):
    links = {
        "/link?url=%zz": "%zz", "/link?url=100%": "100%", "/link?url=%ff": "�", "/link?url=a%2": "a%2", "/link?url=%E4%BD%A0%2B+%41": "你++A",
        "/link?url=": "/link?url=", "/link?x=1": "/link?x=1", "/link?url=&url=b%20c": "b c", "http://x/%zz": "http://x/%zz", "/link?url=%F0%9F%98%80%80": "😀�",
    }
    assert values(list(links), web.redirect_target) == list(links.values())


BROKEN = ["<p title='", "<div>", "<p><b>", "<", "&", "<!--", "</p>", "<a href=", "<h3>", "<h3><a href=", "<p><div><b>", "<b><p></p>", "<a b='c\" ", "<!", "</", "<script>", "</script", "<p/", "x='"]


@pytest.mark.parametrize("piece", BROKEN)
def test_broken_pages_take_linear_time(piece):
    started = time.process_time()
    for html in (piece * (300_000 // len(piece)), "<p><div>" + "<b>" * 20_000 + piece * 20_000):
        page = web.Page(html)
        web._paragraphs(page), web._headings(page, "h3")
        assert time.process_time() - started < 8, len(html)
