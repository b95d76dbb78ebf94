import itertools
import random

import pytest

from rivalry.llm import pages

PAGE = """<html><body class="has-sidebar"><header><h2>Site</h2><p>Welcome to this site.</p></header>
<nav><ul><li><a href="/">Home</a><li><a href="/b">News of the day</a></ul></nav>
<div id="cookie-notice"><p>We use cookies to make this site better for all of its many readers.</p></div>
<div class="content-with-sidebar"><article><h1>Title &amp; more</h1>
<p>First <b>bold</b>ly &eacute;crit,
   on two lines.<p>Second &#8212; unclosed<br>and broken.
<div class="ad-box"><p>Buy this very good thing now, while there are still some left in our shop.</p></div>
<script>var t = "</p><p>no text</p>";</script><style>p{}</style>
<ul><li>point one<li>point two</ul><form><label>Name</label><button>Go</button></form></article>
<section id="comments"><article><p>A reader liked this article very much indeed.</p></article></section>
</div><aside><article><p>Another article that you may like to read as well.</p></article></aside>
<footer><p>&copy; The site, all rights reserved.</p></footer></body></html>"""


def test_main_text():
    assert pages.main_text(PAGE) == (
        "Title & more\nFirst boldly écrit, on two lines.\nSecond — unclosed and broken.\npoint one\npoint two"
    )


def test_page_without_article_elements():
    text = "A long paragraph of running text, with enough words to be taken for content by any measure."
    html = f"<div><p>{text}</p><p>{text}</p><ul><li><a href=x>Home</a><li><a href=y>About</a></ul>"
    assert pages.main_text(html) == f"{text}\n{text}"


def test_names_do_not_outweigh_an_article():
    words = "A paragraph with enough words to be read as a part of what the page has to say."
    names = "social-impact legal-status copyright search related-work notice".split()
    inside = "".join(f'<h2 id="{n}">{n}</h2><section id="{n}"><p>{words}</p></section>' for n in names)
    want = "\n".join(f"{n}\n{words}" for n in names)
    discussion = f'<section id="discussion"><h2 id="discussion">Talk</h2><p>{words}</p><p>Short.</p></section>'
    html = f"<article><h1>Title</h1>{inside}{discussion}</article>"
    assert pages.main_text(html) == f"Title\n{want}\nTalk\n{words}\nShort."
    # outside an article the classifier weighs the name against the text
    long = " ".join([words] * 4)
    html = f'<div><p>{long}</p><div id="notice"><p>{long}</p></div><p>{long}</p></div>'
    assert pages.main_text(html).count("\n") == 2
    links = '<ul class="related"><li><a href="/a">One more page</a><li><a href="/b">And another one</a></ul>'
    assert pages.main_text(f"<article><h1>Title</h1><p>{words}</p>{links}</article>") == f"Title\n{words}"


LONG = "A paragraph with enough words to be read as a part of what the page has to say to readers."
ARTICLE = f"<h1>Title</h1><p>{LONG}</p><p>{LONG}</p><p>Short one.</p><p>{LONG}</p>"
WANT = f"Title\n{LONG}\n{LONG}\nShort one.\n{LONG}"
MENU = '<ul class="menu"><li><a href="/">Home</a><li><a href="/x">News</a></ul>'


@pytest.mark.parametrize(
    "page",
    [
        '<div class="has-sidebar"><main>{}</main></div>',
        '<div class="site sidebar-right"><article>{}</article></div>',
        '<div id="page" class="no-modal-open"><article>{}</article></div>',
        '<div class="widget-area"><article>{}</article></div>',
        '<article class="post-12 post type-post hentry category-advertising tag-menu">{}</article>',
        '<form id="aspnetForm" action="/"><div class="body-text">{}</div></form>',
        '<form><div class="page-wrapper"><div class="col-8">{}</div></div></form>',
        '<div class="layout-with-sidebar"><div class="entry-content">{}</div><div class="sidebar"><p>Other</p></div></div>',
        '<table><tr><td>{}</td><td class="nav"><a href="/a">A</a></td></tr></table>',
        '<div class="popup-container"><div role="main"><main id="main">{}</main></div></div>',
        '<section class="cookies-recipe-category"><article id="post-7">{}</article></section>',
        '<div class="theme-footer-dark"><article itemprop="articleBody">{}</article></div>',
    ],
)
def test_shapes_of_pages_with_an_article(page):
    extra = f"<header><p>{LONG}</p></header>{MENU}{{}}<footer><p>{LONG}</p></footer>"
    assert pages.main_text(f"<html><body class='menu-open'>{extra.format(page.format(ARTICLE))}</body></html>") == WANT


@pytest.mark.parametrize(
    "box",
    [
        '<div id="responses"><h3>What readers say</h3><div><p>{0} {0}</p></div><p>{0}</p></div>',
        '<div class="comment-list"><article class="comment even depth-1"><p>{0} {0}</p></article></div>',
        '<section class="post-comments"><p>{0} {0} {0} {0}</p></section>',
        '<div class="notice"><p>{0} {0} {0} {0}</p></div>',
        '<p class="disclaimer">{0} {0} {0} {0}</p>',
        '<div class="ad-slot wide"><p>{0}</p></div>',
        '<div class="related"><article class="teaser"><p>{0}</p></article></div>',
        '<div class="newsletter-signup"><p>{0}</p><form><input name=m></form></div>',
        '<aside class="left"><article><p>{0}</p></article></aside>',
        '<div class="sidebar-right"><article><h3>Teaser</h3><p>{0}</p></article></div>',
    ],
)
def test_boxes_that_go(box):
    box = box.format(LONG)
    inside, outside = f"<article>{ARTICLE}{box}</article>", f"<main><div>{ARTICLE}</div></main>{box}"
    between = f"<article><h1>Title</h1><p>{LONG}</p>{box}<p>{LONG}</p></article>"
    assert pages.main_text(inside) == WANT and pages.main_text(outside) == WANT
    assert pages.main_text(between) == f"Title\n{LONG}\n{LONG}"


def test_head_without_end_and_formulas():
    words = "A paragraph with enough words to be read as a part of what the page has to say."
    head = "<html><head><title>No text</title><meta charset=utf-8><style>p{}</style><link href=x>"
    for page in (f"{head}<body><p>{words}</body>", f"{head}<p>{words}", f"{head}{words}", f"{head}</head><p>{words}"):
        assert pages.main_text(page) == words
    formula = "<math><semantics><msup><mi>x</mi><mn>2</mn></msup><annotation>x^2</annotation></semantics></math>"
    assert pages.main_text(f"<article><p>It is {formula} here.</p></article>") == "It is x2 here."


def test_odd_pages():
    for html in (None, "", "   ", "<", "<p", "</p></p>", "<script>", "<!-- x", "<p title='>", "&bogus; &#xFFFFFFF;"):
        assert isinstance(pages.main_text(html), str)
    assert pages.main_text("<article>" + "<p>Some words in a paragraph. " * 20_000).count("\n") == 19_999


def test_cut_is_minimal():
    pick = random.Random(9)
    for _ in range(200):
        n = pick.randint(1, 7)
        source = [pick.random() * 3 for _ in range(n)]
        sink = [pick.random() * 3 for _ in range(n)]
        pairs = [
            (a, b, pick.random()) for a, b in itertools.combinations(range(n), 2) if pick.random() < 0.6
        ]

        def cost(label):
            own = sum(sink[i] if label[i] else source[i] for i in range(n))
            return own + sum(w for a, b, w in pairs if label[a] != label[b])

        best = min(map(cost, itertools.product([False, True], repeat=n)))
        assert abs(cost(pages.minimum_cut(source, sink, pairs)) - best) < 1e-6


def test_odd_rows(spark):
    schema = "page_id long, url string, html string, text string"
    rows = [(1, "u", PAGE, "own"), (1, "u", PAGE, "own"), (None, None, None, None), (2, None, "", "own")]
    got = pages.extract(spark.createDataFrame(rows, schema))
    assert got.columns == ["page_id", "url", "text"]
    assert sorted(r.text.count("\n") for r in got.collect()) == [0, 0, 4, 4]
    assert pages.extract(spark.createDataFrame([], schema)).count() == 0
