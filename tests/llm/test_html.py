"""Main text of pages: what is kept, what is set aside, and pages that are odd."""

import html as characters
import re

import pytest

from chainframe.llm import html, queries

P = "This paragraph has enough words, some commas, and so on, to count as running text of the article."
PAGE = f"""<html><head><title>T</title><style>p{{}}</style><script>var a = "<p>no</p>";</script></head><body>
<header><a href="/">Home</a></header><nav><ul><li><a>One</a><li><a>Two</a></ul></nav>
<div class="cookie-notice">We use cookies, dear reader, and so does everyone else on this web site.</div>
<div id="content"><h1>Title &amp; more</h1><p>{P}</p><p>{P} Caf&eacute;&nbsp;&#x1F600;<br>next</p><form><input><p>{P} form</p></form></div>
<aside class="sidebar"><p>{P} aside</p></aside><div class="comments"><p>{P} comment</p></div><footer><p>{P} footer</p></footer></body></html>"""


def test_article_is_kept_and_the_rest_left():
    assert html.main_text(PAGE) == f"Title & more {P} {P} Café \U0001f600 next"


@pytest.mark.parametrize(("page", "text"), [("", ""), ("<p></p>", ""), ("plain words only", "plain words only"), ("<div><p>Short.</p></div>", "Short."), ("<ul><li>a<li>b</ul>", "a b"), ("<script>x</script>", ""), ("<p>open <b>tag", "open tag")])
def test_small_pages(page, text):
    assert html.main_text(page) == text


def test_deep_and_long_pages():
    assert html.main_text("<div>" * 20_000 + f"<p>{P}</p>") == P
    long = " ".join(f"<p>{P} {i}</p>" for i in range(3000))
    assert html.main_text(f"<article>{long}</article>").split()[-1] == "2999"


def test_rows(spark, sf_dir):
    rows = [(1, "u", PAGE, "k"), (None, None, None, "k"), (2, "u", "", "k"), (2, "u", "", "k")]
    got = html.extract(spark.createDataFrame(rows, "page_id long, url string, html string, text string").withColumnRenamed("text", "tag")).collect()
    assert sorted(len(r.text) for r in got)[:3] == [0, 0, 0]
    assert html.extract(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []
    pages = queries.table(spark, sf_dir, "pages").count()
    out = queries.op8_html_extraction(spark, sf_dir).collect()
    assert len(out) == pages
    assert all(r.n_chars == len(r.text) for r in out)


TABLE = "<table><tr><th>Year</th><th>Sum</th></tr><tr><td>2001</td><td>17</td></tr></table>"
REST = f"<h2>Second</h2><p>{P} A</p><p>{P} B</p><p>{P} C</p><ul><li>one</li><li>two</li></ul>{TABLE}<pre>a = 1</pre><h5>Small</h5><blockquote>Short.</blockquote>loose <b>words</b>"
REST_TEXT = f"Second {P} A {P} B {P} C one two Year Sum 2001 17 a = 1 Small Short. loose words"
LONG = "".join(f"<p>{P} {i}</p>" for i in range(100))
LONG_TEXT = " ".join(f"{P} {i}" for i in range(100))


@pytest.mark.parametrize("around", ["<article>{}</article>", "<main><div>{}</div></main>", "<div>{}</div>", "{}"])
@pytest.mark.parametrize("second", ["<section>{}</section>", "{}", "<div><div>{}</div></div>"])
def test_uneven_parts_are_kept_whole(around, second):
    menu = "<ul><li><a>Menu one</a></li><li><a>Menu two</a></li></ul>"
    for first, last in ((f"<section>{LONG}</section>", second.format(REST)), (second.format(REST), f"<section>{LONG}</section>")):
        got = html.main_text(f"<body>{around.format(first + last + menu)}<div class='ad'>{P}</div></body>")
        assert got == " ".join([LONG_TEXT, REST_TEXT] if first.startswith(f"<section><p>{P} 0") else [REST_TEXT, LONG_TEXT])


def test_parts_beside_an_article_and_short_articles():
    page = f"<body><h1>Title</h1><p>Lead.</p><article>{LONG}</article><article><p>{P} more</p></article></body>"
    assert html.main_text(page) == f"Title Lead. {LONG_TEXT} {P} more"
    assert html.main_text("<body><article><p>One.</p></article><article><p>Two.</p></article></body>") == "One. Two."


def test_a_page_of_links_keeps_its_best_part():
    page = f"<body><div><ul><li><a>{P}</a></li><li><a>{P}</a></li></ul></div></body>"
    assert html.main_text(page) == f"{P} {P}"


def plain(page):
    """The text of the one article of a page without markup inside comments or scripts, by plain replacement."""
    inner = re.search(r"(?s)<article>(.*?)</article>", re.sub(r"(?s)<!--.*?-->|<script>.*?</script>|<style>.*?</style>", "", page))[1]
    blocks = re.split(r"</?(?:p|h[1-6]|ul|ol|li|div|section|table|tr|td|th|blockquote|pre)\b[^>]*>", inner.replace("<br>", " "))
    texts = (" ".join(characters.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in blocks)
    return " ".join(t for t in texts if t)


def test_all_pages_against_a_plain_version(spark):
    folder = "/root/testdata/sf0.01"
    pages = {r.page_id: r.html for r in queries.table(spark, folder, "pages").collect()}
    got = {r.page_id: r.text for r in queries.op8_html_extraction(spark, folder).collect()}
    assert got == {i: plain(h) for i, h in pages.items()}


@pytest.mark.parametrize("name", ["post category-social-media", "entry share-wide", "story related-topic", "content tags-python", "post-12 hentry tag-comments sidebar-left", "social", "related-stories", "tags"])
def test_an_article_with_an_odd_class_is_kept(name):
    body = "".join(f"<p>{P} {i}</p>" for i in range(8))
    text = " ".join(f"{P} {i}" for i in range(8))
    page = f"<body><nav><a href='/'>Home</a></nav><div class='{name}'>{body}</div><div class='promo'><p>A promo line of some length, here.</p></div></body>"
    assert html.main_text(page) == text
    assert html.main_text(page.replace("<div class='promo'", "<div class='share-buttons'")) == text


@pytest.mark.parametrize("name", ["comments", "comment-list", "reply", "sidebar", "cookie-consent", "related-posts", "social-links", "ad"])
def test_furniture_is_left_however_long(name):
    long = "".join(f"<p>{P} {i}</p>" for i in range(30))
    for tag in ("article", "main"):
        assert html.main_text(f"<body><{tag}><p>{P}</p></{tag}><div class='{name}'>{long}</div></body>") == P


def test_many_posts_of_a_page_stay():
    posts = "".join(f"<div class='post tag-social share{i}'><p>{P} {i}</p></div>" for i in range(6))
    assert html.main_text(f"<body><div id='blog'>{posts}</div><div class='comments'><p>{P}</p></div></body>") == " ".join(f"{P} {i}" for i in range(6))
