import time

import pytest

from hestia.llm import htmltree as H

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body class="has-sidebar">
<header><h1>Site</h1><p>Slogan, here.</p></header><nav><ul><li><a href=/a>A</a></li></ul></nav>
<div class="cookie-notice">We use cookies, ok, yes, and more, and more.</div>%s
<aside><p>Aside, text.</p></aside><form><p>Your name, please.</p><input></form><footer><p>&copy; Footer, text.</p></footer><script>var t="</p>";</script></body></html>"""


@pytest.mark.parametrize(
    "body,want",
    [
        ("<article><h1>Title</h1><p>One, two &amp; <b>th</b>ree.</p><p>Four\n  five&nbsp;six.</article>", "Title One, two & three. Four five six."),
        ("<article><h1>T</h1><p><b>Open, bold.<br><p>Next.</p></article>", "T Open, bold. Next."),
        ("<main><div class='ad'>Buy, now.</div><div><p>Text, a.</p></div><div><p>Text, b.</p></div></main>", "Text, a. Text, b."),
        ("<div id=wrap><div class=sidebar><p>S, s, s.</p></div><div class='post'><h2>H</h2><p>A, b.</p><ul><li>x<li>y</ul></div></div>", "H A, b. x y"),
        ("<article><p>Body, text.</p><section id='comments'><article class='comment'><p>Nice, very, nice, indeed, yes.</p></article></section></article>", "Body, text."),
        ("<article><header><h1>Title</h1><p>By somebody</p></header><p>Body, text.</p></article>", "Title Body, text."),
        ("<article><p>a &lt;b&gt; c < d &#233;&#x41; &bogus; &am</p></article>", "a <b> c < d éA &bogus; &am"),
        ("<article><p>Kept<!-- not <p>this --> whole.</p><div style='display:none'>Hidden, text.</div></article>", "Kept whole."),
        ("<article></article>", ""),
    ],
)
def test_pages(body, want):
    assert H.main_text(PAGE % body) == want


def test_odd_pages():
    assert H.main_text(None) == H.main_text("") == H.main_text("<p>") == H.main_text("<script>x") == ""
    assert H.main_text("plain, text") == "plain, text" and H.main_text("<p>a<p>b") == "a b"
    assert H.main_text("<div>" * 20000 + "deep") == "deep"
    assert H.main_text("<p>" + "word " * 200000 + "<a href='") == ("word " * 200000).strip()
    assert H.main_text("<article><p>x" + "<b" * 3000) == "x"


def test_rows(spark):
    rows = [(1, "u", "<p>a, b</p>"), (1, "u", "<p>a, b</p>"), (None, None, None), (2, "v", "")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS n_chars", "2 AS text")
    got = H.extract(df, keep=["page_id", "url"]).collect()
    assert sorted((r.page_id or 0, r.text, r.n_chars) for r in got) == [(0, "", 0), (1, "a, b", 4), (1, "a, b", 4), (2, "", 0)]
    assert H.extract(df.limit(0), keep=["page_id"]).count() == 0


@pytest.mark.parametrize(
    "body,want",
    [
        ("<article><span>One, two.</span></article>", "One, two."),
        ("<article><div><font>One, two.<br>Three.</font></div></article>", "One, two. Three."),
        ("<center><font>One, two.</font></center>", "One, two."),
        ("<dl><dt>Term, one</dt></dl>", "Term, one"),
        ("<my-story><my-part>One, two.</my-part></my-story>", "One, two."),
        ("<article><h2>Only a heading</h2></article>", "Only a heading"),
        ("<article><a href=/a>All linked</a></article>", "All linked"),
        ("<article><p>Body, text.</p><ul><li><a href=/a>Source A</a><li><a href=/b>Source B</a></ul><p>End.</p></article>", "Body, text. Source A Source B End."),
        ("<div id=wrap><ul><li><a href=/a>A</a><li><a href=/b>B</a></ul><article><p>Body, text.</p></article><ul><li><a href=/c>C</a><li><a href=/d>D</a></ul></div>", "Body, text."),
    ],
)
def test_text_in_other_elements(body, want):
    assert H.main_text(PAGE % body) == want


@pytest.mark.parametrize(
    "body",
    [
        '<form id="aspnetForm"><input type=hidden name=x><div>%s</div></form>',
        '<div class="share-price-report">%s</div>',
        '<article id="notice-of-meeting">%s</article>',
        '<article class="ad-free">%s</article>',
        '<div class="content-sidebar">%s</div>',
        '<main><section class="comment-piece">%s</section></main>',
        '<form id=f><div class="content-sidebar"><article class="ad-free">%s</article><div class="ad">Buy, now.</div></div></form>',
        '<div>Stray</div><div role="form"><div class="widget-main">%s</div><div class="comments"><p>Nice, very, nice.</p></div></div>',
    ],
)
def test_article_in_what_is_named_like_an_advert(body):
    text = "<p>One, two, three and so on.</p><p>Four, five, and a long, long tail of it.</p>"
    want = "One, two, three and so on. Four, five, and a long, long tail of it."
    got = H.main_text(PAGE % (body % text))
    assert got in (want, "Stray " + want)


def test_long_comments_do_not_replace_a_short_article():
    comments = "<section id=comments>" + "<article class=comment><p>Nice, very, nice, indeed, yes.</p></article>" * 50 + "</section>"
    ad = "<div class=ad>" + "Buy, now, here. " * 50 + "</div>"
    assert H.main_text(PAGE % ("<article><p>Short, text.</p></article>" + comments + ad)) == "Short, text."
    assert H.main_text(PAGE % ("<div><p>Short, text.</p></div>" + comments)) == "Short, text."


@pytest.mark.parametrize(
    "page",
    [
        "<ul><li>x " * 20000,
        "<div>" * 20000 + "</b>" * 20000 + "x",
        "<div><a href=/>x</a>" + "<div>" * 20000 + "y",
        "<form class=ad>" * 20000 + "x, y",
        "<div class=ad>z</div><div class=widget>" * 20000 + "x, y",
    ],
)
def test_deep_pages_take_linear_time(page):
    began = time.monotonic()
    assert H.main_text(page)
    assert time.monotonic() - began < 6
