"""Main text of pages: whole templates, block rules, hard markup; and all given pages against their article element."""

import re
import time
from html import unescape

import pytest

from conftest import SF_TINY
from sparkrec.llm import html_blocks as hb

LONG = "The river that runs through the old town was for many years the only way to bring the stone to the mason, and it is still in use by the boats of the guild."
MORE = "There is a small house at the end of the road, and in it there are the tools that they used when the bridge was built in the year of the flood."
SCHEMA = "page_id bigint, url string, html string, text string, n_chars int"


def test_an_article_in_a_full_page():
    html = f"""<!doctype html><html><head><title>T</title><style>p{{}}</style><script>var x = "<p>{LONG}</p>";</script></head>
    <body class="has-sidebar"><div id="cookie-notice"><p>{MORE}</p></div><header class="site"><h1>Site name</h1></header>
    <nav><ul><li><a href="/">Home</a><li><a href="/b">Other</a></ul></nav>
    <main><article class="post tag-ads"><header><h1>The <em>head</em>line</h1></header><p>{LONG}<p>Short&nbsp;one &amp; more.
    <div class="ad-box"><p>{MORE}</p></div><form><p>{MORE}</p><input></form><p>I<b>n</b> the end.</p>
    <section class="comments"><article><p>{MORE}</p></article></section></article></main>
    <aside><p>{MORE}</p></aside><div class="footerLinks">{MORE}</div><footer>&copy; 2020</footer></body></html>"""
    assert hb.main_text(html) == f"The headline {LONG} Short one & more. In the end."


def test_a_page_without_an_article_element():
    html = f"""<body><div>Home About</div><div><a href=/a>One</a> <a href=/b>Two</a> <a href=/c>Three</a></div>
    <div><h2>Heading</h2><p>{LONG}</p><p>Short.</p><p>{MORE}</p></div><div><a href="x">{MORE}</a></div><div>Copyright 2020 by them</div></body>"""
    assert hb.main_text(html) == f"Heading {LONG} Short. {MORE}"


@pytest.mark.parametrize("html,text", [
    (None, ""), ("", ""), ("   \n", ""), ("plain words", "plain words"), ("a < b and c > d", "a < b and c > d"), ("<p>one<p>two", "one two"),
    ("<article>x<!-- <p>y --> z", "x z"), ("<article>x<!-- y", "x"), ("<article>x<script>y", "x"), ("<article>x<p class='a", "x"),
    ("<article><p title='>'>x</p>", "x"), ("<article><p it's>x</p> y", "x y"), ("<article>&lt;b&gt; &#233;&am &amp", "<b> é&am &"),
    ("<article>a<br>b<span>c</span>d</article>", "a bcd"), ("<article><p>x <span hidden>y</span><span style='display: none'>z</span></p>", "x"),
    ("<article><pre><span class='comment'># kept</span> code</pre></article>", "# kept code"), ("<article><h2 id='related-work'>Related work</h2></article>", "Related work"),
    ("<nav><a href=x>y</a></nav><footer>z</footer>", ""), ("<TITLE>t</TITLE><ARTICLE>Body</ARTICLE>", "Body"), ("<article>x</div></p></article>y", "x"),
    ("<article><a href=x>linked</a><p>text</p></article>", "text"), ("<a name=x>anchor<p>text", "anchor text"), ("<article/>x", "x"),
    ("<article><textarea>no</textarea><select><option>no</select>yes</article>", "yes"),
])
def test_hard_markup(html, text):
    assert hb.main_text(html) == text


def test_a_language_without_known_stop_words():
    words = "Rzeka płynąca przez stare miasto była przez wiele lat jedyną drogą, którą można było przywieźć kamień dla murarza; dzisiaj pływają nią łodzie cechu rzemiosł."
    assert hb.main_text(f"<div><a href=x>Strona</a></div><div>{words}</div>") == words


def test_nearest_decided_block():
    assert hb._nearest([(0, False), (4, True)], 1, False) is False and hb._nearest([(0, False), (4, True)], 2, False) is True
    assert hb._nearest([(0, False), (4, True)], 1, True) is True and hb._nearest([(0, True), (4, False)], 3, False) is False
    assert hb._nearest([(3, True)], 9, True) is True


def test_time_is_linear():
    for piece in ("<div ", "<p title='", "<!-- <a ", "<a href=\"x", "<b><p>", "<script>", "&am<", "<div><a href=x>y"):
        seconds = []
        for n in (20_000, 80_000):
            t0 = time.process_time()
            hb.main_text(piece * n)
            seconds.append(time.process_time() - t0)
        assert seconds[1] < 0.5 + 10 * seconds[0], (piece, seconds)


def test_every_given_page_gives_its_article(spark):
    got = {r["page_id"]: (r["text"], r["n_chars"]) for r in hb.op13_main_text(spark, SF_TINY).collect()}
    pages = spark.read.parquet(f"{SF_TINY}/pages.parquet").collect()
    assert len(got) == len(pages) > 0
    for r in pages:
        inner = re.search("<article>(.*?)</article>", r["html"], re.S).group(1)
        text = " ".join(unescape(re.sub("<[^>]*>", " ", re.sub("</?b>", "", inner))).split())
        assert got[r["page_id"]] == (text, len(text))


def test_rows_and_edges(spark):
    rows = [(1, "u", "<p>x</p>"), (1, "u", "<p>x</p>"), (None, None, "<p>y"), (2, "v", None), (3, "w", ""), (4, "z", "<article>" + f"<p>{LONG}</p>" * 3000)]
    df = spark.createDataFrame([(*r, "clash", 5) for r in rows], SCHEMA)
    got = sorted(map(tuple, hb.extract(df).collect()), key=repr)
    long = " ".join([LONG] * 3000)
    assert got == sorted([(1, "u", "x", 1), (1, "u", "x", 1), (None, None, "y", 1), (2, "v", "", 0), (3, "w", "", 0), (4, "z", long, len(long))], key=repr)
    assert hb.extract(df).columns == ["page_id", "url", "text", "n_chars"] and hb.extract(df.limit(0)).count() == 0
