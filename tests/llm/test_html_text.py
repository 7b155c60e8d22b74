"""Extraction on pages written for it, and on the pages table."""

import html
import re

from casebook.llm.html_text import extract, extract_text, op5_html_text

LONG = "A long paragraph, with commas, and enough words to be scored as text of the article."


def test_cases():
    page = f"""<!doctype html><head><title>T</title><style>p{{}}</style><script>var a="<p>no</p>";</script></head><body>
    <nav><ul><li><a href=/>Home</a></ul></nav><header><h2>Site</h2></header>
    <div id="content"><h1>Title</h1><p>{LONG}<p>Second <b>bo</b>ld&amp;co<br>line.<div class="ad">Buy, buy, buy this now, please, it is cheap.</div>
    <ul><li>one<li>two</ul><form><p>Subscribe here</p></form><!-- no --><div class="comments"><p>Nice post, thanks, I liked it very much indeed.</p></div></div>
    <aside><p>{LONG}</p></aside><footer>&copy; me</footer>"""
    assert extract(page) == f"Title {LONG} Second bold&co line. one two"
    cases = {"": "", "plain text only": "plain text only", "<p>a<p>b": "a b", "<b></b>": "", "<p>": "", "</div></p>x": "x",
             "<ul><li><a href=x>one</a><li><a href=y>two</a></ul>": "",
             "<article><header><h1>T</h1></header><p>x &lt;b&gt; y</p><footer>f</footer></article>": "T x <b> y",
             "<p>a &#x41;&nbsp;b &unknown; &amp;lt;</p>": "a A b &unknown; &lt;", "<p>a\n\t b</p>\n\n<p> c </p>": "a b c"}
    for page, want in cases.items():
        assert extract(page) == want, page


def test_deep_and_long_pages():
    assert extract("<div>" * 30_000 + "<p>" + LONG) == LONG
    body = "".join(f"<p>{LONG} {i}</p>" for i in range(5000))
    assert extract(f"<article>{body}</article>") == " ".join(f"{LONG} {i}" for i in range(5000))


def test_pages_table(spark):
    sf = "/root/testdata/sf0.1"
    out = {r.page_id: r for r in op5_html_text(spark, sf).collect()}
    pages = spark.read.parquet(f"{sf}/pages.parquet").collect()
    assert len(out) == len(pages)
    for r in pages:
        a = re.search("<article>(.*)</article>", r.html, re.S)[1]
        a = re.sub("<[^>]*>", "", re.sub(r"</?(p|h1|br)\b[^>]*>", " ", a))
        want = " ".join(html.unescape(a).split())
        assert (out[r.page_id].text, out[r.page_id].n_chars, out[r.page_id].url) == (want, len(want), r.url)


def test_edge_rows(spark):
    df = spark.createDataFrame([(1, "u", None, 1), (None, None, "<p>x", 2), (1, "u", None, 1), (2, "", "", 3)],
                               "page_id long, url string, html string, text int")
    assert sorted(map(repr, extract_text(df).collect())) == sorted(map(repr, [
        *[type(df.first())(page_id=1, url="u", text="")] * 2, type(df.first())(page_id=None, url=None, text="x"),
        type(df.first())(page_id=2, url="", text="")]))
    assert extract_text(df.limit(0)).count() == 0


def test_article_text_is_kept():
    """Links, compound class names and sibling articles inside an article."""
    cases = {
        f"<article><h1><a href=x>Linked headline</a></h1><p>{LONG}</p></article>": f"Linked headline {LONG}",
        f"<article><p>{LONG}</p><p><a href=r>See the full report here</a></p></article>": f"{LONG} See the full report here",
        f'<article><div class="section-header"><h2>Part</h2></div><p>{LONG}</p></article>': f"Part {LONG}",
        f'<article><p class="legal">Law.</p><p class="promotion-history">Rose.</p><div class="side by">Both.</div><p>{LONG}</p></article>': f"Law. Rose. Both. {LONG}",
        f"<body><article><p>{LONG}</p></article><article><p>Second, short.</p></article></body>": f"{LONG} Second, short.",
        f'<main><p>{LONG}</p><div class="ad">Buy</div><article class="comment"><p>Nice, thanks.</p></article></main>': LONG,
        f'<article><p>{LONG}</p><div class="share">Share</div><div id="comments"><p>Nice, thanks.</p></div><nav>x</nav></article>': LONG,
    }
    for page, want in cases.items():
        assert extract(page) == want, page


def test_broken_markup():
    cases = {'<p>a <b "x>y</p>': "a y", "<p>1 < 2 and <3</p>": "1 < 2 and <3", "<p>a<!-- b": "a", "<p>a <![CDATA[b & <c>]]> d": "a b & <c> d",
             "<p>a <![CDATA[b": "a <![CDATA[b", "<p>x<a href='q>r'>y</a>": "xy", "<p title='>'>a</p><": "a <", "</>x": "</>x", "<p>a</P >b": "a b",
             "<ul><li>a, b<ul><li>c</ul><li>d</ul>": "a, b c d", "<b><p>x</b>y</p>": "xy"}
    for page, want in cases.items():
        assert extract(page) == want, (page, extract(page))


def test_generated_pages():
    """Pages put together from blocks whose text is known, so that what the
    article says needs no second parser."""
    import random
    rnd = random.Random(3)

    def words(n):
        return " ".join("".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(2, 8))) for _ in range(n))
    clutter = [lambda: f"<nav><ul><li><a href=/>{words(2)}</a></ul></nav>", lambda: f"<aside><p>{words(30)}, {words(9)}.</p></aside>",
               lambda: f"<div class='ad'>{words(12)}</div>", lambda: f"<form><p>{words(9)}</p></form>", lambda: f"<script>var x = '<p>{words(9)}</p>';</script>",
               lambda: f"<section class='comments'><p>{words(12)}, {words(3)}.</p></section>", lambda: f"<!-- {words(5)} -->", lambda: "<style>p{}</style>"]
    for _ in range(150):
        want, body = [], []
        for _ in range(rnd.randint(2, 12)):
            t = words(rnd.randint(1, 40))
            shape = rnd.choice(["<p>{}</p>", "<p>{}", "<h2>{}</h2>", "<p><a href='/x'>{}</a></p>", "<ul><li>{}</ul>", "<blockquote><p>{}</p></blockquote>",
                                "<div class='pull side'>{}</div>", "<table><tr><td>{}</table>", "<figure><figcaption>{}</figcaption></figure>", "<p class=tags>{}</p>"])
            body.append(shape.format(t.replace(" ", rnd.choice([" ", "\n  ", "&nbsp;", " <b> </b>"]))))
            want.append(t)
            if rnd.random() < 0.3:
                body.append(rnd.choice(clutter)())
        outside = [rnd.choice(clutter)() for _ in range(6)]
        page = f"<html><head><title>{words(3)}</title></head><body><header>{words(4)}</header>{''.join(outside[:3])}<article>{''.join(body)}</article>{''.join(outside[3:])}<footer>{words(5)}</footer>"
        assert extract(page) == " ".join(want)


def test_time_grows_with_the_page():
    import time
    shapes = [lambda n: "<ul><li>text" * n, lambda n: "<div>some words of text that are long enough" * n, lambda n: '<a "' * n, lambda n: "<![CDATA[" * n,
              lambda n: "<div>" * n + "</b>" * n + "</p>" * n, lambda n: "<i><div>" + "<b>" * n + "</i>" * n, lambda n: "<b>" * n + "<div>x</div>" * n,
              lambda n: "<div>" * n + "<li>x" * n, lambda n: "<a '>' " * n + '"', lambda n: "<div>" * n + f"<p>{LONG}</p>" * n, lambda n: "<table><tr><td>x" * n]
    for shape in shapes:
        took = []
        for n in (3000, 24_000):
            t = time.process_time()
            extract(shape(n))
            took.append(time.process_time() - t)
        assert took[1] < 20 * took[0] + 1, shape(2)
