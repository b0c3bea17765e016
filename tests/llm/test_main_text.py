"""Main text of pages: planted structures, and a plain cut of the tables' articles."""

import re
import time
from html import unescape

from scenetable.llm import main_text as M


def plain(html):
    """The tables' pages have one article of headings and paragraphs."""
    body = re.search(r"<article>(.*?)(</article>|\Z)", html, re.S)[1]
    return "\n".join(t for t in (" ".join(unescape(re.sub(r"<[^>]*(>|\Z)", " ", x)).split()) for x in re.split(r"</?(?:p|h1)>", body)) if t)


def test_tables(spark):
    got = {r.page_id: r.text for r in M.query(spark, "/root/testdata/sf0.01").collect()}
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()
    assert len(got) == len(pages)
    bad = [(got[r.page_id], plain(r.html)) for r in pages if got[r.page_id] != plain(r.html)]
    assert not bad, (len(bad), bad[:2])


PAGE = """<html><head><title>t</title><script>var x="<p>no</p>";</script></head><body><header><h1>Site</h1></header>
<nav><a href="/">Home</a></nav><div id="cookie-notice">We use cookies</div>
<main><h1>Head&amp;line</h1><p>One <b>bold</b>&nbsp; text<p>Two<br>lines &lt;3 <ul><li>first<li>second</ul>
<div class="share">Share!</div><aside>side</aside><form>name<input></form><!-- no <p>x</p> -->
<blockquote>said</blockquote></main><section class="reader comments"><p>first!</p></section><footer>&copy; me</footer></body></html>"""


def test_structures():
    text = "\n".join(t for t, own, _ in M.blocks(PAGE) if own)
    assert text == "Head&line\nOne bold text\nTwo lines <3\nfirst\nsecond\nsaid"
    assert [t for t, own, _ in M.blocks("<p>a<p>b <i>c") if own] == ["a", "b c"]
    assert [t for t, own, _ in M.blocks("plain < text & more <b") if own] == ["plain < text & more"]


def test_long_and_deep_pages_take_time_in_proportion():
    began = time.time()
    for html in ("<a " * 300_000, "<div>" * 60_000 + "x" + "</div>" * 60_000, "<b>" * 60_000 + "</p>" * 60_000, "<div>t" * 50_000, '<a title="' * 60_000, "<a x='>\"<a y=\">'" * 20_000, "<!--" * 200_000, "<script>" * 100_000):
        M.blocks(html)
    assert time.time() - began < 20
    assert [t for t, _, _ in M.blocks("<div>" * 9000 + "deep")] == ["deep"]
    assert [t for t, _, _ in M.blocks('<p title="a > b">x</p><p title="open>y</p>')] == ["x", "y"]


def recount(pages, min_pages=3, share=0.1):
    """Template blocks by a plain recount of each host's innermost non-prose subtrees."""
    hosts, held = {}, {}
    for i, url, html in pages:
        host = url.split("/")[2]
        hosts[host] = hosts.get(host, 0) + 1
        for m in {m for _, _, ms in M.blocks(html) for m in ms if m % 2 == 0}:
            held[host, m] = held.get((host, m), 0) + 1
    drop = {k for k, n in held.items() if n >= min_pages and n >= share * hosts[k[0]]}
    return {i: "\n".join(t for t, own, ms in M.blocks(html) if own and not any((url.split("/")[2], m) in drop for m in ms)) for i, url, html in pages}


def test_template_inside_articles_and_moving_menus(spark):
    menu = lambda k: "<div>" + "".join(f"<div class='{'on' if i == k else ''}'>Part {i}</div>" for i in range(6)) + "</div>"
    pages = [(i, f"http://a.org/{i}", f"<article><h1>Head {i}</h1>{menu(i)}<p>own words {i}</p><p>said by all</p><section>Read more of <b>A</b></section></article>") for i in range(6)]
    pages += [(10 + i, f"http://b.org/{i}", f"<article><p>copy</p><p>own {i % 2}</p><div>note {i}</div></article>") for i in range(6)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in M.main_text(df, prose_share=2.0).collect()}
    assert got == recount(pages) and got[2] == "Head 2\nown words 2\nsaid by all" and got[13] == "copy\nown 1\nnote 3"
    strict = {r.page_id: r.text for r in M.main_text(df).collect()}
    assert strict[2] == "Head 2\nown words 2" and strict[13] == "own 1\nnote 3"
    twice = M.main_text(df.union(df)).collect()
    assert len(twice) == 24 and {(r.page_id, r.text) for r in twice} == set(strict.items())


def test_recurring_pages_keep_their_article(spark):
    page = lambda k, more="": f"<article><div class='content'><h1>Head {k}</h1><p>{'own words ' * 9}{k}</p></div>{more}</article>"
    rows = [(i, f"http://a.org/{i}", page(i)) for i in range(20)]
    rows += [(100 + i, f"http://a.org/copy{i}", page("copy")) for i in range(10)]  # one page under ten urls
    rows += [(200 + i, f"http://a.org/print{i}", page("print", f"<div>variant {i}</div>")) for i in range(4)]  # one article on unlike pages
    rows += rows[:1] * 5
    got = {r.page_id: r.text for r in M.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(got[i] == f"Head {i}\n{'own words ' * 9}{i}" for i in range(20))
    assert all(got[100 + i] == f"Head copy\n{'own words ' * 9}copy" for i in range(10))
    assert all(got[200 + i] == f"Head print\n{'own words ' * 9}print\nvariant {i}" for i in range(4))


def test_long_attributes():
    long = "x" * 400_000
    assert [t for t, _, _ in M.blocks(f'<p data-x="{long} > not text">real</p><p title=\'a > b\'>too</p>')] == ["real", "too"]
    assert [t for t, _, _ in M.blocks('<p data-x="1" title = "a > b" x=\'"\'>real</p>')] == ["real"]


def test_template_by_recurrence(spark):
    site = [(i, f"http://a.org/{i}", f"<div><span>Welcome to A</span></div><div>story {i}</div>", 1) for i in range(5)]
    other = [(9, "http://b.org/1", "<div><span>Welcome to A</span></div><div>b</div>", 1), (None, None, None, 1), (11, "x", "", None)]
    pages = spark.createDataFrame(site + other, "page_id long, url string, html string, row int")
    got = {r.page_id: r.text for r in M.main_text(pages).collect()}
    assert got == {0: "story 0", 1: "story 1", 2: "story 2", 3: "story 3", 4: "story 4", 9: "Welcome to A\nb", None: "", 11: ""}
    assert M.main_text(pages.limit(0)).count() == 0
