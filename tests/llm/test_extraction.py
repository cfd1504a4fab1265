"""Main text of pages whose article is known."""

import html
import re

import pytest

from loomwork.llm import extraction

PROSE = "The house on the hill was built for a family that had come to the valley with all of its cattle."
MORE = "It is said that they were the first to bring the plough, and that the old road is named for them."

PAGES = {
    "plain": (f"<p>{PROSE}</p><p>{MORE}</p>", f"{PROSE} {MORE}"),
    "menu": (f"<ul><li><a href='/a'>Home</a><li><a href=/b>News</a></ul><p>{PROSE}", PROSE),
    "no tags": (PROSE, PROSE),
    "short between good": (f"<p>{PROSE}<p>Yes.<p>{MORE}", f"{PROSE} Yes. {MORE}"),
    "short among links": (f"<div><a href=/>One long link to a page</a></div><div>Share</div><div><a href=/>Two</a></div><p>{PROSE}", PROSE),
    "heading before text": (f"<div><a href=/>Menu entry</a></div><h2>The house</h2><p>{PROSE}", f"The house {PROSE}"),
    "references": (f"<p>{PROSE} &lt;b&gt; &amp;amp; caf&eacute; &#x41;&#66;&nbsp;x", f"{PROSE} <b> &amp; café AB x"),
    "white space": (f"<p>{PROSE}\n\t  and <b>bo</b>ld\r\n end </p>", f"{PROSE} and bold end"),
    "script": (f"<script>var a = '<p>{PROSE}</p>'; if (a < 3) </script><p>{MORE}", MORE),
    "open script": (f"<p>{MORE}</p><script>{PROSE}", MORE),
    "style and comment": (f"<style>p{{}}</style><!-- <p>{PROSE}</p> --><p>{MORE}", MORE),
    "open comment": (f"<p>{MORE}<!-- {PROSE}", MORE),
    "quoted end": (f"<p title='a > b'>{MORE}", MORE),
    "form": (f"<form><label>{PROSE}</label><textarea><p>{PROSE}</textarea></form><p>{MORE}", MORE),
    "sidebar": (f"<div class='left side-bar sidebar'><p>{PROSE}</p></div><p>{MORE}", MORE),
    "comments": (f"<article><p>{MORE}</p></article><section id=comments><p>{PROSE}</p></section>", MORE),
    "advert in article": (f"<article><p>{MORE}<div class='ad'>{PROSE}</div><p>{MORE}</article>", f"{MORE} {MORE}"),
    "odd article": ("<article><h1>Xq</h1><p>Xq### zz&&& qq*** ww$$$</p><p>Zq.</p></article>", "Xq Xq### zz&&& qq*** ww$$$ Zq."),
    "header in article": (f"<article><header><h1>Title here</h1><p>By someone</p></header><p>{MORE}</article>", f"Title here {MORE}"),
    "cookie notice": (f"<div id='cookie-notice'>{PROSE}</div><main><p>{MORE}</main>", MORE),
    "hidden": (f"<div style='display:none'><p>{PROSE}</div><div hidden>{PROSE}</div><p>{MORE}", MORE),
    "stray ends": (f"</div></p><p>{PROSE}</span></div><p>{MORE}</body></html></p>", f"{PROSE} {MORE}"),
    "footer": (f"<p>{MORE}</p><footer>&copy; 2020 {PROSE}</footer>", MORE),
    "nothing": ("<nav><a href=/>a</a></nav>", ""),
    "cut tag": (f"<p>{MORE}</p><a href='", f"{MORE} <a href='"),
}


@pytest.mark.parametrize("name", PAGES)
def test_page(name):
    page, want = PAGES[name]
    assert extraction.main_text(page) == want


def test_long_page():
    page = "<article>" + f"<p>{PROSE}</p>" * 20_000 + "</article>"
    assert extraction.main_text(page) == " ".join([PROSE] * 20_000)
    assert extraction.main_text("<div>" * 50_000 + PROSE) == PROSE
    assert extraction.main_text("<" * 100_000).count("<") in (0, 100_000)


def test_rows(spark):
    rows = [(1, "u", PAGES["menu"][0], 5), (None, None, None, 6), (2, "", "", 7), (1, "u", PAGES["menu"][0], 5)]
    got = extraction.extract(spark.createDataFrame(rows, "page_id long, url string, html string, text int")).collect()
    assert sorted(map(tuple, got), key=str) == sorted(
        [(1, "u", PROSE, len(PROSE)), (None, None, "", 0), (2, "", "", 0), (1, "u", PROSE, len(PROSE))], key=str
    )
    assert extraction.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_query(spark):
    from loomwork.llm.queries import op4_extraction

    def article(page):
        inside = re.search(r"<article>(.*?)(</article>|\Z)", page or "", re.S)
        if not inside:
            return ""
        return " ".join(html.unescape(re.sub(r"<(?!b>|/b>)[^>]*>", " ", inside[1]).replace("<b>", "").replace("</b>", "")).split())

    sf_dir = "/root/testdata/sf0.01"
    want = {r.page_id: article(r.html) for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    got = op4_extraction(spark, sf_dir).collect()
    assert len(got) == len(want)
    assert all(r.text == want[r.page_id] and r.n_chars == len(r.text) for r in got)


@pytest.mark.parametrize("name", ["article-comments", "main-sidebar", "article-notice", "main_nav top", "wide article-related"])
def test_compound_names(name):
    for attribute in ("class", "id"):
        page = f"<div class='article-body'><p>{MORE}</p></div><div {attribute}='{name}'><p>{PROSE}</p></div>"
        assert extraction.main_text(page) == MORE
        assert extraction.main_text(f"<main><p>{MORE}</p><div {attribute}='{name}'>{PROSE}</div></main>") == MORE


@pytest.mark.parametrize("name", ["postComments", "user-reviews", "articleComments", "PostSidebar", "siteNAV", "wide user-reviews"])
def test_names_of_several_words(name):
    page = f"<main><p>{MORE}</p><div class='{name}'><p>{PROSE}</p></div></main>"
    assert extraction.main_text(page) == MORE


SHAPES = {
    "open tags": "<p ", "open tags at last ended in quotes": ("<p ", " x='>"), "quotes": "<a \"'", "quoted values": "<a x=\"<b\" ",
    "quoted values, end in quotes": ("<a x=\"<b\" ", "y='>"), "declarations": "<!", "instructions": "<?x ", "open comment": "<!-",
    "equals": "<a = = ", "one quote": "<a b='", "both quotes": "<a b='<a b=\"", "ends": "</p ", "less": "<", "entity": "&#",
    "raw": "<script", "closed raw": "<title>",
}


@pytest.mark.parametrize("name", SHAPES)
def test_odd_pages_take_linear_time(name):
    import time

    one, tail = SHAPES[name] if isinstance(SHAPES[name], tuple) else (SHAPES[name], "")
    page = one * (1_000_000 // len(one)) + tail
    start = time.process_time()
    extraction.main_text(page)
    assert time.process_time() - start < 4


def test_many_stray_ends_take_linear_time():
    import time

    start = time.process_time()
    got = extraction.main_text("<div>" * 60_000 + f"<p>{PROSE}" + "</section>" * 60_000 + "</span>" * 20_000)
    assert got == PROSE and time.process_time() - start < 4


def test_tags_by_the_standard():
    assert extraction.main_text(f"<p title=\"a > b\" it's>{PROSE}") == PROSE  # a quote in a name opens nothing
    assert extraction.main_text(f"<p data-x = '>' y>{PROSE}") == PROSE
    assert extraction.main_text(f"<p>{PROSE} 1 < 2 <3") == f"{PROSE} 1 < 2 <3"
    assert extraction.main_text(f"<div class='ad' <p>{PROSE}</div><p>{MORE}") == MORE
