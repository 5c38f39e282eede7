"""HTML extraction against the known articles of the given pages, and small pages of other layouts."""

import html
import re
import time

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from tidemark.llm.html_density import Tree, densities, extract, main_text

PROSE = "This is a sentence of some length, as articles have them; it goes on for a while. "
PAGES = "page_id long, url string, html string"


def article_of(page):
    """The blocks of the given pages' one template, read from its article element."""
    inner = re.search(r"<article>(.*?)</article>", page, re.S)[1]
    blocks = [" ".join(html.unescape(re.sub(r"</?b>", "", x).replace("<br>", " ")).split())
              for x in re.split(r"</?(?:p|h1)>", inner)]
    return "\n\n".join(b for b in blocks if b)


def test_given_pages_give_their_articles(spark):
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet")
    got = {r["page_id"]: r for r in extract(pages).collect()}
    rows = pages.collect()
    assert len(got) == len(rows)
    for r in rows:
        want = article_of(r["html"])
        assert got[r["page_id"]]["text"] == want and got[r["page_id"]]["n_chars"] == len(want)
        assert got[r["page_id"]]["url"] == r["url"]


def test_density_finds_the_text_of_unmarked_pages():
    links = "".join(f'<li><a href="/{i}">word{i}</a></li>' for i in range(20))
    text = "".join(f"<p>{PROSE * 3}{i}</p>" for i in range(8))
    want = ["Headline", *[" ".join(f"{PROSE * 3}{i}".split()) for i in range(8)]]
    page = (f"<body><div><ul>{links}</ul></div><div><h1>Headline</h1><div>{text}</div></div>"
            f'<div><ul>{links}</ul></div><div><a href="/">Short</a> <a href="/x">end</a></div></body>')
    assert main_text(page).split("\n\n") == want


@pytest.mark.parametrize("extra", [
    "<nav>Menu</nav>", "<header><p>Site name</p></header>", "<aside>Side</aside>", "<footer>End</footer>",
    '<div class="cookie-notice">We use cookies</div>', '<div id="sidebar-2">Side</div>', '<p class="adBox">Buy</p>',
    "<form><label>Name</label><input></form>", "<script>var a = '<p>no</p>';</script>", "<style>p{}</style>",
    '<section id="comments"><article class="comment"><p>Great!</p></article></section>', "<!-- <p>hidden</p> -->",
    '<div role="navigation">Go</div>', "<div hidden>Later</div>", '<div style="display: none">Later</div>',
    "<noscript>Turn it on</noscript>", "<template><p>x</p></template>"])
@pytest.mark.parametrize("inside", [False, True])
def test_what_is_no_article_goes(extra, inside):
    if extra.startswith("<header") and inside:
        extra = "<nav>Menu</nav>"  # an article's own header is part of it
    body = f"<h1>Title</h1>{extra if inside else ''}<p>One <i>two</i> three.</p><ul><li>a<li>b</ul>"
    page = f"<html><head><title>T</title></head><body>{'' if inside else extra}<article>{body}</article>{extra}</body></html>"
    assert main_text(page) == "Title\n\nOne two three.\n\na\n\nb"


def test_a_wrapper_with_a_telling_name_keeps_the_article_in_it():
    assert main_text('<div class="has-sidebar widget"><form><article><p>Text.</p></article></form></div>') == "Text."


def test_broken_and_odd_markup():
    cases = {
        "": "", "   ": "", "plain text": "plain text", "a &lt; b &amp c &#233;&#x1F600; &nbsp; d &am": "a < b & c é\U0001F600 d &am",
        "<p>a<p>b</b></i>c": "a\n\nbc", "<article><p><b>x<br>y<p>z</article>": "x y\n\nz", "1 < 2 <p>3 > 2": "1 < 2\n\n3 > 2",
        "<article><p>a<!-- gone": "a", "<article>a<script>b": "a", "<p title='a>b' data=\"<p>\">c</p>": "c",
        "<p title=it's>c</p><p>d's</p>": "c\n\nd's", "<a href=\"x>y</p": "y", "<table><tr><td>a<td>b<tr><td>c</table>": "a\n\nb\n\nc",
        "<b>a<p>b</b>c</p>": "a\n\nbc", "</p></div>x": "x", "<article>a<hr>b</article>": "a\n\nb", "<p\n>a\x00b</p>": "a\x00b",
        "<ARTICLE>Up<BR/>down</ARTICLE>": "Up down", "<article><article>inner</article>outer</article>": "inner\n\nouter"}
    for page, want in cases.items():
        assert main_text(page) == want, page


def test_long_and_deep_pages_take_time_in_proportion():
    n = 20_000
    pages = ["<div>" * n + "deep", "<p>" * n, "<li>a" * n, "<li><ul>" + "<span>" * n + "<li>x" * n,
             "<b><div>" + "<i>" * n + "</b>" * n, '<a "' * n, "<!--" * n, "<![" * n, "<a href='" * n, "<table><tr>" * n,
             "<article>" + f"<p>{PROSE}</p>" * n + "</article>", "a" * 5_000_000]
    for page in pages:
        t = time.perf_counter()
        text = main_text(page)
        assert time.perf_counter() - t < 10, page[:20]
    assert len(text) == 5_000_000


def test_density_by_the_formula():
    from math import e, log
    tree = Tree('<div><p>abcdefghij</p><p>klm <a>no</a></p></div>')
    own = [0] * len(tree.name)
    for event in filter(None, tree.events):
        own[event[0]] += len(event[1].replace(" ", ""))
    density, sums = densities(tree.parent, tree.name, own, [True] * len(own))
    want = 10 / 1 * log(10 / 1 * 1 / 1) / log(log(10 / 10 * 1 + 2 / 15 * 10 + e))
    linked = 5 / 1 * log(5 / 2 * 1 / 1) / log(log(5 / 3 * 2 + 2 / 15 * 5 + e))
    assert density[2] == pytest.approx(want) and density[3] == pytest.approx(linked)
    assert sums[1] == pytest.approx(want + linked)


def test_odd_rows_and_empty_table(spark):
    rows = [(None, None, None), (1, "u", None), (2, None, ""), (3, "u", "<p>x</p>"), (3, "u", "<p>x</p>")]
    pages = spark.createDataFrame(rows, PAGES).withColumns({c: F.lit("z") for c in ("text", "n_chars", "own")})
    got = sorted((r["page_id"] or 0, r["url"] or "", r["text"], r["n_chars"]) for r in extract(pages).collect())
    assert got == [(0, "", "", 0), (1, "u", "", 0), (2, "", "", 0), (3, "u", "x", 1), (3, "u", "x", 1)]
    assert extract(pages.limit(0)).count() == 0
