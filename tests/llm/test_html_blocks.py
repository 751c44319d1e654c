import html
import random
import re
import time

import pytest
from llm_helpers import SF, empty

from berthline.llm import html_blocks as H
from berthline.llm import queries
from berthline.llm.common import table

PAGE = """<!DOCTYPE html><html><head><title>Not this</title><style>p{}</style>
<script>var x = "<p>nor this</p>";</script></head><body>
<header class="site-header"><a href="/">Home</a></header><nav><ul><li>Menu</ul></nav>
<div class="cookie-notice">We use cookies</div>
<article class="post ad-free"><header><h1>The &amp; title</h1></header>
<p>First   <b>para</b>graph,<br>with&nbsp;a break<p>second &eacute; <i>one</i>
<div class="advert">Buy now</div><ul><li>point one<li>point two</ul>
<form><p>Your mail</p><input name=q><button>Send</button></form>
<aside>Sidebar</aside><!-- <p>hidden</p> --><p>Last &lt;p&gt;.</p>
<div id="comments"><p>I liked it</p></div></article>
<footer>&copy; us</footer></body></html>"""


def test_article_page():
    assert H.main_text(PAGE).split("\n") == [
        "The & title", "First paragraph, with a break", "second é one", "point one", "point two", "Last <p>."]


def test_unmarked_page_keeps_text_between_surge_and_dive():
    body = "".join(f"<div>{'running text of the page ' * 5}</div>" for _ in range(4))
    page = (f"<body><div><a href=x>Home</a> <a href=y>News</a></div><div class=sidebar>side {'words ' * 60}</div>{body}"
            f"<div>Short end.</div><nav>x</nav><p>stub</p></body>")
    lines = H.main_text(page).split("\n")
    assert len(lines) == 5 and lines[-1] == "Short end." and all(x.startswith("running") for x in lines[:4])


@pytest.mark.parametrize("page", [None, "", "   ", "<html></html>", "<p></p>", "<script>x", "<!-- open", "<", "</p></div>"])
def test_no_text(page):
    assert H.main_text(page) in ("", "<")


def test_cut_off_and_wrongly_nested():
    assert H.main_text("<article><p>one</b></p><p><b>two</p><p>three</article><p>outside</p>") == "one\ntwo\nthree"
    assert H.main_text("<article><h1>t</h1><p>cut off here") == "t\ncut off here"
    assert H.main_text("<main><p>a</p></main>") == "a"


TEXT = "".join(f"<p>{'running text of the page ' * 5}</p>" for _ in range(4))


@pytest.mark.parametrize("name", ["layout has-sidebar", "no-sidebar", "sidebar", "social", "page-with-comments"])
def test_wrappers_round_the_article_stay(name):
    page = f'<body><div class="{name}"><article>{TEXT}</article><div class="sidebar">side</div></div></body>'
    assert H.main_text(page).count("running text") == 20 and "side" not in H.main_text(page)


@pytest.mark.parametrize("tag", ["form", "aside", 'div id="search"', "div hidden", "header", "nav"])
def test_wrappers_round_most_of_the_text_stay(tag):
    for inner in (TEXT, f"<article>{TEXT}</article>"):
        page = f"<body><div class=ad>Buy now</div><{tag}>{inner}</{tag.split()[0]}><footer>us</footer></body>"
        assert H.main_text(page).count("running text") == 20
        assert "Buy" not in H.main_text(page) and "us" not in H.main_text(page).split()


def test_headings_and_sections_named_by_such_words_stay():
    inner = ('<h2 id="related-work">Related</h2><p>one</p><section id="social-impact"><h2 id="search">Search</h2><p>two</p>'
             '</section><section id="search"><p id="menu">three</p></section><p><a id="share">four</a></p>')
    assert H.main_text(f"<article>{inner}</article>").split("\n") == ["Related", "one", "Search", "two", "three", "four"]


def test_names_of_parts_are_still_dropped():
    for name in ("related-posts", "share_buttons", "cookie-notice", "sidebar widget", "post-comments"):
        assert H.main_text(f'<article><p>one</p><div class="{name}">no</div><p>two</p></article>') == "one\ntwo"
    replies = f'<div id="comments"><article class="comment">{TEXT}</article></div>'
    assert H.main_text(f"<article><p>short</p></article>{replies}") == "short"


def test_text_beside_a_teaser_article():
    body = TEXT.replace("<p>", "<div>").replace("</p>", "</div>")
    for name in ("card", "comment", "related"):
        page = f'<body><article class="{name}"><p>A teaser.</p></article><nav>x</nav>{body}</body>'
        assert H.main_text(page).count("running text") == 20 and "teaser" not in H.main_text(page)


def test_block_sums_choose_beside_an_article():
    page = (f"<body><div>Share this page with others.</div><article><h1>Title</h1>{TEXT}{TEXT}</article><div>Menu</div>"
            f"<nav>x</nav>{TEXT.replace('running', 'further')}<nav>y</nav><div>{'side ' * 20}</div></body>")
    got = H.main_text(page)
    assert got.startswith("Title\n") and got.count("running text") == 40 and got.count("further text") == 20
    assert not any(x in got for x in ("Share", "Menu", "side"))


def test_long_page():
    page = "<article>" + "<p>some words</p>" * 20000 + "</article>"
    assert H.main_text(page).count("\n") == 19999
    deep = "<div>" * 3000 + "<article><p>deep</p></article>"
    assert H.main_text(deep) == "deep"


def test_spans():
    # a single line without weight is no dive: the block sum reaches over it
    assert H.kept_spans([0, 5, 50, 60, 3, 0, 4, 0, 0, 0, 90, 0], 3, 80) == [(1, 7), (10, 11)]
    assert H.kept_spans([0, 90, 0, 0, 0, 79, 0, 1], 3, 80) == [(1, 2), (5, 8)]
    assert H.kept_spans([], 3, 80) == []


def plain_spans(weights, window, surge):
    """By the definition, every block sum added up anew."""
    total = [sum(weights[i:i + window]) for i in range(len(weights))]
    kept, inside = set(), False
    for i, w in enumerate(weights):
        inside = total[i] > 0 if inside else w > 0 and total[i] >= surge
        if inside:
            kept.add(i)
    return kept


def test_spans_by_adding_up_every_block():
    rng = random.Random(5)
    for _ in range(300):
        weights = [rng.choice([0, 0, 0, 1, 20, 60, 200]) for _ in range(rng.randrange(30))]
        window, surge = rng.choice([1, 2, 3, 5]), rng.choice([1, 50, 80, 300])
        got = [i for a, b in H.kept_spans(weights, window, surge) for i in range(a, b)]
        assert len(got) == len(set(got)) and set(got) == plain_spans(weights, window, surge)


BLOCK = re.compile("</?(?:p|div|h1|h2|ul|li|article|body|html|footer|nav|header|br)\\b[^>]*>")


def test_pages_without_article_marks_by_adding_up_every_block(spark):
    """The given pages, their article's tags and all dropped parts taken out: plain block sums
    over the lines choose the same text."""
    chosen = 0
    for r in table(spark, SF, "pages").collect():
        body = re.search("<article>(.*?)(?:</article>|$)", r.html, re.S)[1]
        page = f"<body><p>{'Menu of the page ' * 2}</p><hr><div id=menu>x</div><nav>x</nav><aside>y</aside>{body}</body>"
        lines = [" ".join(html.unescape(re.sub("<[^>]*>", "", b)).split()) for b in BLOCK.split(body.replace("<br>", " "))]
        lines = [f"{'Menu of the page ' * 2}".strip(), "", "", "", *filter(None, lines)]
        weights = [len(x) for x in lines]
        want = plain_spans(weights, 3, min(80, max(sum(weights[i:i + 3]) for i in range(len(weights)))))
        if "<a" not in body:
            assert H.main_text(page) == "\n".join(lines[i] for i in sorted(want) if lines[i])
            chosen += 1
    assert chosen > 100


@pytest.mark.parametrize("section", ["<![foo[bar]]>", "<![CDATA[a > b]]>", "<![if !IE]>", "<![endif]>", "<![>", "<!x>", "<?php x?>"])
def test_declarations_within_the_text(section):
    assert H.main_text(f"<article><p>one</p>{section}<p>two</p></article>") == "one\ntwo"


@pytest.mark.parametrize("unit", ["<b>", "<b>x", "<b></i>", "<div>x", "<p>x", "<li>x", "<a>x", "<article>x", "<a ", "<!--", "<![",
                                  "<![foo[", "</", "<td>x", "<span></p>"])
def test_time_grows_with_the_page_only(unit):
    start = time.monotonic()
    H.main_text("<article><p>text</p>" + unit * 50_000)
    assert time.monotonic() - start < 20


def test_paragraphs_keep_their_text_whatever_they_are_about():
    assert H.main_text('<article><p>One.</p><p class="share">Share price rose.</p><p class="notice">Our notice</p></article>') \
        == "One.\nShare price rose."
    assert H.main_text("<body><p>The only paragraph of this page has fifty letters.") != ""
    text = "<p>" + "running text " * 10 + "</p>"
    page = f"<body>{text}<p><a href=x>A paragraph that is a link</a></p>{text}<ul><li><a>Menu</a><li><a>Home</a><li><a>Us</a></ul>"
    assert H.main_text(page).split("\n")[1] == "A paragraph that is a link" and "Menu" not in H.main_text(page)
    # stretches of an article each keep their text, however short
    assert H.main_text("<article><p>a</p></article><div>" + "menu " * 3 + "</div><article><p>bc</p></article>") == "a\nbc"


def test_query_against_the_marked_articles(spark):
    pages = {r.page_id: r for r in table(spark, SF, "pages").collect()}
    got = queries.REGISTRY["op6_html_blocks"](spark, SF).collect()
    assert len(got) == len(pages)
    for r in got:
        inner = re.search("<article>(.*?)(</article>|$)", pages[r.page_id].html, re.S)[1]
        blocks = (" ".join(html.unescape(re.sub("</?b>", "", b)).split()) for b in re.split("</?(?:p|h1)>|<br>", inner))
        assert r.text == "\n".join(filter(None, blocks)) and r.n_chars == len(r.text) and r.url == pages[r.page_id].url


def test_odd_rows(spark):
    rows = [(1, "u", None, "x"), (1, "u", None, "x"), (None, None, "<article><p>a</p></article>", None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = sorted(((r.page_id, r.url, r.text, r.n_chars) for r in H.extract(df).collect()), key=str)
    assert got == sorted([(1, "u", "", 0), (1, "u", "", 0), (None, None, "a", 1)], key=str)
    assert H.extract(empty(spark, "page_id long, url string, html string")).collect() == []
