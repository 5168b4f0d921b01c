from __future__ import annotations

import re
import time

import pytest

from storelake.llm import html_extract
from storelake.llm.html_extract import main_text

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p>";</script></head>
<body><header>Site name</header><nav><ul><li><a href="/">Home</a></li><li><a href="/x">Menu</a></li></ul></nav>
<div class="cookie-notice">We use cookies</div><aside>Side words of the bar</aside><!-- <p>no</p> -->
<article><header><h1>The  title &amp;\n more</h1></header><p>First <b>bold</b>word &lt;here&gt;&nbsp;and on.
<div class="ad">Buy this now please</div><p>Second<br>line</p><form><label>Name</label><input></form>
<p>End.</p></article>
<section id="comments"><p>Nice read, thank you so much for this article</p></section>
<footer>&copy; 2020 all rights reserved by us and others</footer></body></html>"""


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (PAGE, "The title & more First boldword <here> and on. Second line End."),
        (None, ""), ("", ""), ("<p></p>", ""), ("only text", "only text"), ("a < b & c", "a < b & c"),
        ("<p>cut off <b>here", "cut off here"), ("<p>open tag <a href='x", "open tag"),
        ("<script>if (a < b) {}</script><p>shown to all</p>", "shown to all"),
        ("<nav>never closed <p>some words", "never closed some words"),
        ("<p>&eacute;&#233;&#xe9;&am</p>", "ééé&am"),
        ("<div>x</div>" * 3, "x"), ("<p>" + "word " * 50_000, ("word " * 50_000).strip()),
    ],
)
def test_main_text(page, text):
    assert main_text(page) == text


def test_scan_equals_brute_force():
    pages = ["<p>a b</p><div>c</div><p>d e f</p>", "<a>x</a><p>y</p>z<a>q</a>", "<td>u v w</td><p>x</p>"]
    for page in pages:
        parts = list(html_extract.items(page))
        weight = [
            html_extract.WORD_WEIGHT * len(v.split()) if k == "text" else html_extract._weight(v)
            for k, v in parts
        ]
        sums = {(a, b): sum(weight[a:b]) for a in range(len(parts)) for b in range(a + 1, len(parts) + 1)}
        best = max(sums.values())
        texts = set()
        for (a, b), s in sums.items():
            if s > best - 1e-9:
                texts.add(" ".join(" ".join(v for k, v in parts[a:b] if k == "text").split()))
        assert main_text(page) in texts


def test_words_weigh_more_than_nothing_and_tags_less():
    assert html_extract.WORD_WEIGHT > 0
    assert all(w < 0 for w in html_extract.WEIGHTS.values())
    for page in html_extract.LABELLED:
        a, b = page.index(html_extract.START), page.index(html_extract.END)
        want = main_text(page[a + 1 : b])
        plain = page.replace(html_extract.START, "").replace(html_extract.END, "")
        assert main_text(plain) == want


def test_table(spark):
    rows = [(1, "u", PAGE, "x"), (None, None, None, "x"), (2, "v", "", "x"), (2, "v", "<p>hi you", "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = html_extract.extract_pages(df).collect()
    assert [r.n_chars for r in got] == [len(r.text) for r in got]
    assert [r.page_id for r in got] == [1, None, 2, 2] and got[3].text == "hi you"
    assert html_extract.extract_pages(df.limit(0)).count() == 0


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("<div class='content has-sidebar'><p>One two three four.</p></div>", "One two three four."),
        ("<div class='site with-comments'><p>One two three four.</p></div>", "One two three four."),
        ("<div id='comments'><p>One two three four.</p></div>", "One two three four."),
        (
            "<article><p>Five words are in here.</p><section id='related-work'><p>Work of others.</p></section>"
            "<h2 id='search'>How we search</h2><p data-id='ad'>By hand.</p><div class='legal-news'>News of law that all readers of "
            "this page can follow.</div></article>",
            "Five words are in here. Work of others. How we search By hand. News of law that all "
            "readers of this page can follow.",
        ),
        ("<p>Five words are in here.</p><div class='site-footer'>All rights</div>", "Five words are in here."),
        ("<p>Five words are in here.</p><div id=related-posts>All posts</div>", "Five words are in here."),
    ],
)
def test_class_names_drop_only_whole_tokens(page, text):
    assert main_text(page) == text


@pytest.mark.parametrize("name", ["p class=legal", "section id=social", "div class='disclaimer'"])
def test_parts_of_an_article_stay_whatever_their_names(name):
    inside = f"<p>{'word ' * 60}</p><{name}>{'part ' * 20}</{name.split()[0]}><p>{'last ' * 40}</p>"
    assert main_text(f"<nav>a b</nav><article>{inside}</article>") == _text(inside)
    inside = f"<p>{'word ' * 60}</p><div class=ad>buy now</div><p>{'last ' * 40}</p>"
    assert "buy" not in main_text(f"<article>{inside}</article>")


def test_reader_comments_by_other_names_go():
    page = f"<article><p>{'word ' * 50}</p></article><div class=thread><p>{'nice one ' * 15}</p></div>"
    assert main_text(page) == _text("word " * 50)


def test_boxes_count_words_as_a_scan_of_each_does():
    page = PAGE + "<div class=menu><p>a b<div>c<script>no words</div></script>d</div> e <DIV>f"
    boxes = html_extract._Boxes(page)
    boxes._count()
    for m in html_extract._TAG.finditer(page):
        if m[2] is None or m[1] or m.end() not in boxes.words:
            continue
        at, depth, words, name = m.end(), 1, 0, m[2].lower()
        if name in html_extract.RAW:
            continue
        while depth:
            t = html_extract._TAG.search(page, at)
            words += len(page[at : t.start() if t else len(page)].split())
            if not t:
                break
            at = t.end()
            if t[2] and t[2].lower() in html_extract.RAW and not t[1]:
                at = html_extract._raw_end(page, t[2].lower(), at)
            elif t[2] and t[2].lower() == name:
                depth += -1 if t[1] else 1
        assert boxes.words[m.end()] == words


@pytest.mark.parametrize(
    "unit", ["<div class=menu>x ", "<nav>y ", "<div class=ad id=ad><p class=promo>z ", "<a href='q' class=share>"]
)
def test_time_grows_with_the_page(unit):
    page = unit * (3_000_000 // len(unit))
    started = time.process_time()
    main_text(page)
    assert time.process_time() - started < 40


def _text(page):
    return " ".join(re.sub(r"<[^>]*>", " ", page).split())


TABLE = "<table>" + ("<tr>" + "<td>cell</td>" * 4 + "</tr>") * 10 + "</table>"
INSIDE = [
    "<p>" + "before " * 120 + "</p>" + TABLE + "<p>" + "after " * 100 + "</p>",
    "<h1>Two words</h1><p>by <a href=x>Some Body</a></p><p>" + "body " * 80
    + "</p><p>See <a href=y>this</a> and then also <a href=z>that</a> for more.</p>",
    "<p>" + "first " * 60 + "</p>" + "<div>ten words are here in each of the eight blocks</div>" * 8,
    "<p>" + "first " * 40 + "</p><section><h2>Part</h2><div><p>" + "next " * 20 + "</p></div></section>",
]


@pytest.mark.parametrize("inside", INSIDE)
def test_articles_with_tables_links_and_blocks_stay_whole(inside):
    links = "<div><ul>" + "<li><a href=q>Other page</a></li>" * 6 + "</ul></div>"
    assert main_text(f"<body>{links}<article>{inside}</article>{links}</body>") == _text(inside)
    assert main_text(f"<body>{links}<div>{inside}</div>{links}</body>") == _text(inside)
