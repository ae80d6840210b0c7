"""Main text: marked and unmarked pages, furniture, references, edge rows."""

import html as html_lib
import re

import pytest

from ebbflow.llm import html_text
from ebbflow.llm.html_text import NAMES, main_text
from ebbflow.llm.queries import op3_html_text

RICH = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body class="no-sidebar">
<div id="cookieConsent">We use cookies on this site, please accept all of them before reading on here.</div>
<header><h1>Site name</h1></header><nav><ul><li><a href=x>Home</a><li><a href=y>About</a></ul></nav>
<div class="content"><article class="post has-comments"><header><h1>Title &amp; more</h1></header>
<p>First   paragraph,\n with <b>bold</b> and <a href=z>a link</a>.<p>Short.
<div class="ad">Buy now</div><aside>Related</aside><ul><li>one<li>two</ul>
<script>var x = "<p>no</p>";</script><p><a href=q>Only a link</a></p><table><tr><td>a</td><td>b &lt; c</td></tr></table>
<form><input><label>Mail</label><button>Send</button></form><section class="comments"><p>Nice post, I have read it all twice.</p></section>
<footer>Filed under x</footer></article></div><div class="sidebar"><p>Popular things that many read, and a long line of them.</p></div>
<footer>&copy; 2020</footer></body></html>"""

UNMARKED = """<html><body><div><a href=a>Home</a> <a href=b>News</a></div><div>Menu</div>
<div class=x><h2>The title</h2><p>%s</p><p>Short end.</p></div><div class="comment"><p>%s</p></div><p>%s</p><div><a href=u>%s</a></div>"""


def test_marked_page():
    want = ["Title & more", "First paragraph, with bold and a link.", "Short.", "one", "two", "Only a link", "a", "b < c"]
    assert html_text.main_text(RICH).split("\n\n") == want


def test_unmarked_page():
    long = "Words of the article go on for some time. " * 5
    page = UNMARKED % (long, long, "Second part. " * 12, "many links " * 20)
    assert html_text.main_text(page).split("\n\n")[-3:] == [long.strip(), "Short end.", ("Second part. " * 12).strip()]
    assert "many links" not in html_text.main_text(page) and "Home" not in html_text.main_text(page)
    assert html_text.main_text("<p>Hello</p>") == "Hello"
    assert html_text.main_text("just text &eacute;&#8364;") == "just text é€"


def test_regions_follow_the_window_sums():
    assert html_text.regions([0, 5, 0, 0, 0, 5, 90, 0, 7, 0, 0, 0, 3], 80) == [(5, 9)]
    assert html_text.regions([5, 0, 0, 0, 1], 1) == [(0, 1), (4, 5)]
    assert html_text.regions([], 1) == []


def article_of(page):
    """Plain reading of the generated pages: blocks between the article tags."""
    inside = re.search(r"<article>(.*?)</article>", page, re.S)[1]
    blocks = re.split(r"</?(?:p|h1)>", inside)
    texts = [" ".join(html_lib.unescape(re.sub(r"<[^>]*>", " " if "<br" in b else "", b)).split()) for b in blocks]
    return "\n\n".join(t for t in texts if t)


def test_query_matches_the_marked_articles(spark):
    pages = {r["page_id"]: r for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()}
    rows = op3_html_text(spark, "/root/testdata/sf0.01").collect()
    assert len(rows) == len(pages)
    for r in rows:
        assert r["text"] == article_of(pages[r["page_id"]]["html"])
        assert r["n_chars"] == len(r["text"]) and r["url"] == pages[r["page_id"]]["url"]


def test_edge_rows(spark):
    rows = [(1, "u", None), (2, None, ""), (None, "u", "<p>x"), (4, "u", "<" * 2000), (5, "u", "<article><p>" + "long words " * 100_000), (5, "u", "<!-- open"), (6, "u", "<div>" * 5000 + "deep")]
    frame = spark.createDataFrame([(*r, "t", 1) for r in rows], "page_id long, url string, html string, text string, n_chars int")
    got = {(r["page_id"], r["n_chars"]): r["text"] for r in html_text.extract(frame).collect()}
    assert got[(1, 0)] == "" and got[(2, 0)] == "" and got[(None, 1)] == "x" and got[(5, 0)] == "" and got[(6, 4)] == "deep"
    assert got[(5, 1_099_999)] == ("long words " * 100_000).strip()
    assert html_text.extract(frame.limit(0)).count() == 0


def test_generated_pages_without_their_marks():
    """The distribution finds the same text when the article tags are gone or are plain containers."""
    import pyarrow.parquet as pq

    for page in pq.read_table("/root/testdata/sf0.01/pages.parquet").column("html").to_pylist():
        want = article_of(page)
        for start, end in (("", ""), ("<div class=post>", "</div>")):
            assert html_text.main_text(page.replace("<article>", start).replace("</article>", end)) == want


def test_short_lines_of_the_container_stay():
    long = "Words of the article go on for some time. " * 5
    verses = "".join(f"<p>verse {i}</p>" for i in range(6))
    page = f"<body><div>Menu</div><div class=x>{verses}<p>{long}</p><ul><li>one<li>two<li>three<li>four</ul></div><div>Stray</div><div>lines</div><div>here</div><div>too</div></body>"
    got = html_text.main_text(page).split("\n\n")
    assert got[-11:-2] == [*(f"verse {i}" for i in range(6)), long.strip(), "one", "two"] and got[-2:] == ["three", "four"]
    assert html_text.main_text(f"<body><p>{long}</p><p>a</p><p>b</p><p>c</p><p>d</p></body>").split("\n\n")[1:] == ["a", "b", "c", "d"]


def test_the_distribution_selects_on_marked_pages_too():
    long = "Words of the article go on for some time. " * 10
    teasers = "<article><h3>Next one</h3></article><article><h3>Last one</h3></article>"
    assert html_text.main_text(f"<div class=x><p>{long}</p><p>{long}</p></div><nav>x</nav>{teasers}") == "\n\n".join([long.strip()] * 2)
    assert html_text.main_text(f"<div>Short outside.</div><article><p>{long}</p><p>end</p></article><div>Also outside.</div>") == f"{long.strip()}\n\nend"


def test_comment_openings_that_open_no_comment():
    article = "<article><p>The text</p><p>of the page</p></article>"
    want = "The text\n\nof the page"
    for before in (
        '<script>var s = "<!--";</script>',
        "<script><!-- old style block\nrun();</script>",
        "<style><!-- p {}</style>",
        "<form><textarea>a <!-- b</textarea></form>",
        "<head><title>a <!-- b</title></head>",
        '<p title="<!--"></p>',
    ):
        assert html_text.main_text(before + article) == want
        assert html_text.main_text(article + before) == want
        assert html_text.main_text(before + article + "<!-- x --><p>y</p>") == want
    assert html_text.main_text(article + "<!-- never closed <article><p>hidden</p></article>") == want
    assert html_text.main_text("<!-- never closed " + article) == ""


PARAGRAPHS = ["One rather long paragraph about the harbour, its boats and the people who go out with them every morning.", "Another paragraph, as long as the first, that tells what they bring back and to whom they sell it in the evening."]


def page(body):
    return f"<html><body><nav><a href=x>Home</a><a href=y>News</a></nav>{body}<footer>All rights reserved by the publishers of this page</footer></body></html>"


def test_a_form_around_the_page_is_no_form():
    text = "".join(f"<p>{p}</p>" for p in PARAGRAPHS)
    controls = '<input name=q value=go><label>Your search</label><select><option>one<option>two</select><button>Send it</button>'
    for inner in (f"<article>{text}</article>", f"<div>{text}</div>", text):
        got = main_text(page(f'<form action="/page.aspx">{controls}{inner}{controls}</form>'))
        assert got == "\n\n".join(PARAGRAPHS)
    signup = '<form><p>Write your address here and we send you all that is new, every day and for nothing at all, to read at home.</p><input name=mail></form>'
    assert main_text(page(f"<article>{text}{signup}</article>")) == "\n\n".join(PARAGRAPHS)
    assert main_text(page(f"<div>{text}</div>{signup}")) == "\n\n".join(PARAGRAPHS)


@pytest.mark.parametrize("word", sorted(NAMES))
def test_a_word_of_furniture_in_a_name_of_contents_erases_nothing(word):
    text = "".join(f"<p>{p}</p>" for p in PARAGRAPHS)
    want = "\n\n".join(PARAGRAPHS)
    assert main_text(page(f'<article><p>{PARAGRAPHS[0]}</p><section class="{word}-guide"><p>{PARAGRAPHS[1]}</p></section></article>')) == want
    assert main_text(page(f'<div class="content {word}-studies">{text}</div>')) == want
    assert main_text(page(f'<article>{text}<ul class="{word}-free"><li>a short line</li></ul></article>')) == want + "\n\na short line"
    advert = f'<div class="{word}-box-2"><p>Buy the finest things here today and never think again of what it was that you came to read about.</p></div>'
    assert main_text(page(f"<article>{text}{advert}</article>")) == want
    assert main_text(page(f"<div>{text}</div>{advert}")) == want
