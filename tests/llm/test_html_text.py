import time

import pytest

from cardgeo.llm import html_text as h

PAGE = """<!DOCTYPE html><html><head><title>No</title><style>p{}</style><script>var t="</p>";</script></head><body>
<header><h2>Site</h2></header><nav><ul><li><a href="/a">Home</a></li></ul></nav><div id="cookie-notice">We use cookies, OK?</div>
<article class="post"><header><h1>Über &amp; out</h1></header><p>First   <b>bold</b><br>line, with a comma.
<p>Second &lt;tag&gt; paragraph&nbsp;here; it is longer than the first one.</p><p>Ok.</p>
<div class="share-buttons social">Share this!</div><form><label>Mail</label><input name=x><button>Go</button></form>
<ul><li>One<li>Two</ul><!-- gone --><aside>Also read, please.</aside><noscript>No script.</noscript></article>
<section class="comments"><p>A reader, who writes, at length, with many, many commas, indeed.</p></section>
<div class="ad">Buy!</div><footer>&copy; us</footer></body></html>"""


def test_article_only():
    assert h.main_text(PAGE) == ("Über & out\nFirst bold line, with a comma.\nSecond <tag> paragraph here; it is longer "
                                 "than the first one.\nOk.\nOne\nTwo")


def test_page_without_article_element():
    page = ("<body><div class=menu><a>x</a></div><div class=wrap><div class=text><h1>Head</h1><p>A long paragraph, "
            "with commas, and sentences. Many of them.</p><p>Another long paragraph, quite as long as the first.</p>"
            "<p>Short.</p></div><div class=sidebar><p>Other, things, entirely.</p></div></div><div class=foot>x</div>")
    assert h.main_text(page).split("\n") == ["Head", "A long paragraph, with commas, and sentences. Many of them.",
                                             "Another long paragraph, quite as long as the first.", "Short."]


def test_broken_markup():
    assert h.main_text("<article><p>Open <i>end &amp &bogus; 1 < 2 <p") == "Open end & &bogus; 1 < 2"
    assert h.main_text("<script>only") == "" and h.main_text("plain text") == "plain text"
    assert h.main_text("<article><p hidden>no</p><p style='display:none'>no</p><p>yes</p></article>") == "yes"
    assert h.main_text("<article>" + "<div>" * 3000 + "deep" + "</div>" * 3000) == "deep"


def test_ratios_prefer_text():
    blocks = [b for b in h.blocks_of(PAGE) if not b.element.other]
    fused = h.path_ratios(blocks)
    assert max(fused, key=fused.get) == "/html/body/article/p"


def test_columns(spark):
    rows = [(1, "u", PAGE, "old"), (1, "u", PAGE, "old"), (2, None, None, None), (None, "", "", ""), (3, "u", " \n", "")]
    out = h.extract(spark.createDataFrame(rows, "page_id long, url string, html string, text string")).collect()
    assert sorted((r.page_id or 0, r.text) for r in out) == sorted(
        (i or 0, h.main_text(page)) for i, _, page, _ in rows)
    assert h.extract(spark.createDataFrame([], "page_id long, html string")).collect() == []


LONG = "<p>A long paragraph, with commas, and sentences. Many of them, one after another.</p>" * 4
TEXT = "\n".join(["A long paragraph, with commas, and sentences. Many of them, one after another."] * 4)


@pytest.mark.parametrize("page", [
    f'<body class="has-sidebar"><div>{LONG}</div></body>', f'<div id="main" class="no-comments">{LONG}</div>',
    f"<html><body><form action=x><div>{LONG}</div></form></body></html>", f'<main class="widget">{LONG}</main>',
    f'<body><nav><a>Home</a></nav><div class="share-page"><div class="no-ad">{LONG}</div></div></body>'])
def test_page_wide_elements_are_the_page(page):
    assert h.main_text(page) == TEXT


def test_other_elements_inside_a_block():
    page = ("<article><p>Keep <button>Buy</button>this <label>Mail</label>text, <span class=ad>Ad!</span>all "
            "<span hidden>gone </span><b style='display:none'>x</b>of <i>it</i>.</p>" + LONG + "</article>")
    assert h.main_text(page).split("\n")[0] == "Keep this text, all of it."


def test_comments_longer_than_the_article_stay_out():
    page = f'<body><div class=post>{LONG}</div><div class="comments">{LONG * 3}</div></body>'
    assert h.main_text(page) == TEXT


def test_ratios_decide(monkeypatch):
    """Without article or main, what is kept depends on them; with one, text
    of better ratios elsewhere still wins."""
    links = "".join(f"<li>Link {i}</li>" for i in range(40))
    page = f"<body><div><ul>{links}</ul></div><div><div>{LONG}</div></div></body>"
    assert h.main_text(page) == TEXT
    teaser = f"<body><main><ul>{links}</ul></main><div><div>{LONG}</div></div></body>"
    assert h.main_text(teaser) == TEXT
    monkeypatch.setattr(h, "fused_ratios", lambda blocks: dict.fromkeys((b.element.path for b in blocks), 1.0))
    assert "Link 1" in h.main_text(page) and "Link 1" in h.main_text(teaser)


@pytest.mark.parametrize("page", ['<a "' * 250_000, "<a " * 330_000, "<div>" * 100_000 + "deep", "<b>" * 100_000 + "x</i>" * 100_000,
                                  "<div class=ad>" * 50_000 + "x", "<script>" * 100_000, "</p>" * 250_000, "<!--" * 250_000,
                                  "<a '\">" * 150_000, "<p>x" * 100_000, "<svg>" * 100_000 + ">", "<a \"" * 100_000 + ">" + "<" * 100_000])
def test_hostile_pages_take_linear_time(page):
    at = time.time()
    h.main_text(page)
    assert time.time() - at < 20
    assert len(h.main_text("<article>" + LONG + "</article>" + page)) >= len(TEXT)
