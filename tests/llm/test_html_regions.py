"""Which parts of a page are its text: clusters of regions, ratios inside articles, and what is left out by name."""

import pytest

from tallyframe.llm.html_text import main_text

LONG = "A long paragraph with so many words that it surely is the text of this page. " * 4
LONG = LONG.strip()


@pytest.mark.parametrize(
    ("html", "text"),
    [
        (f"<div><p>{LONG}</p><ul><li>one</li></ul><p>Short.</p></div>", f"{LONG} one Short."),
        (f"<body><div><p>{LONG}</p></div><div><p>Short.</p></div><div>Tiny</div></body>", f"{LONG} Short. Tiny"),
        (f"<body><section><div>{LONG}</div></section><section><div>s.</div></section></body>", f"{LONG} s."),
        (f"<table><tr><td>{LONG}<td>Short.</tr><tr><td>x</td></tr></table>", f"{LONG} Short. x"),
        (f"<div><section><p>{LONG}</div></section></div><p>{LONG}", f"{LONG} {LONG}"),
    ],
)
def test_text_after_nested_and_beside(html, text):
    assert main_text(html) == text


def test_many_open_elements():
    assert main_text("<div><section>" * 20_000 + LONG + "</div></ul>" * 20_000) == LONG


BOX = '<div class="mc-box"><p>Buy</p><p>now</p><p>cheap</p><p>offer</p><p>here</p></div>'


def test_ratios_decide_inside_an_article():
    page = f"<article><div><h1>Title</h1></div>{BOX}<p>{LONG}</p><p>Short.</p><p>{LONG}</p>{BOX}<p>{LONG}</p></article>"
    assert main_text(page) == f"Title {LONG} Short. {LONG} {LONG}"


def test_article_without_content():
    page = f"<body><article>{BOX}</article><div><p>{LONG}</p><p>{LONG}</p><p>{LONG}</p></div></body>"
    assert main_text(page) == f"{LONG} {LONG} {LONG}"


@pytest.mark.parametrize(
    ("html", "text"),
    [
        (f'<article class="post no-sidebar"><p>{LONG}</p></article>', LONG),
        (f'<main class="has-sidebar"><p>{LONG}</p></main>', LONG),
        (f'<article class="sidebar"><p>{LONG}</p></article>', LONG),
        (f'<article class="entry share-enabled"><div class="article-header"><h1>T</h1></div><p>{LONG}</p></article>', f"T {LONG}"),
        (f'<article><div class="header"><h1>T</h1></div><p>{LONG}</p></article>', f"T {LONG}"),
        (f'<article><p>{LONG}</p><p class="share">Share<p>End.</p><div class="related-posts"><p>More</p></div></article>', f"{LONG} End."),
        # articles in what is dropped and closed
        (f'<article><p>{LONG}</p></article><div class="related"><article>{LONG}</article></div>', LONG),
        (f'<article><p>{LONG}</p></article><section id="comments"><article>{LONG} no</article><article>no</article></section>', LONG),
        (f'<article><p>{LONG}</p></article><aside><div><article>{LONG}</article></div></aside>', LONG),
        # dropped and never closed
        (f"<div><nav><a>menu<article><p>{LONG}</p></article></div>", LONG),
        (f'<div class="related">menu<article><p>{LONG}</p></article>', LONG),
        (f"<div><nav><a>menu</div><p>{LONG}</p>", LONG),
        # what holds most of the text
        (f'<div class="widget"><p>{LONG}</p></div>', LONG),
        (f'<form id="all"><div class="sidebar">no</div><article><p>{LONG}</p></article></form>', LONG),
        (f'<div hidden><p>{LONG}</p></div><p>shown</p>', "shown"),
        (f'<span class="ad">no <span>no</span> no</span><p>{LONG}</p>', LONG),
    ],
)
def test_dropped_by_name(html, text):
    assert main_text(html) == text


def test_many_open_drops():
    assert main_text('<nav>x<div class="ad">y' * 20_000 + "<main>" + LONG + "</div></p>" * 20_000) == LONG


ARTICLE = f"<article><h1>T</h1><p>{LONG}</p>%s<p>{LONG}</p><p>{LONG}</p>%s</article>"


@pytest.mark.parametrize(
    ("middle", "end", "text"),
    [
        ('<table class="data"><tr><td>1<td>2</tr><tr><td>3<td>4</tr></table>', "", "1 2 3 4"),
        ('<ol class="steps"><li>Cut<li>Fold<li>Glue</ol>', "", "Cut Fold Glue"),
        ('<p class="warning">Hot!</p>', "", "Hot!"),
        ('<header><p class="subtitle">Sub</p><p class="dek">Dek</p></header>', "", "Sub Dek"),
        ('<ul><li><a href="#">one</a></li><li><a href="#">two</a></li><li>three</li></ul>', "", "one two three"),
        ("", '<div class="note"><p>By</p><p>the</p><p>way</p></div>', "By the way"),
        ('<div class="post-comments"><p>I like it</p></div>', "", ""),
        ("", '<div class="comments__list"><p>I like it</p></div>', ""),
        ("", f'<section class="reader-comments"><p>{LONG}</p></section>', ""),
        ('<div class="mc-box">Buy now</div>', '<div class="mc-box">Buy this</div>', ""),
        (BOX, BOX.replace("cheap", "soon"), ""),
        ("", '<div class="more"><p><a href="#">Other page</a></p><p><a href="#">Next page</a></p></div>', ""),
    ],
)
def test_parts_of_an_article(middle, end, text):
    want = f"T {LONG} {text} {LONG} {LONG}" if middle else f"T {LONG} {LONG} {LONG} {text}"
    assert main_text(ARTICLE % (middle, end)) == " ".join(want.split())


@pytest.mark.parametrize("name", ["no-comments", "has-comments", "comments-open", "post-with-comments", "recommended-by-none-at-all"])
def test_names_of_states(name):
    assert main_text(f'<div class="{name}"><article><p>{LONG}</p></article></div>') == LONG


def test_wrapped_paragraphs_stay():
    page = f'<article><div class="par">{LONG}</div><p>{LONG}</p><div class="par">Short.</div><p>{LONG}</p></article>'
    assert main_text(page) == f"{LONG} {LONG} Short. {LONG}"


@pytest.mark.parametrize("part", ["<!--", "<!-- a ", "<a title='", "<!", "</", "<![CDATA[", "<?", "<p ", "<!-- <p>", "<"])
def test_what_is_never_closed_takes_no_time(part):
    import time

    start = time.perf_counter()
    assert main_text(f"<p>{LONG}</p>" + part * (1_000_000 // len(part))).startswith(LONG)
    assert main_text(f"<p>{LONG}</p><!-- --> " + part * 1000 + "<p>").startswith(LONG)
    assert time.perf_counter() - start < 5
    assert main_text(f"<script>'<!--'</script><article><p>{LONG}</p></article>") == LONG
