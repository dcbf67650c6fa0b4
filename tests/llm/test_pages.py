"""Pages and archives: articles that must not vanish, hostile markup, WARC members."""

import random
import time

import pytest

from barsmith.llm import decontaminate, html_main, warc

from llm_fixtures import base_words

P = "The lakes of the north are wide, deep, and cold in the long winter months."


def paragraphs(n):
    return "".join(f"<p>{P}</p>" for _ in range(n))


@pytest.mark.parametrize("html,want", [
    (f"<div title='The hidden cost'>{paragraphs(4)}</div>", [P] * 4),
    (f"<div data-hidden='false'><article>{paragraphs(4)}</article></div>", [P] * 4),
    (f"<article>{paragraphs(1)}<p>See <a href='/hidden-lakes'>the blue lakes</a> and a <a title='hidden gem'>gem</a>.</p></article>",
     [P, "See the blue lakes and a gem."]),
    (f"<form action='x'><div class='nav'>a b c</div><article><h1>T</h1>{paragraphs(4)}</article><input></form>",
     ["T", *[P] * 4]),
    (f"<article>{paragraphs(4)}<form><p>Subscribe to our letter, please.</p></form></article>", [P] * 4),
    (f"<div><h2>Head</h2><div class='content'>{paragraphs(4)}</div>Loose text that is long enough.<p>short</p></div>",
     ["Head", *[P] * 4, "Loose text that is long enough.", "short"]),
    (f"<main><article>{paragraphs(2)}</article><article>{paragraphs(3)}</article></main>", [P] * 5),
    (f"<div hidden>{paragraphs(1)}</div><div style='display: none'>{paragraphs(1)}</div><div id=main>{paragraphs(3)}</div>",
     [P] * 3),
    ("<p>one < two &amp; three</p>", ["one < two & three"]),
])
def test_articles_are_kept_whole(html, want):
    assert html_main.main_text(f"<html><body>{html}</body></html>").split("\n") == want


def test_generated_pages_without_an_article_element():
    """Pages put together from an article and boilerplate around it: the text is the article's blocks."""
    rng = random.Random(11)
    for page in range(60):
        body = [" ".join(base_words(page * 50 + i, rng.randrange(12, 60))).capitalize() + ", yes." for i in range(rng.randrange(3, 12))]
        links = "".join(f"<li><a href='/{i}'>{' '.join(base_words(i, 2))}</a></li>" for i in range(8))
        noise = [f"<nav><ul>{links}</ul></nav>", f"<div class='sidebar'><ul>{links}</ul></div>", "<footer>© all rights</footer>",
                 "<div class='cookie-notice'>We use cookies, accept them all.</div>", f"<div id=related><ul>{links}</ul></div>",
                 "<script>if (a < b) { document.write('<p>no</p>') }</script>",
                 "<section class=comments><p>First! A reader wrote this, and more.</p></section>"]
        rng.shuffle(noise)
        cut = rng.randrange(len(noise))
        tag = rng.choice(["div", "section", "td"])
        inner = "".join(f"<p>{b}</p>" if rng.random() < 0.7 else f"<div>{b}</div>" for b in body)
        html = f"{''.join(noise[:cut])}<{tag} class='{rng.choice(['content', 'x', 'post-body'])}'>{inner}</{tag}>{''.join(noise[cut:])}"
        assert html_main.main_text(f"<!doctype html><html><body>{html}</body></html>") == "\n".join(body)


@pytest.mark.parametrize("html", [
    "<div>" * 8000 + "</span>" * 8000, "<b>" * 8000 + "<div>" * 8000, "<header>" * 8000, "<a " * 16000,
    "<p><b>" * 4000 + "</i>" * 8000, "<li>" * 8000, "<td>" * 8000 + "<div>" * 4000 + "</p>" * 8000, "x<i>y</i>" * 20000,
    "<title>" * 16000, "<title " * 16000, "<a x='" * 16000, "<a href" * 16000, "<!--" * 9000])
def test_hostile_markup_stays_fast(html):
    start = time.time()
    html_main.main_text(html)
    warc.title_of(html)
    warc.outlinks(html)
    warc.plain_text(html)
    assert time.time() - start < 5


def test_titles_and_links():
    html = ("<titles>no</titles><TITLE lang=x>A &amp; B\n c</TITLE ><a class='href=no' data-href='/d' HREF = '/one'>x</a>"
            "<a\nhref=/two?a=1&amp;b=2>y</a><a name=z>z</a><abbr href='/no'>n</abbr>")
    assert warc.title_of(html) == "A & B c"
    assert warc.outlinks(html) == ["/one", "/two?a=1&b=2"]
    assert warc.title_of("<title>never ends") == ""


def test_a_cut_member_is_an_error(spark):
    whole = warc._members_of([("r", [("WARC-Type", "metadata"), ("Content-Length", "2")], b"ab")]).column("member")[0].as_py()
    files = spark.createDataFrame([(bytearray(x),) for x in (whole, whole[:2], whole[:-3])], "content binary")
    rows = warc.parse_records(files).collect()
    assert sorted(r["type"] for r in rows) == ["error", "error", "metadata"]


def test_derivatives_in_one_pass_equal_those_of_the_records(spark):
    pages = spark.createDataFrame([(1, "http://a/", "<title>T</title><p>x &amp; y<a href=/l>z</a>"), (2, None, None), (None, "u", "")],
                                  "page_id long, url string, html string")
    one = warc.page_derivative_files(pages).collect()
    steps = warc.derivative_files(warc.responses(pages)).collect()
    assert sorted(map(tuple, one)) == sorted(map(tuple, steps)) and len(one) == 6


def test_words_of_punctuation_stay_fast():
    start = time.time()
    assert decontaminate.plain_words("." * 40_000 + " «Ünï-ça» (a) --x" + "'" * 40_000) == ["ünï-ça", "a", "x"]
    assert time.time() - start < 1
