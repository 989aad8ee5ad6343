"""Main text of pages."""

import html
import re
import time

import pytest

from tallyhouse.llm import html_text
from tallyhouse.llm.queries import op6_main_text

P = "A paragraph of the article that is long enough to count for something."


def own(page):
    return html_text.Page(page).text([])


def wrap(body):
    return f"<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style></head><body>{body}</body></html>"


@pytest.mark.parametrize(
    "page, text",
    [
        ("", ""),
        ("plain text only", "plain text only"),
        (wrap(f"<nav><a href=x>Home</a></nav><article><h1>Title</h1><p>{P}</p></article><footer>foot</footer>"), f"Title\n\n{P}"),
        (wrap(f"<article><p><b>Head.<br><p>{P}</p></article>"), f"Head.\n\n{P}"),
        (wrap(f"<article><p>a&amp;b &lt;x&gt; caf&eacute; &#8212;\n\t z</p><p>{P}</article>"), f"a&b <x> café — z\n\n{P}"),
        (wrap(f"<div class='ad'>Buy<div>now</div></div><main><p>{P}</p><aside>side</aside><p>{P}</p></main>"), f"{P}\n\n{P}"),
        (wrap(f"<article><p>{P}</p><div class='comments'><p>I agree with all of it, and more.</p></div></article>"), P),
        (wrap(f"<article><p>{P}</p><script>var t='</p><p>no';</script><form><p>sign up</p></form><!-- <p>x</p> --></article>"), P),
        (wrap(f"<div id='cookie-notice'>We use cookies</div><div class='content'><p>{P}</p><ul><li>one<li>two</ul></div>"), f"{P}\n\none\n\ntwo"),
        (wrap(f"<div class='sidebar'><p>{P}{P}{P}</p></div><div class='post'><p>{P}</p></div>"), P),
        (wrap(f"<header><p>{P}</p></header><article><header><h1>Title</h1></header><p>{P}</p></article>"), f"Title\n\n{P}"),
        (wrap(f"<article><p>unclosed <i>tags <b>all over<p>{P}"), f"unclosed tags all over\n\n{P}"),
        (wrap(f"<article><p title=\"a > b\">{P}</p><p>1 < 2 and 3 > 2</p></article>"), f"{P}\n\n1 < 2 and 3 > 2"),
        (wrap(f"<article><section><p>{P}</p></section><section><p>{P}</p></section></article>"), f"{P}\n\n{P}"),
        (wrap(f"<div hidden><p>{P}</p></div><article><p>{P}</p></article></div></span>"), P),
        (wrap(f"<div class='layout sidebar-right'><div class='sidebar'><p>{P}</p></div><article><p>{P}</p></article></div>"), P),
        (wrap(f"<div class='has-menu'><div class='text'><p>{P}</p></div><div class='menu'>a b</div></div>"), P),
        (wrap(f"<article><p>{P}</p><section id='comments'><article class='comment'><p>{P}{P}</p></article></section></article>"), P),
        (wrap(f"<article><p>one <span class='ad'>buy</span> two</p><p>{P}</p></article>"), f"one two\n\n{P}"),
        (wrap(f"<article><p>a &<b>amp;</b> b &am<!-- -->p; c</p><p>{P}</p></article>"), f"a &amp; b &amp; c\n\n{P}"),
        (wrap(f"<article><p>If <math><mi>x</mi></math> holds</p><p>{P}</p></article>"), f"If x holds\n\n{P}"),
        (wrap(f"<article><p>{P}</p><noscript><p>Turn scripts on.</p></noscript></article>"), P),
        (wrap(f"<noscript><article><p>{P}</p><p>{P}</p><p>{P}</p></article></noscript>"), f"{P}\n\n{P}\n\n{P}"),
        (wrap(f"<article><p>{P}</p><template><p>{P}</p></template></article>"), P),
        (wrap(f"<article><p>{P}</p><section class='related-work'>{f'<p>{P}</p>' * 3}</section></article>"), "\n\n".join([P] * 4)),
        (wrap(f"<article><p>{P}</p><section class='related'>{f'<p><a href=x>{P}</a></p>' * 5}</section></article>"), P),
        (wrap(f"<article><p>{P}</p><div class='share'><a href=x>Mail</a> to a friend</div><p>{P}</p></article>"), f"{P}\n\n{P}"),
        (wrap(f"<article><p>a <em class='notice'>{P}{P}{P}</em> b</p></article>"), f"a {P}{P}{P} b"),
        (wrap(f"<article><p>a <em class='notice'>short</em> b</p><p>{P}</p></article>"), f"a b\n\n{P}"),
        (wrap(f"<article><div class='notice'><p>{P * 4}</p><div class='share'>Mail it</div></div><p>{P}</p></article>"), f"{P * 4}\n\n{P}"),
        (wrap(f"<div class='overflow-hidden'><div class='text'><p>{P}</p></div></div>"), P),
        (wrap("<article><p>" + "<i>" * 20 + f"{P}<div>{P}</div></article>"), f"{P}\n\n{P}"),
        (wrap(f"<article><ul><li><p>one<li><p>two</ul><p>{P}</p></article>"), f"one\n\ntwo\n\n{P}"),
        (wrap(f"<article><p>{P}</p></article><!-- open <p>x"), P),
        (wrap(f"<article><p>{P}</p></article>") + "<!-- open", P),
        (wrap(f"<nav><ul><li>never closed<article><p>{P}</p></article>"), ""),
    ],
)
def test_pages(page, text):
    assert own(page) == text


def test_long_and_hostile_pages():
    assert own(wrap("<article>" + f"<p>{P}</p>" * 3000 + "</article>")).count(P) == 3000
    own("<div>" * 3000 + P)
    own('<a href="' * 20000)
    own("<!--" * 20000)
    own("<" * 100000)


@pytest.mark.parametrize(
    "page",
    [
        "<div>" * 100_000 + P,
        "<b>" * 50_000 + "x</i>" * 50_000,
        "<ul>" + "<div>" * 50_000 + "<li>x" * 50_000,
        "<li><ul>" + "<div>" * 50_000 + "<li>" + "<b>" * 50_000,
        "<p>" + "<i>" * 50_000 + "<div>x" * 50_000,
        "<article>" + "<div class=share>x" * 100_000,
        "<nav>" + "</div>" * 100_000,
        '<a href="' * 100_000,
        "<table>" + "<tr><td>x" * 50_000,
        "<!--" * 100_000,
        "<script>" * 100_000,
    ],
)
def test_time_in_proportion(page):
    started = time.monotonic()
    own(page)
    assert time.monotonic() - started < 6


def test_host_consensus(spark):
    """A page whose side column is longer than its text follows the path that its host agrees on."""
    side = "<section class='box'>" + f"<p>{P}</p>" * 9 + "</section>"
    usual = [(i, "https://Blog.Test/a", wrap(f"<section class='body-{i}'><p>{P}</p><p>{P}</p></section>"), "x") for i in range(9)]
    odd = (9, "https://blog.test/b", wrap(f"{side}<section class='body-7'><p>Short one.</p></section>"), "x")
    none = [(10, None, None, "x"), (11, "https://blog.test/c", "", "x"), (None, "u", "<p>alone", "x"), (3, *usual[3][1:])]
    df = spark.createDataFrame([*usual, odd, *none], "page_id long, url string, html string, text string")
    got = html_text.extract(df).collect()
    assert sorted(map(str, (r.page_id for r in got))) == sorted(str(r[0]) for r in [*usual, odd, *none])
    texts = {r.page_id: r.text for r in got}
    assert texts[9] == "Short one." and texts[0] == f"{P}\n\n{P}" and texts[10] == texts[11] == "" and texts[None] == "alone"
    assert all(r.n_chars == len(r.text) for r in got)


def test_empty_table(spark):
    assert html_text.extract(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


def test_query(spark):
    folder = "/root/testdata/sf0.01"
    pages = {r.page_id: r for r in spark.read.parquet(f"{folder}/pages.parquet").collect()}
    for r in op6_main_text(spark, folder).collect():
        page = pages.pop(r.page_id)
        article = re.search(r"<article>(.*?)</article>", page.html, re.S)[1]
        blocks = [" ".join(html.unescape(re.sub("<br>", " ", b).replace("<b>", "")).split()) for b in re.split(r"</?(?:h1|p)>", article)]
        assert (r.text, r.url) == ("\n\n".join(b for b in blocks if b), page.url) and r.n_chars == len(r.text)
    assert not pages


def test_articles_over_several_containers_stay_whole(spark):
    a, b = "First part of the story. " * 30, "Second part. " * 20
    pages = [
        f"<body><article><section><div><p>{a}</p></div></section><section><div><p>{b}</p></div></section></article></body>",
        f"<body><main><h1>Title</h1><p>Lead.</p><div class='text'><p>{a}{b}</p></div></main></body>",
        f"<body><div id=page><div><div><p>{a}</p></div></div><div><div><p>{b}</p></div></div></div></body>",
    ]
    expected = [f"{a.strip()}\n\n{b.strip()}", f"Title\n\nLead.\n\n{a}{b.strip()}", f"{a.strip()}\n\n{b.strip()}"]
    rows = [(10 * k + i, f"http://h{k}.test/{i}", page) for k, page in enumerate(pages) for i in range(4)]
    got = html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r.page_id: r.text for r in got} == {i: expected[i // 10] for i, _, _ in rows}
