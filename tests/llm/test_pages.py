"""Main text and URL verdicts of pages."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from turnstile.llm import html_text, url_filter
from turnstile.llm.url_filter import Rule

PAGE = """<!DOCTYPE html><html><head><title>x</title><style>p{}</style><script>var t="</p>";</script></head>
<body class="page has-sidebar"><div class="wrap sidebar-right"><header class=top><a href=/>x</a><p>Site slogan</p></header>
<div class="cookie-notice">We use cookies &amp; more, accept them to go on reading.</div><nav><ul><li><a href=1>One</a></ul></nav>
<main><article class="post"><h1>Title of it</h1><p>Tiny.<p>A <b>bold</b>ly&nbsp;written
 line &lt;here&gt;.<div class="ad-box">Buy it</div><form><p>Name <input></form><ul><li>One<li>Two</ul>
<aside>Related things</aside><div class="comments"><ul><li><div><p>A really long comment by a reader, who says that the
text is good and should go on for ever.</p></div></ul></div></article></main></div><footer>&copy; me</footer></body></html>"""
LINES = ["Title of it", "Tiny.", "A boldly written line <here>.", "One", "Two"]


@pytest.mark.parametrize("counts", [{}, html_text.page_counts(PAGE)])
def test_the_article_without_boxes(counts):
    potentials = html_text.Potentials.of(counts)
    assert html_text.main_text(PAGE, potentials).split("\n") == LINES


def test_pages_without_an_article_element():
    long, other = "A long paragraph of text. " * 12, "Another long paragraph, with words. " * 12
    page = f"<body><div class=menu><ul><li><a href=1>Start</a></ul></div><div><p>{long}</p><p>Short one.</p><p>{other}</p></div><div><a href=3>More</a></div>"
    for counts in ({}, html_text.page_counts(PAGE)):
        lines = html_text.main_text(page, html_text.Potentials.of(counts)).split("\n")
        assert lines == [long.strip(), "Short one.", other.strip()]


def test_marginals_are_those_of_all_labellings():
    from itertools import product
    from math import exp, prod

    potentials = html_text.Potentials.of({})
    nodes = html_text.parse("<div class=main><p>Some words of text here</p><aside>Else</aside></div>")
    below, places = html_text._below(nodes), html_text._places(nodes)
    weight = [0.0] * len(nodes)
    total = 0.0
    for states in product((True, False), repeat=len(nodes)):
        w = prod(
            exp(sum(potentials.leaning.get(f, 0.0) for f in html_text.features(n, below[i]))) if states[i] else 1.0
            for i, n in enumerate(nodes)
        )
        for i, n in enumerate(nodes[1:], 1):
            stay = potentials.stays[places[i], states[n.parent]]
            w *= stay if states[i] == states[n.parent] else 1 - stay
        total += w
        for i, s in enumerate(states):
            weight[i] += w * s
    assert html_text.marginals(nodes, potentials) == pytest.approx([x / total for x in weight], rel=1e-6)


@pytest.mark.parametrize("page", ["", "<", "<p", "</p></div>", "<a><b><i>x", "<!-- never", "<script>x", "<p>a</b></i></p>", "<table><td>x<tr>y", "&#xZZ;&bad;", "<div " * 500])
def test_broken_pages_never_fail(page):
    assert isinstance(html_text.main_text(page, html_text.Potentials.of({})), str)


def test_deep_and_long_pages():
    potentials = html_text.Potentials.of({})
    deep = "<article>" + "<div>" * 3000 + "<p>Deep words</p>" + "</div>" * 3000 + "</article>"
    assert html_text.main_text(deep, potentials) == "Deep words"
    long = "<article>" + "<p>Some words here.</p>" * 20_000 + "</article>"
    assert html_text.main_text(long, potentials).count("\n") == 19_999


TALE = "The whole article stands here, with enough words to be read as one."
MALFORMED = {
    "no end of head": f"<html><head><title>x</title><meta a=b><body><article><p>{TALE}</p></article>",
    "text ends the head": f"<html><head><title>x</title><article><p>{TALE}</p></article>",
    "stray apostrophe": f"<article><p title=don't>{TALE}</p></article>",
    "stray quote": f'<article><p title="a>{TALE}</p></article>',
    "greater in a value": f'<article><p title="a > b" class=\'x>y\'>{TALE}</p></article>',
    "svg without content": f"<article><svg/><p>{TALE}</p></article>",
    "unclosed video": f"<article><video src=a><p>{TALE}</p></article>",
    "unclosed video before": f"<body><div><video src=a></div><article><p>{TALE}</p></article>",
    "unclosed iframe": f"<article><iframe src=a><p>{TALE}</p></article>",
    "closed video": f"<article><video src=a>Your browser is old</video><p>{TALE}</p></article>",
    "closed svg": f"<article><svg><text>label</text></svg><p>{TALE}</p></article>",
    "comments in articles beside": f"<main><article><p>{TALE}</p></article><section class=comments><article><p>Reader one says so.</p></article>"
    "<article class=comment><p>Reader two says no.</p></article></section></main>",
    "comments in articles inside": f"<article><h2>{TALE}</h2><article class=comment><p>I like it.</p></article><article><p>Me too.</p></article></article>",
    "comments named on the page": f'<body class="has comments"><article><p>{TALE}</p></article><div id=comments><article><p>A reader.</p></article></div>',
}


@pytest.mark.parametrize("name", MALFORMED)
@pytest.mark.parametrize("counts", [{}, html_text.page_counts(PAGE)])
def test_malformed_pages_keep_their_article(name, counts):
    assert html_text.main_text(MALFORMED[name], html_text.Potentials.of(counts)) == TALE


@pytest.mark.parametrize("piece", ["<a ", "<", "<!--", "<a =\">\" ", "<p x='", "<video>", "<iframe>", "</p ", "<![CDATA[", "<title ", "=\""])
def test_a_megabyte_is_read_in_seconds(piece):
    from time import perf_counter

    start = perf_counter()
    html_text.main_text(piece * (1_000_000 // len(piece)), html_text.Potentials.of({}))
    assert perf_counter() - start < 20


def test_pages_of_a_table(spark):
    data = [(1, "http://a", PAGE), (1, "http://a", PAGE), (2, None, None), (None, "x", ""), (3, "u", "<article>plain</article>")]
    pages = spark.createDataFrame(data, "page_id long, url string, html string").withColumns({"text": F.lit(1), "n_chars": F.lit("a")})
    got = html_text.page_texts(pages).collect()
    assert sorted(r.n_chars for r in got) == sorted([len("\n".join(LINES))] * 2 + [0, 0, 5])
    assert html_text.page_texts(pages.limit(0)).collect() == []


def test_hosts_paths_and_rules(spark):
    urls = [
        "http://WWW.Example.com/en/1?x#y", "https://example.com/en/2", "http://a.example.com/fr/", "http://x.net/fr/1", "http://x.net/frost",
        "ftp://notexample.com", "nothing", None, "http://h?q=/es/", "HTTP://X.org/a://b/c",
    ]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").withColumns({"host": F.lit(1), "rule": F.lit(2)})
    rules = [Rule("com", "/", "allow"), Rule("example.com", "/en/", "block"), Rule("www.example.com", "/en/", "allow"), Rule("net", "/fr/", "block")]
    listed = spark.createDataFrame([("x.org/a://b/c",), ("x.net/frost",), (None,)], "key string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judged(pages, rules, listed).collect()}
    assert got == {
        0: ("www.example.com", "/en/1", "www.example.com/en/", "allow"), 1: ("example.com", "/en/2", "example.com/en/", "block"),
        2: ("a.example.com", "/fr/", "com/", "allow"), 3: ("x.net", "/fr/1", "net/fr/", "block"), 4: ("x.net", "/frost", None, "block"),
        5: ("notexample.com", "", None, "allow"), 6: ("", "", None, "allow"), 7: ("", "", None, "allow"), 8: ("h", "", None, "allow"),
        9: ("x.org", "/a://b/c", None, "block"),
    }
    assert url_filter.judged(pages, rules, listed.limit(0)).where("listed").count() == 0
    assert url_filter.judged(pages.limit(0), rules, listed).collect() == []


def test_no_listed_url_is_missed_and_false_positives_go(spark, monkeypatch):
    monkeypatch.setattr(url_filter, "MOST_BLOCKS", 64)  # far too small a filter
    keys = spark.range(20_000).select(F.concat(F.lit("h/"), "id").alias("key"))
    got = url_filter.listed_urls(keys, keys.where("key like '%7'"))
    assert got.where("listed").count() == got.where("key like '%7'").count() == 2000
    assert got.count() == 20_000 and got.where("listed and key not like '%7'").count() == 0


def test_one_spelling_per_address(spark):
    same = ["http://A.com/x/", "https://a.com:443/x.html#top", "http://a.com/x?utm_source=feed", "http://a.com/x?ref=y"]
    df = spark.createDataFrame([(u,) for u in same], "url string")
    assert df.select(url_filter.canonical(F.col("url"))).distinct().count() == 1
    assert spark.createDataFrame([("http://a.com/x?ref=y&page=2",)], "url string").select(url_filter.canonical(F.col("url"))).first()[0] == "a.com/x?page=2"
