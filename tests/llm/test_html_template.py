"""Site templates against brute-force counts; articles are never lost to names; parsing stays linear."""

import time
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from metaenrich.llm import html_template
from metaenrich.llm.html_template import Page


def texts(source):
    return [b.text for b in Page(source).main_blocks()]


@pytest.mark.parametrize(
    "source",
    [
        '<article class="post no-comments"><p>T</p></article>',
        '<div class="row ad-free"><article>T</article></div>',
        '<div class="entry hidden-xs"><article>T</article></div>',
        '<article><p class="share-price">T</p></article>',
        '<article><h2 id="social-policy">T</h2></article>',
        '<article><section id="search-and-replace">T</section></article>',
        '<article><p class="ad">T</p></article>',
        '<div class="sidebar"><article>T</article></div>',
        '<body class="comments"><article>T</article><div class="comments">No</div></body>',
    ],
)
def test_names_delete_no_article(source):
    assert texts(source) == ["T"]


LONG = "A long body of main text, with many words in it."


@pytest.mark.parametrize(
    ("source", "expected"),
    [
        (f'<main><h1>Title</h1><p>{LONG}</p><section><article class="card">teaser</article></section></main>', ["Title", LONG, "teaser"]),
        (f'<div class="content">{LONG}</div><article class="teaser">teaser</article>', [LONG, "teaser"]),
        ("<main><p>Lead.</p><article>A.</article><p>End.</p></main>", ["Lead.", "A.", "End."]),
        (f"<main><article>{LONG}</article><div>More like this</div></main><div>Around</div>", [LONG]),
        (f"<article>{LONG}</article><div>{'<a href=x>Another page of ours</a> ' * 9}</div>", [LONG]),  # links have no mass
        (f"<article>{LONG}</article><article>Second</article>", [LONG, "Second"]),
        (f'<article><p>{LONG}</p><p class="advert">x</p><section id="cookie">x</section><div class="share">x</div><div class="widget">x</div></article>', [LONG]),
        ("<p>one <span hidden>x</span> paragraph</p>", ["one paragraph"]),
        ("<p>one <button>x</button>paragraph <i hidden>x<b>y</b></i>goes on</p><p>two", ["one paragraph goes on", "two"]),
        ("<div>one <span hidden><div>x</div>y</span> block <span hidden>", ["one block"]),
        ("<p>one <span hidden>x<p>two", ["one", "two"]),
        ("<article></article>", []),
    ],
)
def test_main_content_is_chosen_by_mass(source, expected):
    assert texts(source) == expected


def test_pages_without_article_keep_shared_paragraphs(spark):
    """The main content's shared paragraphs stay, a container that recurs goes; texts differ with and without templates."""
    source = lambda i: f"<div><h1>Report {i}</h1><p>The same foreword.</p><p>Body {i}</p></div><div>Our <b>offices</b></div>"
    frame = spark.createDataFrame([(i, "http://a.example/", source(i)) for i in range(20)], "page_id int, url string, html string")
    assert {r.page_id: r.text for r in html_template.extract(frame).collect()} == {i: f"Report {i}\nThe same foreword.\nBody {i}" for i in range(20)}
    assert all(r.text.endswith("Our offices") for r in html_template.extract(frame, recur=1 << 40).collect())


def test_given_pages_without_article_elements(spark):
    """With their articles renamed to div, no line of the main text goes by templates."""
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet").select("page_id", "url", "html")
    renamed = pages.withColumn("html", F.regexp_replace("html", "<(/?)(?:article|main)\\b", "<$1div"))
    plain = {r.page_id: r.text.split("\n") for r in html_template.extract(pages).collect()}
    found = {r.page_id: r.text.split("\n") for r in html_template.extract(renamed).collect()}
    lost = sum(line not in found[i] for i, lines in plain.items() for line in lines)
    added = sum(line not in plain[i] for i, lines in found.items() for line in lines)
    total = sum(map(len, plain.values()))
    assert lost <= 0.001 * total and added <= 0.05 * total, (lost, added, total)


def test_implied_ends():
    assert texts("<table><tr><td>a<td>b<tr><td>c</table><dl><dt>x<dd>y<dt>z</dl>") == ["a b", "c", "x", "y", "z"]
    assert texts("<ul><li>a<ul><li>b</ul><li>c</ul>d</li>e") == ["a", "b", "c", "de"]
    assert texts("<p>a<table><td><p>b</table>c") == ["a", "b", "c"]


@pytest.mark.parametrize(
    "source",
    ["<div>x" * 100_000, "<b>x" * 100_000, "<p><td>" + "<b>" * 50_000 + "<div>x</div>" * 20_000, "</x>" * 100_000 + "<i>" * 50_000 + "</y>" * 50_000, "<a " * 200_000, "<div><p>x" * 30_000 + "</p>" * 30_000, '<a ="' * 100_000],
)
def test_deep_and_broken_pages_take_linear_time(source):
    began = time.process_time()
    page = Page(source)
    elements = np.array([e[1:] for e in page.elements], np.int64).reshape(-1, 3)
    html_template.covered(np.array([b.level for b in page.blocks], np.uint8), elements)
    assert time.process_time() - began < 20


def test_counts_equal_brute_force(spark, tables):
    """Keys and the blocks they delete, on the given pages and on a host with containers in and around articles."""
    rows = [(r.page_id, r.url, r.html) for r in spark.read.parquet(f"{tables}/pages.parquet").collect()]
    rows += [(10_000 + i, "http://x.example/", f"<div>top</div><article><p>Own {i % 7}</p><p>Same</p><ul><li>In</ul></article><section><p>End {i % 2}</p></section>") for i in range(30)]
    pages = {i: Page(source or "", html_template.host_of(url)) for i, url, source in rows}
    stands = defaultdict(set)
    for page in pages.values():
        for key, *_ in page.elements:
            stands[key].add("\n".join(b.text for b in page.main_blocks()))
    recurring = {k for k, contents in stands.items() if len(contents) >= html_template.RECUR_PAGES}
    frame = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    parsed = html_template._parse(frame)
    assert {r.key for r in html_template.templates(parsed).collect()} == recurring and recurring

    out = {r.page_id: r for r in html_template.extract(frame).collect()}
    assert out == {r.page_id: r for r in html_template.extract(frame, max_broadcast=-1).collect()}
    for i, page in pages.items():
        gone = {n for key, first, end, level in page.elements if key in recurring for n in range(first, end) if level >= page.blocks[n].level}
        kept = [page.blocks[n].text for n in page.chosen(gone)]
        assert (out[i].text, out[i].n_template, out[i].n_listed) == ("\n".join(kept), len(gone), len(page.blocks) - len(gone) - len(kept))
    assert out[10_000].text == "Own 0\nSame" and out[10_000].n_template == 3

    # Without templates, their blocks are left to the lists, and what no list knows stays.
    without = {r.page_id: r for r in html_template.extract(frame, recur=1 << 40).collect()}
    assert without[10_000].text == "Own 0\nSame\nIn" and sum(r.n_template for r in without.values()) == 0
    assert sum(r.n_listed for r in without.values()) > sum(r.n_listed for r in out.values())


def test_templates_change_the_result_of_the_given_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet")
    with_, without = (html_template.extract(pages, recur=n).agg({"n_template": "sum", "n_listed": "sum"}).first() for n in (html_template.RECUR_PAGES, 1 << 40))
    assert with_["sum(n_template)"] > 2000 and without["sum(n_template)"] == 0
    assert with_["sum(n_template)"] + with_["sum(n_listed)"] == without["sum(n_listed)"]
