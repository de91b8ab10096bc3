"""Main text of pages: the parser, exact marginals and gradients, held-out accuracy and odd pages."""

import html
import itertools
import re

import duckdb
import numpy as np
import pytest

from assetlake.llm import html_tree as tree
from assetlake.llm import main_text as mt

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def written():
    return mt.fit([tree.parse(p, True) for p in tree.labelled_pages(mt.WRITTEN_PAGES, mt.SEED)])


def whole(source):
    page = tree.parse(source)
    return page.words_of([True] * len(page.parent))


@pytest.mark.parametrize(
    "source, text",
    [
        ("", ""),
        ("no markup &amp; <  lone", "no markup & < lone"),
        ("<p>a<b>b</b> c<br>d\n\te<p>f&nbsp;g", "ab c d e f g"),
        ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>e", "a b c d e"),
        ("<table><tr><td>a<td>b<tr><td>c</table>d", "a b c d"),
        ("x<script>if (a < b) '</p>'</script>y<style>p{}</style><!-- <p>z</p> -->z", "x y z"),
        ("a<span class='ad'>b</span>c", "abc"),
        ("<div title='a > b'>c</div><a href=x'y>d</a><a href=\"", "c d"),
        ("cut &am", "cut &am"),
        ("cut &amp", "cut &"),
        ("cut <p class='x", "cut"),
        ("<script>never ends", ""),
        ("</div></p></zzz>a</b>", "a"),
        ("<form><select><option>o</select><textarea><p>t</textarea>l<input></form>", "l"),
        ("<DIV>A</DIV><my-tag>b</my-tag><br/>c<hr>d", "A b c d"),
        ("&lt;p&gt; &#228;&#x41;&notanentity;", "<p> äA¬anentity;"),
    ],
)
def test_parse(source, text):
    assert whole(source) == text


def test_parents_and_ends():
    page = tree.parse("<div><p>a<p>b</div><nav class='site-menu x'><ul><li>c</ul></nav>d")
    kinds = [tree.KINDS[k] for k in page.kind]
    assert kinds == ["body", "div", "p", "leaf", "p", "leaf", "nav", "list", "li", "leaf", "leaf"]
    assert page.parent == [-1, 0, 1, 2, 1, 4, 0, 6, 7, 8, 0] and page.end[1] == 6 and page.end[6] == 10
    assert page.marks[6] == (tree.GROUPS.index("menu"),)
    for node in range(1, len(kinds)):
        assert page.parent[node] < node < page.end[page.parent[node]]


def test_deep_and_long_pages(written):
    deep = "<div>" * 3000 + "<p>" + "words and more words. " * 20
    long = "<article>" + "<p>Some words, and some more of them.</p>" * 20_000 + "</article><footer>&copy; x</footer>"
    unclosed = "<p " * 20_000 + "<a href='" * 20_000
    texts = mt.main_texts([tree.parse(p) for p in (deep, long, unclosed, "")], written)
    assert texts[1] == " ".join(["Some words, and some more of them."] * 20_000) and texts[3] == ""


def pages_of(seed, count=6):
    out = []
    for source in tree.labelled_pages(200, seed):
        page = tree.parse(source, True)
        if len(page.parent) <= 12:
            out.append(page)
    return out[:count] or [tree.parse("<div><p>a.</p><nav>b</nav></div>c", True)]


def test_marginals_against_enumeration():
    rng = np.random.default_rng(2)
    pages = [tree.parse("<div><p>a.</p><nav>b <p>c</nav></div>d<ul><li>e</ul>"), *pages_of(5, 2)]
    for page in pages:
        trees = mt.forest([page])
        n = len(page.parent)
        own, pair = rng.normal(size=(n, 2)), rng.normal(size=(mt.EDGES, 2, 2))
        told, joint, norm = mt.marginals(trees, own, pair)
        total, main, both = 0.0, np.zeros(n), np.zeros((n, 2, 2))
        for label in itertools.product((0, 1), repeat=n):
            score = sum(own[i, label[i]] for i in range(n))
            score += sum(pair[trees.edge[i], label[page.parent[i]], label[i]] for i in range(1, n))
            weight = np.exp(score)
            total += weight
            main += weight * np.array(label)
            for i in range(1, n):
                both[i, label[page.parent[i]], label[i]] += weight
        assert np.allclose(told, main / total) and np.allclose(joint, both / total) and np.isclose(norm, np.log(total))


def test_gradient():
    rng = np.random.default_rng(3)
    pages = [tree.parse(p, True) for p in tree.labelled_pages(4, 8)]
    trees = mt.forest(pages)
    label = mt.labels_of(trees, pages)
    model = mt.Model(rng.normal(size=mt.WIDTH) * 0.3, rng.normal(size=(mt.EDGES, 2, 2)) * 0.3)
    _, by_own, by_pair = model.likelihood(trees, label)
    for array, slope in ((model.own, by_own), (model.pair, by_pair)):
        for at in rng.choice(array.size, 8, replace=False):
            before = array.flat[at]
            values = []
            for step in (1e-5, -1e-5):
                array.flat[at] = before + step
                values.append(model.likelihood(trees, label)[0])
            array.flat[at] = before
            assert np.isclose((values[0] - values[1]) / 2e-5, slope.flat[at], atol=1e-7)


def test_held_out_accuracy(written):
    pages = [tree.parse(p, True) for p in tree.labelled_pages(300, 77)]
    trees = mt.forest(pages)
    label = mt.labels_of(trees, pages)
    told, _, _ = mt.marginals(trees, written.potentials(trees), written.pair)
    leaf = trees.features[:, 0]
    assert ((told > 0.5) == label)[leaf].mean() > 0.97


def article_of(source):
    found = re.search(r"<article>(.*?)(</article>|\Z)", source, re.S)
    text = re.sub(r"<[^>]*(>|\Z)", "\n", re.sub(r"</?b>", "", found[1])) if found else ""
    return " ".join(html.unescape(text).split())


def test_given_pages(spark):
    df = spark.read.parquet(f"{SF}/pages.parquet")
    got = {r.page_id: (r.url, r.text, r.n_chars) for r in mt.extract(df, mt.train(df), carry=["page_id", "url"]).collect()}
    rows = duckdb.sql(f"SELECT page_id, url, html FROM '{SF}/pages.parquet'").fetchall()
    assert len(got) == len(rows)
    right = sum(got[i][:2] == (url, article_of(source)) for i, url, source in rows)
    assert right >= 0.99 * len(rows) and all(n == len(t) for _, t, n in got.values())


LAYOUT = """<html><body><header class="site-header"><h1>Site name</h1><p>Claim of the site.</p></header>
<div class="cookie-notice"><p>We use cookies on this site, so that it works. Accept them all.</p></div>
<nav><ul><li><a href="/">Home</a><li><a href="/n">News</a></ul></nav>
{open}<h1>Great news</h1><p>First long paragraph of the text, with <a href="/x">a link</a> in it. It goes on for a while.</p>
<div class="ad-slot">Buy this now, it is cheap.</div><p>Second paragraph &ndash; with more to say.</p>
<form><label>Your mail</label><input></form><ul><li>One point of it.</li><li>Another point of it.</li></ul>{close}
<section id="comments"><h3>Comments</h3><div class="comment"><b>Ann</b><p>I did like this text very much, thank you.</p></div></section>
<aside><h3>Related</h3><ul><li><a href="/1">Other text</a></li></ul></aside>
<footer><p>&copy; 2020 Site name. All rights reserved.</p></footer><script>var x = "<p>no</p>"</script></body></html>"""


@pytest.mark.parametrize("name", ["article", "main", 'div class="content"', 'div id="article-body"', 'section class="entry"'])
def test_layouts(written, name):
    source = LAYOUT.format(open=f"<{name}>", close=f"</{name.split()[0]}>")
    want = (
        "Great news First long paragraph of the text, with a link in it. It goes on for a while. "
        "Second paragraph – with more to say. One point of it. Another point of it."
    )
    assert mt.main_texts([tree.parse(source)], written) == [want]


def test_odd_rows(spark, written):
    rows = [(1, None, None, "n"), (None, "u", "", "n"), (2, "u", " \n", None), (2, "u", "<p>Text, and text.</p>", "x"), (2, "u", "<p>Text, and text.</p>", "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string").selectExpr("*", "1 as n_chars", "map(1, 2) as c0")
    out = mt.extract(df, written)
    assert out.columns == [*df.columns, "_text", "_n_chars"]
    got = out.collect()
    assert len(got) == 5 and [r._text for r in got[:3]] == ["", "", ""] and got[3] == got[4] and got[3].text == "x"
    empty = df.limit(0)
    assert mt.extract(empty, mt.train(empty), carry=["url", "page_id"]).collect() == []
