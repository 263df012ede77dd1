"""The page reader on odd markup, the labeller against numeric gradients, held-out pages and the table's own frame."""

import html
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from ticketmill.llm import main_text, page_blocks, page_labeller
from ticketmill.llm.common import table
from ticketmill.llm.queries import op11_main_text


def _texts(page):
    return [b.text for b in page_blocks.read(page).blocks]


@pytest.mark.parametrize(
    ("page", "texts"),
    [
        ("<p>a <b>b<br>c<p>d", ["a b c", "d"]),
        ("<ul><li>x<li>y<ul><li>z</ul></ul>tail", ["x", "y", "z", "tail"]),
        ('<a title="x > y">link</a> t < u <3', ["link t < u <3"]),
        ('<script>var t="</p>";</script>ok<!-- no > --><style>q', ["ok"]),
        ("a<table><tr><td>1<td>2<tr><td>3</table>", ["a", "1", "2", "3"]),
        ("<div>hi &amp; &eacute;&#x41;&nbsp;\n x</div>", ["hi & éA x"]),
        ("<p>x</div>y</p>z", ["x", "y", "z"]),
        ("<p>x</div>y<p>z", ["x", "y", "z"]),
        ('<a href="never>closed</a> more > text', ["closed more > text"]),
        ("<TITLE>t</TITLE><P>Up</P><select><option>no</select><noscript>no</noscript>", ["Up"]),
        ("<![CDATA[no]]><?php no ?>yes<", ["yes<"]),
        ("", []),
        (" \n ", []),
    ],
)
def test_blocks(page, texts):
    assert _texts(page) == texts


@pytest.mark.parametrize("part", ['<a "', '<a b="', "<", "<p", '<a b="x>', "<div>", "<li>", "</p>", "&", "<!--"])
def test_odd_pages_are_read_in_linear_time(part):
    page_blocks.read(part * 100_000)  # a square of this would not end


def test_names_links_and_paths():
    page = page_blocks.read('<div class="ad-top navBar" style="display: none"><p id=x>go <a href=/>here</a></div>')
    (block,) = page.blocks
    assert (block.text, block.linked) == ("go here", 4)
    assert page.nodes[0].marks == ("ad", "top", "nav", "bar", "hidden") and page.nodes[block.node].parent == 0


def test_gradients_equal_differences():
    rng = np.random.default_rng(1)
    w = page_labeller.Weights(
        *(rng.normal(0, 0.3, s) for s in ((7, page_labeller.WORD_WIDTH), (5, page_labeller.PATH_WIDTH), (2, page_labeller.INPUT + page_labeller.HIDDEN + 1, 4 * page_labeller.HIDDEN), (2 * page_labeller.HIDDEN + page_labeller.INPUT + 1,)))
    )
    x, lengths, toward = rng.normal(0, 1, (3, 5, page_labeller.INPUT)), np.array([5, 3, 1]), rng.normal(0, 1, (3, 5))
    toward = np.where(np.arange(5) < lengths[:, None], toward, 0)
    value = lambda w, x: float((page_labeller.forward(w, x, lengths)[0] * toward).sum())
    d_gates, d_out, d_x = page_labeller.gradients(w, page_labeller.forward(w, x, lengths, keep=True)[1], lengths, toward)
    for array, gradient, at in ((w.gates, d_gates, (0, 3, 7)), (w.gates, d_gates, (1, page_labeller.INPUT + 2, 11)), (w.gates, d_gates, (1, -1, 5)), (w.out, d_out, (4,)), (x, d_x, (0, 2, 1)), (x, d_x, (1, 2, 30))):
        was, step = array[at], 1e-3
        array[at] = was + step
        above = value(w, x)
        array[at] = was - step
        below = value(w, x)
        array[at] = was
        assert abs((above - below) / (2 * step) - gradient[at]) < 2e-3


def test_a_page_scores_alike_in_any_company():
    w = page_labeller.trained()
    pages = [page_labeller.features(p) for p, _ in page_labeller.examples(30, seed=5)]
    together = page_labeller.scores(w, pages)
    for page, found in zip(pages, together, strict=True):
        assert np.allclose(page_labeller.scores(w, [page])[0], found, atol=1e-4)


def test_held_out_pages():
    w = page_labeller.trained()
    made = list(page_labeller.examples(300, seed=99))
    right = [(s > 0) == labels for s, (_, labels) in zip(page_labeller.scores(w, [page_labeller.features(p) for p, _ in made]), made, strict=True)]
    assert np.concatenate(right).mean() > 0.99
    assert np.mean([r.all() for r in right]) > 0.92


def _article(page):
    """The article of the table's own frame, by patterns."""
    inside = re.search(r"<article>(.*?)</article>", page, re.S).group(1)
    parts = [html.unescape(re.sub(r"<br>|</?b>", " ", p)) for p in re.split(r"</?(?:p|h1)>", inside)]
    return "\n\n".join(p for p in (" ".join(p.split()) for p in parts) if p)


def test_the_table(spark, folder):
    pages = {r.page_id: r for r in table(spark, folder, "pages").collect()}
    got = op11_main_text(spark, folder).collect()
    assert len(got) == len(pages)
    for row in got:
        assert row.text == _article(pages[row.page_id].html) and row.n_chars == len(row.text) and row.url == pages[row.page_id].url


def test_odd_rows(spark):
    long = "<article>" + "<p>many words here.</p>" * 30_000 + "</article>"
    rows = [(1, None), (2, ""), (None, "<p>"), (3, long), (3, long), (4, "<nav><a href=/>home</a></nav>"), (5, "x" * 300_000)]
    df = spark.createDataFrame(rows, "page_id long, html string").withColumn("text", F.lit(7)).withColumn("score", F.lit(1))
    got = main_text.with_main_text(df).collect()
    by_id = {r.page_id: r for r in got}
    assert len(got) == 7 and by_id[1].text == by_id[2].text == by_id[None].text == by_id[4].text == "" and by_id[3].score == 1
    assert by_id[3].text == "\n\n".join(["many words here."] * 30_000)
    assert main_text.with_main_text(df.limit(0)).collect() == []


def test_blocks_with_scores(spark):
    df = spark.createDataFrame([("<body><nav><a href=/>home</a></nav><article><h1>T</h1><p>Some words. And more.</p></article>",)], "html string")
    (found,) = df.select(main_text.labelled_blocks("html").alias("b")).first()
    assert [(b.text, b.path, b.score > 0) for b in found] == [
        ("home", "body/nav", False),
        ("T", "body/article/h1", True),
        ("Some words. And more.", "body/article/p", True),
    ]
