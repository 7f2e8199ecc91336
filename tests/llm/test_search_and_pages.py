"""Nearest neighbours and main text against brute force."""

import time
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from odflow.llm import html_extract, neighbours

SF = Path("/root/testdata/sf0.1")


def brute(ids, vectors, query, k):
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    scores = np.round(unit @ unit[ids.index(query)], 12)
    order = sorted((-s, i) for s, i in zip(scores, ids, strict=True) if i != query)
    return [i for _, i in order[:k]]


def search(table, modulus=50, **options):
    rows = neighbours.nearest(table, F.col("vec_id") % modulus == 0, **options).collect()
    found = {}
    for r in sorted(rows, key=lambda r: (r["query_id"], r["rank"])):
        found.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    return found


@pytest.mark.skipif(not SF.exists(), reason="test tables missing")
def test_recall_against_brute_force(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = table.collect()
    ids = [r["vec_id"] for r in rows]
    vectors = np.array([r["embedding"] for r in rows], float)
    found = search(table)
    assert set(found) == {i for i in ids if i % 50 == 0}
    hits = sum(len({v for v, _ in got} & set(brute(ids, vectors, q, 5))) for q, got in found.items())
    assert hits >= 0.9 * 5 * len(found)
    for q, got in found.items():
        assert len(got) == 5 and [s for _, s in got] == sorted((s for _, s in got), reverse=True)
        for v, s in got:
            a, b = vectors[ids.index(q)], vectors[ids.index(v)]
            assert abs(s - a @ b / np.linalg.norm(a) / np.linalg.norm(b)) < 1e-12


def test_equal_vectors_ties_and_odd_rows(spark):
    hot = [1.0, 2.0, 3.0]
    rows = [(i, hot, 0) for i in range(200)]
    rows += [(300, [3.0, -1.0, 0.5], 0), (301, None, 0), (302, [0.0, 0.0, 0.0], 0)]
    rows += [(303, [1.0, None, 2.0], 0), (304, [float("nan"), 1.0, 1.0], 0), (350, [float("inf"), 1.0, 1.0], 0)]
    table = spark.createDataFrame(rows, "vec_id BIGINT, embedding ARRAY<FLOAT>, score INT").repartition(4)
    found = search(table)
    assert set(found) == {0, 50, 100, 150, 300}
    assert [v for v, _ in found[0]] == [1, 2, 3, 4, 5]
    assert [v for v, _ in found[50]] == [0, 1, 2, 3, 4]
    assert [v for v, _ in found[300]] == [0, 1, 2, 3, 4]
    assert search(table.limit(0)) == {}
    few = search(table.filter("vec_id in (0, 300, 302)"))
    assert [v for v, _ in few[0]] == [300] and [v for v, _ in few[300]] == [0]


def test_hilbert_key_walks_from_cell_to_neighbouring_cell():
    grid = np.stack(np.meshgrid(*[np.arange(8)] * 3, indexing="ij"), -1).reshape(-1, 3)
    keys = neighbours.hilbert_key(grid, 3)
    assert sorted(keys) == list(range(512))
    path = grid[np.argsort(keys)]
    assert (np.abs(np.diff(path, axis=0)).sum(1) == 1).all()


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head>
<body><nav><ul><li><a href="/a">Home</a></li></ul></nav><div class="cookie-notice">We use cookies to
make this better for everyone who reads here and everywhere else.</div><div class="ad">Buy now a very
long advert text with many words that goes on and on.</div><aside><p>Side text that is as long as a
paragraph of the article itself would be.</p></aside><article><h1>Head &amp; title</h1><p><b>First  one
&lt;here&gt;<br>goes on<p>Short.<p>Second with <a href="x">a link</a>, and more words in it.</p>
<!-- <p>hidden</p> --><form><p>Your mail address please</p></form></article>
<div id="comments"><p>A reader wrote quite a long comment on the text above, and it is not main
text.</p></div><footer>&copy; somebody</footer>"""


def test_main_text_of_a_page(spark):
    rows = [(1, "u", PAGE), (2, None, None), (3, "u", ""), (4, "u", "<p>"), (4, "u", "<p>"), (5, "u", "a < b <")]
    table = spark.createDataFrame(rows, "page_id BIGINT, url STRING, html STRING")
    found = {r["page_id"]: r for r in html_extract.extract(table).collect()}
    text = "Head & title First one <here> goes on Short. Second with a link, and more words in it."
    assert found[1]["text"] == text and found[1]["n_chars"] == len(text)
    assert [found[i]["text"] for i in (2, 3, 4)] == ["", "", ""]
    assert html_extract.extract(table).count() == 6
    assert html_extract.extract(table.limit(0)).collect() == []


def test_tag_with_an_open_quote_is_no_text():
    words = "some words that make up a paragraph " * 3
    page = f"<article><p title=it's>{words}</p><p id=b's alt='>'>a < b and more of it here</p></article>"
    text = html_extract.main_text(page, html_extract.default_tree())
    assert text == f"{words.strip()} a < b and more of it here"


def test_tree_learns_its_table():
    table = np.array(html_extract.TABLE, float)
    tree = html_extract.default_tree()
    assert [html_extract.decide(tree, r) for r in table[:, :-1]] == table[:, -1].tolist()


def test_text_without_article_element():
    body = "".join(f"<div>{'words of the text ' * 15}</div>" for _ in range(4))
    page = f"<html><body><div class=menu><a href=/>Home</a></div>{body}<div>Imprint</div></body></html>"
    text = html_extract.main_text(page, html_extract.default_tree())
    assert text == " ".join(["words of the text " * 15] * 4).replace("  ", " ").strip()


LONG = ("And so the story went on for many days in the old town by the river. " * 5).strip()


@pytest.mark.parametrize(
    "page",
    [
        "<article title=\"the hidden truth\">%s</article>",
        "<article style=\"overflow: hidden !important\">%s</article>",
        "<article data-id=menu aria-x-id='footer'><p>%s</p></article>",
        "<article x=/a/b/><p>%s</p></article>",
        "<div class=\"content has-sidebar\"><article>%s</article><div class=sidebar>Side</div></div>",
        "<div class=sidebar-layout><div class=sidebar>Side</div><main><p>%s</p></main></div>",
        "<div class=\"post header-large\">%s</div>",
        "<form><p>%s</p><input name=q></form>",
        "<article><div class=article-header></div><p>%s</article>",
        "<article>%s</article><div id=comments><article><p>A long word from one reader here.</article></div>",
        "<article>%s</article><aside><article><p>A teaser of another text.</article></aside>",
        "<article>%s<p class=cookie-notice>We use cookies.</p><p hidden>No.</p></article>",
        "<article><p>%s <span style='color:red; display : none'>x <span>y</span> z</span></p></article>",
        "<ul class=menu><li>Home<li>News</ul><article>%s</article>",
        "<article><ul hidden><li>No</ul>%s</article>",
    ],
)
def test_features_and_attributes_decide(page):
    """Pages of one text whose names, attributes or nesting mislead a word list."""
    assert html_extract.main_text(page % LONG, html_extract.default_tree()) == LONG


def test_short_pages_and_last_paragraphs():
    tree = html_extract.default_tree()
    assert html_extract.main_text("<p>A short page.</p>", tree) == "A short page."
    last = "And so it ended, as nobody had thought."
    assert html_extract.main_text(f"<p>{LONG}</p><p>{last}</p>", tree) == f"{LONG} {last}"


def test_word_list_is_not_the_verdict():
    """Blocks in an element of the list that are kept, and blocks outside that go."""
    tree = html_extract.default_tree()
    page = html_extract.read_page(f"<div class=sidebar-layout><p>{LONG}</p></div>")
    assert page.blocks[0].frame >= 0 and html_extract.decide(tree, html_extract.features(page)[0])
    page = html_extract.read_page(f"<div><a href=x>One</a></div><p>{LONG}</p><div>Imprint</div>")
    kept = [html_extract.decide(tree, row) for row in html_extract.features(page)]
    assert [b.frame for b in page.blocks] == [-1] * 3 and kept == [0, 1, 0]


def test_time_follows_the_length_of_nested_tags():
    def seconds(k):
        pages = (
            "<div><b>" * k + "x" + "</i></b></div>" * k,
            "<b>" * k + "<p>x" * k,
            "<i><div>" + "<b>" * k + "</i>" * k,
            "<div class=menu>" * k + "x",
        )
        best = []
        for page in pages:
            took = []
            for _ in range(3):
                start = time.perf_counter()
                html_extract.read_page(page)
                took.append(time.perf_counter() - start)
            best.append(min(took))
        return best

    # Eight times the tags: 64 times the seconds if it were the square.
    for few, many in zip(seconds(1500), seconds(12_000), strict=True):
        assert many < 25 * few
