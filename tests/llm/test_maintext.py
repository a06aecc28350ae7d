"""Main text of pages: block cutting, the field's sums against enumeration, held-out pages, odd and hostile pages."""

import html
import itertools
import re
import time
from collections import Counter

import numpy as np
import pytest

from llm_fixtures import SF_DIR
from lotmill.llm import maintext
from lotmill.llm.layouts import labelled_pages
from lotmill.llm.queries import QUERIES


@pytest.fixture(scope="module")
def extractor():
    return maintext.Extractor(maintext.default_model())


def cut(page):
    return [b.text for b in maintext.blocks(page, maintext.Paths())]


def test_blocks():
    assert cut("<p>one<p>two <b>b</b>old<br>line<ul><li>x<li>y</ul>z") == ["one", "two bold line", "x", "y", "z"]
    assert cut("a&nbsp;&nbsp;b &lt;c&gt; &#8364; &amp x &am<!-- <p>no --><script>var t='</p><p>';</script><style>p{}</style> d") == ["a b <c> € & x &am d"]
    assert cut('<p title="a > b">in</p>') == ["in"] and cut("<table><tr><td>a<td>b<tr><td>c</table>") == ["a", "b", "c"]
    assert cut(None) == cut("") == cut(" \n\t") == cut("<p></p><!-- open <p>x") == []
    assert cut("1 < 2 <3 <> x") == ["1 < 2 <3 <> x"]


def test_marginals_are_those_of_all_label_sequences():
    r = np.random.default_rng(0)
    lengths, emit, after, first = np.array([1, 4, 3]), r.normal(size=(3, 4, 2)), r.normal(size=(2, 2)), r.normal(size=2)
    total, each, pairs = maintext.marginals(emit, after, first, lengths)
    expected = np.zeros((2, 2))
    for s, n in enumerate(lengths):
        score = {}
        for path in itertools.product((0, 1), repeat=int(n)):
            score[path] = first[path[0]] + sum(emit[s, t, y] for t, y in enumerate(path)) + sum(after[a, b] for a, b in zip(path, path[1:]))
        weights = {p: np.exp(v) for p, v in score.items()}
        z = sum(weights.values())
        assert np.isclose(total[s], np.log(z))
        for t in range(n):
            assert np.isclose(each[s, t, 1], sum(w for p, w in weights.items() if p[t]) / z)
        for p, w in weights.items():
            for a, b in zip(p, p[1:]):
                expected[a, b] += w / z
        assert tuple(maintext.viterbi(emit[s, :n], after, first)) == max(score, key=score.get)
    assert np.allclose(pairs, expected)


def test_pages_of_layouts_not_trained_on(extractor):
    right = total = 0
    for page in labelled_pages(150, seed=4711):
        found = Counter(extractor.text("".join(piece for piece, _ in page)).split("\n\n"))
        for b, label in maintext.labelled_blocks(page, maintext.Paths()):
            if label >= 0:
                total += 1
                right += (found[b.text] > 0) == (label == 1)
    assert total > 1500 and right / total > 0.98


def test_every_page_of_the_table_gives_its_article(spark):
    got = {r["page_id"]: r for r in QUERIES["op13_maintext"](spark, SF_DIR).collect()}
    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet").collect()
    assert len(got) == len(pages) > 0
    for page in pages:
        inner = re.search("<article>(.*?)</article>", page["html"], re.S)[1]
        parts = [re.sub("<[^>]*>", lambda m: " " if m[0] == "<br>" else "", p) for p in re.split("</?(?:h1|p)>", inner)]
        text = "\n\n".join(t for t in (" ".join(html.unescape(p).split()) for p in parts) if t)
        assert (got[page["page_id"]]["text"], got[page["page_id"]]["n_chars"]) == (text, len(text))


def test_odd_pages(spark, extractor):
    story = "<article><h1>T</h1><p>One two three.</p><div class='ad'>Buy now.</div><p>Four.</p><section class='comments'><p>I liked it a lot.</p></section></article>"
    rows = [(1, "u", story), (1, "u", story), (2, None, None), (3, "", ""), (None, "v", "<nav><a href=x>only menu</a></nav>"), (4, "w", "<article><p>\U0001f600 é</p></article>")]
    pages = spark.createDataFrame([(*r, "a", 5) for r in rows], "page_id long, url string, html string, text string, n_chars int")
    got = maintext.extract(pages).collect()
    assert [(r["page_id"], r["url"], r["text"], r["n_chars"]) for r in got] == [
        (1, "u", "T\n\nOne two three.\n\nFour.", 24), (1, "u", "T\n\nOne two three.\n\nFour.", 24), (2, None, "", 0), (3, "", "", 0), (None, "v", "", 0), (4, "w", "\U0001f600 é", 3)
    ]
    assert maintext.extract(pages.limit(0)).count() == 0
    assert maintext.train([]).numbers == {}


@pytest.mark.parametrize("piece", ["<b>x", "<div>", '<a href="x ', "<", "<!--", "<svg>", "<ul><li>", "&", " ", "</p>", "<i><p>x", "<table><tr><td>"])
def test_long_pages_take_time_in_proportion(extractor, piece):
    start = time.perf_counter()
    extractor.text(f"<article><p>{piece * (400_000 // len(piece))}")
    assert time.perf_counter() - start < 20
