"""Lexical search and hard negatives against brute force, on odd and on generated rows."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from llm_fixtures import no_docs, odd_docs, odd_items  # noqa: F401
from lotmill.llm import lexical, negatives

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def ranked(items, docs, k):
    """(item, rank, doc, score) by plain loops."""
    cut = [(d, Counter(terms(t)), len(terms(t))) for d, t in docs]
    n_docs, length = sum(n > 0 for _, _, n in cut), sum(n for _, _, n in cut)
    df = Counter(t for _, c, _ in cut for t in c)
    out = []
    for item, text in items:
        found = []
        for d, counts, n in cut:
            m = 100 - 25 + (25 * n * n_docs) // length if length else 0
            score = 0
            for t in terms(text):
                if counts[t]:
                    score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * counts[t] // (1000 * counts[t] + 12 * m))
            if score > 0:
                found.append((-score, math.inf if d is None else d))
        out += [(item, r, None if d == math.inf else d, -s) for r, (s, d) in enumerate(sorted(found)[:k], 1)]
    return sorted(out, key=str)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_lexical_search_of_odd_rows(odd_docs, odd_items, no_docs):
    docs = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    items = [(r["item_id"], r["text"]) for r in odd_items.collect()]
    assert rows(lexical.search(odd_items, odd_docs, 3)) == ranked(items, docs, 3)
    assert lexical.search(odd_items, no_docs).count() == 0
    assert lexical.search(odd_items.limit(0), odd_docs).count() == 0


def test_passes_and_tiles_change_nothing(odd_docs, odd_items):
    whole = rows(lexical.search(odd_items, odd_docs, 4))
    assert rows(lexical.search(odd_items, odd_docs, 4, tile_items=1, pass_pairs=7)) == whole


def test_lexical_search_with_many_ties(spark):
    r = random.Random(3)
    docs = [(i % 50, " ".join(r.choices("a b c D é 9".split(), k=r.randint(0, 6)))) for i in range(120)]
    items = [(f"i{i}", " ".join(r.choices("a b c d É é zz".split(), k=r.randint(1, 5)))) for i in range(12)] + [(None, "a a a")]
    got = lexical.search(spark.createDataFrame(items, "item_id string, text string"), spark.createDataFrame(docs, "doc_id long, text string").repartition(5), 7)
    assert rows(got) == ranked(items, docs, 7)


def test_weights_of_many_digits_stay_exact():
    pairs = [(0, "x", 0, 10**8), (0, "x", 1, 3), (1, "y", 1, 2**21)]
    tile = lexical.Tile(pairs, np.array([30_000, 29_999]))
    got = tile.scores(np.array([0, 1, 1]), np.array([0, 0, 1]), np.array([999_999, 7, 5]), 2)
    assert got.tolist() == [[10**8 * 30_000 * 999_999 + 3 * 29_999 * 7, 3 * 29_999 * 5], [2**21 * 29_999 * 7, 2**21 * 29_999 * 5]]


def test_terms_of_long_texts_are_cut_between_terms():
    text = "Ab1-é_X " * 1000
    assert [t.decode() for piece in lexical.term_pieces(text.encode(), 10) for t in piece] == terms(text)


def mined(vectors, every, k_pos, k_neg, scale=256):
    """(anchor, positive, rank, negative, scores) by plain loops over the rows that take part."""
    own = [
        (i, vec_id, label, [math.floor(x * scale) for x in v])
        for i, (vec_id, label, v) in enumerate(vectors)
        if label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    last = lambda i: math.inf if i is None else i
    out = []
    for i, a, label, v in own:
        if a is None or a % every:
            continue
        score = sorted((-sum(x * y for x, y in zip(v, w)), last(b), b, lab) for j, b, lab, w in own if j != i)
        for s, _, b, _ in [x for x in score if x[3] == label][:k_pos]:
            window = [x for x in score if x[3] != label and 80 * -s <= 100 * -x[0] <= 100 * -s][:k_neg]
            out += [(a, b, r, x[2], -s, -x[0]) for r, x in enumerate(window, 1)]
    return sorted(out, key=str)


VECTORS = "vec_id long, label int, embedding array<double>"


def test_negatives_of_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    vectors = [(0, 1, [1.0, 0.5]), (100, 1, [0.9, 0.5]), (100, 1, [0.9, 0.5]), (1, 1, [1.0, 0.5]), (2, 2, [0.9, 0.5]), (3, 2, [0.9, 0.5]), (None, 2, [0.9, 0.5]),
               (4, 2, None), (5, None, [1.0, 1.0]), (6, 2, [nan, 1.0]), (7, 2, [inf, 0.0]), (8, 2, [None, 1.0]), (9, 2, []), (10, 1, [-1.0]), (11, 3, [1.0, 0.5, 0.1]), (200, 4, [1.0, 1.0])]
    table = spark.createDataFrame([(*v, 1.0, 2) for v in vectors], VECTORS + ", score double, rank int").repartition(3)
    assert rows(negatives.mine(table)) == mined(vectors, 100, 5, 5)
    assert negatives.mine(table.limit(0)).count() == 0
    assert negatives.mine(table.filter("vec_id = 200")).count() == 0


@pytest.mark.parametrize("seed,spread", [(1, 0.2), (2, 1.0), (3, 5e5)])
def test_negatives_against_brute_force(spark, monkeypatch, seed, spread):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(6, 7))
    vectors = [(i, int(r.integers(3)), (spread * (centres[i % 6] + 0.1 * r.normal(size=7)).round(1)).tolist()) for i in range(400)]
    vectors += [(400 + i, 1, vectors[0][2]) for i in range(150)]  # a third of the rows is one vector
    monkeypatch.setattr(negatives, "BLOCK_COMPONENTS", 900)
    monkeypatch.setattr(negatives, "ANCHOR_COMPONENTS", 70)
    got = rows(negatives.mine(spark.createDataFrame(vectors, VECTORS), every=20, codes=5))
    assert got and got == mined(vectors, 20, 5, 5)


def test_walk_ends_early_and_bounds_hold():
    import pandas as pd

    r = np.random.default_rng(5)
    centres = r.normal(size=(12, 16)) * 200
    whole = (np.repeat(centres, 50, axis=0) + r.normal(size=(600, 16)) * 10).astype(np.int64)
    books = negatives.Codebooks(8, negatives._codes(whole[:, :8].astype(float), 8), negatives._codes(whole[:, 8:].astype(float), 8))
    frame = pd.DataFrame({"row": range(600), "vec_id": range(600), "label": np.arange(600) % 2, "v": list(whole)})
    block = negatives.Block(frame, 16, books, float(np.abs(whole).max()))
    seen = list(block.cells(whole[3].astype(float)))
    assert sorted(i for _, cell in seen for i in block.rows[cell]) == list(range(600))
    scores = block.values @ whole[3].astype(float)
    for at, (bound, _) in enumerate(seen):
        assert all((scores[cell] <= bound).all() for _, cell in seen[at:])
    visited, gulps = 0, block.gulps

    def counted(anchor):
        nonlocal visited
        for bound, run in gulps(anchor):
            visited += len(run)
            yield bound, run

    block.gulps = counted
    block.same(whole[3], 1, 3, 5)
    assert visited < 300
