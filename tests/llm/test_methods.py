"""Each operator's method against brute force on small random inputs."""

import itertools
import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from llm_fixtures import PROSE

from lotmill.llm import common, decontaminate, langid, licenses, lm, minhash, packing, sharding, topk, toxicity, urls
from lotmill.llm.components import component_roots


# ---- shared helpers


def test_words_split_at_ascii_blanks_only():
    assert common.words("A b\u00a0C\x0bD\x1cE") == [b"a", "b\u00a0c".encode(), b"d\x1ce"]


def test_numbers_have_no_gap_in_a_hot_group(spark):
    rows = spark.range(3000).selectExpr("id AS r", "CASE WHEN id < 2900 THEN 'hot' ELSE 'cold' END AS g")
    got = common.number_within(rows, "g", [], "r", "n").toPandas()
    for _, own in got.groupby("g"):
        assert sorted(own.n) == list(range(len(own)))


def test_components(spark):
    rng = random.Random(1)
    edges = [(i + 1, i) for i in range(100, 160)] + [(500, k) for k in range(501, 560)]
    edges += [(rng.randrange(200, 300), rng.randrange(200, 300)) for _ in range(60)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    want = {x: find(x) for x in parent if find(x) != x}
    got = {r["node"]: r["root"] for r in component_roots(spark.createDataFrame(edges, "hi long, lo long")).collect()}
    assert got == want
    assert component_roots(spark.createDataFrame([], "hi long, lo long")).isEmpty()


# ---- 1


def summed(votes, weight=None):
    """Statistics of a matrix of votes, for posteriors by a given function."""

    def statistics(posterior):
        s = toxicity.VoteStatistics.none(votes.shape[1])
        s.add(votes, posterior(votes), np.ones(len(votes)) if weight is None else weight)
        return s

    return statistics


def test_label_model_finds_good_and_correlated_voters():
    rng = np.random.default_rng(0)
    y = rng.random(4000) < 0.2
    votes = np.zeros((4000, 8))
    for j in range(6):
        votes[:, j] = np.where(y, rng.random(4000) < 0.6, rng.random(4000) < 0.003)
    votes[:, 6] = votes[:, 0]  # a copy
    votes[:, 7] = rng.random(4000) < 0.02  # says nothing
    model = toxicity.fit_label_model(summed(votes), 0.2)
    q = model.posterior(votes)
    assert ((q > 0.5) == y).mean() > 0.97
    assert model.accuracy[0] > 0.9
    assert model.discount_toxic[0] < model.discount_toxic[1] == 1
    own = (rng.random((2000, 3)) < 0.2).astype(float)
    own[:, 2] = own[:, 0]
    r = toxicity._correlation(own.T @ own, own.sum(axis=0), len(own))
    assert r[0] == r[2] > 0.7 and r[1] == 0


def test_posterior_of_a_tiny_label_model_against_all_vote_sets():
    model = toxicity.LabelModel(0.2, np.array([0.5, 0.4, 0.1]), np.array([0.01, 0.1, 0.2]), np.array([1.0, 0.5, 1.0]), np.array([1.0, 0.25, 1.0]), (0.3, 0.6))
    for own in itertools.product((0, 1), repeat=3):
        toxic, clean = 0.2, 0.8
        for k in range(3):
            # A voter that speaks for the clean class more than for the toxic one has no say.
            says = model.on_toxic[k] ** model.discount_toxic[k] / model.on_clean[k] ** model.discount_clean[k]
            toxic *= max(says, 1) if own[k] else 1
        if not any(own):
            toxic, clean = toxic * 0.3, clean * 0.6
        assert np.isclose(model.posterior(np.array([own], float))[0], toxic / (toxic + clean))


def test_label_model_is_the_same_by_tasks_and_in_one_matrix(spark):
    rng = np.random.default_rng(5)
    y = rng.random(3000) < 0.25
    votes = np.column_stack([np.where(y, rng.random(3000) < 0.5, rng.random(3000) < 0.02) for _ in range(6)]).astype(float)
    votes[:, 4] = votes[:, 1]
    one = toxicity.fit_label_model(summed(votes), 0.2)
    # Voter 2 of the table has no place in the model; sets that then are equal stand apart in it.
    table, place = np.insert(votes, 2, rng.random(3000) < 0.5, axis=1), np.array([0, 1, -1, 2, 3, 4, 5])
    rows = [([int(k) for k in np.flatnonzero(own)],) for own in table]
    sets = spark.createDataFrame(rows, "k array<int>").groupBy("k").agg(F.count("*").alias("docs")).repartition(5)
    many = toxicity.fit_label_model(lambda posterior: toxicity.sum_votes(sets, place, posterior), 0.2)
    for name in ("prior", "on_toxic", "on_clean", "discount_toxic", "discount_clean", "silence"):
        assert np.allclose(getattr(one, name), getattr(many, name)), name


def test_rare_toxic_words_outside_the_fit_sample_are_voters(spark, monkeypatch):
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choice(PROSE) for _ in range(20)) + (" grubblesnark" if i % 20 == 0 else "") + (" " + "x" * 60 if i % 20 == 1 else "")) for i in range(2000)]
    docs = spark.createDataFrame(rows + rows[:3] + [(None, "x"), (9999, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 20 < 2)) for i in range(2500)], "doc_id long, toxic int")
    scorer = toxicity.fit(docs, labels, most=300)
    assert {"=grubblesnark", "=" + "x" * 60} <= set(scorer.names)
    assert scorer.score("the grubblesnark") >= 0.5 and scorer.score("so " + "x" * 60) >= 0.5 and scorer.score("the cat sat") < 0.5
    # Beyond the bound the labels are shuffled, with the same result.
    monkeypatch.setattr(toxicity, "BROADCAST_LABELS", 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        shuffled = toxicity.fit(docs, labels, most=300)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert shuffled.names == scorer.names and np.allclose(shuffled.weights, scorer.weights, atol=1e-4)


def test_linear_model_fits_soft_labels():
    x = np.array([[0.0], [0.0], [1.0], [1.0]])
    w, b = toxicity.fit_linear(x, np.array([0.2, 0.2, 0.7, 0.7]), ridge=1e-9)
    p = 1 / (1 + np.exp(-(x @ w + b)))
    assert np.allclose(p, [0.2, 0.2, 0.7, 0.7], atol=1e-3)


# ---- 2


@pytest.mark.parametrize("seed", range(20))
def test_boundaries_have_the_least_padding(seed):
    rng = np.random.default_rng(seed)
    lengths = np.sort(rng.choice(np.arange(1, 40), rng.integers(1, 8), replace=False)).astype(np.int64)
    counts = rng.integers(1, 9, len(lengths)).astype(np.int64)
    buckets = int(rng.integers(1, 5))

    def padding(bounds):
        own = np.array(bounds)[np.searchsorted(bounds, lengths)]
        return int(((own - lengths) * counts).sum())

    tries = [
        sorted({*inner, int(lengths[-1])})
        for n in range(min(buckets, len(lengths)))
        for inner in itertools.combinations(lengths.tolist(), n)
    ]
    best = packing.best_boundaries(lengths, counts, buckets)
    assert len(best) <= buckets and padding(best) == min(map(padding, tries))


# ---- 3


def test_automaton_against_the_formula():
    texts = ["a b a b c", "a b", None, "c c c a", "b unseen a"]
    train = np.array([True, True, True, True, False])
    g = lm.grams(texts, train)
    own = [["<s>", *(t.split() if t else []), "</s>"] for t in texts]
    words, pairs = {}, {}
    for o, t in zip(own, train):
        for v, w in zip(o, o[1:]):
            if t:
                words[w] = words.get(w, 0) + 1
                pairs[v, w] = pairs.get((v, w), 0) + 1
    n, v_ = sum(words.values()), len(words)
    plain = lambda w: (words.get(w, 0) + 1) / (n + v_ + 1)
    history = words | {"<s>": 4}
    model = lm.automaton(g, g.word_train, g.pair_train, (n, v_, 4), 2.0)
    ends = np.append(g.starts[1:], len(g.word_at))
    for o, a, b in zip(own, g.starts, ends):
        want = sum(math.log10((pairs.get((v, w), 0) + 2 * plain(w)) / (history.get(v, 0) + 2)) for v, w in zip(o, o[1:]))
        assert model.score(g.word_at[a:b].tolist()) == pytest.approx(want)
    total = sum(plain(w) for w in words) + plain("new")
    assert total == pytest.approx(1)


def test_packed_numbers_come_back():
    keys = np.sort(np.random.default_rng(0).integers(0, 2**64, 1000, dtype=np.uint64))
    assert (lm.unpack_sorted(lm.pack_sorted(keys)) == keys).all()
    counts = np.arange(70_000, dtype=np.uint32)
    assert (lm.unpack(lm.pack(counts), np.uint32) == counts).all()
    parts = list(lm._by_shard(keys, np.ones(1000, np.int64), 7))
    assert (np.concatenate([lm.unpack_sorted(k) for _, k, _ in parts]) == keys).all()


def test_scores_do_not_depend_on_the_blocks(spark, monkeypatch):
    rows = [(i, " ".join(random.Random(i % 7).choices("a b c d e f".split(), k=30)), None) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    whole = sorted(map(tuple, lm.score_documents(docs).collect()))
    monkeypatch.setattr(lm, "BLOCK_BYTES", 200)
    assert sorted(map(tuple, lm.score_documents(docs).collect())) == whole


# ---- 4


def sets_of(n, rng, size=60, edits=(0, 30)):
    base = rng.integers(0, 2**63, size, dtype=np.uint64)
    out = []
    for _ in range(n):
        own = base.copy()
        k = int(rng.integers(*edits))
        own[rng.choice(size, k, replace=False)] = rng.integers(0, 2**63, k, dtype=np.uint64)
        out.append(np.unique(own))
    return out


def test_estimates_are_close():
    rng = np.random.default_rng(3)
    for size in (1, 3, 40, 700, 9000):
        for share in (0.0, 0.5, 0.8, 1.0):
            a = rng.integers(0, 2**63, size, dtype=np.uint64)
            b = a.copy()
            k = round(size * (1 - share))
            b[:k] = rng.integers(0, 2**63, k, dtype=np.uint64)
            a, b = np.unique(a), np.unique(b)
            shared = len(np.intersect1d(a, b))
            want = shared / (len(a) + len(b) - shared)
            got = minhash.estimate(minhash.sketch(a)[None], minhash.sketch(b)[None], np.array([len(a)]), np.array([len(b)]))[0]
            assert abs(got - want) < 0.17


def test_registers_are_compressed_in_order():
    # A smaller value has more leading zeros, or as many and a smaller mantissa.
    least = np.array([1, 2, 3, 2**20, 2**31, 2**32 - 1, (3 << 32) | 5, (900 << 32) | 5], np.uint64)
    code = minhash.compress(least)
    zeros = code >> minhash.MANTISSA
    assert zeros.tolist() == [31, 30, 30, 11, 0, 0, 35, 63]
    assert code[5] & 1023 == 1023 and code[4] & 1023 == 0


def test_cells_join_all_that_is_linked():
    rng = np.random.default_rng(5)
    sets = sets_of(60, rng)
    nodes = np.arange(60)
    registers = np.array([minhash.sketch(s) for s in sets])
    found = minhash.links_of_cell(nodes, sets, registers, np.where(nodes < 5, 0, nodes))

    def groups(pairs):
        f = minhash._Forest(60)
        for a, b in pairs:
            f.join(a, b)
        return {tuple(x for x in range(60) if f.find(x) == f.find(y)) for y in range(60)}

    every = [(a, b) for a in range(60) for b in range(a) if minhash.linked(minhash._shared(sets[a], sets[b]), len(sets[a]), len(sets[b]))]
    start = [(k, 0) for k in range(1, 5)]
    assert groups(found + start) == groups(every + start)
    assert all(minhash.linked(minhash._shared(sets[a], sets[b]), len(sets[a]), len(sets[b])) for a, b in found)


def test_near_duplicates_against_all_pairs(spark, monkeypatch):
    # Small limits, so that stars, small buckets and cells of several blocks all take part.
    monkeypatch.setattr(minhash, "SMALL", 3)
    monkeypatch.setattr(minhash, "BLOCK", 8)
    rng = random.Random(2)
    vocabulary = [f"w{i}" for i in range(500)]
    texts = []
    for _ in range(6):
        base = rng.choices(vocabulary, k=rng.randrange(3, 90))
        for _ in range(25):
            own = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 5])):
                own[rng.randrange(len(own))] = rng.choice(vocabulary)
            texts.append(" ".join(own))
    rows = [(i, t) for i, t in enumerate(texts)]
    rng.shuffle(rows)
    got = {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    sets = [set(common.shingle_hashes(t).tolist()) for t in texts]
    forest = minhash._Forest(len(texts))
    for a in range(len(texts)):
        for b in range(a):
            if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                forest.join(a, b)
    first = {}
    for i in range(len(texts)):
        first.setdefault(forest.find(i), i)
    assert got == {i: first[forest.find(i)] for i in range(len(texts))}


# ---- 5


def test_license_rules(spark):
    mit = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"
    notice = "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."
    texts = [
        (1, f"// {mit}\n//\n// {notice}\n"),
        (2, f"{mit} Something else. {notice}"),
        (3, "Licensed under the Apache License, Version 2.0 (the \"License\");\nyou may not use this file except in\ncompliance with the License."),
        (4, "Copyright (c) 2020 Somebody.\nAll rights reserved.\nReleased under the MIT License. Released under the MIT License."),
        (5, "A licence of no kind. MIT License."),
        (6, None), (7, ""), (8, "x" * 200_000 + " All rights reserved."), (9, "Words. All rights reserved. More words."),
    ]
    docs = spark.createDataFrame([(*t, "c", "d") for t in texts], "doc_id long, text string, license string, rule string")
    got = sorted((r["doc_id"], r["license"], r["rule"], r["n_sentences"]) for r in licenses.licenses(docs).collect())
    by = {}
    for doc, name, rule, n in got:
        by.setdefault(doc, []).append((name, rule, n))
    assert by[1] == [("MIT", 3, 2)]
    assert by[2] == [("MIT", 10, 2)]  # the notice alone says nothing
    assert by[3] == [("Apache-2.0", 1, 2)]
    assert sorted(x[0] for x in by[4]) == ["MIT", "Proprietary"] and by[4][0][2] == 4
    assert by[9] == [("Proprietary", 23, 1)]
    assert set(by) <= {1, 2, 3, 4, 8, 9} and licenses.licenses(docs.limit(0)).isEmpty()


# ---- 6


@pytest.mark.parametrize("big", [1, 2**20, 2**45])
def test_top_k_against_all_products(spark, monkeypatch, big):
    monkeypatch.setattr(topk, "CELL", 4)
    rng = np.random.default_rng(4)
    n = 70
    v = (rng.integers(-3, 4, (n, 12)) * (rng.random((n, 12)) < 0.5)).astype(object) * big
    frame = spark.createDataFrame([(i, i, v[i].tolist()) for i in range(n)], "row long, vec_id long, v array<long>").repartition(3)
    got = topk.exact_top_k(frame.filter("vec_id % 20 = 0"), frame, 7).collect()
    found = {}
    for r in got:
        found.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    for q in range(0, n, 20):
        scores = [(-min(max(int((v[q] * v[c]).sum()), -topk.LONG), topk.LONG), c) for c in range(n) if c != q]
        want = [(k + 1, c, -s) for k, (s, c) in enumerate(sorted(scores)[:7])]
        assert sorted(found[q]) == want


# ---- 7


def test_short_items_inside_long_documents(spark):
    rng = random.Random(5)
    vocabulary = list("abcdefgh")
    texts = [" ".join(rng.choices(vocabulary, k=k)) for k in (1, 2, 3, 4, 5, 9, 30, 200) for _ in range(4)] + [None, ""]
    items = [" ".join(rng.choices(vocabulary, k=k)) for k in (1, 2, 3, 4) for _ in range(5)] + ["", "z", "a z"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = sorted((r["doc_id"], r["item_id"], r["item_shingles"], r["shared"]) for r in decontaminate.contamination(docs, benchmark).collect())
    assert got == sorted((d, i, 1, 1) for d, t in enumerate(texts) for i, x in enumerate(items) if t and x and f" {x} " in f" {t} ")


def test_containment_search_finds_all():
    rng = random.Random(7)
    vocabulary = [f"w{i}" for i in range(3000)]
    items = [rng.choices(vocabulary, k=k) for k in (5, 6, 9, 20, 33, 64, 65, 120) for _ in range(6)]
    index = decontaminate.ItemIndex([(i, common.shingle_hashes(" ".join(t))) for i, t in enumerate(items)])
    missed = total = 0
    for trial in range(120):
        k = trial % len(items)
        own = list(items[k])
        if len(own) > 20 and trial % 3 == 0:
            own[rng.randrange(len(own))] = "changed"
        place = rng.randrange(2000)
        words = rng.choices(vocabulary, k=place) + own + rng.choices(vocabulary, k=1500)
        if trial % 4 == 0 and len(own) >= 33:  # in two parts, far apart
            half = len(own) // 2
            words = own[: half + 2] + rng.choices(vocabulary, k=900) + own[half - 2 :]
        shingles = common.shingle_hashes(" ".join(words))
        document = np.unique(shingles)
        if 100 * index.contained(k, document) >= 75 * len(index.sets[k]):
            total += 1
            missed += k not in index.candidates(shingles)
    assert total > 90 and missed == 0


def test_windows_hold_their_items():
    for size in range(8):
        length, step = decontaminate.window_of(size)
        for n in range(2 ** (size - 1) + 1 if size else 1, 2**size + 1):
            assert decontaminate.size_class(n) == size
            assert all(-(-place // step) * step - place <= length - n or place // step * step + length >= place + n for place in range(3 * length))


# ---- 8


def test_url_rules_against_a_loop(spark):
    rng = random.Random(3)
    hosts = ["com", "a.com", "b.a.com", "c.b.a.com", "xa.com", "net", "n.net", "a.net", "www.a.net"]
    paths = ["/", "/x", "/x/", "/x/y", "/xy", "/x/y/z", "", "/\u00e9", "/\U0001f600/"]
    rules = list({(rng.choice(hosts), rng.choice(paths), rng.choice(["allow", "block"])) for _ in range(40)})
    pages = [(i, f"http://{rng.choice(hosts + ['z.' + h for h in hosts] + [''])}{rng.choice(paths)}{rng.choice(['', '1', '?q/x', '#/x', 'y/z'])}") for i in range(300)]
    got = urls.judge_urls(
        spark.createDataFrame(pages, "page_id long, url string"), spark.createDataFrame(rules, "host string, path string, verdict string"), parts=4
    ).collect()
    best = {}
    for host, path, verdict in rules:
        best[host, path] = max(verdict, best.get((host, path), verdict))
    for r in got:
        fits = [
            (len(h) + len(p), len(h), h + p, v)
            for (h, p), v in best.items()
            if (r["host"] == h or r["host"].endswith("." + h)) and r["path"].startswith(p)
        ]
        want = max(fits)[2:] if fits else (None, "allow")
        assert (r["rule"], r["verdict"]) == want, (r, fits)
    assert len(got) == 300


def test_url_sweep_has_each_rule_once_and_carries_stacks_over_ranges(spark):
    hosts = spark.range(3000).selectExpr("concat('h', id % 1500, IF(id < 1500, '.com', '.org')) AS host", "concat('/', id % 7) AS path", "IF(id % 2 = 0, 'block', 'allow') AS verdict")
    rules = hosts.unionAll(spark.createDataFrame([("com", "/", "block"), ("hot.com", "/", "allow"), ("hot.com", "/a/b", "block")], hosts.schema))
    # A hot url with a third of all rows, so that ranges begin inside it.
    pages = spark.range(6000).selectExpr("id AS page_id", "IF(id % 3 = 0, 'https://x.hot.com/a/b?q', concat('https://w.h', id % 1500, '.com/', id % 9)) AS url")
    prefixes = rules.select(F.lit("").alias("space"), urls.reversed_host(F.col("host")).alias("prefix")).distinct()
    assert urls.rule_events(prefixes).count() == 2 * prefixes.count()
    got = urls.judge_urls(pages, rules, parts=16).collect()
    known = {(r["host"], r["path"]): r["verdict"] for r in rules.collect()}
    assert len(got) == 6000
    for r in got:
        labels = r["host"].split(".")
        ends = [".".join(labels[i:]) for i in range(len(labels))]
        fits = [(len(h) + n, h + r["path"][:n], known[h, r["path"][:n]]) for h in ends for n in range(len(r["path"]) + 1) if (h, r["path"][:n]) in known]
        assert (r["rule"], r["verdict"]) == max(fits)[1:], (r, fits)
    dealt = urls.sweep(pages.select(F.lit("").alias("space"), F.lit("com.hot.x.").alias("key"), F.col("page_id").alias("page_row")), prefixes, 8, "test-hot")
    assert {tuple(r["stack"]) for r in dealt.collect()} == {("com.", "com.hot.")}


def test_url_plan_is_native(spark):
    df = urls.judge_urls(spark.createDataFrame([(1, "a://b")], "page_id long, url string"), urls.rule_table(spark))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


# ---- 9


def test_viterbi_of_a_long_text_keeps_small_differences():
    rng = np.random.default_rng(3)
    truth = np.repeat(rng.integers(0, 4, 400), 50)
    scores = rng.normal(-1e5, 2, (len(truth), 4)).astype(np.float32)
    scores[np.arange(len(truth)), truth] += np.float32(2)
    texts = np.zeros(len(truth), np.int64)
    exact = langid.viterbi(scores.astype(np.float64) + 1e5, texts, 1)
    assert (langid.viterbi(scores, texts, 1) == exact).mean() > 0.999


def test_viterbi_against_all_paths():
    rng = np.random.default_rng(9)
    lengths = [5, 0, 1, 4, 6]
    texts = np.repeat(np.arange(5), lengths)
    scores = rng.integers(-9, 0, (len(texts), 3)).astype(np.float32)
    path = langid.viterbi(scores, texts, 5, switch=4.0)
    for t in range(5):
        own = scores[texts == t]
        value = lambda p: sum(own[i, k] for i, k in enumerate(p)) - 4 * sum(a != b for a, b in zip(p, p[1:]))
        if len(own):
            best = max(value(p) for p in itertools.product(range(3), repeat=len(own)))
            assert value(path[texts == t].tolist()) == best


def test_spans_of_mixed_text(spark):
    rows = [("the cat and the dog are in the house with the others", "en"), ("der hund und die katze sind im haus mit den anderen", "de"),
            ("собака и кошка в доме", "ru")] * 20
    model = langid.learn(spark.createDataFrame(rows, "text string, lang string"))
    text = "the dog and the others are in the house и кошка в доме der hund und die katze sind mit den anderen im haus"
    langs, scores, spans = langid._labelled(model, [text, "", "123"])
    assert [s["lang"] for s in spans[0]] == ["en", "ru", "de"]
    assert [s["n_words"] for s in spans[0]] == [9, 4, 11] and spans[0][2]["first_word"] == 13
    assert langs[1:] == ["und", "und"] and 0 < scores[0] < 1
    # A script that only one language was learned with leaves that one.
    greek = langid._labelled(model, ["λόγος"])
    assert greek[0][0] in ("en", "de", "ru")
    assert langid._labelled(model, ["кот"])[0] == ["ru"]


# ---- 10


@pytest.mark.parametrize("seed", range(10))
def test_longest_first_against_a_loop(seed):
    rng = random.Random(seed)
    items = [(rng.randrange(1, 50), k) for k in range(rng.randrange(1, 30))]
    loads, want = [0] * 4, {}
    for size, key in sorted(items, key=lambda x: (-x[0], x[1])):
        shard = loads.index(min(loads))
        loads[shard] += size
        want[key] = shard
    assert sharding.longest_first(items, 4) == want


def test_light_groups_go_in_bundles(spark, monkeypatch):
    from pyspark.sql import functions as F

    monkeypatch.setattr(sharding, "ITEMS_PER_SHARD", 8)
    frame = pd.DataFrame({"g": [f"g{i % 400}" for i in range(2000)] + ["hot"] * 900, "s": 3})
    got = sharding.assign_shards(spark.createDataFrame(frame), 4, F.col("g"), F.col("s")).toPandas()
    assert got.groupby("g").shard.nunique().max() == 1
    loads = got.groupby("shard").s.sum()
    assert loads.max() == 2700 and loads.drop(loads.idxmax()).max() < 1.25 * loads.drop(loads.idxmax()).min()


def test_texts_are_labelled_a_bounded_part_at_a_time(spark):
    model = langid.learn(spark.createDataFrame([("the cat and the dog", "en"), ("der hund und die katze", "de")], "text string, lang string"))
    docs = [("the dog and the cat " * (i % 7 * 300), i) for i in range(300)]
    parts = []

    class Docs:
        """Stands for a table whose rows are worked on here."""

        schema = spark.createDataFrame([], "text string, i int").schema

        def drop(self, *names):
            return self

        def mapInArrow(self, run, schema):
            import pyarrow as pa

            texts, ids = zip(*docs)
            batch = pa.RecordBatch.from_arrays([pa.array(texts), pa.array(ids, pa.int32())], names=["text", "i"])
            parts.extend(run(iter([batch])))

    langid.label(Docs(), model)
    assert sum(p.num_rows for p in parts) == 300
    most = max(sum(len(t) for t in p.column("text").to_pylist()) for p in parts)
    assert most <= 1_000_000
    want = [langid._labelled(model, [t]) for t, _ in docs]
    assert [x for p in parts for x in p.column("lang_pred").to_pylist()] == [w[0][0] for w in want]
    assert [x for p in parts for x in p.column("score").to_pylist()] == [w[1][0] for w in want]


def test_terms_are_counted_in_one_python_step_where_labels_are_sent(spark, monkeypatch):
    rows = [(1, "You IDIOT, you idiot moronically", 1), (2, "a moronical word", 0), (3, "", 1), (4, "1 2 3", 0), (5, "no label", None), (5, "no label", None), (2, "again Idiot", 0)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    known = spark.createDataFrame(sorted({(i, y) for i, _, y in rows if y is not None}), "doc_id long, toxic int")
    expected = {}
    for _, text, y in rows:
        if y is not None:
            for t in toxicity.terms(set(toxicity.letters(text))):
                n, pos = expected.get(t, (0, 0))
                expected[t] = (n + 1, pos + y)
    plans = []
    mined = toxicity.mined_terms

    def spied(labelled, n, toxic):
        counts = toxicity.term_counts(labelled)
        plans.append((counts._jdf.queryExecution().executedPlan().toString(), {r["term"]: (r["n"], r["pos"]) for r in counts.collect()}))
        return mined(labelled, n, toxic)

    monkeypatch.setattr(toxicity, "mined_terms", spied)
    for most in (10, 0):  # sent, shuffled
        monkeypatch.setattr(toxicity, "BROADCAST_LABELS", most)
        toxicity.fit(docs, known)
    (sent, counts), (_, shuffled) = plans
    assert counts == shuffled == expected
    assert sent.count("MapInArrow") == 1


def test_rows_that_stay_are_sent_to_the_texts(spark):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(1, text, "a"), (2, text + " end", "b"), (3, "other words that stand alone here", "c"), (4, "", "d"), (4, "", "d"), (None, text, "e")]
    kept = minhash.one_of_each(spark.createDataFrame(rows, "doc_id long, text string, _row string"))
    assert sorted(tuple(r) for r in kept.collect()) == sorted([rows[0], rows[2], rows[3], rows[4]])
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
