"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns, for every operator and stage."""

import pytest

import corpus_pipeline
from lotmill.llm import decontaminate, langid, lm, minhash, packing, sharding, topk, toxicity, urls
from llm_fixtures import SF_DIR, no_docs, odd_docs, odd_items, odd_labels  # noqa: F401


def by_id(df):
    return sorted(df.collect(), key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0))


def test_near_duplicates(odd_docs, no_docs):
    got = {r["doc_id"]: r for r in minhash.near_duplicates(odd_docs).collect() if r["doc_id"] is not None}
    assert [got[k]["component_id"] for k in (0, 1, 2, 3, 4, 5, 8, 9)] == [0, 0, 0, 3, 4, 5, 8, 8]
    assert [got[k]["n_shingles"] for k in (3, 4, 5, 8)] == [0, 0, 0, 1]
    assert [got[k]["kept"] for k in (0, 1, 2, 3, 9)] == [True, False, False, True, False]
    assert got[7]["n_shingles"] == 9000
    rows = minhash.near_duplicates(odd_docs).collect()
    assert len(rows) == 16 and all(r["kept"] and r["component_id"] is None for r in rows if r["doc_id"] is None)
    assert minhash.near_duplicates(no_docs).count() == 0


def test_language(odd_docs, no_docs):
    got = {r["doc_id"]: r for r in langid.identify(odd_docs).collect() if r["doc_id"] is not None}
    assert [got[k]["lang_pred"] for k in (3, 4, 5, 6)] == ["und"] * 4
    assert got[3]["score"] == 0.0 and got[3]["spans"] == []
    assert langid.identify(no_docs).count() == 0
    assert {r["lang_pred"] for r in langid.label(odd_docs, langid.learn(no_docs)).collect()} == {"und"}


def test_toxicity(odd_docs, no_docs, odd_labels):
    rows = toxicity.toxicity(odd_docs, odd_labels).collect()
    assert len(rows) == 16 and all(0 <= r["score"] <= 1 for r in rows)
    got = {r["doc_id"]: r for r in rows if r["doc_id"] is not None}
    assert got[12]["score"] > got[4]["score"] == got[3]["score"]
    assert toxicity.toxicity(no_docs, odd_labels).count() == 0
    assert toxicity.toxicity(odd_docs, odd_labels.limit(0)).count() == 16


def test_lm(odd_docs, no_docs):
    got = by_id(lm.score_documents(odd_docs))
    assert len(got) == 16
    ids = {r["doc_id"]: r for r in got}
    assert [ids[k]["n_tokens"] for k in (3, 4, 5, 8, 7)] == [1, 1, 1, 4, 60_001]
    assert ids[0]["score"] == ids[1]["score"] and ids[3]["score"] == ids[4]["score"]
    assert all(r["held_out"] is not None for r in got)
    assert lm.score_documents(no_docs).count() == 0


def test_decontamination(odd_docs, no_docs, odd_items):
    got = {(r["doc_id"], r["item_id"], r["item_shingles"], r["shared"]) for r in decontaminate.contamination(odd_docs, odd_items).collect()}
    assert {(d, i) for d, i, _, _ in got} == {(0, 1), (1, 1), (2, 1), (8, 2), (9, 2)}
    assert all(size == shared for _, _, size, shared in got)
    assert decontaminate.contamination(no_docs, odd_items).count() == 0
    assert decontaminate.contamination(odd_docs, odd_items.limit(0)).count() == 0
    left = decontaminate.clean_documents(odd_docs, odd_items)
    assert left.columns == odd_docs.columns and left.count() == 10


def test_slices_of_the_benchmark_change_nothing(odd_docs, odd_items):
    whole = decontaminate.contamination(odd_docs, odd_items)
    parts = decontaminate.contamination(odd_docs, odd_items, most=5)
    keys = ("doc_id", "item_id", "shared")
    assert sorted(map(tuple, whole.select(*keys).collect())) == sorted(map(tuple, parts.select(*keys).collect()))


def test_packing(odd_docs, no_docs):
    got = packing.pack(odd_docs, max_tokens=1000).toPandas()
    assert sorted(got[got.doc_id == 7].n_tokens) == [1000] * 60
    assert len(got[got.doc_id == 2]) == 2
    assert not set(got.doc_id.dropna()) & {3, 4, 5}
    assert packing.pack(no_docs).count() == 0


def test_sharding(odd_docs, no_docs):
    got = sharding.shard_documents(odd_docs, 3).toPandas()
    assert len(got) == 16 and set(got.shard) == {0, 1, 2}
    nulls = got[got.text_crc32.isna()]
    assert len(nulls) == 2 and nulls.shard.nunique() == 1 and (nulls["size"] == 8).all()
    assert got[got.doc_id == 2].shard.nunique() == 1
    for _, slots in got.groupby("shard").slot:
        assert sorted(slots) == list(range(len(slots)))
    assert sharding.shard_documents(no_docs).count() == 0


def test_urls(spark):
    rows = [(1, None), (2, ""), (3, "no scheme"), (4, "http://"), (5, "HTTP://WWW.Example.COM/en/1?q#f"), (5, "HTTP://WWW.Example.COM/en/1?q#f"),
            (None, "https://a.net/es/"), (6, "https://net/fr/" + "x" * 100_000), (7, "x://exampleXcom/en/"), (8, "a://b://c.com/d")]
    pages = spark.createDataFrame([(*r, "x", "y") for r in rows], "page_id long, url string, rule string, host string")
    got = urls.judge_urls(pages, urls.rule_table(spark))
    ids = [(r["page_id"], r["host"], r["rule"], r["verdict"]) for r in got.collect()]
    assert len(ids) == 10 and ids.count((5, "www.example.com", "www.example.com/en/", "allow")) == 2
    assert {(1, "", None, "allow"), (2, "", None, "allow"), (3, "", None, "allow"), (4, "", None, "allow"), (None, "a.net", "net/es/", "block"),
            (6, "net", "net/fr/", "block"), (7, "examplexcom", None, "allow"), (8, "b:", None, "allow")} <= set(ids)
    assert urls.judge_urls(pages.limit(0), urls.rule_table(spark)).count() == 0
    assert {r["rule"] for r in urls.judge_urls(pages, urls.rule_table(spark).limit(0)).collect()} == {None}


def test_top_k(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (20, [-1.0, 2.0]), (3, None), (4, [1.0, None]), (5, [nan, 1.0]), (6, [inf, 1.0]),
            (7, []), (8, [3.0]), (None, [1.0, 0.0]), (20, [-1.0, 2.0])]
    vectors = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, score int")
    got = [(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in topk.search(vectors, k=4).orderBy("query_id", "rank").collect()]
    assert got[:4] == [(0, 1, 8, 12288), (0, 2, 1, 4096), (0, 3, 2, 4096), (0, 4, None, 4096)]
    assert [g for g in got if g[0] == 20][:2] == [(20, 1, 20, 20480)] * 2  # two rows of the same id meet each other
    assert topk.search(vectors.limit(0)).count() == 0


@pytest.mark.parametrize("stage", corpus_pipeline.STAGES[:-1], ids=lambda s: s[0])
def test_stages_keep_columns(spark, odd_docs, no_docs, stage):
    got = stage[1](spark, odd_docs, SF_DIR)
    assert got.columns == odd_docs.columns and 0 < got.count() <= 16
    assert all(r["score"] == "score" and r["source"] == "s" for r in got.collect())
    assert stage[1](spark, no_docs, SF_DIR).count() == 0


def test_duplicate_stage_keeps_one_of_each(spark, odd_docs):
    kept = corpus_pipeline.duplicates_stage(spark, odd_docs, SF_DIR)
    ids = [r["doc_id"] for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == [0, 3, 4, 5, 6, 7, 8, 10, 11, 12] and ids.count(None) == 2
