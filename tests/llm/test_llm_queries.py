"""Registered queries: SQL where there is some, held-out accuracy and laws elsewhere."""

import pytest

import __spark_entry__ as contract
from compare import compare, connect
from llm_fixtures import SF_DIR
from lotmill.llm.queries import ORACLE, QUERIES

MEDIUM = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    connection = connect(SF_DIR)
    yield connection
    connection.close()


def test_each_operator_is_registered():
    names = contract.queries()
    assert all(any(name.startswith(f"op{n}_") for name in names) for n in range(1, 14))
    assert "pipeline" in names and "pipeline" not in contract.oracle_sql()


@pytest.mark.parametrize("name", list(ORACLE))
def test_query_matches_sql(spark, con, name):
    assert compare(QUERIES[name](spark, SF_DIR), con, ORACLE[name]) is None


def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet").toPandas()


def test_language_of_held_out_documents(spark):
    got = QUERIES["op9_langid"](spark, MEDIUM).toPandas().merge(documents(spark, MEDIUM), on="doc_id")
    held = got[got.held_out]
    assert len(got) == 1000 and len(held) > 200
    assert (held.lang_pred == held.lang).mean() > 0.98
    assert got.score.between(0, 1).all()


def test_toxicity_of_held_out_documents(spark):
    labels = spark.read.parquet(f"{MEDIUM}/labels.parquet").toPandas()
    scored = QUERIES["op1_toxicity"](spark, MEDIUM).toPandas()
    assert len(scored) == 1000 and scored.score.between(0, 1).all()
    assert (scored.predicted == (scored.score >= 0.5)).all()
    held = scored.merge(labels, on="doc_id")
    held = held[held.held_out]
    assert ((held.predicted == 1) & (held.toxic == 0)).sum() == 0
    assert (held.predicted == held.toxic).mean() > 0.93


def test_shards_keep_equal_texts_and_are_even(spark):
    docs = documents(spark, MEDIUM)
    got = QUERIES["op10_shards"](spark, MEDIUM).toPandas()
    both = got.merge(docs, on="doc_id")
    assert len(got) == len(docs)
    assert both.groupby("text").shard.nunique().max() == 1
    assert (both["size"] == both.text.str.encode("utf-8").str.len() + 8).all()
    loads = got.groupby("shard")["size"].sum()
    assert len(loads) == 24 and loads.max() - loads.min() < 0.02 * loads.mean()
    for _, slots in got.groupby("shard").slot:
        assert sorted(slots) == list(range(len(slots)))


def test_every_word_is_packed_once(spark):
    docs = documents(spark, MEDIUM)
    got = QUERIES["op2_packing"](spark, MEDIUM).toPandas()
    words = docs.text.map(lambda t: len(t.encode().split()))
    assert got.n_tokens.sum() == words.sum()
    assert (got.groupby("doc_id").n_tokens.sum() == words.groupby(docs.doc_id).sum()).all()
    assert (got.n_tokens <= got.bucket).all() and got.bucket.nunique() <= 8
    for bucket, own in got.groupby("bucket"):
        room = max(1, 16_384 // bucket)
        assert sorted(own.batch * room + own.slot) == list(range(len(own)))
