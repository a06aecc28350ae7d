"""run() against plain loops, document by document."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lotmill.llm import langid


def shingles(text):
    words = text.lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def survivors(docs, items, toxic):
    """(doc_id, text) left by the stages: letters of a known script, not toxic, one of each group, no item inside."""
    left = [(i, t) for i, t in docs if t and any(c.isalpha() and c < "Ѐ" for c in t) and i not in toxic]
    sets = {i: shingles(t) for i, t in left}
    group = {i: i for i in sets}
    for a in sorted(sets):
        for b in sorted(sets):
            if a < b and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                old, new = sorted((group[a], group[b]), reverse=True)
                group = {k: new if v == old else v for k, v in group.items()}
    first = [(i, t) for i, t in left if group[i] == i]
    return [(i, t) for i, t in first if not any(100 * len(sets[i] & shingles(x)) >= 75 * len(shingles(x)) for x in items)]


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    r = random.Random(8)
    vocabulary = {"en": "the house of a man and this garden with many flowers here".split(), "de": "der hund und die katze sind nicht im haus wo ich bin".split()}

    def prose(lang, n):
        return " ".join(r.choice(vocabulary[lang]) + r.choice(["", "s", "en", "ing"]) for _ in range(n))

    docs = [(i, prose("en" if i % 2 else "de", r.randint(20, 90)), "en" if i % 2 else "de") for i in range(60)]
    docs += [(100 + i, docs[i][1] + (" today" if i % 2 else ""), docs[i][2]) for i in range(8)]  # copies and near copies
    docs += [(200, "собака и кошка спят в доме на полу и за окном идёт снег", None), (201, "123 !!! 456", "en"), (202, None, "en"), (203, "", None)]
    docs += [(204, prose("en", 30) + " " + prose("de", 30), "en")]  # two known languages
    item = prose("en", 12)
    docs += [(300 + i, prose("en", 20) + " " + item + " " + prose("en", 20), "en") for i in range(3)]
    toxic = range(400, 430)
    docs += [(i, prose("en", 15) + " you stupid idiot moron idiot stupid " + prose("en", 15), "en") for i in toxic]
    labels = [(i, 1, int(i in toxic)) for i, _, _ in docs if i % 5 or i in toxic]
    folder = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame([(i, t, lang, "web", len(t or "")) for i, t, lang in docs], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, [(i, t) for i, t, _ in docs], [item], set(toxic)


def test_run_keeps_what_loops_keep(spark, corpus):
    folder, docs, items, toxic = corpus
    got = corpus_pipeline.run(spark, folder).toPandas()
    expected = survivors(docs, items, toxic)
    assert set(got.doc_id) == {i for i, _ in expected} and 204 in set(got.doc_id)
    words = got.groupby("doc_id").n_tokens.sum().to_dict()
    assert words == {i: len(t.split()) for i, t in expected}


def test_documents_without_any_language_stay(spark, corpus):
    docs = spark.read.parquet(f"{corpus[0]}/documents.parquet").withColumn("lang", F.lit(None).cast("string"))
    left = corpus_pipeline.language_stage(spark, docs, corpus[0])
    assert left.count() == docs.count() and left.columns == docs.columns


def test_a_text_of_three_languages_is_kept(spark):
    parts = {"en": "the cat and the dog are in the house", "de": "der hund und die katze sind im haus", "es": "el perro y el gato estan en la casa"}
    rows = [(i, parts[k], k) for i, k in enumerate(parts)] + [(9, " ".join(parts.values()), None), (10, "кошка и собака the", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r["doc_id"]: r for r in langid.label(docs, langid.learn(docs.select("text", "lang"))).collect()}
    assert got[9]["score"] < 0.5 and got[9]["known"] == 1.0 and got[10]["known"] < 0.5
    assert sorted(r["doc_id"] for r in corpus_pipeline.language_stage(spark, docs, "").collect()) == [0, 1, 2, 9]
