"""From raw documents to packed batches: five stages, each over all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotmill.llm import decontaminate, langid, minhash, packing, toxicity
from lotmill.llm.common import materialize, shield, table, unshield

#: A document is rejected below this share of letters in scripts of the learned languages.
KNOWN_SHARE = 0.5


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose letters are mostly in a script of a learned language, in one such language or in several.

    Learned from all documents of the stage that have a language. Null texts and texts without a
    letter are rejected. If no document has a language nothing can be told, and all stay. Columns are as they were.
    """
    model = langid.learn(docs.select("text", "lang"))
    if not model.languages:
        return docs
    labelled = langid.label(shield(docs, "text"), model)
    return unshield(labelled.filter((F.col("lang_pred") != langid.UNKNOWN) & (F.col("known") >= KNOWN_SHARE)), docs, "text")


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted toxic, learned from the labels of the stage's documents."""
    scorer = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return unshield(toxicity.score_texts(shield(docs, "text"), scorer).filter("predicted = 0"), docs, "text")


def duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: that with the smallest doc_id, of repeated rows one."""
    return minhash.one_of_each(docs)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece of every document in a token-budget batch."""
    return packing.pack(docs)


STAGES = [
    ("language", language_stage),
    ("toxicity", toxicity_stage),
    ("near duplicates", duplicates_stage),
    ("benchmark", benchmark_stage),
    ("packing", packing_stage),
]

# Classifiers and the bucket search are not expressible in SQL; a test holds run() against brute force, document by document.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written and read again before the next.

    Rows with null text and an empty table leave no rows; repeated rows count as copies, of which one stays.
    """
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
