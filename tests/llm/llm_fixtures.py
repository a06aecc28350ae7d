"""Fixtures of the operators' tests; imported by name, as a second conftest would hide the first."""

import os

import pytest
from pyspark.sql import functions as F

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
# Names that operators use for columns of their own.
CLASHING = ["score", "node", "block", "shard", "_row", "lang_pred", "root", "predicted", "spans", "item_id", "bucket", "n_shingles"]
PROSE = "the cat sat on the mat and looked at the moon while nobody in the house was awake".split()


def document_rows():
    """(doc_id, text, lang): nulls, empty, blank and very long texts, copies, repeated rows, other scripts."""
    copy = " ".join(PROSE * 2)
    near = " ".join(PROSE * 2 + ["today"])
    return [
        (0, copy, "en"),
        (1, copy.upper(), "en"),
        (2, near, "en"),
        (2, near, "en"),
        (3, None, "en"),
        (4, "", "en"),
        (5, " \t\n\x0b ", None),
        (6, "!!! 123 ###", "en"),
        (7, " ".join(f"w{i % 9000}" for i in range(60_000)), "en"),
        (8, "one two three", "en"),
        (9, "one  two\tthree", "en"),
        (None, "nobody knows this id at all", "en"),
        (None, None, None),
        (10, "der hund und die katze sind nicht im haus", "de"),
        (11, "собака и кошка спят в доме на полу", "ru"),
        (12, "zero\u00a0width\u2003and \U0001f600 idiot idiot", "en"),
    ]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """The odd documents, with columns whose names operators use themselves."""
    docs = spark.createDataFrame(document_rows(), "doc_id long, text string, lang string")
    docs = docs.withColumns({c: F.lit(c) for c in CLASHING}).repartition(3)
    return docs.withColumn("source", F.lit("s"))


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)


@pytest.fixture(scope="session")
def odd_labels(spark):
    rows = [(0, 1, 0), (1, 1, 0), (12, 0, 1), (12, 1, 0), (None, 1, 1), (8, None, None), (10, 1, 0), (11, 1, 1)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


@pytest.fixture(scope="session")
def odd_items(spark):
    rows = [(1, " ".join(PROSE)), (2, "one two three"), (3, None), (4, ""), (1, " ".join(PROSE)), (5, "not to be found in any of these texts")]
    return spark.createDataFrame(rows, "item_id long, text string")
