"""Connected components by alternating large-star and small-star steps on edge tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotmill.llm.common import materialize


def _oriented(edges: DataFrame) -> DataFrame:
    """Each link once, as (hi, lo) with hi > lo."""
    return edges.filter("hi <> lo").select(F.greatest("hi", "lo").alias("hi"), F.least("hi", "lo").alias("lo")).distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("hi").alias("n"), F.col("lo").alias("v")).unionByName(
        edges.select(F.col("lo").alias("n"), F.col("hi").alias("v"))
    )
    least = both.groupBy("n").agg(F.min("v").alias("m")).withColumn("m", F.least("n", "m"))
    return _oriented(both.filter("v > n").join(least, "n").select(F.col("v").alias("hi"), F.col("m").alias("lo")))


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("hi").agg(F.min("lo").alias("m"))
    linked = edges.join(least, "hi").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
    return _oriented(linked.unionByName(least.select("hi", F.col("m").alias("lo"))))


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
    return row[0], row[1]


def component_roots(edges: DataFrame) -> DataFrame:
    """(node, root) of every linked node that is not itself a root; root is the least node it reaches.

    ``edges`` is (hi, lo) of longs. Each step groups with map-side minima, so a
    node with very many links sends one row per task; every round is
    written to the shared folder, and rounds grow with the logarithm of the longest chain.
    """
    edges = materialize(_oriented(edges), "links")
    mark = _mark(edges)
    while True:
        edges = materialize(_small_star(_large_star(edges)), "links")
        before, mark = mark, _mark(edges)
        if before == mark:
            return edges.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
