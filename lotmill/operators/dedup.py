"""One row per key, and duplicate removal."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lotmill.operators.clean import normalize_raw
from lotmill.schemas import RAW_COLUMNS


def arrival_order(df: DataFrame) -> list[Column]:
    """A total order for rows of one key: collection time, file, then content.

    Files are read in no fixed order, so position cannot decide; identical
    rows are the only ones this order leaves equal. The content columns are
    compared only where time and file agree.
    """
    first = [c for c in ("created_at", "file_name") if c in df.columns]
    return [F.col(c) for c in [*first, *sorted(set(df.columns) - set(first))]]


def _one_per_key(df: DataFrame, key: str, order: Sequence[Column]) -> DataFrame:
    # A rank filter of 1 lets Spark keep one row per key on the map side
    # (WindowGroupLimit), so a hot key sends one row per task to the shuffle.
    window = Window.partitionBy(key).orderBy(*order)
    ranked = df.withColumn("_rank", F.row_number().over(window))
    return ranked.filter(F.col("_rank") == 1).drop("_rank")


def keep_first(df: DataFrame, key: str, order: Sequence[Column] | None = None) -> DataFrame:
    """Earliest row of each key."""
    return _one_per_key(df, key, [c.asc() for c in order or arrival_order(df)])


def keep_last(df: DataFrame, key: str, order: Sequence[Column] | None = None) -> DataFrame:
    """Latest row of each key."""
    return _one_per_key(df, key, [c.desc() for c in order or arrival_order(df)])


def append_dedup(existing: DataFrame, new: DataFrame) -> DataFrame:
    """Existing plus new raw rows, normalised, without exact duplicates.

    The collection time is part of the comparison, as are nulls (equal to
    each other). Columns missing on one side are filled with null.
    """
    both = existing.unionByName(new, allowMissingColumns=True)
    absent = [c for c in RAW_COLUMNS if c not in both.columns]
    both = both.withColumns({c: F.lit(None).cast("string") for c in absent}) if absent else both
    return normalize_raw(both).dropDuplicates(RAW_COLUMNS)


def fingerprinted(df: DataFrame) -> DataFrame:
    """Normalised raw columns with ``fingerprint``, a hash of them all; columns that are missing are null.

    Rows have the same fingerprint if :func:`append_dedup` would hold them for equal: nulls are told from
    empty text, and cells do not run into each other.
    """
    absent = [c for c in RAW_COLUMNS if c not in df.columns]
    whole = normalize_raw(df.withColumns({c: F.lit(None).cast("string") for c in absent}) if absent else df).select(*RAW_COLUMNS)
    content = F.to_json(F.struct(*RAW_COLUMNS), {"ignoreNullFields": "false"})
    return whole.withColumn("fingerprint", F.sha2(content, 256))


def first_visits(df: DataFrame, pages: DataFrame) -> DataFrame:
    """Rows of ``df`` that come from the first of the visits ``pages`` to their page URL.

    The first visit is settled on ``url`` and ``page_id`` alone. Applied to
    extracted rows, no page body takes part in a shuffle; the join key also
    carries the page, so a much-visited URL spreads over partitions. A page without
    a URL is a page of its own. ``pages`` should hold usable visits only: a first visit
    that shows a challenge would hide a later one with listings.
    """
    winners = pages.filter("url IS NOT NULL").groupBy("url").agg(F.min("page_id").alias("page_id"))
    alone = pages.filter("url IS NULL").select("url", "page_id")
    first = winners.unionByName(alone).select(F.col("url").alias("_url"), F.col("page_id").alias("_page"))
    same = F.col("url").eqNullSafe(F.col("_url")) & (F.col("page_id") == F.col("_page"))
    return df.join(first, same, "left_semi")
