"""Merging an incoming batch into stored listings by key.

Every merge first reduces the batch to one row per key, then joins it with
the stored table. Both sides then hold each key once, so no key can be hot in
the join.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotmill.functions.hashing import row_hash
from lotmill.operators.dedup import arrival_order, keep_first, keep_last
from lotmill.schemas import CLEAN_COLUMNS, CURRENT_COLUMNS

KEY = "property_id"


def with_versioning(df: DataFrame, as_of: datetime, *more: str) -> DataFrame:
    """Clean listings with the versioning columns of a fresh current row, and ``more`` of their own."""
    return df.select(
        *more,
        *CLEAN_COLUMNS,
        F.lit(as_of).cast("timestamp_ntz").alias("valid_from"),
        F.lit(None).cast("timestamp_ntz").alias("valid_to"),
        F.lit(True).alias("is_current"),
        row_hash(CLEAN_COLUMNS).alias("row_hash"),
    )


def insert_ignore(
    existing: DataFrame, incoming: DataFrame, order: Sequence[Column] | None = None
) -> DataFrame:
    """Rows to append: first row of each key that is not stored yet."""
    first = keep_first(incoming, KEY, order)
    return first.join(existing.select(KEY), KEY, "left_anti")


def latest_rows(incoming: DataFrame, as_of: datetime, order: Sequence[Column] | None = None) -> DataFrame:
    """The batch's latest row of each key, as fresh current rows."""
    return with_versioning(keep_last(incoming, KEY, order), as_of)


def counted_latest(incoming: DataFrame, as_of: datetime) -> DataFrame:
    """As :func:`latest_rows`, with ``n_rows``, the number of rows of the key, in one aggregation.

    The latest row is the largest in arrival order; maxima and counts are taken on the map side first.
    """
    order = [incoming.select(c).columns[0] for c in arrival_order(incoming)]
    largest = incoming.groupBy(KEY).agg(
        F.max(F.struct(*order)).alias("_row"), F.count("*").alias("n_rows")
    )
    return with_versioning(largest.select("_row.*", "n_rows"), as_of, "n_rows")


def _arrived(special: dict[str, Column]) -> list[Column]:
    arrived = F.col(f"i.{KEY}").isNotNull()
    plain = {
        c: F.when(arrived, F.col(f"i.{c}")).otherwise(F.col(f"e.{c}")) for c in CURRENT_COLUMNS
    }
    # No merge writes valid_to, so a stored value survives.
    plain["valid_to"] = F.col("e.valid_to")
    return [{**plain, **special}[c].alias(c) for c in CURRENT_COLUMNS]


def _forward() -> dict[str, Column]:
    """A stored price and date that only move forward.

    The price changes when it differs and the incoming posting date is later;
    a comparison with null keeps the stored value.
    """
    arrived = F.col(f"i.{KEY}").isNotNull()
    newer = F.col("e.posted_date") < F.col("i.posted_date")
    differs = F.col("e.house_price") != F.col("i.house_price")

    def moved(column: str, moves: Column) -> Column:
        old, new = F.col(f"e.{column}"), F.col(f"i.{column}")
        return F.when(F.col(f"e.{KEY}").isNull() | (arrived & moves), new).otherwise(old)

    return {
        "house_price": moved("house_price", newer & differs),
        "posted_date": moved("posted_date", newer),
    }


def _joined(existing: DataFrame, latest: DataFrame) -> DataFrame:
    same = F.col(f"e.{KEY}") == F.col(f"i.{KEY}")
    return existing.alias("e").join(latest.alias("i"), same, "full_outer")


def change_images(existing: DataFrame, latest: DataFrame, only_newer: bool = False, small: bool = True) -> DataFrame:
    """What a written batch of one current row per key does to the stored rows.

    ``existing`` and ``latest`` carry their ``bucket``, ``latest`` also ``n_rows``. Returns (property_id, bucket, action, n_rows,
    before, after), one row for each key of the batch: ``insert``, ``update``, or ``unchanged`` where the stored row has the same
    content hash; then both images are null. The batch, if small, goes to the stored rows, and these are not
    shuffled; the batch is read twice, and of the stored rows the keys are. If it is not ``small``, both sides are sorted once and meet
    in one join, so that a task holds no more than two sorts.
    """
    same = F.col(f"e.{KEY}") == F.col(f"i.{KEY}")
    equal = F.coalesce(F.col("e.row_hash") == F.col("i.row_hash"), F.lit(False))
    before = F.struct(*[F.col(f"e.{c}").alias(c) for c in CURRENT_COLUMNS])
    after = F.struct(*_arrived(_forward() if only_newer else {}))
    if not small:
        new = F.col(f"e.{KEY}").isNull()
        fresh = F.struct(*[F.col(f"i.{c}").alias(c) for c in CURRENT_COLUMNS])
        return latest.hint("merge").alias("i").join(existing.alias("e"), same, "left").select(
            F.col(f"i.{KEY}").alias(KEY),
            F.col("i.bucket").alias("bucket"),
            F.when(new, "insert").when(equal, "unchanged").otherwise("update").alias("action"),
            F.col("i.n_rows").alias("n_rows"),
            F.when(~new & ~equal, before).alias("before"),
            F.when(new, fresh).when(~equal, after).alias("after"),
        )
    met = existing.alias("e").join(latest.alias("i"), same)
    changed = met.select(
        F.col(f"i.{KEY}").alias(KEY),
        F.col("i.bucket").alias("bucket"),
        F.when(equal, "unchanged").otherwise("update").alias("action"),
        F.col("i.n_rows").alias("n_rows"),
        F.when(~equal, before).alias("before"),
        F.when(~equal, after).alias("after"),
    )
    known = existing.select(KEY).join(latest.select(KEY), KEY, "left_semi")
    new = latest.join(known, KEY, "left_anti").select(
        KEY, "bucket", F.lit("insert").alias("action"), "n_rows", F.lit(None).alias("before"), F.struct(*CURRENT_COLUMNS).alias("after")
    )
    return changed.unionByName(new)


def upsert_latest(
    existing: DataFrame,
    incoming: DataFrame,
    as_of: datetime,
    order: Sequence[Column] | None = None,
) -> DataFrame:
    """The current table after the batch: its latest row per key wins."""
    return _joined(existing, latest_rows(incoming, as_of, order)).select(*_arrived({}))


def merge_if_newer(
    existing: DataFrame,
    incoming: DataFrame,
    as_of: datetime,
    order: Sequence[Column] | None = None,
) -> DataFrame:
    """As :func:`upsert_latest`, but a stored price and date only move forward.

    The row hash of a merged row is that of the incoming row, as the other columns are.
    """
    return _joined(existing, latest_rows(incoming, as_of, order)).select(*_arrived(_forward()))


def merge_counts(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """Rows a row-by-row upsert would insert and update.

    The first row of a new key inserts; every other row updates. Only keys
    are read, and they are counted before the join.
    """
    # Stored keys are the side that streams, so a small batch is sent to them.
    keys = incoming.groupBy(KEY).agg(F.count("*").alias("n_rows"))
    known = existing.select(KEY).join(keys, KEY, "left_semi")
    parts = keys.select(F.lit(1).alias("new"), "n_rows").unionByName(
        known.select(F.lit(-1).alias("new"), F.lit(0).cast("long").alias("n_rows"))
    )
    total = parts.agg(
        F.coalesce(F.sum("new"), F.lit(0)).alias("inserted"),
        F.coalesce(F.sum("n_rows") - F.sum("new"), F.lit(0)).alias("updated"),
    )
    return total.select(
        F.stack(F.lit(2), F.lit("inserted"), "inserted", F.lit("updated"), "updated").alias(
            "action", "n_rows"
        )
    )
