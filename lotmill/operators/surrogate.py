"""Dense integer ids for distinct names, without one global sort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HASH_BUCKETS = 256


def number_names(
    names: DataFrame,
    name: str,
    id_column: str,
    start: Column | int = 0,
    buckets: int = HASH_BUCKETS,
) -> DataFrame:
    """Ids ``start + 1 … start + N`` for N distinct names.

    Names fall into a fixed number of hash buckets. Each bucket is numbered
    by itself and shifted by the sizes of the buckets before it, so no task
    sees more than one bucket. Only the content decides an id: a recomputed
    task gives the same ids again.
    """
    hashed = names.withColumn("_bucket", F.pmod(F.xxhash64(name), F.lit(buckets)))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    sizes = hashed.groupBy("_bucket").agg(F.count("*").alias("_size"))
    # At most `buckets` rows: one per hash bucket, whatever the data size.
    shifts = sizes.select(
        "_bucket", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_shift")
    )
    within = F.row_number().over(Window.partitionBy("_bucket").orderBy(name))
    start = F.lit(start) if isinstance(start, int) else start
    # Every bucket has its shift. An outer join says so without adding a null
    # filter to one branch, and both branches then share one distinct shuffle.
    numbered = hashed.withColumn("_n", within).join(F.broadcast(shifts), "_bucket", "left")
    ident = (start + F.col("_shift") + F.col("_n")).cast("long").alias(id_column)
    return numbered.select(ident, *names.columns)


def extend_names(
    existing: DataFrame, names: DataFrame, name: str, id_column: str, buckets: int = HASH_BUCKETS
) -> DataFrame:
    """Rows to append to a dimension: unseen names, numbered after its ids."""
    top = existing.agg(F.coalesce(F.max(id_column), F.lit(0)).alias("top")).scalar()
    unseen = names.join(existing.select(name), name, "left_anti")
    return number_names(unseen, name, id_column, top, buckets)
