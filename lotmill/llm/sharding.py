"""Sharding by longest processing time: equal texts stay together, shard sizes come out near equal."""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotmill.llm.common import materialize, number_within

# Items per shard that the heap sees at most, twice: heavy groups and bundles of light ones.
ITEMS_PER_SHARD = 1024
OVERHEAD = 8


def longest_first(items: list[tuple[int, object]], shards: int) -> dict[object, int]:
    """(size, key) items, the largest first, each to the shard with the least so far.

    Ties go to the smaller key and the smaller shard number.
    """
    heap = [(0, shard) for shard in range(shards)]
    out = {}
    for size, key in sorted(items, key=lambda item: (-item[0], item[1])):
        load, shard = heap[0]
        out[key] = shard
        heapq.heapreplace(heap, (load + size, shard))
    return out


def assign_shards(docs: DataFrame, shards: int, group: Column, size: Column) -> DataFrame:
    """``docs`` with ``shard``; rows with the same ``group`` (null is a group too) share one.

    A group of at least 1/1024 of a shard's fair share is an item of its own, and
    there can be no more than 1024 of them for each shard. The rest is hashed into 1024
    bundles for each shard, so that what meets in the heap is bounded by the number
    of shards, never by the data. No shard then exceeds the fair share by
    more than the larger of one bundle and the group that overfills it.

    An empty table gives no rows. A group larger than the fair share fills a shard alone.
    """
    spark = docs.sparkSession
    keyed = docs.withColumns({"_group": F.coalesce(group.cast("string"), F.lit("")), "_size": size.cast("long")})
    bundles = shards * ITEMS_PER_SHARD
    keyed = keyed.withColumn("_bundle", F.pmod(F.xxhash64("_group"), F.lit(bundles)).cast("int"))
    groups = materialize(keyed.groupBy("_group", "_bundle").agg(F.sum("_size").alias("_size")), "shard-groups")
    total = groups.agg(F.sum("_size")).first()[0] or 0
    heavy = F.col("_size") >= max(1, -(-total // bundles))
    large = [(r["_size"], ("group", r["_group"])) for r in groups.filter(heavy).select("_group", "_size").collect()]
    light = groups.filter(~heavy).groupBy("_bundle").agg(F.sum("_size").alias("_size")).collect()
    placed = longest_first(large + [(r["_size"], ("bundle", f"{r['_bundle']:09d}")) for r in light], shards)
    by_group = [(key, shard) for (kind, key), shard in placed.items() if kind == "group"]
    by_bundle = [(int(key), shard) for (kind, key), shard in placed.items() if kind == "bundle"]
    # Both lists are bounded by shards * ITEMS_PER_SHARD rows.
    large_shards = spark.createDataFrame(by_group, "_large string, _large_shard int")
    light_shards = spark.createDataFrame(by_bundle, "_light int, _light_shard int")
    return (
        keyed.join(F.broadcast(large_shards), F.col("_group") == F.col("_large"), "left")
        .join(F.broadcast(light_shards), F.col("_bundle") == F.col("_light"), "left")
        .withColumn("shard", F.coalesce("_large_shard", "_light_shard"))
        .drop("_group", "_size", "_bundle", "_large", "_light", "_large_shard", "_light_shard")
    )


def shard_documents(docs: DataFrame, shards: int = 24) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    Size is the UTF-8 bytes of the text plus 8; a null text has none, keeps a
    null checksum, and all null texts stay together. Equal texts (by SHA-256) share a shard.
    The law is ``bytes``: shard sizes come out near equal, so adding a shard
    deals anew and ``grown_shard`` is null. Slots number a shard's rows from 0.
    Repeated rows are kept, one slot each; a null doc_id is kept as it is.
    """
    narrow = materialize(
        docs.select(
            F.col("doc_id"),
            (F.coalesce(F.octet_length("text"), F.lit(0)) + OVERHEAD).cast("long").alias("size"),
            F.crc32(F.col("text").cast("binary")).alias("text_crc32"),
            F.sha2("text", 256).alias("_text"),
            F.monotonically_increasing_id().alias("_row"),
        ),
        "shard-rows",
    )
    placed = assign_shards(narrow, shards, F.col("_text"), F.col("size")).drop("_text")
    placed = materialize(placed, "shard-placed")
    numbered = number_within(placed, "shard", [F.col("doc_id")], "_row", "slot")
    return numbered.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
