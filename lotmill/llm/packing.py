"""Packing into length buckets whose boundaries minimise padding, and token-budget batches inside them."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotmill.llm.common import by_bytes, materialize, number_within, words

MAX_TOKENS = 2048
BUCKETS = 8
BATCH_TOKENS = 16_384


def best_boundaries(lengths: np.ndarray, counts: np.ndarray, buckets: int) -> list[int]:
    """Upper lengths of at most ``buckets`` buckets with the least padding in all.

    ``lengths`` are distinct and rising. Dynamic programming: the best cost of the first j
    lengths in k buckets is the least, over the start i of the last bucket, of the best cost of the
    first i in k - 1 plus the padding of lengths i to j up to the largest. Of equal costs the
    earliest start is taken, and no more buckets than lower the cost.
    """
    n = len(lengths)
    if not n:
        return []
    number = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
    total = np.concatenate([[0], np.cumsum(counts * lengths)]).astype(np.int64)
    huge = np.iinfo(np.int64).max // 4
    best = np.full(n + 1, huge, np.int64)
    best[0] = 0
    starts, results = [], []
    for _ in range(min(buckets, n)):
        now, start = np.full(n + 1, huge, np.int64), np.zeros(n + 1, np.int64)
        for j in range(1, n + 1):
            cost = best[:j] + lengths[j - 1] * (number[j] - number[:j]) - (total[j] - total[:j])
            start[j] = int(cost.argmin())
            now[j] = cost[start[j]]
        starts.append(start)
        results.append(int(now[n]))
        best = now
    k = int(np.argmin(results))
    bounds, j = [], n
    while j > 0:
        bounds.append(int(lengths[j - 1]))
        j = int(starts[k][j])
        k -= 1
    return bounds[::-1]


def pieces(docs: DataFrame, max_tokens: int) -> DataFrame:
    """One row (columns of ``docs`` but text, piece, n_tokens) for every ``max_tokens`` words of a text, the last one shorter.

    A null or empty text, or one without a word, gives none.
    """
    own = [f for f in docs.schema if f.name != "text"]
    names = [f.name for f in own]
    result = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in own) + "piece int, n_tokens int"

    def cut(batches):
        for batch in by_bytes(batches, "text"):
            n = np.array([len(words(t)) if t else 0 for t in batch.column("text").to_pylist()], np.int64)
            parts = -(-n // max_tokens)
            at = np.repeat(np.arange(len(n)), parts)
            piece = np.arange(len(at)) - np.repeat(np.cumsum(parts) - parts, parts)
            size = np.minimum(n[at] - piece * max_tokens, max_tokens)
            taken = batch.select(names).take(pa.array(at))
            yield pa.RecordBatch.from_arrays([*taken.columns, pa.array(piece, pa.int32()), pa.array(size, pa.int32())], names=[*names, "piece", "n_tokens"])

    return docs.mapInArrow(cut, result)


def pack(docs: DataFrame, max_tokens: int = MAX_TOKENS, buckets: int = BUCKETS, batch_tokens: int = BATCH_TOKENS) -> DataFrame:
    """(doc_id, piece, n_tokens, bucket, batch, slot): where each piece of each text goes.

    Tokens are words. Texts longer than ``max_tokens`` go in pieces of that many, so the global histogram has
    at most ``max_tokens`` lengths; it goes to the driver, which chooses the boundaries. ``bucket`` is the padded length of
    the piece. A batch has as many slots as fit ``batch_tokens`` padded tokens, one at least; batches count from 0 in each bucket,
    slots from 0 in each batch, and only a bucket's last batch is not full. Texts without a word have no piece; repeated rows have a place each.
    """
    spark = docs.sparkSession
    rows = materialize(
        pieces(docs.select("doc_id", "text"), max_tokens).withColumn("_row", F.monotonically_increasing_id()), "pieces"
    )
    histogram = rows.groupBy("n_tokens").agg(F.count("*").alias("n")).orderBy("n_tokens").collect()
    lengths = np.array([r["n_tokens"] for r in histogram], np.int64)
    bounds = best_boundaries(lengths, np.array([r["n"] for r in histogram], np.int64), buckets)
    own = np.searchsorted(bounds, lengths, "left")
    places = spark.createDataFrame([(int(n), int(bounds[k])) for n, k in zip(lengths, own)], "_n int, bucket int")
    # At most max_tokens rows.
    placed = rows.join(F.broadcast(places), F.col("n_tokens") == F.col("_n")).drop("_n")
    numbered = number_within(placed, "bucket", [F.col("doc_id"), F.col("piece")], "_row", "_place")
    room = F.greatest(F.floor(F.lit(batch_tokens) / F.col("bucket")), F.lit(1))
    return numbered.select(
        "doc_id",
        "piece",
        "n_tokens",
        "bucket",
        F.floor(F.col("_place") / room).cast("long").alias("batch"),
        (F.col("_place") % room).cast("int").alias("slot"),
    )
