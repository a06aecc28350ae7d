"""Exact top-k inner products by term-at-a-time accumulation."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# A cell holds about this many candidates and as many queries: either side is copied once per cell of the other,
# so large square cells copy least. Of 64 components a side is some 10 MB, and so is a cell's result.
CELL = 16_384
# Where that leaves cores without a cell, candidates are cut finer, down to so many.
LEAST = 4096
# A posting list that covers this share of the candidates is added as a whole column.
DENSE = 0.5
LONG = 2**63 - 1
# Stands for a null vec_id, which comes last among ties.
LAST_ID = LONG

_RESULT = "query_row long, query_id long, vec_id long, score long"


def integer_vectors(vectors: DataFrame, column: str = "embedding", scale: int = 64) -> DataFrame:
    """(row, vec_id, v): floor(scale * x) of each component.

    Rows whose vector is null or holds a null or non-finite component take no part. ``row``
    tells repeated rows apart; a null vec_id becomes the largest long.
    """
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    return (
        vectors.select(
            F.monotonically_increasing_id().alias("row"), F.coalesce(F.col("vec_id").cast("long"), F.lit(LAST_ID)).alias("vec_id"), F.col(column).alias("_x")
        )
        .filter(F.col("_x").isNotNull() & F.forall("_x", finite))
        .select("row", "vec_id", F.transform("_x", lambda x: F.floor(x.cast("double") * scale).cast("long")).alias("v"))
    )


def _flat(vectors: pd.Series) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row positions, dimensions and values of the non-zero components."""
    lengths = np.fromiter((len(v) for v in vectors), np.int64, len(vectors))
    values = np.concatenate([np.asarray(v, np.int64) for v in vectors]) if len(vectors) else np.empty(0, np.int64)
    rows = np.repeat(np.arange(len(lengths)), lengths)
    dims = np.arange(len(values)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    kept = values != 0
    return rows[kept], dims[kept], values[kept]


def _bound(rows: np.ndarray, values: np.ndarray, n: int) -> float:
    """The largest sum of absolute components of any row."""
    return float(np.bincount(rows, np.abs(values.astype(np.float64)), n).max()) if len(rows) else 0.0


def best_of_cell(queries: pd.DataFrame, candidates: pd.DataFrame, k: int) -> Iterator[tuple]:
    """(query_row, query_id, vec_ids, scores) of the best k candidates of one cell for each query."""
    n = len(candidates)
    ids = candidates["vec_id"].to_numpy(np.int64)
    order = np.lexsort((candidates["row"].to_numpy(), ids))
    candidates, ids = candidates.iloc[order], ids[order]
    place = {int(r): i for i, r in enumerate(candidates["row"])}
    at, dims, values = _flat(candidates["v"])
    q_at, q_dims, q_values = _flat(queries["v"])
    most = _bound(q_at, q_values, len(queries)) * (np.abs(values.astype(np.float64)).max() if len(values) else 0.0)
    kind = np.int32 if most < 2**31 else np.int64 if most < 2**62 else object
    postings = {}
    by_dim = np.argsort(dims, kind="stable")
    starts = np.flatnonzero(np.diff(dims[by_dim], prepend=-1))
    for start, stop in zip(starts, [*starts[1:], len(by_dim)]):
        own = by_dim[start:stop]
        if len(own) >= DENSE * n:
            column = np.zeros(n, kind)
            column[at[own]] = values[own]
            postings[int(dims[own[0]])] = (None, column)
        else:
            postings[int(dims[own[0]])] = (at[own], values[own].astype(kind))
    firsts = np.searchsorted(q_at, np.arange(len(queries) + 1))
    for q, (row, query_id) in enumerate(zip(queries["row"], queries["vec_id"])):
        scores = np.zeros(n, kind)
        for t in range(firsts[q], firsts[q + 1]):
            where, weights = postings.get(int(q_dims[t]), (None, None))
            if weights is None:
                continue
            term = int(q_values[t]) if kind is object else kind(q_values[t])
            if where is None:
                scores += weights * term
            else:
                scores[where] += weights * term
        if kind is object:  # beyond 64 bits: exact, then held at the ends of long
            scores = np.array([min(max(int(s), -LONG), LONG) for s in scores], np.int64)
        live = n
        own = place.get(int(row))
        if own is not None:
            live -= 1
            scores = np.delete(scores, own)
        if live <= 0:
            continue
        keep = min(k, live)
        least = np.partition(scores, live - keep)[live - keep]
        # Candidates stand in id order, so of equal scores the first ones win.
        above, equal = np.flatnonzero(scores > least), np.flatnonzero(scores == least)
        chosen = np.concatenate([above, equal[: keep - len(above)]])
        chosen = chosen[np.lexsort((chosen, -scores[chosen].astype(np.int64)))]
        yield row, query_id, (np.delete(ids, own) if own is not None else ids)[chosen], scores[chosen]


def exact_top_k(queries: DataFrame, candidates: DataFrame, k: int) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k highest inner products.

    Both sides are (row, vec_id, v); a query never meets the candidate of its own ``row``.
    Ties go to the smaller vec_id, a null id last. Missing dimensions count as 0, so vectors may
    differ in length. Both sides are dealt into chunks by row and meet in a grid of cells of
    bounded size; each cell returns at most k rows per query, and these are merged by rank.
    """
    n_queries, n_candidates = queries.count(), candidates.count()
    grid_q = max(1, -(-n_queries // CELL))
    cores = candidates.sparkSession.sparkContext.defaultParallelism
    grid_c = max(1, -(-n_candidates // CELL), min(-(-n_candidates // LEAST), 2 * cores // grid_q))

    chunk = lambda n: F.pmod(F.xxhash64("row"), F.lit(n)).cast("int")
    dealt_c = candidates.withColumn("c", chunk(grid_c)).withColumn("q", F.explode(F.sequence(F.lit(0), F.lit(grid_q - 1))))
    dealt_q = queries.withColumn("q", chunk(grid_q)).withColumn("c", F.explode(F.sequence(F.lit(0), F.lit(grid_c - 1))))

    def score(own: pd.DataFrame, others: pd.DataFrame) -> pd.DataFrame:
        found = {c: [np.empty(0, np.int64)] for c in ("query_row", "query_id", "vec_id", "score")}
        for row, query_id, ids, scores in best_of_cell(own, others, k) if len(own) and len(others) else ():
            for c, values in zip(found, (np.full(len(ids), row), np.full(len(ids), query_id), ids, scores)):
                found[c].append(values)
        return pd.DataFrame({c: np.concatenate(values).astype(np.int64) for c, values in found.items()})

    found = dealt_q.groupBy("c", "q").cogroup(dealt_c.groupBy("c", "q")).applyInPandas(score, _RESULT)
    order = Window.partitionBy("query_row").orderBy(F.col("score").desc(), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", F.when(F.col("vec_id") != LAST_ID, F.col("vec_id")).alias("vec_id"), "score")
    )


def search(vectors: DataFrame, k: int = 20, every: int = 20) -> DataFrame:
    """Top k of every row whose vec_id is divisible by ``every``, against all rows."""
    rows = integer_vectors(vectors)
    return exact_top_k(rows.filter((F.col("vec_id") % every == 0) & (F.col("vec_id") != LAST_ID)), rows, k)
