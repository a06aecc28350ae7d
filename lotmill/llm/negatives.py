"""Hard-negative mining with an inverted multi-index whose stops are certified.

Vectors are cut in two halves and each half has a codebook; a row lies in the cell of its two nearest
codes. Rows are dealt into blocks, and every block is an inverted multi-index of its own over
the shared codebooks. An anchor walks through the cells of a block by the sum of two half scores,
each the score of the code plus the anchor's norm times the radius of the code's rows. That sum bounds
every row of the cells still ahead, so the walk ends as soon as nothing ahead can change the
result, and the result is that of a full search.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lotmill.llm.common import materialize

# Codes of each half, rows that the codebooks are fitted on, rounds of fitting.
CODES, FIT_ROWS, ROUNDS = 16, 8192, 10
# Vector components in a block of rows, and in a group of anchors that visits it.
BLOCK_COMPONENTS, ANCHOR_COMPONENTS = 2**19, 2**20
# Rows that a walk scores at once: at first, and at most.
GULP, LARGEST_GULP = 64, 1024
LONG = 2**63 - 1
# Stands for a null vec_id, which comes last among ties.
LAST_ID = LONG

_FOUND = "anchor_row long, span long, vec_id long, score long"


def labelled_vectors(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """(row, vec_id, label, v): floor(scale * x) of each component.

    Rows with a null label, a null vector, or a null or non-finite component take no part. ``row``
    tells repeated rows apart.
    """
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    return (
        vectors.select(
            F.monotonically_increasing_id().alias("row"),
            F.coalesce(F.col("vec_id").cast("long"), F.lit(LAST_ID)).alias("vec_id"),
            F.col("label").cast("long").alias("label"),
            F.col("embedding").alias("_x"),
        )
        .filter(F.col("label").isNotNull() & F.col("_x").isNotNull() & F.forall("_x", finite))
        .select("row", "vec_id", "label", F.transform("_x", lambda x: F.floor(x.cast("double") * scale).cast("long")).alias("v"))
    )


@dataclass(frozen=True)
class Codebooks:
    """Codes of the first ``split`` components and of those behind them."""

    split: int
    first: np.ndarray
    second: np.ndarray


def _codes(points: np.ndarray, k: int) -> np.ndarray:
    """k-means from evenly spaced rows; a code without rows stays where it is."""
    centres = points[np.linspace(0, len(points) - 1, min(k, len(points))).astype(int)].copy()
    for _ in range(ROUNDS):
        near = _nearest(points, centres)
        for c in range(len(centres)):
            if (near == c).any():
                centres[c] = points[near == c].mean(axis=0)
    return centres


def _nearest(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.argmin((centres * centres).sum(axis=1) - 2.0 * points @ centres.T, axis=1)


def fit_codebooks(rows: DataFrame, codes: int = CODES, fit_rows: int = FIT_ROWS) -> Codebooks:
    """Codebooks from at most ``fit_rows`` rows, chosen by a hash of their number; every row is indexed with them.

    They decide how fast a walk ends, never what it finds.
    """
    sample = rows.orderBy(F.xxhash64("row"), "row").limit(fit_rows).select("v").toPandas()["v"]
    points = matrix(list(sample), max((len(v) for v in sample), default=0)).astype(np.float64)
    split = (points.shape[1] + 1) // 2
    if not len(points):
        return Codebooks(0, np.zeros((1, 0)), np.zeros((1, 0)))
    return Codebooks(split, _codes(points[:, :split], codes), _codes(points[:, split:], codes))


def matrix(vectors: list[np.ndarray], width: int) -> np.ndarray:
    """Vectors as rows of whole numbers; missing components are 0."""
    out = np.zeros((len(vectors), width), np.int64)
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def _padded(codes: np.ndarray, width: int) -> np.ndarray:
    return np.pad(codes, ((0, 0), (0, max(0, width - codes.shape[1]))))[:, :width]


class Block:
    """The inverted multi-index of one block of rows."""

    def __init__(self, rows: pd.DataFrame, width: int, books: Codebooks, anchor_most: float):
        rows = rows.sort_values(["vec_id", "row"], kind="stable")
        whole = matrix(list(rows["v"]), width)
        reals = whole.astype(np.float64)
        self.split = books.split
        self.books = (_padded(books.first, books.split), _padded(books.second, width - books.split))
        halves = (reals[:, : self.split], reals[:, self.split :])
        near = [_nearest(h, b) for h, b in zip(halves, self.books)]
        self.radii, self.present = [], []
        for half, book, code in zip(halves, self.books, near):
            radius = np.zeros(len(book))
            np.maximum.at(radius, code, np.sqrt(((half - book[code]) ** 2).sum(axis=1)))
            self.radii.append(radius)
            self.present.append(np.unique(code))
        cell = near[0] * len(self.books[1]) + near[1]
        order = np.argsort(cell, kind="stable")
        self.starts = np.searchsorted(cell[order], np.arange(len(self.books[0]) * len(self.books[1]) + 1))
        # Below 2**53 every partial sum of a float product is a whole number; beyond, whole numbers of any size add up.
        most = float(np.abs(reals).max(initial=0.0)) * anchor_most * max(1, width)
        self.values = (reals if most < 2**53 else whole.astype(object))[order]
        self.ids, self.rows, self.labels = (rows[c].to_numpy()[order] for c in ("vec_id", "row", "label"))

    def cells(self, anchor: np.ndarray) -> Iterator[tuple[float, slice]]:
        """(bound, rows) of the cells with rows; no row from there on scores above ``bound``."""
        sums = []
        for half, book, radius, present in zip((anchor[: self.split], anchor[self.split :]), self.books, self.radii, self.present):
            norm = float(np.sqrt((half * half).sum()))
            size = np.sqrt((book * book).sum(axis=1))
            # The last part is far above the rounding of the sums before it.
            bound = book @ half + norm * radius + 1e-9 * norm * (size + radius) + 1e-6
            order = present[np.argsort(-bound[present], kind="stable")]
            sums.append((order, bound[order]))
        (first, a), (second, b) = sums
        heap = [(-(a[0] + b[0]), 0, 0)] if len(a) and len(b) else []
        while heap:
            bound, i, j = heapq.heappop(heap)
            at = first[i] * len(self.books[1]) + second[j]
            if self.starts[at] < self.starts[at + 1]:
                yield -bound, slice(self.starts[at], self.starts[at + 1])
            if j + 1 < len(b):
                heapq.heappush(heap, (-(a[i] + b[j + 1]), i, j + 1))
            if j == 0 and i + 1 < len(a):
                heapq.heappush(heap, (-(a[i + 1] + b[0]), i + 1, 0))

    def gulps(self, anchor: np.ndarray) -> Iterator[tuple[float, np.ndarray]]:
        """(bound, rows) of runs of cells, longer ones as the walk goes on; no row from there on scores above ``bound``."""
        run, held, top, most = [], 0, 0.0, GULP
        for bound, cell in self.cells(anchor.astype(np.float64)):
            top = top if run else bound
            run.append(np.arange(cell.start, cell.stop))
            held += cell.stop - cell.start
            if held >= most:
                yield top, np.concatenate(run)
                run, held, most = [], 0, min(2 * most, LARGEST_GULP)
        if run:
            yield top, np.concatenate(run)

    def _scores(self, places: np.ndarray, anchor: np.ndarray) -> np.ndarray:
        return self.values[places] @ anchor.astype(self.values.dtype)

    def same(self, anchor: np.ndarray, label: int, own: int, n: int) -> list[tuple]:
        """(-score, vec_id, place) of the n best other rows of the label."""
        best: list[tuple] = []
        for bound, run in self.gulps(anchor):
            if len(best) == n and -best[-1][0] > bound:
                break
            places = run[(self.labels[run] == label) & (self.rows[run] != own)]
            best = _merged(best, self._scores(places, anchor), self.ids[places], places, n)
        return best

    def others(self, anchor: np.ndarray, label: int, spans: list[tuple[int, int]], n: int) -> list[list[tuple]]:
        """For each span (least, most) the n best rows of other labels whose score lies in it."""
        best: list[list[tuple]] = [[] for _ in spans]
        open_ = [w for w, (low, high) in enumerate(spans) if low <= high]
        for bound, run in self.gulps(anchor):
            open_ = [w for w in open_ if bound >= spans[w][0] and not (len(best[w]) == n and -best[w][-1][0] > bound)]
            if not open_:
                break
            places = run[self.labels[run] != label]
            scores = self._scores(places, anchor)
            for w in open_:
                low = max(spans[w][0], -best[w][-1][0]) if len(best[w]) == n else spans[w][0]
                inside = np.flatnonzero((scores >= low) & (scores <= spans[w][1]))
                if len(inside):
                    best[w] = _merged(best[w], scores[inside], self.ids[places[inside]], places[inside], n)
        return best


def _merged(best: list[tuple], scores: np.ndarray, ids: np.ndarray, places: np.ndarray, n: int) -> list[tuple]:
    if len(best) == n:
        kept = np.flatnonzero(scores >= -best[-1][0])
        scores, ids, places = scores[kept], ids[kept], places[kept]
    if len(scores) > n:  # equal scores stay, as the id decides among them
        kept = np.flatnonzero(scores >= np.partition(scores, len(scores) - n)[len(scores) - n])
        scores, ids, places = scores[kept], ids[kept], places[kept]
    return sorted([*best, *((-int(s), int(i), int(p)) for s, i, p in zip(scores, ids, places))])[:n]


def _held(score: int) -> int:
    """Beyond 64 bits a score is held at the ends of long."""
    return min(max(score, -LONG), LONG)


def _visit(rows: DataFrame, anchors: DataFrame, books: Codebooks, search) -> DataFrame:
    """(anchor_row, span, vec_id, score) that ``search(block, anchor, vector)`` finds in each block for each anchor.

    Rows meet anchors in a grid: a row goes to as many cells as there are groups of anchors, an anchor to as many as there
    are blocks. Both groups are bounded by vector components.
    """
    n, width = rows.agg(F.count("*"), F.max(F.size("v"))).first()
    width = max(1, width or 1)
    blocks = max(1, -(-n * width // BLOCK_COMPONENTS))
    groups = max(1, -(-anchors.count() * width // ANCHOR_COMPONENTS))
    chunk = lambda n: F.pmod(F.xxhash64("row"), F.lit(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    # Columns of their own: both sides come from one table, and grouping them together goes by column.
    dealt = rows.select(*(F.col(c).alias(c) for c in rows.columns), chunk(blocks).alias("b"), each(groups).alias("g"))
    visitors = anchors.withColumn("g", chunk(groups)).withColumn("b", each(blocks))

    def walk(own: pd.DataFrame, others: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(own) and len(others):
            vectors = matrix(list(own["v"]), width)
            block = Block(others, width, books, float(np.abs(vectors.astype(np.float64)).max(initial=0.0)))
            for anchor, vector in zip(own.itertuples(index=False), vectors):
                found += [(anchor.row, span, i, _held(-s)) for span, best in search(block, anchor, vector) for s, i, _ in best]
        return pd.DataFrame(found, columns=["anchor_row", "span", "vec_id", "score"]).astype("int64")

    return visitors.groupBy("b", "g").cogroup(dealt.groupBy("b", "g")).applyInPandas(walk, _FOUND)


def _first(found: DataFrame, n: int, *group: str) -> DataFrame:
    order = Window.partitionBy(*group).orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n)


def _id(column: str) -> Column:
    return F.when(F.col(column) != LAST_ID, F.col(column))


def mine(
    vectors: DataFrame,
    every: int = 100,
    positives: int = 5,
    negatives: int = 5,
    least: int = 80,
    whole: int = 100,
    scale: int = 256,
    codes: int = CODES,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of ``vectors`` (vec_id, label, embedding).

    Anchors are the rows whose vec_id is divisible by ``every``. An anchor's positives are the
    ``positives`` best other rows of its label; for each, the ``negatives`` best rows of other labels with
    ``least * positive_score <= whole * negative_score <= whole * positive_score`` are returned. Best is the
    highest integer inner product, ties by smaller vec_id, a null vec_id last.

    Rows with a null label, a null vector, or a null or non-finite component take no part; a row with a null vec_id is no
    anchor. Repeated rows are rows of their own: each is an anchor, and each a candidate of the others. Vectors may differ
    in length, missing components count as 0. Extra columns are left out. A positive whose score is negative has no window,
    one without negatives no rows; an empty table gives no rows.
    """
    rows = labelled_vectors(vectors, scale)
    anchors = rows.filter((F.col("vec_id") % every == 0) & (F.col("vec_id") != LAST_ID))
    books = fit_codebooks(rows, codes)

    def friends(block, anchor, vector):
        return [(0, block.same(vector, anchor.label, anchor.row, positives))]

    pairs = _first(_visit(rows, anchors, books, friends), positives, "anchor_row").select(
        "anchor_row", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")
    )
    pairs = materialize(pairs, "positives")
    spans = pairs.groupBy("anchor_row").agg(F.array_sort(F.collect_set("positive_score")).alias("spans"))
    asking = anchors.join(spans.withColumnRenamed("anchor_row", "row"), "row")

    def foes(block, anchor, vector):
        tops = [int(s) for s in anchor.spans]
        return list(zip(tops, block.others(vector, anchor.label, [(-(-least * s // whole), s) for s in tops], negatives)))

    found = _first(_visit(rows, asking, books, foes), negatives, "anchor_row", "span")
    return (
        pairs.join(found, (pairs["anchor_row"] == found["anchor_row"]) & (pairs["positive_score"] == found["span"]))
        .join(anchors.select(F.col("row").alias("_row"), F.col("vec_id").alias("anchor_id")), pairs["anchor_row"] == F.col("_row"))
        .select(
            "anchor_id",
            _id("positive_id").alias("positive_id"),
            F.col("rank").cast("int").alias("rank"),
            _id("vec_id").alias("negative_id"),
            "positive_score",
            F.col("score").alias("negative_score"),
        )
    )
