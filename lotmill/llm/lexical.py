"""Ranked lexical search by dense blocked matrix multiplication, exact in whole numbers.

Search items are dealt into tiles; a tile keeps only the terms its items hold. A block of documents becomes a dense
matrix of impacts over those terms, and one multiplication with the items' weights scores every document for
every item of the tile. Impacts and weight digits are below 2**20 and a product spans at most 2**12 terms, so each
partial sum of the float64 product is a whole number below 2**52, and sums of products are taken in 64-bit integers.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lotmill.llm.common import by_bytes, materialize

# Items in a tile; (item, term) pairs that one pass over the documents carries.
TILE_ITEMS, PASS_PAIRS = 256, 2**18
# Terms in one product, and bits of a weight digit.
TILE_TERMS, DIGIT = 2**12, 20
# Documents and bytes in a block.
BLOCK_DOCS, BLOCK_BYTES = 1024, 4_000_000
# A text is cut into pieces of about this many bytes between terms.
PIECE = 4_000_000
# Partial lists of an item are merged by this many tasks before one merges theirs.
MERGERS = 64
# The largest impact: (10**9 * tf) div (1000 * tf + 12 * m) for m = 0.
MOST_IMPACT = 1_000_000
LONG = 2**63 - 1
LAST_ID = LONG

# Bytes that are no part of a term become blanks, A-Z become a-z.
_TABLE = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def term_pieces(text: bytes | None, piece: int = PIECE) -> Iterator[list[bytes]]:
    """The terms of a UTF-8 text, in lists of bounded size: runs of ASCII letters and digits and of any other characters."""
    clean = (text or b"").translate(_TABLE)
    start = 0
    while start < len(clean):
        stop = clean.find(b" ", start + piece)
        stop = len(clean) if stop < 0 else stop
        yield clean[start:stop].split()
        start = stop


def _bytes(batch: pa.RecordBatch, name: str) -> list:
    return batch.column(batch.schema.get_field_index(name)).cast(pa.large_binary()).to_pylist()


def item_terms(items: DataFrame) -> DataFrame:
    """(item_row, item_id, term, n) of the terms of each item, of items (item_id, text)."""
    id_type = items.schema["item_id"].dataType.simpleString()

    def cut(batches):
        for batch in batches:
            rows, ids = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            out = []
            for row, item, text in zip(rows, ids, _bytes(batch, "text")):
                counts = Counter()
                for terms in term_pieces(text):
                    counts.update(terms)
                out += [(row, item, t, n) for t, n in counts.items()]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([x[0] for x in out], pa.int64()),
                    pa.array([x[1] for x in out], batch.schema.field(1).type),
                    pa.array([x[2] for x in out], pa.binary()),
                    pa.array([x[3] for x in out], pa.int64()),
                ],
                ["item_row", "item_id", "term", "n"],
            )

    rows = items.select(F.monotonically_increasing_id().alias("item_row"), "item_id", F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(cut, f"item_row long, item_id {id_type}, term binary, n long")


def count_terms(docs: DataFrame, vocabulary) -> dict[int, int]:
    """Documents that hold each term, by the term's number in ``vocabulary`` (a broadcast dict); -1: documents with
    a term, -2: all their terms with repeats."""

    def count(batches):
        total: Counter = Counter()
        numbers = vocabulary.value
        for batch in by_bytes(batches, "text", BLOCK_BYTES):
            for text in _bytes(batch, "text"):
                n, seen = 0, set()
                for terms in term_pieces(text):
                    n += len(terms)
                    seen.update(numbers.keys() & terms)
                if n:
                    total.update(numbers[t] for t in seen)
                    total[-1] += 1
                    total[-2] += n
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int64()), pa.array(list(total.values()), pa.int64())], ["g", "n"])

    counted = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(count, "g long, n long")
    return {r["g"]: r["n"] for r in counted.groupBy("g").agg(F.sum("n").alias("n")).collect()}


class Tile:
    """The items of one tile over their own terms; ``numbers`` are the terms' numbers, in column order."""

    def __init__(self, pairs: list[tuple], weights: np.ndarray):
        self.items = list(dict.fromkeys((row, item) for row, item, _, _ in pairs))
        place = {row: i for i, (row, _) in enumerate(self.items)}
        self.numbers = np.array(sorted({g for _, _, g, _ in pairs}), np.int64)
        column = {g: i for i, g in enumerate(self.numbers.tolist())}
        self.at = np.array([place[row] for row, _, _, _ in pairs], np.int64)
        self.column = np.array([column[g] for _, _, g, _ in pairs], np.int64)
        self.weight = np.array([n * int(weights[g]) for _, _, g, n in pairs], np.int64)

    def scores(self, numbers: np.ndarray, docs: np.ndarray, impacts: np.ndarray, n_docs: int) -> np.ndarray:
        """Item by document scores from postings (term number, document, impact)."""
        total = np.zeros((len(self.items), n_docs), np.int64)
        columns = np.searchsorted(self.numbers, numbers)
        columns[columns == len(self.numbers)] = 0
        own = self.numbers[columns] == numbers
        columns, docs, impacts = columns[own], docs[own], impacts[own]
        for start in range(0, len(self.numbers), TILE_TERMS):
            inside = (columns >= start) & (columns < start + TILE_TERMS)
            if not inside.any():
                continue
            width = min(TILE_TERMS, len(self.numbers) - start)
            block = np.zeros((width, n_docs))
            block[columns[inside] - start, docs[inside]] = impacts[inside]
            mine = (self.column >= start) & (self.column < start + TILE_TERMS)
            digits, shift = self.weight[mine], 0
            while digits.any():
                dense = np.zeros((len(self.items), width))
                dense[self.at[mine], self.column[mine] - start] = digits & (2**DIGIT - 1)
                total += (dense @ block).astype(np.int64) << shift
                digits, shift = digits >> DIGIT, shift + DIGIT
        return total


class Best:
    """The k best documents of each item of a tile so far; equal scores by smaller id."""

    def __init__(self, n_items: int, k: int):
        self.k = k
        self.found = [(np.empty(0, np.int64), np.empty(0, np.int64)) for _ in range(n_items)]
        self.least = np.ones(n_items, np.int64)

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        # A score equal to the last one kept may still win by its id.
        for i in np.flatnonzero((scores >= self.least[:, None]).any(axis=1)):
            near = np.flatnonzero(scores[i] >= self.least[i])
            s = np.concatenate([self.found[i][0], scores[i, near]])
            d = np.concatenate([self.found[i][1], ids[near]])
            if len(s) > self.k:
                tied = s >= np.partition(s, len(s) - self.k)[len(s) - self.k]
                s, d = s[tied], d[tied]
            order = np.lexsort((d, -s))[: self.k]
            self.found[i] = (s[order], d[order])
            if len(order) == self.k:
                self.least[i] = s[order[-1]]


def _postings(texts: list, numbers: dict, documents: int, terms: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(term number, document, impact) of a block of texts."""
    g, at, tf, m = [], [], [], []
    for i, text in enumerate(texts):
        n, counts = 0, Counter()
        for piece in term_pieces(text):
            n += len(piece)
            counts.update(piece)
        m.append(75 + 25 * n * documents // terms if terms else 75)
        for t in numbers.keys() & counts.keys():
            g.append(numbers[t])
            at.append(i)
            tf.append(counts[t])
    at, tf = np.array(at, np.int64), np.array(tf, np.int64)
    impacts = 1_000_000_000 * tf // (1000 * tf + 12 * np.array(m, np.int64)[at]) if len(at) else tf
    return np.array(g, np.int64), at, impacts


def _score_pass(docs: DataFrame, pairs: list, k: int, id_type: str) -> DataFrame:
    """(item_row, item_id, doc_id, score): the k best of every task for the items of ``pairs`` (tile, item_row, item_id, term, n)."""
    context = docs.sparkSession.sparkContext
    terms = sorted({bytes(p["term"]) for p in pairs})
    vocabulary = context.broadcast({t: i for i, t in enumerate(terms)})
    counts = count_terms(docs, vocabulary)
    documents, length = counts.get(-1, 0), counts.get(-2, 0)
    weights = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * counts.get(i, 0) + 1))) for i in range(len(terms))], np.int64)
    by_tile: dict[int, list] = {}
    for p in pairs:
        by_tile.setdefault(p["tile"], []).append((p["item_row"], p["item_id"], vocabulary.value[bytes(p["term"])], p["n"]))
    tiles = context.broadcast([Tile(own, weights) for own in by_tile.values()])

    def search(batches):
        best = [Best(len(t.items), k) for t in tiles.value]
        for batch in by_bytes(batches, "text", BLOCK_BYTES):
            for start in range(0, batch.num_rows, BLOCK_DOCS):
                block = batch.slice(start, BLOCK_DOCS)
                ids = block.column(0).fill_null(LAST_ID).to_numpy(zero_copy_only=False).astype(np.int64)
                g, at, impacts = _postings(_bytes(block, "text"), vocabulary.value, documents, length)
                for tile, found in zip(tiles.value, best):
                    found.add(tile.scores(g, at, impacts, len(ids)), ids)
        for tile, found in zip(tiles.value, best):
            out = [(row, item, d, s) for (row, item), (ss, ds) in zip(tile.items, found.found) for d, s in zip(ds.tolist(), ss.tolist())]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([x[0] for x in out], pa.int64()),
                    pa.array([x[1] for x in out], _arrow(id_type)),
                    pa.array([x[2] for x in out], pa.int64()),
                    pa.array([x[3] for x in out], pa.int64()),
                ],
                ["item_row", "item_id", "doc_id", "score"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(search, f"item_row long, item_id {id_type}, doc_id long, score long")


def _arrow(simple: str) -> pa.DataType:
    return {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[simple]


def search(items: DataFrame, docs: DataFrame, k: int = 20, tile_items: int = TILE_ITEMS, pass_pairs: int = PASS_PAIRS) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` documents (doc_id, text) with the highest scores above 0 for each item (item_id, text).

    Terms are runs of letters, digits and non-ASCII characters of the whole text, A-Z lower-cased. With N documents that hold a term, L
    terms in them, n in one document, tf occurrences there and df documents that hold the term, the weight w of a term is
    floor(1000 * ln((2N+2)/(2df+1))), m is 75 + (25*n*N) div L, and a document's score is the sum over the item's
    terms, repeats included, of w * ((10**9*tf) div (1000*tf + 12*m)). Equal scores go by ascending doc_id, a null doc_id last.

    Items go to tiles of about ``tile_items``; about ``pass_pairs`` (item, term) pairs are sent to the tasks at once, and a
    larger set of items takes more passes over the documents, each with a count of its terms before it. The terms of one item
    stay together. Every item row is an item, repeated ones too; items and documents without text or terms have no rows, as
    have empty tables. Extra columns are left out. ``item_id`` is a bigint, int or string, or null.
    """
    id_type = items.schema["item_id"].dataType.simpleString()
    if id_type not in ("bigint", "int", "string"):
        raise ValueError(f"item_id is {id_type}; bigint, int or string is needed")
    pairs = materialize(item_terms(items.select("item_id", "text")), "item-terms")
    held, n_pairs = pairs.agg(F.countDistinct("item_row"), F.count("*")).first()
    passes = max(1, -(-n_pairs // pass_pairs))
    n_tiles = passes * max(1, -(-held // (passes * tile_items)))
    tiled = pairs.withColumn("tile", F.pmod(F.xxhash64("item_row"), F.lit(n_tiles)).cast("int"))
    found = None
    for p in range(passes):
        own = tiled.filter(F.col("tile") % passes == p).collect()
        part = _score_pass(docs, own, k, id_type)
        if passes > 1:
            part = materialize(part, "search-pass")
        found = part if found is None else found.unionByName(part)
    order = [F.col("score").desc(), F.col("doc_id")]
    merger = F.pmod(F.xxhash64("doc_id"), F.lit(MERGERS))
    near = found.withColumn("_m", merger).withColumn("_r", F.row_number().over(Window.partitionBy("item_row", "_m").orderBy(*order)))
    last = near.filter(F.col("_r") <= k).withColumn("rank", F.row_number().over(Window.partitionBy("item_row").orderBy(*order)))
    return last.filter(F.col("rank") <= k).select(
        "item_id", F.col("rank").cast("int").alias("rank"), F.when(F.col("doc_id") != LAST_ID, F.col("doc_id")).alias("doc_id"), "score"
    )
