"""Benchmark decontamination: size-partitioned MinHash containment search, then exact containment.

A short item inside a long document has a tiny Jaccard similarity with the whole of it. Items
are therefore parted by size into classes, and a document is looked at through windows
somewhat longer than the items of a class, in which an item that is there has a large
share. Item and window are compared by MinHash: under each of 64 hash functions, does the
least shingle of both agree? A window's least shingle can only agree with an item's if it is that
very shingle, so windows are evaluated where one of the items' least shingles stands.
Any agreement makes the item a candidate for the document; shingle sets of both then decide.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotmill.llm.common import by_bytes, materialize, mix, shield, unshield, windows, word_hashes, words

SHINGLE = 5
FUNCTIONS = 64
# 100 * shared shingles >= PERCENT * shingles of the item.
PERCENT = 75
# Items of up to so many shingles in all are sent to every task at once; more go in slices of this size.
SLICE_SHINGLES = 2_000_000


def _seeds() -> np.ndarray:
    return mix(np.arange(1000, 1000 + FUNCTIONS, dtype=np.uint64))


def _least(shingles: np.ndarray) -> np.ndarray:
    """Place of the least shingle under each hash function."""
    seeds = _seeds()
    return np.array([int(mix(shingles ^ s).argmin()) for s in seeds])


def size_class(n: int) -> int:
    """Items of 2**(c-1) < n <= 2**c shingles are of class c."""
    return max(0, int(n - 1).bit_length())


def window_of(size: int) -> tuple[int, int]:
    """Length and step of the windows of a size class: any item of the class lies whole in one."""
    full = 2**size
    step = max(1, full // 4)
    return full + step - 1 if full > 1 else 1, step


class ItemIndex:
    """Least shingles of items: by shingle, which item has it under which hash functions."""

    def __init__(self, items: list[tuple[int, np.ndarray]]):
        self.sets = {i: np.unique(s) for i, s in items if len(s)}
        self.where: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
        for item, own in self.sets.items():
            functions: dict[int, int] = defaultdict(int)
            for k, place in enumerate(_least(own)):
                functions[int(own[place])] |= 1 << k
            for shingle, mask in functions.items():
                self.where[shingle].append((size_class(len(own)), item, mask))
        self.keys = np.array(sorted(self.where), np.uint64)

    def candidates(self, shingles: np.ndarray) -> set[int]:
        """Items that agree with some window of the document in some least shingle."""
        if not len(self.keys):
            return set()
        at = np.searchsorted(self.keys, shingles)
        at[at == len(self.keys)] = 0
        hits = np.flatnonzero(self.keys[at] == shingles)
        found: set[int] = set()
        for place in hits.tolist():
            rivals: dict[int, dict[int, bool]] = defaultdict(dict)
            for size, item, mask in self.where[int(shingles[place])]:
                if item in found:
                    continue
                k = 0
                while mask >> k:
                    if mask >> k & 1:
                        if k not in rivals[size]:
                            rivals[size][k] = _least_of_a_window(shingles, place, size, k)
                        if rivals[size][k]:
                            found.add(item)
                            break
                    k += 1
        return found

    def contained(self, item: int, document: np.ndarray) -> int:
        """Shingles that the item shares with the sorted distinct shingles of a document."""
        own = self.sets[item]
        at = np.searchsorted(document, own)
        at[at == len(document)] = 0
        return int((document[at] == own).sum())


def _least_of_a_window(shingles: np.ndarray, place: int, size: int, function: int) -> bool:
    """Is the shingle at ``place`` the least one of some window of the class that holds it?"""
    length, step = window_of(size)
    first = max(0, -(-(place - length + 1) // step))  # number of the first window that reaches the place
    start = first * step
    values = mix(shingles[start : place + length] ^ _seeds()[function])
    own = place - start
    # Windows begin at multiples of the step, up to the place itself.
    for offset in range(0, own + 1, step):
        if values[own] == values[offset : offset + length].min():
            return True
    return False


def _item_slices(items: DataFrame, most: int) -> list[DataFrame]:
    """The items, in slices of about ``most`` words each; nearly always one."""
    octets = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-octets // (6 * most)))
    part = F.pmod(F.xxhash64("item_id"), F.lit(n))
    return [items.filter(part == k) for k in range(n)]


def _hashes(text: str | None) -> np.ndarray:
    return word_hashes(words(text) if text else [])


def short_items(items: list[np.ndarray]) -> dict[int, dict[int, list[int]]]:
    """Places of items of fewer words than a shingle, by number of words and hash of all words."""
    found: dict[int, dict[int, list[int]]] = {}
    for k, own in enumerate(items):
        if 0 < len(own) < SHINGLE:
            found.setdefault(len(own), {}).setdefault(int(windows(own, len(own))[0]), []).append(k)
    return found


def short_contained(short: dict[int, dict[int, list[int]]], document: np.ndarray) -> list[int]:
    """Short items whose words stand side by side in a document of these word hashes."""
    found = []
    for size, places in short.items():
        if len(document) >= size:
            both = np.intersect1d(windows(document, size), np.fromiter(places, np.uint64, len(places)))
            found += [k for h in both.tolist() for k in places[h]]
    return found


def contamination(docs: DataFrame, benchmark: DataFrame, percent: int = PERCENT, most: int = SLICE_SHINGLES) -> DataFrame:
    """(columns of ``docs`` but text, item_id, item_shingles, shared): each item that a document contains.

    An item is contained if the document has at least ``percent`` of its distinct five-word
    shingles, anywhere in its text. An item of fewer than five words has one shingle, of all its words, and is found wherever
    these words stand side by side; null or empty items and texts have none and match nothing. Repeated
    rows are reported each; items with the same item_id count as one for each distinct text. The
    benchmark is read in slices of bounded size, each sent to every task; for each slice the documents are passed once. A column of ``docs``
    with a result's name gives way to it.
    """
    docs = docs.drop("item_id", "item_shingles", "shared")
    own = [f for f in docs.schema if f.name != "text"]
    names = [f.name for f in own]
    result = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in own) + "item_id long, item_shingles long, shared long"
    known = benchmark.select(F.col("item_id").cast("long"), "text").filter("text IS NOT NULL").distinct()
    found = None
    for part in _item_slices(known, most):
        rows = [(r["item_id"], _hashes(r["text"])) for r in part.collect()]
        ids = [i for i, _ in rows]
        index = ItemIndex([(k, windows(h, SHINGLE)) for k, (_, h) in enumerate(rows) if len(h) >= SHINGLE])
        short = short_items([h for _, h in rows])

        def search(batches, index=index, ids=ids, short=short):
            for batch in by_bytes(batches, "text"):
                at, items, sizes, shared = [], [], [], []
                for row, text in enumerate(batch.column("text").to_pylist()):
                    hashes = _hashes(text)
                    for k in short_contained(short, hashes):
                        at.append(row)
                        items.append(ids[k])
                        sizes.append(1)
                        shared.append(1)
                    shingles = windows(hashes, SHINGLE) if len(hashes) else hashes
                    likely = index.candidates(shingles)
                    document = np.unique(shingles) if likely else None
                    for k in sorted(likely):
                        size, n = len(index.sets[k]), index.contained(k, document)
                        if 100 * n >= percent * size:
                            at.append(row)
                            items.append(ids[k])
                            sizes.append(size)
                            shared.append(n)
                taken = batch.select(names).take(pa.array(at, pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [*taken.columns, *(pa.array(x, pa.int64()) for x in (items, sizes, shared))], names=[*names, "item_id", "item_shingles", "shared"]
                )

        matches = docs.mapInArrow(search, result)
        found = matches if found is None else found.unionByName(matches)
    return found


def clean_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that contain no benchmark item, all columns as they are."""
    numbered = materialize(shield(docs, "text").withColumn("_row", F.monotonically_increasing_id()), "decontaminate")
    dirty = contamination(numbered.select("_row", "text"), benchmark).select("_row").distinct()
    return unshield(numbered.join(dirty, "_row", "left_anti"), docs, "text")
