"""Near duplicates by HyperMinHash: banded compressed registers, a corrected estimate, exact verification.

A document is the set of its distinct five-word shingles. Equal sets are one node. A
node's sketch has 200 registers; a register keeps the leading zeros and ten mantissa bits
of the least hash that fell into its bucket, in 16 bits. Buckets that a small set
leaves empty are filled by further rounds of hashing, whose number takes the place of the zeros.
Five registers make a band; nodes that agree in a band are compared.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotmill.llm.common import by_bytes, materialize, mix, shield, shingle_hashes, unshield
from lotmill.llm.components import component_roots

SHINGLE = 5
BANDS, BAND = 40, 5
REGISTERS = BANDS * BAND
MANTISSA, WIDTH = 10, 32
LAST_EXPONENT = 63
# Links: 100 * intersection >= PERCENT * union.
PERCENT = 75
# Five standard deviations of the estimate below the threshold.
CUT = PERCENT / 100 - 5 * (0.75 * 0.25 / REGISTERS) ** 0.5
# Buckets of up to so many nodes give all their pairs; larger ones a star, then cells of two blocks.
SMALL, BLOCK, BLOCK_SHINGLES = 8, 512, 2_000_000
# Node lists of up to so many rows are sent to every executor.
BROADCAST_ROWS = 500_000


# ---- sketches

def sketch(shingles: np.ndarray) -> np.ndarray:
    """The registers of a non-empty set of distinct 64-bit hashes."""
    n = len(shingles)
    least = np.full(REGISTERS, np.iinfo(np.uint64).max, np.uint64)
    empty, start = True, 0
    while empty:
        # Enough rounds at once that hardly ever a bucket stays empty.
        rounds = max(1, round(REGISTERS * 17 / n))
        seeds = mix(np.arange(start, start + rounds, dtype=np.uint64))
        h = mix(shingles[None, :] ^ seeds[:, None])
        bucket = ((h >> np.uint64(32)) * np.uint64(REGISTERS)) >> np.uint64(32)
        number = np.arange(start, start + rounds, dtype=np.uint64)[:, None]
        value = (np.minimum(number, np.uint64(2**31)) << np.uint64(32)) | (h & np.uint64(0xFFFFFFFF))
        np.minimum.at(least, bucket.ravel().astype(np.int64), value.ravel())
        start += rounds
        empty = bool((least == np.iinfo(np.uint64).max).any())
    return compress(least)


def compress(least: np.ndarray) -> np.ndarray:
    """16-bit registers of (round << 32 | value): exponent, then mantissa."""
    number, value = (least >> np.uint64(32)).astype(np.int64), (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
    # frexp is exact for 32 bits: value has `bits` significant ones.
    bits = np.frexp(value.astype(np.float64))[1]
    zeros = WIDTH - bits
    first = np.where(bits > 0, value << zeros.clip(0, WIDTH), 0)  # the leading one at the top bit
    mantissa = np.where(number > 0, value >> (WIDTH - MANTISSA), (first >> (WIDTH - 1 - MANTISSA)) & ((1 << MANTISSA) - 1))
    exponent = np.where(number > 0, np.minimum(WIDTH + number, LAST_EXPONENT), zeros)
    return ((exponent << MANTISSA) | mantissa).astype(np.uint16)


@lru_cache(maxsize=4096)
def _chance(log_n: int, log_m: int) -> float:
    """Chance that registers of unrelated sets agree, for elements per bucket of 2**(log/2)."""
    n, m = 2 ** (log_n / 2), 2 ** (log_m / 2)
    total = 0.0
    steps = np.arange(2**MANTISSA + 1) / 2**MANTISSA
    for zeros in range(WIDTH):
        edges = (1 + steps) / 2 ** (zeros + 1)
        a, b = (1 - edges) ** n, (1 - edges) ** m
        total += float(((a[:-1] - a[1:]) * (b[:-1] - b[1:])).sum())
    return total


def chance_agreement(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Expected share of registers that agree by accident, by set sizes."""
    logs = lambda x: np.rint(2 * np.log2(np.maximum(np.asarray(x, np.float64) / REGISTERS, 1))).astype(int)
    return np.array([_chance(int(a), int(b)) for a, b in np.broadcast(logs(n), logs(m))])


def estimate(a: np.ndarray, b: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Jaccard estimates of rows of registers, corrected for accidental agreement."""
    share, chance = (a == b).mean(axis=-1), chance_agreement(n, m)
    return (share - chance) / (1 - chance)


def _registers(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, REGISTERS)


def _sketches(batches):
    """(key columns..., text) to (key columns..., n_shingles, set_key, sketch)."""
    import hashlib

    for batch in by_bytes(batches, "text"):
        sizes, keys, sketches = [], [], []
        for text in batch.column("text").to_pylist():
            shingles = np.unique(shingle_hashes(text, SHINGLE))
            sizes.append(len(shingles))
            keys.append(hashlib.blake2b(shingles.tobytes(), digest_size=16).digest() if len(shingles) else None)
            sketches.append(sketch(shingles).tobytes() if len(shingles) else None)
        names = [c for c in batch.schema.names if c != "text"]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in names), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.array(sketches, pa.binary())],
            names=[*names, "n_shingles", "set_key", "sketch"],
        )


def _bands(batches):
    """(node, n, sketch) to one row (band, node, n) for each band."""
    for batch in batches:
        if not batch.num_rows:
            continue
        registers = _registers(batch.column("sketch")).reshape(-1, BANDS, BAND).astype(np.uint64)
        key = np.broadcast_to(mix(np.arange(BANDS, dtype=np.uint64)), registers.shape[:2])
        for k in range(BAND):
            key = mix(key ^ registers[:, :, k])
        nodes, sizes = (np.repeat(batch.column(c).to_numpy(), BANDS) for c in ("node", "n"))
        yield pa.RecordBatch.from_arrays([pa.array(key.reshape(-1).view(np.int64)), pa.array(nodes), pa.array(sizes)], names=["band", "node", "n"])


# ---- candidate pairs of bands

def _likely(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The (hi, lo) pairs whose corrected estimate passes the cut."""
    side = lambda s: nodes.select(F.col("node").alias(s), F.col("n").alias(f"{s}_n"), F.col("sketch").alias(f"{s}_sketch"))
    # Sets of too different sizes cannot reach the threshold.
    fits = 100 * F.least("hi_n", "lo_n") >= PERCENT * F.greatest("hi_n", "lo_n")
    joined = pairs.join(side("hi"), "hi").join(side("lo"), "lo").filter(fits)

    def passing(batches):
        for batch in batches:
            if batch.num_rows:
                n, m = (batch.column(c).to_numpy() for c in ("hi_n", "lo_n"))
                good = estimate(_registers(batch.column("hi_sketch")), _registers(batch.column("lo_sketch")), n, m) >= CUT
                yield batch.select(["hi", "lo"]).filter(pa.array(good))

    return joined.select("hi", "lo", "hi_n", "lo_n", "hi_sketch", "lo_sketch").mapInArrow(passing, "hi long, lo long")


def _shared(a: np.ndarray, b: np.ndarray) -> int:
    return len(np.intersect1d(a, b, assume_unique=True))


def linked(shared: int | np.ndarray, n: int | np.ndarray, m: int | np.ndarray) -> bool | np.ndarray:
    return 100 * shared >= PERCENT * (n + m - shared)


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The (hi, lo) pairs whose full sets are similar enough."""
    side = lambda s: sets.select(F.col("node").alias(s), F.col("shingles").alias(f"{s}_set"))

    def passing(batches):
        for batch in by_bytes(batches, "hi_set"):
            good = []
            for x, y in zip(batch.column("hi_set").to_pylist(), batch.column("lo_set").to_pylist()):
                a, b = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                good.append(linked(_shared(a, b), len(a), len(b)))
            yield batch.select(["hi", "lo"]).filter(pa.array(good, pa.bool_()))

    return pairs.join(side("hi"), "hi").join(side("lo"), "lo").mapInArrow(passing, "hi long, lo long")


# ---- cells of two blocks of one large bucket

class _Forest:
    def __init__(self, n: int):
        self.parent = list(range(n))

    def find(self, x: int) -> int:
        while self.parent[x] != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = self.parent[x]
        return x

    def join(self, x: int, y: int) -> None:
        self.parent[self.find(x)] = self.find(y)


def links_of_cell(nodes: np.ndarray, sets: list[np.ndarray], registers: np.ndarray, roots: np.ndarray) -> list[tuple[int, int]]:
    """Links between members that ``roots`` and earlier links leave apart, enough to join all that are linked."""
    n = np.array([len(s) for s in sets])
    _, flat = np.unique(np.concatenate(sets), return_inverse=True)
    starts = np.concatenate([[0], np.cumsum(n)[:-1]])
    mark = np.zeros(int(flat.max()) + 1, np.int64)
    _, group = np.unique(roots, return_inverse=True)
    forest, out = _Forest(int(group.max()) + 1), []
    for a in range(len(nodes) - 1):
        others = np.arange(a + 1, len(nodes))
        others = others[group[others] != group[a]]
        others = others[100 * np.minimum(n[others], n[a]) >= PERCENT * np.maximum(n[others], n[a])]
        if len(others):
            others = others[estimate(registers[a], registers[others], n[a], n[others]) >= CUT]
        others = [b for b in others.tolist() if forest.find(group[a]) != forest.find(group[b])]
        if not others:
            continue
        own = flat[starts[a] : starts[a] + n[a]]
        mark[own] = 1
        for b in others:
            if forest.find(group[a]) != forest.find(group[b]):
                shared = int(mark[flat[starts[b] : starts[b] + n[b]]].sum())
                if linked(shared, int(n[a]), int(n[b])):
                    forest.join(group[a], group[b])
                    out.append((int(max(nodes[a], nodes[b])), int(min(nodes[a], nodes[b]))))
        mark[own] = 0
    return out


def _cell_links(members: DataFrame, sets: DataFrame) -> DataFrame:
    """(hi, lo) links inside large buckets. ``members`` is (band, node, root, size, shingled).

    A bucket is cut into blocks of about BLOCK nodes and BLOCK_SHINGLES shingles; every two
    blocks meet in one cell, so any two members meet once, and no task holds more than two blocks.
    """
    import pandas as pd

    blocks = F.ceil(F.greatest(F.col("size") / BLOCK, F.col("shingled") / BLOCK_SHINGLES)).cast("int")
    placed = members.withColumn("_blocks", blocks).withColumn("_own", F.pmod(F.xxhash64("node"), F.col("_blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1))
    placed = placed.withColumn("_other", other).select(
        "band", F.least("_own", "_other").alias("_i"), F.greatest("_own", "_other").alias("_j"), "node", "root"
    )
    full = placed.join(sets, "node")

    def links(cell: pd.DataFrame) -> pd.DataFrame:
        found = links_of_cell(
            cell["node"].to_numpy(np.int64),
            [np.frombuffer(s, np.uint64) for s in cell["shingles"]],
            np.frombuffer(b"".join(cell["sketch"]), np.uint16).reshape(-1, REGISTERS),
            cell["root"].to_numpy(np.int64),
        )
        return pd.DataFrame(found, columns=["hi", "lo"], dtype="int64")

    return full.groupBy("band", "_i", "_j").applyInPandas(links, "hi long, lo long")


# ---- the operator

def _with_roots(nodes: DataFrame, roots: DataFrame) -> DataFrame:
    return nodes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))


def _bounded(df: DataFrame) -> DataFrame:
    """``df`` marked for broadcast where a count shows that it is small, else as it is."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def similar_sets(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows and nodes of ``docs`` (doc_id, text, and other columns that are carried along).

    Rows: all columns but text, with n_shingles and set_key. Nodes: node, set_key,
    first_doc, n, root, where all linked nodes have one root.
    """
    text_hash = F.xxhash64("text").alias("_text")
    keyed = docs.select(*[c for c in docs.columns if c != "text"], text_hash, "text")
    out = f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in keyed.schema if f.name != 'text')}, n_shingles long, set_key binary, sketch binary"
    rows = materialize(keyed.mapInArrow(_sketches, out), "sketches")
    nodes = materialize(
        rows.filter("n_shingles > 0")
        .groupBy("set_key")
        .agg(
            F.min_by(F.struct("doc_id", "_text"), F.struct(F.col("doc_id").isNull(), "doc_id", "_text")).alias("_first"),
            F.any_value("n_shingles").alias("n"),
            F.any_value("sketch").alias("sketch"),
        )
        .select(F.monotonically_increasing_id().alias("node"), "set_key", F.col("_first.doc_id").alias("first_doc"), F.col("_first._text").alias("_text"), "n", "sketch"),
        "sets",
    )
    bands = nodes.select("node", "n", "sketch").mapInArrow(_bands, "band long, node long, n long")
    # Most bands stand alone; what is left is small, and Spark then sends the hubs to the bands.
    hubs = bands.groupBy("band").agg(F.min("node").alias("hub"), F.count("*").alias("size"), F.sum("n").alias("shingled")).filter("size > 1")
    shared = materialize(bands.join(hubs, "band"), "bands")
    star = shared.filter("node <> hub").select(F.col("node").alias("hi"), F.col("hub").alias("lo"))
    few = (
        shared.filter(f"size BETWEEN 3 AND {SMALL}")
        .groupBy("band")
        .agg(F.array_sort(F.collect_list("node")).alias("m"))
        .select(F.explode(F.flatten(F.transform("m", lambda x, i: F.transform(F.slice("m", F.lit(2), i), lambda y: F.struct(x.alias("hi"), y.alias("lo")))))).alias("p"))
        .select("p.hi", "p.lo")
        .filter("hi > lo")
    )
    pairs = star.unionByName(few).distinct()
    likely = materialize(_likely(pairs, nodes), "pairs")
    large = shared.filter(f"size > {SMALL}").select("band", "node", "size", "shingled")
    wanted = likely.select(F.col("hi").alias("node")).unionByName(likely.select(F.col("lo").alias("node"))).unionByName(large.select("node")).distinct()
    sets = _full_sets(docs, nodes.join(wanted, "node", "left_semi"))
    links = materialize(_verified(likely, sets), "links")
    roots = component_roots(links)
    # Large buckets whose members are still apart: the pairs beside the star.
    members = materialize(_with_roots(large, roots), "members")
    apart = members.groupBy("band").agg(F.min("root").alias("a"), F.max("root").alias("b")).filter("a <> b").select("band")
    more = materialize(_cell_links(members.join(apart, "band", "left_semi"), sets), "cell-links")
    if not more.isEmpty():
        roots = component_roots(links.unionByName(more))
    return rows, _with_roots(nodes.drop("sketch"), roots)


def _full_sets(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, sketch, shingles): the sorted distinct shingle hashes of one document of each node."""
    wanted = nodes.select("node", F.col("first_doc").alias("_doc"), F.col("_text").alias("_hash"))
    texts = docs.select("doc_id", "text", F.xxhash64("text").alias("_text"))
    found = texts.join(_bounded(wanted), F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("_text") == F.col("_hash"))).select("node", "text")

    def shingled(batches):
        for batch in by_bytes(batches, "text"):
            sets = [np.unique(shingle_hashes(text, SHINGLE)).tobytes() for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(sets, pa.binary())], names=["node", "shingles"])

    # A node's document may be repeated; its set is the same in each row.
    made = found.mapInArrow(shingled, "node long, shingles binary")
    sets = made.groupBy("node").agg(F.any_value("shingles").alias("shingles"))
    return materialize(sets.join(nodes.select("node", "sketch"), "node"), "full-sets")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row of ``docs`` (doc_id, text; no other column is read).

    component_id is the smallest doc_id of the document's component, itself included; kept is
    doc_id = component_id. Null or empty text, or one without a word, has no shingle and is linked with nothing. Repeated
    rows are one node and all keep their rows. A null doc_id counts as larger than any other; a component
    of null ids only has a null component_id and is kept.
    """
    rows, nodes = similar_sets(docs.select("doc_id", "text"))
    first = nodes.groupBy("root").agg(F.min("first_doc").alias("component_id"))
    known = nodes.select(F.col("set_key").alias("_set"), "root").join(first, "root").select("_set", "component_id")
    own = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return (
        rows.join(known, F.col("set_key") == F.col("_set"), "left")
        .withColumn("component_id", own)
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
        .select("doc_id", "n_shingles", "component_id", "kept")
    )


def one_of_each(docs: DataFrame) -> DataFrame:
    """One row of ``docs`` for each component, all columns as they are.

    It is the row with the smallest doc_id (a null id last), of repeated rows any one. Rows without
    a shingle are linked with nothing and stay; a repeated one stays each time.
    """
    rows = materialize(shield(docs, "doc_id", "text").withColumn("_row", F.monotonically_increasing_id()), "near-rows")
    marked, nodes = similar_sets(rows.select("_row", "doc_id", "text"))
    roots = nodes.select(F.col("set_key").alias("_set"), "root")
    grouped = marked.filter("n_shingles > 0").join(roots, F.col("set_key") == F.col("_set"))
    # One aggregation with map-side minima, however large a group is.
    first = grouped.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("a"), F.col("doc_id").alias("b"), F.col("_row").alias("c"))).alias("_first"))
    kept = materialize(first.select(F.col("_first.c").alias("_row")).unionByName(marked.filter("n_shingles = 0").select("_row")), "near-kept")
    # Few row numbers go to the texts; else both are shuffled.
    return unshield(rows.join(_bounded(kept), "_row", "left_semi"), docs, "doc_id", "text")
