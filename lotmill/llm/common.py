"""Helpers that several operators share."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lotmill.session import scratch_folder

# The smallest spread that numbering gives a group, and the rows it aims at per part.
MIN_PARTS, PART_ROWS = 8, 50_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialize(df: DataFrame, label: str) -> DataFrame:
    """The same rows as a table in the shared folder, cut off from their lineage."""
    spark = df.sparkSession
    path = scratch_folder(spark, f"llm-{label}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shield(docs: DataFrame, *used: str) -> DataFrame:
    """``docs`` with columns other than ``used`` renamed by place, so that none clashes with an operator's own."""
    return docs.toDF(*(c if c in used else f"_kept{i}" for i, c in enumerate(docs.columns)))


def unshield(rows: DataFrame, docs: DataFrame, *used: str) -> DataFrame:
    """The columns of ``docs`` under their names again, from ``rows`` made of the shielded ones."""
    return rows.select(*(F.col(c if c in used else f"_kept{i}").alias(c) for i, c in enumerate(docs.columns)))


def remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id's text modulo ``modulus``; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % modulus


def held_out(doc_id: Column, modulus: int, left: int) -> Column:
    """True where the id falls in the held-out fold; a null id never does."""
    return F.coalesce(remainder(doc_id, modulus) == left, F.lit(False))


def words(text: str) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of the text, A-Z lower-cased, as UTF-8."""
    return text.encode("utf-8", "surrogatepass").lower().split()


_SPREAD = np.uint64(0x9E3779B97F4A7C15)


def mix(values: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (the splitmix64 finaliser)."""
    x = values.astype(np.uint64, copy=True)
    with np.errstate(over="ignore"):
        x += _SPREAD
        x ^= x >> np.uint64(30)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(27)
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return x


def word_hashes(tokens: list[bytes]) -> np.ndarray:
    """64-bit hashes of words."""
    import xxhash

    h = xxhash.xxh3_64_intdigest
    return np.fromiter((h(t) for t in tokens), np.uint64, len(tokens))


def shingle_hashes(text: str | None, size: int = 5) -> np.ndarray:
    """Hashes of every ``size``-word window in order of appearance, repeats included.

    Fewer words make one shingle of the whole sequence; no word makes none.
    """
    tokens = words(text) if text else []
    if not tokens:
        return np.empty(0, np.uint64)
    return windows(word_hashes(tokens), size)


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """Order-sensitive hashes of the windows of ``size`` hashes."""
    n = max(1, len(hashes) - size + 1)
    out = np.full(n, min(size, len(hashes)), np.uint64)
    for k in range(min(size, len(hashes))):
        out = mix(out ^ hashes[k : k + n])
    return out


def by_bytes(batches, column: str, limit: int = 4_000_000):
    """Arrow batches cut so that ``column`` holds about ``limit`` bytes in each."""
    for batch in batches:
        at = batch.schema.get_field_index(column)
        lengths = pc.binary_length(batch.column(at)).fill_null(0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(lengths + 64)
        start = 0
        while start < batch.num_rows:
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + limit, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def number_within(df: DataFrame, group: str, order: list[Column], row: str, column: str) -> DataFrame:
    """Number the rows of each group from 0 without gaps, however few the groups are.

    ``row`` is a stored, unique row number. Each group is dealt by it to parts of
    bounded size, parts are numbered side by side and shifted by the rows of
    the parts before them, so no task holds a whole group.
    """
    rows = df.count()
    parts = max(MIN_PARTS, -(-rows // PART_ROWS))
    dealt = df.withColumn("_part", F.pmod(F.xxhash64(F.col(row)), F.lit(parts)))
    sizes = dealt.groupBy(group, "_part").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.select(
        F.col(group).alias("_group"),
        F.col("_part").alias("_shift_part"),
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_shift"),
    )
    within = Window.partitionBy(group, "_part").orderBy(*order, F.col(row))
    return (
        dealt.withColumn("_rank", F.row_number().over(within) - 1)
        .join(shifts, (F.col(group).eqNullSafe(F.col("_group"))) & (F.col("_part") == F.col("_shift_part")), "left")
        .withColumn(column, (F.col("_rank") + F.col("_shift")).cast("long"))
        .drop("_part", "_rank", "_group", "_shift_part", "_shift")
    )


def letters(text: str) -> list[str]:
    """Lower-cased runs of letters."""
    return re.findall(r"[^\W\d_]+", text.lower())
