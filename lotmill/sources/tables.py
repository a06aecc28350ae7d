"""Stored listing tables: the current table in key partitions, bucketed append tables, mart snapshots."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterator, Mapping
from contextlib import contextmanager
from datetime import datetime
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lotmill.operators.dedup import fingerprinted, keep_first, keep_last
from lotmill.operators.gate import passing
from lotmill.operators.merge import KEY, change_images, counted_latest, latest_rows
from lotmill.schemas import CLEAN_SCHEMA, CURRENT_SCHEMA, RAW_SCHEMA
from lotmill.session import bytes_read, drop_folder, is_written, matches, no_rows

BUCKETS = 32

#: Rows of one key that are left to the one task that has its bucket.
MOST_ROWS = 1_000_000

#: Bytes of input files that make a bucket of a merge, up to as many buckets as shuffle partitions.
BUCKET_BYTES = 2 << 20

#: Keys that may be sent to every executor. Compressed files tell little of how many there are, so they are counted.
FEW_KEYS = 500_000


def buckets_for(spark: SparkSession, *sources: DataFrame) -> int:
    """How many buckets suit a table that these are loaded into: as many more as their files are larger, so that a bucket is not."""
    return max(BUCKETS, -(-bytes_read(spark, *sources) // BUCKET_BYTES))


@contextmanager
def _bucket_a_task(spark: SparkSession) -> Iterator[None]:
    """Meanwhile bucketed tables are read a bucket a task, and rows of one bucket are written as they come.

    Else every task sorts whole rows by a bucket that they share. A task that does have rows of a second bucket still sorts those left.
    """
    wanted = {"spark.sql.maxConcurrentOutputFileWriters": "1", "spark.sql.sources.bucketing.autoBucketedScan.enabled": "false"}
    before = {name: spark.conf.get(name, None) for name in wanted}
    try:
        for name, value in wanted.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


class CurrentTable:
    """One current row per key, in partitions by a hash of the key.

    A merge writes two things, in this order: what it changes, as before and after images under ``changes/<batch>``, and
    the partitions that hold a changed key, by Spark's dynamic partition overwrite. A batch whose
    images are there is not compared again; writing its partitions once more gives the same rows. So a load that failed anywhere
    is run again under its name. One writer at a time.

    The partition of a key is also its bucket: rows, a batch cut to its latest rows and its images are all bucketed by
    the key alike, so incoming rows are shuffled once, as they are dealt, and nothing stored is shuffled to meet them.
    """

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType = CURRENT_SCHEMA, n_buckets: int = BUCKETS):
        self.spark, self.root, self.schema, self.n_buckets = spark, root.rstrip("/"), schema, n_buckets
        self.stored = T.StructType([*schema.fields, T.StructField("bucket", T.IntegerType())])
        self.image = T.StructType(
            [T.StructField(KEY, T.StringType()), T.StructField("bucket", T.IntegerType()), T.StructField("action", T.StringType()),
             T.StructField("n_rows", T.LongType()), T.StructField("before", schema), T.StructField("after", schema)]
        )

    def exists(self) -> bool:
        return matches(self.spark, f"{self.root}/rows/bucket=*")

    def bucket(self):
        """The bucket that Spark puts a key into."""
        return F.pmod(F.hash(KEY), F.lit(self.n_buckets))

    def dealt(self, rows: DataFrame) -> DataFrame:
        """Rows dealt as the buckets are; what then groups or joins by the key shuffles no more."""
        return rows.repartition(self.n_buckets, KEY)

    def _table(self) -> str:
        """The catalog table over the stored rows, as they are now."""
        clause = f"PARTITIONED BY (bucket) CLUSTERED BY (`{KEY}`) INTO {self.n_buckets} BUCKETS"
        name = _catalog_table(self.spark, f"{self.root}/rows", self.stored, clause, partitionOverwriteMode="dynamic")
        if self.exists():
            self.spark.sql(f"MSCK REPAIR TABLE {name} SYNC PARTITIONS")
        self.spark.catalog.refreshTable(name)
        return name

    def _rows(self, buckets: list[int] | None = None) -> DataFrame:
        """Stored rows with their ``bucket``; files of other buckets than the given ones are not listed."""
        if not self.exists():
            return no_rows(self.spark, self.stored)
        rows = self.spark.table(self._table())
        return rows if buckets is None else rows.filter(F.col("bucket").isin(buckets))

    def read(self) -> DataFrame:
        if not self.exists():
            return no_rows(self.spark, self.schema)
        return self.spark.read.schema(self.stored).parquet(f"{self.root}/rows").select(*self.schema.names)

    def images(self, batch: str) -> DataFrame:
        """(property_id, bucket, action, n_rows, before, after) of a merged batch; see :func:`change_images`."""
        return self.spark.read.schema(self.image).parquet(f"{self.root}/changes/{batch}")

    def _changes(self, batch: str) -> BucketedTable:
        return BucketedTable(self.spark, f"{self.root}/changes/{batch}", self.image, KEY, self.n_buckets)

    def _write(self, rows: DataFrame) -> None:
        """Replace the partitions that these rows, dealt as the buckets are, belong to."""
        rows.select(*self.stored.names).write.insertInto(self._table(), overwrite=True)

    def replace(self, rows: DataFrame, batch: str | None = None, dealt: bool = False) -> None:
        """Just these rows from now on; without any, an error, and the table stays as it is.

        Earlier images go. The rows may come from this table. ``dealt`` if they come from :meth:`dealt`.
        """
        batch, seen = batch or uuid.uuid4().hex, Observation()
        rows = (rows if dealt else self.dealt(rows)).select(*self.schema.names).withColumn("bucket", self.bucket())
        with _bucket_a_task(self.spark):
            self._write(rows.observe(seen, F.collect_set("bucket").alias("buckets")))
        written = seen.get["buckets"]
        if not written:
            raise RuntimeError("no rows were loaded")
        for gone in set(range(self.n_buckets)).difference(written):
            drop_folder(self.spark, f"{self.root}/rows/bucket={gone}")
        drop_folder(self.spark, f"{self.root}/changes")
        after = F.struct(*self.schema.names)
        inserts = self._rows().select(KEY, "bucket", F.lit("insert").alias("action"), F.lit(1).cast("long").alias("n_rows"), F.lit(None).cast(self.schema).alias("before"), after.alias("after"))
        with _bucket_a_task(self.spark):
            self._changes(batch).overwrite(inserts)

    def merge(self, staged: DataFrame, as_of: datetime, only_newer: bool = True, batch: str | None = None) -> dict[str, int]:
        """Merge gated clean rows; rows inserted, updated and unchanged, as a row-by-row upsert would count them.

        The batch is dealt to the buckets, cut there to one row per key and written first; if it is small (:data:`FEW_KEYS`), Spark
        then may send it to the stored rows, else it meets them bucket by bucket. Only buckets with a key of the batch are read, and
        only buckets with a changed one are written: a batch delivered twice writes none.
        """
        with _bucket_a_task(self.spark):
            return self._merge(staged, as_of, only_newer, batch)

    def _merge(self, staged: DataFrame, as_of: datetime, only_newer: bool, batch: str | None) -> dict[str, int]:
        batch = batch or uuid.uuid4().hex
        path, aside = f"{self.root}/changes/{batch}", f"{self.root}/incoming/{batch}"
        changed = F.col("action") != "unchanged"
        counts = [
            F.coalesce(F.sum(F.when(F.col("action") == "insert", 1)), F.lit(0)).alias("inserted"),
            F.coalesce(F.sum(F.when(changed, F.col("n_rows"))), F.lit(0)).alias("moved"),
            F.coalesce(F.sum(F.when(~changed, F.col("n_rows"))), F.lit(0)).alias("unchanged"),
            F.count(F.when(changed, 1)).alias("keys"),
            F.collect_set(F.when(changed, F.col("bucket"))).alias("buckets"),
        ]
        if is_written(self.spark, path):
            found = self.images(batch).agg(*counts).first().asDict()
        else:
            reach, seen = Observation(), Observation()
            latest = counted_latest(self.dealt(staged), as_of).withColumn("bucket", self.bucket())
            cut = BucketedTable(self.spark, aside, latest.schema, KEY, self.n_buckets)
            cut.overwrite(latest.observe(reach, F.count("*").alias("keys"), F.collect_set("bucket").alias("buckets")))
            stored = self._rows(list(reach.get["buckets"]))
            images = change_images(stored, cut.read(), only_newer, reach.get["keys"] <= FEW_KEYS)
            self._changes(batch).overwrite(images.observe(seen, *counts))
            found = seen.get
            cut.drop()
        if found["buckets"]:
            images = self._changes(batch).read().filter(changed)
            gone = images.select(KEY) if found["keys"] <= FEW_KEYS else images.select(KEY).hint("merge")
            kept = self._rows(list(found["buckets"])).join(gone, KEY, "left_anti")
            # By the key, which says that a task has one bucket.
            after = images.select(KEY, *[f"after.{c}" for c in self.schema.names if c != KEY], "bucket")
            self._write(kept.unionByName(after))
        return {"inserted": found["inserted"], "updated": found["moved"] - found["inserted"], "unchanged": found["unchanged"]}


def _catalog_table(spark: SparkSession, path: str, schema: T.StructType, clause: str, **options: str) -> str:
    """The name of the catalog table over a folder, which is made if the session does not know it.

    Hashes are half as large under zstd as under snappy.
    """
    name = f"lotmill_{hashlib.sha256(path.encode()).hexdigest()[:16]}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    place = path.replace("\\", "\\\\").replace("'", "\\'")
    given = ", ".join(f"{k} '{v}'" for k, v in {"compression": "zstd", **options}.items())
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet OPTIONS ({given}) {clause} LOCATION '{place}'")
    return name


class BucketedTable:
    """An append-only catalog table over a folder, bucketed by its key.

    New rows are dealt as the buckets are, so they meet the stored keys without a shuffle of these.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, key: str, n_buckets: int = BUCKETS, **options: str):
        self.spark, self.path, self.key, self.n_buckets, self.columns = spark, path, key, n_buckets, schema.names
        self.name = _catalog_table(spark, path, schema, f"CLUSTERED BY (`{key}`) INTO {n_buckets} BUCKETS", **options)

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def dealt(self, rows: DataFrame) -> DataFrame:
        """Rows, with the columns of the table, dealt as its buckets are; what then groups or joins by the key shuffles no more."""
        return rows.select(*self.columns).repartition(self.n_buckets, self.key)

    def unseen(self, rows: DataFrame, dealt: bool = False) -> DataFrame:
        """Rows, one for each key, whose key is not stored; ``dealt`` if they come from :meth:`dealt`.

        Stored keys are met bucket by bucket however small their files are: compressed, millions of keys take a few MB.
        """
        rows = rows if dealt else self.dealt(rows)
        return rows.join(self.read().select(self.key).hint("merge"), self.key, "left_anti").select(*self.columns)

    def overwrite(self, rows: DataFrame) -> None:
        """Just these rows; a bucket is one file if they are dealt as the buckets are, else one of each task that has rows of it."""
        rows.select(*self.columns).write.insertInto(self.name, overwrite=True)

    def drop(self) -> None:
        """Delete the table and its folder."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
        drop_folder(self.spark, self.path)

    def append(self, rows: DataFrame, dealt: bool = False) -> int:
        """Append the rows whose key is not stored, one for each key; how many. What is stored is neither moved nor rewritten."""
        seen = Observation()
        with _bucket_a_task(self.spark):
            self.unseen(rows, dealt).observe(seen, F.count("*").alias("n")).write.insertInto(self.name)
        return seen.get["n"]


def raw_table(spark: SparkSession, path: str, n_buckets: int = BUCKETS) -> BucketedTable:
    return BucketedTable(spark, path, CLEAN_SCHEMA, KEY, n_buckets)


def load_raw_table(spark: SparkSession, incoming: DataFrame, path: str, n_buckets: int = BUCKETS) -> int:
    """Append the first row of each unseen key of the batch to the raw table; how many.

    Rows of a key meet in its bucket, so that they are shuffled once.
    """
    return raw_table(spark, path, n_buckets).append(keep_first(incoming.repartition(n_buckets, KEY), KEY), dealt=True)


def raw_archive(spark: SparkSession, path: str, n_buckets: int = BUCKETS) -> BucketedTable:
    """Raw rows of all collections, each content once, by fingerprint."""
    schema = T.StructType([*RAW_SCHEMA.fields, T.StructField("fingerprint", T.StringType())])
    return BucketedTable(spark, path, schema, "fingerprint", n_buckets)


def append_raw(archive: BucketedTable, rows: DataFrame) -> int:
    """Append raw rows, normalised, whose content is not in the archive yet; how many.

    Copies meet in their bucket, so that the rows are shuffled once.
    """
    return archive.append(archive.dealt(fingerprinted(rows)).dropDuplicates(["fingerprint"]), dealt=True)


def full_reload(table: CurrentTable, staged: DataFrame, as_of: datetime) -> DataFrame:
    """Replace the table by the staged rows; an empty load is an error and keeps the old rows."""
    table.replace(latest_rows(table.dealt(passing(staged)), as_of), dealt=True)
    return table.read()


def incremental_load(table: CurrentTable, staged: DataFrame, as_of: datetime, only_newer: bool = True) -> DataFrame:
    """First load when the table holds nothing, else merge the staged rows into it."""
    if not table.exists():
        return full_reload(table, staged, as_of)
    table.merge(passing(staged), as_of, only_newer)
    return table.read()


def merged_in_buckets(
    run: Callable[..., DataFrame],
    existing: DataFrame,
    incoming: DataFrame,
    as_of: datetime,
    path: str,
    n_buckets: int | None = None,
    most_rows: int = MOST_ROWS,
) -> DataFrame:
    """``run``, an upsert of :mod:`lotmill.operators.merge`, over two sides that are first put into the same buckets.

    Every task writes what it reads into the files of the buckets, so whole rows lie on disk once, in compressed columns, and
    meet bucket by bucket without a shuffle. Keys with more than ``most_rows`` rows in the batch are cut to their latest row by all tasks
    before, so no task has to sort such a key. If not given, there are as many buckets as shuffle partitions, fewer for
    small files. The result reads the files under ``path``.
    """
    spark = existing.sparkSession
    most = int(spark.conf.get("spark.sql.shuffle.partitions"))
    n_buckets = n_buckets or min(most, -(-bytes_read(spark, existing, incoming) // BUCKET_BYTES) or most)
    incoming = incoming.withColumn("_cut", F.lit(False))
    # Read once: dictionaries would take longer to build than they save.
    once = {"parquet.enable.dictionary": "false"}
    stored = BucketedTable(spark, f"{path}/stored", existing.schema, KEY, n_buckets, **once)
    batch = BucketedTable(spark, f"{path}/batch", incoming.schema, KEY, n_buckets, **once)
    stored.overwrite(existing)
    batch.overwrite(incoming)
    often = batch.read().groupBy(KEY).count().filter(F.col("count") > most_rows).collect()
    hot = reduce(or_, [F.col(KEY).eqNullSafe(F.lit(r[KEY])) for r in often], F.lit(False))
    if often:
        # Not by bucket: the files of a hot key are many, and as many tasks read them.
        spread = spark.read.schema(incoming.schema).parquet(batch.path).filter(hot).drop("_cut")
        keep_last(spread, KEY).withColumn("_cut", F.lit(True)).select(*batch.columns).write.insertInto(batch.name)
    return run(stored.read(), batch.read().filter(F.col("_cut") | ~hot).drop("_cut"), as_of)


def save_snapshots(marts: Mapping[str, DataFrame], folder: str, prefix: str = "mv_") -> None:
    """Write every mart as a parquet snapshot, replacing the last one."""
    for name, mart in marts.items():
        mart.write.mode("overwrite").parquet(f"{folder}/{prefix}{name}")


def save_snapshot_tables(marts: Mapping[str, DataFrame], database: str | None = None, prefix: str = "mv_") -> None:
    """The same snapshots as catalog tables."""
    for name, mart in marts.items():
        target = f"{database}.{prefix}{name}" if database else f"{prefix}{name}"
        mart.write.mode("overwrite").format("parquet").saveAsTable(target)
