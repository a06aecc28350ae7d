"""Session set-up and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Applied only where the caller or the cluster has not already decided.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def build_session(app: str = "lotmill", master: str | None = None, **conf: str) -> SparkSession:
    """A session with UTC timestamps and adaptive execution.

    Memory, executor counts and shuffle partitions belong to the cluster
    and are left alone; keyword arguments (with ``__`` for ``.``) override.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder every executor can reach, for data that cuts lineage.

    The location is the cluster's ``spark.checkpoint.dir``. Only a local
    session without that setting gets a temporary folder of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        root = spark.conf.get("lotmill.local.scratch", None)
        if not root:
            root = tempfile.mkdtemp(prefix="lotmill-")
            spark.conf.set("lotmill.local.scratch", root)
    path = os.path.join(root, f"{label}-{uuid.uuid4().hex}")
    _made.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


#: Scratch folders of each application, until they are dropped.
_made: dict[str, list[str]] = {}


def drop_scratch(spark: SparkSession) -> int:
    """Delete the scratch folders that this session's application has made; how many there were.

    For the end of a session, or a point where no result that reads them is still wanted:
    queries return lazy tables, so the folders cannot go as soon as a query returns.
    """
    paths = _made.pop(spark.sparkContext.applicationId, [])
    for path in paths:
        drop_folder(spark, path)
    return len(paths)


def _place(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def drop_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder on any file system that Spark reaches; no error if it is not there."""
    place, files = _place(spark, path)
    files.delete(place, True)


def is_written(spark: SparkSession, path: str) -> bool:
    """Has a Spark job finished writing to this folder?"""
    place, files = _place(spark, f"{path}/_SUCCESS")
    return files.exists(place)


def matches(spark: SparkSession, pattern: str) -> bool:
    """Does anything match this path pattern?"""
    place, files = _place(spark, pattern)
    return len(files.globStatus(place) or []) > 0


def bytes_read(spark: SparkSession, *tables: DataFrame) -> int:
    """How large the files are that these tables read; 0 if they read none."""
    total = 0
    for uri in {file for table in tables for file in table.inputFiles()}:
        place = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(uri))
        total += place.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(place).getLen()
    return total


def no_rows(spark: SparkSession, schema: StructType) -> DataFrame:
    """An empty table. One made from a list starts Python processes on the executors to read it."""
    columns = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema]
    return spark.range(1).filter("false").select(*columns)
