"""One batch of raw files into the stored tables; batch runs and streams both load through this."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lotmill.operators.clean import judged_listings
from lotmill.operators.gate import passing, rejected
from lotmill.plans.partials import write_partials
from lotmill.schemas import CLEAN_COLUMNS
from lotmill.session import is_written
from lotmill.sources.files import read_files
from lotmill.sources.tables import CurrentTable, load_raw_table


@dataclass(frozen=True)
class LoadOptions:
    """Choices that every load passes on."""

    fix_ranges: bool = False
    strict_nan: bool = False
    multi_line: bool = True
    only_newer: bool = True
    buckets: int = 32


def current_table(spark: SparkSession, root: str, options: LoadOptions = LoadOptions()) -> CurrentTable:
    return CurrentTable(spark, f"{root}/current_listings", n_buckets=options.buckets)


def stored(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A table of all batches: ``cleaned_listings``, ``rejected_listings``, ``rejected_files`` or ``loads``."""
    return spark.read.option("mergeSchema", "true").parquet(f"{root}/{name}")


def load_batch(
    spark: SparkSession,
    headers: list,
    root: str,
    as_of: datetime,
    writer: str,
    batch: int,
    options: LoadOptions = LoadOptions(),
) -> dict[str, int]:
    """Files to judged rows, rejects, raw table, current table and mart partials; what became of them.

    Judged rows, rejected rows and rejected files are written under the batch's own folder,
    so a repeated batch replaces its own and no run touches another's. Rejected rows carry the reason: unreadable
    (``reject_reason``; for ``cells`` the record stands in ``raw_line``) or turned back by the gate (``violation``). Counts
    are taken by the writes themselves and kept in ``loads``; a batch that stands there is done, and only its counts are returned.
    """
    own = f"writer={writer}/batch={batch}"
    if is_written(spark, f"{root}/loads/{own}"):
        return spark.read.parquet(f"{root}/loads/{own}").first().asDict()
    rows, bad_files = read_files(spark, headers, options.multi_line)
    cleaned, read = f"{root}/cleaned_listings/{own}", Observation()
    judged = judged_listings(rows, as_of, options.fix_ranges, options.strict_nan)
    judged = judged.observe(read, F.count("*").alias("rows"), F.count("reject_reason").alias("unreadable"))
    judged.write.mode("overwrite").parquet(cleaned)
    judged = spark.read.schema(judged.schema).parquet(cleaned)
    staged = judged.filter("reject_reason IS NULL").drop("reject_reason", "raw_line")
    back = Observation()
    turned_back = rejected(staged).withColumnRenamed("violation", "reason").withColumn("raw_line", F.lit(None).cast("string"))
    turned_back = turned_back.observe(back, F.count("*").alias("turned_back"))
    unread = judged.filter("reject_reason IS NOT NULL").withColumnRenamed("reject_reason", "reason")
    columns = [*CLEAN_COLUMNS, "file_name", "raw_line", "reason"]
    rejects = unread.select(*columns).unionByName(turned_back.select(*columns))
    rejects.write.mode("overwrite").parquet(f"{root}/rejected_listings/{own}")
    broken = Observation()
    bad_files.observe(broken, F.count("*").alias("files")).write.mode("overwrite").parquet(f"{root}/rejected_files/{own}")
    load_raw_table(spark, staged, f"{root}/raw_listings", options.buckets)
    current = current_table(spark, root, options)
    merged = current.merge(passing(staged), as_of, options.only_newer, f"{writer}-{batch}")
    write_partials(current.images(f"{writer}-{batch}"), f"{root}/mart_partials", f"{writer}-{batch}")
    counts = {"files": len(headers), "rejected_files": broken.get["files"], **read.get, **back.get, **merged}
    spark.range(1).select(*[F.lit(n).cast("long").alias(c) for c, n in counts.items()]).write.mode("overwrite").parquet(f"{root}/loads/{own}")
    return counts
