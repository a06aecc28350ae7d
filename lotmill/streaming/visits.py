"""Web pages to listing cards as a stream: every page URL is read once, over all runs."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lotmill.operators.cards import extract_listings, without_challenges

PAGES = "page_id long, url string, html string"
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def start_visits(
    spark: SparkSession,
    folder: str,
    root: str,
    checkpoint: str,
    as_of: datetime,
    files_per_batch: int | None = None,
) -> StreamingQuery:
    """Take in the page files that are new since the last run, then stop.

    The URLs seen are state of the query, kept by RocksDB in the checkpoint: a URL counts at its first visit without a
    challenge, in whatever run. Which of several visits in one batch of files that is, is left to Spark. A page without a
    URL is a page of its own. Only keys go through the shuffle and into the state; page bodies are read
    again from the files of the batch and joined to the visits. Each batch has its own folder under ``visits`` and ``cards``, so a
    repeated batch replaces its own.
    """
    spark.conf.set(STATE_STORE, ROCKS)
    reader = spark.readStream.schema(PAGES).option("recursiveFileLookup", "true")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    pages = without_challenges(reader.parquet(folder).select("*", F.col("_metadata.file_path").alias("file_path")))
    # A blank cannot stand in a URL, so no URL is taken for a page's number.
    key = F.coalesce(F.col("url"), F.concat(F.lit("page "), F.col("page_id").cast("string")))
    visits = pages.select(key.alias("visit_key"), "url", "page_id", "file_path").dropDuplicates(["visit_key"])

    def load(found: DataFrame, batch: int) -> None:
        found.drop("visit_key").write.mode("overwrite").parquet(f"{root}/visits/batch={batch}")
        new = spark.read.parquet(f"{root}/visits/batch={batch}")
        # At most the files of one batch.
        paths = [r["file_path"] for r in new.select("file_path").distinct().collect()]
        if paths:
            bodies = spark.read.schema(PAGES).parquet(*paths)
            same = (bodies["page_id"] == new["page_id"]) & bodies["url"].eqNullSafe(new["url"])
            cards = extract_listings(bodies.join(new, same, "left_semi"), as_of)
            cards.write.mode("overwrite").parquet(f"{root}/cards/batch={batch}")

    return visits.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
