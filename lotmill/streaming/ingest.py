"""New raw files to the stored tables, each file once."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from lotmill.plans.load import LoadOptions, load_batch
from lotmill.sources.files import file_headers, stream_headers


def start_ingest(
    spark: SparkSession,
    raw_folder: str,
    root: str,
    checkpoint: str,
    as_of: datetime,
    files_per_batch: int | None = None,
    options: LoadOptions = LoadOptions(),
) -> StreamingQuery:
    """Process all files that are new since the last run, then stop.

    The stream finds the files and their headers; each batch of files then goes through
    :func:`load_batch` under the stream's identity and its own number, so a batch that is
    repeated after a failure is not merged twice, and other writers of the same tables do no harm.
    """

    def load(lines: DataFrame, batch_id: int) -> None:
        headers = file_headers(lines).collect()
        if headers:
            stream = spark.read.json(f"{checkpoint}/metadata").first()["id"]
            load_batch(spark, headers, root, as_of, stream, batch_id, options)

    return (
        stream_headers(spark, raw_folder, files_per_batch)
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
