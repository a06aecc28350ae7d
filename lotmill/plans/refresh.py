"""One run from raw files to marts."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from lotmill.plans.load import LoadOptions, current_table
from lotmill.plans.partials import read_marts
from lotmill.plans.star import write_star
from lotmill.sources.tables import save_snapshots
from lotmill.streaming.ingest import start_ingest


def refresh(
    spark: SparkSession,
    raw_folder: str,
    root: str,
    as_of: datetime,
    options: LoadOptions = LoadOptions(),
) -> dict[str, DataFrame]:
    """Load the files that are new, extend dimensions, rewrite the fact and bring the marts up to date; returns the written marts.

    Files are loaded as by the stream, each once. Names keep their ids from run to run. Marts come from the partials
    that the loads have left, so no mart reads the current table. Every stage reads what
    the stage before it wrote, so a lost executor costs one stage's tasks and no table is
    computed twice. If nothing was ever loaded this is an error; rejects are kept all the same.
    """
    start_ingest(spark, raw_folder, root, f"{root}/ingested", as_of, options=options).awaitTermination()
    table = current_table(spark, root, options)
    if not table.exists():
        raise RuntimeError("no rows were loaded")
    star = write_star(spark, table.read(), f"{root}/star")
    marts = read_marts(spark, f"{root}/mart_partials", star.dims["dim_agent"])
    save_snapshots(marts, f"{root}/marts")
    return {name: spark.read.parquet(f"{root}/marts/mv_{name}") for name in marts}
