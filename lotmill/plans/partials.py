"""Marts kept up by each batch: sums and counts of what a merge changes, added up when a mart is read.

The before image of a changed row is taken off and its after image added, so a row that moves from one group to
another, or changes its price, is right in both. No stored row is read for it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lotmill.plans.marts import month_of
from lotmill.schemas import CURRENT_COLUMNS

# Type of every column that some mart groups by.
KEYS = {
    "period": "date",
    "posting_date": "date",
    "posted_at": "timestamp_ntz",
    "state": "string",
    "property_type": "string",
    "furniture_status": "string",
    "agent_name": "string",
    "area": "string",
}
GROUPS = {
    "time_series_prices": ["period"],
    "furniture_status": ["furniture_status"],
    "avg_price_by_state": ["state"],
    "price_trends_by_type": ["property_type"],
    "property_type_distribution": ["property_type"],
    "posting_dates": ["posting_date"],
    "detailed_sales_summary": ["posted_at", "property_type", "state", "agent_name", "area"],
    "agent_summary": ["agent_name"],
}
# Marts over rows that have a name in every dimension.
NAMED = ("detailed_sales_summary", "agent_summary")


def signed_rows(images: DataFrame) -> DataFrame:
    """Current rows with ``sign``: -1 as they were, 1 as they are."""
    both = F.array(F.struct(F.lit(-1).alias("sign"), F.col("before").alias("r")), F.struct(F.lit(1).alias("sign"), F.col("after").alias("r")))
    rows = images.filter("action <> 'unchanged'").select(F.inline(both))
    return rows.filter("r IS NOT NULL").select("sign", *[F.col(f"r.{c}").alias(c) for c in CURRENT_COLUMNS])


def _keys() -> dict[str, Column]:
    return {
        "period": month_of(F.col("posted_date")),
        "posting_date": F.to_date("posted_date"),
        "posted_at": F.col("posted_date"),
        "state": F.col("state"),
        "property_type": F.col("house_type"),
        "furniture_status": F.col("house_furniture"),
        "agent_name": F.col("agent_name"),
        "area": F.col("area"),
    }


def partials(signed: DataFrame) -> DataFrame:
    """(mart, keys…, n_rows, n_priced, total) of signed rows, one row for each mart and group that they touch."""
    keyed = signed.select("sign", "house_price", *[c.alias(n) for n, c in _keys().items()])
    out = None
    for mart, group in GROUPS.items():
        rows = keyed
        if mart in NAMED:
            rows = rows.filter(" and ".join(f"{c} is not null" for c in ("property_type", "state", "agent_name", "area")))
        part = rows.groupBy(*group).agg(
            F.sum("sign").cast("long").alias("n_rows"),
            F.sum(F.when(F.col("house_price").isNotNull(), F.col("sign"))).cast("long").alias("n_priced"),
            F.sum(F.when(F.col("sign") > 0, F.col("house_price")).otherwise(-F.col("house_price"))).cast("decimal(38,2)").alias("total"),
        )
        part = part.select(F.lit(mart).alias("mart"), *[(F.col(c) if c in group else F.lit(None).cast(t)).alias(c) for c, t in KEYS.items()], "n_rows", "n_priced", "total")
        out = part if out is None else out.unionByName(part)
    return out


def write_partials(images: DataFrame, folder: str, batch: str) -> None:
    """The partials of one batch, in its own folder, so that a repeated batch replaces its own."""
    partials(signed_rows(images)).write.mode("overwrite").partitionBy("mart").parquet(f"{folder}/batch={batch}")


def start_partials(images: DataFrame, folder: str, batch: str) -> None:
    """Partials of a table that was replaced as a whole, in place of all earlier ones."""
    whole = partials(signed_rows(images)).withColumn("batch", F.lit(batch))
    whole.write.mode("overwrite").partitionBy("batch", "mart").parquet(folder)


def read_marts(spark: SparkSession, folder: str, agents: DataFrame | None = None) -> dict[str, DataFrame]:
    """The eight marts from their partials; groups without rows are gone. ``agents`` (agent_id, agent_name) gives the agent ids."""
    every = spark.read.parquet(folder)
    mean = (F.sum("total").cast("double") / F.when(F.sum("n_priced") != 0, F.sum("n_priced"))).alias("mean")
    out = {}
    for mart, group in GROUPS.items():
        rows = every.filter(F.col("mart") == mart).groupBy(*group).agg(F.sum("n_rows").alias("n"), mean, F.sum("total").alias("total"))
        out[mart] = rows.filter("n <> 0")
    count = F.col("n").alias("count")
    for mart, average in (("time_series_prices", "average_house_price"), ("avg_price_by_state", "average_price"), ("price_trends_by_type", "average_price")):
        out[mart] = out[mart].select(*GROUPS[mart], F.col("mean").alias(average), count)
    for mart in ("furniture_status", "property_type_distribution", "posting_dates"):
        out[mart] = out[mart].select(*GROUPS[mart], count)
    out["detailed_sales_summary"] = out["detailed_sales_summary"].select(
        F.to_date("posted_at").alias("posted_date"), "property_type", "state", "agent_name", "area",
        F.col("mean").alias("average_price"), F.col("n").alias("total_sales"),
    )
    sums = out["agent_summary"].select("agent_name", F.col("total").alias("total_sales"), F.col("mean").alias("average_sale_price"), F.col("n").alias("properties_listed"))
    out["agent_summary"] = sums if agents is None else sums.join(agents, "agent_name").select("agent_id", *sums.columns)
    return out
