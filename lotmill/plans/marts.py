"""Summary marts over the current table and the fact."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def mean(value: str, count: Column | None = None) -> Column:
    """Null-skipping mean: the exact decimal sum, divided once as doubles."""
    return F.sum(value).cast("double") / (F.count(value) if count is None else count)


def month_of(moment: Column) -> Column:
    return F.trunc(moment.cast("date"), "month")


def _average_and_count(df: DataFrame, key: Column, name: str, average: str) -> DataFrame:
    # One pass gives both measures; averaging and counting apart and joining
    # on the key again reads the table twice for the same rows.
    return df.groupBy(key.alias(name)).agg(
        mean("house_price").alias(average), F.count("property_id").alias("count")
    )


def time_series_prices(current: DataFrame) -> DataFrame:
    """Mean price and listings per posting month."""
    return _average_and_count(
        current, month_of(F.col("posted_date")), "period", "average_house_price"
    )


def avg_price_by_state(current: DataFrame) -> DataFrame:
    return _average_and_count(current, F.col("state"), "state", "average_price")


def price_trends_by_type(current: DataFrame) -> DataFrame:
    return _average_and_count(current, F.col("house_type"), "property_type", "average_price")


def _count_by(df: DataFrame, key: Column, name: str) -> DataFrame:
    return df.groupBy(key.alias(name)).agg(F.count("*").alias("count"))


def property_type_distribution(current: DataFrame) -> DataFrame:
    return _count_by(current, F.col("house_type"), "property_type")


def furniture_status(current: DataFrame) -> DataFrame:
    return _count_by(current, F.col("house_furniture"), "furniture_status")


def posting_dates(current: DataFrame) -> DataFrame:
    return _count_by(current, F.to_date("posted_date"), "posting_date")


def detailed_sales_summary(current: DataFrame) -> DataFrame:
    """Mean price and listings by posting time, type, state, agent and area.

    The four dimensions hold exactly the non-null names of this table, each
    once, so joining them back in only drops rows with a null name. The joins
    are therefore left out and the filter is kept.
    """
    keys = ["house_type", "state", "agent_name", "area"]
    known = current.filter(" and ".join(f"{k} is not null" for k in keys))
    grouped = known.groupBy("posted_date", *keys).agg(
        mean("house_price").alias("average_price"), F.count("property_id").alias("total_sales")
    )
    return grouped.select(
        F.to_date("posted_date").alias("posted_date"),
        F.col("house_type").alias("property_type"),
        "state",
        "agent_name",
        "area",
        "average_price",
        "total_sales",
    )


def agent_summary(fact: DataFrame, agents: DataFrame) -> DataFrame:
    """Sum, mean and count of sales per agent.

    Sales are summed by agent id before the name is joined in, so the join
    sees one row per agent, however many sales an agent holds.
    """
    sums = fact.groupBy("agent_id").agg(
        F.sum("sale_price").alias("total_sales"),
        mean("sale_price").alias("average_sale_price"),
        F.count("property_id").alias("properties_listed"),
    )
    return sums.join(agents, "agent_id").select(
        "agent_id", "agent_name", "total_sales", "average_sale_price", "properties_listed"
    )


def averages_full_outer(df: DataFrame, key: str, value: str, counted: str) -> DataFrame:
    """Averages and counts per key, taken apart and joined on the key.

    The form with separate tables keeps a null key as two unmatched rows,
    one with the average and one with the count.
    """
    averages = df.groupBy(key).agg(mean(value).alias("average"))
    counts = df.groupBy(F.col(key).alias("count_key")).agg(F.count(counted).alias("count"))
    joined = averages.join(counts, F.col(key) == F.col("count_key"), "full_outer")
    return joined.select(key, "average", "count")


def all_marts(current: DataFrame, fact: DataFrame, agents: DataFrame) -> dict[str, DataFrame]:
    """The eight summary tables by name.

    Each reads two or three columns of the columnar current table, which is
    less than one pass that expands every row once per grouping.
    """
    return {
        "time_series_prices": time_series_prices(current),
        "furniture_status": furniture_status(current),
        "avg_price_by_state": avg_price_by_state(current),
        "price_trends_by_type": price_trends_by_type(current),
        "property_type_distribution": property_type_distribution(current),
        "posting_dates": posting_dates(current),
        "detailed_sales_summary": detailed_sales_summary(current),
        "agent_summary": agent_summary(fact, agents),
    }
