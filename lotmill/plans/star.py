"""Dimensions and the sales fact."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotmill.functions.dates import calendar_parts
from lotmill.operators.surrogate import extend_names, number_names
from lotmill.session import is_written

# Labels of the price range dimension, in id order.
PRICE_RANGES = ["0-500k", "500k-1M", "1M-1.5M", "1.5M+"]

DIMENSIONS = [
    "dim_state",
    "dim_area",
    "dim_property_type",
    "dim_agent",
    "dim_date",
    "dim_price_range",
    "dim_lot_type",
]


def _names(current: DataFrame, column: str, name: str) -> DataFrame:
    return (
        current.filter(F.col(column).isNotNull()).select(F.col(column).alias(name)).distinct()
    )


def _numbered(names: DataFrame, name: str, id_column: str, stored: DataFrame | None) -> DataFrame:
    """All names with ids: fresh ones, or with a stored map of earlier ids only those it lacks, numbered after its highest."""
    return number_names(names, name, id_column) if stored is None else extend_names(stored, names, name, id_column)


def dim_state(current: DataFrame, stored: DataFrame | None = None) -> DataFrame:
    return _numbered(_names(current, "state", "state_name"), "state_name", "state_id", stored)


def dim_property_type(current: DataFrame, stored: DataFrame | None = None) -> DataFrame:
    names = _names(current, "house_type", "property_type_name")
    return _numbered(names, "property_type_name", "property_type_id", stored)


def dim_agent(current: DataFrame, stored: DataFrame | None = None) -> DataFrame:
    return _numbered(_names(current, "agent_name", "agent_name"), "agent_name", "agent_id", stored)


def dim_lot_type(current: DataFrame, stored: DataFrame | None = None) -> DataFrame:
    return _numbered(_names(current, "lot_type", "lot_type_name"), "lot_type_name", "lot_type_id", stored)


def dim_area(current: DataFrame, states: DataFrame, stored: DataFrame | None = None) -> DataFrame:
    """Each area once, under the first of its states by name.

    Distinct pairs come first: a distinct hashes, whereas a text minimum over
    all listings would have to sort them.
    """
    pairs = (
        current.filter(F.col("area").isNotNull())
        .select(F.col("area").alias("area_name"), F.col("state").alias("state_name"))
        .distinct()
    )
    areas = pairs.join(states, "state_name").groupBy("area_name").agg(
        F.min(F.struct("state_name", "state_id")).alias("first")
    )
    chosen = areas.select("area_name", F.col("first.state_id").alias("state_id"))
    return _numbered(chosen, "area_name", "area_id", stored)


def dim_date(current: DataFrame, stored: DataFrame | None = None) -> DataFrame:
    """Posting dates with calendar parts, which follow from the date alone."""
    days = (
        current.filter(F.col("posted_date").isNotNull())
        .select(F.to_date("posted_date").alias("date"))
        .distinct()
    )
    numbered = _numbered(days, "date", "date_id", stored)
    return numbered.select("*", *[c.alias(n) for n, c in calendar_parts(F.col("date")).items()])


def dim_price_range(spark: SparkSession) -> DataFrame:
    rows = [(i, label) for i, label in enumerate(PRICE_RANGES, 1)]
    return spark.createDataFrame(rows, "price_range_id bigint, range_label string")


def fact_property_sales(
    current: DataFrame,
    states: DataFrame,
    areas: DataFrame,
    property_types: DataFrame,
    agents: DataFrame,
) -> DataFrame:
    """Listings with the ids of their state, area, type and agent.

    Hand in dimensions read back from files: Spark then knows their size,
    broadcasts those below its threshold and joins a larger one (agents, at
    scale) by shuffle, where adaptive execution splits a hot name.
    """
    listings = current.select(
        "property_id", "state", "area", "house_type", "agent_name", "posted_date", "house_price"
    )
    return (
        listings.join(states, F.col("state") == F.col("state_name"))
        .join(areas.select("area_id", "area_name"), F.col("area") == F.col("area_name"))
        .join(property_types, F.col("house_type") == F.col("property_type_name"))
        .join(agents, "agent_name")
        .select(
            "property_id",
            "state_id",
            "area_id",
            "property_type_id",
            "agent_id",
            F.to_date("posted_date").alias("sale_date"),
            F.col("house_price").alias("sale_price"),
        )
    )


def with_sale_ids(fact: DataFrame) -> DataFrame:
    """The fact with unique sale ids; like a serial, they may have gaps.

    Numbering by position costs no shuffle, and the ids are settled by the
    write that follows.
    """
    return fact.select((F.monotonically_increasing_id() + 1).alias("sale_id"), "*")


@dataclass
class Star:
    """Dimension and fact tables, read back from where they were written."""

    dims: dict[str, DataFrame]
    fact: DataFrame


def write_dimensions(
    spark: SparkSession, current: DataFrame, folder: str, wanted: list[str] | None = None
) -> dict[str, DataFrame]:
    """Build, write and read back the dimensions, in dependency order.

    A dimension only grows: where one is stored, names it holds keep their ids (an area also its state), and new names are
    appended after the highest id. Names that no listing has any more stay. Ids follow content, so a run that
    failed after an append adds nothing when it is repeated.
    """
    build = {
        "dim_state": lambda done, old: dim_state(current, old),
        "dim_area": lambda done, old: dim_area(current, done["dim_state"], old),
        "dim_property_type": lambda done, old: dim_property_type(current, old),
        "dim_agent": lambda done, old: dim_agent(current, old),
        "dim_date": lambda done, old: dim_date(current, old),
        "dim_price_range": lambda done, old: dim_price_range(spark),
        "dim_lot_type": lambda done, old: dim_lot_type(current, old),
    }
    done: dict[str, DataFrame] = {}
    for name in wanted or DIMENSIONS:
        path = f"{folder}/{name}"
        old = spark.read.parquet(path) if name != "dim_price_range" and is_written(spark, path) else None
        built = build[name](done, old)
        built.write.mode("overwrite" if old is None else "append").parquet(path)
        done[name] = spark.read.schema(built.schema).parquet(path)
    return done


FACT_DIMENSIONS = ["dim_state", "dim_area", "dim_property_type", "dim_agent"]


def sales_fact(current: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    return fact_property_sales(current, *[dims[d] for d in FACT_DIMENSIONS])


def write_star(spark: SparkSession, current: DataFrame, folder: str) -> Star:
    """Dimensions with what is new to them, and the fact, which is replaced on every run."""
    dims = write_dimensions(spark, current, folder)
    fact = sales_fact(current, dims)
    path = f"{folder}/fact_property_sales"
    with_sale_ids(fact).write.mode("overwrite").parquet(path)
    return Star(dims, spark.read.parquet(path))
