"""Small frames and plan texts for the tests."""

from __future__ import annotations

from datetime import datetime
from decimal import Decimal

from pyspark.sql import DataFrame

from lotmill.schemas import CLEAN_SCHEMA, RAW_COLUMNS

NOON = datetime(2024, 1, 31, 12)


def values(spark, texts, rule, types="string"):
    """Apply a column rule to one text column, keeping the order."""
    rows = [(i, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, f"i int, c {types}")
    out = df.select("i", rule(df["c"]).alias("v")).orderBy("i").collect()
    return [r["v"] for r in out]


def raw_rows(spark, rows: list[dict], file_name="batch1_01_kuala-lumpur_listings_20240131_120000.csv"):
    """Raw listings; columns left out are null."""
    base = {
        "Page_Link": "https://www.x.com/property/kl-city/sale-1/",
        "Source": "x",
        "House_Price": "rm 450,000",
        "House_Type": "condominium",
        "Posted_Date": "posted yesterday",
        "Created_At": "2024-01-31 12:00:00",
    }
    filled = [{**base, **r} for r in rows]
    schema = ", ".join(f"{c} string" for c in [*RAW_COLUMNS, "file_name"])
    data = [tuple(r.get(c) for c in RAW_COLUMNS) + (r.get("file_name", file_name),) for r in filled]
    return spark.createDataFrame(data, schema)


def listing(key: str, price=100000, day=1, created=1, **other) -> dict:
    row = {
        "property_id": key,
        "page_link": f"https://www.x.com/{key}",
        "source": "x",
        "agent_name": "Agent",
        "state": "Johor",
        "area": "Skudai",
        "house_price": Decimal(price).quantize(Decimal("0.01")),
        "price_square_feet": Decimal("1.00"),
        "house_name": "Name",
        "house_location": "Place",
        "house_type": "House",
        "lot_type": "Corner",
        "square_footage": Decimal("900.00"),
        "house_furniture": "Unfurnished",
        "posted_date": datetime(2024, 1, day),
        "created_at": datetime(2024, 2, created),
    }
    return {**row, **other}


def clean_rows(spark, rows: list[dict]) -> DataFrame:
    data = [tuple(r[c] for c in CLEAN_SCHEMA.names) for r in rows]
    return spark.createDataFrame(data, CLEAN_SCHEMA)


def physical_plan(df: DataFrame) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
