"""Table schemas: raw text listings, clean listings and the current table."""

from __future__ import annotations

import re

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Raw listing columns, in file order; all text.
RAW_COLUMNS = [
    "Page_Link",
    "Source",
    "Agent_Name",
    "Posted_Date",
    "House_Price",
    "Price_Square_Feet",
    "House_Name",
    "House_Location",
    "House_Type",
    "Lot_Type",
    "Square_Footage",
    "House_Furniture",
    "Created_At",
]

# Clean listing columns and their declared SQL types, in order.
CLEAN_TYPES = {
    "property_id": "VARCHAR(50)",
    "page_link": "TEXT",
    "source": "VARCHAR(9)",
    "agent_name": "VARCHAR(100)",
    "state": "VARCHAR(100)",
    "area": "VARCHAR(100)",
    "house_price": "DECIMAL(20,2)",
    "price_square_feet": "DECIMAL(20,2)",
    "house_name": "TEXT",
    "house_location": "TEXT",
    "house_type": "TEXT",
    "lot_type": "TEXT",
    "square_footage": "DECIMAL(20,2)",
    "house_furniture": "TEXT",
    "posted_date": "TIMESTAMP",
    "created_at": "TIMESTAMP",
}

# Versioning columns every stored listing table carries.
VERSION_TYPES = {
    "valid_from": "TIMESTAMP",
    "valid_to": "TIMESTAMP",
    "is_current": "BOOLEAN",
    "row_hash": "VARCHAR(64)",
}

CURRENT_TYPES = {**CLEAN_TYPES, **VERSION_TYPES}
CLEAN_COLUMNS = list(CLEAN_TYPES)
CURRENT_COLUMNS = list(CURRENT_TYPES)

_TYPE = re.compile(r"\s*([A-Za-z]+)\s*(?:\(\s*([0-9, ]+|MAX)\s*\))?\s*", re.I)


def _spark_type(sql_type: str, keep_length: bool) -> str:
    match = _TYPE.fullmatch(sql_type)
    if not match:
        raise ValueError(f"cannot read SQL type {sql_type!r}")
    name, args = match[1].upper(), match[2]
    if name in ("VARCHAR", "NVARCHAR", "CHAR"):
        bounded = args is not None and args.upper() != "MAX"
        return f"VARCHAR({args})" if keep_length and bounded else "STRING"
    if name in ("DECIMAL", "NUMERIC"):
        return f"DECIMAL({args})" if args else "DOUBLE"
    plain = {
        "TEXT": "STRING",
        "TIMESTAMP": "TIMESTAMP_NTZ",
        "DATETIME": "TIMESTAMP_NTZ",
        "DATE": "DATE",
        "BOOLEAN": "BOOLEAN",
        "INT": "INT",
        "INTEGER": "INT",
        "SERIAL": "BIGINT",
        "DOUBLE": "DOUBLE",
    }
    if name not in plain:
        raise ValueError(f"no Spark type for {sql_type!r}")
    return plain[name]


def _columns(types: dict[str, str], keep_length: bool) -> list[tuple[str, str]]:
    return [(c.strip("[]"), _spark_type(t, keep_length)) for c, t in types.items()]


def _data_type(name: str) -> T.DataType:
    if match := re.fullmatch(r"DECIMAL\((\d+)\s*,\s*(\d+)\)", name):
        return T.DecimalType(int(match[1]), int(match[2]))
    return {
        "STRING": T.StringType(),
        "TIMESTAMP_NTZ": T.TimestampNTZType(),
        "DATE": T.DateType(),
        "BOOLEAN": T.BooleanType(),
        "INT": T.IntegerType(),
        "BIGINT": T.LongType(),
        "DOUBLE": T.DoubleType(),
    }[name]


def struct_from_types(types: dict[str, str]) -> T.StructType:
    """``{column: sql type}`` (as kept in a JSON schema file) to a StructType."""
    return T.StructType([T.StructField(c, _data_type(t)) for c, t in _columns(types, False)])


def typed_columns(types: dict[str, str]) -> list[Column]:
    """Cast text columns to their declared types; bad values become null."""
    return [F.col(c).try_cast(t).alias(c) for c, t in _columns(types, False)]


def max_lengths(types: dict[str, str]) -> dict[str, int]:
    """Declared length limits of the bounded text columns."""
    found = ((c, re.fullmatch(r"VARCHAR\((\d+)\)", t)) for c, t in _columns(types, True))
    return {c: int(m[1]) for c, m in found if m}


def create_table(
    spark: SparkSession,
    name: str,
    types: dict[str, str],
    not_null: bool = False,
    key: str | None = None,
    buckets: int = 0,
    path: str | None = None,
) -> None:
    """Create an empty parquet table from a schema dict plus versioning columns, over a folder if one is given.

    Text limits become VARCHAR(n) and ``not_null`` holds for the declared columns; Spark enforces both on
    insert. Bucketing on the key lets later merges read the table without shuffling it.
    """
    nullable = set(VERSION_TYPES)
    body = ", ".join(
        f"`{c}` {t}" + (" NOT NULL" if not_null and c not in nullable else "")
        for c, t in _columns({**types, **VERSION_TYPES}, True)
    )
    cluster = f" CLUSTERED BY ({key}) INTO {buckets} BUCKETS" if key and buckets else ""
    place = " LOCATION '" + path.replace("\\", "\\\\").replace("'", "\\'") + "'" if path else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({body}) USING parquet{cluster}{place}")


RAW_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in RAW_COLUMNS])
CLEAN_SCHEMA = struct_from_types(CLEAN_TYPES)
CURRENT_SCHEMA = struct_from_types(CURRENT_TYPES)
