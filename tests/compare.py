"""Compare a registered query with its SQL on the same tables."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def _value(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else v
    return v


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_value(row[i]) for i in order) for row in rows)


def compare(df, con, sql: str) -> str | None:
    """None when names, types and rows agree, else what differs."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    duck_types = {d[0]: str(d[1]).lower() for d in result.description}
    expected = _rows(names, result.fetchall())
    table = df.toArrow().to_pydict()
    got = _rows(df.columns, list(zip(*(table[c] for c in df.columns))) if df.columns else [])
    spark_types = {"string": "varchar", "timestamp_ntz": "timestamp", "int": "integer"}
    for name, t in df.dtypes:
        if spark_types.get(t, t) != duck_types[name]:
            return f"type of {name}: {t} != {duck_types[name]}"
    if got != expected:
        extra, missing = got - expected, expected - got
        return (
            f"{sum(got.values())} rows, expected {sum(expected.values())}; "
            f"extra {list(extra)[:2]}; missing {list(missing)[:2]}"
        )
    return None
