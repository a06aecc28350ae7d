"""Quality gate in front of the current table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotmill.operators.clean import evaluate_once, settled
from lotmill.schemas import CLEAN_TYPES, max_lengths


def violation(types: dict[str, str] = CLEAN_TYPES) -> Column:
    """First broken rule of a row as text, or null: ``null:col`` or ``length:col``."""
    nulls = [F.when(F.col(c).isNull(), f"null:{c}") for c in types]
    lengths = [
        F.when(F.length(c) > n, f"length:{c}") for c, n in max_lengths(types).items()
    ]
    return F.coalesce(*nulls, *lengths)


def passing(df: DataFrame, types: dict[str, str] = CLEAN_TYPES) -> DataFrame:
    """Rows with every column present and within its declared length.

    The rules look at most columns, so rows that come straight out of
    cleaning are settled first; otherwise they would be cleaned twice.
    """
    rules = [F.col(c).isNotNull() for c in types]
    rules += [F.length(c) <= n for c, n in max_lengths(types).items()]
    df = settled(df)
    for rule in rules:
        df = df.filter(rule)
    return df


def rejected(df: DataFrame, types: dict[str, str] = CLEAN_TYPES) -> DataFrame:
    """Rows the gate turns back, with the rule they break."""
    return evaluate_once(df, violation=violation(types)).filter(F.col("violation").isNotNull())
