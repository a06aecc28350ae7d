"""Content hash of a listing row."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def row_hash(columns: Iterable[str]) -> Column:
    """SHA-256 over the values as text, columns by name, null as empty."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in sorted(columns)]
    return F.sha2(F.concat_ws("|", *parts), 256)
