"""Values read from the texts of a listing card."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lotmill.functions.text import SPACE, strip

_TOKENS = rf"(?U)^[{SPACE}]*\(*([^{SPACE}]*)[{SPACE}]+([^{SPACE}]+)"


def _present(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def psf_text(c: Column) -> Column:
    """First two words, the first without opening brackets; null if fewer."""
    return F.when(
        c.rlike(_TOKENS),
        F.concat_ws(" ", F.regexp_extract(c, _TOKENS, 1), F.regexp_extract(c, _TOKENS, 2)),
    )


def house_type(attrs: Column) -> Column:
    """Attribute text up to the first bar or bullet."""
    return _present(strip(F.regexp_extract(attrs, r"^([^|•]*)", 1)))


def lot_type(attrs: Column) -> Column:
    """Attribute text between the first bar and the next bullet."""
    return _present(strip(F.regexp_extract(attrs, r"\|([^•]+)", 1)))


def floor_area(attrs: Column) -> Column:
    """Built-up or land area before ``sq. ft.``, without commas."""
    pattern = rf"(?iU)(?:Built-up|Land[{SPACE}]*area)[{SPACE}]*:[{SPACE}]*(.*?)[{SPACE}]*sq\. ft\."
    return _present(F.replace(F.regexp_extract(attrs, pattern, 1), F.lit(",")))


def furniture(attrs: Column) -> Column:
    """Part after the last bullet when the text speaks of furnishing."""
    return F.when(
        F.lower(attrs).contains("furnished"), strip(F.substring_index(attrs, "•", -1))
    )
