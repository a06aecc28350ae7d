"""Text rules shared by several listing fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Cell texts a CSV read treats as missing (exact match).
MISSING_TOKENS = [
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
]

# Unicode whitespace, no-break spaces included: as characters for trimming, and
# as the inside of a pattern class. Under (?U) the JVM matches \s faster than the
# same characters listed one by one.
SPACES = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0"
    "\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
SPACE = r"\s\x1c-\x1f"


def missing_to_null(c: Column) -> Column:
    """Missing-value tokens become null."""
    return F.when(c.isin(MISSING_TOKENS), None).otherwise(c)


def strip(c: Column) -> Column:
    """Trim every kind of whitespace from both ends."""
    return F.trim(c, F.lit(SPACES))


def normalize(c: Column) -> Column:
    """Strip and lower-case, as raw files store every cell."""
    return F.lower(strip(c))


def capitalize_words(c: Column) -> Column:
    """Runs of whitespace and hyphens become one blank; each word capitalised.

    Blanks are settled first because ``initcap`` only splits on them.
    """
    return F.initcap(F.trim(F.regexp_replace(c, f"(?U)[{SPACE}-]+", " ")))


def expand_house_type(c: Column) -> Column:
    """Whole-word house-type synonyms, case-sensitive."""
    for word, full in (("Homes", "House"), ("Sty", "Storey"), ("link", "Link")):
        c = F.regexp_replace(c, rf"\b{word}\b", full)
    return c


def blank_nan(c: Column, strict: bool = False) -> Column:
    """Null and text starting with ``nan`` become empty.

    The prefix test also blanks real names such as ``Nancy Lim``; with
    ``strict`` only the exact word ``nan`` is blanked.
    """
    head = c if strict else F.left(c, F.lit(3))
    return F.when(F.lower(head) == "nan", "").otherwise(F.coalesce(c, F.lit("")))
