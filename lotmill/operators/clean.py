"""Raw text listings to clean typed listings."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotmill.functions import dates, links, prices, text
from lotmill.schemas import CLEAN_COLUMNS, RAW_COLUMNS


# Raw columns whose words are capitalised, besides the area.
WORDED = ["agent_name", "house_name", "house_location", "house_type", "lot_type", "house_furniture"]


def evaluate_once(df: DataFrame, **values: Column) -> DataFrame:
    """Add costly columns that later filters cannot pull back into the scan.

    A filter on a projected column is pushed below the projection with the
    expression copied into it, so the regex work would run twice per row. A
    one-element ``inline`` stays in the same codegen stage and is a boundary
    that filters on the generated columns do not cross.
    """
    one = F.struct(*[c.alias(n) for n, c in values.items()])
    return df.select("*", F.inline(F.array(one)))


def settled(df: DataFrame) -> DataFrame:
    """The same rows, with every column evaluated before any later filter."""
    return df.select(F.inline(F.array(F.struct(*df.columns))))


def with_missing_as_null(df: DataFrame) -> DataFrame:
    """Missing-value tokens in every raw column become null."""
    return df.withColumns({c: text.missing_to_null(F.col(c)) for c in RAW_COLUMNS})


def normalize_raw(df: DataFrame) -> DataFrame:
    """Strip and lower-case every raw column."""
    return df.withColumns({c: text.normalize(F.col(c)) for c in RAW_COLUMNS})


def has_link(df: DataFrame) -> DataFrame:
    """Rows with a page link."""
    return df.filter(F.col("Page_Link") != "")


def without_contact_prices(df: DataFrame) -> DataFrame:
    """Rows whose price does not ask to make contact; null prices stay."""
    return df.filter(~prices.asks_contact(F.col("House_Price")))


def judged_listings(
    df: DataFrame, as_of: datetime, fix_ranges: bool = False, strict_nan: bool = False
) -> DataFrame:
    """Clean listings and unreadable rows together, in one pass.

    ``df`` holds the raw text columns, ``file_name`` and, if it comes from files, ``raw_line``, the text of
    records whose cells do not fit their header. Rows without a link,
    with a contact price or below the price floor are left out; unreadable
    rows carry a ``reject_reason``, which is ``cells`` for those records.
    """
    lines = "raw_line" in df.columns
    broken = F.col("raw_line").isNotNull() if lines else F.lit(False)
    wanted = (F.col("Page_Link") != "") & ~prices.asks_contact(F.col("House_Price"))
    kept = df.filter(broken | wanted) if lines else without_contact_prices(has_link(df))
    priced = evaluate_once(
        kept,
        _price_text=prices.price_text(F.col("House_Price"), F.col("House_Type"), fix_ranges),
    )
    priced = evaluate_once(
        priced,
        _price=prices.price_value(F.col("_price_text")),
        _bad_range=prices.bad_range(F.col("_price_text")),
        _psf=prices.psf_value(F.col("Price_Square_Feet")),
        _state=links.state_name(F.col("file_name")),
    )
    price, bad_range, psf, state = (F.col(c) for c in ("_price", "_bad_range", "_psf", "_state"))
    priced = priced.filter((price >= prices.PRICE_FLOOR) | bad_range | broken)

    raw = {c.lower(): F.col(c) for c in RAW_COLUMNS}
    # One array expression for all worded columns keeps the generated method
    # of this stage small enough for the JVM to compile it.
    worded = {c: raw[c] for c in WORDED} | {"area": links.area_slug(raw["page_link"])}

    def label(c: Column) -> Column:
        return text.blank_nan(c, strict_nan)

    capitalized = F.transform(F.array(*worded.values()), text.capitalize_words)
    priced = priced.withColumn("_words", F.transform(capitalized, label))

    def words(name: str) -> Column:
        return F.col("_words")[list(worded).index(name)]

    def amount(c: Column) -> Column:
        return F.coalesce(c, F.lit(0.0)).try_cast("decimal(20,2)")

    values = {
        "property_id": label(links.property_id(raw["page_link"])),
        "page_link": label(raw["page_link"]),
        "source": label(raw["source"]),
        "agent_name": words("agent_name"),
        "state": label(state),
        "area": words("area"),
        "house_price": amount(price),
        "price_square_feet": amount(psf),
        "house_name": words("house_name"),
        "house_location": words("house_location"),
        "house_type": text.expand_house_type(words("house_type")),
        "lot_type": words("lot_type"),
        "square_footage": amount(prices.square_footage(raw["square_footage"])),
        "house_furniture": words("house_furniture"),
        "posted_date": dates.posted_date(raw["posted_date"], as_of),
        "created_at": raw["created_at"].try_cast("timestamp_ntz"),
    }
    reason = (
        F.when(broken, "cells")
        .when(bad_range, "price_range")
        .when(state.isNull(), "file_name")
        .when(raw["price_square_feet"].isNotNull() & psf.isNull(), "price_square_feet")
    )
    return priced.select(
        *[values[c].alias(c) for c in CLEAN_COLUMNS], "file_name", *["raw_line"] * lines, reason.alias("reject_reason")
    )


def clean_listings(
    df: DataFrame, as_of: datetime, fix_ranges: bool = False, strict_nan: bool = False
) -> DataFrame:
    """Readable clean listings in their fixed column order, plus the raw file name."""
    judged = judged_listings(df, as_of, fix_ranges, strict_nan)
    return judged.filter(F.col("reject_reason").isNull()).drop("reject_reason")


def quarantine(df: DataFrame, as_of: datetime, fix_ranges: bool = False) -> DataFrame:
    """Rows that could not be read, with the reason, out of the same rules."""
    return judged_listings(df, as_of, fix_ranges).filter(F.col("reject_reason").isNotNull())
