"""Price, price-per-area and floor-area rules.

Each digit rule is one ``regexp_replace`` with look-aheads, so it names its
input once. Written as CASE chains the same rules multiply the expression at
every step once a filter is pushed through them.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PRICE_FLOOR = 25000

_TWO_COMMAS = r"(?=[^,]*+,[^,]*+,[^,]*+$)"
_THREE_COMMAS = r"(?=(?:[^,]*+,){3})"
_NINE_DIGITS = r"(?=(?:\D*+\d){9}\D*+$)"
_NINE_DIGITS_UP = r"(?=(?:\D*+\d){9})"
_ENDS_000 = r"(?=.*0\D*+0\D*+0\D*+$)"
_NOT_ENDS_000 = r"(?!.*0\D*+0\D*+0\D*+$)"
_MIDDLE = f"(?s)^{_TWO_COMMAS}{_NINE_DIGITS}{_NOT_ENDS_000}(.*?),000"
_NINE = f"{_TWO_COMMAS}{_NINE_DIGITS}"
_LONG = f"{_THREE_COMMAS}{_NINE_DIGITS_UP}"
_CUT = "(.*).{4}$"

_NUMBER = r"\s*[+]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+]?[0-9]+)?\s*"
_SIGNED = r"\s*[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?\s*"

# House types the digit rules pass by, wholly and in part.
LAND = "Residential Land"
BUNGALOW = "Bungalow"


def asks_contact(price: Column) -> Column:
    """True where the price only asks to make contact; false for null."""
    return F.coalesce(F.lower(price).contains("contact"), F.lit(False))


def strip_price_words(price: Column) -> Column:
    """Remove ``rm `` and ``from `` wherever they stand."""
    return F.replace(F.replace(price, F.lit("rm ")), F.lit("from "))


def shorten_middle_zeros(c: Column) -> Column:
    """Nine digits, two commas, not ending in 000: the first ``,000`` loses two zeros."""
    return F.regexp_replace(c, _MIDDLE, "$1,0")


def cut_trailing_zeros(c: Column) -> Column:
    """Nine digits, two commas, ending in 000: the last four characters go."""
    return F.regexp_replace(c, f"(?s)^{_NINE}{_ENDS_000}{_CUT}", "$1")


def cut_long_trailing_zeros(c: Column) -> Column:
    """Three commas and nine digits or more, ending in 000: the last four characters go."""
    return F.regexp_replace(c, f"(?s)^{_LONG}{_ENDS_000}{_CUT}", "$1")


def _cut_either(c: Column) -> Column:
    # The two cuts ask for two and for three commas, and a text that lost its
    # last comma has fewer still: one pass with either test gives the same.
    return F.regexp_replace(c, f"(?s)^(?:{_NINE}|{_LONG}){_ENDS_000}{_CUT}", "$1")


def _digit_rules(c: Column, house_type: Column) -> Column:
    return (
        F.when(house_type == LAND, c)
        .when(house_type == BUNGALOW, cut_long_trailing_zeros(c))
        .otherwise(_cut_either(shorten_middle_zeros(c)))
    )


def price_text(price: Column, house_type: Column, fix_ranges: bool = False) -> Column:
    """Price text after the digit rules, without commas.

    A range passes through the rules as one text, so a range in millions
    loses digits from its upper bound. ``fix_ranges`` applies the rules to
    each bound instead.
    """
    text = strip_price_words(price)
    if fix_ranges:
        low = _digit_rules(F.trim(F.substring_index(text, "-", 1)), house_type)
        high = _digit_rules(F.trim(F.substring_index(text, "-", -1)), house_type)
        rules = F.when(F.regexp_like(text, F.lit("^[^-]*-[^-]*$")), F.concat_ws("-", low, high))
        text = rules.otherwise(_digit_rules(text, house_type))
    else:
        text = _digit_rules(text, house_type)
    return F.replace(text, F.lit(","))


def price_value(text: Column) -> Column:
    """Mean of an ``a-b`` range, or the number when all digits, else null."""
    low = F.substring_index(text, "-", 1).try_cast("double")
    high = F.substring_index(text, "-", -1).try_cast("double")
    return F.when(text.rlike(f"^{_NUMBER}-{_NUMBER}$"), (low + high) / 2).when(
        text.rlike("^[0-9]+$"), text.try_cast("double")
    )


def bad_range(text: Column) -> Column:
    """True for a hyphenated price that is not two numbers."""
    ill_formed = text.contains("-") & ~text.rlike(f"^{_NUMBER}-{_NUMBER}$")
    return F.coalesce(ill_formed, F.lit(False))


def psf_text_value(psf: Column) -> Column:
    """Price per square foot without currency and commas, still text."""
    return F.replace(F.replace(psf, F.lit("rm ")), F.lit(","))


def psf_value(psf: Column) -> Column:
    """Price per square foot as a number; null when missing or not a number."""
    text = psf_text_value(psf)
    return F.when(text.rlike(f"^{_SIGNED}$"), text.try_cast("double"))


def square_footage(c: Column) -> Column:
    """Floor area; a range gives its lower bound, unreadable text null."""
    lower = F.split_part(F.replace(c, F.lit("from ")), F.lit(" - "), F.lit(1))
    return F.regexp_replace(lower, r"[^0-9.]+", "").try_cast("double")
