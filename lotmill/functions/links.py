"""Values read from listing links, page URLs and raw file names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def property_id(link: Column) -> Column:
    """Last path segment of the link, with or without a trailing slash.

    A pattern anchored only at the end would be tried from every position.
    """
    slash = F.endswith(link, F.lit("/")).cast("int")
    return F.substring_index(F.left(link, F.length(link) - slash), "/", -1)


def area_slug(link: Column) -> Column:
    """Path segment after ``/property/``; empty when there is none."""
    return F.regexp_extract(link, r"/property/([^/]+)/", 1)


def source_name(url: Column) -> Column:
    """Second dot-part of the URL host; null when the host has no such part."""
    host = F.split_part(url, F.lit("/"), F.lit(3))
    return F.nullif(F.split_part(host, F.lit("."), F.lit(2)), F.lit(""))


# Raw file: batch, script number, region slug, site tag, date, time.
RAW_FILE = r"batch\d+_(\d+)_([^_/]+)_[^_/]+_\d+_\d+\.csv"


def region_slug(file_name: Column) -> Column:
    """Region part of a raw file name or path; null when it does not match."""
    return F.nullif(F.regexp_extract(file_name, RAW_FILE, 2), F.lit(""))


def script_number(file_name: Column) -> Column:
    """Script number part of a raw file name; null when it does not match."""
    return F.nullif(F.regexp_extract(file_name, RAW_FILE, 1), F.lit(""))


def state_name(file_name: Column) -> Column:
    """Region of the raw file as a title-case state name."""
    spaced = F.regexp_replace(region_slug(file_name), r"[-\s]+", " ")
    return F.initcap(F.trim(spaced))
