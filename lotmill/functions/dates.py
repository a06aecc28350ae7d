"""Posting dates: relative and absolute forms."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

_CLOCK = r"(\d{2}:\d{2} [ap]m)"


def posted_date(c: Column, as_of: datetime) -> Column:
    """Posting time as a zone-free timestamp; null when unreadable.

    ``today`` needs a clock time, ``yesterday`` defaults to midnight, and
    absolute dates may or may not have a time. All three forms are brought to
    one text, whose ending tells which of two formats to parse: trying one
    format after the other would throw an exception for every failing row.
    """
    def day(moment: datetime) -> Column:
        return F.lit(f"{moment.day} {moment:%b %Y} ")

    clock = F.nullif(F.regexp_extract(c, _CLOCK, 1), F.lit(""))
    text = (
        F.when(c.contains("today"), F.concat(day(as_of), clock))
        .when(
            c.contains("yesterday"),
            F.concat(day(as_of - timedelta(days=1)), F.coalesce(clock, F.lit("12:00 am"))),
        )
        .otherwise(F.trim(F.replace(c, F.lit("posted on "))))
    )
    return _zone_free(text)


def _zone_free(text: Column) -> Column:
    """``d MMM yyyy`` with or without ``h:mm am`` to timestamp_ntz; null for anything else.

    Read as a time of zone zero and counted in seconds from 1970, so that the session's zone
    and its clock changes play no part. Text without a digit is no date and is not parsed, as a failing parse
    throws an exception.
    """
    zero = F.when(text.rlike("[0-9]"), F.concat(text, F.lit(" +0000")))
    moment = F.when(
        text.rlike("(?i)[ap]m$"), F.try_to_timestamp(zero, F.lit("d MMM yyyy h:mm a xx"))
    ).otherwise(F.try_to_timestamp(zero, F.lit("d MMM yyyy xx")))
    seconds = F.make_dt_interval(secs=moment.cast("long").cast("decimal(18,6)"))
    return F.lit("1970-01-01").cast("timestamp_ntz") + seconds


def stamp(as_of: datetime) -> Column:
    """Collection time as raw files hold it."""
    return F.lit(as_of.strftime("%Y-%m-%d %H:%M:%S"))


def calendar_parts(day: Column) -> dict[str, Column]:
    """Calendar columns of the date dimension: weeks are ISO, Sunday is day 0."""
    return {
        "day": F.dayofmonth(day),
        "month": F.month(day),
        "year": F.year(day),
        "quarter": F.quarter(day),
        "day_of_week": F.dayofweek(day) - 1,
        "week_of_year": F.weekofyear(day),
    }
