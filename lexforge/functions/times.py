"""Timestamps in several ISO notations, as built-in column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def utc_wall(ts: Column) -> Column:
    """``ts`` shifted so that the session's time zone renders its UTC wall time."""
    return F.to_utc_timestamp(ts, F.current_timezone())


def utc_month(ts: Column) -> Column:
    """``yyyy-MM`` of an instant in UTC, whatever the session's time zone; null for null."""
    return F.date_format(utc_wall(ts), "yyyy-MM")


def utc_month_number(ts: Column) -> Column:
    """Months since year 0 of an instant in UTC, an int that compares and shuffles cheaper than its text; null for null."""
    wall = utc_wall(ts)
    return F.year(wall) * 12 + F.month(wall) - 1


def month_text(number: Column) -> Column:
    """``yyyy-MM`` of a month number."""
    return F.concat(F.lpad(F.floor(number / 12).cast("string"), 4, "0"), F.lit("-"), F.lpad((number % 12 + 1).cast("string"), 2, "0"))


def iso_instant(text: Column) -> Column:
    """The instant an ISO-8601 string denotes; null where it denotes none.

    Extended and basic notation, ``T`` or a blank between date and time, fractions after a point or comma, offsets as
    ``Z``, ``+hh:mm``, ``+hhmm`` or ``+hh``. A string without an offset is UTC.
    """
    s = F.upper(F.trim(text))
    s = F.regexp_replace(s, r"^(\d{4})(\d{2})(\d{2})([T ])(\d{2})(\d{2})(\d{2})", "$1-$2-$3$4$5:$6:$7")
    s = F.regexp_replace(s, ",", ".")
    s = F.regexp_replace(s, r"(:\d{2}(?:\.\d+)?)\s+([+\-Z])", "$1$2")
    s = F.regexp_replace(s, r"(:\d{2}(?:\.\d+)?[+\-]\d{2}):?(\d{2})$", "$1:$2")
    s = F.regexp_replace(s, r"(:\d{2}(?:\.\d+)?[+\-]\d{2})$", "$1:00")
    bare = s.rlike(r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d+)?)?)?$")
    dateonly = s.rlike(r"^\d{4}-\d{2}-\d{2}$")
    s = F.when(dateonly, F.concat(s, F.lit("T00:00:00Z"))).when(bare, F.concat(s, F.lit("Z"))).otherwise(s)
    ok = s.rlike(r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(:\d{2}(\.\d+)?)?(Z|[+\-]\d{2}:\d{2})$")
    return F.when(ok, s.try_cast("timestamp"))
