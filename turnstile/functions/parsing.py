"""Tolerant text-to-value conversions: a value that cannot be read becomes NULL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Day-first date layouts found in the sources.
DAY_FIRST_SLASH = "d/M/yyyy"
DAY_FIRST_DASH = "d-M-yyyy"

# Year-first dates need all three parts, the same separator, and at most a clock time after them.
_YEAR_FIRST = r"^\d{4}([-/])\d{1,2}\1\d{1,2}([ T]\d{1,2}:\d{2}.*)?$"
# Plain decimal notation; keeps out type suffixes such as "1.5d" that the JVM would accept.
_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def strip(text: Column) -> Column:
    """Remove leading and trailing white space of any kind."""
    return F.btrim(text, F.lit(" \t\n\r\v\f"))


def year_first_date(text: Column) -> Column:
    """``2024-01-05`` or ``2024/1/5``, optionally followed by a time, as DATE."""
    cleaned = strip(text)
    return F.when(cleaned.rlike(_YEAR_FIRST), F.replace(cleaned, F.lit("/"), F.lit("-")).try_cast("date"))


def patterned_date(text: Column, pattern: str) -> Column:
    """Text in one fixed date layout as DATE."""
    return F.try_to_date(strip(text), pattern)


def flexible_date(text: Column, *patterns: str) -> Column:
    """Year-first reading, then each pattern in turn; the first that succeeds wins."""
    return F.coalesce(year_first_date(text), *(patterned_date(text, p) for p in patterns))


def decimal_number(text: Column) -> Column:
    """Decimal text as DOUBLE."""
    cleaned = strip(text)
    return F.when(
        cleaned.rlike(_NUMBER) | F.lower(cleaned).isin("inf", "-inf", "infinity", "-infinity", "nan"),
        cleaned.try_cast("double"),
    )


def comma_number(text: Column) -> Column:
    """Decimal text that may use a comma (``39,00``) as DOUBLE."""
    return decimal_number(F.replace(text, F.lit(","), F.lit(".")))


def whole_number(text: Column) -> Column:
    """Number text as INT, rounding halves away from zero; out of range is NULL."""
    return F.round(decimal_number(text)).try_cast("int")


def truth_value(text: Column) -> Column:
    """``true/t/yes/y/1`` and their opposites as BOOLEAN."""
    return text.try_cast("boolean")


def date_as_written(text: Column) -> Column:
    """Date part of timestamp text, without any time-zone shift."""
    return year_first_date(F.substring(strip(text), 1, 10))


def local_timestamp(text: Column) -> Column:
    """ISO text such as ``2024-01-05T20:00`` as a wall-clock timestamp."""
    return strip(text).try_cast("timestamp_ntz")


def utc_timestamp(text: Column) -> Column:
    """ISO text as a wall-clock timestamp in UTC; an offset such as ``+02:00`` or ``Z`` is applied."""
    cleaned = strip(text)
    with_zone = cleaned.rlike(r"[0-9]([+-][0-9]{2}:?[0-9]{2}|Z)$") & cleaned.contains(":")
    shifted = F.to_utc_timestamp(cleaned.try_cast("timestamp"), F.current_timezone()).cast("timestamp_ntz")
    return F.when(with_zone, shifted).otherwise(cleaned.try_cast("timestamp_ntz"))


def number_in_name(name: Column, pattern: str) -> Column:
    """First group of ``pattern`` in a file name, as INT; NULL when there is no match."""
    return F.regexp_extract(name, pattern, 1).try_cast("int")


def token_in_name(name: Column, pattern: str) -> Column:
    """First group of ``pattern`` in a file name, as text; NULL when there is no match."""
    return F.nullif(F.regexp_extract(name, pattern, 1), F.lit(""))
