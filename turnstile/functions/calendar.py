"""Dates, kick-off times and weekdays."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# English weekday names, Monday first.
WEEKDAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")

# Labels of the two kick-off slots and the hour that separates them.
AFTERNOON = "Après-midi"
EVENING = "Soirée"
EVENING_FROM_HOUR = 18


def weekday_name(day: Column) -> Column:
    """Full English weekday name."""
    return F.date_format(day, "EEEE")


def weekday_position(name: Column) -> Column:
    """0 for Monday to 6 for Sunday from a weekday name; NULL for other text."""
    return F.nullif(F.array_position(F.array(*map(F.lit, WEEKDAYS)), name), F.lit(0)) - 1


def day_token(day: Column) -> Column:
    """``20240105``: the form of the date used in scan file names."""
    return F.date_format(day, "yyyyMMdd")


def clock_hour(clock: Column) -> Column:
    """Hour of ``HH:mm[:ss]`` text."""
    return F.split_part(clock, F.lit(":"), F.lit(1)).try_cast("int")


def clock_minutes(clock: Column) -> Column:
    """Minutes since midnight of ``HH:mm[:ss]`` text."""
    return clock_hour(clock) * 60 + F.split_part(clock, F.lit(":"), F.lit(2)).try_cast("int")


def kickoff_hour(day: Column, clock: Column) -> Column:
    """Day and ``HH:mm[:ss]`` text as a wall-clock timestamp at the start of the hour.

    Built from its parts, so that no time zone of the session takes part.
    """
    zero = F.lit(0)
    return F.try_make_timestamp_ntz(F.year(day), F.month(day), F.day(day), clock_hour(clock), zero, zero)


def time_slot(clock: Column) -> Column:
    """Afternoon or evening slot; NULL when the time is unknown."""
    hour = clock_hour(clock)
    return F.when(hour < EVENING_FROM_HOUR, AFTERNOON).when(hour >= EVENING_FROM_HOUR, EVENING)
