"""Lookups that add columns to a table without adding rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def flag_dates_in_periods(
    df: DataFrame, date_col: str, periods: DataFrame, start_col: str, end_col: str, flag: str
) -> DataFrame:
    """Add ``flag``: whether the date lies in any period, bounds included; never NULL.

    Periods are spread to the days they cover and made distinct, which turns the
    range test into an equality join. The right side is bounded by the number of
    calendar days, whatever the number of periods or rows.
    """
    days = (
        periods.filter(F.col(start_col) <= F.col(end_col))
        .select(F.explode(F.sequence(F.col(start_col), F.col(end_col))).alias("_day"))
        .distinct()
        .withColumn("_covered", F.lit(True))
    )
    return (
        df.join(days, df[date_col] == days["_day"], "left")
        .withColumn(flag, F.coalesce(F.col("_covered"), F.lit(False)))
        .drop("_day", "_covered")
    )


def hourly_readings(weather: DataFrame) -> DataFrame:
    """Weather reduced to one row per hour: the coolest reading, the driest of equals.

    Two hash aggregations over primitive columns, so repeated hours are folded
    before the shuffle. Both values come from one reading: a known temperature
    goes before an unknown one, and so does a known precipitation among equal
    temperatures. Columns in: ``hour_ts, temperature, precipitation``.
    """
    per_temperature = weather.groupBy("hour_ts", "temperature").agg(F.min("precipitation").alias("precipitation"))
    return per_temperature.groupBy("hour_ts").agg(
        F.min("temperature").alias("temperature"),
        # an hour without any temperature has one row here
        F.when(F.min("temperature").isNull(), F.min("precipitation"))
        .otherwise(F.min_by("precipitation", "temperature"))
        .alias("precipitation"),
    )


def unmatched_keys(df: DataFrame, reference: DataFrame, key: str) -> DataFrame:
    """Number of rows of ``df`` whose key has no row in ``reference``."""
    return df.join(reference.select(key), key, "left_anti").agg(F.count("*").alias("n_unmatched"))
