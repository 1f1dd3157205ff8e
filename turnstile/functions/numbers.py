"""Ratios and rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_away(value: Column, digits: int) -> Column:
    """Round a DOUBLE by scaling in binary; exact halves go away from zero."""
    scale = float(10**digits)
    return F.round(value * scale) / scale


def round_half_even(value: Column, digits: int) -> Column:
    """Round a DOUBLE by scaling in binary; exact halves go to the even neighbour."""
    scale = float(10**digits)
    return F.rint(value * scale) / scale


def round_money(value: Column, digits: int = 2) -> Column:
    """Round an average of money so that the order of summation cannot flip a half.

    Six decimals are fixed first, which removes the last-bit noise of a
    distributed DOUBLE sum, and only then is the value rounded.
    """
    return F.round(value.cast("decimal(28,6)"), digits).cast("double")


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient as DOUBLE; NULL when the denominator is zero or NULL."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def rate(numerator: Column, denominator: Column, digits: int) -> Column:
    """Rounded ``ratio``."""
    return round_half_away(ratio(numerator, denominator), digits)


def percent(numerator: Column, denominator: Column, digits: int) -> Column:
    """Rounded ``ratio`` in percent; scaled before the division."""
    return round_half_away(ratio(numerator * F.lit(100.0), denominator), digits)


def percent_label(share: Column) -> Column:
    """Share as text with one decimal and a percent sign; ``N/A`` for NULL."""
    text = F.concat(F.format_string("%.1f", round_half_away(share * 100.0, 1)), F.lit("%"))
    return F.when(share.isNotNull(), text).otherwise("N/A")
