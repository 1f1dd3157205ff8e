"""Display labels and bands."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Labels shown for results and competitions.
WIN = "Victoire"
LOSS = "Défaite"
PLAYOFFS = "Playoffs"
EUROPEAN = "EuroLeague"
DOMESTIC = "Betclic ÉLITE"

# Fixed value: conversion percentage above which a channel is highlighted.
HIGH_CONVERSION_PCT = 15.0


def result_label(won: Column) -> Column:
    """1 and 0 as win and loss; anything else is NULL."""
    return F.when(won == 1, WIN).when(won == 0, LOSS)


def competition_group(
    competition: Column,
    groups: tuple[str, ...] = (PLAYOFFS, EUROPEAN),
    otherwise: str = DOMESTIC,
) -> Column:
    """First group whose name occurs in the competition name, else the default."""
    label = F.lit(otherwise)
    for group in reversed(groups):
        label = F.when(competition.contains(group), group).otherwise(label)
    return label


def channel_label(source: Column, medium: Column) -> Column:
    """``source / medium``; NULL when either part is NULL."""
    return F.concat(source, F.lit(" / "), medium)


def high_conversion(percentage: Column, threshold: float = HIGH_CONVERSION_PCT) -> Column:
    """Whether a channel converts above the threshold."""
    return percentage > threshold
