"""The records behind the dashboard: matches in date order, conversion by channel, campaign rates."""

from __future__ import annotations

from pyspark.sql import DataFrame

from turnstile.plans import analysis
from turnstile.sources.tables import as_records, by_date, write_records


def feed(fact: DataFrame, web_sessions: DataFrame, campaign_events: DataFrame) -> dict[str, DataFrame]:
    """The three record sets by name."""
    return {
        "matches": by_date(fact),
        "conversion": analysis.conversion_by_channel(web_sessions),
        "campaigns": analysis.campaign_rates(campaign_events),
    }


def write_feed(fact: DataFrame, web_sessions: DataFrame, campaign_events: DataFrame, path: str) -> dict:
    """Write each set as JSON records in a folder of its name; returns the schemas of the records."""
    sets = feed(fact, web_sessions, campaign_events)
    for name, rows in sets.items():
        write_records(rows, f"{path}/{name}")
    return {name: as_records(rows).schema for name, rows in sets.items()}
