"""Venue analytics on PySpark: raw drops to typed tables to one fact row per event."""
