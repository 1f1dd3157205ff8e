"""Readers for the raw drops, the load report, and table and file sinks."""
