"""Queries: typing and cleaning, the fact table, analysis, feeds and quality checks."""
