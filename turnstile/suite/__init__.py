"""Queries over the given Parquet tables, each with an equivalent SQL text."""
