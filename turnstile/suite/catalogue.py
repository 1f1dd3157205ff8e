"""Registered queries: a Spark build over the given tables and, beside it, its SQL text."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnstile.functions.numbers import round_half_away
from turnstile.suite.sql import with_tables
from turnstile.suite.standins import Inputs


@dataclass(frozen=True)
class Query:
    """A query and its SQL text; None where SQL cannot express it."""

    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None


CATALOGUE: dict[str, Query] = {}


def query(sql: str | None = None):
    """Register ``build(inputs)`` under its own name, with the SQL that gives the same rows."""

    def register(build: Callable[[Inputs], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return build(Inputs(spark, folder))

        CATALOGUE[build.__name__] = Query(run, with_tables(sql) if sql else None)
        return build

    return register


def rounded(df: DataFrame, digits: int = 9, **by_column: int) -> DataFrame:
    """DOUBLE columns rounded, so that the order of a distributed sum does not show."""
    return df.select(
        *(
            round_half_away(F.col(f"`{f.name}`"), by_column.get(f.name, digits)).alias(f.name)
            if isinstance(f.dataType, T.DoubleType)
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        )
    )
