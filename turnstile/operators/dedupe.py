"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str] | None = None) -> DataFrame:
    """Keep the first row of each key in ``order`` (default: all other columns).

    The order covers every column that is not a key, so the survivor does not
    depend on how the data was partitioned. Catalyst turns the ``= 1`` filter
    into a group limit that runs before the shuffle as well: a key that holds a
    large part of all rows leaves each input task as a single row.
    """
    rank = "_row_in_key"
    ordering = list(order) if order is not None else [c for c in df.columns if c not in keys]
    window = Window.partitionBy(*keys).orderBy(*(ordering or keys))
    return df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) == 1).drop(rank)


def duplicate_count(df: DataFrame, key: str) -> DataFrame:
    """Rows, distinct keys and the difference, as one row."""
    return (
        df.groupBy(key)
        .agg(F.count("*").alias("n"))
        .agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
            F.count(key).alias("n_distinct"),
        )
        .withColumn("n_duplicates", F.col("n_rows") - F.col("n_distinct"))
    )
