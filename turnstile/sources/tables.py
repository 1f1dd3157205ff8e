"""Tables and files written by the stages."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnstile.sources.files import absent_as_none
from turnstile.sources.staging import observed, seen_totals


def ensure_schema(spark: SparkSession, name: str) -> None:
    """Create a database when it does not exist."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")


def replace_table(df: DataFrame, table: str) -> None:
    """Write ``df`` as the whole content of a table."""
    df.write.mode("overwrite").saveAsTable(table)


# The column that says which batch a row of a table came with.
BATCH = "_batch"


def append_table(df: DataFrame, table: str, batch: str | None = None) -> None:
    """Add rows to a table, matching columns by name; creates it when absent.

    Columns that ``df`` lacks are filled with NULL. A column the table lacks is an error. With ``batch`` the rows are
    added once, however often the call is repeated: they are a partition of their own, written as a whole, and a table
    begun without batches cannot take them.
    """
    spark = df.sparkSession
    known = [f for f in spark.table(table).schema.fields] if spark.catalog.tableExists(table) else None
    if batch is not None:
        _check_batch(batch)
        if known is not None and BATCH not in {f.name for f in known}:
            raise ValueError(f"{table} was begun without batches")
        if known is None:
            df.limit(0).withColumn(BATCH, F.lit(batch)).write.partitionBy(BATCH).saveAsTable(table)
            known = spark.table(table).schema.fields
        known = [f for f in known if f.name != BATCH]
    if known is not None:
        extra = set(df.columns) - {f.name for f in known}
        if extra:
            raise ValueError(f"columns unknown to {table}: {sorted(extra)}")
        df = df.select(
            *(F.col(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in known)
        )
    if batch is None:
        df.write.mode("append").saveAsTable(table)
    else:
        spark.sql(f"INSERT OVERWRITE TABLE {table} PARTITION ({BATCH} = '{batch}') SELECT * FROM {{rows}}", rows=df)


def _check_batch(batch: str) -> None:
    if not re.fullmatch(r"[A-Za-z0-9_.-]+", batch):
        raise ValueError(f"a batch is named by letters, digits, _, . and -, not {batch!r}")


def append_batch(df: DataFrame, path: str, batch: str) -> bool:
    """Add a batch of rows to the files under ``path`` once, however often it is run; False if it was there.

    The rows are written to a folder of the batch, and its line in the manifest after them. Rows without a line, left by a
    run that was cut off, are no part of the data, and the next run of that batch replaces them.
    """
    _check_batch(batch)
    spark = df.sparkSession
    if batch in committed_batches(spark, path):
        return False
    counted, seen = observed(df, f"batch {batch}", n_rows=F.count("*"))
    counted.write.mode("overwrite").parquet(f"{path}/data/{BATCH}={batch}")
    line = spark.createDataFrame([(batch, seen_totals(seen, "n_rows")["n_rows"])], _MANIFEST)
    line.coalesce(1).write.mode("overwrite").json(f"{path}/manifest/{BATCH}={batch}")
    return True


_MANIFEST = "batch string, n_rows long"


def committed_batches(spark: SparkSession, path: str) -> dict[str, int]:
    """The batches of the manifest with their numbers of rows."""
    lines = absent_as_none(lambda: spark.read.schema(_MANIFEST).json(f"{path}/manifest/*"))
    return {} if lines is None else {r.batch: r.n_rows for r in lines.collect()}


def read_batches(spark: SparkSession, path: str) -> DataFrame | None:
    """Rows of all committed batches, merged by column name, or None before the first; files of other batches are not opened."""
    batches = committed_batches(spark, path)
    if not batches:
        return None
    folders = [f"{path}/data/{BATCH}={batch}" for batch in sorted(batches)]
    return spark.read.option("mergeSchema", True).parquet(*folders)


def replace_files(df: DataFrame, path: str) -> None:
    """Write Parquet files, replacing what is there."""
    df.write.mode("overwrite").parquet(path)


def append_files(df: DataFrame, path: str) -> None:
    """Write further Parquet files next to those that are there."""
    df.write.mode("append").parquet(path)


def as_records(df: DataFrame) -> DataFrame:
    """Columns in export form: dates as ISO text, everything else as it is."""
    return df.select(
        *(
            F.date_format(f.name, "yyyy-MM-dd").alias(f.name) if isinstance(f.dataType, T.DateType) else F.col(f.name)
            for f in df.schema.fields
        )
    )


def json_records(df: DataFrame) -> DataFrame:
    """One JSON object per row in column ``record``; NULL fields are written as null."""
    return as_records(df).select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("record"))


def write_records(df: DataFrame, path: str) -> None:
    """JSON files with one object per row."""
    as_records(df).write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def copy_tables(spark: SparkSession, names: Iterable[str], source: str, target: str, prefix: str = "raw_") -> list[str]:
    """Copy tables unchanged from one schema to another; returns the names that were absent."""
    absent = []
    for name in names:
        raw = f"{source}.{prefix}{name}"
        if spark.catalog.tableExists(raw):
            replace_table(spark.table(raw), f"{target}.{name}")
        else:
            absent.append(name)
    return absent


def by_date(table: DataFrame, column: str = "date") -> DataFrame:
    """Rows in date order; equal dates follow the first other columns."""
    rest = [c for c in table.columns if c != column]
    return table.orderBy(column, *rest[:1])
