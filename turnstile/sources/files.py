"""Finding and listing input files."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def absent_as_none(read):
    """Result of ``read()``, or None when its path does not exist or matches no file."""
    try:
        return read()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def same_path(path: Column) -> Column:
    """One spelling for local paths, which Spark writes with one slash or three."""
    return F.regexp_replace(path, "^file:/+", "file:///")


def list_files(spark: SparkSession, path: str) -> DataFrame | None:
    """Name, path and size of the files under ``path``; their content is not read.

    Spark makes no rows from empty files, so the names come from its file index,
    which the driver holds for any read, and the sizes from the files' metadata.
    """
    listing = absent_as_none(lambda: spark.read.format("binaryFile").load(path))
    if listing is None:
        return None
    sizes = listing.select(
        same_path(F.col("_metadata.file_path")).alias("path"), F.col("_metadata.file_size").alias("_size")
    )
    names = spark.createDataFrame([(name,) for name in listing.inputFiles()], "path string")
    names = names.select(same_path(F.col("path")).alias("path"))
    return names.join(sizes, "path", "left").select(
        F.element_at(F.split("path", "/"), -1).alias("filename"),
        "path",
        F.coalesce("_size", F.lit(0)).alias("length"),
    )


def first_file(spark: SparkSession, path: str) -> str | None:
    """Path of the first file with content, by path order, or None when there is none."""
    listing = absent_as_none(lambda: spark.read.format("binaryFile").load(path))
    return None if listing is None else listing.agg(F.min("path")).first()[0]


def without_files(rows: DataFrame, listed: DataFrame, path_column: str) -> DataFrame:
    """Rows of files that are not listed: one lazy anti-join, whose form the planner chooses."""
    return rows.join(listed.select(path_column), path_column, "left_anti").select(rows.columns)
