"""CSV sources."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.types import StructType

from turnstile import schemas
from turnstile.functions.parsing import (
    DAY_FIRST_SLASH,
    comma_number,
    flexible_date,
    strip,
    token_in_name,
    utc_timestamp,
    whole_number,
)
from turnstile.sources.files import absent_as_none, list_files
from turnstile.sources.staging import Staged, observed, seen_totals, stage

# Fixed value: the date token in a scan file's name.
SCAN_NAME = r"scan_(.*)\.csv"

_CORRUPT = "_corrupt"


def _reader(spark: SparkSession, separator: str = ","):
    """CSV reader with a header row; quotes inside quoted text are doubled."""
    return spark.read.option("header", True).option("sep", separator).option("quote", '"').option("escape", '"')


def _tolerant(text: Column, kind: T.DataType) -> Column:
    """Text as a declared type: numbers such as ``3.0`` or ``39,00`` and day-first dates are read too."""
    if isinstance(kind, T.IntegerType):
        return whole_number(text)
    if isinstance(kind, T.DoubleType):
        return comma_number(text)
    if isinstance(kind, T.DateType):
        return flexible_date(text, DAY_FIRST_SLASH)
    return text if isinstance(kind, T.StringType) else text.try_cast(kind)


def read_named_csv(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame | None:
    """Typed CSV with a header row, or None when the file is absent.

    Columns are matched by their name in the header. Columns in ``schema`` are read
    as text and converted tolerantly, so that a rank written ``3.0`` or a date
    written ``17/10/2025`` survives; ``watched_csv`` counts what does not. Only if
    the file has other columns is it read once more to infer those from all rows.
    """
    watched = watched_csv(spark, path, schema)
    return None if watched is None else watched[0]


def watched_csv(spark: SparkSession, path: str, schema: str | None = None) -> tuple[DataFrame, Observation, list[str]] | None:
    """``read_named_csv`` with an observation of it and the declared columns that it holds.

    Once the rows have been written, the observation has under each such column's
    place how many of its texts, other than blank ones, could not be converted.
    """
    as_text = absent_as_none(lambda: _reader(spark).csv(path))
    if as_text is None:
        return None
    known = {f.name.lower(): f for f in StructType.fromDDL(schema).fields} if schema else {}
    given = [known.get(name.lower()) for name in as_text.columns]
    if None in given:
        inferred = _reader(spark).option("inferSchema", True).option("samplingRatio", 1.0).csv(path).schema.fields
        mixed = [T.StructField(i.name, T.StringType()) if g else i for g, i in zip(given, inferred)]
        as_text = _reader(spark).schema(StructType(mixed)).csv(path)
    # Each declared column as its text and its value side by side, so that both are at hand when rows are counted.
    paired = as_text.toDF(*(f"t{i}" for i in range(len(given))))
    paired = paired.select("*", *(_tolerant(F.col(f"t{i}"), field.dataType).alias(f"v{i}") for i, field in enumerate(given) if field))
    unread = {f"v{i}": F.count_if((strip(F.col(f"t{i}")) != "") & F.col(f"v{i}").isNull()) for i, field in enumerate(given) if field}
    rows, seen = observed(paired, f"unread {uuid.uuid4().hex}", n_rows=F.count("*"), **unread)
    names = [field.name if field else name for name, field in zip(as_text.columns, given)]
    typed = rows.select(*(F.col(f"v{i}" if field else f"t{i}").alias(name) for i, (name, field) in enumerate(zip(names, given))))
    return typed, seen, [field.name if field else "" for field in given]


def unread_counts(seen: Observation, declared: list[str]) -> dict[str, int]:
    """By declared column, how many texts could not be converted, after the rows have been written."""
    return {name: seen_totals(seen, f"v{i}")[f"v{i}"] for i, name in enumerate(declared) if name}


def unread_values(spark: SparkSession, path: str, schema: str) -> DataFrame | None:
    """Per declared column of a CSV file: how many non-empty texts could not be converted."""
    watched = watched_csv(spark, path, schema)
    if watched is None:
        return None
    rows, seen, declared = watched
    rows.write.format("noop").mode("overwrite").save()
    return spark.createDataFrame(list(unread_counts(seen, declared).items()), "column string, n_unread long")


def read_text_csv(spark: SparkSession, path: str, separator: str = ",") -> DataFrame:
    """CSV with a header row, every column kept as text. The file must exist."""
    return _reader(spark, separator).csv(path)


def read_contacts(spark: SparkSession, path: str) -> DataFrame:
    """Contacts, untyped."""
    return read_text_csv(spark, path)


def read_till(spark: SparkSession, path: str) -> DataFrame:
    """Till lines, untyped, separated by semicolons."""
    return read_text_csv(spark, path, separator=";")


def _raw_scans(spark: SparkSession, path: str) -> DataFrame | None:
    reader = (
        spark.read.schema(f"{schemas.SCANS}, {_CORRUPT} string")
        .option("header", False)
        .option("quote", '"')
        .option("escape", '"')
        .option("mode", "PERMISSIVE")
        .option("columnPruning", False)  # lines are judged by all their fields, whatever a query selects
        .option("columnNameOfCorruptRecord", _CORRUPT)
    )
    rows = absent_as_none(lambda: reader.csv(path))
    if rows is None:
        return None
    is_header = F.lit(True)
    for name in StructType.fromDDL(schemas.SCANS).names:  # a line that names every column, nothing less
        is_header = is_header & F.coalesce(strip(F.col(name)) == name, F.lit(False))
    return rows.select(
        "*",
        is_header.alias("_is_header"),
        F.col("_metadata.file_name").alias("filename"),
        F.col("_metadata.file_path").alias("_path"),
    )


def stage_scans(spark: SparkSession, path: str, token_pattern: str = SCAN_NAME) -> Staged | None:
    """Scan files with and without a header row, parsed once, or None when there is no file.

    No file is read on its own: all are read without header, and header lines are
    marked wherever a file has one. Times are converted here, once.
    """
    listing = list_files(spark, path)
    if listing is None:
        return None
    data = ~F.col("_is_header")
    time = utc_timestamp(F.col("scan_ts_utc"))
    rows = _raw_scans(spark, path).select(
        "barcode",
        time.alias("scan_ts_utc"),
        "portique",
        "ext_id",
        "type_billet",
        "resultat",
        "filename",
        token_in_name(F.col("_path"), token_pattern).alias("date_fichier"),
        "_path",
        "_is_header",
        (data & F.col(_CORRUPT).isNotNull()).alias("_bad"),
        (data & F.coalesce(strip(F.col("scan_ts_utc")) != "", F.lit(False)) & time.isNull()).alias("_unread_time"),
    )
    return stage(rows, listing, "scans", n_headers=F.count_if("_is_header"), n_unread_times=F.count_if("_unread_time"))


def staged_scans(scans: Staged) -> DataFrame:
    """Scans of the files without a malformed line, with file name and date token."""
    return scans.sound().filter(~F.col("_is_header")).drop("_path", "_is_header", "_bad", "_unread_time")


def read_scans(spark: SparkSession, path: str, token_pattern: str = SCAN_NAME) -> DataFrame | None:
    """Scans with file name and date token. A file with a malformed line is left out as a whole."""
    scans = stage_scans(spark, path, token_pattern)
    return None if scans is None else staged_scans(scans)
