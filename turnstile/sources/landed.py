"""Landed Parquet files whose columns and types changed over time."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnstile.sources.files import absent_as_none

# Number types from narrow to wide; a later one holds the values of all before it, but for the last digits of very long whole numbers.
_NUMBERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType)
_CONFLICTS = ("CANNOT_MERGE_SCHEMAS", "CANNOT_MERGE_INCOMPATIBLE_DATA_TYPE")


def wider_type(a: T.DataType, b: T.DataType) -> T.DataType:
    """A type that holds the values of both: the wider number, a timestamp for dates and times, the union of fields, or text."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(a, _NUMBERS) and isinstance(b, _NUMBERS):
        places = sorted((_NUMBERS.index(type(a)), _NUMBERS.index(type(b))))
        whole_and_real = places[0] > 1 and places[1] == 4  # 24 bits of a FLOAT hold no INT
        return T.DoubleType() if whole_and_real else _NUMBERS[places[1]]()
    if isinstance(a, (T.DecimalType, *_NUMBERS)) and isinstance(b, (T.DecimalType, *_NUMBERS)):
        return _wider_decimal(a, b)
    times = (T.DateType, T.TimestampNTZType, T.TimestampType)
    if isinstance(a, times) and isinstance(b, times):
        return times[max(times.index(type(a)), times.index(type(b)))]()
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return _wider_struct([a, b])
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(wider_type(a.elementType, b.elementType))
    return T.StringType()


def _wider_decimal(a: T.DataType, b: T.DataType) -> T.DataType:
    if isinstance(a, (T.FloatType, T.DoubleType)) or isinstance(b, (T.FloatType, T.DoubleType)):
        return T.DoubleType()
    digits = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 20}
    sizes = [(d.precision - d.scale, d.scale) if isinstance(d, T.DecimalType) else (digits[type(d)], 0) for d in (a, b)]
    before, after = max(s[0] for s in sizes), max(s[1] for s in sizes)
    return T.DecimalType(before + after, after) if before + after <= 38 else T.DoubleType()


def _wider_struct(structs: Sequence[T.StructType]) -> T.StructType:
    """All fields by name, in the order in which they first come."""
    merged: dict[str, T.DataType] = {}
    for struct in structs:
        for f in struct.fields:
            merged[f.name] = wider_type(merged[f.name], f.dataType) if f.name in merged else f.dataType
    return T.StructType([T.StructField(name, kind) for name, kind in merged.items()])


def schema_groups(spark: SparkSession, files: Sequence[str]) -> list[tuple[list[str], T.StructType]]:
    """Files in groups that Spark can read together, with the merged schema of each.

    Spark merges the footers of many files in one job, and fails where a type differs. Then the files are halved, in
    order of their names, as types change with time; groups that end up with one schema are joined again.
    """

    def merged(part: list[str]) -> list[tuple[list[str], T.StructType]]:
        try:
            return [(part, spark.read.option("mergeSchema", True).parquet(*part).schema)]
        except (PySparkException, Py4JJavaError) as error:  # a failed merge is not among the errors PySpark converts
            if len(part) == 1 or not any(c in str(error) for c in _CONFLICTS):
                raise
        half = len(part) // 2
        return merged(part[:half]) + merged(part[half:])

    groups: dict[str, tuple[list[str], T.StructType]] = {}
    for part, schema in merged(sorted(files)):
        groups.setdefault(schema.json(), ([], schema))[0].extend(part)
    return list(groups.values())


def read_landed(spark: SparkSession, path: str, *stamps: Column) -> DataFrame | None:
    """All Parquet files under ``path``, merged by column name and widened type, followed by ``stamps``; None when there is no file."""
    found = absent_as_none(lambda: spark.read.format("binaryFile").load(path))
    files = [] if found is None else found.inputFiles()
    if not files:
        return None
    groups = schema_groups(spark, files)
    whole = _wider_struct([schema for _, schema in groups])
    names = [f.name for f in whole.fields]
    parts = []
    for part, schema in groups:
        rows = spark.read.schema(schema).parquet(*part)
        held = {f.name: F.col(f"`{f.name}`").cast(whole[f.name].dataType) for f in schema.fields}
        columns = [held.get(n, F.lit(None).cast(whole[n].dataType)).alias(n) for n in names]
        parts.append(rows.select(*columns, *stamps))
    return reduce(DataFrame.unionAll, parts)
