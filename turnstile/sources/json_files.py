"""JSON sources: nested order drops and the files of external services."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnstile import schemas
from turnstile.functions.parsing import number_in_name
from turnstile.session import scratch_path
from turnstile.sources.files import absent_as_none, first_file, list_files, same_path
from turnstile.sources.landed import read_landed
from turnstile.sources.staging import Staged, observed, stage

# The round number in a file name.
STREAKS_NAME = r"streaks_r(\d+)\.json"
STANDINGS_NAME = r"standings_r(\d+)\."

_CORRUPT = "_corrupt"


def read_order_drops(
    spark: SparkSession, path: str, one_document_per_file: bool = True, lists: bool = False
) -> DataFrame | None:
    """Order drops as they are: ``orders``, with ``lists`` also ``included``, ``_corrupt``, ``filename``, ``_path``.

    A drop is one JSON document. Usually a file holds one document over many
    lines. Files with one document per line are read with
    ``one_document_per_file=False``, and can then be split between tasks.
    """
    parts = [schemas.ORDERS_DROP, *([schemas.REFERENCE_LISTS] if lists else []), f"{_CORRUPT} string"]
    reader = (
        spark.read.schema(", ".join(parts))
        .option("multiLine", one_document_per_file)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", _CORRUPT)
    )
    drops = absent_as_none(lambda: reader.json(path))
    if drops is None:
        return None
    return drops.select(
        "*",
        F.col("_metadata.file_name").alias("filename"),
        F.col("_metadata.file_path").alias("_path"),
    )


def is_unreadable() -> Column:
    """Whether a document of an order drop could not be parsed."""
    return F.col(_CORRUPT).isNotNull()


def tickets_in_document() -> Column:
    """Number of tickets in a drop document, from the sizes of its lists."""

    def joined(lists: Column) -> Column:
        return F.flatten(F.filter(lists, lambda x: x.isNotNull()))

    products = joined(F.col("orders.products"))
    return F.coalesce(F.size(joined(products["tickets"])), F.lit(0))


def stage_order_drops(spark: SparkSession, path: str, one_document_per_file: bool = True) -> Staged | None:
    """Order drops parsed once, with the reference lists of the first drop, or None when there is no file."""
    listing = list_files(spark, path)
    if listing is None:
        return None
    first = first_file(spark, path)
    drops = read_order_drops(spark, path, one_document_per_file, lists=True)
    is_first = same_path(F.col("_path")) == same_path(F.lit(first))
    kept = drops.select(
        "orders",
        F.when(is_first, F.col("included")).alias("included"),
        "filename",
        "_path",
        is_unreadable().alias("_bad"),
        tickets_in_document().cast("long").alias("_tickets"),
    )
    return stage(kept, listing, "order-drops", n_tickets=F.sum(F.when(~F.col("_bad"), F.col("_tickets"))))


def unreadable_files(drops: DataFrame) -> DataFrame:
    """Quarantine list: name and path of files that hold an unreadable document.

    Spark parses documents only when a data column is asked for, hence the test on ``orders``.
    """
    parsed = F.coalesce(F.size("orders"), F.lit(0)) >= 0
    return drops.filter(is_unreadable() & parsed).select("filename", "_path").distinct()


def flatten_tickets(drops: DataFrame) -> DataFrame:
    """One row per ticket from orders, their products and their tickets.

    Three generators in one stage, no shuffle; orders without products and
    products without tickets give no row.
    """
    orders = drops.select("filename", "_path", F.explode("orders").alias("o"))
    products = orders.select(
        "filename",
        "_path",
        F.col("o.order_id"),
        F.col("o.event_id"),
        F.col("o.order_status_id"),
        F.col("o.channel_id"),
        F.col("o.customer.external_id").alias("ext_id"),
        F.col("o.creation_date").alias("order_creation_date"),
        F.col("o.validation_date").alias("order_validation_date"),
        F.col("o.is_secondary_market"),
        F.explode("o.products").alias("p"),
    )
    header = [c for c in products.columns if c != "p"]
    tickets = products.select(*header, "p", F.explode("p.tickets").alias("t"))
    return tickets.select(
        *header,
        F.col("p.order_product_id"),
        F.col("p.product_type_id"),
        F.col("p.is_cancelled").alias("product_is_cancelled"),
        F.col("p.amount_inc_tax").alias("product_amount_inc_tax"),
        F.col("t.ticket_id"),
        F.col("t.bar_code"),
        F.col("t.category_id"),
        F.col("t.session_id"),
        F.col("t.amount"),
        F.col("t.ticket_status_id"),
        F.col("t.seats.gate").alias("seat_gate"),
        F.col("t.seats.stand").alias("seat_stand"),
        F.col("t.seats.row").alias("seat_row"),
        F.col("t.seats.number").alias("seat_number"),
    )


def read_tickets(spark: SparkSession, path: str, one_document_per_file: bool = True) -> DataFrame | None:
    """Tickets of all readable drop files, 23 columns, or None when there is no file.

    Where a file is one document it is judged as it is parsed; files of many documents are staged, so that they
    are parsed once and not a second time to find the unreadable ones.
    """
    if one_document_per_file:
        drops = read_order_drops(spark, path)
        return None if drops is None else flatten_tickets(drops.filter(~is_unreadable())).drop("_path")
    drops = stage_order_drops(spark, path, one_document_per_file)
    return None if drops is None else staged_tickets(drops)


def staged_tickets(drops: Staged) -> DataFrame:
    """Tickets of the readable files of staged drops, 23 columns."""
    return flatten_tickets(drops.sound()).drop("_path")


REFERENCE_LISTS = ("sessions", "product_types", "order_status")


def staged_reference_lists(drops: Staged) -> dict[str, DataFrame]:
    """Sessions, product types and order states, as the first drop file by name lists them."""
    return {name: drops.rows.select(F.inline(f"included.{name}")) for name in REFERENCE_LISTS}


def read_reference_lists(
    spark: SparkSession, path: str, one_document_per_file: bool = True
) -> dict[str, DataFrame] | None:
    """Sessions, product types and order states from the first drop file by name."""
    first = first_file(spark, path)
    if first is None:
        return None
    document = spark.read.schema(schemas.REFERENCE_LISTS).option("multiLine", one_document_per_file).json(first)
    return {name: document.select(F.inline(f"included.{name}")) for name in REFERENCE_LISTS}


def read_weather(spark: SparkSession, path: str) -> DataFrame | None:
    """Hourly weather from the first file of a folder: parallel lists become rows.

    Lists of different lengths are padded with NULL.
    """
    first = first_file(spark, path)
    if first is None:
        return None
    return unzip_weather(spark.read.schema(schemas.WEATHER).option("multiLine", True).json(first))


def unzip_weather(documents: DataFrame) -> DataFrame:
    """Rows from documents with an ``hourly`` struct of parallel lists."""
    lists = F.arrays_zip(
        *(
            F.col(f"hourly.{c}")
            for c in ("time", "temperature_2m", "apparent_temperature", "precipitation", "weather_code")
        )
    )
    # A missing list must not blank the others, so NULL lists count as empty.
    filled = documents.select(
        F.struct(
            *(
                F.coalesce(F.col(f"hourly.{c}"), F.array().cast(f"array<{t}>")).alias(c)
                for c, t in (
                    ("time", "string"),
                    ("temperature_2m", "double"),
                    ("apparent_temperature", "double"),
                    ("precipitation", "double"),
                    ("weather_code", "int"),
                )
            )
        ).alias("hourly")
    )
    return filled.select(F.inline(lists)).toDF(
        "heure", "temperature", "temperature_ressentie", "precipitation", "code_meteo"
    )


def read_holidays(
    spark: SparkSession, path: str, schema: str | None = None, one_document_per_file: bool = True
) -> DataFrame | None:
    """Rows of the ``results`` lists of all files, one column per field."""
    if schema is None:
        return read_listed_rows(spark, path, "results", one_document_per_file)
    documents = _documents(spark, path, schema, one_document_per_file)
    return None if documents is None else documents.select(F.inline("results"))


def read_population(
    spark: SparkSession, path: str, schema: str | None = None, one_document_per_file: bool = True
) -> DataFrame | None:
    """Population records, or None when the file is absent."""
    return _documents(spark, path, schema, one_document_per_file)


def read_streaks(
    spark: SparkSession,
    path: str,
    name_pattern: str = STREAKS_NAME,
    schema: str | None = None,
    one_document_per_file: bool = True,
) -> DataFrame | None:
    """Team rows of every round file, with the round number taken from the file name."""
    round_number = number_in_name(F.col("_metadata.file_path"), name_pattern).alias("round")
    if schema is None:
        return read_listed_rows(spark, path, "teams", one_document_per_file, round_number)
    documents = _documents(spark, path, schema, one_document_per_file)
    if documents is None:
        return None
    return documents.select(round_number, F.explode("teams").alias("team")).select("round", "team.*")


def _documents(spark: SparkSession, path: str, schema: str | None, one_document_per_file: bool) -> DataFrame | None:
    """JSON documents, or None when no file matches. Without a schema, fields of all files are merged by name."""
    reader = spark.read.option("multiLine", one_document_per_file)
    return absent_as_none(lambda: (reader.schema(schema) if schema else reader).json(path))


def read_listed_rows(
    spark: SparkSession, path: str, listed: str, one_document_per_file: bool = True, *stamps: Column
) -> DataFrame | None:
    """Objects in the list field ``listed`` of all files as rows, merged by field name, after ``stamps``; None when there is no file.

    The files are read once, as VARIANT, whatever fields they have: the pass that writes the rows down also merges
    their fields and types, and columns are then taken from the copy. Fields come in order of their names. Whole
    numbers are BIGINT, others DOUBLE; a field of unlike types, or always null, is text.
    """
    reader = spark.read.option("multiLine", one_document_per_file).option("singleVariantColumn", "document")
    documents = absent_as_none(lambda: reader.json(path))
    if documents is None:
        return None
    objects = F.try_variant_get("document", f"$.{listed}", "array<variant>")
    listed_rows = documents.select(*stamps, F.explode(objects).alias("_row"))
    watched, seen = observed(listed_rows, f"fields of {listed}", fields=F.schema_of_variant_agg("_row"))
    folder = scratch_path(spark, listed)
    watched.write.parquet(folder)
    copy = spark.read.schema(listed_rows.schema).parquet(folder)
    fields = _struct_of(seen.get.get("fields") or "VOID").fields
    columns = [F.try_variant_get("_row", _in_object(f.name), f.dataType.simpleString()).alias(f.name) for f in fields]
    return copy.select(*(c for c in copy.columns if c != "_row"), *columns)


def _struct_of(description: str) -> T.StructType:
    """A merged description of VARIANT objects as the types of their columns."""
    ddl = re.sub("`(?:[^`]|``)*`|OBJECT<", lambda m: "STRUCT<" if m[0] == "OBJECT<" else m[0], description)
    merged = T.DataType.fromDDL(ddl)
    if isinstance(merged, T.NullType):
        return T.StructType()
    if not isinstance(merged, T.StructType):
        raise ValueError(f"listed rows are not objects but {description}")
    return _plain_type(merged)


def _plain_type(kind: T.DataType) -> T.DataType:
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _plain_type(f.dataType)) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_plain_type(kind.elementType))
    if isinstance(kind, T.DecimalType):
        return T.DoubleType()
    return T.StringType() if isinstance(kind, (T.NullType, T.VariantType)) else kind


def _in_object(name: str) -> str:
    """Path to a field of an object, whatever characters its name has."""
    return f'$["{name}"]' if "'" in name else f"$['{name}']"


def read_standings(spark: SparkSession, path: str, name_pattern: str = STANDINGS_NAME) -> DataFrame:
    """Landed Parquet standings of all rounds, merged by column name, stamped with the round.

    Absent rounds are simply not there; no file at all is an error. Columns whose type differs between rounds get the
    type that holds all of them.
    """
    rounds = read_landed(spark, path, number_in_name(F.col("_metadata.file_path"), name_pattern).alias("round"))
    if rounds is None:
        raise FileNotFoundError(f"no standings under {path}")
    return rounds
