"""Load reports: what each file gave, and which files gave nothing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnstile.sources.csv_files import stage_scans
from turnstile.sources.json_files import stage_order_drops
from turnstile.sources.staging import Staged


def staged_order_report(drops: Staged) -> DataFrame:
    """Per file of staged drops: size, tickets read, and ``ok``, ``corrupt`` or ``empty``; the documents are not parsed again."""
    files = drops.per_file(_n=F.sum("_tickets"), _bad=F.max("_bad"))
    state = F.when(F.col("length") == 0, "empty").when(F.coalesce("_bad", F.lit(False)), "corrupt").otherwise("ok")
    tickets = F.when(F.col("state") == "ok", F.coalesce("_n", F.lit(0))).otherwise(0)
    return files.withColumn("state", state).select("filename", "length", "state", tickets.alias("n_rows"))


def order_file_report(spark: SparkSession, path: str, one_document_per_file: bool = True) -> DataFrame | None:
    """Per order file: size, tickets read, and ``ok``, ``corrupt`` or ``empty``.

    The listing comes from the file index, so files that give no row at all are reported too.
    """
    drops = stage_order_drops(spark, path, one_document_per_file)
    return None if drops is None else staged_order_report(drops)


def staged_scan_report(scans: Staged) -> DataFrame:
    """Per file of staged scans: size, rows, ``ok``, ``corrupt`` or ``empty``, and whether it had a header row."""
    files = scans.per_file(
        _n=F.count_if(~F.col("_is_header")), _bad=F.max("_bad"), _unread=F.count_if("_unread_time"), has_header=F.max("_is_header")
    )
    state = F.when(F.coalesce("_n", F.lit(0)) == 0, "empty").when(F.col("_bad"), "corrupt").otherwise("ok")
    return files.withColumn("state", state).select(
        "filename",
        "length",
        "state",
        F.when(F.col("state") == "ok", F.col("_n")).otherwise(0).alias("n_rows"),
        F.coalesce("_unread", F.lit(0)).alias("n_unread_times"),
        "has_header",
    )


def scan_file_report(spark: SparkSession, path: str) -> DataFrame | None:
    """Per scan file: size, rows, ``ok``, ``corrupt`` or ``empty``, and whether it had a header row."""
    scans = stage_scans(spark, path)
    return None if scans is None else staged_scan_report(scans)


def load_summary(file_report: DataFrame) -> DataFrame:
    """Totals of a file report as one row."""
    totals = [
        F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows"),
        F.count("*").alias("n_files"),
        F.count_if(F.col("state") == "ok").alias("n_files_ok"),
        F.count_if(F.col("state") != "ok").alias("n_files_failed"),
    ]
    if "has_header" in file_report.columns:
        totals.append(F.count_if((F.col("state") == "ok") & ~F.col("has_header")).alias("n_files_without_header"))
    return file_report.agg(*totals)
