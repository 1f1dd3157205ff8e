"""The whole run: raw drops to bronze, silver and gold tables, in order.

A stage that raises stops the run; what earlier stages wrote stays.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnstile import schemas
from turnstile.plans import gold, quality, silver
from turnstile.sources import csv_files, json_files, report
from turnstile.sources.staging import Staged, observed, seen_totals
from turnstile.sources.tables import copy_tables, ensure_schema, replace_table

# Where each source lies under the raw folder.
DATASET = "dataset"
SCANS = "sftp/scans/scan_*.csv"
ORDERS = "sftp/orders/ORDERS_*.json"
WEATHER = "plan_api/open_meteo/*.json"
HOLIDAYS = "plan_api/calendrier_scolaire/*.json"
TOWNS = "plan_api/population/communes_idf_population.json"
DISTRICTS = "plan_api/population/arrondissements_paris_population.json"
STREAKS = "plan_api/euroleague/E2025/streaks_r*.json"


@dataclass
class RunLog:
    """Tables written, with the rows of each, and optional sources that were absent.

    ``loads`` has the totals of each source whose files were staged, and ``unread`` the values of each CSV source
    that could not be converted. All counts come from the passes that wrote the rows.
    """

    written: list[str] = field(default_factory=list)
    absent: list[str] = field(default_factory=list)
    rows: dict[str, int] = field(default_factory=dict)
    loads: dict[str, dict[str, int]] = field(default_factory=dict)
    unread: dict[str, dict[str, int]] = field(default_factory=dict)

    def save(self, df: DataFrame | None, table: str) -> None:
        if df is None:
            self.absent.append(table)
        else:
            counted, seen = observed(df, f"rows of {table}", n_rows=F.count("*"))
            replace_table(counted, table)
            self.rows[table] = seen_totals(seen, "n_rows")["n_rows"]
            self.written.append(table)


def bronze(spark: SparkSession, raw: str, log: RunLog) -> None:
    """Raw tables. Contacts and till lines must exist; any other source may be absent.

    Every file is parsed once: CSV rows and what could not be converted in them are counted as they are written,
    and order drops and scans are staged, from which come their tables, the reference lists and the reports.
    """
    ensure_schema(spark, "bronze")
    for name, (file, schema) in schemas.NAMED_CSV_FILES.items():
        watched = csv_files.watched_csv(spark, f"{raw}/{DATASET}/{file}", schema)
        if watched is None:
            log.save(None, f"bronze.raw_{name}")
            continue
        rows, seen, declared = watched
        log.save(rows, f"bronze.raw_{name}")
        if schema:
            log.unread[name] = csv_files.unread_counts(seen, declared)
    scans = csv_files.stage_scans(spark, f"{raw}/{SCANS}")
    log.save(None if scans is None else csv_files.staged_scans(scans), "bronze.raw_scans")
    log.save(csv_files.read_contacts(spark, f"{raw}/{DATASET}/contacts.csv"), "bronze.raw_contacts")
    log.save(csv_files.read_till(spark, f"{raw}/{DATASET}/boutique_ventes_avoirs.csv"), "bronze.raw_boutique")

    log.save(json_files.read_weather(spark, f"{raw}/{WEATHER}"), "bronze.raw_meteo_horaire")
    log.save(json_files.read_holidays(spark, f"{raw}/{HOLIDAYS}"), "bronze.raw_vacances_scolaires")
    log.save(json_files.read_population(spark, f"{raw}/{TOWNS}", schemas.POPULATION), "bronze.raw_population_communes")
    log.save(json_files.read_population(spark, f"{raw}/{DISTRICTS}", schemas.POPULATION), "bronze.raw_population_arrondissements")
    log.save(json_files.read_streaks(spark, f"{raw}/{STREAKS}"), "bronze.raw_euroleague_streaks")

    orders = json_files.stage_order_drops(spark, f"{raw}/{ORDERS}")
    log.save(None if orders is None else json_files.staged_tickets(orders), "bronze.raw_billets")
    if orders is not None:
        for name, rows in json_files.staged_reference_lists(orders).items():
            log.save(rows, f"bronze.raw_billetterie_{name}")
    report_loads(spark, orders, scans, log)


def report_loads(spark: SparkSession, orders: Staged | None, scans: Staged | None, log: RunLog) -> None:
    """Reports on the files read: their state and rows, those left out, and values that could not be converted."""
    log.loads.update({kind: staged.totals for kind, staged in (("orders", orders), ("scans", scans)) if staged is not None})
    reports = [
        ("orders", None if orders is None else report.staged_order_report(orders)),
        ("scans", None if scans is None else report.staged_scan_report(scans)),
    ]
    parts = [
        df.select(F.lit(kind).alias("source"), "filename", F.col("length").cast("long").alias("length"), "state", F.col("n_rows").cast("long").alias("n_rows"))
        for kind, df in reports
        if df is not None
    ]
    files = reduce(DataFrame.unionAll, parts) if parts else None
    log.save(files, "bronze.load_report")
    log.save(None if files is None else spark.table("bronze.load_report").filter("state <> 'ok'"), "bronze.quarantine")
    unread = [(source, column, n) for source, counts in log.unread.items() for column, n in counts.items()]
    log.save(spark.createDataFrame(unread, "source string, column string, n_unread long") if unread else None, "bronze.unread_values")


def clean(spark: SparkSession, raw: str, log: RunLog) -> None:
    """Silver tables from the bronze tables."""
    ensure_schema(spark, "silver")
    log.save(silver.contacts(spark.table("bronze.raw_contacts")), "silver.contacts")
    log.save(silver.till_lines(spark.table("bronze.raw_boutique")), "silver.boutique_ventes")
    if spark.catalog.tableExists("bronze.raw_billets"):
        log.save(silver.sold_tickets(spark.table("bronze.raw_billets")), "silver.billets")
        log.save(spark.table("bronze.raw_billetterie_sessions"), "silver.sessions")
        log.save(spark.table("bronze.raw_billetterie_product_types"), "silver.product_types")
    else:
        log.absent.append("silver.billets")
    absent = copy_tables(spark, schemas.COPIED_TABLES, "bronze", "silver")
    log.absent.extend(f"silver.{name}" for name in absent)
    log.written.extend(f"silver.{name}" for name in schemas.COPIED_TABLES if name not in absent)


def build(spark: SparkSession, raw: str, log: RunLog) -> None:
    """The fact table from the silver and bronze tables."""
    ensure_schema(spark, "gold")
    fact = gold.fact_match(
        calendar=spark.table("silver.calendrier_matchs"),
        tickets=spark.table("bronze.raw_billets"),
        sessions=spark.table("silver.sessions"),
        product_types=spark.table("silver.product_types"),
        scans=spark.table("silver.scans"),
        results=spark.table("silver.resultats_matchs"),
        holidays=spark.table("bronze.raw_vacances_scolaires"),
        weather=spark.table("bronze.raw_meteo_horaire"),
    )
    log.save(fact, "gold.fact_match")
    checks = quality.all_checks(
        fact=spark.table("gold.fact_match"),
        calendar=spark.table("silver.calendrier_matchs"),
        till=spark.table("silver.boutique_ventes"),
        scans=spark.table("silver.scans"),
        sold=spark.table("silver.billets"),
        raw=spark.table("bronze.raw_billets"),
        contacts=spark.table("silver.contacts"),
    )
    log.save(checks, "gold.quality_report")
    log.save(gold.dates_with_several_results(spark.table("silver.resultats_matchs")), "gold.dates_with_several_results")
    log.save(gold.types_with_several_codes(spark.table("silver.product_types")), "gold.types_with_several_codes")


STAGES: tuple[Callable[[SparkSession, str, RunLog], None], ...] = (bronze, clean, build)


def run(spark: SparkSession, raw: str) -> RunLog:
    """All stages over the raw folder."""
    log = RunLog()
    for stage in STAGES:
        stage(spark, raw, log)
    return log
