"""Queries on files: Spark writes the given tables as drops, the readers read them back."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnstile import schemas
from turnstile.operators.lookups import hourly_readings
from turnstile.plans import dashboard, silver
from turnstile.session import scratch_path, written_copy
from turnstile.sources import csv_files, json_files, report, tables
from turnstile.suite.catalogue import query, rounded
from turnstile.suite.standins import Inputs

# The shipping year whose drops are cut short, so that they cannot be read.
CUT_YEAR = 1998

# Drops repeat every field's name with every ticket, and are written compressed.
PACKED = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}


def _order_drops(inputs: Inputs) -> str:
    """Folder of order drops with one document per line."""
    path = scratch_path(inputs.spark, "orders")
    inputs.order_documents().select("orders").write.options(**PACKED).json(path)
    return path


def _stopping_short(year: Column) -> Column:
    """Documents as text; those of one year stop in mid-value."""
    text = F.to_json(F.struct("orders"))
    return F.when(year == CUT_YEAR, F.substring(text, F.lit(1), F.length(text) - 25)).otherwise(text)


def _cut_order_drops(inputs: Inputs) -> str:
    """The same in one folder per year, where the documents of one year stop in mid-value."""
    path = scratch_path(inputs.spark, "cut-orders")
    documents = inputs.order_documents(arranged=lambda drops: drops.hint("rebalance", "year").sortWithinPartitions("year"))
    text = documents.select("year", _stopping_short(F.col("year")).alias("value"))
    text.write.partitionBy("year").options(**PACKED).text(path)
    return f"{path}/year=*"


def _monthly_order_drops(inputs: Inputs) -> str:
    """One file per month, those of one year stopping in mid-value, and an empty file."""
    path = scratch_path(inputs.spark, "monthly-orders")
    documents = inputs.order_documents(
        "yyyyMM", "month", lambda drops: drops.repartition("month").sortWithinPartitions("month")
    )
    text = documents.select("month", _stopping_short(F.floor(F.col("month") / 100)).alias("value"))
    text.write.partitionBy("month").options(**PACKED).text(path)
    _write_empty_file(inputs, f"{path}/month=0")
    return f"{path}/month=*"


def _write_empty_file(inputs: Inputs, path: str) -> None:
    inputs.spark.createDataFrame([], "value string").coalesce(1).write.text(path)


@query("""
    SELECT l_orderkey AS order_id, l_orderkey % 97 AS event_id,
           CASE WHEN l_returnflag = 'N' THEN 1 WHEN l_returnflag = 'A' THEN 8
                WHEN l_linestatus = 'F' THEN 9 ELSE 4 END AS order_status_id,
           CAST(l_orderkey % 5 AS INTEGER) AS channel_id, 'C' || l_orderkey AS ext_id, CAST(made AS VARCHAR) AS order_creation_date,
           CASE WHEN l_orderkey % 3 > 0 THEN made || 'T10:00:00' END AS order_validation_date,
           CASE WHEN l_orderkey % 7 > 0 THEN l_orderkey % 2 = 0 END AS is_secondary_market,
           l_orderkey * 10 + l_linenumber AS order_product_id, l_linenumber AS product_type_id,
           CASE WHEN l_discount > 0 THEN l_discount > 0.08 END AS product_is_cancelled,
           CAST(l_linenumber AS DOUBLE) * 1.5 AS product_amount_inc_tax, l_partkey AS ticket_id,
           l_orderkey || '-' || l_linenumber AS bar_code, CAST(l_linenumber % 3 AS INTEGER) AS category_id, l_orderkey AS session_id,
           l_extendedprice AS amount, CAST(l_linenumber % 2 AS INTEGER) AS ticket_status_id, 'G' || l_linenumber AS seat_gate,
           l_returnflag AS seat_stand, CASE WHEN l_linestatus = 'F' THEN 'F' END AS seat_row,
           CAST(l_suppkey AS VARCHAR) AS seat_number, '.json' AS filename
    FROM (SELECT *, CAST(DATE '2020-01-01' + CAST(l_orderkey % 1000 AS INTEGER) AS DATE) AS made FROM lineitem)""")
def nested_tickets(inputs: Inputs) -> DataFrame:
    """All 23 columns; of the file name, which Spark chooses, the ending, without that of the compression."""
    tickets = json_files.read_tickets(inputs.spark, _order_drops(inputs), one_document_per_file=False)
    return tickets.withColumn("filename", F.substring(F.regexp_replace("filename", r"\.gz$", ""), -5, 5))


@query(f"""
    SELECT order_status_id, count(*) AS n_tickets, round(sum(amount), 2) AS amount
    FROM tickets WHERE year(l_shipdate) <> {CUT_YEAR} GROUP BY 1""")
def tickets_without_cut_files(inputs: Inputs) -> DataFrame:
    tickets = json_files.read_tickets(inputs.spark, _cut_order_drops(inputs), one_document_per_file=False)
    return rounded(
        tickets.groupBy("order_status_id").agg(F.count("*").alias("n_tickets"), F.sum("amount").alias("amount")), 2
    )


@query(f"""
    SELECT count(*) FILTER (WHERE sound) AS n_rows, count(DISTINCT month) + 1 AS n_files,
           count(DISTINCT month) FILTER (WHERE sound) AS n_files_ok,
           count(DISTINCT month) FILTER (WHERE NOT sound) + 1 AS n_files_failed
    FROM (SELECT year(l_shipdate) <> {CUT_YEAR} AS sound, date_trunc('month', l_shipdate) AS month FROM lineitem)""")
def order_load_summary(inputs: Inputs) -> DataFrame:
    """Totals over the files of staged drops: whole ones, malformed ones and an empty one."""
    files = report.order_file_report(inputs.spark, _monthly_order_drops(inputs), one_document_per_file=False)
    return report.load_summary(files)


@query("""
    SELECT 'product_types' AS list, CAST(r_regionkey AS BIGINT) AS id, r_name AS label FROM region
    UNION ALL SELECT 'sessions', n_nationkey, n_name FROM nation
    UNION ALL SELECT 'order_status', CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 4 ELSE 8 END, o_orderstatus
    FROM orders GROUP BY ALL""")
def reference_lists(inputs: Inputs) -> DataFrame:
    """Lists repeated in every drop, read from the first drop only."""
    path = scratch_path(inputs.spark, "lists")
    state = F.col("o_orderstatus")
    status_id = F.when(state == "F", 1).when(state == "O", 4).otherwise(8)
    included = (
        inputs.table("region")
        .agg(F.collect_list(F.struct(F.col("r_regionkey").alias("id"), F.col("r_name").alias("code"))).alias("product_types"))
        .withColumn(
            "sessions",
            inputs.table("nation")
            .agg(F.collect_list(F.struct(F.col("n_nationkey").alias("id"), F.col("n_name").alias("start_at"))))
            .scalar(),
        )
        .withColumn(
            "order_status",
            inputs.table("orders")
            .select(status_id.alias("id"), state.alias("name"))
            .distinct()
            .agg(F.collect_list(F.struct("id", "name")))
            .scalar(),
        )
    )
    document = included.select(F.struct("sessions", "product_types", "order_status").alias("included"))
    document.write.json(path)
    lists = json_files.read_reference_lists(inputs.spark, f"{path}/*.json", one_document_per_file=False)
    labels = {"sessions": "start_at", "product_types": "code", "order_status": "name"}
    parts = [
        rows.select(F.lit(name).alias("list"), F.col("id").cast("bigint").alias("id"), F.col(labels[name]).alias("label"))
        for name, rows in lists.items()
    ]
    return parts[0].unionAll(parts[1]).unionAll(parts[2])


@query("""
    SELECT strftime(hour_ts, '%Y-%m-%dT%H:00') AS heure, temperature, precipitation FROM weather_hour""")
def weather_from_lists(inputs: Inputs) -> DataFrame:
    """One document per day with parallel hourly lists, then rows again."""
    path = scratch_path(inputs.spark, "weather")
    hours = hourly_readings(inputs.weather().withColumnRenamed("heure", "hour_ts")).withColumnRenamed("hour_ts", "heure")
    days = hours.groupBy(F.substring("heure", 1, 10).alias("day")).agg(
        F.array_sort(F.collect_list(F.struct("heure", "temperature", "precipitation"))).alias("h")
    )
    days.select(
        F.struct(
            F.col("h.heure").alias("time"),
            F.col("h.temperature").alias("temperature_2m"),
            F.col("h.precipitation").alias("precipitation"),
        ).alias("hourly")
    ).write.json(path)
    documents = inputs.spark.read.schema(schemas.WEATHER).json(path)
    return json_files.unzip_weather(documents).select("heure", "temperature", "precipitation")


@query("SELECT start_date, end_date, location, CASE WHEN location = 'Paris' THEN 'zone C' END AS zone FROM holidays")
def holidays_from_lists(inputs: Inputs) -> DataFrame:
    """Two folders whose records have different fields, merged by name."""
    path = scratch_path(inputs.spark, "holidays")
    periods = inputs.holidays().withColumn("zone", F.lit("zone C"))
    record = {"paris": F.struct("start_date", "end_date", "location", "zone"), "other": F.struct("location", "end_date", "start_date")}
    for part, fields in record.items():
        chosen = periods.filter((F.col("location") == "Paris") == F.lit(part == "paris"))
        chosen.select(F.array(fields).alias("results")).write.json(f"{path}/{part}")
    documents = json_files.read_holidays(inputs.spark, f"{path}/*/*.json", one_document_per_file=False)
    return documents.select("start_date", "end_date", "location", "zone")


@query("SELECT nom, array_to_string(codes, ' ') AS codes, population FROM towns")
def population_records(inputs: Inputs) -> DataFrame:
    path = scratch_path(inputs.spark, "population")
    inputs.towns().write.json(path)
    records = json_files.read_population(inputs.spark, path, schemas.POPULATION, one_document_per_file=False)
    return records.select("nom", F.array_join("codesPostaux", " ").alias("codes"), "population")


@query("""
    SELECT CAST(round AS INTEGER) AS round, CAST(team AS BIGINT) AS team, CASE WHEN round > 3 THEN losses END AS losses,
           CASE WHEN round % 2 = 0 THEN CAST(wins AS DOUBLE) + 0.5 ELSE wins END AS wins FROM teams""")
def round_streaks(inputs: Inputs) -> DataFrame:
    """One folder per round; a document holds the teams, whose fields and number types depend on the round."""
    path = scratch_path(inputs.spark, "streaks")
    teams = inputs.monthly_teams()
    whole, half = F.col("wins"), (F.col("wins") + 0.5).alias("wins")
    for part, rows, fields in (
        ("first", teams.filter("round <= 3 AND round % 2 = 1"), ["team", whole]),
        ("early", teams.filter("round <= 3 AND round % 2 = 0"), ["team", half]),
        ("even", teams.filter("round > 3 AND round % 2 = 0"), ["losses", "team", half]),
        ("odd", teams.filter("round > 3 AND round % 2 = 1"), [whole, "team", "losses"]),
    ):
        rows.groupBy("round").agg(F.collect_list(F.struct(*fields)).alias("teams")).write.partitionBy("round").json(f"{path}/{part}")
    return json_files.read_streaks(
        inputs.spark, f"{path}/*/round=*", name_pattern=r"round=(\d+)/", one_document_per_file=False
    )


@query("""
    SELECT CAST(round AS INTEGER) AS round, team, CASE WHEN round = 9 THEN wins + 0.25 ELSE CAST(wins AS DOUBLE) END AS wins,
           CASE WHEN round > 6 THEN losses END AS losses FROM teams""")
def round_standings(inputs: Inputs) -> DataFrame:
    """Landed Parquet; the first rounds lack a column that later ones have, and number types change from round to round."""
    path = scratch_path(inputs.spark, "standings")
    teams = inputs.monthly_teams()
    wins, losses = F.col("wins"), F.col("losses")
    for part, rows, columns in (
        ("early", "round <= 6", {"wins": wins.cast("int")}),
        ("late", "round IN (7, 8)", {"wins": wins, "losses": losses.cast("int")}),
        ("later", "round = 9", {"wins": wins + 0.25, "losses": losses}),
        ("latest", "round > 9", {"losses": losses, "wins": wins}),
    ):
        landed = teams.filter(rows).select("round", "team", *(c.alias(name) for name, c in columns.items()))
        landed.write.partitionBy("round").parquet(f"{path}/{part}")
    landed = json_files.read_standings(inputs.spark, f"{path}/*/round=*", name_pattern=r"round=(\d+)/")
    return landed.select("round", "team", "wins", "losses")


@query("""
    SELECT strftime(l_shipdate, '%Y%m') AS date_fichier, count(*) AS n_scans,
           count(*) FILTER (WHERE l_linestatus = 'F') AS n_ok,
           count(CASE WHEN l_linestatus <> 'F' AND l_tax = 0 THEN 1 END) AS n_sans_resultat,
           min(l_shipdate) AS first_scan
    FROM lineitem GROUP BY 1""")
def scan_files(inputs: Inputs) -> DataFrame:
    """Files with and without a header row under one folder, told apart by their content."""
    scans = csv_files.read_scans(inputs.spark, _scan_drops(inputs), token_pattern=r"scan=([^/]+)/")
    return scans.groupBy("date_fichier").agg(
        F.count("*").alias("n_scans"),
        F.count_if(F.col("resultat") == "OK").alias("n_ok"),
        F.count_if(F.col("resultat").isNull()).alias("n_sans_resultat"),
        F.min("scan_ts_utc").alias("first_scan"),
    )


@query("""
    SELECT count(*) AS n_rows, count(DISTINCT month) + count(DISTINCT other_month) + 2 AS n_files,
           count(DISTINCT month) + count(DISTINCT other_month) AS n_files_ok, CAST(2 AS BIGINT) AS n_files_failed,
           count(DISTINCT other_month) AS n_files_without_header
    FROM (SELECT CASE WHEN l_linestatus = 'F' THEN date_trunc('month', l_shipdate) END AS month,
                 CASE WHEN l_linestatus <> 'F' THEN date_trunc('month', l_shipdate) END AS other_month FROM lineitem)""")
def scan_load_summary(inputs: Inputs) -> DataFrame:
    """Totals over scan files with and without a header row, a malformed one and an empty one."""
    path = _scan_drops(inputs, one_file_a_month=True)
    folder = path.removesuffix("/header=*/scan=*")
    line = F.concat_ws(",", "n_nationkey", F.lit("2020-01-01"), "n_name", "n_regionkey", F.lit("T"), F.lit("OK"))
    short = F.when(F.col("n_nationkey") == 7, F.col("n_name"))
    malformed = inputs.table("nation").select(F.coalesce(short, line).alias("value"))
    malformed.coalesce(1).write.text(f"{folder}/header=none/scan=malformed")
    _write_empty_file(inputs, f"{folder}/header=none/scan=empty")
    return report.load_summary(report.scan_file_report(inputs.spark, path))


def _scan_drops(inputs: Inputs, one_file_a_month: bool = False) -> str:
    """Scan CSV per month: accepted scans with a header row, the others without."""
    path = scratch_path(inputs.spark, "scans")
    line = F.col("l_linestatus")
    scans = inputs.table("lineitem").select(
        F.date_format("l_shipdate", "yyyyMM").alias("scan"),
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("barcode"),
        F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss").alias("scan_ts_utc"),
        F.concat(F.lit("P"), "l_suppkey").alias("portique"),
        F.col("l_partkey").cast("string").alias("ext_id"),
        F.col("l_returnflag").alias("type_billet"),
        F.when(line == "F", "OK").when(F.col("l_tax") > 0, "KO").alias("resultat"),
    )
    for header in (True, False):
        chosen = scans.filter((F.coalesce("resultat", F.lit("")) == "OK") == F.lit(header))
        dealt = chosen.repartition("scan") if one_file_a_month else chosen.hint("rebalance", "scan")
        writer = dealt.write.option("header", header).partitionBy("scan")
        writer.csv(f"{path}/header={str(header).lower()}")
    return f"{path}/header=*/scan=*"


@query("""
    SELECT match_id, date, heure, competition, journee, adversaire, salle, capacite_salle FROM calendar""")
def named_csv(inputs: Inputs) -> DataFrame:
    """Typed CSV; the file's columns are in another order than the schema's."""
    path = scratch_path(inputs.spark, "calendar")
    calendar = inputs.calendar()
    calendar.select(*reversed(calendar.columns)).write.option("header", True).csv(path)
    return csv_files.read_named_csv(inputs.spark, path, schemas.CALENDAR).select(calendar.columns)


@query("""
    SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer""")
def inferred_csv(inputs: Inputs) -> DataFrame:
    """Types found from all rows of the file."""
    path = scratch_path(inputs.spark, "customers")
    inputs.table("customer").write.option("header", True).csv(path)
    return csv_files.read_named_csv(inputs.spark, path).withColumn("c_custkey", F.col("c_custkey").cast("bigint"))


@query(f"""
    SELECT {", ".join(f"nullif({name}, '') AS {source}" for source, name in silver.TILL_NAMES.items())} FROM raw_till""")
def till_csv(inputs: Inputs) -> DataFrame:
    """Semicolons, all text, decimal commas untouched; all 21 columns."""
    path = scratch_path(inputs.spark, "till")
    inputs.raw_till().write.option("header", True).option("sep", ";").option("emptyValue", "").csv(path)
    return csv_files.read_till(inputs.spark, path)


@query("SELECT * REPLACE (nullif(date_naissance, '') AS date_naissance) FROM raw_contacts")
def contacts_csv(inputs: Inputs) -> DataFrame:
    """All 13 columns, with separators and quotes in some."""
    path = scratch_path(inputs.spark, "contacts")
    writer = inputs.raw_contacts().write.option("header", True).option("emptyValue", "").option("escape", '"')
    writer.option("ignoreTrailingWhiteSpace", False).csv(path)
    return csv_files.read_contacts(inputs.spark, path)


@query("SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
def replaced_and_appended_files(inputs: Inputs) -> DataFrame:
    """Replace twice, then append what is missing."""
    path = scratch_path(inputs.spark, "orders-table")
    orders = inputs.table("orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    tables.replace_files(orders, path)
    tables.replace_files(orders.filter("o_orderstatus = 'F'"), path)
    tables.append_files(orders.filter("o_orderstatus <> 'F'"), path)
    return inputs.spark.read.parquet(path)


_EXPORTED = """
    SELECT * REPLACE (strftime(date, '%Y-%m-%d') AS date, round(revenu_billetterie, 2) AS revenu_billetterie,
                      round(precipitation, 9) AS precipitation) FROM fact"""


@query(_EXPORTED)
def exported_records(inputs: Inputs) -> DataFrame:
    """All 31 columns as JSON records with ISO dates and nullable counts, in date order, read back by name."""
    path = scratch_path(inputs.spark, "records")
    fact = tables.by_date(inputs.fact())
    tables.write_records(fact, path)
    exported = inputs.spark.read.schema(tables.as_records(fact).schema).json(path)
    return rounded(exported, revenu_billetterie=2)


@query(_EXPORTED)
def records_as_text(inputs: Inputs) -> DataFrame:
    """One JSON text per match, NULL fields written out, parsed again."""
    fact = inputs.fact()
    schema = tables.as_records(fact).schema
    records = tables.json_records(fact)
    whole = F.size(F.json_object_keys("record")) == len(schema)
    parsed = records.filter(whole).select(F.from_json("record", schema).alias("r")).select("r.*")
    return rounded(parsed, revenu_billetterie=2)


@query("""
    SELECT 'conversion' AS feed, source || '/' || medium AS name, sessions AS n, taux_conversion_pct AS first, CAST(NULL AS DOUBLE) AS second
    FROM conversion
    UNION ALL SELECT 'campaigns', canal, CAST(delivered AS BIGINT), round(100.0 * opened / nullif(delivered, 0), 1), round(100.0 * clicked / nullif(opened, 0), 1)
    FROM (SELECT canal, count_if(evenement = 'DELIVRE') AS delivered, count_if(evenement = 'OUVERTURE') AS opened,
                 count_if(evenement = 'CLIC') AS clicked FROM campaign_events GROUP BY canal)
    UNION ALL SELECT 'matches', match_id || ' ' || strftime(date, '%Y-%m-%d'), billets_vendus, taux_remplissage, entrees_ok FROM fact""")
def dashboard_feed(inputs: Inputs) -> DataFrame:
    """The feed's three record sets as they were written, side by side."""
    path = scratch_path(inputs.spark, "feed")
    feed = dashboard.write_feed(inputs.fact(), inputs.web_sessions(), inputs.campaign_events(), path)
    read = {name: inputs.spark.read.schema(schema).json(f"{path}/{name}") for name, schema in feed.items()}

    def part(name: str, label: Column, n: str, first: str, second: Column) -> DataFrame:
        return read[name].select(
            F.lit(name).alias("feed"), label.alias("name"), F.col(n).alias("n"), F.col(first).alias("first"), second.cast("double").alias("second")
        )

    parts = [
        part("conversion", F.concat_ws("/", "source", "medium"), "sessions", "taux_conversion_pct", F.lit(None)),
        part("campaigns", F.col("canal"), "delivres", "taux_ouverture_pct", F.col("taux_clic_pct")),
        part("matches", F.concat_ws(" ", "match_id", "date"), "billets_vendus", "taux_remplissage", F.col("entrees_ok")),
    ]
    return reduce(DataFrame.unionAll, parts)


@query("""
    SELECT strftime(hour_ts, '%Y-%m-%dT%H:00') AS heure, temperature, precipitation FROM weather_hour
    WHERE year(hour_ts) = (SELECT min(year(hour_ts)) FROM weather_hour)""")
def weather_of_the_first_file(inputs: Inputs) -> DataFrame:
    """One file per year; the first by name counts, an empty one before it does not."""
    path = scratch_path(inputs.spark, "weather-files")
    hours = hourly_readings(inputs.weather().withColumnRenamed("heure", "hour_ts")).withColumnRenamed("hour_ts", "heure")
    years = hours.groupBy(F.substring("heure", 1, 4).alias("year")).agg(
        F.array_sort(F.collect_list(F.struct("heure", "temperature", "precipitation"))).alias("h")  # hours of a year
    )
    lists = F.struct(
        F.col("h.heure").alias("time"), F.col("h.temperature").alias("temperature_2m"), F.col("h.precipitation").alias("precipitation")
    )
    years.select("year", lists.alias("hourly")).repartition("year").write.partitionBy("year").json(path)
    _write_empty_file(inputs, f"{path}/year=0000")
    return json_files.read_weather(inputs.spark, f"{path}/year=*/*").select("heure", "temperature", "precipitation")


@query("SELECT o_orderkey, o_orderstatus, o_totalprice, CASE WHEN o_orderstatus = 'F' THEN o_orderpriority END AS priority FROM orders")
def appended_batches(inputs: Inputs) -> DataFrame:
    """One batch per order state: one run twice, one with a column more, and one cut off before it was committed."""
    path = scratch_path(inputs.spark, "batches")
    orders = inputs.table("orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    with_priority = inputs.table("orders").select(*orders.columns, F.col("o_orderpriority").alias("priority"))
    tables.append_batch(with_priority.filter("o_orderstatus = 'F'"), path, "F")
    for _ in range(2):
        tables.append_batch(orders.filter("o_orderstatus = 'O'"), path, "O")
    orders.filter("o_orderkey % 2 = 0").write.parquet(f"{path}/data/{tables.BATCH}=P")
    tables.append_batch(orders.filter("o_orderstatus NOT IN ('F', 'O')"), path, "P")
    orders.write.parquet(f"{path}/data/{tables.BATCH}=cut-off")
    return tables.read_batches(inputs.spark, path)


@query("""
    SELECT 'orders' AS name, o_orderkey AS id, o_totalprice AS amount FROM orders
    UNION ALL SELECT 'customer', c_custkey, c_acctbal FROM customer
    UNION ALL SELECT 'supplier', s_suppkey, NULL FROM supplier
    UNION ALL SELECT 'absent: part', NULL, NULL
    UNION ALL SELECT 'absent: file', NULL, NULL""")
def catalogue_tables(inputs: Inputs) -> DataFrame:
    """Tables by name: replaced, appended to in batches that are repeated, filled up by name, copied; an absent table and file are named."""
    spark, home = inputs.spark, uuid.uuid4().hex
    bronze, silver = f"bronze_{home}", f"silver_{home}"
    tables.ensure_schema(spark, bronze)
    tables.ensure_schema(spark, silver)
    orders = inputs.table("orders").select(F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("amount"))
    customers = inputs.table("customer").select(F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("amount"))
    tables.replace_table(customers, f"{bronze}.raw_orders")
    tables.replace_table(orders.filter("id % 4 < 2"), f"{bronze}.raw_orders")
    tables.append_table(orders.filter("id % 4 >= 2"), f"{bronze}.raw_orders")
    for batch in (0, 1, 1, 0):
        tables.append_table(customers.filter(F.col("id") % 2 == batch), f"{bronze}.raw_customer", batch=str(batch))
    suppliers = inputs.table("supplier").select(F.col("s_suppkey").alias("id"))
    tables.replace_table(customers.limit(0), f"{bronze}.raw_supplier")
    tables.append_table(suppliers, f"{bronze}.raw_supplier")
    names = ("orders", "customer", "supplier", "part")
    absent = tables.copy_tables(spark, names, bronze, silver)
    if csv_files.read_named_csv(spark, f"{scratch_path(spark, 'nowhere')}/absent.csv") is None:
        absent.append("file")
    copies = [spark.table(f"{silver}.{n}").select(F.lit(n).alias("name"), "id", "amount") for n in names if n not in absent]
    missing = spark.createDataFrame([(f"absent: {n}", None, None) for n in absent], "name string, id long, amount double")
    found = written_copy(reduce(DataFrame.unionAll, [*copies, missing]), "catalogue")
    for schema in (bronze, silver):
        spark.sql(f"DROP DATABASE {schema} CASCADE")
    return found
