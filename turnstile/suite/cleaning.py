"""Queries on typing, cleaning, filtering and quality checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnstile.functions import parsing
from turnstile.operators.dedupe import duplicate_count, first_per_key
from turnstile.plans import quality, silver
from turnstile.suite.catalogue import query, rounded
from turnstile.suite.standins import Inputs


@query("SELECT * FROM contacts")
def clean_contacts(inputs: Inputs) -> DataFrame:
    return silver.contacts(inputs.raw_contacts())


@query("""
    SELECT count(*) AS n_contacts,
           count(*) FILTER (WHERE r.date_naissance <> '' AND c.date_naissance IS NULL) AS n_unparsed
    FROM raw_contacts r JOIN contacts c USING (ext_id)""")
def unparsed_birth_dates(inputs: Inputs) -> DataFrame:
    return silver.unparsed_birth_dates(inputs.raw_contacts())


@query("""
    SELECT CAST(coalesce(sum(written.n * empty.n), 0) AS BIGINT) AS n_unparsed
    FROM (SELECT ext_id, count_if(length(date_naissance) > 0) AS n FROM raw_contacts GROUP BY ext_id) AS written,
         (SELECT ext_id, count(*) - count(date_naissance) AS n FROM contacts GROUP BY ext_id) AS empty
    WHERE written.ext_id = empty.ext_id""")
def unparsed_after_cleaning(inputs: Inputs) -> DataFrame:
    raw = inputs.raw_contacts()
    return silver.unparsed_after_cleaning(raw, silver.contacts(raw))


@query("SELECT * FROM till")
def till_lines(inputs: Inputs) -> DataFrame:
    return silver.till_lines(inputs.raw_till())


@query("""
    SELECT count(*) AS n_lines, count(*) FILTER (WHERE etat_vente = 'ANNULEE') AS n_cancelled FROM till""")
def cancelled_till_lines(inputs: Inputs) -> DataFrame:
    return silver.cancelled_lines(silver.till_lines(inputs.raw_till()))


@query("""
    SELECT * EXCLUDE l_shipdate FROM tickets WHERE order_status_id = 1 AND NOT product_is_cancelled""")
def sold_tickets(inputs: Inputs) -> DataFrame:
    return silver.sold_tickets(inputs.tickets())


@query("""
    SELECT n_total, n_valid, round(n_valid * CAST(100.0 AS DOUBLE) / n_total, 9) AS kept_pct FROM (
        SELECT count(*) AS n_total,
               count(*) FILTER (WHERE order_status_id = 1 AND NOT product_is_cancelled) AS n_valid FROM tickets)""")
def kept_share(inputs: Inputs) -> DataFrame:
    return rounded(silver.kept_share(inputs.tickets()))


@query("""
    SELECT count(*) AS n_rows, count(DISTINCT bar_code) AS n_distinct,
           count(*) - count(DISTINCT bar_code) AS n_duplicates FROM tickets""")
def duplicate_bar_codes(inputs: Inputs) -> DataFrame:
    return duplicate_count(inputs.tickets(), "bar_code")


@query("""
    SELECT * FROM lineitem QUALIFY row_number() OVER (
        PARTITION BY l_orderkey, l_linenumber
        ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus,
                 l_shipdate) = 1""")
def one_line_per_number(inputs: Inputs) -> DataFrame:
    return first_per_key(inputs.table("lineitem"), ["l_orderkey", "l_linenumber"])


# Text in many notations from one order: the SQL and the Spark text are built alike.
@query("""
    SELECT o_orderkey, coalesce(try_cast(t AS DATE), CAST(try_strptime(t, '%d/%m/%Y') AS DATE),
                                CAST(try_strptime(t, '%d-%m-%Y') AS DATE)) AS parsed
    FROM (SELECT o_orderkey,
                 CASE o_orderpriority
                      WHEN '1-URGENT' THEN strftime(o_orderdate, '%Y/%m/%d')
                      WHEN '2-HIGH' THEN strftime(o_orderdate, '%d-%m-%Y')
                      WHEN '3-MEDIUM' THEN day(o_orderdate) || '/' || month(o_orderdate) || '/' || year(o_orderdate)
                      WHEN '5-LOW' THEN strftime(o_orderdate, '%Y-%m-%dT20:45:00')
                      ELSE CASE o_orderstatus WHEN 'F' THEN strftime(o_orderdate, '%Y-%m') WHEN 'O' THEN '2024-13-45'
                                ELSE '  ' || strftime(o_orderdate, '%Y-%m-%d') || ' ' END END AS t
          FROM orders)""")
def dates_in_many_notations(inputs: Inputs) -> DataFrame:
    day, level, state = F.col("o_orderdate"), F.col("o_orderpriority"), F.col("o_orderstatus")
    other = (
        F.when(state == "F", F.date_format(day, "yyyy-MM"))
        .when(state == "O", "2024-13-45")
        .otherwise(F.concat(F.lit("  "), F.date_format(day, "yyyy-MM-dd"), F.lit(" ")))
    )
    text = (
        F.when(level == "1-URGENT", F.date_format(day, "yyyy/MM/dd"))
        .when(level == "2-HIGH", F.date_format(day, "dd-MM-yyyy"))
        .when(level == "3-MEDIUM", F.date_format(day, "d/M/yyyy"))
        .when(level == "5-LOW", F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit("T20:45:00")))
        .otherwise(other)
    )
    parsed = parsing.flexible_date(text, parsing.DAY_FIRST_SLASH, parsing.DAY_FIRST_DASH)
    return inputs.table("orders").select("o_orderkey", parsed.alias("parsed"))


@query("""
    SELECT o_orderkey, try_cast(replace(t, ',', '.') AS DOUBLE) AS number, try_cast(t AS INTEGER) AS whole,
           try_cast(f AS BOOLEAN) AS flag
    FROM (SELECT o_orderkey,
                 CASE o_orderpriority
                      WHEN '1-URGENT' THEN replace(printf('%.2f', o_totalprice), '.', ',')
                      WHEN '2-HIGH' THEN printf('%.2f', o_totalprice)
                      WHEN '3-MEDIUM' THEN printf('%.0f', floor(o_totalprice)) || '.5'
                      WHEN '5-LOW' THEN ' ' || printf('%.0f', floor(o_totalprice)) || 'e1 '
                      ELSE 'n/a' END AS t,
                 CASE o_orderpriority WHEN '1-URGENT' THEN 'TRUE' WHEN '2-HIGH' THEN 'n' WHEN '3-MEDIUM' THEN '0'
                      WHEN '5-LOW' THEN 'on' ELSE '' END AS f
          FROM orders)""")
def numbers_in_many_notations(inputs: Inputs) -> DataFrame:
    price, level = F.col("o_totalprice"), F.col("o_orderpriority")
    floor = F.format_string("%d", F.floor(price))
    fixed = F.format_string("%.2f", price)
    text = (
        F.when(level == "1-URGENT", F.replace(fixed, F.lit("."), F.lit(",")))
        .when(level == "2-HIGH", fixed)
        .when(level == "3-MEDIUM", F.concat(floor, F.lit(".5")))
        .when(level == "5-LOW", F.concat(F.lit(" "), floor, F.lit("e1 ")))
        .otherwise("n/a")
    )
    flag = (
        F.when(level == "1-URGENT", "TRUE").when(level == "2-HIGH", "n").when(level == "3-MEDIUM", "0")
        .when(level == "5-LOW", "on").otherwise("")
    )
    return inputs.table("orders").select(
        "o_orderkey",
        parsing.comma_number(text).alias("number"),
        parsing.whole_number(text).alias("whole"),
        parsing.truth_value(flag).alias("flag"),
    )


# --- checks --------------------------------------------------------------------


def _check(name: str, value: str, bound: str, rule: str, table: str) -> str:
    return f"""
    SELECT '{name}' AS "check", CAST({value} AS DOUBLE) AS value, CAST({bound} AS DOUBLE) AS bound,
           {value} {rule} {bound} AS passed FROM {table}"""


@query(
    " UNION ALL ".join(
        [
            _check("match_id_unique", "count(*) - count(DISTINCT match_id)", "0", "<=", "fact"),
            _check("row_count_as_calendar", "abs(count(*) - (SELECT count(*) FROM calendar))", "0", "<=", "fact"),
            _check("fill_within_bounds", "count(*) FILTER (WHERE taux_remplissage < 0 OR taux_remplissage > 1.02)", "0", "<=", "fact"),
            _check("attendance_within_bounds", "count(*) FILTER (WHERE taux_presence > 1.05)", "0", "<=", "fact"),
            _check("capacity_positive", "count(*) FILTER (WHERE capacite_salle IS NULL OR capacite_salle <= 0)", "0", "<=", "fact"),
            _check("ranks_positive", "count(*) FILTER (WHERE rang_pbb_avant <= 0 OR rang_adversaire_avant <= 0)", "0", "<=", "fact"),
            _check("own_rank_varies", "count(DISTINCT rang_pbb_avant)", "1", ">", "fact"),
        ]
    )
)
def fact_checks(inputs: Inputs) -> DataFrame:
    return quality.fact_checks(inputs.fact(), inputs.calendar())


@query("""
    SELECT "check", round(value, 9) AS value, bound, value < bound AS passed FROM (
        SELECT 'till_duplicates' AS "check", (count(*) - count(DISTINCT ligne_id)) * CAST(1.0 AS DOUBLE) / count(*) AS value,
               CAST(0.01 AS DOUBLE) AS bound FROM till
        UNION ALL SELECT 'till_dates_unreadable', count(*) FILTER (WHERE date_vente IS NULL) * CAST(1.0 AS DOUBLE) / count(*),
               CAST(0.01 AS DOUBLE) FROM till)""")
def till_checks(inputs: Inputs) -> DataFrame:
    return rounded(quality.till_checks(silver.till_lines(inputs.raw_till())))


@query("""
    SELECT "check", round(value, 9) AS value, bound, value < bound AS passed FROM (
        SELECT 'scans_without_result' AS "check",
               count(*) FILTER (WHERE resultat IS NULL) * CAST(1.0 AS DOUBLE) / count(*) AS value,
               CAST(0.01 AS DOUBLE) AS bound FROM scans)""")
def scan_checks(inputs: Inputs) -> DataFrame:
    return rounded(quality.scan_checks(inputs.scans()))


@query(
    _check(
        "sold_tickets_within_all",
        "count(*) FILTER (WHERE order_status_id = 1 AND NOT product_is_cancelled) - count(*)",
        "0",
        "<=",
        "tickets",
    )
)
def ticket_checks(inputs: Inputs) -> DataFrame:
    return quality.ticket_checks(silver.sold_tickets(inputs.tickets()), inputs.tickets())


@query(_check("contact_key_unique", "count(*) - count(DISTINCT ext_id)", "0", "<=", "contacts"))
def contact_checks(inputs: Inputs) -> DataFrame:
    return quality.contact_checks(silver.contacts(inputs.raw_contacts()))
