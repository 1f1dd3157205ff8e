"""The fact table: one row per home match."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnstile import schemas
from turnstile.functions.calendar import day_token, kickoff_hour, weekday_name
from turnstile.functions.numbers import rate, round_money
from turnstile.functions.parsing import date_as_written, local_timestamp
from turnstile.operators.lookups import flag_dates_in_periods, hourly_readings
from turnstile.plans.silver import is_sold

# The columns of the fact table, in order.
FACT_COLUMNS = (
    "match_id",
    "date",
    "heure",
    "competition",
    "journee",
    "adversaire",
    "salle",
    "capacite_salle",
    "billets_vendus",
    "taux_remplissage",
    "revenu_billetterie",
    "prix_moyen_billet",
    "billets_abonnement",
    "billets_unite",
    "part_billets_unite",
    "billets_annules",
    "billets_rembourses",
    "billets_en_attente",
    "taux_annulation",
    "entrees_ok",
    "taux_presence",
    "rang_pbb_avant",
    "rang_adversaire_avant",
    "ecart_classement",
    "score_domicile",
    "score_exterieur",
    "victoire_pbb",
    "jour_semaine",
    "vacances_scolaires",
    "temperature",
    "precipitation",
)

# Highest attendance rate that is still plausible.
MAX_ATTENDANCE = 1.05


def _day(df: DataFrame, column: str) -> Column:
    """Date of a DATE, timestamp or timestamp-text column."""
    if isinstance(df.schema[column].dataType, T.StringType):
        return date_as_written(F.col(column))
    return F.col(column).cast("date")


TICKET_SUMS = ("n_tickets", "n_sold", "revenue", "n_priced", "n_cancelled", "n_refunded", "n_pending")


def tickets_by_session(tickets: DataFrame, product_types: DataFrame) -> DataFrame:
    """Counts and sums per session, sold and unsold together in one pass over all tickets.

    Runs before the tickets meet their sessions or codes: a session, or a product
    type, that holds a large part of all tickets is folded in every input task. Only
    one row per session and type meets the codes, and one per session the sessions.
    """
    codes = product_types.groupBy(F.col("id").alias("product_type_id")).agg(F.min("code").alias("code"))
    sold, status = is_sold(), F.col("order_status_id")
    by_type = tickets.groupBy("session_id", "product_type_id").agg(
        F.count("*").alias("n_tickets"),
        F.count_if(sold).alias("n_sold"),
        F.sum(F.when(sold, F.col("amount"))).alias("revenue"),
        F.count(F.when(sold, F.col("amount"))).alias("n_priced"),
        F.count_if(status == schemas.STATUS_CANCELLED).alias("n_cancelled"),
        F.count_if(status == schemas.STATUS_REFUNDED).alias("n_refunded"),
        F.count_if(status == schemas.STATUS_PENDING).alias("n_pending"),
    )

    def sold_with_code(code: str) -> Column:
        sold_here = F.when(F.col("n_sold") > 0, F.when(F.col("code") == code, F.col("n_sold")).otherwise(0))
        return F.sum(sold_here)

    return (
        by_type.join(codes, "product_type_id", "left")
        .groupBy("session_id")
        .agg(
            sold_with_code(schemas.CODE_SUBSCRIPTION).alias("n_subscription"),
            sold_with_code(schemas.CODE_SINGLE).alias("n_single"),
            *(F.sum(c).alias(c) for c in TICKET_SUMS),
        )
    )


def tickets_by_date(tickets: DataFrame, sessions: DataFrame, product_types: DataFrame) -> DataFrame:
    """Ticket measures per session date; measures of sold tickets are NULL when none was sold."""
    dated = sessions.select(F.col("id").alias("session_id"), _day(sessions, "start_at").alias("date_match"))
    return (
        tickets_by_session(tickets, product_types)
        .join(dated, "session_id")
        .groupBy("date_match")
        .agg(*(F.sum(c).alias(c) for c in (*TICKET_SUMS, "n_subscription", "n_single")))
        .select(
            "date_match",
            F.col("n_tickets").alias("billets_total"),
            F.nullif("n_sold", F.lit(0)).alias("billets_vendus"),
            F.col("revenue").alias("revenu_billetterie"),
            round_money(F.try_divide("revenue", "n_priced")).alias("prix_moyen_billet"),
            F.col("n_subscription").alias("billets_abonnement"),
            F.col("n_single").alias("billets_unite"),
            F.col("n_cancelled").alias("billets_annules"),
            F.col("n_refunded").alias("billets_rembourses"),
            F.col("n_pending").alias("billets_en_attente"),
        )
    )


def scans_by_token(scans: DataFrame) -> DataFrame:
    """Accepted scans per date token; a ticket scanned twice counts twice."""
    return scans.groupBy("date_fichier").agg(
        F.count_if(F.col("resultat") == schemas.SCAN_OK).alias("entrees_ok"),
    )


RESULT_VALUES = ("rang_pbb_avant", "rang_adversaire_avant", "score_domicile", "score_exterieur")


def home_results(results: DataFrame) -> DataFrame:
    """Ranks before the match and scores of home matches, one row per date.

    Of several results on a date the one with the fewest unknown values stays, then
    the smallest by ranks and scores; ``dates_with_several_results`` lists such dates.
    """
    unknown = sum((F.col(c).isNull().cast("int") for c in RESULT_VALUES), F.lit(0)).alias("unknown")
    return (
        results.filter(F.col("lieu") == schemas.HOME)
        .groupBy(F.col("date").alias("date_resultat"))
        .agg(F.min(F.struct(unknown, *RESULT_VALUES)).alias("r"))
        .select("date_resultat", *(F.col(f"r.{c}").alias(c) for c in RESULT_VALUES))
    )


def dates_with_several_results(results: DataFrame) -> DataFrame:
    """Dates with more than one home result, of which ``home_results`` keeps one."""
    home = results.filter(F.col("lieu") == schemas.HOME)
    return home.groupBy("date").agg(F.count("*").alias("n_results")).filter("n_results > 1")


def types_with_several_codes(product_types: DataFrame) -> DataFrame:
    """Product types with more than one code, of which the ticket counts use the smallest."""
    codes = product_types.groupBy(F.col("id").alias("product_type_id")).agg(F.countDistinct("code").alias("n_codes"))
    return codes.filter("n_codes > 1")


def fact_match(
    calendar: DataFrame,
    tickets: DataFrame,
    sessions: DataFrame,
    product_types: DataFrame,
    scans: DataFrame,
    results: DataFrame,
    holidays: DataFrame,
    weather: DataFrame,
    holiday_location: str = schemas.HOLIDAY_LOCATION,
) -> DataFrame:
    """One row per calendar row with ticket, scan, result, calendar and weather measures.

    ``tickets`` are all tickets, whatever their state. Each right side is reduced
    to one row per join key first, so joins never add rows, and Catalyst drops
    the joins whose columns a query does not use.
    """
    periods = holidays.filter(F.col("location") == holiday_location).select(
        _day(holidays, "start_date").alias("_first"), _day(holidays, "end_date").alias("_last")
    )
    hours = hourly_readings(
        weather.select(local_timestamp(F.col("heure")).alias("hour_ts"), "temperature", "precipitation")
    ).withColumnRenamed("hour_ts", "_hour")

    fact = (
        calendar.join(
            tickets_by_date(tickets, sessions, product_types), F.col("date_match") == F.col("date"), "left"
        )
        .join(scans_by_token(scans), F.col("date_fichier") == day_token(F.col("date")), "left")
        .join(home_results(results), F.col("date_resultat") == F.col("date"), "left")
        .join(hours, F.col("_hour") == kickoff_hour(F.col("date"), F.col("heure")), "left")
    )
    fact = flag_dates_in_periods(fact, "date", periods, "_first", "_last", "vacances_scolaires")
    return fact.withColumns(
        {
            "taux_remplissage": rate(F.col("billets_vendus"), F.col("capacite_salle"), 3),
            "part_billets_unite": rate(F.col("billets_unite"), F.col("billets_vendus"), 3),
            "taux_annulation": rate(F.col("billets_annules"), F.col("billets_total"), 3),
            "taux_presence": rate(F.col("entrees_ok"), F.col("billets_vendus"), 3),
            "ecart_classement": F.col("rang_adversaire_avant") - F.col("rang_pbb_avant"),
            "victoire_pbb": F.when(F.col("score_domicile") > F.col("score_exterieur"), 1).otherwise(0),
            "jour_semaine": weekday_name(F.col("date")),
        }
    ).select(*FACT_COLUMNS)


def dates_with_several_sessions(sessions: DataFrame) -> DataFrame:
    """Dates whose sessions are added together in the fact table."""
    return (
        sessions.groupBy(_day(sessions, "start_at").alias("date_match"))
        .agg(F.count("*").alias("n_sessions"))
        .filter(F.col("n_sessions") > 1)
    )


def completeness(fact: DataFrame) -> DataFrame:
    """Matches, and those without tickets, scans or ranks, as one row."""
    return fact.agg(
        F.count("*").alias("n_matchs"),
        F.count_if(F.col("billets_vendus").isNull()).alias("n_sans_billets"),
        F.count_if(F.col("entrees_ok").isNull()).alias("n_sans_scans"),
        F.count_if(F.col("rang_pbb_avant").isNull()).alias("n_sans_classement"),
    )


def implausible_attendance(fact: DataFrame, limit: float = MAX_ATTENDANCE) -> DataFrame:
    """Matches with more accepted scans than sold tickets can explain."""
    return fact.filter(F.col("taux_presence") > limit).select(
        "match_id", "date", "billets_vendus", "entrees_ok", "taux_presence"
    )
