"""Rules the tables must keep, as report rows: check, value, bound, passed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnstile.functions.numbers import ratio
from turnstile.plans.gold import MAX_ATTENDANCE

# Tolerances of the checks.
MAX_FILL = 1.02
MAX_DEFECT_SHARE = 0.01


def _report(totals: DataFrame, checks: list[tuple[str, Column, float, str]]) -> DataFrame:
    """One row per check from a one-row table of totals; a NULL value does not pass."""

    def passed(value: Column, bound: float, rule: str) -> Column:
        tests = {"at_most": value <= bound, "below": value < bound, "above": value > bound}
        return F.coalesce(tests[rule], F.lit(False))

    rows = [
        F.struct(
            F.lit(name).alias("check"),
            value.cast("double").alias("value"),
            F.lit(float(bound)).alias("bound"),
            passed(value, bound, rule).alias("passed"),
        )
        for name, value, bound, rule in checks
    ]
    return totals.select(F.inline(F.array(*rows)))


def fact_checks(fact: DataFrame, calendar: DataFrame) -> DataFrame:
    """Uniqueness, row count, ranges and leakage checks of the fact table, in one pass over it."""
    fill, attendance, capacity = (F.col(c) for c in ("taux_remplissage", "taux_presence", "capacite_salle"))
    totals = fact.agg(
        F.count("*").alias("n"),
        F.count_distinct("match_id").alias("n_ids"),
        F.count_if((fill < 0) | (fill > MAX_FILL)).alias("n_fill"),
        F.count_if(attendance > MAX_ATTENDANCE).alias("n_attendance"),
        F.count_if(capacity.isNull() | (capacity <= 0)).alias("n_capacity"),
        F.count_if((F.col("rang_pbb_avant") <= 0) | (F.col("rang_adversaire_avant") <= 0)).alias("n_ranks"),
        F.count_distinct("rang_pbb_avant").alias("n_own_ranks"),
    ).withColumn("n_calendar", calendar.agg(F.count("*")).scalar())
    return _report(
        totals,
        [
            ("match_id_unique", F.col("n") - F.col("n_ids"), 0, "at_most"),
            ("row_count_as_calendar", F.abs(F.col("n") - F.col("n_calendar")), 0, "at_most"),
            ("fill_within_bounds", F.col("n_fill"), 0, "at_most"),
            ("attendance_within_bounds", F.col("n_attendance"), 0, "at_most"),
            ("capacity_positive", F.col("n_capacity"), 0, "at_most"),
            ("ranks_positive", F.col("n_ranks"), 0, "at_most"),
            ("own_rank_varies", F.col("n_own_ranks"), 1, "above"),
        ],
    )


def _share(part: Column, whole: Column) -> Column:
    return F.coalesce(ratio(part, whole), F.lit(0.0))


def till_checks(till: DataFrame) -> DataFrame:
    """Repeated line numbers and unreadable dates stay rare.

    Lines are folded to one row per number first; the number of distinct keys
    is then the number of those rows.
    """
    totals = (
        till.groupBy("ligne_id")
        .agg(F.count("*").alias("n"), F.count_if(F.col("date_vente").isNull()).alias("undated"))
        .agg(F.sum("n").alias("n"), F.count("ligne_id").alias("n_ids"), F.sum("undated").alias("n_undated"))
    )
    return _report(
        totals,
        [
            ("till_duplicates", _share(F.col("n") - F.col("n_ids"), F.col("n")), MAX_DEFECT_SHARE, "below"),
            ("till_dates_unreadable", _share(F.col("n_undated"), F.col("n")), MAX_DEFECT_SHARE, "below"),
        ],
    )


def scan_checks(scans: DataFrame) -> DataFrame:
    """Scans without a result stay rare."""
    totals = scans.agg(F.count("*").alias("n"), F.count_if(F.col("resultat").isNull()).alias("n_null"))
    return _report(
        totals, [("scans_without_result", _share(F.col("n_null"), F.col("n")), MAX_DEFECT_SHARE, "below")]
    )


def ticket_checks(sold: DataFrame, raw: DataFrame) -> DataFrame:
    """No more sold tickets than tickets."""
    totals = sold.agg(F.count("*").alias("n_sold")).withColumn("n_raw", raw.agg(F.count("*")).scalar())
    return _report(totals, [("sold_tickets_within_all", F.col("n_sold") - F.col("n_raw"), 0, "at_most")])


def contact_checks(contacts: DataFrame) -> DataFrame:
    """Contact keys are unique."""
    totals = contacts.groupBy("ext_id").agg(F.count("*").alias("n")).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("ext_id").alias("n_ids")
    )
    return _report(totals, [("contact_key_unique", F.col("n") - F.col("n_ids"), 0, "at_most")])


def all_checks(
    fact: DataFrame, calendar: DataFrame, till: DataFrame, scans: DataFrame,
    sold: DataFrame, raw: DataFrame, contacts: DataFrame,
) -> DataFrame:
    """Every check in one report."""
    parts = [
        fact_checks(fact, calendar),
        till_checks(till),
        scan_checks(scans),
        ticket_checks(sold, raw),
        contact_checks(contacts),
    ]
    report = parts[0]
    for part in parts[1:]:
        report = report.unionAll(part)
    return report
