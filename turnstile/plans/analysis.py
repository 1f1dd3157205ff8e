"""Questions asked of the fact table and of the marketing tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnstile import schemas
from turnstile.functions.calendar import WEEKDAYS, clock_minutes, time_slot, weekday_position
from turnstile.functions.labels import channel_label, high_conversion, result_label
from turnstile.functions.numbers import percent, percent_label, ratio, round_half_even
from turnstile.operators.lookups import unmatched_keys
from turnstile.operators.stats import cross_counts, group_summary, least_squares, pearson

FILL = "taux_remplissage"

# Context shown next to the weakest matches.
CONTEXT = (
    "match_id",
    "date",
    "adversaire",
    "competition",
    "taux_remplissage",
    "rang_adversaire_avant",
    "jour_semaine",
    "vacances_scolaires",
    "temperature",
)

# Sizes of the two top lists and the channel size limit.
WEAKEST = 8
TOP_ZONES = 15
MIN_SESSIONS = 1000


def with_kickoff(fact: DataFrame) -> DataFrame:
    """Add minutes since midnight and the time slot of the kick-off."""
    return fact.withColumns(
        {"heure_minutes": clock_minutes(F.col("heure")), "creneau": time_slot(F.col("heure"))}
    )


def with_rain(fact: DataFrame) -> DataFrame:
    """Add whether it rained; unknown counts as dry."""
    return fact.withColumn("pluie", F.coalesce(F.col("precipitation") > 0, F.lit(False)))


def fill_by(fact: DataFrame, by: str, digits: int | None = None) -> DataFrame:
    """Mean, minimum, maximum and count of the fill rate per label."""
    summary = group_summary(fact, by, FILL)
    if digits is None:
        return summary
    return summary.withColumns({c: round_half_even(F.col(c), digits) for c in ("mean", "min", "max")})


def fill_by_weekday(fact: DataFrame) -> DataFrame:
    """Fill rate per weekday, weakest first."""
    return fill_by(fact, "jour_semaine", 3).select("jour_semaine", "mean", "count").orderBy("mean", "jour_semaine")


def opponent_rank_by_holiday(fact: DataFrame) -> DataFrame:
    """Mean rank of the opponent in and out of holidays."""
    return fact.groupBy("vacances_scolaires").agg(F.avg("rang_adversaire_avant").alias("rang_moyen"))


def rainy_matches(fact: DataFrame) -> DataFrame:
    """Number of matches with rain."""
    return with_rain(fact).agg(F.count_if("pluie").alias("n_pluie"))


def cancellation_correlation(fact: DataFrame) -> DataFrame:
    """Correlation of fill and cancellation rates over matches with a known cancellation rate."""
    return fact.filter(F.col("taux_annulation").isNotNull()).agg(
        pearson(F.col(FILL), F.col("taux_annulation")).alias("correlation")
    )


def rank_line(fact: DataFrame) -> DataFrame:
    """Least-squares line of the fill rate on the opponent's rank."""
    slope, intercept = least_squares(F.col(FILL), F.col("rang_adversaire_avant"))
    return fact.agg(slope.alias("slope"), intercept.alias("intercept"))


def weakest_matches(fact: DataFrame, n: int = WEAKEST) -> DataFrame:
    """The ``n`` matches that fill least, with context; unknown rates do not compete."""
    return fact.filter(F.col(FILL).isNotNull()).orderBy(FILL, "date", "match_id").limit(n).select(*CONTEXT)


def series(fact: DataFrame, x: str, y: str, label: str = "competition", y_scale: float = 1.0) -> DataFrame:
    """Points of a scatter view with known coordinates."""
    points = fact.select(F.col(x).alias("x"), (F.col(y) * y_scale).alias("y"), F.col(label).alias("label"))
    return points.dropna(subset=["x", "y"])


def slot_by_weekday(fact: DataFrame) -> DataFrame:
    """Matches per time slot and weekday; absent pairs are 0."""
    return cross_counts(with_kickoff(fact), "creneau", "jour_semaine", WEEKDAYS)


def match_scores(fact: DataFrame, survey: DataFrame) -> DataFrame:
    """Mean survey score and number of answers per match; only surveys taken after a match.

    Answers are averaged per match before they meet the fact table.
    """
    answers = (
        survey.filter(F.col("type_enquete") == schemas.POST_MATCH)
        .groupBy("match_id")
        .agg(F.avg("note_globale").alias("note_globale_moy"), F.count("*").alias("n_reponses"))
    )
    return fact.select("match_id", "victoire_pbb").join(answers, "match_id")


def score_by_result(scores: DataFrame) -> DataFrame:
    """Mean of the match means per result: every match weighs the same."""
    return (
        scores.groupBy("victoire_pbb")
        .agg(F.avg("note_globale_moy").alias("note_moyenne"), F.count("*").alias("n_matchs"))
        .withColumn("resultat", result_label(F.col("victoire_pbb")))
    )


def population_by_postcode(districts: DataFrame, towns: DataFrame) -> DataFrame:
    """Inhabitants per postcode; the city proper is counted by its districts only."""

    def spread(df: DataFrame) -> DataFrame:
        return df.select(F.explode("codesPostaux").alias("code_postal"), "population")

    other_towns = towns.filter(F.col("nom") != schemas.CITY_COUNTED_BY_DISTRICT)
    return (
        spread(districts)
        .unionAll(spread(other_towns))
        .groupBy("code_postal")
        .agg(F.sum("population").alias("population"))
    )


def contacts_by_postcode(contacts: DataFrame) -> DataFrame:
    """Contacts per known postcode."""
    return (
        contacts.filter(F.col("code_postal").isNotNull())
        .groupBy("code_postal")
        .agg(F.count("*").alias("nb_contacts"))
    )


def penetration(contacts: DataFrame, population: DataFrame) -> DataFrame:
    """Contacts per 1000 inhabitants for each postcode with a known population."""
    per_thousand = ratio(F.col("nb_contacts") * 1000, F.col("population"))
    return (
        contacts_by_postcode(contacts)
        .join(population, "code_postal", "left")
        .withColumn("contacts_pour_1000_hab", round_half_even(per_thousand, 2))
        .dropna(subset=["population"])
    )


def penetration_coverage(contacts: DataFrame, population: DataFrame) -> DataFrame:
    """Postcodes of contacts with and without a known population, as one row."""
    return (
        contacts_by_postcode(contacts)
        .join(population, "code_postal", "left")
        .agg(
            F.count("population").alias("n_connus"),
            F.count_if(F.col("population").isNull()).alias("n_inconnus"),
        )
    )


def unmatched_postcodes(contacts: DataFrame, population: DataFrame) -> DataFrame:
    """Number of contact postcodes absent from the population tables."""
    return unmatched_keys(contacts_by_postcode(contacts), population, "code_postal")


def top_zones(penetrated: DataFrame, n: int = TOP_ZONES) -> DataFrame:
    """Postcodes with the highest penetration."""
    return penetrated.orderBy(F.desc("contacts_pour_1000_hab"), "code_postal").limit(n)


def funnel(events: DataFrame, steps: dict[str, str] = schemas.FUNNEL_STEPS) -> DataFrame:
    """Distinct sessions that reached each step, and the cart-to-purchase rate.

    Sessions are reduced to one row of flags first: one shuffle on the session,
    instead of one expansion of the rows for each distinct count.
    """
    sessions = (
        events.filter(F.col("session_id").isNotNull() & F.col("event_name").isin(*steps.values()))
        .groupBy("session_id")
        .agg(*(F.max(F.when(F.col("event_name") == event, 1).otherwise(0)).alias(step) for step, event in steps.items()))
    )
    counts = sessions.agg(*(F.coalesce(F.sum(step), F.lit(0)).alias(step) for step in steps))
    return counts.withColumn("panier_achat_pct", ratio(F.col("achat"), F.col("panier")) * 100.0)


def conversion_by_channel(sessions: DataFrame, min_sessions: int = MIN_SESSIONS) -> DataFrame:
    """Sessions and percentage with revenue per channel, for channels above a size."""
    return (
        sessions.groupBy("source", "medium")
        .agg(F.count("*").alias("sessions"), F.count_if(F.col("revenue") > 0).alias("_paid"))
        .filter(F.col("sessions") > min_sessions)
        .select("source", "medium", "sessions", percent(F.col("_paid"), F.col("sessions"), 2).alias("taux_conversion_pct"))
        .orderBy(F.desc("taux_conversion_pct"), "source", "medium")
    )


def conversion_bands(conversion: DataFrame) -> DataFrame:
    """Channel labels with their conversion and whether it is high, lowest first."""
    return conversion.select(
        channel_label(F.col("source"), F.col("medium")).alias("canal_label"),
        "taux_conversion_pct",
        high_conversion(F.col("taux_conversion_pct")).alias("est_fort"),
    ).orderBy("taux_conversion_pct", "canal_label")


def campaign_rates(events: DataFrame) -> DataFrame:
    """Deliveries per channel, opens over deliveries and clicks over opens in percent."""

    def happened(label: str) -> Column:
        return F.count_if(F.col("evenement") == label)

    return (
        events.groupBy("canal")
        .agg(
            happened(schemas.DELIVERED).alias("delivres"),
            happened(schemas.OPENED).alias("_opened"),
            happened(schemas.CLICKED).alias("_clicked"),
        )
        .select(
            "canal",
            "delivres",
            percent(F.col("_opened"), F.col("delivres"), 1).alias("taux_ouverture_pct"),
            percent(F.col("_clicked"), F.col("_opened"), 1).alias("taux_clic_pct"),
        )
    )


def scorecard(fact: DataFrame) -> DataFrame:
    """Headline numbers of the season, as one row, with display text."""
    return fact.agg(
        F.avg(FILL).alias("remplissage_moyen"),
        F.min(FILL).alias("remplissage_min"),
        F.max(FILL).alias("remplissage_max"),
        F.avg("taux_annulation").alias("annulation_moyenne"),
        F.count("*").alias("n_matchs"),
    )


def scorecard_text(card: DataFrame) -> DataFrame:
    """The scorecard as percentages with one decimal."""
    shares = ("remplissage_moyen", "remplissage_min", "remplissage_max", "annulation_moyenne")
    return card.select(*(percent_label(F.col(c)).alias(c) for c in shares), F.col("n_matchs").cast("string").alias("n_matchs"))


def fill_by_competition_over_time(fact: DataFrame) -> DataFrame:
    """Mean fill rate per competition, in the order in which competitions first appear."""
    return (
        fact.filter(F.col(FILL).isNotNull())
        .groupBy("competition")
        .agg(F.avg(FILL).alias("mean"), F.min("date").alias("first_date"))
        .orderBy("first_date", "competition")
    )


def fill_by_weekday_in_week_order(fact: DataFrame) -> DataFrame:
    """Mean fill rate per weekday from Monday to Sunday; days without matches are absent."""
    return (
        fact.filter(F.col(FILL).isNotNull())
        .groupBy("jour_semaine")
        .agg(F.avg(FILL).alias("mean"))
        .withColumn("position", weekday_position(F.col("jour_semaine")))
        .orderBy("position")
    )


def ranked_by_size(df: DataFrame, value: str, ties: Sequence[str]) -> DataFrame:
    """Rows by falling absolute value."""
    return df.orderBy(F.abs(value).desc(), *ties)


def model_rows(fact: DataFrame) -> DataFrame:
    """Inputs of the fill model: rows with a known rate and opponent rank."""
    return fact.select(
        FILL, "rang_adversaire_avant", "competition", "jour_semaine", "vacances_scolaires"
    ).dropna(subset=[FILL, "rang_adversaire_avant"])


# Numeric and categorical inputs of the fill model.
MODEL_NUMERIC = ("rang_adversaire_avant", "vacances_scolaires")
MODEL_CATEGORICAL = ("competition", "jour_semaine")
