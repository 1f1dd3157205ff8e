"""Queries on the fact table, its parts and the questions asked of it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnstile.functions.calendar import kickoff_hour
from turnstile.functions.labels import competition_group
from turnstile.functions.parsing import date_as_written, local_timestamp
from turnstile.operators import lookups, stats
from turnstile.operators.label_ridge import fit_label_ridge
from turnstile.operators.ridge import fit_ridge
from turnstile.plans import analysis, gold
from turnstile.session import written_copy
from turnstile.suite.catalogue import query, rounded
from turnstile.suite.standins import Inputs


@query("""
    SELECT * REPLACE (round(revenu_billetterie, 2) AS revenu_billetterie, round(precipitation, 9) AS precipitation)
    FROM fact""")
def fact_match(inputs: Inputs) -> DataFrame:
    return rounded(inputs.fact(), revenu_billetterie=2)


@query("""
    SELECT date_match, billets_total, billets_vendus, round(revenu_billetterie, 2) AS revenu_billetterie,
           CAST(round(CAST(prix_moyen AS DECIMAL(28, 6)), 2) AS DOUBLE) AS prix_moyen_billet,
           billets_abonnement, billets_unite, billets_annules, billets_rembourses, billets_en_attente
    FROM by_date""")
def tickets_by_date(inputs: Inputs) -> DataFrame:
    return rounded(
        gold.tickets_by_date(inputs.tickets(), inputs.sessions(), inputs.product_types()), revenu_billetterie=2
    )


@query("""
    SELECT p_type AS code, count(*) AS n_tickets, round(sum(l_extendedprice), 2) AS revenue
    FROM lineitem LEFT JOIN part ON l_partkey = p_partkey GROUP BY 1""")
def tickets_by_product(inputs: Inputs) -> DataFrame:
    """A lookup that grows with the data: tickets are folded per product before the join."""
    per_product = (
        inputs.table("lineitem")
        .groupBy(F.col("l_partkey").alias("p_partkey"))
        .agg(F.count("*").alias("n"), F.sum("l_extendedprice").alias("amount"))
    )
    products = inputs.table("part").select("p_partkey", F.col("p_type").alias("code"))
    joined = per_product.join(products, "p_partkey", "left")
    return rounded(joined.groupBy("code").agg(F.sum("n").alias("n_tickets"), F.sum("amount").alias("revenue")), 2)


@query("SELECT * FROM scans_by_token")
def scans_by_day(inputs: Inputs) -> DataFrame:
    return gold.scans_by_token(inputs.scans())


@query("""
    SELECT date AS date_resultat, rang_pbb_avant, rang_adversaire_avant, score_domicile, score_exterieur
    FROM home_results""")
def home_results(inputs: Inputs) -> DataFrame:
    return gold.home_results(inputs.results())


@query("SELECT date, vacances_scolaires FROM fact")
def holiday_flags(inputs: Inputs) -> DataFrame:
    periods = inputs.holidays().filter(F.col("location") == "Paris").select(
        date_as_written(F.col("start_date")).alias("first"), date_as_written(F.col("end_date")).alias("last")
    )
    days = inputs.calendar().select("date")
    return lookups.flag_dates_in_periods(days, "date", periods, "first", "last", "vacances_scolaires")


@query("SELECT match_id, temperature, precipitation FROM fact")
def kickoff_weather(inputs: Inputs) -> DataFrame:
    readings = inputs.weather().withColumn("hour_ts", local_timestamp(F.col("heure")))
    hours = lookups.hourly_readings(readings)
    matches = inputs.calendar().withColumn("hour_ts", kickoff_hour(F.col("date"), F.col("heure")))
    return matches.join(hours, "hour_ts", "left").select("match_id", "temperature", "precipitation")


@query("""
    SELECT CAST(start_at AS DATE) AS date_match, count(*) AS n_sessions FROM sessions
    GROUP BY 1 HAVING count(*) > 1""")
def dates_with_several_sessions(inputs: Inputs) -> DataFrame:
    return gold.dates_with_several_sessions(inputs.sessions())


@query("""
    SELECT count(*) AS n_matchs, count(*) FILTER (WHERE billets_vendus IS NULL) AS n_sans_billets,
           count(*) FILTER (WHERE entrees_ok IS NULL) AS n_sans_scans,
           count(*) FILTER (WHERE rang_pbb_avant IS NULL) AS n_sans_classement
    FROM fact""")
def fact_completeness(inputs: Inputs) -> DataFrame:
    return gold.completeness(inputs.fact())


@query("""
    SELECT match_id, date, billets_vendus, entrees_ok, taux_presence FROM fact WHERE taux_presence > 1.05""")
def implausible_attendance(inputs: Inputs) -> DataFrame:
    return gold.implausible_attendance(inputs.fact())


# --- grouped means ------------------------------------------------------------


@query("""
    SELECT competition, round_even(avg(taux_remplissage) * 1000, 0) / 1000 AS mean,
           round_even(min(taux_remplissage) * 1000, 0) / 1000 AS min,
           round_even(max(taux_remplissage) * 1000, 0) / 1000 AS max, count(taux_remplissage) AS count
    FROM fact GROUP BY competition""")
def fill_by_competition(inputs: Inputs) -> DataFrame:
    return analysis.fill_by(inputs.fact(), "competition", 3)


@query("""
    SELECT jour_semaine, round_even(avg(taux_remplissage) * 1000, 0) / 1000 AS mean,
           count(taux_remplissage) AS count
    FROM fact GROUP BY jour_semaine""")
def fill_by_weekday(inputs: Inputs) -> DataFrame:
    return analysis.fill_by_weekday(inputs.fact())


@query("""
    SELECT vacances_scolaires, round_even(avg(taux_remplissage) * 1000, 0) / 1000 AS mean,
           count(taux_remplissage) AS count
    FROM fact GROUP BY 1""")
def fill_by_holiday(inputs: Inputs) -> DataFrame:
    return analysis.fill_by(inputs.fact(), "vacances_scolaires", 3).select("vacances_scolaires", "mean", "count")


@query("SELECT vacances_scolaires, round(avg(rang_adversaire_avant), 9) AS rang_moyen FROM fact GROUP BY 1")
def opponent_rank_by_holiday(inputs: Inputs) -> DataFrame:
    return rounded(analysis.opponent_rank_by_holiday(inputs.fact()))


@query("""
    SELECT pluie, round(avg(taux_remplissage), 9) AS mean, count(taux_remplissage) AS count
    FROM kickoff GROUP BY 1""")
def fill_by_rain(inputs: Inputs) -> DataFrame:
    return rounded(analysis.fill_by(analysis.with_rain(inputs.fact()), "pluie").select("pluie", "mean", "count"))


@query("SELECT count(*) FILTER (WHERE pluie) AS n_pluie FROM kickoff")
def rainy_matches(inputs: Inputs) -> DataFrame:
    return analysis.rainy_matches(inputs.fact())


@query("""
    SELECT creneau, round(avg(taux_remplissage), 9) AS mean, count(taux_remplissage) AS count
    FROM kickoff GROUP BY 1""")
def fill_by_slot(inputs: Inputs) -> DataFrame:
    return rounded(analysis.fill_by(analysis.with_kickoff(inputs.fact()), "creneau").select("creneau", "mean", "count"))


@query("""
    SELECT creneau, count(*) FILTER (WHERE jour_semaine = 'Monday') AS Monday,
           count(*) FILTER (WHERE jour_semaine = 'Tuesday') AS Tuesday,
           count(*) FILTER (WHERE jour_semaine = 'Wednesday') AS Wednesday,
           count(*) FILTER (WHERE jour_semaine = 'Thursday') AS Thursday,
           count(*) FILTER (WHERE jour_semaine = 'Friday') AS Friday,
           count(*) FILTER (WHERE jour_semaine = 'Saturday') AS Saturday,
           count(*) FILTER (WHERE jour_semaine = 'Sunday') AS Sunday
    FROM kickoff GROUP BY 1""")
def slot_by_weekday(inputs: Inputs) -> DataFrame:
    return analysis.slot_by_weekday(inputs.fact())


@query("""
    SELECT competition, round(avg(taux_remplissage), 9) AS mean, min(date) AS first_date
    FROM fact WHERE taux_remplissage IS NOT NULL GROUP BY 1""")
def fill_by_competition_over_time(inputs: Inputs) -> DataFrame:
    return rounded(analysis.fill_by_competition_over_time(inputs.fact()))


@query("""
    SELECT jour_semaine, round(avg(taux_remplissage), 9) AS mean,
           CAST(isodow(min(date)) - 1 AS INTEGER) AS position
    FROM fact WHERE taux_remplissage IS NOT NULL GROUP BY 1""")
def fill_by_weekday_in_week_order(inputs: Inputs) -> DataFrame:
    ordered = analysis.fill_by_weekday_in_week_order(inputs.fact())
    return rounded(ordered.withColumn("position", F.col("position").cast("int")))


@query("""
    SELECT CASE WHEN contains(competition, 'Playoffs') THEN 'Playoffs'
                WHEN contains(competition, 'EuroLeague') THEN 'EuroLeague' ELSE 'Betclic ÉLITE' END AS groupe,
           count(*) AS n_matchs
    FROM calendar GROUP BY 1""")
def competition_groups(inputs: Inputs) -> DataFrame:
    grouped = inputs.calendar().withColumn("groupe", competition_group(F.col("competition")))
    return grouped.groupBy("groupe").agg(F.count("*").alias("n_matchs"))


# --- correlation, distribution, line ---------------------------------------------


def _correlation_rows(*columns: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS variable, round(corr(taux_remplissage, {c}), 9) AS correlation FROM kickoff" for c in columns
    )


@query(_correlation_rows("rang_adversaire_avant", "rang_pbb_avant", "ecart_classement"))
def fill_and_rank_correlations(inputs: Inputs) -> DataFrame:
    others = ["rang_adversaire_avant", "rang_pbb_avant", "ecart_classement"]
    return rounded(stats.correlations(inputs.fact(), analysis.FILL, others))


@query(_correlation_rows("temperature", "precipitation"))
def fill_and_weather_correlations(inputs: Inputs) -> DataFrame:
    return rounded(stats.correlations(inputs.fact(), analysis.FILL, ["temperature", "precipitation"]))


@query(_correlation_rows("heure_minutes"))
def fill_and_kickoff_correlation(inputs: Inputs) -> DataFrame:
    return rounded(stats.correlations(analysis.with_kickoff(inputs.fact()), analysis.FILL, ["heure_minutes"]))


@query("""
    SELECT round(corr(taux_remplissage, taux_annulation), 9) AS correlation FROM fact
    WHERE taux_annulation IS NOT NULL""")
def cancellation_correlation(inputs: Inputs) -> DataFrame:
    return rounded(analysis.cancellation_correlation(inputs.fact()))


def _description(value: str, table: str, by: str = "", digits: int = 9) -> str:
    keys = f"{by}, " if by else ""
    return f"""
    SELECT {keys}count({value}) AS count, round(avg({value}), {digits}) AS mean, round(stddev_samp({value}), {digits}) AS std,
           round(min({value}), {digits}) AS min, round(quantile_cont({value}, 0.25), {digits}) AS q25,
           round(quantile_cont({value}, 0.5), {digits}) AS q50, round(quantile_cont({value}, 0.75), {digits}) AS q75,
           round(max({value}), {digits}) AS max
    FROM {table} {f"GROUP BY {by}" if by else ""}"""


@query(_description("taux_remplissage", "fact"))
def describe_fill(inputs: Inputs) -> DataFrame:
    return rounded(stats.describe(inputs.fact(), analysis.FILL))


@query(_description("taux_annulation", "fact"))
def describe_cancellation(inputs: Inputs) -> DataFrame:
    return rounded(stats.describe(inputs.fact(), "taux_annulation"))


@query(_description("amount", "tickets", "order_status_id", digits=4))
def describe_ticket_prices(inputs: Inputs) -> DataFrame:
    """Quantiles over every ticket, in groups that each hold about a third of the rows."""
    return rounded(stats.describe(inputs.tickets(), "amount", ["order_status_id"]), 4)


def _boxes(value: str, table: str, by: str) -> str:
    return f"""
    WITH q AS (SELECT {by}, quantile_cont({value}, 0.25) AS q25, quantile_cont({value}, 0.5) AS q50,
                      quantile_cont({value}, 0.75) AS q75 FROM {table} WHERE {value} IS NOT NULL GROUP BY 1),
    f AS (SELECT t.{by}, t.{value} AS v, q25, q50, q75, q25 - 1.5 * (q75 - q25) AS lo, q75 + 1.5 * (q75 - q25) AS hi
          FROM {table} t JOIN q ON q.{by} = t.{by} WHERE t.{value} IS NOT NULL)
    SELECT {by}, round(q25, 9) AS q25, round(q50, 9) AS q50, round(q75, 9) AS q75,
           round(min(v) FILTER (WHERE v BETWEEN lo AND hi), 9) AS whisker_low,
           round(max(v) FILTER (WHERE v BETWEEN lo AND hi), 9) AS whisker_high,
           count(*) FILTER (WHERE v NOT BETWEEN lo AND hi) AS n_outliers
    FROM f GROUP BY {by}, q25, q50, q75"""


def _inline(sql: str) -> str:
    """A query with its own WITH list as a nested query, so that shared tables can precede it."""
    return f"SELECT * FROM ({sql})"


@query(_inline(_boxes("taux_remplissage", "fact", "competition")))
def fill_boxes_by_competition(inputs: Inputs) -> DataFrame:
    return rounded(stats.box_summary(inputs.fact(), analysis.FILL, ["competition"]))


@query(_inline(_boxes("taux_remplissage", "kickoff", "creneau")))
def fill_boxes_by_slot(inputs: Inputs) -> DataFrame:
    return rounded(stats.box_summary(analysis.with_kickoff(inputs.fact()), analysis.FILL, ["creneau"]))


@query(_inline(_boxes("note_globale_moy", "match_scores", "victoire_pbb")))
def score_boxes_by_result(inputs: Inputs) -> DataFrame:
    scores = analysis.match_scores(inputs.fact(), inputs.survey())
    return rounded(stats.box_summary(rounded(scores, 9), "note_globale_moy", ["victoire_pbb"]))


@query("""
    SELECT match_id, competition, taux_remplissage FROM fact f JOIN (
        SELECT competition AS c, quantile_cont(taux_remplissage, 0.25) AS a, quantile_cont(taux_remplissage, 0.75) AS b
        FROM fact WHERE taux_remplissage IS NOT NULL GROUP BY 1) ON c = competition
    WHERE taux_remplissage NOT BETWEEN a - 1.5 * (b - a) AND b + 1.5 * (b - a)""")
def fill_outliers_by_competition(inputs: Inputs) -> DataFrame:
    fact = inputs.fact().select("match_id", "competition", "taux_remplissage")
    return stats.box_outliers(fact, analysis.FILL, ["competition"])


@query("""
    SELECT round(regr_slope(taux_remplissage, rang_adversaire_avant), 9) AS slope,
           round(regr_intercept(taux_remplissage, rang_adversaire_avant), 9) AS intercept FROM fact""")
def rank_line(inputs: Inputs) -> DataFrame:
    return rounded(analysis.rank_line(inputs.fact()))


# --- lists and views -------------------------------------------------------------


@query("""
    SELECT match_id, date, adversaire, competition, taux_remplissage, rang_adversaire_avant, jour_semaine,
           vacances_scolaires, temperature
    FROM fact WHERE taux_remplissage IS NOT NULL ORDER BY taux_remplissage, date, match_id LIMIT 8""")
def weakest_matches(inputs: Inputs) -> DataFrame:
    return analysis.weakest_matches(inputs.fact())


def _points(x: str, y: str, scale: str = "") -> str:
    return f"""
    SELECT {x} AS x, {y}{scale} AS y, competition AS label FROM fact WHERE {x} IS NOT NULL AND {y} IS NOT NULL"""


@query(_points("prix_moyen_billet", "taux_remplissage", " * 1.0"))
def price_points(inputs: Inputs) -> DataFrame:
    return analysis.series(inputs.fact(), "prix_moyen_billet", "taux_remplissage")


@query(_points("temperature", "taux_remplissage", " * 1.0"))
def temperature_points(inputs: Inputs) -> DataFrame:
    return analysis.series(inputs.fact(), "temperature", "taux_remplissage")


@query(_points("taux_remplissage", "taux_annulation", " * 1.0"))
def cancellation_points(inputs: Inputs) -> DataFrame:
    return analysis.series(inputs.fact(), "taux_remplissage", "taux_annulation")


@query(_points("rang_adversaire_avant", "taux_remplissage", " * 100.0"))
def rank_points(inputs: Inputs) -> DataFrame:
    return analysis.series(inputs.fact(), "rang_adversaire_avant", "taux_remplissage", y_scale=100.0)


@query("""
    SELECT round(avg(taux_remplissage), 9) AS remplissage_moyen, min(taux_remplissage) AS remplissage_min,
           max(taux_remplissage) AS remplissage_max, round(avg(taux_annulation), 9) AS annulation_moyenne,
           count(*) AS n_matchs
    FROM fact""")
def scorecard(inputs: Inputs) -> DataFrame:
    return rounded(analysis.scorecard(inputs.fact()))


@query("""
    SELECT printf('%.1f', round(avg(taux_remplissage) * 100, 1)) || '%' AS remplissage_moyen,
           printf('%.1f', round(min(taux_remplissage) * 100, 1)) || '%' AS remplissage_min,
           printf('%.1f', round(max(taux_remplissage) * 100, 1)) || '%' AS remplissage_max,
           coalesce(printf('%.1f', round(avg(taux_annulation) * 100, 1)) || '%', 'N/A') AS annulation_moyenne,
           CAST(count(*) AS VARCHAR) AS n_matchs
    FROM fact""")
def scorecard_text(inputs: Inputs) -> DataFrame:
    return analysis.scorecard_text(analysis.scorecard(inputs.fact()))


# --- survey ------------------------------------------------------------------------


@query("""
    SELECT match_id, victoire_pbb, round(note_globale_moy, 9) AS note_globale_moy, n_reponses FROM match_scores""")
def match_scores(inputs: Inputs) -> DataFrame:
    return rounded(analysis.match_scores(inputs.fact(), inputs.survey()))


@query("""
    SELECT victoire_pbb, round(avg(note_globale_moy), 9) AS note_moyenne, count(*) AS n_matchs,
           CASE victoire_pbb WHEN 1 THEN 'Victoire' WHEN 0 THEN 'Défaite' END AS resultat
    FROM match_scores GROUP BY 1""")
def score_by_result(inputs: Inputs) -> DataFrame:
    return rounded(analysis.score_by_result(analysis.match_scores(inputs.fact(), inputs.survey())))


# --- model ----------------------------------------------------------------------------


def _model_input(inputs: Inputs) -> DataFrame:
    """Saved once: the model reads its rows several times."""
    return written_copy(analysis.model_rows(inputs.fact()), "model-rows")


# Two features in closed form: standardised columns a and b with correlation r.
_TWO_FEATURES = """
    WITH d AS (SELECT taux_remplissage AS y, CAST(rang_adversaire_avant AS DOUBLE) AS p,
                      CAST(vacances_scolaires AS INTEGER) AS q
               FROM fact WHERE taux_remplissage IS NOT NULL AND rang_adversaire_avant IS NOT NULL),
    m AS (SELECT count(*) AS n, avg(y) AS my, avg(p) AS mp, avg(q) AS mq, stddev_pop(p) AS sp, stddev_pop(q) AS sq FROM d),
    z AS (SELECT n, my, y, (p - mp) / sp AS a, (q - mq) / sq AS b FROM d, m),
    s AS (SELECT any_value(n) AS n, any_value(my) AS my, sum(a * a) + 1 AS aa, sum(a * b) AS ab, sum(b * b) + 1 AS bb,
                 sum(a * (y - my)) AS ta, sum(b * (y - my)) AS tb FROM z),
    c AS (SELECT n, my, bb / (aa * bb - ab * ab) AS iaa, -ab / (aa * bb - ab * ab) AS iab, aa / (aa * bb - ab * ab) AS ibb,
                 (bb * ta - ab * tb) / (aa * bb - ab * ab) AS ca, (aa * tb - ab * ta) / (aa * bb - ab * ab) AS cb FROM s)
"""


@query(f"""
    SELECT * FROM ({_TWO_FEATURES}
    SELECT 'rang_adversaire_avant' AS feature, round(ca, 9) AS coefficient FROM c
    UNION ALL SELECT 'vacances_scolaires', round(cb, 9) FROM c)""")
def fill_model_two_features(inputs: Inputs) -> DataFrame:
    fit = fit_ridge(_model_input(inputs), analysis.FILL, analysis.MODEL_NUMERIC)
    return rounded(fit.ranking(inputs.spark))


@query(f"""
    SELECT * FROM ({_TWO_FEATURES}
    SELECT round(avg(e), 9) AS mae, round(avg(y), 9) AS mean_target, round(avg(e) / avg(y) * 100, 9) AS relative_error_pct
    FROM (SELECT y, abs(y - c.my - a * ca - b * cb)
                    / (1 - (1.0 / c.n + a * a * iaa + 2 * a * b * iab + b * b * ibb)) AS e FROM z, c))""")
def fill_model_two_features_error(inputs: Inputs) -> DataFrame:
    rows = _model_input(inputs)
    return rounded(fit_ridge(rows, analysis.FILL, analysis.MODEL_NUMERIC).evaluation(rows))


# All features: the normal equations are inverted by Gauss-Jordan steps on nested lists.
# The matrix is symmetric and positive, so no pivot search is needed.
_MODEL_LABELS = {
    "competition": ("Betclic ÉLITE Playoffs", "EuroLeague"),
    "jour_semaine": ("Monday", "Saturday", "Sunday", "Thursday", "Tuesday", "Wednesday"),
}
_MODEL_FEATURES = [*analysis.MODEL_NUMERIC, *(f"{c}_{v}" for c, labels in _MODEL_LABELS.items() for v in labels)]
_ALL_FEATURES = f"""
    WITH RECURSIVE d AS (
        SELECT row_number() OVER () AS id, taux_remplissage AS y,
               [CAST(rang_adversaire_avant AS DOUBLE), CAST(vacances_scolaires AS DOUBLE),
                {", ".join(f"CAST({c} = '{v}' AS DOUBLE)" for c, labels in _MODEL_LABELS.items() for v in labels)}] AS x
        FROM fact WHERE taux_remplissage IS NOT NULL AND rang_adversaire_avant IS NOT NULL),
    size AS (SELECT count(*) AS n, avg(y) AS my FROM d),
    v AS (SELECT id, y, unnest(x) AS v, generate_subscripts(x, 1) AS j FROM d),
    st AS (SELECT j, avg(v) AS m, stddev_pop(v) AS s FROM v GROUP BY j),
    z AS (SELECT id, y, j, (v - m) / s AS z FROM v JOIN st USING (j)),
    g AS (SELECT a.j AS i, b.j AS j, sum(a.z * b.z) + CASE WHEN a.j = b.j THEN 1 ELSE 0 END AS g
          FROM z a JOIN z b USING (id) GROUP BY 1, 2),
    rows AS (SELECT i, list(g ORDER BY j) || list(CASE WHEN i = j THEN 1.0 ELSE 0.0 END ORDER BY j) AS r FROM g GROUP BY i),
    steps(k, m) AS (
        SELECT 1, list(r ORDER BY i) FROM rows
        UNION ALL
        SELECT k + 1, list_transform(m, lambda r, i: list_transform(r, lambda e, j:
            CASE WHEN i = k THEN e / r[k] ELSE e - r[k] * m[k][j] / m[k][k] END))
        FROM steps WHERE k <= {len(_MODEL_FEATURES)}),
    inv AS (SELECT i, j, m[i][j + {len(_MODEL_FEATURES)}] AS h
            FROM steps, range(1, {len(_MODEL_FEATURES) + 1}) a(i), range(1, {len(_MODEL_FEATURES) + 1}) b(j)
            WHERE k = {len(_MODEL_FEATURES) + 1}),
    zy AS (SELECT j, sum(z * (y - my)) AS t FROM z, size GROUP BY j),
    beta AS (SELECT i AS j, sum(h * t) AS c FROM inv JOIN zy USING (j) GROUP BY i)
"""


@query(f"""
    SELECT * FROM ({_ALL_FEATURES}
    SELECT {_MODEL_FEATURES!r}[j] AS feature, round(c, 9) AS coefficient FROM beta)""")
def fill_model(inputs: Inputs) -> DataFrame:
    rows = _model_input(inputs)
    fit = fit_ridge(rows, analysis.FILL, analysis.MODEL_NUMERIC, analysis.MODEL_CATEGORICAL)
    return analysis.ranked_by_size(rounded(fit.ranking(inputs.spark)), "coefficient", ["feature"])


@query(f"""
    SELECT * FROM ({_ALL_FEATURES},
    fitted AS (SELECT id, any_value(y) AS y, any_value(my) + sum(z * c) AS f, any_value(n) AS n
               FROM z JOIN beta USING (j), size GROUP BY id),
    leverage AS (SELECT a.id, sum(a.z * h * b.z) AS l FROM z a JOIN inv ON inv.i = a.j JOIN z b ON b.id = a.id AND b.j = inv.j
                 GROUP BY 1)
    SELECT round(avg(e), 9) AS mae, round(avg(y), 9) AS mean_target, round(avg(e) / avg(y) * 100, 9) AS relative_error_pct
    FROM (SELECT y, abs(y - f) / (1 - 1.0 / n - l) AS e FROM fitted JOIN leverage USING (id)))""")
def fill_model_error(inputs: Inputs) -> DataFrame:
    rows = _model_input(inputs)
    fit = fit_ridge(rows, analysis.FILL, analysis.MODEL_NUMERIC, analysis.MODEL_CATEGORICAL)
    return rounded(fit.evaluation(rows))


# One coefficient per part number: thousands of labels, more with more data. Eliminating a label leaves a system of two.
_MANY_LABELS = """
    WITH d AS (SELECT CAST(l_partkey AS VARCHAR) AS label, CAST(l_linenumber AS DOUBLE) AS x, l_quantity AS y FROM lineitem),
    m AS (SELECT count(*) AS n, avg(x) AS mx, avg(y) AS my, var_pop(x) AS vx, min(label) AS base FROM d),
    c AS (SELECT label, x - mx AS x, y - my AS y, n, vx, base FROM d, m),
    g AS (SELECT label, count(*) AS k, sum(x) AS sx, sum(y) AS sy, count(*) / any_value(n) AS p FROM c
          WHERE label <> base GROUP BY label),
    e AS (SELECT *, k + p * (1 - p) AS held FROM g),
    w AS (SELECT sum(1.0) AS a, sum(x) AS b, sum(x * x) + any_value(vx) AS c, sum(y) AS r, sum(x * y) AS q FROM c),
    t AS (SELECT any_value(a) - sum(k * k / held) AS a, any_value(b) - sum(k * sx / held) AS b,
                 any_value(c) - sum(sx * sx / held) AS c, any_value(r) - sum(k * sy / held) AS r,
                 any_value(q) - sum(sx * sy / held) AS q FROM e, w),
    s AS (SELECT c / (a * c - b * b) AS ia, -b / (a * c - b * b) AS ib, a / (a * c - b * b) AS ic,
                 (c * r - b * q) / (a * c - b * b) AS f, (a * q - b * r) / (a * c - b * b) AS h FROM t),
    o AS (SELECT label, (sy - f * k - h * sx) / held AS weight, held, k / held AS pk, sx / held AS px, sqrt(p * (1 - p)) AS scale FROM e, s)
"""


def _part_rows(inputs: Inputs) -> DataFrame:
    return inputs.table("lineitem").select(
        F.col("l_partkey").alias("part"), F.col("l_linenumber").alias("line"), F.col("l_quantity").alias("quantity")
    )


@query(f"""
    SELECT * FROM ({_MANY_LABELS}
    SELECT 'part_' || label AS feature, round(weight * scale, 7) AS coefficient FROM o
    UNION ALL SELECT 'line', round(h * sqrt(vx), 7) FROM s, m)""")
def model_of_many_labels(inputs: Inputs) -> DataFrame:
    fit = fit_label_ridge(_part_rows(inputs), "quantity", "part", ["line"])
    return rounded(fit.ranking(), 7)


@query(f"""
    SELECT * FROM ({_MANY_LABELS}
    SELECT round(avg(err), 7) AS mae, round(avg(y0), 7) AS mean_target, round(avg(err) / avg(y0) * 100, 7) AS relative_error_pct
    FROM (SELECT y + my AS y0, abs(y - f - h * x - coalesce(weight, 0)) / (1 - coalesce(1 / held, 0)
            - (1 - coalesce(pk, 0)) * (1 - coalesce(pk, 0)) * ia - 2 * (1 - coalesce(pk, 0)) * (x - coalesce(px, 0)) * ib
            - (x - coalesce(px, 0)) * (x - coalesce(px, 0)) * ic) AS err
          FROM c LEFT JOIN o USING (label), s, (SELECT my FROM m)))""")
def model_of_many_labels_error(inputs: Inputs) -> DataFrame:
    rows = _part_rows(inputs)
    return rounded(fit_label_ridge(rows, "quantity", "part", ["line"]).evaluation(rows), 7)
