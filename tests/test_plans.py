"""The whole run over a raw folder, and the plans' rules on chosen rows."""

from __future__ import annotations

import datetime as dt

import pytest
import raw_files
from pyspark.sql import functions as F

from turnstile import schemas, session
from turnstile.plans import analysis, gold, job, quality, silver
from turnstile.sources import csv_files


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def raw(tmp_path_factory):
    return str(raw_files.write(tmp_path_factory.mktemp("raw")))


@pytest.fixture(scope="module")
def log(spark, raw):
    return job.run(spark, raw)


@pytest.fixture(scope="module")
def fact(spark, log):
    return spark.table("gold.fact_match")


def test_run_writes_all_tables_and_names_absent_sources(log):
    assert set(log.absent) == {
        "bronze.raw_campagnes", "bronze.raw_animations_participations", "bronze.raw_fb_transactions",
        "silver.campagnes", "silver.animations_participations", "silver.fb_transactions",
    }
    assert "gold.fact_match" in log.written and "silver.scans" in log.written
    assert len(log.written) == len(set(log.written)) == 19 + 3 + 13 + 1 + 3


def test_run_stops_at_the_first_failure(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        job.run(spark, str(tmp_path))


def test_fact_table(fact):
    assert tuple(fact.columns) == gold.FACT_COLUMNS and len(fact.columns) == 31
    first, second, third = (r.asDict() for r in fact.orderBy("match_id").collect())
    assert first == {
        "match_id": "M001", "date": dt.date(2025, 10, 3), "heure": "20:45", "competition": "EuroLeague", "journee": "J1",
        "adversaire": "Club, A", "salle": "Arena", "capacite_salle": 4,
        "billets_vendus": 3, "taux_remplissage": 0.75, "revenu_billetterie": pytest.approx(60.005), "prix_moyen_billet": 20.0,
        "billets_abonnement": 2, "billets_unite": 1, "part_billets_unite": 0.333,
        "billets_annules": 1, "billets_rembourses": 0, "billets_en_attente": 0, "taux_annulation": 0.167,
        "entrees_ok": 2, "taux_presence": 0.667,
        "rang_pbb_avant": 3, "rang_adversaire_avant": 10, "ecart_classement": 7, "score_domicile": 90, "score_exterieur": 80,
        "victoire_pbb": 1, "jour_semaine": "Friday", "vacances_scolaires": False, "temperature": 12.0, "precipitation": 0.4,
    }
    # Product type 9 is unknown and one ticket has no amount: both tickets count.
    assert (second["billets_vendus"], second["billets_abonnement"], second["billets_unite"]) == (2, 0, 0)
    assert (second["revenu_billetterie"], second["prix_moyen_billet"]) == (40.0, 40.0)
    assert (second["billets_en_attente"], second["billets_rembourses"], second["taux_annulation"]) == (1, 1, 0.0)
    assert (second["vacances_scolaires"], second["temperature"], second["victoire_pbb"]) == (True, 9.0, 0)
    # No tickets, no scans, no result, capacity zero.
    assert [third[c] for c in ("billets_vendus", "taux_remplissage", "billets_abonnement", "entrees_ok", "rang_pbb_avant")] == [None] * 5
    assert (third["victoire_pbb"], third["vacances_scolaires"], third["temperature"]) == (0, True, None)


def test_completeness_and_attendance(fact):
    assert rows(gold.completeness(fact)) == [(3, 1, 1, 1)]
    assert rows(gold.implausible_attendance(fact)) == []
    assert [r.match_id for r in gold.implausible_attendance(fact, limit=0.9).collect()] == ["M002"]


def test_sessions_on_one_date_are_added(spark):
    tickets = spark.createDataFrame(
        [(1, 1, 1, 10.0, False), (2, 1, 1, 20.0, False), (2, 1, 1, 30.0, None)],
        "session_id bigint, order_status_id int, product_type_id int, amount double, product_is_cancelled boolean",
    )
    sessions = spark.createDataFrame([(1, "2025-01-01T10:00:00"), (2, "2025-01-01T20:00:00"), (3, "2025-01-02T20:00:00")], "id bigint, start_at string")
    types = spark.createDataFrame([(1, "ABONNEMENT"), (1, "ABONNEMENT")], "id int, code string")
    by_date = gold.tickets_by_date(tickets, sessions, types).collect()
    assert [(r.date_match, r.billets_total, r.billets_vendus, r.revenu_billetterie) for r in by_date] == [(dt.date(2025, 1, 1), 3, 2, 30.0)]
    assert rows(gold.dates_with_several_sessions(sessions)) == [(dt.date(2025, 1, 1), 2)]


def test_a_session_with_most_tickets(spark):
    tickets = spark.range(90_000).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("session_id"),
        F.lit(1).alias("order_status_id"), F.lit(1).alias("product_type_id"),
        F.lit(1.0).alias("amount"), F.lit(False).alias("product_is_cancelled"),
    )
    sessions = spark.range(90_000).select("id", F.date_add(F.lit("2025-01-01").cast("date"), (F.col("id") % 5).cast("int")).alias("start_at"))
    types = spark.createDataFrame([(1, "ABONNEMENT")], "id int, code string")
    by_date = gold.tickets_by_date(tickets, sessions, types)
    assert by_date.agg(F.sum("billets_vendus"), F.sum("billets_abonnement")).first() == (90_000, 90_000)
    assert by_date.filter("date_match = '2025-01-02'").first().billets_vendus == 30_000 + 12_000


def test_contacts(spark, log):
    got = {r.ext_id: r for r in spark.table("silver.contacts").collect()}
    assert [got[f"C{i}"].date_naissance for i in range(1, 6)] == [dt.date(1990, 5, 3)] * 2 + [None] * 3
    assert [got[f"C{i}"].optin_email for i in range(1, 6)] == [True, False, None, True, False]
    raw_contacts = spark.table("bronze.raw_contacts")
    assert rows(silver.unparsed_birth_dates(raw_contacts)) == [(5, 2)]
    assert rows(silver.unparsed_after_cleaning(raw_contacts, spark.table("silver.contacts"))) == [(2,)]


def test_till(spark, log):
    till = spark.table("silver.boutique_ventes")
    assert len(till.columns) == 21
    got = sorted((r.ligne_id, r.ticket_id, r.prix_vente, r.quantite, r.date_vente, r.etat_vente) for r in till.na.fill(-1, ["quantite"]).collect())
    day = dt.date(2025, 10, 3)
    assert got == [
        ("1", "10", 39.0, 1, day, "VALIDEE"), ("1", "11", 39.0, 2, day, "VALIDEE"),
        ("2", "12", 1250.5, -1, day, "ANNULEE"), ("2", "12", 1250.5, -1, day, "ANNULEE"),
    ]
    assert rows(silver.cancelled_lines(till)) == [(4, 2)]


def test_sold_tickets(spark, log):
    tickets = spark.table("bronze.raw_billets")
    sold = silver.sold_tickets(tickets)
    assert tuple(sold.columns) == silver.TICKET_COLUMNS
    assert sorted(r.ticket_id for r in sold.collect()) == [1, 1, 2, 3, 8, 9]
    assert rows(silver.kept_share(tickets)) == [(11, 6, pytest.approx(54.545454, abs=1e-5))]
    assert rows(silver.kept_share(tickets.limit(0))) == [(0, 0, 0.0)]


# --- analysis ------------------------------------------------------------------------------


def test_weakest_matches_skip_unknown_rates(fact):
    assert [r.match_id for r in analysis.weakest_matches(fact).collect()] == ["M002", "M001"]
    assert [r.match_id for r in analysis.weakest_matches(fact, 1).collect()] == ["M002"]


def test_survey_means_weigh_matches(spark, fact, log):
    scores = analysis.match_scores(fact, spark.table("silver.satisfaction"))
    assert rows(scores) == [("M001", 1, 8.5, 2), ("M002", 0, 5.5, 1)]
    assert rows(analysis.score_by_result(scores)) == [(0, 5.5, 1, "Défaite"), (1, 8.5, 1, "Victoire")]


def test_penetration(spark, log):
    population = analysis.population_by_postcode(
        spark.table("bronze.raw_population_arrondissements"), spark.table("bronze.raw_population_communes")
    )
    assert rows(population) == [("75001", 16000), ("94300", 50000), ("94301", 50000)]
    contacts = spark.table("silver.contacts")
    assert rows(analysis.penetration(contacts, population)) == [("75001", 2, 16000, 0.12), ("94300", 1, 50000, 0.02)]
    assert rows(analysis.penetration_coverage(contacts, population)) == [(2, 1)]
    assert rows(analysis.unmatched_postcodes(contacts, population)) == [(1,)]


def test_funnel(spark, log):
    assert rows(analysis.funnel(spark.table("silver.web_evenements"))) == [(0, 2, 0, 1, 50.0)]
    empty = analysis.funnel(spark.table("silver.web_evenements").limit(0)).first()
    assert tuple(empty) == (0, 0, 0, 0, None)


def test_a_channel_of_exactly_the_limit_is_left_out(spark):
    sessions = spark.range(2001).select(
        F.when(F.col("id") < 1000, "a").otherwise("b").alias("source"), F.lit("m").alias("medium"),
        F.when(F.col("id") % 2 == 0, 5.0).alias("revenue"),
    )
    assert rows(analysis.conversion_by_channel(sessions)) == [("b", "m", 1001, 50.05)]


def test_campaign_without_deliveries(spark, log):
    assert rows(analysis.campaign_rates(spark.table("bronze.raw_campagnes_evenements"))) == [("SMS", 1, 100.0, 0.0), ("WEB", 0, None, None)]


def test_scorecard_without_values(fact):
    empty = analysis.scorecard_text(analysis.scorecard(fact.limit(0))).first()
    assert tuple(empty) == ("N/A", "N/A", "N/A", "N/A", "0")


def test_order_of_first_appearance_and_of_the_week(fact):
    assert [r.competition for r in analysis.fill_by_competition_over_time(fact).collect()] == ["EuroLeague", "Betclic ÉLITE"]
    assert [(r.jour_semaine, r.position) for r in analysis.fill_by_weekday_in_week_order(fact).collect()] == [("Friday", 4)]


# --- checks -----------------------------------------------------------------------------------

FACT = (
    "match_id string, capacite_salle int, taux_remplissage double, taux_presence double, "
    "rang_pbb_avant int, rang_adversaire_avant int"
)
SOUND = [("M1", 10, 0.5, 0.9, 1, 2), ("M2", 10, 1.02, 1.05, 2, 3), ("M3", 10, None, None, None, None)]
BROKEN = {
    "match_id_unique": ("M1", 10, 0.5, 0.9, 1, 2),
    "fill_within_bounds": ("M4", 10, 1.021, 0.9, 1, 2),
    "attendance_within_bounds": ("M4", 10, 0.5, 1.051, 1, 2),
    "capacity_positive": ("M4", 0, 0.5, 0.9, 1, 2),
    "ranks_positive": ("M4", 10, 0.5, 0.9, 1, 0),
}


def failed(report):
    return {r.check for r in report.collect() if not r.passed}


def test_fact_checks_pass_and_fail(spark):
    good = spark.createDataFrame(SOUND, FACT)
    assert failed(quality.fact_checks(good, good)) == set()
    for name, row in BROKEN.items():
        bad = spark.createDataFrame([*SOUND, row], FACT)
        assert failed(quality.fact_checks(bad, bad)) == {name}
    assert failed(quality.fact_checks(good, good.limit(2))) == {"row_count_as_calendar"}
    flat = good.withColumn("rang_pbb_avant", F.lit(4))
    assert failed(quality.fact_checks(flat, flat)) == {"own_rank_varies"}


def test_share_checks_pass_and_fail(spark):
    till = spark.range(1000).select(F.col("id").alias("ligne_id"), F.lit("2025-01-01").cast("date").alias("date_vente"))
    few = till.withColumn("date_vente", F.when(F.col("ligne_id") >= 9, F.col("date_vente")))
    many = till.withColumn("date_vente", F.when(F.col("ligne_id") >= 10, F.col("date_vente")))
    assert failed(quality.till_checks(few)) == set()
    assert failed(quality.till_checks(many)) == {"till_dates_unreadable"}
    assert failed(quality.till_checks(till.unionAll(till.limit(20)))) == {"till_duplicates"}
    assert failed(quality.till_checks(till.limit(0))) == set()

    scans = spark.range(100).select(F.when(F.col("id") > 0, "OK").alias("resultat"))
    assert failed(quality.scan_checks(scans)) == {"scans_without_result"}
    assert failed(quality.scan_checks(scans.filter("resultat is not null"))) == set()

    assert failed(quality.ticket_checks(scans.limit(3), scans)) == set()
    assert failed(quality.ticket_checks(scans, scans.limit(3))) == {"sold_tickets_within_all"}

    people = spark.createDataFrame([("a",), ("b",)], "ext_id string")
    assert failed(quality.contact_checks(people)) == set()
    assert failed(quality.contact_checks(people.unionAll(people))) == {"contact_key_unique"}


def test_all_checks_in_one_report(spark, fact, log):
    report = quality.all_checks(
        fact, spark.table("silver.calendrier_matchs"), spark.table("silver.boutique_ventes"), spark.table("silver.scans"),
        spark.table("silver.billets"), spark.table("bronze.raw_billets"), spark.table("silver.contacts"),
    )
    assert report.count() == 12
    assert failed(report) == {"capacity_positive", "till_duplicates"}


def test_columns_in_another_order_do_not_matter(spark, raw):
    results = csv_files.read_named_csv(spark, f"{raw}/dataset/resultats_matchs.csv", schemas.RESULTS)
    turned = results.select(*reversed(results.columns))
    assert rows(gold.home_results(turned)) == rows(gold.home_results(results))


def test_of_two_results_the_known_one_stays(spark):
    results = spark.createDataFrame(
        [("DOMICILE", 80, 70, 3, 9), ("DOMICILE", None, None, None, None)],
        "lieu string, score_domicile int, score_exterieur int, rang_pbb_avant int, rang_adversaire_avant int",
    ).withColumn("date", F.lit("2025-01-01").cast("date"))
    assert [tuple(r)[1:] for r in gold.home_results(results).collect()] == [(3, 9, 80, 70)]
    assert [r.n_results for r in gold.dates_with_several_results(results).collect()] == [2]


def test_codes_meet_folded_tickets_only(spark):
    types = spark.createDataFrame([(1, "ABONNEMENT"), (1, "X"), (2, "BILLET_UNITE")], "id int, code string")
    assert rows(gold.types_with_several_codes(types)) == [(1, 2)]
    tickets = spark.createDataFrame(
        [(1, 1, 5.0, 1, False), (1, 1, 5.0, 1, False), (1, 2, 7.0, 8, False), (2, None, None, 1, None)],
        "session_id int, product_type_id int, amount double, order_status_id int, product_is_cancelled boolean",
    )
    got = {r.session_id: (r.n_tickets, r.n_sold, r.revenue, r.n_subscription, r.n_single) for r in gold.tickets_by_session(tickets, types).collect()}
    assert got == {1: (3, 2, 10.0, 2, 0), 2: (1, 0, None, None, None)}


def test_scratch_must_be_shared_unless_local(monkeypatch):
    class Session:
        class conf:  # noqa: N801
            get = staticmethod(lambda key, default: None)

        class sparkContext:  # noqa: N801
            master = "spark://host:7077"

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.scratch_path(Session, "x")
    Session.sparkContext.master = "local[2]"
    assert "/x-" in session.scratch_path(Session, "x")
