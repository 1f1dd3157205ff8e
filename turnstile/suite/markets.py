"""Queries on web, campaign, contact and population tables."""

from __future__ import annotations

from pyspark.sql import DataFrame

from turnstile.plans import analysis
from turnstile.suite.catalogue import query, rounded
from turnstile.suite.standins import Inputs


@query("""
    SELECT vue_liste, panier, checkout, achat,
           CASE WHEN panier > 0 THEN round(CAST(100 * achat AS DOUBLE) / panier, 9) END AS panier_achat_pct
    FROM (SELECT CAST(count_if(list_contains(steps, 'view_item_list')) AS BIGINT) AS vue_liste,
                 CAST(count_if(list_contains(steps, 'add_to_cart')) AS BIGINT) AS panier,
                 CAST(count_if(list_contains(steps, 'begin_checkout')) AS BIGINT) AS checkout,
                 CAST(count_if(list_contains(steps, 'purchase')) AS BIGINT) AS achat
          FROM (SELECT session_id, list(event_name) AS steps FROM web_events
                WHERE session_id IS NOT NULL GROUP BY session_id))""")
def shop_funnel(inputs: Inputs) -> DataFrame:
    return rounded(analysis.funnel(inputs.web_events()))


@query("SELECT * FROM conversion")
def conversion_by_channel(inputs: Inputs) -> DataFrame:
    return analysis.conversion_by_channel(inputs.web_sessions())


@query("""
    SELECT source || ' / ' || medium AS canal_label, taux_conversion_pct, taux_conversion_pct > 15 AS est_fort
    FROM conversion""")
def conversion_bands(inputs: Inputs) -> DataFrame:
    return analysis.conversion_bands(analysis.conversion_by_channel(inputs.web_sessions()))


@query("""
    SELECT canal, CAST(coalesce(n['DELIVRE'], 0) AS BIGINT) AS delivres,
           round(CAST(100 * coalesce(n['OUVERTURE'], 0) AS DOUBLE) / n['DELIVRE'], 1) AS taux_ouverture_pct,
           round(CAST(100 * coalesce(n['CLIC'], 0) AS DOUBLE) / n['OUVERTURE'], 1) AS taux_clic_pct
    FROM (SELECT canal, histogram(evenement) AS n FROM campaign_events GROUP BY canal)""")
def campaign_rates(inputs: Inputs) -> DataFrame:
    return analysis.campaign_rates(inputs.campaign_events())


def _population(inputs: Inputs) -> DataFrame:
    return analysis.population_by_postcode(inputs.districts(), inputs.towns())


@query("SELECT * FROM population")
def population_by_postcode(inputs: Inputs) -> DataFrame:
    return _population(inputs)


@query("SELECT * FROM penetration")
def penetration(inputs: Inputs) -> DataFrame:
    return analysis.penetration(inputs.raw_contacts(), _population(inputs))


@query("""
    SELECT * FROM penetration ORDER BY contacts_pour_1000_hab DESC, code_postal LIMIT 15""")
def top_zones(inputs: Inputs) -> DataFrame:
    return analysis.top_zones(analysis.penetration(inputs.raw_contacts(), _population(inputs)))


@query("""
    SELECT count(population) AS n_connus, count(*) FILTER (WHERE population IS NULL) AS n_inconnus
    FROM contacts_by_postcode LEFT JOIN population USING (code_postal)""")
def penetration_coverage(inputs: Inputs) -> DataFrame:
    return analysis.penetration_coverage(inputs.raw_contacts(), _population(inputs))


@query("""
    SELECT count(*) AS n_unmatched FROM contacts_by_postcode
    WHERE code_postal NOT IN (SELECT code_postal FROM population)""")
def unmatched_postcodes(inputs: Inputs) -> DataFrame:
    return analysis.unmatched_postcodes(inputs.raw_contacts(), _population(inputs))
