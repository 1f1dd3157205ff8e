"""SQL counterparts of the stand-in tables, as named table expressions."""

from __future__ import annotations

# Fixed text: one entry per derived table; later ones may use earlier ones.
TABLES = {
    "tickets": """
        SELECT l_orderkey AS session_id, l_orderkey AS order_id, l_partkey AS ticket_id,
               l_orderkey || '-' || l_linenumber AS bar_code, l_linenumber AS product_type_id,
               l_extendedprice AS amount,
               CASE WHEN l_returnflag = 'N' THEN 1 WHEN l_returnflag = 'A' THEN 8
                    WHEN l_linestatus = 'F' THEN 9 ELSE 4 END AS order_status_id,
               CASE WHEN l_discount > 0 THEN l_discount > 0.08 END AS product_is_cancelled,
               CAST(l_suppkey AS VARCHAR) AS ext_id, CAST(l_linenumber % 3 AS INTEGER) AS category_id,
               CAST(l_linenumber % 2 AS INTEGER) AS ticket_status_id,
               strftime(l_shipdate, '%Y-%m-%d') AS order_creation_date,
               CASE WHEN l_returnflag = 'N' THEN strftime(l_shipdate, '%Y-%m-%d') END AS order_validation_date,
               'G' || l_linenumber AS seat_gate, l_returnflag AS seat_stand, l_linestatus AS seat_row,
               CAST(l_partkey AS VARCHAR) AS seat_number,
               l_shipdate
        FROM lineitem""",
    "sessions": "SELECT o_orderkey AS id, o_orderdate AS start_at FROM orders",
    "product_types": """
        SELECT r_regionkey + 1 AS id,
               CASE r_name WHEN 'AFRICA' THEN 'ABONNEMENT' WHEN 'AMERICA' THEN 'BILLET_UNITE' ELSE r_name END AS code
        FROM region""",
    "scans": """
        SELECT l_orderkey || '-' || l_linenumber AS barcode,
               CASE WHEN l_linestatus = 'F' THEN 'OK' WHEN l_tax > 0 THEN 'KO' END AS resultat,
               strftime(l_shipdate, '%Y%m%d') AS date_fichier
        FROM lineitem""",
    "calendar": """
        SELECT 'M' || strftime(date, '%Y%m%d') AS match_id, date,
               CASE dayname(date) WHEN 'Sunday' THEN '16:30' WHEN 'Saturday' THEN '18:00'
                    WHEN 'Monday' THEN '13:30:00' WHEN 'Friday' THEN '20:45' ELSE '19:15' END AS heure,
               CASE WHEN month(date) IN (5, 6) THEN 'Betclic ÉLITE Playoffs'
                    WHEN dayname(date) IN ('Tuesday', 'Wednesday', 'Thursday') THEN 'EuroLeague'
                    ELSE 'Betclic ÉLITE' END AS competition,
               'J' || day(date) AS journee, 'Club ' || month(date) AS adversaire, 'Arena' AS salle,
               capacite_salle
        FROM (SELECT CAST(o_orderdate AS DATE) AS date, CAST(count(*) * 2 AS INTEGER) AS capacite_salle
              FROM orders GROUP BY 1)""",
    "results": """
        SELECT date, CASE WHEN o_orderstatus = 'F' THEN 'DOMICILE' ELSE 'EXTERIEUR' END AS lieu,
               rang_pbb_avant, rang_adversaire_avant,
               CASE WHEN dayname(date) <> 'Wednesday' THEN home END AS score_domicile,
               CASE WHEN dayname(date) <> 'Wednesday' THEN away END AS score_exterieur
        FROM (SELECT CAST(o_orderdate AS DATE) AS date, o_orderstatus,
                     CAST(sum(o_custkey) % 18 + 1 AS INTEGER) AS rang_pbb_avant,
                     CAST(max(o_custkey) % 18 + 1 AS INTEGER) AS rang_adversaire_avant,
                     CAST(min(o_custkey) % 40 + 60 AS INTEGER) AS home,
                     CAST(max(o_orderkey) % 40 + 60 AS INTEGER) AS away
              FROM orders GROUP BY 1, 2)""",
    "holidays": """
        SELECT strftime(first, '%Y-%m-%d') || 'T00:00:00+00:00' AS start_date,
               strftime(first + INTERVAL 3 DAY, '%Y-%m-%d') || 'T00:00:00+00:00' AS end_date,
               CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'Paris' ELSE 'Lyon' END AS location
        FROM (SELECT date_trunc('month', o_orderdate) AS m, o_orderpriority, min(CAST(o_orderdate AS DATE)) AS first
              FROM orders GROUP BY 1, 2)""",
    "weather": """
        SELECT l_shipdate + to_hours(l_linenumber + 12) AS hour_ts,
               strftime(l_shipdate, '%Y-%m-%d') || 'T' || (l_linenumber + 12) || ':00' AS heure,
               l_quantity AS temperature, l_tax * 10.0 AS precipitation
        FROM lineitem""",
    "weather_hour": """
        SELECT hour_ts, temperature, precipitation FROM weather
        QUALIFY row_number() OVER (PARTITION BY hour_ts ORDER BY temperature, precipitation) = 1""",
    "home_results": "SELECT * FROM results WHERE lieu = 'DOMICILE'",
    # every value of a day under its name; a name is missing where the value is unknown
    "dated_tickets": """
        SELECT CAST(start_at AS DATE) AS day, amount, order_status_id AS state,
               (SELECT min(code) FROM product_types p WHERE p.id = product_type_id) AS code,
               order_status_id = 1 AND product_is_cancelled IS NOT DISTINCT FROM false AS is_sold
        FROM sessions JOIN tickets ON session_id = id""",
    "day_values": """
        SELECT day, map_from_entries(list((name, value))) AS v FROM (
            SELECT day, unnest(['all', 'cancelled', 'refunded', 'pending']) AS name,
                   unnest([count(*), sum((state = 8)::INT), sum((state = 9)::INT), sum((state = 4)::INT)]::DOUBLE[]) AS value
            FROM dated_tickets GROUP BY day
            UNION ALL
            SELECT day, unnest(['sold', 'season', 'single', 'revenue', 'price']),
                   unnest([count(*), sum(coalesce(code = 'ABONNEMENT', false)::INT),
                           sum(coalesce(code = 'BILLET_UNITE', false)::INT), sum(amount), avg(amount)]::DOUBLE[])
            FROM dated_tickets WHERE is_sold GROUP BY day
            UNION ALL
            SELECT CAST(strptime(date_fichier, '%Y%m%d') AS DATE), 'entries', sum((resultat IS NOT DISTINCT FROM 'OK')::INT)
            FROM scans GROUP BY 1
            UNION ALL
            SELECT date, unnest(['own', 'theirs', 'home', 'away']),
                   unnest([rang_pbb_avant, rang_adversaire_avant, score_domicile, score_exterieur]::DOUBLE[])
            FROM home_results
            UNION ALL
            SELECT DISTINCT CAST(unnest(generate_series(CAST(start_date[:10] AS DATE), CAST(end_date[:10] AS DATE),
                                                        INTERVAL 1 DAY)) AS DATE), 'holiday', 1
            FROM holidays WHERE location = 'Paris')
        WHERE value IS NOT NULL GROUP BY day""",
    "by_date": """
        SELECT day AS date_match, CAST(v['all'] AS BIGINT) AS billets_total, CAST(v['sold'] AS BIGINT) AS billets_vendus,
               v['revenue'] AS revenu_billetterie, v['price'] AS prix_moyen,
               CAST(v['season'] AS BIGINT) AS billets_abonnement, CAST(v['single'] AS BIGINT) AS billets_unite,
               CAST(v['cancelled'] AS BIGINT) AS billets_annules, CAST(v['refunded'] AS BIGINT) AS billets_rembourses,
               CAST(v['pending'] AS BIGINT) AS billets_en_attente
        FROM day_values WHERE v['all'] IS NOT NULL""",
    "scans_by_token": """
        SELECT strftime(day, '%Y%m%d') AS date_fichier, CAST(v['entries'] AS BIGINT) AS entrees_ok
        FROM day_values WHERE v['entries'] IS NOT NULL""",
    "fact": """
        SELECT match_id, date, heure, competition, journee, adversaire, salle, capacite_salle,
               CAST(v['sold'] AS BIGINT) AS billets_vendus,
               CASE WHEN capacite_salle <> 0 THEN round(v['sold'] / capacite_salle, 3) END AS taux_remplissage,
               v['revenue'] AS revenu_billetterie,
               CAST(round(CAST(v['price'] AS DECIMAL(28, 6)), 2) AS DOUBLE) AS prix_moyen_billet,
               CAST(v['season'] AS BIGINT) AS billets_abonnement, CAST(v['single'] AS BIGINT) AS billets_unite,
               round(v['single'] / v['sold'], 3) AS part_billets_unite,
               CAST(v['cancelled'] AS BIGINT) AS billets_annules, CAST(v['refunded'] AS BIGINT) AS billets_rembourses,
               CAST(v['pending'] AS BIGINT) AS billets_en_attente, round(v['cancelled'] / v['all'], 3) AS taux_annulation,
               CAST(v['entries'] AS BIGINT) AS entrees_ok, round(v['entries'] / v['sold'], 3) AS taux_presence,
               CAST(v['own'] AS INTEGER) AS rang_pbb_avant, CAST(v['theirs'] AS INTEGER) AS rang_adversaire_avant,
               CAST(v['theirs'] - v['own'] AS INTEGER) AS ecart_classement,
               CAST(v['home'] AS INTEGER) AS score_domicile, CAST(v['away'] AS INTEGER) AS score_exterieur,
               CAST(coalesce(v['home'] > v['away'], false) AS INTEGER) AS victoire_pbb,
               dayname(date) AS jour_semaine, v['holiday'] IS NOT NULL AS vacances_scolaires, temperature, precipitation
        FROM calendar LEFT JOIN day_values ON day = date
        LEFT JOIN weather_hour ON hour_ts = date + to_hours(CAST(split_part(heure, ':', 1) AS BIGINT))""",
    "survey": """
        SELECT 'M' || strftime(l_shipdate, '%Y%m%d') AS match_id,
               CASE WHEN l_linestatus = 'F' THEN 'POST_MATCH' ELSE 'SAISON' END AS type_enquete,
               l_quantity / 5.0 AS note_globale
        FROM lineitem""",
    "match_scores": """
        SELECT match_id, victoire_pbb,
               list_sum([g.key * g.value FOR g IN map_entries(grades)]) / list_sum(map_values(grades)) AS note_globale_moy,
               CAST(list_sum(map_values(grades)) AS BIGINT) AS n_reponses
        FROM (SELECT match_id, histogram(note_globale) AS grades FROM survey WHERE type_enquete = 'POST_MATCH' GROUP BY match_id)
        JOIN fact USING (match_id)""",
    "kickoff": """
        SELECT *, CAST(split_part(heure, ':', 1) AS INTEGER) * 60 + CAST(split_part(heure, ':', 2) AS INTEGER)
                  AS heure_minutes,
               CASE WHEN CAST(split_part(heure, ':', 1) AS INTEGER) < 18 THEN 'Après-midi' ELSE 'Soirée' END AS creneau,
               coalesce(precipitation > 0, false) AS pluie
        FROM fact""",
    "web_events": """
        SELECT user_id || '-' || strftime(ts, '%Y%m%d') AS session_id,
               CASE event_type WHEN 'view' THEN 'view_item_list' WHEN 'click' THEN 'add_to_cart'
                    WHEN 'signup' THEN 'begin_checkout' ELSE event_type END AS event_name
        FROM events""",
    "web_sessions": """
        SELECT event_type AS source, CASE WHEN hour(ts) < 12 THEN 'matin' ELSE 'soir' END AS medium,
               CASE WHEN event_type = 'purchase' THEN value WHEN event_type <> 'view' THEN value - 50.0 END AS revenue
        FROM events""",
    "conversion": """
        SELECT source, medium, seen.n AS sessions, round(100.0 * coalesce(bought.n, 0) / seen.n, 2) AS taux_conversion_pct
        FROM (SELECT source, medium, count(*) AS n FROM web_sessions GROUP BY source, medium) AS seen
        LEFT JOIN (SELECT source, medium, count(*) AS n FROM web_sessions WHERE revenue > 0 GROUP BY source, medium) AS bought
        USING (source, medium) WHERE seen.n > 1000""",
    "campaign_events": """
        SELECT CASE WHEN event_type = 'error' THEN 'WEB' WHEN value > 20 THEN 'SMS' ELSE 'EMAIL' END AS canal,
               CASE event_type WHEN 'view' THEN 'DELIVRE' WHEN 'click' THEN 'OUVERTURE'
                    WHEN 'purchase' THEN 'CLIC' ELSE 'AUTRE' END AS evenement
        FROM events""",
    "raw_contacts": """
        SELECT CAST(c_custkey AS VARCHAR) AS ext_id, c_name AS nom,
               CASE WHEN c_mktsegment = 'BUILDING' THEN strftime(born, '%Y-%m-%d')
                    WHEN c_mktsegment = 'MACHINERY' THEN strftime(born, '%d/%m/%Y')
                    WHEN c_mktsegment = 'HOUSEHOLD' THEN day(born) || '/' || month(born) || '/' || year(born) || ' '
                    WHEN c_mktsegment = 'FURNITURE' THEN 'inconnue'
                    WHEN c_acctbal >= 0 THEN '' END AS date_naissance,
               CASE WHEN c_acctbal >= 0 THEN CAST(c_nationkey + 75000 AS VARCHAR)
                    WHEN c_mktsegment <> 'BUILDING' THEN CAST(c_nationkey + 99000 AS VARCHAR) END AS code_postal,
               c_mktsegment AS segment,
               year(born) || '/' || month(born) || '/' || day(born) AS date_creation,
               CASE c_mktsegment WHEN 'BUILDING' THEN 'true' WHEN 'MACHINERY' THEN 'No' WHEN 'HOUSEHOLD' THEN '1'
                    WHEN 'FURNITURE' THEN 'oui' ELSE 'F' END AS optin_email,
               'N° ' || (c_custkey % 100) AS prenom, CASE WHEN c_custkey % 2 = 0 THEN 'F' WHEN c_custkey % 3 = 0 THEN 'M' END AS genre,
               '+33 ' || c_custkey AS telephone, CASE WHEN c_acctbal >= 0 THEN 'France' ELSE 'Belgique, BE' END AS pays,
               lower(c_mktsegment) AS canal_acquisition,
               CASE WHEN c_nationkey > 12 THEN 'Joueur "' || c_nationkey || '"' END AS joueur_prefere
        FROM (SELECT *, CAST(DATE '1950-01-01' + CAST(c_custkey % 18000 AS INTEGER) AS DATE) AS born FROM customer)""",
    "contacts": """
        SELECT ext_id, nom, prenom, genre, telephone, pays, canal_acquisition, joueur_prefere,
               CASE WHEN len(born) = 3 THEN CASE WHEN length(born[1]) = 4
                    THEN make_date(CAST(born[1] AS BIGINT), CAST(born[2] AS BIGINT), CAST(born[3] AS BIGINT))
                    ELSE make_date(CAST(born[3] AS BIGINT), CAST(born[2] AS BIGINT), CAST(born[1] AS BIGINT)) END
               END AS date_naissance,
               code_postal, segment,
               make_date(CAST(made[1] AS BIGINT), CAST(made[2] AS BIGINT), CAST(made[3] AS BIGINT)) AS date_creation,
               CASE WHEN lower(optin_email) IN ('true', 't', 'yes', 'y', '1') THEN true
                    WHEN lower(optin_email) IN ('false', 'f', 'no', 'n', '0') THEN false END AS optin_email
        FROM (SELECT *, regexp_extract_all(date_naissance, '[0-9]+') AS born,
                     regexp_extract_all(date_creation, '[0-9]+') AS made FROM raw_contacts)""",
    "nation_suppliers": """
        SELECT n_nationkey, n_name, n_regionkey, count(s_suppkey) AS n
        FROM nation LEFT JOIN supplier ON s_nationkey = n_nationkey GROUP BY 1, 2, 3""",
    "towns": """
        SELECT CASE WHEN n_name = 'NATION_0' THEN 'Paris' ELSE n_name END AS nom,
               [CAST(75000 + n_nationkey AS VARCHAR), CAST(75001 + n_nationkey AS VARCHAR)] AS codes,
               n * 1000 + 500 AS population
        FROM nation_suppliers""",
    "districts": """
        SELECT r_name AS nom, [CAST(75000 + r_regionkey AS VARCHAR)] AS codes,
               CAST(sum(n) * 2000 AS BIGINT) AS population
        FROM region JOIN nation_suppliers ON n_regionkey = r_regionkey GROUP BY r_name, r_regionkey""",
    "population": """
        WITH places AS (SELECT codes, population FROM towns WHERE nom <> 'Paris'
                        UNION ALL SELECT codes, population FROM districts),
        known AS (SELECT DISTINCT unnest(codes) AS code_postal FROM places)
        SELECT code_postal, CAST(sum(population) AS BIGINT) AS population
        FROM known JOIN places ON list_contains(codes, code_postal) GROUP BY code_postal""",
    "contacts_by_postcode": """
        SELECT code_postal, count(*) AS nb_contacts FROM contacts WHERE code_postal IS NOT NULL GROUP BY 1""",
    "penetration": """
        SELECT code_postal, nb_contacts, population,
               round_even(CAST(nb_contacts * 1000 AS DOUBLE) / population * 100, 0) / 100 AS contacts_pour_1000_hab
        FROM contacts_by_postcode JOIN population USING (code_postal)""",
    "raw_till": """
        SELECT CAST(l_orderkey AS VARCHAR) AS ligne_id, CAST(l_linenumber AS VARCHAR) AS ticket_id,
               CAST(l_suppkey AS VARCHAR) AS magasin, 'Textile' AS famille, CAST(NULL AS VARCHAR) AS rayon,
               CAST(NULL AS VARCHAR) AS sous_famille,
               CASE WHEN l_linestatus = 'F' THEN 'Maillot' ELSE 'Écharpe' END AS designation,
               CAST(NULL AS VARCHAR) AS couleur, CAST(NULL AS VARCHAR) AS taille,
               replace(printf('%.2f', l_extendedprice), '.', ',') AS prix_vente,
               CASE WHEN l_returnflag = 'A' THEN printf('%.1f', l_quantity + 0.5)
                    WHEN l_returnflag = 'N' THEN printf('%.0f', l_quantity) ELSE '' END AS quantite,
               replace(printf('%.2f', l_extendedprice * l_quantity), '.', ',') AS total_ligne,
               CAST(NULL AS VARCHAR) AS motif_avoir, CAST(l_partkey AS VARCHAR) AS vente_id,
               CASE WHEN l_linenumber <= 2 THEN strftime(day, '%Y-%m-%d')
                    WHEN l_linenumber <= 4 THEN strftime(day, '%d/%m/%Y')
                    WHEN l_linenumber <= 6 THEN strftime(day, '%d-%m-%Y') ELSE '' END AS date_vente,
               CAST(NULL AS VARCHAR) AS vente_magasin, printf('%.2f', l_tax * 100) AS vente_total,
               l_returnflag AS nature, CAST(l_suppkey AS VARCHAR) AS ext_id, CAST(NULL AS VARCHAR) AS segment_client,
               CASE WHEN l_returnflag = 'R' THEN 'ANNULEE' ELSE 'VALIDEE' END AS etat_vente
        FROM (SELECT *, DATE '2020-01-01' + CAST(l_orderkey % 1500 AS INTEGER) AS day FROM lineitem)""",
    "till": """
        SELECT ligne_id, ticket_id, l.magasin, l.famille, l.rayon, l.sous_famille, designation, l.couleur, l.taille,
               CAST(array_to_string(string_split(l.prix_vente, ','), '.') AS DOUBLE) AS prix_vente,
               CAST(round(try_cast(l.quantite AS DOUBLE), 0) AS INTEGER) AS quantite,
               CAST(array_to_string(string_split(l.total_ligne, ','), '.') AS DOUBLE) AS total_ligne, l.motif_avoir, l.vente_id,
               CASE len(n) WHEN 3 THEN CASE WHEN length(n[1]) = 4
                    THEN make_date(CAST(n[1] AS BIGINT), CAST(n[2] AS BIGINT), CAST(n[3] AS BIGINT))
                    ELSE make_date(CAST(n[3] AS BIGINT), CAST(n[2] AS BIGINT), CAST(n[1] AS BIGINT)) END END AS date_vente,
               l.vente_magasin, CAST(l.vente_total AS DOUBLE) AS vente_total,
               l.nature, l.ext_id, l.segment_client, etat_vente
        FROM (  -- of lines with one key the smallest by what else they say
            SELECT ligne_id, ticket_id, designation, etat_vente, regexp_extract_all(date_vente, '[0-9]+') AS n,
                   min({magasin: magasin, prix_vente: prix_vente, quantite: quantite, total_ligne: total_ligne,
                        vente_id: vente_id, vente_total: vente_total, nature: nature, ext_id: ext_id, famille: famille,
                        rayon: rayon, sous_famille: sous_famille, couleur: couleur, taille: taille,
                        motif_avoir: motif_avoir, vente_magasin: vente_magasin, segment_client: segment_client}) AS l
            FROM raw_till GROUP BY ligne_id, ticket_id, designation, date_vente, etat_vente)""",
    "teams": """
        SELECT month(o_orderdate) AS round, c_nationkey AS team, count(*) AS wins,
               count(*) FILTER (WHERE o_orderstatus = 'F') AS losses
        FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2""",
}


def with_tables(query: str) -> str:
    """The query with every derived table in reach."""
    expressions = ",\n".join(f"{name} AS ({text})" for name, text in TABLES.items())
    return f"WITH {expressions}\n{query}"
