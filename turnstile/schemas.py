"""Column names and types of the source files and tables.

Everything below is a fixed value: it must equal what the files contain and
what users of the tables ask for.
"""

from __future__ import annotations

CALENDAR = (
    "match_id string, date date, heure string, competition string, journee string, "
    "adversaire string, salle string, capacite_salle int"
)
RESULTS = (
    "date date, lieu string, score_domicile int, score_exterieur int, rang_pbb_avant int, "
    "rang_adversaire_avant int, bilan_pbb string, bilan_adversaire string"
)
SURVEY = "match_id string, type_enquete string, note_globale double"
WEB_SESSIONS = "session_id string, source string, medium string, revenue double"
WEB_EVENTS = "session_id string, event_name string"
CAMPAIGN_EVENTS = "canal string, evenement string"

CONTACTS = (
    "ext_id string, nom string, prenom string, genre string, date_naissance string, telephone string, "
    "code_postal string, pays string, segment string, date_creation string, optin_email string, "
    "canal_acquisition string, joueur_prefere string"
)
TILL = (
    "LIGNE_ligne string, LIGNE_vente string, LIGNE_CodeMag string, LIGNE_Famille string, LIGNE_Rayon string, "
    "PRODUIT_ssfamille string, LIGNE_Designation string, LIGNE_Couleur string, LIGNE_Taille string, "
    "LIGNE_PrixVente string, LIGNE_Quantite string, LIGNE_Total string, LIGNE_Motif string, VENTE_vente string, "
    "VENTE_date string, VENTE_codemag string, VENTE_total string, VENTE_nature string, VENTe_client string, "
    "CLIENT_Regroupement string, VENTE_Etat string"
)
SCANS = (
    "barcode string, scan_ts_utc string, portique string, ext_id string, type_billet string, resultat string"
)

ORDERS_DROP = (
    "orders array<struct<order_id: bigint, event_id: bigint, order_status_id: int, channel_id: int, "
    "customer: struct<external_id: string>, creation_date: string, validation_date: string, "
    "is_secondary_market: boolean, products: array<struct<order_product_id: bigint, product_type_id: int, "
    "is_cancelled: boolean, amount_inc_tax: double, tickets: array<struct<ticket_id: bigint, bar_code: string, "
    "category_id: int, session_id: bigint, amount: double, ticket_status_id: int, "
    "seats: struct<gate: string, stand: string, row: string, number: string>>>>>>>"
)
REFERENCE_LISTS = (
    "included struct<sessions: array<struct<id: bigint, start_at: string>>, "
    "product_types: array<struct<id: int, code: string>>, order_status: array<struct<id: int, name: string>>>"
)
WEATHER = (
    "hourly struct<time: array<string>, temperature_2m: array<double>, apparent_temperature: array<double>, "
    "precipitation: array<double>, weather_code: array<int>>"
)
POPULATION = "nom string, codesPostaux array<string>, population bigint"

# Named CSV files with a header row: table name, file name, and schema.
# A schema of None is inferred from the whole file.
NAMED_CSV_FILES = {
    "resultats_matchs": ("resultats_matchs.csv", RESULTS),
    "satisfaction": ("satisfaction.csv", SURVEY),
    "calendrier_matchs": ("calendrier_matchs.csv", CALENDAR),
    "campagnes": ("campagnes.csv", None),
    "effectif": ("effectif.csv", None),
    "animations_participations": ("animations_participations.csv", None),
    "fb_transactions": ("fb_transactions.csv", None),
    "web_sessions": ("web_sessions.csv", WEB_SESSIONS),
    "web_evenements": ("web_evenements.csv", WEB_EVENTS),
    "campagnes_evenements": ("campagnes_evenements.csv", CAMPAIGN_EVENTS),
}

# Order status codes.
STATUS_VALID = 1
STATUS_PENDING = 4
STATUS_CANCELLED = 8
STATUS_REFUNDED = 9

# Product codes counted apart.
CODE_SUBSCRIPTION = "ABONNEMENT"
CODE_SINGLE = "BILLET_UNITE"

# Labels tested for equality.
HOME = "DOMICILE"
SCAN_OK = "OK"
SALE_CANCELLED = "ANNULEE"
POST_MATCH = "POST_MATCH"
HOLIDAY_LOCATION = "Paris"
CITY_COUNTED_BY_DISTRICT = "Paris"
DELIVERED, OPENED, CLICKED = "DELIVRE", "OUVERTURE", "CLIC"

# Steps of the online shop: result column and event name.
FUNNEL_STEPS = {
    "vue_liste": "view_item_list",
    "panier": "add_to_cart",
    "checkout": "begin_checkout",
    "achat": "purchase",
}

# Clean bronze tables copied to silver unchanged.
COPIED_TABLES = (
    "resultats_matchs",
    "satisfaction",
    "calendrier_matchs",
    "campagnes",
    "effectif",
    "animations_participations",
    "fb_transactions",
    "web_sessions",
    "web_evenements",
    "campagnes_evenements",
    "scans",
)
