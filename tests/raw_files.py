"""A small raw folder with every known defect, written as the sources deliver it."""

from __future__ import annotations

import json
from pathlib import Path

SCAN_HEADER = "barcode,scan_ts_utc,portique,ext_id,type_billet,resultat"


def order(order_id, status, products, customer="C1"):
    return {
        "order_id": order_id, "event_id": 1, "order_status_id": status, "channel_id": 2,
        "customer": {"external_id": customer}, "creation_date": "2025-09-01T10:00:00",
        "validation_date": "2025-09-01T10:05:00", "is_secondary_market": False, "products": products,
    }


def product(kind, cancelled, tickets):
    return {
        "order_product_id": kind * 10, "product_type_id": kind, "is_cancelled": cancelled, "amount_inc_tax": 50.0,
        "tickets": tickets,
    }


def ticket(number, session, amount=30.0):
    return {
        "ticket_id": number, "bar_code": f"B{number}", "category_id": 1, "session_id": session, "amount": amount,
        "ticket_status_id": 1, "seats": {"gate": "G1", "stand": "S", "row": "R", "number": str(number)},
    }


INCLUDED = {
    "sessions": [
        {"id": 1, "start_at": "2025-10-03T20:45:00"},
        {"id": 2, "start_at": "2025-10-17T19:00:00"},
        {"id": 3, "start_at": "2025-10-26T16:30:00"},
    ],
    "product_types": [{"id": 1, "code": "ABONNEMENT"}, {"id": 2, "code": "BILLET_UNITE"}],
    "order_status": [{"id": 1, "name": "Validée"}, {"id": 8, "name": "Annulée"}],
}

FIRST_DROP = {
    "orders": [
        order(1, 1, [product(1, False, [ticket(1, 1), ticket(2, 1, 20.0)]), product(2, False, [ticket(3, 1, 10.005)])]),
        order(2, 8, [product(2, False, [ticket(4, 1)])]),
        order(3, 1, [product(2, True, [ticket(5, 1)]), product(2, None, [ticket(6, 1)])]),
        order(4, 1, []),
        order(5, 1, [product(1, False, [])]),
        order(6, 4, [product(2, False, [ticket(7, 2)])]),
    ],
    "included": INCLUDED,
}
SECOND_DROP = {
    "orders": [
        order(7, 1, [product(9, False, [ticket(8, 2, 40.0), ticket(9, 2, None)])], customer=None),
        order(8, 9, [product(1, False, [ticket(10, 2)])]),
        order(9, 1, [product(1, False, [ticket(1, 99)])]),
    ],
    "included": {**INCLUDED, "sessions": INCLUDED["sessions"] + [{"id": 77, "start_at": "2030-01-01T00:00:00"}]},
}

CALENDAR = """match_id,date,heure,competition,journee,adversaire,salle,capacite_salle,arbitre
M001,2025-10-03,20:45,EuroLeague,J1,"Club, A",Arena,4,7
M002,2025-10-17,19:00:00,Betclic ÉLITE,J2,Club B,Arena,10,8
M003,2025-10-26,16:30,Betclic ÉLITE Playoffs,J3,Club C,Arena,0,9
"""
RESULTS = """date,lieu,score_domicile,score_exterieur,rang_pbb_avant,rang_adversaire_avant,bilan_pbb,bilan_adversaire
2025-10-03,DOMICILE,90,80,3,10,1-0,0-1
2025-10-17,DOMICILE,70,80,4,2,1-1,2-0
2025-10-10,EXTERIEUR,70,80,5,2,1-1,2-0
"""
CONTACTS = """ext_id,nom,prenom,genre,date_naissance,telephone,code_postal,pays,segment,date_creation,optin_email,canal_acquisition,joueur_prefere
C1,Un,A,F,1990-05-03,,75001,FR,S,2024-01-05,true,WEB,
C2,Deux,B,M,03/05/1990,,75001,FR,S,2024-01-05,false,WEB,
C3,Trois,C,F,inconnue,,94300,FR,S,x,oui,WEB,
C4,Quatre,D,M,,,99999,FR,S,2024-01-05,1,WEB,
C5,Cinq,E,M,03-05-1990,,,FR,S,2024-01-05,0,WEB,
"""
TILL_HEADER = (
    "LIGNE_ligne;LIGNE_vente;LIGNE_CodeMag;LIGNE_Famille;LIGNE_Rayon;PRODUIT_ssfamille;LIGNE_Designation;LIGNE_Couleur;"
    "LIGNE_Taille;LIGNE_PrixVente;LIGNE_Quantite;LIGNE_Total;LIGNE_Motif;VENTE_vente;VENTE_date;VENTE_codemag;"
    "VENTE_total;VENTE_nature;VENTe_client;CLIENT_Regroupement;VENTE_Etat"
)
TILL = [
    "1;10;M;F;R;SF;Maillot;B;L;39,00;1;39,00;;10;2025-10-03;M;39,00;V;C1;G;VALIDEE",
    "1;10;M;F;R;SF;Maillot;B;L;39,00;1;39,00;;10;2025-10-03;M;39,00;V;C1;G;VALIDEE",
    "1;11;M;F;R;SF;Maillot;B;L;39,00;1.5;58,50;;11;2025-10-03;M;58,50;V;C1;G;VALIDEE",
    "2;12;M;F;R;SF;Maillot;B;L;1250,5;;x;;12;03/10/2025;M;;V;C1;G;ANNULEE",
    "2;12;M;F;R;SF;Maillot;B;L;1250,5;;x;;12;03-10-2025;M;;V;C1;G;ANNULEE",
]


def write(root: Path) -> Path:
    """The folder; returns its path."""

    def text(path: str, content: str) -> None:
        target = root / path
        target.parent.mkdir(parents=True, exist_ok=True)
        target.write_text(content, encoding="utf-8")

    def document(path: str, content) -> None:
        text(path, json.dumps(content, indent=2, ensure_ascii=False))

    text("dataset/calendrier_matchs.csv", CALENDAR)
    text("dataset/resultats_matchs.csv", RESULTS)
    text("dataset/satisfaction.csv", "match_id,type_enquete,note_globale\nM001,POST_MATCH,9\nM001,POST_MATCH,8\n,SAISON,1\nM002,POST_MATCH,5.5\n")
    text("dataset/web_sessions.csv", "session_id,source,medium,revenue\ns1,google,cpc,12.5\ns2,google,cpc,\n")
    text("dataset/web_evenements.csv", "session_id,event_name\ns1,add_to_cart\ns1,purchase\ns2,add_to_cart\n")
    text("dataset/campagnes_evenements.csv", "canal,evenement\nSMS,DELIVRE\nSMS,OUVERTURE\nWEB,CLIC\n")
    text("dataset/effectif.csv", "joueur,numero,taille,naissance\nUn,7,1.98,1999-01-02\nDeux,23,2.05,2001-03-04\n")
    text("dataset/contacts.csv", CONTACTS)
    text("dataset/boutique_ventes_avoirs.csv", "\n".join([TILL_HEADER, *TILL]) + "\n")

    scan = "B{0},2025-10-03 19:{0}0:00,P1,C1,X,{1}"
    text("sftp/scans/scan_20251003.csv", "\n".join([SCAN_HEADER, scan.format(1, "OK"), scan.format(1, "OK"), scan.format(2, "KO")]) + "\n")
    text("sftp/scans/scan_20251017.csv", "\n".join([scan.format(3, "OK"), scan.format(4, "OK")]) + "\n")
    text("sftp/scans/scan_20251026.csv", "")
    text("sftp/scans/scan_20251102.csv", "\n".join([SCAN_HEADER, scan.format(5, "OK"), "B6,2025-11"]) + "\n")

    document("sftp/orders/ORDERS_20250901_235959.json", FIRST_DROP)
    document("sftp/orders/ORDERS_20250902_235959.json", SECOND_DROP)
    whole = json.dumps(FIRST_DROP, indent=2)
    text("sftp/orders/ORDERS_20250903_235959.json", whole[: len(whole) // 3])
    text("sftp/orders/ORDERS_20250904_235959.json", "")

    document(
        "plan_api/open_meteo/paris_horaire.json",
        {"hourly": {"time": ["2025-10-03T20:00", "2025-10-03T20:00", "2025-10-17T19:00"], "temperature_2m": [12.5, 12.0, 9.0],
                    "apparent_temperature": [11.0, 11.0], "precipitation": [0.0, 0.4, 1.2], "weather_code": [1, 2, 3]}},
    )
    document("plan_api/open_meteo/zz_later.json", {"hourly": {"time": ["2030-01-01T00:00"], "temperature_2m": [99.0]}})
    document("plan_api/calendrier_scolaire/zone_c_1.json", {"results": [
        {"start_date": "2025-10-17T22:00:00+00:00", "end_date": "2025-11-02T23:00:00+00:00", "location": "Paris"},
        {"start_date": "2025-10-03T00:00:00+00:00", "end_date": "2025-10-03T00:00:00+00:00", "location": "Lyon"}]})
    document("plan_api/calendrier_scolaire/zone_c_2.json", {"results": [
        {"location": "Paris", "zones": "Zone C", "start_date": "2025-10-20T00:00:00+00:00", "end_date": "2025-10-26T00:00:00+00:00"}]})
    document("plan_api/population/communes_idf_population.json", [
        {"nom": "Paris", "codesPostaux": ["75001"], "population": 2000000},
        {"nom": "Vincennes", "codesPostaux": ["94300", "94301"], "population": 50000}])
    document("plan_api/population/arrondissements_paris_population.json", [
        {"nom": "1er", "codesPostaux": ["75001"], "population": 16000}])
    document("plan_api/euroleague/E2025/streaks_r01.json", {"winner": {"club": "A"}, "teams": [{"club": "A", "wins": 1}, {"club": "B", "wins": 0}]})
    document("plan_api/euroleague/E2025/streaks_r12.json", {"winner": {"club": "B"}, "teams": [{"club": "B", "wins": 7}]})
    return root
