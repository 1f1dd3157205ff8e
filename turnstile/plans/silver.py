"""Typing, cleaning and filtering of the raw tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from turnstile import schemas
from turnstile.functions.numbers import ratio
from turnstile.functions.parsing import (
    DAY_FIRST_DASH,
    DAY_FIRST_SLASH,
    comma_number,
    flexible_date,
    truth_value,
    whole_number,
    year_first_date,
)
from turnstile.operators.dedupe import first_per_key

# Source column and table column of the till lines.
TILL_NAMES = {
    "LIGNE_ligne": "ligne_id",
    "LIGNE_vente": "ticket_id",
    "LIGNE_CodeMag": "magasin",
    "LIGNE_Famille": "famille",
    "LIGNE_Rayon": "rayon",
    "PRODUIT_ssfamille": "sous_famille",
    "LIGNE_Designation": "designation",
    "LIGNE_Couleur": "couleur",
    "LIGNE_Taille": "taille",
    "LIGNE_PrixVente": "prix_vente",
    "LIGNE_Quantite": "quantite",
    "LIGNE_Total": "total_ligne",
    "LIGNE_Motif": "motif_avoir",
    "VENTE_vente": "vente_id",
    "VENTE_date": "date_vente",
    "VENTE_codemag": "vente_magasin",
    "VENTE_total": "vente_total",
    "VENTE_nature": "nature",
    "VENTe_client": "ext_id",
    "CLIENT_Regroupement": "segment_client",
    "VENTE_Etat": "etat_vente",
}

# The columns that make two till lines the same line. The date is
# the text as written: one sale in two notations is two lines.
TILL_KEYS = ("ligne_id", "ticket_id", "designation", "date_vente", "etat_vente")

# Columns of the sold tickets.
TICKET_COLUMNS = (
    "bar_code",
    "ext_id",
    "session_id",
    "order_id",
    "ticket_id",
    "product_type_id",
    "category_id",
    "amount",
    "order_status_id",
    "product_is_cancelled",
    "ticket_status_id",
    "order_creation_date",
    "order_validation_date",
    "seat_gate",
    "seat_stand",
    "seat_row",
    "seat_number",
)


def contacts(raw: DataFrame) -> DataFrame:
    """Contacts with typed dates and consent flag: the thirteen columns of a contact, NULL where the source lacks one."""
    typed = {
        "date_naissance": lambda text: flexible_date(text, DAY_FIRST_SLASH),
        "date_creation": year_first_date,
        "optin_email": truth_value,
    }
    columns = StructType.fromDDL(schemas.CONTACTS).names
    given = {c: F.col(c) if c in raw.columns else F.lit(None).cast("string") for c in columns}
    return raw.select(*(typed.get(c, lambda text: text)(text).alias(c) for c, text in given.items()))


def unparsed_birth_dates(raw: DataFrame) -> DataFrame:
    """Contacts and, among them, those whose birth date has text that is not a date.

    Counted while the text is at hand; no join back to the raw table.
    """
    text = F.col("date_naissance")
    return raw.agg(
        F.count("*").alias("n_contacts"),
        F.count_if((text != "") & flexible_date(text, DAY_FIRST_SLASH).isNull()).alias("n_unparsed"),
    )


def unparsed_after_cleaning(raw: DataFrame, clean: DataFrame, key: str = "ext_id") -> DataFrame:
    """The same count from two stored tables, matched on the contact key.

    Only contacts with an unreadable date take part. Each side is counted per
    key before the join, so repeated keys multiply as numbers, not as rows.
    """
    empty = clean.filter(F.col("date_naissance").isNull()).groupBy(key).agg(F.count("*").alias("n_empty"))
    written = raw.filter(F.col("date_naissance") != "").groupBy(key).agg(F.count("*").alias("n_written"))
    return empty.join(written, key).agg(
        F.coalesce(F.sum(F.col("n_empty") * F.col("n_written")), F.lit(0)).alias("n_unparsed")
    )


def till_lines(raw: DataFrame) -> DataFrame:
    """Till lines renamed, each kept once, then typed."""
    named = raw.select(*(F.col(source).alias(name) for source, name in TILL_NAMES.items()))
    return first_per_key(named, TILL_KEYS).withColumns(
        {
            "prix_vente": comma_number(F.col("prix_vente")),
            "quantite": whole_number(F.col("quantite")),
            "total_ligne": comma_number(F.col("total_ligne")),
            "vente_total": comma_number(F.col("vente_total")),
            "date_vente": flexible_date(F.col("date_vente"), DAY_FIRST_SLASH, DAY_FIRST_DASH),
        }
    )


def cancelled_lines(till: DataFrame) -> DataFrame:
    """Lines and cancelled lines, as one row."""
    return till.agg(
        F.count("*").alias("n_lines"),
        F.count_if(F.col("etat_vente") == schemas.SALE_CANCELLED).alias("n_cancelled"),
    )


def is_sold():
    """Whether a raw ticket counts as sold; an unknown cancellation flag does not."""
    return F.coalesce(
        (F.col("order_status_id") == schemas.STATUS_VALID) & ~F.col("product_is_cancelled"), F.lit(False)
    )


def sold_tickets(raw: DataFrame) -> DataFrame:
    """Tickets of valid orders whose product is not cancelled."""
    return raw.filter(is_sold()).select(*TICKET_COLUMNS)


def kept_share(raw: DataFrame) -> DataFrame:
    """Tickets, sold tickets and their share in percent (0 for an empty table)."""
    return raw.agg(
        F.count("*").alias("n_total"),
        F.count_if(is_sold()).alias("n_valid"),
    ).withColumn("kept_pct", F.coalesce(ratio(F.col("n_valid") * 100.0, F.col("n_total")), F.lit(0.0)))
