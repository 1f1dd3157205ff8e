"""Source-shaped tables derived by Spark from the given Parquet tables.

Each function has a SQL counterpart of the same name in ``sql.py``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from turnstile.functions.calendar import day_token, weekday_name
from turnstile.plans import gold

# Tickets in one order drop at most.
DROP_SIZE = 500

# Tickets that one task groups to drops, so few that it sorts them in memory.
TASK_TICKETS = 250_000


class Inputs:
    """The given tables of one folder, and tables derived from them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        """A given table; its schema is looked up once."""
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._tables[name]

    # --- ticketing -------------------------------------------------------

    def tickets(self) -> DataFrame:
        """One ticket per order line; order state, product flag and type from the line's codes."""
        flag, line = F.col("l_returnflag"), F.col("l_linestatus")
        return self.table("lineitem").select(
            F.col("l_orderkey").alias("session_id"),
            F.col("l_orderkey").alias("order_id"),
            F.col("l_partkey").alias("ticket_id"),
            F.concat_ws("-", "l_orderkey", "l_linenumber").alias("bar_code"),
            F.col("l_linenumber").alias("product_type_id"),
            F.col("l_extendedprice").alias("amount"),
            F.when(flag == "N", 1).when(flag == "A", 8).when(line == "F", 9).otherwise(4).alias("order_status_id"),
            F.when(F.col("l_discount") > 0, F.col("l_discount") > 0.08).alias("product_is_cancelled"),
            F.col("l_suppkey").cast("string").alias("ext_id"),
            (F.col("l_linenumber") % 3).cast("int").alias("category_id"),
            (F.col("l_linenumber") % 2).cast("int").alias("ticket_status_id"),
            F.date_format("l_shipdate", "yyyy-MM-dd").alias("order_creation_date"),
            F.when(flag == "N", F.date_format("l_shipdate", "yyyy-MM-dd")).alias("order_validation_date"),
            F.concat(F.lit("G"), "l_linenumber").alias("seat_gate"),
            flag.alias("seat_stand"),
            line.alias("seat_row"),
            F.col("l_partkey").cast("string").alias("seat_number"),
        )

    def sessions(self) -> DataFrame:
        return self.table("orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderdate").alias("start_at"))

    def product_types(self) -> DataFrame:
        """Five types; lines numbered above five have none."""
        name = F.col("r_name")
        code = F.when(name == "AFRICA", "ABONNEMENT").when(name == "AMERICA", "BILLET_UNITE").otherwise(name)
        return self.table("region").select((F.col("r_regionkey") + 1).alias("id"), code.alias("code"))

    def scans(self) -> DataFrame:
        line = F.col("l_linestatus")
        return self.table("lineitem").select(
            F.concat_ws("-", "l_orderkey", "l_linenumber").alias("barcode"),
            F.when(line == "F", "OK").when(F.col("l_tax") > 0, "KO").alias("resultat"),
            day_token(F.col("l_shipdate")).alias("date_fichier"),
        )

    # --- matches ---------------------------------------------------------

    def calendar(self) -> DataFrame:
        """One match per order date; capacity is twice the number of orders."""
        days = (
            self.table("orders")
            .groupBy(F.col("o_orderdate").cast("date").alias("date"))
            .agg((F.count("*") * 2).cast("int").alias("capacite_salle"))
        )
        weekday, month = weekday_name(F.col("date")), F.month("date")
        return days.select(
            F.concat(F.lit("M"), day_token(F.col("date"))).alias("match_id"),
            "date",
            F.when(weekday == "Sunday", "16:30")
            .when(weekday == "Saturday", "18:00")
            .when(weekday == "Monday", "13:30:00")
            .when(weekday == "Friday", "20:45")
            .otherwise("19:15")
            .alias("heure"),
            F.when(month.isin(5, 6), "Betclic ÉLITE Playoffs")
            .when(weekday.isin("Tuesday", "Wednesday", "Thursday"), "EuroLeague")
            .otherwise("Betclic ÉLITE")
            .alias("competition"),
            F.concat(F.lit("J"), F.dayofmonth("date")).alias("journee"),
            F.concat(F.lit("Club "), month).alias("adversaire"),
            F.lit("Arena").alias("salle"),
            "capacite_salle",
        )

    def results(self) -> DataFrame:
        """One result per order date and state; scores are unknown on Wednesdays."""
        day = F.col("date")
        known = weekday_name(day) != "Wednesday"
        return (
            self.table("orders")
            .groupBy(F.col("o_orderdate").cast("date").alias("date"), "o_orderstatus")
            .agg(
                (F.sum("o_custkey") % 18 + 1).cast("int").alias("rang_pbb_avant"),
                (F.max("o_custkey") % 18 + 1).cast("int").alias("rang_adversaire_avant"),
                (F.min("o_custkey") % 40 + 60).cast("int").alias("home"),
                (F.max("o_orderkey") % 40 + 60).cast("int").alias("away"),
            )
            .select(
                "date",
                F.when(F.col("o_orderstatus") == "F", "DOMICILE").otherwise("EXTERIEUR").alias("lieu"),
                "rang_pbb_avant",
                "rang_adversaire_avant",
                F.when(known, F.col("home")).alias("score_domicile"),
                F.when(known, F.col("away")).alias("score_exterieur"),
            )
        )

    def holidays(self) -> DataFrame:
        """Four days from the first order of each month and priority; periods overlap."""
        day = F.col("o_orderdate").cast("date")
        midnight = F.lit("T00:00:00+00:00")
        first = F.min(day)
        return (
            self.table("orders")
            .groupBy(F.date_trunc("month", "o_orderdate").alias("month"), "o_orderpriority")
            .agg(first.alias("first"))
            .select(
                F.concat(F.date_format("first", "yyyy-MM-dd"), midnight).alias("start_date"),
                F.concat(F.date_format(F.date_add("first", 3), "yyyy-MM-dd"), midnight).alias("end_date"),
                F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), "Paris").otherwise("Lyon").alias("location"),
            )
        )

    def weather(self) -> DataFrame:
        """One reading per order line, from 13:00 to 19:00 of the shipping day; hours repeat."""
        hour = (F.col("l_linenumber") + 12).cast("string")
        return self.table("lineitem").select(
            F.concat(F.date_format("l_shipdate", "yyyy-MM-dd"), F.lit("T"), hour, F.lit(":00")).alias("heure"),
            F.col("l_quantity").alias("temperature"),
            (F.col("l_tax") * 10.0).alias("precipitation"),
        )

    def fact(self) -> DataFrame:
        return gold.fact_match(
            calendar=self.calendar(),
            tickets=self.tickets(),
            sessions=self.sessions(),
            product_types=self.product_types(),
            scans=self.scans(),
            results=self.results(),
            holidays=self.holidays(),
            weather=self.weather(),
        )

    def survey(self) -> DataFrame:
        return self.table("lineitem").select(
            F.concat(F.lit("M"), day_token(F.col("l_shipdate"))).alias("match_id"),
            F.when(F.col("l_linestatus") == "F", "POST_MATCH").otherwise("SAISON").alias("type_enquete"),
            (F.col("l_quantity") / 5.0).alias("note_globale"),
        )

    # --- web and campaigns ------------------------------------------------

    def web_events(self) -> DataFrame:
        """A session is one user on one day."""
        kind = F.col("event_type")
        return self.table("events").select(
            F.concat_ws("-", "user_id", F.date_format("ts", "yyyyMMdd")).alias("session_id"),
            F.when(kind == "view", "view_item_list")
            .when(kind == "click", "add_to_cart")
            .when(kind == "signup", "begin_checkout")
            .otherwise(kind)
            .alias("event_name"),
        )

    def web_sessions(self) -> DataFrame:
        kind, value = F.col("event_type"), F.col("value")
        return self.table("events").select(
            kind.alias("source"),
            F.when(F.hour("ts") < 12, "matin").otherwise("soir").alias("medium"),
            F.when(kind == "purchase", value).when(kind != "view", value - 50.0).alias("revenue"),
        )

    def campaign_events(self) -> DataFrame:
        """Errors form a channel without deliveries."""
        kind, value = F.col("event_type"), F.col("value")
        return self.table("events").select(
            F.when(kind == "error", "WEB").when(value > 20, "SMS").otherwise("EMAIL").alias("canal"),
            F.when(kind == "view", "DELIVRE")
            .when(kind == "click", "OUVERTURE")
            .when(kind == "purchase", "CLIC")
            .otherwise("AUTRE")
            .alias("evenement"),
        )

    # --- people and places -------------------------------------------------

    def raw_contacts(self) -> DataFrame:
        """Contacts as text; the layout of the birth date depends on the segment."""
        born = F.date_add(F.lit("1950-01-01").cast("date"), (F.col("c_custkey") % 18000).cast("int"))
        segment = F.col("c_mktsegment")
        known = F.col("c_acctbal") >= 0
        return self.table("customer").select(
            F.col("c_custkey").cast("string").alias("ext_id"),
            F.col("c_name").alias("nom"),
            F.when(segment == "BUILDING", F.date_format(born, "yyyy-MM-dd"))
            .when(segment == "MACHINERY", F.date_format(born, "dd/MM/yyyy"))
            .when(segment == "HOUSEHOLD", F.concat(F.date_format(born, "d/M/yyyy"), F.lit(" ")))
            .when(segment == "FURNITURE", F.lit("inconnue"))
            .when(known, F.lit(""))
            .alias("date_naissance"),
            F.when(known, (F.col("c_nationkey") + 75000).cast("string"))
            .when(segment != "BUILDING", (F.col("c_nationkey") + 99000).cast("string"))
            .alias("code_postal"),
            segment.alias("segment"),
            F.date_format(born, "yyyy/M/d").alias("date_creation"),
            F.when(segment == "BUILDING", "true")
            .when(segment == "MACHINERY", "No")
            .when(segment == "HOUSEHOLD", "1")
            .when(segment == "FURNITURE", "oui")
            .otherwise("F")
            .alias("optin_email"),
            F.concat(F.lit("N° "), F.col("c_custkey") % 100).alias("prenom"),
            F.when(F.col("c_custkey") % 2 == 0, "F").when(F.col("c_custkey") % 3 == 0, "M").alias("genre"),
            F.concat(F.lit("+33 "), "c_custkey").alias("telephone"),
            F.when(known, "France").otherwise("Belgique, BE").alias("pays"),
            F.lower("c_mktsegment").alias("canal_acquisition"),
            F.when(F.col("c_nationkey") > 12, F.concat(F.lit('Joueur "'), "c_nationkey", F.lit('"'))).alias("joueur_prefere"),
        )

    def _suppliers_by_nation(self) -> DataFrame:
        counted = self.table("supplier").groupBy(F.col("s_nationkey").alias("n_nationkey")).agg(F.count("*").alias("n"))
        return self.table("nation").join(counted, "n_nationkey", "left").withColumn("n", F.coalesce("n", F.lit(0)))

    def towns(self) -> DataFrame:
        """One town per nation with two postcodes; neighbours share one."""
        code = F.col("n_nationkey") + 75000
        return self._suppliers_by_nation().select(
            F.when(F.col("n_name") == "NATION_0", "Paris").otherwise(F.col("n_name")).alias("nom"),
            F.array(code.cast("string"), (code + 1).cast("string")).alias("codesPostaux"),
            (F.col("n") * 1000 + 500).alias("population"),
        )

    def districts(self) -> DataFrame:
        """One district per region with one postcode."""
        by_region = self._suppliers_by_nation().groupBy(F.col("n_regionkey").alias("r_regionkey")).agg(F.sum("n").alias("n"))
        return self.table("region").join(by_region, "r_regionkey").select(
            F.col("r_name").alias("nom"),
            F.array((F.col("r_regionkey") + 75000).cast("string")).alias("codesPostaux"),
            (F.col("n") * 2000).alias("population"),
        )

    # --- till ----------------------------------------------------------------

    def raw_till(self) -> DataFrame:
        """Till lines as text: several line numbers repeat, dates come in four layouts."""
        day = F.date_add(F.lit("2020-01-01").cast("date"), (F.col("l_orderkey") % 1500).cast("int"))
        number, line, flag = F.col("l_linenumber"), F.col("l_linestatus"), F.col("l_returnflag")

        def with_digits(value, digits):
            return value.cast(f"decimal(18,{digits})").cast("string")

        def comma(value):
            return F.replace(with_digits(value, 2), F.lit("."), F.lit(","))

        return self.table("lineitem").select(
            F.col("l_orderkey").cast("string").alias("LIGNE_ligne"),
            number.cast("string").alias("LIGNE_vente"),
            F.col("l_suppkey").cast("string").alias("LIGNE_CodeMag"),
            F.lit("Textile").alias("LIGNE_Famille"),
            F.lit(None).cast("string").alias("LIGNE_Rayon"),
            F.lit(None).cast("string").alias("PRODUIT_ssfamille"),
            F.when(line == "F", "Maillot").otherwise("Écharpe").alias("LIGNE_Designation"),
            F.lit(None).cast("string").alias("LIGNE_Couleur"),
            F.lit(None).cast("string").alias("LIGNE_Taille"),
            comma(F.col("l_extendedprice")).alias("LIGNE_PrixVente"),
            F.when(flag == "A", with_digits(F.col("l_quantity") + 0.5, 1))
            .when(flag == "N", with_digits(F.col("l_quantity"), 0))
            .otherwise("")
            .alias("LIGNE_Quantite"),
            comma(F.col("l_extendedprice") * F.col("l_quantity")).alias("LIGNE_Total"),
            F.lit(None).cast("string").alias("LIGNE_Motif"),
            F.col("l_partkey").cast("string").alias("VENTE_vente"),
            F.when(number <= 2, F.date_format(day, "yyyy-MM-dd"))
            .when(number <= 4, F.date_format(day, "dd/MM/yyyy"))
            .when(number <= 6, F.date_format(day, "dd-MM-yyyy"))
            .otherwise("")
            .alias("VENTE_date"),
            F.lit(None).cast("string").alias("VENTE_codemag"),
            with_digits(F.col("l_tax") * 100, 2).alias("VENTE_total"),
            flag.alias("VENTE_nature"),
            F.col("l_suppkey").cast("string").alias("VENTe_client"),
            F.lit(None).cast("string").alias("CLIENT_Regroupement"),
            F.when(flag == "R", "ANNULEE").otherwise("VALIDEE").alias("VENTE_Etat"),
        )

    # --- drops ------------------------------------------------------------------

    def order_drops(self, layout: str = "yyyy", period: str = "year") -> DataFrame:
        """Order drops of at most ``DROP_SIZE`` tickets of one shipping period: ``drop``, the period's number, ``orders``.

        The lists hold the given columns only; ``order_documents`` derives the other
        fields from them, which are most of a document's bytes, after the last shuffle.
        The drop number is given in the scan stage, whose row order is the order
        of the file, so a repeated task gives the same numbers. No list is longer
        than a drop, however many tickets an order has: a large order is spread
        over several drops. One shuffle on the drop serves all three levels, to as many
        tasks as the counted tickets need.
        """
        flag, line = F.col("l_returnflag"), F.col("l_linestatus")
        given = self.table("lineitem")
        tasks = max(self.spark.sparkContext.defaultParallelism, -(-given.count() // TASK_TICKETS))
        lines = (
            given
            .withColumn("drop", F.expr(f"monotonically_increasing_id() div {DROP_SIZE}"))
            .withColumn(period, F.date_format("l_shipdate", layout).cast("int"))
        )
        tickets = lines.select(
            "drop",
            period,
            F.col("l_orderkey").alias("order_id"),
            F.when(flag == "N", 1).when(flag == "A", 8).when(line == "F", 9).otherwise(4).alias("order_status_id"),
            F.col("l_linenumber").alias("product_type_id"),
            F.when(F.col("l_discount") > 0, F.col("l_discount") > 0.08).alias("is_cancelled"),
            "l_partkey",
            "l_suppkey",
            "l_extendedprice",
            "l_returnflag",
            "l_linestatus",
        ).repartition(tasks, "drop", period)
        products = tickets.groupBy("drop", period, "order_id", "order_status_id", "product_type_id", "is_cancelled").agg(
            F.collect_list(F.struct("l_partkey", "l_suppkey", "l_extendedprice", "l_returnflag", "l_linestatus")).alias("tickets")
        )
        orders = products.groupBy("drop", period, "order_id", "order_status_id").agg(
            F.collect_list(F.struct("product_type_id", "is_cancelled", "tickets")).alias("products")
        )
        return orders.groupBy("drop", period).agg(
            F.collect_list(F.struct("order_id", "order_status_id", "products")).alias("orders")
        )

    def order_documents(self, layout: str = "yyyy", period: str = "year", arranged=lambda drops: drops) -> DataFrame:
        """Order drops with all fields of a document; ``arranged`` deals the short drops to tasks before that."""
        drops = arranged(self.order_drops(layout, period))
        return drops.withColumn("orders", F.transform("orders", _whole_order))

    def monthly_teams(self) -> DataFrame:
        """Orders of each nation's customers per calendar month.

        Orders are folded per customer before the join, so a busy customer is one row a month.
        """
        per_customer = (
            self.table("orders")
            .groupBy(F.col("o_custkey").alias("c_custkey"), F.month("o_orderdate").alias("round"))
            .agg(F.count("*").alias("wins"), F.count_if(F.col("o_orderstatus") == "F").alias("losses"))
        )
        return (
            per_customer.join(self.table("customer").select("c_custkey", "c_nationkey"), "c_custkey")
            .groupBy("round", F.col("c_nationkey").alias("team"))
            .agg(F.sum("wins").alias("wins"), F.sum("losses").alias("losses"))
        )


def _whole_order(order: Column) -> Column:
    """An order of a drop with its derived fields."""
    number = order["order_id"]
    created = F.date_add(F.lit("2020-01-01").cast("date"), (number % 1000).cast("int")).cast("string")
    return F.struct(
        number.alias("order_id"),
        (number % 97).alias("event_id"),
        order["order_status_id"].alias("order_status_id"),
        (number % 5).cast("int").alias("channel_id"),
        F.struct(F.concat(F.lit("C"), number).alias("external_id")).alias("customer"),
        created.alias("creation_date"),
        F.when(number % 3 > 0, F.concat(created, F.lit("T10:00:00"))).alias("validation_date"),
        F.when(number % 7 > 0, number % 2 == 0).alias("is_secondary_market"),
        F.transform(order["products"], lambda product: _whole_product(number, product)).alias("products"),
    )


def _whole_product(order_id: Column, product: Column) -> Column:
    kind = product["product_type_id"]
    return F.struct(
        (order_id * 10 + kind).alias("order_product_id"),
        kind.alias("product_type_id"),
        product["is_cancelled"].alias("is_cancelled"),
        (kind * 1.5).alias("amount_inc_tax"),
        F.transform(product["tickets"], lambda ticket: _whole_ticket(order_id, kind, ticket)).alias("tickets"),
    )


def _whole_ticket(order_id: Column, kind: Column, ticket: Column) -> Column:
    line = ticket["l_linestatus"]
    return F.struct(
        ticket["l_partkey"].alias("ticket_id"),
        F.concat_ws("-", order_id, kind).alias("bar_code"),
        order_id.alias("session_id"),
        ticket["l_extendedprice"].alias("amount"),
        (kind % 3).cast("int").alias("category_id"),
        (kind % 2).cast("int").alias("ticket_status_id"),
        F.struct(
            F.concat(F.lit("G"), kind).alias("gate"),
            ticket["l_returnflag"].alias("stand"),
            F.when(line == "F", line).alias("row"),
            ticket["l_suppkey"].cast("string").alias("number"),
        ).alias("seats"),
    )
