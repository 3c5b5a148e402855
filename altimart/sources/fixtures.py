"""The twelve raw sheets derived from the driver's tables.

A deterministic mapping, so that the airline models run on tables that exist
at every scale.  Blank, padded and mixed-case cells are put in on purpose.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from altimart.functions.exact import rounded
from altimart.functions.tagging import first_true, mapped
from altimart.sources.sinks import remove, scratch, write_model

col, lit = F.col, F.lit


def _text(c: Column) -> Column:
    return c.cast("string")


def _pad(c: Column, width: int) -> Column:
    return F.lpad(_text(c), width, "0")


def _cents(c: Column) -> Column:
    return rounded(c, 2)


def _pick(index: Column, values: list[str], default: str) -> Column:
    return mapped(index, dict(enumerate(values)), default)


_TABLES = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "supplier": "s_suppkey bigint, s_nationkey int",
    "part": "p_partkey bigint, p_brand string, p_size int",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "events": "event_id bigint, user_id bigint, event_type string, value double",
}


class RawSheets(Mapping[str, DataFrame]):
    """Sheets by name, each built when it is first asked for.

    With ``stored`` the items sold, which bookings and their extras are made of, are joined with their
    orders once and written.
    """

    def __init__(self, spark: SparkSession, folder: str, stored: bool = False):
        self._spark, self._folder, self._stored = spark, folder, stored
        self._built: dict[str, DataFrame] = {}
        self._sold: DataFrame | None = None
        self._at: str | None = None

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = _SHEETS[name](self)
        return self._built[name]

    def __iter__(self):
        return iter(_SHEETS)

    def __len__(self) -> int:
        return len(_SHEETS)

    def table(self, name: str) -> DataFrame:
        return self._spark.read.schema(_TABLES[name]).parquet(f"{self._folder}/{name}.parquet")

    def size(self, name: str) -> Column:
        return self.table(name).agg(F.count(lit(1))).scalar()

    def sold(self) -> DataFrame:
        if self._sold is None:
            orders = self.table("orders").withColumnRenamed("o_orderkey", "l_orderkey")
            joined = self.table("lineitem").drop("l_quantity").join(orders, "l_orderkey")
            self._sold = joined
            if self._stored:
                self._at = scratch(self._spark, "sold")
                self._sold = write_model(joined, self._at)
        return self._sold

    def let_go(self) -> None:
        """The written table goes.  Frames that read it are lost; sheets asked for later are built anew."""
        if self._at is not None:
            remove(self._spark, self._at)
            self._at, self._sold = None, None
            self._built.clear()


def _booking_id() -> Column:
    parts = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return F.concat(lit("B"), F.concat_ws("-", *[_text(col(p)) for p in parts]))


def _part_day() -> Column:
    days = (col("p_partkey") * 7) % 1200
    return F.date_add(lit("1998-01-01").cast("date"), days.cast("int"))


def _part_route(sheets: RawSheets) -> Column:
    return F.concat(lit("R"), _pad(col("p_partkey") % sheets.size("supplier"), 5))


def _part_at(clock: Column) -> Column:
    return F.concat(_text(_part_day()), lit(" "), clock).cast("timestamp_ntz")


def _airports(sheets: RawSheets) -> DataFrame:
    nat = col("n_nationkey")
    return sheets.table("nation").select(
        F.concat(lit("N"), _pad(nat, 2)).alias("airport_code"),
        F.when(nat % 2 == 0, F.concat("n_name", lit(" International")))
        .otherwise(col("n_name")).alias("airport_name"),
        F.when(nat % 9 == 4, "  ").otherwise(col("n_name")).alias("city"),
        F.when(nat % 5 == 0, "Côte d'Ivoire").otherwise(col("n_name")).alias("country"),
        _pick(
            col("n_regionkey"),
            ["Africa/Abidjan", "America/New_York", "Asia/Tokyo", "Europe/Paris"],
            "Pacific/Fiji",
        ).alias("timezone"),
        (nat * 8 - 90).cast("double").alias("latitude"),
        (nat * 16 - 180).cast("double").alias("longitude"),
    )


def _routes(sheets: RawSheets) -> DataFrame:
    supp, last = col("s_suppkey"), _last_nation(sheets)
    return sheets.table("supplier").select(
        F.concat(lit("R"), _pad(supp, 5)).alias("route_id"),
        F.concat(lit("N"), _pad(col("s_nationkey"), 2)).alias("origin_airport_code"),
        F.concat(lit(" N"), _pad((col("s_nationkey") + 1 + supp % last) % (last + 1), 2))
        .alias("destination_airport_code"),
        mapped(supp % 4, {0: "Domestic", 3: " INTERNATIONAL"}, "Regional").alias("route_type"),
        (200 + (supp * 37) % 1800).cast("int").alias("distance_km"),
        (40 + (supp * 53) % 120).cast("int").alias("block_time_min"),
    )


def _flights(sheets: RawSheets) -> DataFrame:
    key, minute = col("p_partkey"), _pad(col("p_size"), 2)
    late = (key % 20 == 6) | (key % (3 + key % 4) == 0)
    return sheets.table("part").select(
        F.concat(lit("F"), _text(key)).alias("flight_id"),
        F.concat(lit("HF"), _text(key)).alias("flight_number"),
        _part_route(sheets).alias("route_id"),
        _part_day().alias("flight_date"),
        _part_at(lit("08:00:30")).alias("scheduled_departure"),
        _part_at(F.concat(lit("08:"), minute, lit(":10"))).alias("actual_departure"),
        _part_at(lit("11:00:00")).alias("scheduled_arrival"),
        _part_at(F.concat(lit("11:"), minute, lit(":00"))).alias("actual_arrival"),
        col("p_brand").alias("aircraft_type"),
        (20 + (key % 5) * 15).cast("int").alias("seat_capacity"),
        F.when(key % 40 == 0, "Cancelled").otherwise(" Landed ").alias("flight_status"),
        F.when(late, col("p_size") * 2).otherwise(col("p_size") % 12).cast("int").alias("delay_min"),
    )


def _flight_costs(sheets: RawSheets) -> DataFrame:
    key = col("p_partkey")
    return sheets.table("part").select(
        F.concat(lit("F"), _text(key)).alias("flight_id"),
        _part_route(sheets).alias("route_id"),
        _part_day().alias("flight_date"),
        (2000 + (key % 10) * 1900 + F.when(key % 20 == 6, 20000).otherwise(0))
        .cast("double").alias("fuel_cost_usd"),
        (900 + col("p_size") * 10).cast("double").alias("airport_fees_usd"),
        (1500 + key % 7 * 100).cast("double").alias("crew_cost_usd"),
        (700 + col("p_size")).cast("double").alias("maintenance_cost_usd"),
        (col("p_size") * 12).cast("double").alias("catering_cost_usd"),
    )


def _bookings(sheets: RawSheets) -> DataFrame:
    return sheets.sold().select(
        _booking_id().alias("booking_id"),
        F.concat(lit("C"), _text(col("o_custkey"))).alias("customer_id"),
        F.concat(lit(" F"), _text(col("l_partkey"))).alias("flight_id"),
        col("o_orderdate").alias("booking_date"),
        col("o_orderpriority").alias("booking_channel"),
        F.concat("l_returnflag", "l_linestatus").alias("fare_class"),
        F.when(col("l_linenumber") == 7, "").otherwise("Flex").alias("fare_family"),
        _cents(col("l_extendedprice") / 100).alias("ticket_price_usd"),
        _cents(col("l_tax") * 500).alias("ancillary_revenue_usd"),
        (col("l_linenumber") % 3).cast("int").alias("bags_count"),
        (col("l_linenumber") % 2).cast("int").alias("seat_selection_flag"),
        mapped(col("l_returnflag"), {"R": "Cancelled", "A": "Flown"}, "Confirmed")
        .alias("booking_status"),
    )


def _customers(sheets: RawSheets) -> DataFrame:
    cust = col("c_custkey")
    return sheets.table("customer").select(
        F.concat(lit("C"), _text(cust)).alias("customer_id"),
        col("c_name").alias("first_name"),
        F.concat(lit("N"), _text(col("c_nationkey"))).alias("last_name"),
        _pick(cust % 3, ["m", "F"], "X").alias("gender"),
        F.date_add(lit("1945-01-01").cast("date"), ((cust * 13) % 25000).cast("int"))
        .alias("birth_date"),
        F.when(col("c_nationkey") % 5 == 0, "Côte d'Ivoire").otherwise("Other").alias("country"),
        lit(None).cast("string").alias("city"),
        mapped(
            col("c_mktsegment"),
            {"BUILDING": "Business", "MACHINERY": "Premium", "HOUSEHOLD": "Budget"},
            "Standard",
        ).alias("customer_segment"),
        first_true(
            [
                (col("c_acctbal") > bound, tier)
                for bound, tier in (
                    (9000, "Platinum"), (8000, "Gold"), (5000, "Silver"), (2000, "None"), (0, ""),
                )
            ],
            lit(None).cast("string"),
        ).alias("loyalty_tier"),
        F.when(cust % 2 == 0, "Web").otherwise("MOBILE").alias("preferred_channel"),
        F.date_add(lit("1999-01-01").cast("date"), (cust % 1200).cast("int")).alias("signup_date"),
    )


def _tickets(sheets: RawSheets) -> DataFrame:
    event, value = col("event_id"), col("value")
    return sheets.table("events").where(col("event_type") == "error").select(
        F.concat(lit("T"), _text(event)).alias("ticket_id"),
        F.concat(lit("C"), _text(col("user_id") * 3)).alias("customer_id"),
        F.concat(lit("F"), _text(event % sheets.size("part"))).alias("flight_id"),
        _pick(event % 3, ["Retard de vol", "Annulation"], "Autre").alias("ticket_category"),
        _pick(
            event % 13,
            [
                "Demande de remboursement, débité deux fois",
                "Bagage perdu",
                "Ma valise est abîmée",
                "RETARD et correspondance manquée",
                "Vol annulé sans préavis",
                "Surréservation: refusé l'embarquement",
                "Repas immangeable",
                "Siège cassé, hublot sale",
                "Climatisation en panne",
                "Le site web ne marche pas",
                "Personnel désagréable",
                "Très bon accueil, équipe attentionnée",
            ],
            "  ",
        ).alias("customer_comments"),
        _cents(F.when(value > 150, -1.0).otherwise(1.0 - value / 75)).alias("sentiment_score"),
        _pick(event % 4, ["Ouvert", "En cours"], "Résolu").alias("resolution_status"),
        (event % 10).cast("int").alias("resolution_time_days"),
    )


def _ancillary(sheets: RawSheets) -> DataFrame:
    k, line = col("k"), col("l_linenumber")
    return (
        sheets.sold().withColumn("k", F.explode(F.array(lit(0), lit(1))))
        # an item was bought where the row's discount reaches a bound of the customer; else there is none
        .where(col("l_discount") >= (2 + 6 * k + col("o_custkey") % 8) / 100)
        .select(
            F.concat(lit("A"), F.substring(_booking_id(), 2, 100), lit("-"), _text(k))
            .alias("ancillary_id"),
            _booking_id().alias("booking_id"),
            _pick(
                (line + k) % 7,
                [
                    "Bagage supplémentaire", "Siège premium", "Repas spécial", "Lounge",
                    "Assurance voyage", "Priorité",
                ],
                "Wifi",
            ).alias("item_category"),
            _pick(
                (line + k) % 5,
                ["Application mobile", "Site web", "Comptoir aéroport", "Agence"],
                "Autre",
            ).alias("purchase_channel"),
            _cents(col("l_tax") * 300 + k).alias("item_revenue_usd"),
        )
    )


def _competitors(sheets: RawSheets) -> DataFrame:
    supp, nat = col("s_suppkey"), col("n_nationkey")
    rivals = ((supp * 7) % 5).cast("int")  # nations 0 .. rivals-1 compete on the route
    return (
        sheets.table("supplier").where(rivals > 0)
        .withColumn("n_nationkey", F.explode(F.sequence(lit(0), rivals - 1)))
        .join(sheets.table("nation").select("n_nationkey", "n_name"), "n_nationkey")
        .select(
            F.concat(lit("M"), _text(supp), lit("-"), _text(nat)).alias("market_id"),
            F.concat(lit("R"), _pad(supp, 5)).alias("route_id"),
            col("n_name").alias("competitor_name"),
            (1 + (supp + nat) % 9).cast("int").alias("competitor_frequency_weekly"),
            (100 + (supp * 17 + nat * 31) % 300).cast("double")
            .alias("competitor_average_fare_usd"),
        )
    )


def _last_nation(sheets: RawSheets):
    return sheets.table("nation").agg(F.max("n_nationkey")).scalar()


def _weather(sheets: RawSheets) -> DataFrame:
    nat = col("n_nationkey")
    day, dom = col("date"), F.dayofmonth("date")
    return (
        sheets.table("part").select(_part_day().alias("date")).distinct()  # at most 1200 days
        .withColumn("n_nationkey", F.explode(F.sequence(lit(0), _last_nation(sheets))))
        .join(sheets.table("nation").select("n_nationkey"), "n_nationkey")
        .select(
            F.concat(lit("W"), _text(nat), lit("-"), _text(day)).alias("weather_id"),
            F.concat(lit("N"), _pad(nat, 2)).alias("airport_code"),
            "date",
            _pick(
                (nat + F.month(day)) % 6,
                [
                    "Harmattan", "Petite saison sèche", "Grande saison sèche",
                    "Petite saison des pluies", "Grande saison des pluies",
                ],
                "Saison sèche",
            ).alias("season_type"),
            _pick((nat + dom) % 4, ["Élevé", "Moyen", "Faible"], "").alias("disruption_risk_level"),
            ((nat * 5 + dom * 3) % 60).cast("int").alias("average_delay_caused_min"),
        )
    )


def _cargo(sheets: RawSheets) -> DataFrame:
    line = col("l_linenumber")
    return sheets.table("lineitem").select(
        F.concat(lit("G"), F.substring(_booking_id(), 2, 100)).alias("cargo_shipment_id"),
        F.concat(lit("F"), _text(col("l_partkey"))).alias("flight_id"),
        mapped(
            line,
            {
                1: "Documents urgents", 2: "Pharma", 3: "Périssable", 4: "Textile",
                5: "Électronique",
            },
            "Divers",
        ).alias("cargo_type"),
        (col("l_quantity") * 22.5).alias("weight_kg"),
        _cents(col("l_extendedprice") / 40).alias("cargo_revenue_usd"),
        (col("l_discount") * 1000).alias("space_utilization_pct"),
    )


def _loyalty(sheets: RawSheets) -> DataFrame:
    event, value = col("event_id"), col("value")
    return sheets.table("events").where(col("event_type") != "error").select(
        F.concat(lit("L"), _text(event)).alias("activity_id"),
        F.concat(lit("C"), _text(col("user_id") * 3 + event % 2)).alias("customer_id"),
        _pick(
            event % 7,
            [
                "Miles gagnés sur vol", "Partenaire hôtel", "Bonus promotion", "Miles achetés",
                "Miles utilisés", "Miles expirés",
            ],
            "Divers",
        ).alias("activity_type"),
        F.floor(value * 10).cast("int").alias("miles_amount"),
        _cents(value / 8).alias("estimated_value_usd"),
    )


_SHEETS = {
    "flights": _flights,
    "airports": _airports,
    "routes": _routes,
    "customers": _customers,
    "bookings": _bookings,
    "flight_costs": _flight_costs,
    "customer_service_tickets": _tickets,
    "ancillary_details": _ancillary,
    "competitor_context": _competitors,
    "weather_impact": _weather,
    "cargo_operations": _cargo,
    "loyalty_activity": _loyalty,
}
