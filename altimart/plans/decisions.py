"""Route and customer performance, decision flags, labels and recommendations.

Flags, labels and recommendations follow three separate rule lists on purpose:
flags may overlap, labels leave out some tests, and a recommendation follows
the flags, so it can differ from the label.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from altimart import fixed_values as V
from altimart.functions.dates import as_of_date, days_between
from altimart.functions.exact import count_if, exact_sum, percent, rounded, rounded_mean
from altimart.operators.rules import Rule, advice, first_label, flags, rule
from altimart.plans.facts import bookings_per_customer

col = F.col
FLAG_COLUMNS = ("flag_1", "flag_2", "flag_3", "flag_4", "flag_5")

# FIXED VALUES: rules in order of priority
ROUTE_FLAG_RULES = (
    rule("GrowthOpportunity", "avg_load_factor_pct >= 80", "avg_margin_pct >= 15",
         "nb_competitors <= 1"),
    rule("StrategicUnderperformer", "is_strategic_route = true",
         "avg_margin_pct < 10 | delay_rate_pct > 30 | profitable_flight_pct < 60"),
    rule("OperationallyUnprofitable", "avg_margin_pct < 0", "avg_load_factor_pct >= 65",
         "nb_operational_delays > nb_weather_delays"),
    rule("DemandUnprofitable", "avg_margin_pct < 0", "avg_load_factor_pct < 65"),
    rule("RouteToDefend", "avg_margin_pct >= 10", "nb_competitors >= 3",
         "route_sentiment < -0.3"),
)
ROUTE_LABEL_RULES = (
    ROUTE_FLAG_RULES[0],
    rule("StrategicUnderperformer", "is_strategic_route = true",
         "avg_margin_pct < 10 | delay_rate_pct > 30"),
    ROUTE_FLAG_RULES[2],
    ROUTE_FLAG_RULES[3],
    rule("RouteToDefend", "avg_margin_pct >= 10", "nb_competitors >= 3"),
)
CUSTOMER_FLAG_RULES = (
    rule("HighValueAtRisk", "is_high_value = true",
         "avg_sentiment_score < -0.3 | critical_tickets >= 1 | days_since_last_flight > 90"),
    rule("LoyaltyConversionTarget", "is_loyalty_member = false", "total_bookings >= 2",
         "total_revenue_usd >= 300"),
    rule("PremiumUpgradeCandidate", "customer_segment = 'standard'", "total_miles >= 5000",
         "ancillary_attach_rate_pct >= 50"),
    rule("AncillaryOfferTarget", "total_bookings >= 2", "ancillary_attach_rate_pct < 30",
         "avg_sentiment_score >= -0.2"),
    rule("ReactivationTarget", "days_since_last_flight > 180", "total_bookings >= 1"),
)
CUSTOMER_LABEL_RULES = (
    *CUSTOMER_FLAG_RULES[:4],
    rule("ReactivationTarget", "days_since_last_flight > 180"),
)


def route_performance(flights: DataFrame) -> DataFrame:
    def mean(name: str, digits: int) -> Column:
        return rounded_mean(col(name), digits)

    n = F.count(F.lit(1))
    delayed, cancelled = count_if(col("is_delayed")), count_if(col("is_cancelled"))
    profitable = count_if(col("is_profitable"))
    return flights.groupBy("route_id").agg(
        n.alias("nb_flights"),
        F.sum("nb_passengers").alias("total_passengers"),
        mean("load_factor_pct", 2).alias("avg_load_factor_pct"),
        exact_sum(col("total_revenue_usd")).alias("total_revenue_usd"),
        exact_sum(col("total_cost_usd")).alias("total_cost_usd"),
        exact_sum(col("flight_margin_usd")).alias("total_margin_usd"),
        mean("flight_margin_pct", 2).alias("avg_margin_pct"),
        mean("yield_usd_per_km", 4).alias("avg_yield"),
        mean("rask", 6).alias("avg_rask"),
        mean("cask", 6).alias("avg_cask"),
        mean("delay_minutes", 1).alias("avg_delay_minutes"),
        delayed.alias("nb_delayed_flights"),
        cancelled.alias("nb_cancelled_flights"),
        percent(delayed, n).alias("delay_rate_pct"),
        percent(cancelled, n).alias("cancellation_rate_pct"),
        count_if(col("is_operational_delay")).alias("nb_operational_delays"),
        count_if(col("is_weather_driven_delay")).alias("nb_weather_delays"),
        profitable.alias("nb_profitable_flights"),
        percent(profitable, n).alias("profitable_flight_pct"),
    )


def route_sentiment(tickets: DataFrame) -> DataFrame:
    return (
        tickets.where(col("route_id").isNotNull())
        .groupBy("route_id")
        .agg(
            F.count(F.lit(1)).alias("nb_tickets"),
            rounded_mean(col("sentiment_score"), 3).alias("avg_sentiment_score"),
            count_if(col("urgency_level") == "critical").alias("nb_critical_tickets"),
            count_if(col("has_delay_keyword")).alias("nb_delay_complaints"),
            count_if(col("has_baggage_keyword")).alias("nb_baggage_complaints"),
            count_if(col("has_refund_keyword")).alias("nb_refund_complaints"),
            count_if(col("is_operational_delay") & col("has_delay_keyword"))
            .alias("nb_operational_delay_complaints"),
        )
    )


def customer_performance(bookings: DataFrame, as_of=None) -> DataFrame:
    """Distinct bookings are counted by (customer, booking) first, so a hot customer is spread."""
    names = ("nb_rows", "nb_distinct_bookings", "revenue", "nb_revenues", "ancillary_revenue",
             "nb_with_ancillary", "last_flight_date")
    return performance_of(bookings_per_customer(bookings, names), as_of)


def performance_of(bought: DataFrame, as_of=None) -> DataFrame:
    """Performance from the figures of ``bookings_per_customer``."""
    revenue, extras = col("revenue").cast("double"), col("nb_with_ancillary")
    return bought.select(
        "customer_id",
        col("nb_distinct_bookings").alias("total_bookings"),
        revenue.alias("total_revenue_usd"),
        rounded(F.try_divide(revenue, col("nb_revenues")), 2).alias("avg_revenue_per_booking"),
        col("ancillary_revenue").cast("double").alias("total_ancillary_usd"),
        "last_flight_date",
        days_between(col("last_flight_date"), as_of_date(as_of)).alias("days_since_last_flight"),
        extras.alias("nb_bookings_with_ancillary"),
        percent(extras, col("nb_rows")).alias("ancillary_attach_rate_pct"),
    )


def _decided(
    df: DataFrame, flag_rules: tuple[Rule, ...], label_rules: tuple[Rule, ...], labels, texts
) -> DataFrame:
    default = list(labels)[-1]
    flagged = df.select("*", *flags(flag_rules, FLAG_COLUMNS))
    by_rule = {r.name: name for r, name in zip(flag_rules, FLAG_COLUMNS, strict=True)}
    return flagged.select(
        "*",
        first_label(label_rules, labels, default).alias("ontology_label"),
        advice(by_rule, texts, default).alias("recommendation"),
    )


def route_decisions(routes: DataFrame, flights: DataFrame, tickets: DataFrame) -> DataFrame:
    """Every route with its performance, flags, label and recommendation."""
    df = (
        routes.join(route_performance(flights), "route_id", "left")
        .join(route_sentiment(tickets), "route_id", "left")
        .withColumn("route_sentiment", F.coalesce(col("avg_sentiment_score"), F.lit(0.0)))
    )
    return _decided(df, ROUTE_FLAG_RULES, ROUTE_LABEL_RULES, V.ROUTE_LABELS, V.ROUTE_ADVICE).drop(
        "route_sentiment"
    )


def customer_decisions(customers: DataFrame, bookings: DataFrame, as_of=None) -> DataFrame:
    """Every customer with behaviour, flags, label and recommendation."""
    return decided_customers(customers, customer_performance(bookings, as_of))


def decided_customers(customers: DataFrame, performance: DataFrame) -> DataFrame:
    df = customers.join(performance, "customer_id", "left")
    return _decided(
        df, CUSTOMER_FLAG_RULES, CUSTOMER_LABEL_RULES, V.CUSTOMER_LABELS, V.CUSTOMER_ADVICE
    )


def _aligned(df: DataFrame, kind: str, key: str, title: Column, metrics: list[str]) -> DataFrame:
    return df.select(
        F.lit(kind).alias("decision_entity_type"),
        col(key).alias("entity_id"),
        title.alias("entity_label"),
        "ontology_label",
        *FLAG_COLUMNS,
        *[col(m).cast("double").alias(f"metric_{i}") for i, m in enumerate(metrics, 1)],
        "recommendation",
    )


def route_layer(route_rows: DataFrame) -> DataFrame:
    return _aligned(
        route_rows, "route", "route_id", col("route_key"),
        ["avg_load_factor_pct", "avg_margin_pct", "delay_rate_pct", "avg_sentiment_score",
         "total_revenue_usd"],
    )


def customer_layer(customer_rows: DataFrame) -> DataFrame:
    return _aligned(
        customer_rows, "customer", "customer_id",
        F.concat("first_name", F.lit(" "), "last_name"),
        ["total_revenue_usd", "ancillary_attach_rate_pct", "days_since_last_flight",
         "avg_sentiment_score", "total_miles"],
    )


def decision_layer(route_rows: DataFrame, customer_rows: DataFrame) -> DataFrame:
    """Routes and customers in one shape: entity, label, five flags, five metrics, advice."""
    return route_layer(route_rows).unionByName(customer_layer(customer_rows))
