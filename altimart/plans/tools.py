"""Business questions over the marts and the classified graph.

Every tool takes the models by name and returns a DataFrame.  Optional
parameters become Column conditions, never text in a query.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from altimart import fixed_values as V
from altimart.functions.exact import count_if, exact_sum, rounded, rounded_mean
from altimart.plans import decisions, graph
from altimart.plans.graph import NAMESPACE

col, lit = F.col, F.lit
Models = Mapping[str, DataFrame]


def _is(name: str, wanted: str | None) -> Column:
    return lit(True) if wanted is None else col(name) == wanted


def get_global_kpis(m: Models) -> DataFrame:
    return m["fct_flights"].agg(
        rounded(exact_sum(col("total_revenue_usd")), 2).alias("total_revenue"),
        rounded_mean(col("load_factor_pct"), 2).alias("avg_load_factor"),
        rounded_mean(col("flight_margin_pct"), 2).alias("avg_margin"),
        F.count("flight_id").alias("nb_flights"),
    )


def get_route_performance(m: Models, route_id: str | None = None) -> DataFrame:
    return decisions.route_performance(m["fct_flights"].where(_is("route_id", route_id)))


def get_routes_budget_recommendation(m: Models, limit: int | None = None) -> DataFrame:
    """Routes by mean margin, best first; all of them unless a limit is asked for."""
    df = (
        m["decision_layer"].where(col("decision_entity_type") == "route")
        .select("entity_id", "entity_label", "ontology_label", "recommendation",
                col("metric_2").alias("avg_margin_pct"))
    )
    if limit is None:
        return df
    return df.orderBy(col("avg_margin_pct").desc_nulls_last(), "entity_id").limit(limit)


def get_complaints_by_route(m: Models, route_id: str | None = None) -> DataFrame:
    return (
        m["fct_tickets"].where(_is("route_id", route_id))
        .groupBy("route_id", "primary_complaint_category")
        .agg(
            F.count(lit(1)).alias("nb_tickets"),
            rounded_mean(col("sentiment_score"), 3).alias("avg_sentiment"),
        )
    )


def top_complaints(m: Models, limit: int = 5) -> DataFrame:
    return (
        m["fct_tickets"].groupBy("primary_complaint_category")
        .agg(
            F.count(lit(1)).alias("nb"),
            rounded_mean(col("sentiment_score"), 3).alias("sentiment"),
        )
        .orderBy(col("nb").desc(), "primary_complaint_category")
        .limit(limit)
    )


def route_comparison(m: Models, routes: list[str] | None = None) -> DataFrame:
    """Financial and satisfaction figures side by side, one row per route."""
    wanted = lit(True) if routes is None else col("route_id").isin(*routes)
    money = (
        m["fct_flights"].where(wanted).groupBy("route_id").agg(
            rounded_mean(col("load_factor_pct"), 2).alias("load_factor"),
            rounded_mean(col("flight_margin_pct"), 2).alias("margin_pct"),
            rounded_mean(col("delay_minutes"), 1).alias("avg_delay"),
        )
    )
    mood = decisions.route_sentiment(m["fct_tickets"].where(wanted)).select(
        "route_id", "nb_tickets", "avg_sentiment_score", "nb_critical_tickets"
    )
    # flights grouped first: one row per route meets the dimension, not one per flight
    keys = m["dim_routes"].where(wanted).select("route_id", "route_key").distinct()
    return money.join(keys, "route_id", "left").join(mood, "route_id", "left").select(
        "route_id", "route_key", "load_factor", "margin_pct", "avg_delay",
        F.coalesce("nb_tickets", lit(0)).alias("nb_tickets"),
        "avg_sentiment_score",
        F.coalesce("nb_critical_tickets", lit(0)).alias("nb_critical_tickets"),
    )


def compare_routes(m: Models, route_id_1: str, route_id_2: str) -> DataFrame:
    return route_comparison(m, [route_id_1, route_id_2])


def get_high_value_at_risk_customers(m: Models, limit: int | None = None) -> DataFrame:
    """Unhappiest first when limited."""
    label = V.CUSTOMER_LABELS["HighValueAtRisk"]
    df = decisions.customer_layer(m["customer_decisions"]).where(col("ontology_label") == label).select(
        "entity_id", "entity_label", "ontology_label", col("metric_4").alias("sentiment"), "recommendation"
    )
    if limit is None:
        return df
    return df.orderBy(col("sentiment").asc_nulls_last(), "entity_id").limit(limit)


def get_upsell_segments(m: Models) -> DataFrame:
    """Customers worth an upgrade or an extras offer, by segment."""
    labels = [V.CUSTOMER_LABELS[n] for n in ("PremiumUpgradeCandidate", "AncillaryOfferTarget")]
    return (
        m["customer_decisions"].where(col("ontology_label").isin(*labels))
        .groupBy("ontology_label", "customer_segment")
        .agg(
            F.count(lit(1)).alias("nb_customers"),
            rounded_mean(col("total_revenue_usd"), 2).alias("avg_revenue_usd"),
            rounded_mean(col("ancillary_attach_rate_pct"), 2).alias("avg_attach_rate_pct"),
            rounded_mean(col("total_miles"), 2).alias("avg_miles"),
        )
    )


def get_unstructured_insights(m: Models, category: str | None = None) -> DataFrame:
    levels = ("critical", "high", "medium", "low")
    return (
        m["fct_tickets"].where(_is("primary_complaint_category", category))
        .groupBy("primary_complaint_category")
        .agg(
            F.count(lit(1)).alias("nb_tickets"),
            rounded_mean(col("sentiment_score"), 3).alias("avg_sentiment"),
            *[count_if(col("urgency_level") == u).alias(f"nb_{u}") for u in levels],
            count_if(col("is_high_value_critical_ticket")).alias("nb_high_value_critical"),
        )
    )


def get_owl_route_classification(g: DataFrame, ns: str = NAMESPACE, infer: bool = False) -> DataFrame:
    """``infer`` here and below: the graph is not classified yet, labels are inferred on the way."""
    return (
        graph.classified(g, "route", ns=ns, infer=infer)
        .where(col("hasRouteKey").isNotNull() & col("hasLoadFactorPct").isNotNull()
               & col("hasMarginPct").isNotNull())
        .select(
            col("entity_id").alias("route_id"),
            col("hasRouteKey").alias("route_key"),
            "owl_label",
            col("hasLoadFactorPct").alias("load_factor_pct"),
            col("hasMarginPct").alias("margin_pct"),
            lit(V.INFERENCE_SOURCE).alias("source"),
        )
        .orderBy("route_id", "owl_label")
    )


def get_owl_customer_classification(
    g: DataFrame, label: str | None = None, limit: int | None = None, ns: str = NAMESPACE, infer: bool = False
) -> DataFrame:
    df = (
        graph.classified(g, "customer", label, ns, infer)
        .where(col("hasCustomerKey").isNotNull() & col("hasSentimentScore").isNotNull()
               & col("hasTotalMiles").isNotNull() & col("hasDaysSinceLastFlight").isNotNull())
        .select(
            col("entity_id").alias("customer_id"),
            "owl_label",
            col("hasSentimentScore").alias("sentiment_score"),
            col("hasTotalMiles").alias("total_miles"),
            col("hasDaysSinceLastFlight").alias("days_since_last_flight"),
            lit(V.INFERENCE_SOURCE).alias("source"),
        )
    )
    df = df.orderBy("customer_id", "owl_label")
    return df if limit is None else df.limit(limit)


def explain_why_classified(
    g: DataFrame, entity_id: str, entity_type: str = "route", ns: str = NAMESPACE, infer: bool = False
) -> DataFrame:
    return graph.explanations(g, entity_type, entity_id, ns, infer)


def _routes_vs_customers(routes_of: DataFrame, customers_of: DataFrame, ns: str, worst: int, infer: bool) -> DataFrame:
    """Strategic underperformers beside the unhappiest high-value customers at risk."""
    routes = graph.classified(routes_of, "route", "StrategicUnderperformer", ns, infer).where(
        col("hasRouteKey").isNotNull()
    )
    customers = (
        graph.classified(customers_of, "customer", "HighValueAtRisk", ns, infer)
        .where(col("hasSentimentScore").isNotNull() & col("hasDaysSinceLastFlight").isNotNull())
        .orderBy("hasSentimentScore", "entity_id")
        .limit(worst)
    )
    both = routes.select(
        lit("underperforming_routes").alias("section"),
        "entity_id",
        col("hasRouteKey").alias("route_key"),
        lit(None).cast("double").alias("sentiment"),
        lit(None).cast("long").alias("days_inactive"),
    ).unionByName(
        customers.select(
            lit("high_value_at_risk_customers").alias("section"),
            "entity_id",
            lit(None).cast("string").alias("route_key"),
            col("hasSentimentScore").alias("sentiment"),
            col("hasDaysSinceLastFlight").alias("days_inactive"),
        )
    )
    return both.select("*", lit(V.CROSS_INSIGHT).alias("insight"), lit(V.CROSS_SOURCE).alias("source"))


def owl_cross_query(
    g: DataFrame,
    question_type: str = "routes_vs_customers",
    ns: str = NAMESPACE,
    worst: int = 10,
    customers: DataFrame | None = None,
    infer: bool = False,
) -> DataFrame:
    """``customers`` is a graph of the customers, where ``g`` has only the routes; ``infer``: not classified yet."""
    if question_type != "routes_vs_customers":
        raise ValueError(f"unknown question type {question_type!r}")
    return _routes_vs_customers(g, g if customers is None else customers, ns, worst, infer)
