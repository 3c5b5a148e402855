"""The three dimensions: dates, routes, customers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from altimart import fixed_values as V
from altimart.functions.clean import flag
from altimart.functions.dates import date_key, date_spine
from altimart.functions.exact import count_if, exact_sum, rounded, rounded_mean
from altimart.functions.tagging import band_from, mapped
from altimart.operators.skew import lookup_join

col = F.col


def _or_zero(name: str, digits: bool = False):
    return F.coalesce(col(name), F.lit(0.0 if digits else 0)).alias(name)


def dim_date(spark: SparkSession, first: str = "2024-01-01", end: str = "2025-12-31") -> DataFrame:
    """One row per day from ``first`` up to, not including, ``end``."""
    return calendar(spark.range(1).select(F.lit(first).alias("first"), F.lit(end).alias("end")))


def dim_date_of(df: DataFrame, day: str) -> DataFrame:
    """The calendar from the earliest to the latest day of a column, both included."""
    return calendar(df.agg(F.min(day).alias("first"), F.date_add(F.max(day), 1).alias("end")))


def calendar(bounds: DataFrame) -> DataFrame:
    day = col("full_date")
    weekday = F.dayofweek(day) - 1  # Sunday 0 .. Saturday 6
    quarter = F.quarter(day).cast("string")
    demand = {m: "peak" for m in (12, 1, 2)} | {m: "high" for m in (6, 7, 8)}
    return date_spine(bounds).select(
        date_key(day).alias("date_id"),
        day,
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.dayofmonth(day).alias("day_of_month"),
        weekday.alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.weekofyear(day).alias("week_of_year"),
        F.concat(F.lit("Q"), quarter, F.lit(" "), F.year(day).cast("string"))
        .alias("quarter_label"),
        F.date_format(day, "yyyy-MM").alias("year_month"),
        weekday.isin(0, 6).alias("is_weekend"),
        mapped(F.month(day), demand, "normal").alias("season_demand"),
        F.concat(F.lit("FY-Q"), quarter).alias("fiscal_quarter"),
    )


def competitor_totals(competitors: DataFrame) -> DataFrame:
    fare, weekly = col("competitor_average_fare_usd"), col("competitor_frequency_weekly")
    return competitors.groupBy("route_id").agg(
        F.count(F.lit(1)).alias("nb_competitors"),
        rounded_mean(fare, 2).alias("avg_competitor_fare_usd"),
        F.min(fare).alias("min_competitor_fare_usd"),
        F.max(fare).alias("max_competitor_fare_usd"),
        F.sum(weekly).alias("total_competitor_frequency"),
        F.max(weekly).alias("max_competitor_strength"),
    )


def dim_routes(routes: DataFrame, airports: DataFrame, competitors: DataFrame) -> DataFrame:
    """One row per route with both of its airports and its competition."""

    def airport_as(role: str) -> DataFrame:
        return airports.select(
            col("airport_code").alias(f"{role}_airport_code"),
            *[
                col(name).alias(f"{role}_{name}")
                for name in ("airport_name", "city", "country", "continent", "is_domestic")
            ],
        )

    df = routes
    for role in ("origin", "destination"):
        df = lookup_join(df, airport_as(role), f"{role}_airport_code")
    df = df.join(competitor_totals(competitors), "route_id", "left")
    rivals = F.coalesce(col("nb_competitors"), F.lit(0))
    return df.select(
        "route_id",
        "route_key",
        "origin_airport_code",
        "destination_airport_code",
        "route_type",
        "distance_km",
        "distance_category",
        "block_time_min",
        "block_time_hours",
        "avg_speed_kmh",
        "is_return_route",
        *[
            f"{role}_{name}"
            for role in ("origin", "destination")
            for name in ("airport_name", "city", "country", "continent", "is_domestic")
        ],
        rivals.alias("nb_competitors"),
        "avg_competitor_fare_usd",
        "min_competitor_fare_usd",
        "max_competitor_fare_usd",
        _or_zero("total_competitor_frequency"),
        F.when(rivals == 0, "monopole")
        .when(rivals == 1, "duopole")
        .when(rivals <= 3, "oligopole")
        .otherwise("haute_concurrence")
        .alias("competitive_intensity"),
        (flag(col("route_type") == "international") | flag(col("distance_category") == "long_haul"))
        .alias("is_strategic_route"),
    )


def loyalty_totals(loyalty: DataFrame) -> DataFrame:
    def miles_of(kind: str):
        return F.sum(F.when(col(kind), col("miles_amount")).otherwise(F.lit(0)))

    return loyalty.groupBy("customer_id").agg(
        F.sum("miles_amount").alias("total_miles"),
        exact_sum(col("estimated_value_usd")).alias("total_loyalty_value_usd"),
        F.count(F.lit(1)).alias("total_loyalty_transactions"),
        miles_of("is_flight_earn").alias("flight_miles_earned"),
        miles_of("is_purchased_miles").alias("purchased_miles"),
        miles_of("is_bonus_miles").alias("bonus_miles"),
    )


def ticket_totals(tickets: DataFrame) -> DataFrame:
    return tickets.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("total_tickets"),
        rounded_mean(col("sentiment_score"), 3).alias("avg_sentiment_score"),
        count_if(col("is_resolved")).alias("resolved_tickets"),
        count_if(col("urgency_level") == "critical").alias("critical_tickets"),
        count_if(col("is_sla_breached")).alias("sla_breached_tickets"),
    )


def dim_customers(customers: DataFrame, loyalty: DataFrame, tickets: DataFrame) -> DataFrame:
    """One row per customer; all three inputs meet partitioned by customer."""
    # Both sides of each join hold one row per customer: there is nothing to skew.
    df = customers.join(loyalty_totals(loyalty), "customer_id", "left").join(
        ticket_totals(tickets), "customer_id", "left"
    )
    df = df.select(
        "customer_id",
        "first_name",
        "last_name",
        "gender",
        "birth_date",
        "age_years",
        "generation",
        "country",
        "city",
        "is_domestic_customer",
        "customer_segment",
        "loyalty_tier",
        "preferred_channel",
        "signup_date",
        "customer_tenure_days",
        "is_loyalty_member",
        _or_zero("total_miles"),
        _or_zero("total_loyalty_value_usd", digits=True),
        _or_zero("total_loyalty_transactions"),
        _or_zero("flight_miles_earned"),
        _or_zero("purchased_miles"),
        _or_zero("bonus_miles"),
        _or_zero("total_tickets"),
        _or_zero("avg_sentiment_score", digits=True),
        _or_zero("resolved_tickets"),
        _or_zero("critical_tickets"),
        _or_zero("sla_breached_tickets"),
    )
    miles, mood = col("total_miles"), col("avg_sentiment_score")
    standard = flag(col("customer_segment") == "standard")
    return df.select(
        "*",
        band_from(miles, ((10000, "high"), (3000, "medium"), (1, "low")), "inactive")
        .alias("loyalty_engagement_level"),
        band_from(mood, V.SENTIMENT_BANDS, V.SENTIMENT_DEFAULT).alias("customer_sentiment_label"),
        rounded(col("total_loyalty_value_usd") + miles * F.lit(0.01), 2)
        .alias("customer_value_score"),
        (
            flag(col("customer_segment").isin("business", "premium"))
            | flag(col("loyalty_tier").isin("Gold", "Platinum"))
            | (miles >= 10000)
        ).alias("is_high_value"),
        ((mood < -0.5) | (col("critical_tickets") >= 2) | (col("sla_breached_tickets") >= 1))
        .alias("is_at_risk"),
        (standard & col("is_loyalty_member") & (miles >= 3000)).alias("is_upsell_candidate"),
    )
