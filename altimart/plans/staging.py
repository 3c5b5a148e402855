"""Twelve staging models: one narrow pass each from a raw sheet to clean rows.

Each function takes the raw DataFrame and returns cleaned inputs, derived
columns and quality flags for the rows whose keys are present.  Helper columns
that are used several times (lower-case texts) live in the first projection
and are gone after the second.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from altimart import fixed_values as V
from altimart.functions.clean import Raw, blank_to_null, flag
from altimart.functions.dates import as_of_date, days_between, minute_boundaries, year_boundaries
from altimart.functions.exact import exact_mean, exact_sum, percent, rounded
from altimart.functions.keywords import Keywords
from altimart.functions.tagging import (
    band_below,
    band_from,
    first_true,
    has_all,
    has_any,
    keyword_category,
    mapped,
)
from altimart.operators.skew import with_group_totals

col = F.col
_CRITICAL = Keywords(V.CRITICAL_KEYWORDS)


def _pass(df: DataFrame, first: dict[str, Column], then: dict[str, Column]) -> DataFrame:
    """Two projections; columns of the first that start with ``_`` are dropped by the second."""
    df = df.select(*[c.alias(name) for name, c in first.items()])
    kept = [name for name in df.columns if not name.startswith("_")]
    return df.select(*kept, *[c.alias(name) for name, c in then.items()])


def _key_part(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def cost_key(flight: Column, route: Column, day: Column) -> Column:
    return F.concat_ws("|", _key_part(flight), _key_part(route), _key_part(day))


def _outside(c: Column, low, high) -> Column:
    return flag(~c.between(low, high))


def flights(raw: DataFrame, as_of=None, strict: bool = False) -> DataFrame:
    r = Raw(raw, strict)
    out = _pass(
        raw.where(~r.missing("flight_id")),
        {
            "flight_id": r.string("flight_id"),  # not trimmed: padded ids stay different
            "flight_number": r.text("flight_number"),
            "route_id": r.text("route_id"),
            "flight_date": r.date("flight_date"),
            "scheduled_departure_at": r.timestamp("scheduled_departure"),
            "actual_departure_at": r.timestamp("actual_departure"),
            "scheduled_arrival_at": r.timestamp("scheduled_arrival"),
            "actual_arrival_at": r.timestamp("actual_arrival"),
            "aircraft_type": r.text("aircraft_type"),
            "seat_capacity": r.integer("seat_capacity"),
            "flight_status": r.lower_text("flight_status"),
            "delay_minutes": r.integer("delay_min"),
            "_status": r.folded("flight_status"),
        },
        {
            "flight_cost_key": cost_key(col("flight_id"), col("route_id"), col("flight_date")),
            "computed_departure_delay_min": minute_boundaries(
                col("scheduled_departure_at"), col("actual_departure_at")
            ),
            "computed_arrival_delay_min": minute_boundaries(
                col("scheduled_arrival_at"), col("actual_arrival_at")
            ),
            "is_id_missing": F.lit(False),
            "is_delayed": flag(col("delay_minutes") >= 15),
            "is_cancelled": flag(col("_status") == "cancelled"),
            "is_timeline_invalid": flag(col("actual_arrival_at") < col("actual_departure_at")),
            "is_delay_suspect": flag(col("delay_minutes") > 1440),
            "is_capacity_invalid": flag(col("seat_capacity") <= 0),
        },
    )
    return out


def airports(raw: DataFrame, as_of=None, strict: bool = False) -> DataFrame:
    r = Raw(raw, strict)
    zone, country = r.string("timezone"), r.string("country")
    at_home = country == V.HOME_COUNTRY
    return _pass(
        raw.where(~r.missing("airport_code")),
        {
            "airport_code": r.text("airport_code"),
            "airport_name": r.text("airport_name"),
            "city": r.text("city"),
            "country": r.text("country"),
            "timezone": r.text("timezone"),
            "latitude": r.double("latitude"),
            "longitude": r.double("longitude"),
            "continent": first_true(
                [(zone.startswith(f"{z}/"), z) for z in V.CONTINENT_ZONES], "Unknown"
            ),
            "is_international": flag(~at_home)
            | flag(F.contains(r.folded("airport_name"), F.lit("international"))),
            "is_domestic": flag(at_home),
        },
        {
            "is_id_missing": F.lit(False),
            "is_latitude_invalid": _outside(col("latitude"), -90, 90),
            "is_longitude_invalid": _outside(col("longitude"), -180, 180),
        },
    )


def routes(raw: DataFrame, as_of=None, strict: bool = False, hub: str = V.HOME_HUB) -> DataFrame:
    r = Raw(raw, strict)
    airport_missing = r.missing("origin_airport_code") | r.missing("destination_airport_code")
    origin, destination = r.string("origin_airport_code"), r.string("destination_airport_code")
    km, minutes = r.double("distance_km"), r.double("block_time_min")
    distance = col("distance_km")
    return _pass(
        raw.where(~r.missing("route_id") & ~airport_missing),
        {
            "route_id": r.text("route_id"),
            "origin_airport_code": blank_to_null(origin),
            "destination_airport_code": blank_to_null(destination),
            "route_type": r.lower_text("route_type"),
            "distance_km": r.integer("distance_km"),
            "block_time_min": r.integer("block_time_min"),
            "avg_speed_kmh": rounded(F.try_divide(km, minutes) * 60, 1),
            "block_time_hours": rounded(minutes / 60, 2),
            "reverse_route_key": F.concat(F.trim(destination), F.lit("-"), F.trim(origin)),
            "route_key": F.concat(F.trim(origin), F.lit("-"), F.trim(destination)),
            "is_return_route": flag(origin != hub),
        },
        {
            "distance_category": F.when(distance < 500, "short_haul")
            .when(distance <= 1500, "medium_haul")
            .when(distance > 1500, "long_haul"),
            "is_id_missing": F.lit(False),
            "is_airport_missing": F.lit(False),
            "is_distance_invalid": flag(distance <= 0),
            "is_blocktime_invalid": flag(col("block_time_min") <= 0),
            "is_speed_suspect": _outside(col("avg_speed_kmh"), 300, 1000),
        },
    )


def customers(raw: DataFrame, as_of=None, strict: bool = False) -> DataFrame:
    r, today = Raw(raw, strict), as_of_date(as_of)
    no_tier = F.trim(r.folded("loyalty_tier")).isin(*V.NO_TIER_WORDS)
    return _pass(
        raw.where(~r.missing("customer_id")),
        {
            "customer_id": r.text("customer_id"),
            "first_name": r.text("first_name"),
            "last_name": r.text("last_name"),
            "gender": r.upper_text("gender"),
            "birth_date": r.date("birth_date"),
            "country": r.text("country"),
            "city": r.text("city"),
            "customer_segment": r.lower_text("customer_segment"),
            "loyalty_tier": F.when(~no_tier, F.trim(r.string("loyalty_tier"))),
            "preferred_channel": r.lower_text("preferred_channel"),
            "signup_date": r.date("signup_date"),
            "is_domestic_customer": flag(r.string("country") == V.HOME_COUNTRY),
            "is_gender_invalid": flag(~F.upper(r.string("gender")).isin("M", "F")),
            "_today": today,
        },
        {
            "age_years": year_boundaries(col("birth_date"), col("_today")),
            "generation": band_below(F.year("birth_date"), V.GENERATIONS, "Unknown"),
            "customer_tenure_days": days_between(col("signup_date"), col("_today")),
            "is_loyalty_member": col("loyalty_tier").isNotNull(),
            "is_id_missing": F.lit(False),
            "is_birthdate_future": flag(col("birth_date") > col("_today")),
            "is_minor": flag(year_boundaries(col("birth_date"), col("_today")) < 18),
            "is_age_suspect": flag(year_boundaries(col("birth_date"), col("_today")) > 100),
            "is_signup_future": flag(col("signup_date") > col("_today")),
            "is_signup_suspect": flag(col("signup_date") < F.lit("2000-01-01").cast("date")),
        },
    )


def bookings(raw: DataFrame, as_of=None, strict: bool = False) -> DataFrame:
    r = Raw(raw, strict)
    price, extras, status = col("ticket_price_usd"), col("ancillary_revenue_usd"), col("_status")
    return _pass(
        raw.where(~r.missing("booking_id") & ~r.missing("customer_id") & ~r.missing("flight_id")),
        {
            "booking_id": r.text("booking_id"),
            "customer_id": r.text("customer_id"),
            "flight_id": r.text("flight_id"),
            "booked_at": r.timestamp("booking_date"),
            "booking_date": r.date("booking_date"),
            "booking_channel": r.lower_text("booking_channel"),
            "fare_class": r.lower_text("fare_class"),
            "fare_family": r.lower_text("fare_family"),
            "ticket_price_usd": r.double("ticket_price_usd"),
            "ancillary_revenue_usd": r.double("ancillary_revenue_usd"),
            "bags_count": r.integer("bags_count"),
            "has_seat_selection": r.integer("seat_selection_flag") == 1,
            "booking_status": r.lower_text("booking_status"),
            "_status": r.folded("booking_status"),
        },
        {
            "total_revenue_usd": rounded(price + extras, 2),
            "ancillary_revenue_pct": F.when(
                price + extras > 0, percent(extras, price + extras)
            ).otherwise(F.lit(0.0)),
            "ticket_price_category": F.when(price == 0, F.lit("free")).otherwise(
                band_below(price, ((100, "low"), (300, "medium"), (600, "high")), "premium")
            ),
            "is_confirmed": flag(status == "confirmed"),
            "is_flown": flag(status == "flown"),
            "is_cancelled": flag(status == "cancelled"),
            "is_id_missing": F.lit(False),
            "is_fk_missing": F.lit(False),
            "is_price_negative": flag(price < 0),
            "is_ancillary_negative": flag(extras < 0),
            "is_bags_invalid": flag(col("bags_count") < 0),
            "is_booking_future": flag(col("booking_date") > as_of_date(as_of)),
            "is_price_suspect": flag(price > 10000),
        },
    )


def flight_costs(raw: DataFrame, as_of=None, strict: bool = False) -> DataFrame:
    r = Raw(raw, strict)
    parts = list(V.COST_LIMITS)
    keys = {
        "flight_id": r.text("flight_id"),
        "route_id": r.text("route_id"),
        "flight_date": r.date("flight_date"),
    }
    present = keys["flight_id"].isNotNull() & keys["route_id"].isNotNull()
    total = sum((col(p) for p in parts[1:]), col(parts[0]))
    suspect = {
        name: flag((col(part) < 0) | (col(part) > limit))
        for part, (name, limit) in V.COST_LIMITS.items()
    }
    shares = {
        part.replace("_usd", "_pct"): percent(col(part), col("_total"))
        for part in parts
        if part != "airport_fees_usd"
    }
    priced = raw.where(present & keys["flight_date"].isNotNull()).select(
        *[c.alias(name) for name, c in keys.items()], *[r.double(p).alias(p) for p in parts]
    )
    return _pass(
        priced,
        {name: col(name) for name in priced.columns} | {"_total": total},
        {
            "flight_cost_key": cost_key(col("flight_id"), col("route_id"), col("flight_date")),
            "total_cost_usd": rounded(col("_total"), 2),
            **shares,
            **suspect,
            "is_any_cost_suspect": F.greatest(*suspect.values()),
            "is_id_missing": F.lit(False),
            "is_route_missing": F.lit(False),
            "is_date_missing": F.lit(False),
            "is_composite_key_incomplete": F.lit(False),
        },
    )


def customer_service_tickets(raw: DataFrame, as_of=None, strict: bool = False) -> DataFrame:
    r = Raw(raw, strict)
    score, status, days = col("sentiment_score"), col("_status"), col("resolution_time_days")
    resolved = flag(status == V.RESOLVED)
    ids = {name: r.text(name) for name in ("ticket_id", "customer_id", "flight_id")}
    return _pass(
        raw.where(
            ids["ticket_id"].isNotNull()
            & ids["customer_id"].isNotNull()
            & ids["flight_id"].isNotNull()
        ),
        {
            **ids,
            "ticket_category": r.text("ticket_category"),
            "customer_comments": r.text("customer_comments"),
            "sentiment_score": r.double("sentiment_score"),
            "resolution_status": r.text("resolution_status"),
            "resolution_time_days": r.integer("resolution_time_days"),
            "_status": r.folded("resolution_status"),
            "_category": r.folded("ticket_category"),
            "_comment": r.folded("customer_comments"),
        },
        {
            "sentiment_label": band_from(score, V.SENTIMENT_BANDS, V.SENTIMENT_DEFAULT),
            # a NULL status is neither resolved nor unresolved: urgency stays low
            "urgency_level": F.when(
                status != V.RESOLVED, band_below(score, V.URGENCY_BANDS, "low")
            ).otherwise(F.lit("low")),
            "is_resolved": resolved,
            "is_open": flag(status == V.OPEN),
            "is_in_progress": flag(status == V.IN_PROGRESS),
            "is_sla_breached": flag(days > 3) & resolved,
            "is_delay_related": flag(F.contains(col("_category"), F.lit("retard"))),
            "is_cancellation_related": flag(F.contains(col("_category"), F.lit("annulation"))),
            "has_critical_keywords": flag(_CRITICAL.any(_CRITICAL.found(col("_comment")), V.CRITICAL_KEYWORDS)),
            "is_id_missing": F.lit(False),
            "is_fk_missing": F.lit(False),
            "is_sentiment_invalid": _outside(score, -1, 1),
            "is_resolution_time_invalid": flag(days < 0),
            "is_comment_empty": col("customer_comments").isNull(),
        },
    )


def ancillary_details(raw: DataFrame, as_of=None, strict: bool = False) -> DataFrame:
    r = Raw(raw, strict)
    channel, item, revenue = col("_channel"), col("_item"), col("item_revenue_usd")
    channels = dict(V.PURCHASE_CHANNELS)
    return _pass(
        raw.where(~r.missing("ancillary_id") & ~r.missing("booking_id")),
        {
            "ancillary_id": r.text("ancillary_id"),
            "booking_id": r.text("booking_id"),
            "item_category": r.text("item_category"),
            "purchase_channel": r.lower_text("purchase_channel"),
            "item_revenue_usd": r.double("item_revenue_usd"),
            "_item": r.folded("item_category"),
            "_channel": r.folded("purchase_channel"),
        },
        {
            "item_category_normalized": keyword_category(item, V.ITEM_CATEGORIES),
            "purchase_channel_normalized": keyword_category(channel, V.PURCHASE_CHANNELS),
            "is_digital_purchase": flag(
                has_any(channel, channels["mobile_app"] + channels["web"])
            ),
            "is_premium_seat": flag(has_any(item, V.PREMIUM_SEAT_WORDS)),
            "is_id_missing": F.lit(False),
            "is_fk_missing": F.lit(False),
            "is_revenue_invalid": flag(revenue <= 0),
            "is_revenue_suspect": flag(revenue > 500),
        },
    )


def competitor_context(
    raw: DataFrame, as_of=None, strict: bool = False, totals: bool = True
) -> DataFrame:
    """Totals per route count every row of the raw route key, kept or dropped later."""
    r = Raw(raw, strict)
    weekly, fare = col("competitor_frequency_weekly"), col("competitor_average_fare_usd")
    rows = raw.where(~r.missing("route_id")).select(
        r.text("market_id").alias("market_id"),
        r.text("route_id").alias("route_id"),
        r.text("competitor_name").alias("competitor_name"),
        r.integer("competitor_frequency_weekly").alias("competitor_frequency_weekly"),
        r.double("competitor_average_fare_usd").alias("competitor_average_fare_usd"),
        r.string("route_id").alias("_raw_route"),
        (~r.missing("market_id") & ~r.missing("competitor_name")).alias("_keep"),
    )
    if totals:
        rows = with_group_totals(
            rows,
            "_raw_route",
            {
                "nb_competitors_on_route": F.count(F.lit(1)),
                "total_competitor_frequency": F.sum(weekly),
                "avg_competitor_fare_on_route": rounded(exact_mean(fare), 2),
                "min_competitor_fare_on_route": F.min(fare),
                "max_competitor_fare_on_route": F.max(fare),
            },
        )
    rows = rows.where("_keep")
    return _pass(
        rows,
        {name: col(name) for name in rows.columns if not name.startswith("_")},
        {
            "competitor_strength": band_from(
                weekly, ((7, "very_strong"), (5, "strong"), (3, "moderate")), "weak"
            ),
            "competitor_fare_segment": band_below(
                fare, ((150, "low_cost"), (250, "mid_range"), (350, "premium")), "ultra_premium"
            ),
            "is_id_missing": F.lit(False),
            "is_route_missing": F.lit(False),
            "is_competitor_missing": F.lit(False),
            "is_frequency_invalid": flag(weekly <= 0),
            "is_fare_invalid": flag(fare <= 0),
        },
    )


def weather_impact(raw: DataFrame, as_of=None, strict: bool = False) -> DataFrame:
    r = Raw(raw, strict)
    risk, delay, day = col("_risk"), col("average_delay_caused_min"), col("weather_date")
    return _pass(
        raw.where(~r.missing("weather_id") & ~r.missing("airport_code") & ~r.missing("date")),
        {
            "weather_id": r.text("weather_id"),
            "airport_code": r.text("airport_code"),
            "weather_date": r.date("date"),
            "season_type": r.text("season_type"),
            "disruption_risk_level": r.text("disruption_risk_level"),
            "average_delay_caused_min": r.integer("average_delay_caused_min"),
            "_risk": r.folded("disruption_risk_level"),
            "_season": r.folded("season_type"),
        },
        {
            "disruption_risk_score": mapped(risk, V.RISK_SCORES, 0),
            "season_type_normalized": keyword_category(col("_season"), V.SEASONS, "unknown"),
            "is_disruptive_weather": flag(risk.isin("élevé", "moyen")),
            "is_high_risk": flag(risk == "élevé"),
            "is_significant_delay": flag(delay >= 15),
            "delay_category": F.when(delay == 0, F.lit("no_delay")).otherwise(
                band_below(delay, ((15, "minor"), (45, "moderate")), "severe")
            ),
            "weather_month": F.month(day),
            "weather_quarter": F.quarter(day),
            "is_id_missing": F.lit(False),
            "is_airport_missing": F.lit(False),
            "is_date_missing": F.lit(False),
            "is_composite_key_incomplete": F.lit(False),
            "is_delay_invalid": flag(delay < 0),
            "is_delay_suspect": flag(delay > 240),
        },
    )


def cargo_operations(raw: DataFrame, as_of=None, strict: bool = False) -> DataFrame:
    r = Raw(raw, strict)
    kg, revenue, used = col("weight_kg"), col("cargo_revenue_usd"), col("space_utilization_pct")
    return _pass(
        raw.where(~r.missing("cargo_shipment_id") & ~r.missing("flight_id")),
        {
            "cargo_shipment_id": r.text("cargo_shipment_id"),
            "flight_id": r.text("flight_id"),
            "cargo_type": r.text("cargo_type"),
            "weight_kg": r.double("weight_kg"),
            "cargo_revenue_usd": r.double("cargo_revenue_usd"),
            "space_utilization_pct": r.double("space_utilization_pct"),
            "_kind": r.folded("cargo_type"),
        },
        {
            "revenue_per_kg_usd": F.when(kg > 0, rounded(F.try_divide(revenue, kg), 2)),
            "cargo_type_normalized": keyword_category(col("_kind"), V.CARGO_TYPES),
            "is_high_value_cargo": flag(F.try_divide(revenue, kg) > 10),
            "is_sensitive_cargo": flag(has_any(col("_kind"), V.SENSITIVE_CARGO_WORDS)),
            "space_utilization_level": band_from(
                used, ((80, "high"), (50, "medium"), (20, "low")), "very_low"
            ),
            "is_underutilized": flag(used < 20),
            "is_overutilized": flag(used > 95),
            "weight_category": band_below(
                kg, ((100, "light"), (500, "medium"), (1000, "heavy")), "very_heavy"
            ),
            "is_id_missing": F.lit(False),
            "is_fk_missing": F.lit(False),
            "is_weight_invalid": flag(kg <= 0),
            "is_revenue_invalid": flag(revenue <= 0),
            "is_utilization_invalid": _outside(used, 0, 100),
            "is_weight_suspect": flag(kg > 10000),
            "is_revenue_suspect": flag(revenue > 50000),
        },
    )


def loyalty_activity(
    raw: DataFrame, as_of=None, strict: bool = False, totals: bool = True
) -> DataFrame:
    """Totals per customer count every row of the raw customer key, kept or dropped later."""
    r = Raw(raw, strict)
    miles, value, kind = col("miles_amount"), col("estimated_value_usd"), col("_kind")
    flown = flag(has_all(kind, V.FLIGHT_EARN_WORDS))
    rows = raw.where(~r.missing("customer_id")).select(
        r.text("activity_id").alias("activity_id"),
        r.text("customer_id").alias("customer_id"),
        r.text("activity_type").alias("activity_type"),
        r.integer("miles_amount").alias("miles_amount"),
        r.double("estimated_value_usd").alias("estimated_value_usd"),
        r.folded("activity_type").alias("_kind"),
        r.string("customer_id").alias("_raw_customer"),
        (~r.missing("activity_id")).alias("_keep"),
    )
    if totals:
        rows = with_group_totals(
            rows,
            "_raw_customer",
            {
                "customer_total_miles": F.sum(miles),
                "customer_total_value_usd": rounded(exact_sum(value), 2),
                "customer_activity_count": F.count(F.lit(1)),
                "customer_flight_miles_total": F.sum(F.when(flown, miles).otherwise(F.lit(0))),
            },
        )
    rows = rows.where("_keep")
    return _pass(
        rows,
        {name: col(name) for name in rows.columns if name not in ("_raw_customer", "_keep")},
        {
            "value_per_mile_usd": F.when(miles > 0, rounded(F.try_divide(value, miles), 4)),
            "activity_category": F.when(flown, F.lit("earn_flight")).otherwise(
                keyword_category(kind, V.EARN_CATEGORIES)
            ),
            "is_earn": ~flag(has_any(kind, V.SPENDING_WORDS)),
            "is_flight_earn": flown,
            "is_purchased_miles": flag(has_any(kind, V.PURCHASED_MILES_WORDS)),
            "is_partner_earn": flag(has_any(kind, V.PARTNER_MILES_WORDS)),
            "is_bonus_miles": flag(has_any(kind, V.BONUS_MILES_WORDS)),
            "miles_volume_category": band_from(miles, ((3000, "high"), (1000, "medium")), "low"),
            "is_id_missing": F.lit(False),
            "is_fk_missing": F.lit(False),
            "is_miles_invalid": flag(miles <= 0),
            "is_value_invalid": flag(value < 0),
            "is_miles_suspect": flag(miles > 100000),
            "is_value_per_mile_suspect": _outside(F.try_divide(value, miles), 0.001, 0.10),
        },
    )


MODELS = {
    "flights": flights,
    "airports": airports,
    "routes": routes,
    "customers": customers,
    "bookings": bookings,
    "flight_costs": flight_costs,
    "customer_service_tickets": customer_service_tickets,
    "ancillary_details": ancillary_details,
    "competitor_context": competitor_context,
    "weather_impact": weather_impact,
    "cargo_operations": cargo_operations,
    "loyalty_activity": loyalty_activity,
}
