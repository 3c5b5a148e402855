"""Column types of the twelve raw sheets."""

from __future__ import annotations

from pyspark.sql import types as T

# FIXED VALUES: sheet -> columns
SHEETS = {
    "flights": "flight_id string, flight_number string, route_id string, flight_date date, "
    "scheduled_departure timestamp_ntz, actual_departure timestamp_ntz, scheduled_arrival "
    "timestamp_ntz, actual_arrival timestamp_ntz, aircraft_type string, seat_capacity "
    "int, flight_status string, delay_min int",
    "airports": "airport_code string, airport_name string, city string, country string, timezone "
    "string, latitude double, longitude double",
    "routes": "route_id string, origin_airport_code string, destination_airport_code string, "
    "route_type string, distance_km int, block_time_min int",
    "customers": "customer_id string, first_name string, last_name string, gender string, birth_date "
    "date, country string, city string, customer_segment string, loyalty_tier string, "
    "preferred_channel string, signup_date date",
    "bookings": "booking_id string, customer_id string, flight_id string, booking_date timestamp_ntz, "
    "booking_channel string, fare_class string, fare_family string, ticket_price_usd "
    "double, ancillary_revenue_usd double, bags_count int, seat_selection_flag int, "
    "booking_status string",
    "flight_costs": "flight_id string, route_id string, flight_date date, fuel_cost_usd double, "
    "airport_fees_usd double, crew_cost_usd double, maintenance_cost_usd double, "
    "catering_cost_usd double",
    "customer_service_tickets": "ticket_id string, customer_id string, flight_id string, ticket_category string, "
    "customer_comments string, sentiment_score double, resolution_status string, "
    "resolution_time_days int",
    "ancillary_details": "ancillary_id string, booking_id string, item_category string, purchase_channel "
    "string, item_revenue_usd double",
    "competitor_context": "market_id string, route_id string, competitor_name string, "
    "competitor_frequency_weekly int, competitor_average_fare_usd double",
    "weather_impact": "weather_id string, airport_code string, date date, season_type string, "
    "disruption_risk_level string, average_delay_caused_min int",
    "cargo_operations": "cargo_shipment_id string, flight_id string, cargo_type string, weight_kg double, "
    "cargo_revenue_usd double, space_utilization_pct double",
    "loyalty_activity": "activity_id string, customer_id string, activity_type string, miles_amount int, "
    "estimated_value_usd double",
}


def schema(sheet: str, as_text: bool = False) -> T.StructType:
    """Schema of a sheet; ``as_text`` reads every cell as a string for staging to cast."""
    declared = T.StructType.fromDDL(SHEETS[sheet])
    if not as_text:
        return declared
    return T.StructType([T.StructField(name, T.StringType()) for name in declared.names])
