"""Staging models, marts, decisions and graph metrics as SQL views over the raw sheets."""

from __future__ import annotations

from altimart import fixed_values as V
from oracle.sql import (
    any_word,
    cases,
    category,
    clean,
    columns,
    low,
    mean,
    n_if,
    quoted,
    rnd,
    share,
    total,
    yes,
)

AS_OF = "date '2001-06-30'"
NS = "urn:altimart:ontology#"
_HOME = quoted(V.HOME_COUNTRY)


def _never(names: str) -> str:
    """Key flags of rows that survived the key filter."""
    return ", ".join(f"false as {n}" for n in names.split())


def _texts(names: str) -> str:
    return ", ".join(f"{clean(n)} as {n}" for n in names.split())


def _flags(pairs: dict[str, str]) -> str:
    return ", ".join(f"{yes(condition)} as {name}" for name, condition in pairs.items())


_costs = list(V.COST_LIMITS)
_cost_sum = "(" + " + ".join(_costs) + ")"
_cost_suspect = {n: f"{c} < 0 or {c} > {limit}" for c, (n, limit) in V.COST_LIMITS.items()}
_ch = dict(V.PURCHASE_CHANNELS)
_earn = [(any_word("kind", words), name) for name, words in V.EARN_CATEGORIES]
_flown_miles = yes("contains(kind, 'vol') and contains(kind, 'gagn')")
_minutes = "date_diff('minute', {}, {})"


STAGING = {
    "stg_flights": f"""
select cast(flight_id as varchar) as flight_id, {_texts("flight_number route_id aircraft_type")},
  concat(coalesce(flight_id, ''), '|', coalesce({clean("route_id")}, ''), '|',
    coalesce(cast(flight_date as varchar), '')) as flight_cost_key,
  flight_date, scheduled_departure as scheduled_departure_at,
  actual_departure as actual_departure_at, scheduled_arrival as scheduled_arrival_at,
  actual_arrival as actual_arrival_at, seat_capacity,
  nullif(trim({low("flight_status")}), '') as flight_status, delay_min as delay_minutes,
  {_minutes.format("scheduled_departure", "actual_departure")} as computed_departure_delay_min,
  {_minutes.format("scheduled_arrival", "actual_arrival")} as computed_arrival_delay_min,
  {_never("is_id_missing")},
  {_flags({"is_delayed": "delay_min >= 15", "is_cancelled": "lower(flight_status) = 'cancelled'",
           "is_timeline_invalid": "actual_arrival < actual_departure",
           "is_delay_suspect": "delay_min > 1440", "is_capacity_invalid": "seat_capacity <= 0"})}
from raw_flights where flight_id is not null""",
    "stg_airports": f"""
select {_texts("airport_code airport_name city country timezone")}, latitude, longitude,
  {cases([(f"timezone like '{z}/%'", z) for z in V.CONTINENT_ZONES], "Unknown")} as continent,
  {_flags({"is_international": f"coalesce(country <> {_HOME}, false) "
                               "or contains(lower(airport_name), 'international')",
           "is_domestic": f"country = {_HOME}"})},
  {_never("is_id_missing")},
  {_flags({"is_latitude_invalid": "abs(latitude) > 90", "is_longitude_invalid": "abs(longitude) > 180"})}
from raw_airports where airport_code is not null""",
    "stg_routes": f"""
select {_texts("route_id origin_airport_code destination_airport_code")},
  nullif(trim({low("route_type")}), '') as route_type, distance_km, block_time_min, speed as avg_speed_kmh,
  {rnd("block_time_min / 60.0", 2)} as block_time_hours,
  concat(trim(destination_airport_code), '-', trim(origin_airport_code)) as reverse_route_key,
  concat(trim(origin_airport_code), '-', trim(destination_airport_code)) as route_key,
  origin_airport_code <> 'ABJ' as is_return_route,
  case when distance_km < 500 then 'short_haul' when distance_km > 1500 then 'long_haul'
    when distance_km is not null then 'medium_haul' end as distance_category,
  {_never("is_id_missing is_airport_missing")},
  {_flags({"is_distance_invalid": "distance_km <= 0", "is_blocktime_invalid": "block_time_min <= 0",
           "is_speed_suspect": "speed < 300 or speed > 1000"})}
from (select *, {rnd("cast(distance_km as double) / nullif(cast(block_time_min as double), 0) * 60", 1)}
  as speed from raw_routes)
where route_id is not null and origin_airport_code is not null and destination_airport_code is not null""",
    "stg_customers": f"""
select {_texts("customer_id first_name last_name country city")},
  nullif(trim(upper(gender)), '') as gender, birth_date,
  nullif(trim({low("customer_segment")}), '') as customer_segment, tier as loyalty_tier,
  nullif(trim({low("preferred_channel")}), '') as preferred_channel, signup_date,
  cast(age as int) as age_years,
  {cases([(f"year(birth_date) < {y}", g) for y, g in V.GENERATIONS], "Unknown")} as generation,
  cast({AS_OF} - signup_date as int) as customer_tenure_days, tier is not null as is_loyalty_member,
  {_never("is_id_missing")},
  {_flags({"is_domestic_customer": f"country = {_HOME}", "is_birthdate_future": f"birth_date > {AS_OF}",
           "is_minor": "age < 18", "is_age_suspect": "age > 100",
           "is_signup_future": f"signup_date > {AS_OF}",
           "is_signup_suspect": "signup_date < date '2000-01-01'",
           "is_gender_invalid": "upper(gender) not in ('M', 'F')"})}
from (select *, year({AS_OF}) - year(birth_date) as age,
  case when lower(trim(loyalty_tier)) not in ('none', 'null', '') then trim(loyalty_tier) end as tier
  from raw_customers) where customer_id is not null""",
    "stg_bookings": f"""
select {_texts("booking_id customer_id flight_id")},
  cast(booking_date as timestamp) as booked_at, cast(booking_date as date) as booking_date,
  nullif(trim({low("booking_channel")}), '') as booking_channel,
  nullif(trim({low("fare_class")}), '') as fare_class,
  nullif(trim({low("fare_family")}), '') as fare_family,
  ticket_price_usd, ancillary_revenue_usd, {rnd("paid", 2)} as total_revenue_usd, bags_count,
  seat_selection_flag = 1 as has_seat_selection,
  nullif(trim({low("booking_status")}), '') as booking_status,
  case when paid > 0 then {share("ancillary_revenue_usd", "paid")} else 0.0::double end
    as ancillary_revenue_pct,
  {cases([("ticket_price_usd = 0", "free"), ("ticket_price_usd < 100", "low"),
          ("ticket_price_usd < 300", "medium"), ("ticket_price_usd < 600", "high")], "premium")}
    as ticket_price_category,
  {_never("is_id_missing is_fk_missing")},
  {_flags({f"is_{s}": f"lower(booking_status) = '{s}'" for s in ("confirmed", "flown", "cancelled")})},
  {_flags({"is_price_negative": "ticket_price_usd < 0", "is_ancillary_negative": "ancillary_revenue_usd < 0",
           "is_bags_invalid": "bags_count < 0", "is_booking_future": f"cast(booking_date as date) > {AS_OF}",
           "is_price_suspect": "ticket_price_usd > 10000"})}
from (select *, ticket_price_usd + ancillary_revenue_usd as paid from raw_bookings)
where booking_id is not null and customer_id is not null and flight_id is not null""",
    "stg_flight_costs": f"""
select {_texts("flight_id route_id")}, flight_date,
  concat_ws('|', {clean("flight_id")}, {clean("route_id")}, cast(flight_date as varchar))
    as flight_cost_key, {", ".join(_costs)}, {rnd(_cost_sum, 2)} as total_cost_usd,
  {", ".join(f"{share(c, _cost_sum)} as {c[:-4]}_pct" for c in _costs if "fees" not in c)},
  {_flags(_cost_suspect)}, {yes("(" + ") or (".join(_cost_suspect.values()) + ")")} as is_any_cost_suspect,
  {_never("is_id_missing is_route_missing is_date_missing is_composite_key_incomplete")}
from raw_flight_costs
where {clean("flight_id")} is not null and {clean("route_id")} is not null and flight_date is not null""",
    "stg_customer_service_tickets": f"""
select {_texts("ticket_id customer_id flight_id ticket_category customer_comments resolution_status")},
  sentiment_score, resolution_time_days,
  {cases([("sentiment_score >= 0.5", "positive"), ("sentiment_score >= 0", "neutral"),
          ("sentiment_score >= -0.5", "negative")], "very_negative")} as sentiment_label,
  case when status <> 'résolu' then case when sentiment_score < -0.7 then 'critical'
    when sentiment_score < -0.5 then 'high' when sentiment_score < 0 then 'medium' else 'low' end
    else 'low' end as urgency_level,
  {_flags({"is_resolved": "status = 'résolu'", "is_open": "status = 'ouvert'",
           "is_in_progress": "status = 'en cours'",
           "is_sla_breached": "resolution_time_days > 3 and status = 'résolu'",
           "is_delay_related": "lower(ticket_category) like '%retard%'",
           "is_cancellation_related": "lower(ticket_category) like '%annulation%'",
           "has_critical_keywords": any_word("lower(customer_comments)", V.CRITICAL_KEYWORDS)})},
  {_never("is_id_missing is_fk_missing")},
  {_flags({"is_sentiment_invalid": "abs(sentiment_score) > 1",
           "is_resolution_time_invalid": "resolution_time_days < 0"})},
  {clean("customer_comments")} is null as is_comment_empty
from (select *, lower(resolution_status) as status from raw_tickets)
where {clean("ticket_id")} is not null and {clean("customer_id")} is not null
  and {clean("flight_id")} is not null""",
    "stg_ancillary_details": f"""
select {_texts("ancillary_id booking_id item_category")},
  nullif(trim({low("purchase_channel")}), '') as purchase_channel, item_revenue_usd,
  {category("lower(item_category)", V.ITEM_CATEGORIES, "other")} as item_category_normalized,
  {category("lower(purchase_channel)", V.PURCHASE_CHANNELS, "other")} as purchase_channel_normalized,
  {_flags({"is_digital_purchase": any_word("lower(purchase_channel)", _ch["mobile_app"] + _ch["web"]),
           "is_premium_seat": any_word("lower(item_category)", V.PREMIUM_SEAT_WORDS)})},
  {_never("is_id_missing is_fk_missing")},
  {_flags({"is_revenue_invalid": "item_revenue_usd <= 0", "is_revenue_suspect": "item_revenue_usd > 500"})}
from raw_ancillary where ancillary_id is not null and booking_id is not null""",
    "stg_competitor_context": f"""
select {_texts("market_id route_id competitor_name")},
  competitor_frequency_weekly, competitor_average_fare_usd,
  {cases([("competitor_frequency_weekly >= 7", "very_strong"), ("competitor_frequency_weekly >= 5", "strong"),
          ("competitor_frequency_weekly >= 3", "moderate")], "weak")} as competitor_strength,
  {cases([("competitor_average_fare_usd < 150", "low_cost"), ("competitor_average_fare_usd < 250", "mid_range"),
          ("competitor_average_fare_usd < 350", "premium")], "ultra_premium")} as competitor_fare_segment,
  nb_competitors_on_route, total_competitor_frequency, avg_competitor_fare_on_route,
  min_competitor_fare_on_route, max_competitor_fare_on_route,
  {_never("is_id_missing is_route_missing is_competitor_missing")},
  {_flags({"is_frequency_invalid": "competitor_frequency_weekly <= 0",
           "is_fare_invalid": "competitor_average_fare_usd <= 0"})}
from (select *, count(*) over w as nb_competitors_on_route,
    cast(sum(competitor_frequency_weekly) over w as bigint) as total_competitor_frequency,
    {rnd("fsum(competitor_average_fare_usd) over w"
         " / count(competitor_average_fare_usd) over w", 2)} as avg_competitor_fare_on_route,
    min(competitor_average_fare_usd) over w as min_competitor_fare_on_route,
    max(competitor_average_fare_usd) over w as max_competitor_fare_on_route
  from raw_competitors window w as (partition by route_id))
where market_id is not null and route_id is not null and competitor_name is not null""",
    "stg_weather_impact": f"""
select {_texts("weather_id airport_code season_type disruption_risk_level")}, date as weather_date,
  average_delay_caused_min,
  case risk when 'élevé' then 3 when 'moyen' then 2 when 'faible' then 1 else 0 end
    as disruption_risk_score,
  {category("lower(season_type)", V.SEASONS, "unknown")} as season_type_normalized,
  {_flags({"is_disruptive_weather": "risk in ('élevé', 'moyen')", "is_high_risk": "risk = 'élevé'",
           "is_significant_delay": "average_delay_caused_min >= 15"})},
  {cases([("average_delay_caused_min = 0", "no_delay"), ("average_delay_caused_min < 15", "minor"),
          ("average_delay_caused_min < 45", "moderate")], "severe")} as delay_category,
  cast(month(date) as int) as weather_month, cast(quarter(date) as int) as weather_quarter,
  {_never("is_id_missing is_airport_missing is_date_missing is_composite_key_incomplete")},
  {_flags({"is_delay_invalid": "average_delay_caused_min < 0", "is_delay_suspect": "average_delay_caused_min > 240"})}
from (select *, lower(disruption_risk_level) as risk from raw_weather)
where weather_id is not null and airport_code is not null and date is not null""",
    "stg_cargo_operations": f"""
select {_texts("cargo_shipment_id flight_id cargo_type")}, weight_kg, cargo_revenue_usd,
  space_utilization_pct,
  case when weight_kg > 0 then {rnd("cargo_revenue_usd / weight_kg", 2)} end as revenue_per_kg_usd,
  {category("lower(cargo_type)", V.CARGO_TYPES, "other")} as cargo_type_normalized,
  {_flags({"is_high_value_cargo": "cargo_revenue_usd / nullif(weight_kg, 0) > 10",
           "is_sensitive_cargo": any_word("lower(cargo_type)", V.SENSITIVE_CARGO_WORDS),
           "is_underutilized": "space_utilization_pct < 20", "is_overutilized": "space_utilization_pct > 95"})},
  {cases([("space_utilization_pct >= 80", "high"), ("space_utilization_pct >= 50", "medium"),
          ("space_utilization_pct >= 20", "low")], "very_low")} as space_utilization_level,
  {cases([("weight_kg < 100", "light"), ("weight_kg < 500", "medium"), ("weight_kg < 1000", "heavy")],
         "very_heavy")} as weight_category,
  {_never("is_id_missing is_fk_missing")},
  {_flags({"is_weight_invalid": "weight_kg <= 0", "is_revenue_invalid": "cargo_revenue_usd <= 0",
           "is_utilization_invalid": "space_utilization_pct < 0 or space_utilization_pct > 100",
           "is_weight_suspect": "weight_kg > 10000", "is_revenue_suspect": "cargo_revenue_usd > 50000"})}
from raw_cargo where cargo_shipment_id is not null and flight_id is not null""",
    "stg_loyalty_activity": f"""
select {_texts("activity_id customer_id activity_type")}, miles_amount, estimated_value_usd,
  case when miles_amount > 0 then {rnd("estimated_value_usd / miles_amount", 4)} end as value_per_mile_usd,
  {cases([(_flown_miles, "earn_flight"), *_earn], "other")} as activity_category,
  not {yes(any_word("kind", V.SPENDING_WORDS))} as is_earn, {_flown_miles} as is_flight_earn,
  {_flags({"is_purchased_miles": "contains(kind, 'achet')",
           "is_partner_earn": any_word("kind", V.PARTNER_MILES_WORDS),
           "is_bonus_miles": any_word("kind", V.BONUS_MILES_WORDS)})},
  {cases([("miles_amount >= 3000", "high"), ("miles_amount >= 1000", "medium")], "low")}
    as miles_volume_category,
  customer_total_miles, customer_total_value_usd, customer_activity_count, customer_flight_miles_total,
  {_never("is_id_missing is_fk_missing")},
  {_flags({"is_miles_invalid": "miles_amount <= 0", "is_value_invalid": "estimated_value_usd < 0",
           "is_miles_suspect": "miles_amount > 100000",
           "is_value_per_mile_suspect":
               "estimated_value_usd / nullif(miles_amount, 0) not between 0.001 and 0.10"})}
from (select *, cast(sum(miles_amount) over w as bigint) as customer_total_miles,
    {rnd("fsum(estimated_value_usd) over w", 2)}
      as customer_total_value_usd,
    count(*) over w as customer_activity_count,
    cast(sum(case when {_flown_miles} then miles_amount else 0 end) over w as bigint)
      as customer_flight_miles_total
  from (select *, lower(activity_type) as kind from raw_loyalty)
  window w as (partition by customer_id))
where activity_id is not null and customer_id is not null""",
}

_ROLE = "airport_name city country continent is_domestic"


def _role(alias: str, role: str) -> str:
    return ", ".join(f"{alias}.{c} as {role}_{c}" for c in _ROLE.split())


def _z(c: str, zero: str = "0") -> str:
    return f"coalesce({c}, {zero})"


_income = "(" + " + ".join(
    f"coalesce(cast({c} as decimal(30,10)), 0)"
    for c in ("bk.tickets", "bk.extras", "cg.cargo_usd")
) + ")"
_usd = f"cast({_income} as double)"
_cost = "coalesce(fc.total_cost_usd, 0)"
_cost_cols = ("total_cost_usd fuel_cost_usd crew_cost_usd airport_fees_usd maintenance_cost_usd "
              "catering_cost_usd fuel_cost_pct")

MARTS = {
    "dim_date": f"""
select cast(strftime(d, '%Y%m%d') as int) as date_id, d as full_date, cast(year(d) as int) as year,
  cast(quarter(d) as int) as quarter, cast(month(d) as int) as month, cast(day(d) as int) as day_of_month,
  cast(dayofweek(d) as int) as day_of_week, dayname(d) as day_name, monthname(d) as month_name,
  cast(weekofyear(d) as int) as week_of_year, concat('Q', quarter(d), ' ', year(d)) as quarter_label,
  strftime(d, '%Y-%m') as year_month, dayofweek(d) in (0, 6) as is_weekend,
  case when month(d) in (12, 1, 2) then 'peak' when month(d) in (6, 7, 8) then 'high' else 'normal' end
    as season_demand, concat('FY-Q', quarter(d)) as fiscal_quarter
from (select cast(unnest(range(min(flight_date), max(flight_date) + interval 1 day, interval 1 day)) as date) as d
  from stg_flights)""",
    "dim_routes": f"""
select {columns("r", "route_id route_key origin_airport_code destination_airport_code route_type distance_km "
                     "distance_category block_time_min block_time_hours avg_speed_kmh is_return_route")},
  {_role("a", "origin")}, {_role("b", "destination")},
  {_z("c.n")} as nb_competitors, c.fare as avg_competitor_fare_usd, c.lo as min_competitor_fare_usd,
  c.hi as max_competitor_fare_usd, {_z("c.freq")} as total_competitor_frequency,
  case {_z("c.n")} when 0 then 'monopole' when 1 then 'duopole' when 2 then 'oligopole'
    when 3 then 'oligopole' else 'haute_concurrence' end as competitive_intensity,
  {yes("r.route_type = 'international'")} or {yes("r.distance_category = 'long_haul'")}
    as is_strategic_route
from stg_routes r left join stg_airports a on a.airport_code = r.origin_airport_code
  left join stg_airports b on b.airport_code = r.destination_airport_code
  left join (select route_id, count(*) as n, {rnd(mean("competitor_average_fare_usd"), 2)} as fare,
    min(competitor_average_fare_usd) as lo, max(competitor_average_fare_usd) as hi,
    cast(sum(competitor_frequency_weekly) as bigint) as freq
    from stg_competitor_context group by all) c using (route_id)""",
    "dim_customers": f"""
select *,
  {cases([("total_miles >= 10000", "high"), ("total_miles >= 3000", "medium"), ("total_miles > 0", "low")],
         "inactive")} as loyalty_engagement_level,
  {cases([("avg_sentiment_score >= 0.5", "positive"), ("avg_sentiment_score >= 0", "neutral"),
          ("avg_sentiment_score >= -0.5", "negative")], "very_negative")} as customer_sentiment_label,
  {rnd("total_loyalty_value_usd + total_miles * 0.01::double", 2)} as customer_value_score,
  {yes("customer_segment in ('business', 'premium')")} or {yes("loyalty_tier in ('Gold', 'Platinum')")}
    or total_miles >= 10000 as is_high_value,
  avg_sentiment_score < -0.5 or critical_tickets >= 2 or sla_breached_tickets >= 1 as is_at_risk,
  {yes("customer_segment = 'standard'")} and is_loyalty_member and total_miles >= 3000
    as is_upsell_candidate
from (select {columns("c", "customer_id first_name last_name gender birth_date age_years generation country "
                           "city is_domestic_customer customer_segment loyalty_tier preferred_channel "
                           "signup_date customer_tenure_days is_loyalty_member")},
    {", ".join(f"{_z(f'l.{n}')} as {n}" for n in
               "total_miles total_loyalty_value_usd total_loyalty_transactions flight_miles_earned "
               "purchased_miles bonus_miles".split())},
    {", ".join(f"{_z(f't.{n}')} as {n}" for n in
               "total_tickets avg_sentiment_score resolved_tickets critical_tickets "
               "sla_breached_tickets".split())}
  from stg_customers c
  left join (select customer_id, cast(sum(miles_amount) as bigint) as total_miles,
      {total("estimated_value_usd")} as total_loyalty_value_usd, count(*) as total_loyalty_transactions,
      {", ".join(f"cast(sum(case when {k} then miles_amount else 0 end) as bigint) as {n}" for k, n in
                 (("is_flight_earn", "flight_miles_earned"), ("is_purchased_miles", "purchased_miles"),
                  ("is_bonus_miles", "bonus_miles")))}
    from stg_loyalty_activity group by all) l using (customer_id)
  left join (select customer_id, count(*) as total_tickets,
      {rnd(mean("sentiment_score"), 3)} as avg_sentiment_score, {n_if("is_resolved")} as resolved_tickets,
      {n_if("urgency_level = 'critical'")} as critical_tickets,
      {n_if("is_sla_breached")} as sla_breached_tickets
    from stg_customer_service_tickets group by all) t using (customer_id))""",
    "fct_flights": f"""
select {columns("f", "flight_id route_id flight_cost_key flight_date flight_number aircraft_type seat_capacity "
                     "flight_status delay_minutes computed_departure_delay_min computed_arrival_delay_min "
                     "is_delayed is_cancelled")},
  cast(strftime(f.flight_date, '%Y%m%d') as int) as date_id,
  {columns("w", "disruption_risk_level disruption_risk_score is_disruptive_weather season_type_normalized")},
  w.average_delay_caused_min as weather_delay_min,
  case when delay_minutes > 0 and average_delay_caused_min > 0
    then {share("average_delay_caused_min", "delay_minutes")} else 0.0::double end as weather_delay_share_pct,
  f.is_delayed and {_z("average_delay_caused_min < delay_minutes * 0.5", "true")} as is_operational_delay,
  f.is_delayed and {_z("average_delay_caused_min >= delay_minutes * 0.5", "false")}
    as is_weather_driven_delay,
  {_z("bk.n")} as nb_bookings, {_z("bk.people")} as nb_passengers, {_z("bk.flown")} as nb_flown_passengers,
  {_z("bk.cancelled")} as nb_cancelled_bookings,
  case when seat_capacity > 0 then {share(_z("bk.n"), "seat_capacity")} end as load_factor_pct,
  {yes(_z("bk.n") + "::double / nullif(seat_capacity, 0) < 0.60")} as is_underloaded,
  {yes(_z("bk.n") + "::double / nullif(seat_capacity, 0) >= 0.85")} as is_high_load,
  {_z("bk.tickets")} as total_ticket_revenue_usd, {_z("bk.extras")} as total_ancillary_revenue_usd,
  {_z("cg.cargo_usd")} as total_cargo_revenue_usd, {rnd(_usd, 2)} as total_revenue_usd,
  case when r.distance_km > 0 and bk.flown > 0
    then {rnd(_z("bk.tickets") + " / r.distance_km / bk.flown", 4)} end as yield_usd_per_km,
  case when seat_capacity > 0 and r.distance_km > 0
    then {rnd(_z("bk.tickets") + " / (seat_capacity::double * r.distance_km)", 6)} end as rask,
  {", ".join(f"{_z('fc.' + c)} as {c}" for c in _cost_cols.split())},
  case when seat_capacity > 0 and r.distance_km > 0
    then {rnd(_cost + " / (seat_capacity::double * r.distance_km)", 6)} end as cask,
  {rnd(f"{_usd} - {_cost}", 2)} as flight_margin_usd,
  case when {_cost} > 0 then {share(f"({_usd} - {_cost})", "fc.total_cost_usd")} end as flight_margin_pct,
  {_usd} > {_cost} as is_profitable, {_z("cg.n")} as nb_cargo_shipments,
  {_z("cg.kg")} as total_cargo_weight_kg, {_z("cg.used")} as avg_cargo_utilization_pct,
  {_z("bk.seats")} as nb_seat_selections, {_z("bk.bags")} as total_bags,
  case when bk.n > 0 then {share(_z("bk.seats"), "bk.n")} else 0.0::double end
    as seat_selection_attach_rate_pct
from stg_flights f left join dim_routes r on r.route_id = f.route_id
  left join stg_flight_costs fc on fc.flight_cost_key = f.flight_cost_key
  left join stg_weather_impact w
    on w.airport_code = r.origin_airport_code and w.weather_date = f.flight_date
  left join (select flight_id, count(*) as n, count(distinct customer_id) as people,
      {total("ticket_price_usd")} as tickets, {total("ancillary_revenue_usd")} as extras,
      cast(sum(bags_count) as bigint) as bags, {n_if("is_cancelled")} as cancelled,
      {n_if("is_flown")} as flown, {n_if("has_seat_selection")} as seats
    from stg_bookings group by all) bk on bk.flight_id = f.flight_id
  left join (select flight_id, count(*) as n, {total("weight_kg")} as kg,
      {total("cargo_revenue_usd")} as cargo_usd, {rnd(mean("space_utilization_pct"), 2)} as used
    from stg_cargo_operations group by all) cg on cg.flight_id = f.flight_id""",
    "fct_bookings": f"""
select {columns("b", "booking_id customer_id flight_id booking_date booking_channel fare_class fare_family "
                     "booking_status is_confirmed is_flown is_cancelled bags_count has_seat_selection "
                     "ticket_price_category ticket_price_usd ancillary_revenue_usd total_revenue_usd "
                     "ancillary_revenue_pct")},
  f.route_id, cast(strftime(b.booking_date, '%Y%m%d') as int) as date_id,
  {_z("a.n")} as nb_ancillary_items, {_z("a.baggage")} as baggage_revenue_usd,
  {_z("a.seat")} as seat_revenue_usd, {_z("a.meal")} as meal_revenue_usd,
  {_z("a.premium")} as nb_premium_seats, {_z("a.digital")} as nb_digital_purchases,
  {_z("a.n")} > 0 as has_ancillary_purchase,
  case when a.n >= 2 then 'high' when a.n = 1 then 'low' else 'none' end as ancillary_attach_level,
  f.flight_date, f.is_delayed as flight_was_delayed, f.delay_minutes as flight_delay_minutes,
  f.is_cancelled as flight_was_cancelled, f.load_factor_pct, f.is_profitable as flight_is_profitable,
  {columns("c", "customer_segment loyalty_tier is_loyalty_member is_high_value is_at_risk "
                "is_upsell_candidate age_years generation customer_value_score")},
  c.country as customer_country, {_z("h.n")} as customer_total_bookings,
  {_z("h.usd")} as customer_total_revenue_usd, h.first_booking_date, h.last_booking_date,
  {_z("h.n")} > 1 as is_repeat_customer,
  cast({AS_OF} - h.last_booking_date as int) as days_since_last_booking,
  {yes(f"{AS_OF} - h.last_booking_date > 180")} as is_inactive_customer
from stg_bookings b left join fct_flights f on f.flight_id = b.flight_id
  left join dim_customers c on c.customer_id = b.customer_id
  left join (select booking_id, count(*) as n,
      {", ".join(total(f"case when item_category_normalized = '{k}' then item_revenue_usd else 0 end")
                 + f" as {k}" for k in ("baggage", "seat", "meal"))},
      {n_if("is_premium_seat")} as premium, {n_if("is_digital_purchase")} as digital
    from stg_ancillary_details group by all) a on a.booking_id = b.booking_id
  left join (select customer_id, count(*) as n, {total("total_revenue_usd")} as usd,
      min(booking_date) as first_booking_date, max(booking_date) as last_booking_date
    from stg_bookings where booking_status <> 'cancelled' group by all) h
    on h.customer_id = b.customer_id""",
    "fct_tickets": f"""
select {columns("t", "ticket_id customer_id flight_id ticket_category customer_comments resolution_status "
                     "resolution_time_days is_resolved is_open is_in_progress is_sla_breached "
                     "sentiment_score sentiment_label urgency_level")}, f.route_id,
  {_flags({f"has_{k}_keyword": any_word("lower(customer_comments)", w)
           for k, w in V.COMPLAINT_KEYWORDS.items()})},
  {category("lower(customer_comments)", V.PRIMARY_COMPLAINT, "other")} as primary_complaint_category,
  f.flight_date, f.is_delayed as flight_was_delayed, f.delay_minutes as flight_delay_minutes,
  f.is_cancelled as flight_was_cancelled, f.is_operational_delay, f.is_weather_driven_delay,
  f.load_factor_pct,
  {yes("lower(customer_comments) like '%retard%' and f.is_delayed")} as is_delay_complaint_confirmed,
  {yes("lower(customer_comments) like '%annulé%' and f.is_cancelled")}
    as is_cancellation_complaint_confirmed,
  {columns("c", "customer_segment loyalty_tier is_high_value is_at_risk customer_value_score")},
  {yes("c.is_high_value and urgency_level in ('critical', 'high')")} as is_high_value_critical_ticket,
  {yes("not is_resolved and resolution_time_days > 7")} as is_overdue_ticket
from stg_customer_service_tickets t left join fct_flights f on f.flight_id = t.flight_id
  left join dim_customers c on c.customer_id = t.customer_id""",
}


def _pct(condition: str) -> str:
    return share(n_if(condition), "count(*)")


# decision rules, written out independently of the rule objects of the package
# FIXED VALUES: the rules of the decision layer
_R = {
    "grow": "avg_load_factor_pct >= 80 and avg_margin_pct >= 15 and nb_competitors <= 1",
    "weak": "is_strategic_route and (avg_margin_pct < 10 or delay_rate_pct > 30)",
    "weak_flag": "is_strategic_route and (avg_margin_pct < 10 or delay_rate_pct > 30"
                 " or profitable_flight_pct < 60)",
    "ops": "avg_margin_pct < 0 and avg_load_factor_pct >= 65 and nb_operational_delays > nb_weather_delays",
    "demand": "avg_margin_pct < 0 and avg_load_factor_pct < 65",
    "defend": "avg_margin_pct >= 10 and nb_competitors >= 3",
    "defend_flag": "avg_margin_pct >= 10 and nb_competitors >= 3 and coalesce(avg_sentiment_score, 0) < -0.3",
    "risk": "is_high_value and (avg_sentiment_score < -0.3 or critical_tickets >= 1"
            " or days_since_last_flight > 90)",
    "convert": "not is_loyalty_member and total_bookings >= 2 and total_revenue_usd >= 300",
    "upgrade": "customer_segment = 'standard' and total_miles >= 5000 and ancillary_attach_rate_pct >= 50",
    "offer": "total_bookings >= 2 and ancillary_attach_rate_pct < 30 and avg_sentiment_score >= -0.2",
    "wake": "days_since_last_flight > 180",
    "wake_flag": "days_since_last_flight > 180 and total_bookings >= 1",
}


def _decided(flag_rules: list[str], label_rules: list[str], labels: dict, texts: dict) -> str:
    label_texts, advice = list(labels.values()), list(texts.values())
    flags = ", ".join(f"{yes(_R[r])} as flag_{i}" for i, r in enumerate(flag_rules, 1))
    label = cases([(_R[r], t) for r, t in zip(label_rules, label_texts)], label_texts[-1])
    follow = cases([(_R[r], t) for r, t in zip(flag_rules, advice)], advice[-1])
    return f"{flags}, {label} as ontology_label, {follow} as recommendation"


_metrics = ", ".join("cast({} as double) as metric_%d" % i for i in range(1, 6))

DECISIONS = {
    "route_performance": f"""
select route_id, count(*) as nb_flights, cast(sum(nb_passengers) as bigint) as total_passengers,
  {rnd(mean("load_factor_pct"), 2)} as avg_load_factor_pct, {total("total_revenue_usd")} as total_revenue_usd,
  {total("total_cost_usd")} as total_cost_usd, {total("flight_margin_usd")} as total_margin_usd,
  {rnd(mean("flight_margin_pct"), 2)} as avg_margin_pct, {rnd(mean("yield_usd_per_km"), 4)} as avg_yield,
  {rnd(mean("rask"), 6)} as avg_rask, {rnd(mean("cask"), 6)} as avg_cask,
  {rnd(mean("delay_minutes"), 1)} as avg_delay_minutes, {n_if("is_delayed")} as nb_delayed_flights,
  {n_if("is_cancelled")} as nb_cancelled_flights, {_pct("is_delayed")} as delay_rate_pct,
  {_pct("is_cancelled")} as cancellation_rate_pct, {n_if("is_operational_delay")} as nb_operational_delays,
  {n_if("is_weather_driven_delay")} as nb_weather_delays, {n_if("is_profitable")} as nb_profitable_flights,
  {_pct("is_profitable")} as profitable_flight_pct
from fct_flights group by all""",
    "route_sentiment": f"""
select route_id, count(*) as nb_tickets, {rnd(mean("sentiment_score"), 3)} as avg_sentiment_score,
  {n_if("urgency_level = 'critical'")} as nb_critical_tickets,
  {", ".join(f"{n_if(f'has_{k}_keyword')} as nb_{k}_complaints" for k in ("delay", "baggage", "refund"))},
  {n_if("is_operational_delay and has_delay_keyword")} as nb_operational_delay_complaints
from fct_tickets where route_id is not null group by all""",
    "customer_performance": f"""
select customer_id, count(distinct booking_id) as total_bookings,
  {total("total_revenue_usd")} as total_revenue_usd,
  {rnd(mean("total_revenue_usd"), 2)} as avg_revenue_per_booking,
  {total("ancillary_revenue_usd")} as total_ancillary_usd, max(flight_date) as last_flight_date,
  cast({AS_OF} - max(flight_date) as int) as days_since_last_flight,
  {n_if("has_ancillary_purchase")} as nb_bookings_with_ancillary,
  {_pct("has_ancillary_purchase")} as ancillary_attach_rate_pct
from fct_bookings group by all""",
    "route_decisions": f"""
select *, {_decided(["grow", "weak_flag", "ops", "demand", "defend_flag"],
                    ["grow", "weak", "ops", "demand", "defend"], V.ROUTE_LABELS, V.ROUTE_ADVICE)}
from dim_routes left join route_performance using (route_id) left join route_sentiment using (route_id)""",
    "customer_decisions": f"""
select *, {_decided(["risk", "convert", "upgrade", "offer", "wake_flag"],
                    ["risk", "convert", "upgrade", "offer", "wake"], V.CUSTOMER_LABELS, V.CUSTOMER_ADVICE)}
from dim_customers left join customer_performance using (customer_id)""",
    "decision_layer": f"""
select 'route' as decision_entity_type, route_id as entity_id, route_key as entity_label, ontology_label,
  flag_1, flag_2, flag_3, flag_4, flag_5,
  {_metrics.format("avg_load_factor_pct", "avg_margin_pct", "delay_rate_pct", "avg_sentiment_score",
                   "total_revenue_usd")}, recommendation from route_decisions
union all
select 'customer', customer_id, first_name || ' ' || last_name, ontology_label,
  flag_1, flag_2, flag_3, flag_4, flag_5,
  {_metrics.format("total_revenue_usd", "ancillary_attach_rate_pct", "days_since_last_flight",
                   "avg_sentiment_score", "total_miles")}, recommendation from customer_decisions""",
}

# graph metrics through the joins as they stand, every pair of rows included
_g_delay = share(f"cast({n_if('f.is_delayed')} as double)", "count(f.flight_id)")
GRAPH = {
    "route_metrics": f"""
select r.route_id, r.route_key, r.origin_airport_code, r.destination_airport_code, r.is_strategic_route,
  r.nb_competitors, {_z(rnd(mean("f.load_factor_pct"), 2))} as avg_load_factor_pct,
  {_z(rnd(mean("f.flight_margin_pct"), 2))} as avg_margin_pct, {_z(_g_delay)} as delay_rate_pct,
  {_z(rnd(mean("t.sentiment_score"), 2))} as avg_sentiment_score
from dim_routes r left join fct_flights f on f.route_id = r.route_id
  left join fct_tickets t on t.flight_id = f.flight_id group by all""",
    "customer_metrics": f"""
select c.customer_id, c.is_high_value, c.is_at_risk, c.avg_sentiment_score, c.total_miles,
  c.is_loyalty_member, {_z("c.customer_segment", "'standard'")} as customer_segment,
  count(b.booking_id) as total_bookings, {_z(total("b.total_revenue_usd"))} as total_revenue,
  {_z(share(n_if("b.has_ancillary_purchase"), "count(b.booking_id)"))} as ancillary_attach_rate,
  {_z("max(b.days_since_last_booking)", "999")} as days_since_last_flight,
  {n_if("t.urgency_level = 'critical'")} as critical_tickets
from dim_customers c left join fct_bookings b on b.customer_id = c.customer_id
  left join fct_tickets t on t.customer_id = c.customer_id group by all""",
}


def _lex(c: str, kind: str) -> str:
    if kind == "decimal":
        return f"regexp_replace(cast(cast({c} as decimal(38,6)) as varchar), '(\\.\\d+?)0+$', '\\1')"
    return f"cast({c} as varchar)"


def _facts(view: str, key: str, base: str, properties: dict, links: dict) -> str:
    iri = f"'{NS}' || {key}"
    parts = [f"select {iri} as s, '{V.RDF_TYPE}' as p, '{NS}{base}' as o, null::varchar as dtype, "
             f"true as is_iri from {view}"]
    for p, (kind, column) in properties.items():
        parts.append(f"select {iri}, '{NS}{p}', {_lex(column, kind)}, '{V.XSD}{kind}', false from {view}")
    for p, column in links.items():
        parts.append(f"select {iri}, '{NS}{p}', '{NS}' || {column}, null, true from {view}")
        parts.append(f"select '{NS}' || {column}, '{V.RDF_TYPE}', '{NS}Airport', null, true from {view}")
    return "select distinct * from (" + "\nunion all ".join(parts) + ") where s is not null and o is not null"


_A = f"'{V.RDF_TYPE}'"
GRAPH |= {
    "route_triples": _facts("route_metrics", "route_id", "Route", V.ROUTE_PROPERTIES,
                            {"hasOrigin": "origin_airport_code", "hasDestination": "destination_airport_code"}),
    "customer_triples": _facts("customer_metrics", "customer_id", "Customer", V.CUSTOMER_PROPERTIES, {}),
    "competitor_triples": f"""
select '{NS}' || route_id as s, '{NS}hasCompetitor' as p, '{NS}' || replace(competitor_name, ' ', '_') as o,
  null::varchar as dtype, true as is_iri from stg_competitor_context
union select '{NS}' || replace(competitor_name, ' ', '_'), {_A}, '{NS}Airline', null, true
from stg_competitor_context""",
}

# FIXED VALUES: the rules of the graph
_G = {
    "GrowthOpportunity": "avg_load_factor_pct >= 80 and avg_margin_pct >= 15 and nb_competitors <= 1",
    "StrategicUnderperformer": "is_strategic_route and (avg_margin_pct < 10 or delay_rate_pct > 30)",
    "OperationallyUnprofitable": "avg_margin_pct < 0 and avg_load_factor_pct >= 65",
    "DemandUnprofitable": "avg_margin_pct < 0 and avg_load_factor_pct < 65",
    "RouteToDefend": "avg_margin_pct >= 10 and nb_competitors >= 3 and avg_sentiment_score < -0.3",
    "HighValueAtRisk": "is_high_value and (avg_sentiment_score < -0.3 or critical_tickets >= 1"
                       " or days_since_last_flight > 90)",
    "LoyaltyConversionTarget": "not is_loyalty_member and total_bookings >= 2 and total_revenue >= 300",
    "PremiumUpgradeCandidate": "customer_segment = 'standard' and total_miles >= 5000"
                               " and ancillary_attach_rate >= 50",
    "AncillaryOfferTarget": "total_bookings >= 2 and ancillary_attach_rate < 30 and avg_sentiment_score >= -0.2",
    "ReactivationTarget": "days_since_last_flight > 180 and total_bookings >= 1",
}


def _labels(view: str, key: str, names: list[str], default: str) -> str:
    hits = [f"select {key} as entity_id, '{n}' as label from {view} where {_G[n]}" for n in names]
    none = " and ".join(f"not coalesce({_G[n]}, false)" for n in names)
    hits.append(f"select {key}, '{default}' from {view} where {none}")
    return "select * from (" + "\nunion all ".join(hits) + ") where entity_id is not null"


GRAPH |= {
    "route_labels": _labels("route_metrics", "route_id", list(_G)[:5], "StableRoute"),
    "customer_labels": _labels("customer_metrics", "customer_id", list(_G)[5:], "StableCustomer"),
}
