"""The twelve raw sheets as SQL over the driver's tables."""

_DAY = "date '1998-01-01' + cast((p_partkey * 7) % 1200 as int)"
_ROUTE = "concat('R', lpad(cast(p_partkey % (select count(*) from supplier) as varchar), 5, '0'))"
_LINE = "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey)"


def _cents(x: str) -> str:
    return f"cast(round(cast({x} as decimal(20,8)), 2) as double)"


def _at(clock: str) -> str:
    return f"cast(concat(cast({_DAY} as varchar), ' ', {clock}) as timestamp)"


RAW = {
    "raw_airports": """
select concat('N', lpad(cast(n_nationkey as varchar), 2, '0')) as airport_code,
  case when n_nationkey % 2 = 0 then concat(n_name, ' International') else n_name end as airport_name,
  case when n_nationkey % 9 = 4 then '  ' else n_name end as city,
  case when n_nationkey % 5 = 0 then 'Côte d''Ivoire' else n_name end as country,
  case n_regionkey when 0 then 'Africa/Abidjan' when 1 then 'America/New_York'
    when 2 then 'Asia/Tokyo' when 3 then 'Europe/Paris' else 'Pacific/Fiji' end as timezone,
  cast(n_nationkey * 8 - 90 as double) as latitude,
  cast(n_nationkey * 16 - 180 as double) as longitude
from nation""",
    "raw_routes": """
select concat('R', lpad(cast(s_suppkey as varchar), 5, '0')) as route_id,
  concat('N', lpad(cast(s_nationkey as varchar), 2, '0')) as origin_airport_code,
  concat(' N', lpad(cast((s_nationkey + 1 + s_suppkey % (select max(n_nationkey) from nation)) % (select max(n_nationkey) + 1 from nation) as varchar), 2, '0'))
    as destination_airport_code,
  case s_suppkey % 4 when 0 then 'Domestic' when 3 then ' INTERNATIONAL' else 'Regional' end
    as route_type,
  cast(200 + (s_suppkey * 37) % 1800 as int) as distance_km,
  cast(40 + (s_suppkey * 53) % 120 as int) as block_time_min
from supplier""",
    "raw_flights": f"""
select concat('F', p_partkey) as flight_id, concat('HF', p_partkey) as flight_number,
  {_ROUTE} as route_id, {_DAY} as flight_date, p_brand as aircraft_type,
  cast(20 + (p_partkey % 5) * 15 as int) as seat_capacity,
  case when p_partkey % 40 = 0 then 'Cancelled' else ' Landed ' end as flight_status,
  cast(case when p_partkey % 20 = 6 or p_partkey % (3 + p_partkey % 4) = 0 then p_size * 2
    else p_size % 12 end as int) as delay_min,
  {_at("'08:00:30'")} as scheduled_departure,
  {_at("concat('08:', lpad(cast(p_size as varchar), 2, '0'), ':10')")} as actual_departure,
  {_at("'11:00:00'")} as scheduled_arrival,
  {_at("concat('11:', lpad(cast(p_size as varchar), 2, '0'), ':00')")} as actual_arrival
from part""",
    "raw_flight_costs": f"""
select concat('F', p_partkey) as flight_id, {_ROUTE} as route_id, {_DAY} as flight_date,
  cast(2000 + (p_partkey % 10) * 1900 + case when p_partkey % 20 = 6 then 20000 else 0 end
    as double) as fuel_cost_usd,
  cast(900 + p_size * 10 as double) as airport_fees_usd,
  cast(1500 + p_partkey % 7 * 100 as double) as crew_cost_usd,
  cast(700 + p_size as double) as maintenance_cost_usd,
  cast(p_size * 12 as double) as catering_cost_usd
from part""",
    "raw_bookings": f"""
select concat('B', {_LINE}) as booking_id, concat('C', o_custkey) as customer_id,
  concat(' F', l_partkey) as flight_id, o_orderdate as booking_date,
  o_orderpriority as booking_channel, concat(l_returnflag, l_linestatus) as fare_class,
  case when l_linenumber = 7 then '' else 'Flex' end as fare_family,
  {_cents('l_extendedprice / 100')} as ticket_price_usd,
  {_cents('l_tax * 500')} as ancillary_revenue_usd,
  cast(l_linenumber % 3 as int) as bags_count, cast(l_linenumber % 2 as int) as seat_selection_flag,
  case l_returnflag when 'R' then 'Cancelled' when 'A' then 'Flown' else 'Confirmed' end
    as booking_status
from lineitem join orders on l_orderkey = o_orderkey""",
    "raw_customers": """
select concat('C', c_custkey) as customer_id, c_name as first_name,
  concat('N', c_nationkey) as last_name,
  case c_custkey % 3 when 0 then 'm' when 1 then 'F' else 'X' end as gender,
  date '1945-01-01' + cast((c_custkey * 13) % 25000 as int) as birth_date,
  case when c_nationkey % 5 = 0 then 'Côte d''Ivoire' else 'Other' end as country,
  cast(null as varchar) as city,
  case c_mktsegment when 'BUILDING' then 'Business' when 'MACHINERY' then 'Premium'
    when 'HOUSEHOLD' then 'Budget' else 'Standard' end as customer_segment,
  case when c_acctbal > 9000 then 'Platinum' when c_acctbal > 8000 then 'Gold'
    when c_acctbal > 5000 then 'Silver' when c_acctbal > 2000 then 'None'
    when c_acctbal > 0 then '' end as loyalty_tier,
  case when c_custkey % 2 = 0 then 'Web' else 'MOBILE' end as preferred_channel,
  date '1999-01-01' + cast(c_custkey % 1200 as int) as signup_date
from customer""",
    "raw_tickets": f"""
select concat('T', event_id) as ticket_id, concat('C', user_id * 3) as customer_id,
  concat('F', event_id % (select count(*) from part)) as flight_id,
  case event_id % 3 when 0 then 'Retard de vol' when 1 then 'Annulation' else 'Autre' end
    as ticket_category,
  case event_id % 13 when 0 then 'Demande de remboursement, débité deux fois'
    when 1 then 'Bagage perdu' when 2 then 'Ma valise est abîmée'
    when 3 then 'RETARD et correspondance manquée' when 4 then 'Vol annulé sans préavis'
    when 5 then 'Surréservation: refusé l''embarquement' when 6 then 'Repas immangeable'
    when 7 then 'Siège cassé, hublot sale' when 8 then 'Climatisation en panne'
    when 9 then 'Le site web ne marche pas' when 10 then 'Personnel désagréable'
    when 11 then 'Très bon accueil, équipe attentionnée' else '  ' end as customer_comments,
  {_cents('case when value > 150 then -1.0 else 1.0 - value / 75 end')} as sentiment_score,
  case event_id % 4 when 0 then 'Ouvert' when 1 then 'En cours' else 'Résolu' end
    as resolution_status,
  cast(event_id % 10 as int) as resolution_time_days
from events where event_type = 'error'""",
    "raw_ancillary": f"""
select concat('A', {_LINE}, '-', k) as ancillary_id, concat('B', {_LINE}) as booking_id,
  case (l_linenumber + k) % 7 when 0 then 'Bagage supplémentaire' when 1 then 'Siège premium'
    when 2 then 'Repas spécial' when 3 then 'Lounge' when 4 then 'Assurance voyage'
    when 5 then 'Priorité' else 'Wifi' end as item_category,
  case (l_linenumber + k) % 5 when 0 then 'Application mobile' when 1 then 'Site web'
    when 2 then 'Comptoir aéroport' when 3 then 'Agence' else 'Autre' end as purchase_channel,
  {_cents('l_tax * 300 + k')} as item_revenue_usd
from lineitem join orders on l_orderkey = o_orderkey
  cross join (select 0 as k union all select 1 as k) ks
where l_discount >= 0.02 + 0.06 * k + 0.01 * (o_custkey % 8)""",
    "raw_competitors": """
select concat('M', s_suppkey, '-', n_nationkey) as market_id,
  concat('R', lpad(cast(s_suppkey as varchar), 5, '0')) as route_id, n_name as competitor_name,
  cast(1 + (s_suppkey + n_nationkey) % 9 as int) as competitor_frequency_weekly,
  cast(100 + (s_suppkey * 17 + n_nationkey * 31) % 300 as double) as competitor_average_fare_usd
from supplier cross join nation where n_nationkey < (s_suppkey * 7) % 5""",
    "raw_weather": f"""
select concat('W', n_nationkey, '-', cast(d.day as varchar)) as weather_id,
  concat('N', lpad(cast(n_nationkey as varchar), 2, '0')) as airport_code, d.day as date,
  case (n_nationkey + month(d.day)) % 6 when 0 then 'Harmattan' when 1 then 'Petite saison sèche'
    when 2 then 'Grande saison sèche' when 3 then 'Petite saison des pluies'
    when 4 then 'Grande saison des pluies' else 'Saison sèche' end as season_type,
  case (n_nationkey + day(d.day)) % 4 when 0 then 'Élevé' when 1 then 'Moyen' when 2 then 'Faible'
    else '' end as disruption_risk_level,
  cast((n_nationkey * 5 + day(d.day) * 3) % 60 as int) as average_delay_caused_min
from nation cross join (select distinct {_DAY} as day from part) d""",
    "raw_cargo": f"""
select concat('G', {_LINE}) as cargo_shipment_id, concat('F', l_partkey) as flight_id,
  case l_linenumber when 1 then 'Documents urgents' when 2 then 'Pharma' when 3 then 'Périssable'
    when 4 then 'Textile' when 5 then 'Électronique' else 'Divers' end as cargo_type,
  l_quantity * 22.5 as weight_kg, {_cents('l_extendedprice / 40')} as cargo_revenue_usd,
  l_discount * 1000 as space_utilization_pct
from lineitem""",
    "raw_loyalty": f"""
select concat('L', event_id) as activity_id, concat('C', user_id * 3 + event_id % 2) as customer_id,
  case event_id % 7 when 0 then 'Miles gagnés sur vol' when 1 then 'Partenaire hôtel'
    when 2 then 'Bonus promotion' when 3 then 'Miles achetés' when 4 then 'Miles utilisés'
    when 5 then 'Miles expirés' else 'Divers' end as activity_type,
  cast(floor(value * 10) as int) as miles_amount, {_cents('value / 8')} as estimated_value_usd
from events where event_type <> 'error'""",
}
