"""One complete SQL statement per registered query."""

from __future__ import annotations

import re
from typing import NamedTuple

from altimart import fixed_values as V
from oracle.models import _G, DECISIONS, GRAPH, MARTS, NS, STAGING
from oracle.sheets import RAW
from oracle.sql import mean, n_if, quoted, rnd, share, total

class _Kpi(NamedTuple):
    name: str
    model: str
    kind: str
    measure: str


# FIXED VALUES: the metrics, written out here apart from the library's list
KPIS = {
    k.name: k
    for k in (
        _Kpi("load_factor", "fct_flights", "mean", "load_factor_pct"),
        _Kpi("route_margin", "fct_flights", "sum", "flight_margin_usd"),
        _Kpi("route_margin_pct", "fct_flights", "mean", "flight_margin_pct"),
        _Kpi("yield", "fct_flights", "mean", "yield_usd_per_km"),
        _Kpi("delay_rate", "fct_flights", "share", "is_delayed"),
        _Kpi("cancellation_rate", "fct_flights", "share", "is_cancelled"),
        _Kpi("ancillary_attach_rate", "fct_bookings", "share", "has_ancillary_purchase"),
        _Kpi("repeat_booking_rate", "fct_bookings", "share", "is_repeat_customer"),
        _Kpi("customer_sentiment_score", "fct_tickets", "mean", "sentiment_score"),
        _Kpi("clv_revenue", "fct_bookings", "sum", "total_revenue_usd"),
        _Kpi("clv_score", "dim_customers", "mean", "customer_value_score"),
        _Kpi("rask", "fct_flights", "mean", "rask"),
        _Kpi("cask", "fct_flights", "mean", "cask"),
        _Kpi("loyalty_engagement_score", "dim_customers", "mean", "total_miles"),
    )
}
VIEWS = RAW | STAGING | MARTS | DECISIONS | GRAPH
_NAMES = re.compile(r"\b(" + "|".join(sorted(VIEWS, key=len, reverse=True)) + r")\b")


def _needed(sql: str, seen: dict[str, None]) -> None:
    for name in _NAMES.findall(sql):
        if name not in seen:
            _needed(VIEWS[name], seen)
            seen[name] = None


def statement(sql: str) -> str:
    """The query with every view it needs in front of it."""
    seen: dict[str, None] = {}
    _needed(sql, seen)
    return "with " + ",\n".join(f"{n} as ({VIEWS[n]})" for n in seen) + "\n" + sql


def _kpi(name: str, by: str) -> str:
    m = KPIS[name]
    value = {
        "mean": mean(m.measure),
        "sum": total(m.measure),
        "share": f"cast({n_if(m.measure)} as double) / count(*)",
    }[m.kind]
    return f"select {by}, {value} as {name} from {m.model} group by all"


def _overview() -> str:
    parts = []
    for m in KPIS.values():
        one = _kpi(m.name, "1 as one")
        parts.append(f"select {quoted(m.name)} as metric, {m.name}::double as value from ({one})")
    return " union all ".join(parts)


def _grains() -> str:
    parts = []
    for m in KPIS.values():
        by = KPI_GRAIN[m.model]
        parts.append(f"select '{by}' as grain, {by} as member, '{m.name}' as metric, {m.name}::double as value from ({_kpi(m.name, by)})")
        parts.append(f"select '' as grain, null as member, '{m.name}' as metric, {m.name}::double as value from ({_kpi(m.name, '1 as one')})")
    return " union all ".join(parts)


# FIXED VALUES: the schema, written out here apart from the library's lists
_CLASSES = {
    "Route": "Route aérienne", "Customer": "Client", "Airport": "Aéroport", "Airline": "Compagnie aérienne",
}
_COMMENTS = {
    "Route": "Équivalent de la table main_marts.dim_routes.",
    "Customer": "Équivalent de la table main_marts.dim_customers.",
    "Airport": "Classe de contexte. Permet hasOrigin et hasDestination.",
    "Airline": "Classe de contexte. Permet hasCompetitor.",
}


def _schema() -> str:
    rdfs, owl = "http://www.w3.org/2000/01/rdf-schema#", "http://www.w3.org/2002/07/owl#"
    rows = []

    def link(s, p, o):
        rows.append((NS + s, p, o, None, True))

    def text(s, p, o):
        rows.append((NS + s, rdfs + p, o, "@fr", False))

    for name in _CLASSES:
        link(name, V.RDF_TYPE, owl + "Class")
        text(name, "label", _CLASSES[name])
        text(name, "comment", _COMMENTS[name])
    inferred = {"Route": [*list(_G)[:5], "StableRoute"], "Customer": [*list(_G)[5:], "StableCustomer"]}
    for base, names in inferred.items():
        for name in names:
            link(name, V.RDF_TYPE, owl + "Class")
            link(name, rdfs + "subClassOf", NS + base)
            text(name, "label", V.CLASS_TEXTS[name])
    for base, properties in (("Route", V.ROUTE_PROPERTIES), ("Customer", V.CUSTOMER_PROPERTIES)):
        for name, (xsd, _) in properties.items():
            link(name, V.RDF_TYPE, owl + "DatatypeProperty")
            link(name, rdfs + "domain", NS + base)
            link(name, rdfs + "range", V.XSD + xsd)
    for name, base, target in (
        ("hasOrigin", "Route", "Airport"), ("hasDestination", "Route", "Airport"), ("hasCompetitor", "Route", "Airline"),
    ):
        link(name, V.RDF_TYPE, owl + "ObjectProperty")
        link(name, rdfs + "domain", NS + base)
        link(name, rdfs + "range", NS + target)
    for a, b in (
        ("HighValueAtRisk", "StableCustomer"), ("GrowthOpportunity", "DemandUnprofitable"),
        ("GrowthOpportunity", "StrategicUnderperformer"),
    ):
        link(a, owl + "disjointWith", NS + b)
    values = ", ".join(
        f"({quoted(s)}, {quoted(p)}, {quoted(o)}, {'null' if d is None else quoted(d)}, {str(i).lower()})" for s, p, o, d, i in rows
    )
    return f"select * from (values {values}) as t(s, p, o, dtype, is_iri)"


KPI_GRAIN = {
    "fct_flights": "route_id",
    "fct_bookings": "customer_segment",
    "fct_tickets": "route_id",
    "dim_customers": "customer_segment",
}

_FLAGS = "flag_1, flag_2, flag_3, flag_4, flag_5"
_is = "'OWL inference' as source"
_route_facts = {
    "hasLoadFactorPct": "avg_load_factor_pct", "hasMarginPct": "avg_margin_pct",
    "hasNbCompetitors": "nb_competitors", "hasDelayRatePct": "delay_rate_pct",
    "hasAvgSentimentScore": "avg_sentiment_score", "isStrategicRoute": "is_strategic_route",
    "isHighValue": "is_high_value", "hasSentimentScore": "avg_sentiment_score",
    "hasCriticalTickets": "critical_tickets", "hasDaysSinceLastFlight": "days_since_last_flight",
    "isLoyaltyMember": "is_loyalty_member", "hasTotalBookings": "total_bookings",
    "hasTotalRevenue": "total_revenue", "hasCustomerSegment": "customer_segment",
    "hasTotalMiles": "total_miles", "hasAncillaryAttachRate": "ancillary_attach_rate",
}


def _num(c: str) -> str:
    return (f"regexp_replace(cast(cast({c} as decimal(38,6)) as varchar), "
            "'(\\.\\d+?)0+$', '\\1')")


def _shown(p: str) -> str:
    c = _route_facts[p]
    return f"cast({c} as varchar)" if p.startswith("is") or "Segment" in p else _num(c)


# FIXED VALUES: what the explanation of each label says, and the tests behind it
_REASONS = {
    "GrowthOpportunity": "'LF=' || {hasLoadFactorPct} || '>=80 ET Marge=' || {hasMarginPct} "
                         "|| '>=15 ET Concurrents=' || {hasNbCompetitors} || '<=1'",
    "HighValueAtRisk": "'is_high_value=True ET (Sentiment=' || {hasSentimentScore} "
                       "|| '<-0.3 OU CriticalTickets=' || {hasCriticalTickets} "
                       "|| '>=1 OU Inactif=' || {hasDaysSinceLastFlight} || '>90j)'",
    "StrategicUnderperformer": "'isStrategicRoute=' || {isStrategicRoute} || ' = true ET (hasMarginPct=' || "
                               "{hasMarginPct} || ' < 10 OU hasDelayRatePct=' || {hasDelayRatePct} || ' > 30)'",
    "OperationallyUnprofitable": "'hasMarginPct=' || {hasMarginPct} || ' < 0 ET hasLoadFactorPct=' || "
                                 "{hasLoadFactorPct} || ' >= 65'",
    "DemandUnprofitable": "'hasMarginPct=' || {hasMarginPct} || ' < 0 ET hasLoadFactorPct=' || "
                          "{hasLoadFactorPct} || ' < 65'",
    "RouteToDefend": "'hasMarginPct=' || {hasMarginPct} || ' >= 10 ET hasNbCompetitors=' || "
                     "{hasNbCompetitors} || ' >= 3 ET hasAvgSentimentScore=' || {hasAvgSentimentScore} || ' < -0.3'",
    "LoyaltyConversionTarget": "'isLoyaltyMember=' || {isLoyaltyMember} || ' = false ET hasTotalBookings=' || "
                               "{hasTotalBookings} || ' >= 2 ET hasTotalRevenue=' || {hasTotalRevenue} || ' >= 300'",
    "PremiumUpgradeCandidate": "'hasCustomerSegment=' || {hasCustomerSegment} || ' = standard ET hasTotalMiles=' || "
                               "{hasTotalMiles} || ' >= 5000 ET hasAncillaryAttachRate=' || "
                               "{hasAncillaryAttachRate} || ' >= 50'",
    "AncillaryOfferTarget": "'hasTotalBookings=' || {hasTotalBookings} || ' >= 2 ET hasAncillaryAttachRate=' || "
                            "{hasAncillaryAttachRate} || ' < 30 ET hasSentimentScore=' || {hasSentimentScore} || ' >= -0.2'",
    "ReactivationTarget": "'hasDaysSinceLastFlight=' || {hasDaysSinceLastFlight} || ' > 180 ET hasTotalBookings=' || "
                          "{hasTotalBookings} || ' >= 1'",
}


def _explained(entity: str) -> str:
    view, key = f"{entity}_metrics", f"{entity}_id"
    names = list(_REASONS)
    mine = [n for n in names if (n in V.ROUTE_LABELS) == (entity == "route")]
    fill = {p: _shown(p) for p in _route_facts}
    arms = " ".join(f"when '{n}' then {_REASONS[n].format(**fill)}" for n in mine)
    return (f"select '{entity}' as entity_type, entity_id, label, case label {arms} "
            f"else {quoted(V.DEFAULT_REASON)} end as explanation "
            f"from {entity}_labels l join {view} m on m.{key} = l.entity_id")


# FIXED VALUES: the tests of each label
_TESTS = {
    "GrowthOpportunity": ["hasLoadFactorPct >= 80", "hasMarginPct >= 15", "hasNbCompetitors <= 1"],
    "StrategicUnderperformer": ["isStrategicRoute = true", "hasMarginPct < 10", "hasDelayRatePct > 30"],
    "OperationallyUnprofitable": ["hasMarginPct < 0", "hasLoadFactorPct >= 65"],
    "DemandUnprofitable": ["hasMarginPct < 0", "hasLoadFactorPct < 65"],
    "RouteToDefend": ["hasMarginPct >= 10", "hasNbCompetitors >= 3", "hasAvgSentimentScore < -0.3"],
    "HighValueAtRisk": ["isHighValue = true", "hasSentimentScore < -0.3", "hasCriticalTickets >= 1",
                        "hasDaysSinceLastFlight > 90"],
    "LoyaltyConversionTarget": ["isLoyaltyMember = false", "hasTotalBookings >= 2", "hasTotalRevenue >= 300"],
    "PremiumUpgradeCandidate": ["hasCustomerSegment = 'standard'", "hasTotalMiles >= 5000",
                                "hasAncillaryAttachRate >= 50"],
    "AncillaryOfferTarget": ["hasTotalBookings >= 2", "hasAncillaryAttachRate < 30", "hasSentimentScore >= -0.2"],
    "ReactivationTarget": ["hasDaysSinceLastFlight > 180", "hasTotalBookings >= 1"],
}


def _seen(p: str) -> str:
    """A tested value as text: decimals to six places, everything else as it is."""
    kind = (V.ROUTE_PROPERTIES | V.CUSTOMER_PROPERTIES)[p][0]
    c = _route_facts[p]
    return _num(c) if kind == "decimal" else f"cast({c} as varchar)"


def _traced(entity: str) -> str:
    parts = []
    for label, tests in _TESTS.items():
        if (label in V.ROUTE_LABELS) != (entity == "route"):
            continue
        for test in tests:
            p, op, bound = test.split()
            parts.append(
                f"select '{entity}' as entity_type, entity_id, label, '{p}' as metric, '{op}' as op, "
                f"{quoted(bound.strip(chr(39)))} as threshold, {_seen(p)} as value, "
                f"{_route_facts[p]} {op} {bound} as ok "
                f"from {entity}_labels join {entity}_metrics on {entity}_id = entity_id "
                f"where label = '{label}'"
            )
    return " union all ".join(parts)


_rules = "'OWL inference — règles SPARQL CONSTRUCT'"
_route_names = ", ".join(quoted(n) for n in V.ROUTE_LABELS)


def _metric_rows(entity: str) -> str:
    """One row per property that is there; entities with a label are all entities with a key."""
    kinds = V.ROUTE_PROPERTIES if entity == "route" else V.CUSTOMER_PROPERTIES
    parts = []
    for name, (kind, column) in kinds.items():
        text = _num(column) if kind in ("decimal", "integer") else f"cast({column} as varchar)"
        parts.append(
            f"select '{entity}' as entity_type, {entity}_id as entity_id, {_rules} as source, '{name}' as metric, "
            f"{text} as text, try_cast({text} as double) as number from {entity}_metrics "
            f"where {column} is not null and {entity}_id is not null"
        )
    return " union all ".join(parts)


_all_labels = list(V.ROUTE_LABELS) + list(V.CUSTOMER_LABELS)
_rule_rows = ", ".join(
    f"({quoted('route' if n in V.ROUTE_LABELS else 'customer')}, {quoted(n)})" for n in _all_labels
)
_pairs = ", ".join(f"({quoted(a)}, {quoted(b)})" for a, b in V.DISJOINT_PAIRS)
_both_labels = "(select * from route_labels union all select * from customer_labels)"
_top5 = "order by avg_margin_pct desc nulls last, entity_id limit 5"
_route_rows = ("select entity_id, entity_label, ontology_label, recommendation, metric_2 as avg_margin_pct "
               "from decision_layer where decision_entity_type = 'route'")
_owl_customers = (f"select entity_id as customer_id, label as owl_label, avg_sentiment_score as sentiment_score, "
                  f"total_miles, days_since_last_flight, {_is} "
                  "from customer_labels join customer_metrics on customer_id = entity_id")

FINAL = {
    **{name: f"select * from {name}" for name in STAGING},
    "win_competitor": "select market_id, route_id, nb_competitors_on_route, total_competitor_frequency, "
                      "avg_competitor_fare_on_route, min_competitor_fare_on_route, "
                      "max_competitor_fare_on_route from stg_competitor_context",
    "win_loyalty": "select activity_id, customer_id, customer_total_miles, customer_total_value_usd, "
                   "customer_activity_count, customer_flight_miles_total from stg_loyalty_activity",
    **{name: f"select * from {name}" for name in MARTS},
    **{name: f"select * from {name}" for name in ("route_performance", "route_sentiment",
                                                  "customer_performance", "decision_layer")},
    "agg_competitors_per_route": f"""
select route_id, count(*) as nb_competitors, {rnd(mean("competitor_average_fare_usd"), 2)} as avg_competitor_fare_usd,
  min(competitor_average_fare_usd) as min_competitor_fare_usd, max(competitor_average_fare_usd) as max_competitor_fare_usd,
  cast(sum(competitor_frequency_weekly) as bigint) as total_competitor_frequency,
  max(competitor_frequency_weekly) as max_competitor_strength from stg_competitor_context group by all""",
    "agg_loyalty_per_customer": f"""
select customer_id, cast(sum(miles_amount) as bigint) as total_miles, {total("estimated_value_usd")} as total_loyalty_value_usd,
  count(*) as total_loyalty_transactions,
  coalesce(cast(sum(miles_amount) filter (where is_flight_earn) as bigint), 0) as flight_miles_earned,
  coalesce(cast(sum(miles_amount) filter (where is_purchased_miles) as bigint), 0) as purchased_miles,
  coalesce(cast(sum(miles_amount) filter (where is_bonus_miles) as bigint), 0) as bonus_miles
from stg_loyalty_activity group by all""",
    "agg_tickets_per_customer": f"""
select customer_id, count(*) as total_tickets, {rnd(mean("sentiment_score"), 3)} as avg_sentiment_score,
  {n_if("is_resolved")} as resolved_tickets, {n_if("urgency_level = 'critical'")} as critical_tickets,
  {n_if("is_sla_breached")} as sla_breached_tickets from stg_customer_service_tickets group by all""",
    "agg_cargo_per_flight": f"""
select flight_id, count(*) as nb_cargo_shipments, {total("weight_kg")} as total_cargo_weight_kg,
  {total("cargo_revenue_usd")} as total_cargo_revenue_usd,
  {rnd(mean("space_utilization_pct"), 2)} as avg_cargo_utilization_pct,
  {n_if("is_sensitive_cargo")} as nb_sensitive_shipments from stg_cargo_operations group by all""",
    "agg_bookings_per_flight": f"""
select flight_id, count(*) as nb_bookings, count(distinct customer_id) as nb_unique_passengers,
  {total("ticket_price_usd")} as total_ticket_revenue_usd, {total("ancillary_revenue_usd")} as total_ancillary_revenue_usd,
  {total("total_revenue_usd")} as total_revenue_usd, cast(sum(bags_count) as bigint) as total_bags,
  {n_if("is_cancelled")} as nb_cancelled_bookings, {n_if("is_flown")} as nb_flown_bookings,
  {n_if("has_seat_selection")} as nb_seat_selections from stg_bookings group by all""",
    "agg_ancillary_per_booking": f"""
select booking_id, count(*) as nb_ancillary_items, {total("item_revenue_usd")} as total_ancillary_detail_usd,
  {", ".join(total(f"case when item_category_normalized = '{k}' then item_revenue_usd else 0 end") + f" as {k}_revenue_usd"
             for k in ("baggage", "seat", "meal"))},
  {n_if("is_premium_seat")} as nb_premium_seats, {n_if("is_digital_purchase")} as nb_digital_purchases
from stg_ancillary_details group by all""",
    "agg_booking_history": f"""
select customer_id, count(*) as total_past_bookings, {total("total_revenue_usd")} as total_past_revenue_usd,
  min(booking_date) as first_booking_date, max(booking_date) as last_booking_date
from stg_bookings where booking_status <> 'cancelled' group by all""",
    "route_flags": f"select route_id, {_FLAGS}, recommendation from route_decisions",
    "route_labels": "select route_id, ontology_label from route_decisions",
    "customer_flags": f"select customer_id, {_FLAGS}, recommendation from customer_decisions",
    "customer_labels": "select customer_id, ontology_label from customer_decisions",
    **{f"kpi_{name}": _kpi(name, KPI_GRAIN[m.model]) for name, m in KPIS.items()},
    "kpi_overview": _overview(),
    "kpi_grains": _grains(),
    "q_get_global_kpis": f"""
select {rnd(total("total_revenue_usd"), 2)} as total_revenue, {rnd(mean("load_factor_pct"), 2)} as avg_load_factor,
  {rnd(mean("flight_margin_pct"), 2)} as avg_margin, count(flight_id) as nb_flights from fct_flights""",
    "q_get_route_performance": "select * from route_performance",
    "q_get_routes_budget_recommendation": _route_rows,
    "q_top_routes_for_budget": f"select * from ({_route_rows}) {_top5}",
    "q_get_complaints_by_route": f"""
select route_id, primary_complaint_category, count(*) as nb_tickets,
  {rnd(mean("sentiment_score"), 3)} as avg_sentiment from fct_tickets group by all""",
    "q_top_complaints": f"""
select primary_complaint_category, count(*) as nb, {rnd(mean("sentiment_score"), 3)} as sentiment
from fct_tickets group by all order by nb desc, primary_complaint_category limit 5""",
    "q_compare_routes": f"""
select f.route_id, route_key, {rnd(mean("load_factor_pct"), 2)} as load_factor,
  {rnd(mean("flight_margin_pct"), 2)} as margin_pct, {rnd(mean("delay_minutes"), 1)} as avg_delay,
  coalesce(nb_tickets, 0) as nb_tickets, avg_sentiment_score,
  coalesce(nb_critical_tickets, 0) as nb_critical_tickets
from fct_flights f left join dim_routes r on r.route_id = f.route_id
  left join route_sentiment s on s.route_id = f.route_id group by all""",
    "q_get_high_value_at_risk_customers": f"""
select entity_id, entity_label, ontology_label, metric_4 as sentiment, recommendation from decision_layer
where decision_entity_type = 'customer' and ontology_label = {quoted(V.CUSTOMER_LABELS["HighValueAtRisk"])}""",
    "q_get_upsell_segments": f"""
select ontology_label, customer_segment, count(*) as nb_customers,
  {rnd(mean("total_revenue_usd"), 2)} as avg_revenue_usd,
  {rnd(mean("ancillary_attach_rate_pct"), 2)} as avg_attach_rate_pct,
  {rnd(mean("total_miles"), 2)} as avg_miles from customer_decisions
where contains(ontology_label, 'PremiumUpgradeCandidate') or contains(ontology_label, 'AncillaryOfferTarget')
group by all""",
    "q_get_unstructured_insights": f"""
select primary_complaint_category, count(*) as nb_tickets, {rnd(mean("sentiment_score"), 3)} as avg_sentiment,
  {", ".join(f"{n_if(f'urgency_level = {quoted(u)}')} as nb_{u}" for u in ("critical", "high", "medium", "low"))},
  {n_if("is_high_value_critical_ticket")} as nb_high_value_critical from fct_tickets group by all""",
    "q_get_owl_route_classification": f"""
select entity_id as route_id, route_key, label as owl_label, avg_load_factor_pct as load_factor_pct,
  avg_margin_pct as margin_pct, {_is} from route_labels join route_metrics on route_id = entity_id""",
    "q_get_owl_customer_classification": _owl_customers,
    "q_owl_customers_first_50": f"select * from ({_owl_customers}) order by customer_id, owl_label limit 50",
    "q_owl_cross_query": """
select *, 'Ces routes sous-performantes affectent probablement la satisfaction des clients à risque.' as insight,
  'OWL cross-domain inference' as source from (
select 'underperforming_routes' as section, entity_id, route_key, null::double as sentiment,
  null::bigint as days_inactive from route_labels join route_metrics on route_id = entity_id
where label = 'StrategicUnderperformer'
union all select * from (
  select 'high_value_at_risk_customers', entity_id, null, avg_sentiment_score, days_since_last_flight
  from customer_labels join customer_metrics on customer_id = entity_id where label = 'HighValueAtRisk'
  order by avg_sentiment_score, entity_id limit 10))""",
    "graph_route_metrics": "select * from route_metrics",
    "graph_customer_metrics": "select * from customer_metrics",
    "triples_routes": "select * from route_triples",
    "triples_customers": "select * from customer_triples",
    "triples_competitors": "select * from competitor_triples",
    "graph_route_labels": "select entity_id, label from route_labels",
    "graph_customer_labels": "select entity_id, label from customer_labels",
    "graph_rule_counts": f"""
select r.entity_type, r.label, count(l.entity_id) as matches from (values {_rule_rows}) r(entity_type, label)
left join {_both_labels} l on l.label = r.label group by all""",
    "graph_disjoint_violations": f"""
select a.entity_id, a.label as class_1, b.label as class_2 from {_both_labels} a join {_both_labels} b
  on a.entity_id = b.entity_id and (a.label, b.label) in ({_pairs})""",
    "graph_explain": f"{_explained('route')} union all {_explained('customer')}",
    "graph_explain_trace": f"{_traced('route')} union all {_traced('customer')}",
    "graph_same_as": f"""
select * from customer_triples union
select '{NS}' || 'ext-' || substr(s, {len(NS) + 1}) as s, p, o, dtype, is_iri from customer_triples""",
    "graph_same_as_closure": " union ".join(
        ["select * from customer_triples"]
        + [
            f"select '{NS}{prefix}' || substr(s, {len(NS) + 1}) as s, p, o, dtype, is_iri from customer_triples"
            for prefix in ("ext-", "ext2-")
        ]
    ),
    "graph_triples": f"select * from ({_schema()}) union select * from route_triples union select * from customer_triples",
    "graph_members": f"""
select class, count(distinct s) as members from (
  select 'Route' as class, s from route_triples union all select 'Route', s from competitor_triples where p = '{NS}hasCompetitor'
  union all select 'Route', '{NS}' || entity_id from route_labels union all select label, '{NS}' || entity_id from route_labels
  union all select 'Airport', o from route_triples where p in ('{NS}hasOrigin', '{NS}hasDestination')
  union all select 'Airline', o from competitor_triples where p = '{NS}hasCompetitor'
) where s not in (select o from route_triples where p in ('{NS}hasOrigin', '{NS}hasDestination')) or class = 'Airport'
group by class""",
    "graph_by_predicate": """
select route_id, cast(cast(avg_load_factor_pct as decimal(38,6)) as double) as "hasLoadFactorPct",
  cast(nb_competitors as bigint) as "hasNbCompetitors" from route_metrics where route_id is not null""",
    "graph_about_one": f"select * from customer_triples where s = '{NS}C3'",
    "graph_explain_metrics": " union all ".join(_metric_rows(e) for e in ("route", "customer")),
    "graph_explain_labels": f"""
select case when label in ({_route_names}) then 'route' else 'customer' end as entity_type, entity_id, label,
  {_rules} as source from {_both_labels}""",
    "graph_explain_one": f"""
select entity_id, 'customer' as entity_type, label, {_rules} as source from customer_labels where entity_id = 'C3'""",
    "q_one_route_performance": "select * from route_performance where route_id = 'R00002'",
    "q_one_route_complaints": f"""
select route_id, primary_complaint_category, count(*) as nb_tickets,
  {rnd(mean("sentiment_score"), 3)} as avg_sentiment from fct_tickets where route_id = 'R00002' group by all""",
    "q_compare_two_routes": f"""
select f.route_id, route_key, {rnd(mean("load_factor_pct"), 2)} as load_factor,
  {rnd(mean("flight_margin_pct"), 2)} as margin_pct, {rnd(mean("delay_minutes"), 1)} as avg_delay,
  coalesce(nb_tickets, 0) as nb_tickets, avg_sentiment_score,
  coalesce(nb_critical_tickets, 0) as nb_critical_tickets
from fct_flights f left join dim_routes r on r.route_id = f.route_id
  left join route_sentiment s on s.route_id = f.route_id where f.route_id in ('R00001', 'R00002') group by all""",
    "q_one_category_insights": f"""
select primary_complaint_category, count(*) as nb_tickets, {rnd(mean("sentiment_score"), 3)} as avg_sentiment,
  {", ".join(f"{n_if(f'urgency_level = {quoted(u)}')} as nb_{u}" for u in ("critical", "high", "medium", "low"))},
  {n_if("is_high_value_critical_ticket")} as nb_high_value_critical from fct_tickets
where primary_complaint_category = 'bagage' group by all""",
    "q_owl_customers_of_label": f"select * from ({_owl_customers}) where owl_label = 'ReactivationTarget'",
    "q_top_high_value_at_risk": f"""
select entity_id, entity_label, ontology_label, metric_4 as sentiment, recommendation from decision_layer
where decision_entity_type = 'customer' and ontology_label = {quoted(V.CUSTOMER_LABELS["HighValueAtRisk"])}
order by sentiment nulls last, entity_id limit 3""",
    "kpi_load_factor_of_delayed": _kpi("load_factor", "route_id").replace(" group by", " where is_delayed group by"),
    "sheet_bookings_parquet": "select * from stg_bookings",
    "sheet_bookings_csv": "select * from stg_bookings",
    "sheet_flights_json": "select * from stg_flights",
    "table_dim_routes": "select * from dim_routes",
    "table_bucketed_customer_metrics": "select * from customer_metrics",
    "view_stg_routes": "select route_id, route_type, distance_km from stg_routes",
    "sink_json_rows": """
select cast(to_json({'route_id': route_id, 'route_type': route_type, 'distance_km': distance_km}) as varchar) as json
from stg_routes""",
    "ntriples_read_back": "select * from route_triples",
    "sink_ntriples": """
select concat('<', s, '> <', p, '> ', case when is_iri then concat('<', o, '>')
  else concat('"', o, '"^^<', dtype, '>') end, ' .') as line from route_triples""",
    "graph_customer_metrics_fanout_safe": f"""
select c.customer_id, c.is_high_value, c.is_at_risk, c.avg_sentiment_score, c.total_miles, c.is_loyalty_member,
  coalesce(c.customer_segment, 'standard') as customer_segment, coalesce(b.n, 0) as total_bookings,
  coalesce(b.usd, 0) as total_revenue, coalesce(b.rate, 0) as ancillary_attach_rate,
  coalesce(b.idle, 999) as days_since_last_flight, coalesce(t.critical, 0) as critical_tickets
from dim_customers c
left join (select customer_id, count(booking_id) as n, {total("total_revenue_usd")} as usd,
    {share(n_if("has_ancillary_purchase"), "count(booking_id)")} as rate,
    max(days_since_last_booking) as idle from fct_bookings group by all) b using (customer_id)
left join (select customer_id, {n_if("urgency_level = 'critical'")} as critical
  from fct_tickets group by all) t using (customer_id)""",
}


def all_statements() -> dict[str, str]:
    return {name: statement(sql) for name, sql in FINAL.items()}
