"""The thirteen KPIs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from altimart.operators.metrics import MetricDef, evaluate, evaluate_grains

# FIXED VALUES: name, model, kind, measure
KPIS = {
    m.name: m
    for m in (
        MetricDef("load_factor", "fct_flights", "mean", "load_factor_pct"),
        MetricDef("route_margin", "fct_flights", "sum", "flight_margin_usd"),
        MetricDef("route_margin_pct", "fct_flights", "mean", "flight_margin_pct"),
        MetricDef("yield", "fct_flights", "mean", "yield_usd_per_km"),
        MetricDef("delay_rate", "fct_flights", "share", "is_delayed"),
        MetricDef("cancellation_rate", "fct_flights", "share", "is_cancelled"),
        MetricDef("ancillary_attach_rate", "fct_bookings", "share", "has_ancillary_purchase"),
        MetricDef("repeat_booking_rate", "fct_bookings", "share", "is_repeat_customer"),
        MetricDef("customer_sentiment_score", "fct_tickets", "mean", "sentiment_score"),
        # two readings of lifetime value: revenue added up per customer, or the mean score
        MetricDef("clv_revenue", "fct_bookings", "sum", "total_revenue_usd"),
        MetricDef("clv_score", "dim_customers", "mean", "customer_value_score"),
        MetricDef("rask", "fct_flights", "mean", "rask"),
        MetricDef("cask", "fct_flights", "mean", "cask"),
        MetricDef("loyalty_engagement_score", "dim_customers", "mean", "total_miles"),
    )
}
ALIASES = {"customer_lifetime_value": "clv_score"}


def metric(
    models: Mapping[str, DataFrame],
    name: str,
    by: Sequence[str] = (),
    where: Column | None = None,
) -> DataFrame:
    """One KPI at the grain of ``by``."""
    return evaluate(models, [KPIS[ALIASES.get(name, name)]], by, where)


def overview(models: Mapping[str, DataFrame]) -> DataFrame:
    """Every KPI over everything, as (metric, value) rows: one pass per model."""
    by_model: dict[str, list[MetricDef]] = {}
    for m in KPIS.values():
        by_model.setdefault(m.model, []).append(m)
    parts = []
    for defs in by_model.values():
        pairs = [F.struct(F.lit(m.name).alias("metric"), F.col(m.name).alias("value")) for m in defs]
        parts.append(evaluate(models, defs).select(F.inline(F.array(*pairs))))
    return reduce(DataFrame.unionByName, parts)


def at_grains(models: Mapping[str, DataFrame], grains: Mapping[str, Sequence[Sequence[str]]]) -> DataFrame:
    """Every KPI of the named models at each of their grains: one aggregate per model.

    Rows (grain, member, metric, value); ``member`` is the text of a one-dimensional grain's value.
    """
    parts = []
    for model, wanted in grains.items():
        defs = [m for m in KPIS.values() if m.model == model]
        rows = evaluate_grains(models, defs, wanted)
        names = sorted({name for grain in wanted for name in grain})
        member = F.coalesce(*[F.col(n).cast("string") for n in names]) if names else F.lit(None).cast("string")
        pairs = [F.struct(F.lit(m.name).alias("metric"), F.col(m.name).cast("double").alias("value")) for m in defs]
        parts.append(rows.select("grain", member.alias("member"), F.inline(F.array(*pairs))))
    return reduce(DataFrame.unionByName, parts)
