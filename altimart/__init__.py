"""Airline analytics as Spark DataFrame jobs: staging, star schema, KPIs, rules, triples."""

from altimart.plans.build import Marts

__all__ = ["Marts"]
