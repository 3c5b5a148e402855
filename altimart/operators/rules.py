"""Rules as data, compiled to Column expressions.

A rule is a conjunction of clauses, a clause a disjunction of tests, a test a
comparison of a metric with a constant or with another metric.  The same rule
objects give boolean flags, first-match labels, multi-label classification and
the trace that explains a label.
"""

from __future__ import annotations

import operator
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from altimart.functions.clean import flag
from altimart.functions.tagging import first_true

_COMPARE = {
    ">=": operator.ge,
    ">": operator.gt,
    "<=": operator.le,
    "<": operator.lt,
    "=": operator.eq,
}


@dataclass(frozen=True)
class Metric:
    """Name of a metric used as the right side of a test."""

    name: str


@dataclass(frozen=True)
class Test:
    metric: str
    op: str
    against: object

    __test__ = False  # not a pytest class

    def holds(self) -> Column:
        against = self.against
        right = F.col(against.name) if isinstance(against, Metric) else F.lit(against)
        return _COMPARE[self.op](F.col(self.metric), right)


@dataclass(frozen=True)
class Rule:
    name: str
    clauses: tuple[tuple[Test, ...], ...]

    def tests(self) -> list[Test]:
        return [t for clause in self.clauses for t in clause]

    def holds(self, need_all: bool = False) -> Column:
        """Never NULL.  ``need_all`` also asks that no metric of the rule is NULL."""
        clauses = [reduce(operator.or_, [t.holds() for t in c]) for c in self.clauses]
        if need_all:
            names = dict.fromkeys(t.metric for t in self.tests())
            clauses += [F.col(name).isNotNull() for name in names]
        return flag(reduce(operator.and_, clauses))


def rule(name: str, *clauses: str) -> Rule:
    """``rule("Name", "a >= 80", "b < 10 | c > 30")``: every clause, any test of a clause."""
    return Rule(name, tuple(tuple(_test(t) for t in c.split("|")) for c in clauses))


def _test(text: str) -> Test:
    metric, op, against = text.split()
    return Test(metric, op, _operand(against))


def _operand(text: str):
    if text in ("true", "false"):
        return text == "true"
    if text.startswith("'"):
        return text.strip("'")
    try:
        return int(text) if text.lstrip("-").isdigit() else float(text)
    except ValueError:
        return Metric(text)


def flags(rules: Sequence[Rule], names: Sequence[str]) -> list[Column]:
    """One never-NULL boolean per rule; several may be true."""
    return [r.holds().alias(name) for r, name in zip(rules, names, strict=True)]


def first_label(rules: Sequence[Rule], labels: Mapping[str, str], default: str) -> Column:
    """Label of the first rule that holds."""
    return first_true([(r.holds(), labels[r.name]) for r in rules], labels[default])


def advice(flag_names: Mapping[str, str], texts: Mapping[str, str], default: str) -> Column:
    """Text of the first flag column that is true; ``flag_names`` maps rule to flag column."""
    return first_true([(F.col(f), texts[rule]) for rule, f in flag_names.items()], texts[default])


def all_labels(
    rules: Sequence[Rule], default: str, settled: Column | None = None, need_all: bool = False
) -> Column:
    """Names of every rule that holds, an array with at most one entry per rule.

    The default stands alone where no rule holds; where ``settled`` is true the
    row has a label from elsewhere and gets no default.
    """
    found = F.array_compact(
        F.array(*[F.when(r.holds(need_all), F.lit(r.name)) for r in rules])
    )
    lacking = F.size(found) == 0
    if settled is not None:
        lacking = lacking & ~settled
    return F.when(lacking, F.array(F.lit(default))).otherwise(found)


def trace(r: Rule) -> Column:
    """Every test of a rule with the value it saw: array<metric, value, op, threshold, ok>."""

    def shown(t: Test) -> Column:
        against = t.against
        if isinstance(against, Metric):
            return F.col(against.name).cast("string")
        return F.lit(str(against).lower() if isinstance(against, bool) else str(against))

    return F.array(
        *[
            F.struct(
                F.lit(t.metric).alias("metric"),
                F.col(t.metric).cast("string").alias("value"),
                F.lit(t.op).alias("op"),
                shown(t).alias("threshold"),
                flag(t.holds()).alias("ok"),
            )
            for t in r.tests()
        ]
    )
