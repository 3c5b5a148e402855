"""Named metrics over models, evaluated at any grain.

A metric names its model and an aggregate; ``evaluate`` groups by the wanted
dimensions, after an optional filter.  Metrics of one model are computed in one
pass.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from altimart.functions.exact import count_if, exact_mean, exact_sum


@dataclass(frozen=True)
class MetricDef:
    name: str
    model: str
    kind: str  # "mean", "sum", or "share" of rows where the measure is true
    measure: str

    def aggregate(self) -> Column:
        c = F.col(self.measure)
        if self.kind == "mean":
            return exact_mean(c)
        if self.kind == "sum":
            return exact_sum(c)
        if self.kind == "share":
            return F.try_divide(count_if(c).cast("double"), F.count(F.lit(1)))
        raise ValueError(f"unknown metric kind {self.kind!r}")


def evaluate_grains(
    models: Mapping[str, DataFrame],
    metrics: Sequence[MetricDef],
    grains: Sequence[Sequence[str]],
    where: Column | None = None,
) -> DataFrame:
    """Metrics of one model at several grains, by grouping sets: the model is read once.

    One row per grain and combination of its dimensions.  ``grain`` names the dimensions of a row's
    grain, joined by ``+`` (empty: over everything); those of other grains are NULL in it.
    """
    if len({m.model for m in metrics}) != 1:
        raise ValueError("metrics evaluated together must share their model")
    df = models[metrics[0].model]
    if where is not None:
        df = df.where(where)
    names = sorted({name for grain in grains for name in grain})
    if not names:
        return evaluate(models, metrics, (), where).select(F.lit("").alias("grain"), *[m.name for m in metrics])
    sets = [[F.col(name) for name in grain] for grain in grains]
    grouped = df.groupingSets(sets, *names).agg(
        F.grouping_id(*names).alias("__left_out"), *[m.aggregate().alias(m.name) for m in metrics]
    )
    # a bit of the grouping id is set for each dimension that is not part of the grain
    last = len(names) - 1
    part = [F.when(F.col("__left_out").bitwiseAND(1 << (last - i)) == 0, F.lit(name)) for i, name in enumerate(names)]
    return grouped.select(F.concat_ws("+", *part).alias("grain"), *names, *[m.name for m in metrics])


def evaluate(
    models: Mapping[str, DataFrame],
    metrics: Sequence[MetricDef],
    by: Sequence[str] = (),
    where: Column | None = None,
) -> DataFrame:
    """Metrics of one model, one row per combination of ``by`` (one row in all without it)."""
    if len({m.model for m in metrics}) != 1:
        raise ValueError("metrics evaluated together must share their model")
    df = models[metrics[0].model]
    if where is not None:
        df = df.where(where)
    return df.groupBy(*by).agg(*[m.aggregate().alias(m.name) for m in metrics])
