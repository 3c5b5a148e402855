"""Left joins and per-group totals that survive hot keys, by Spark's adaptive skew join.

A shuffle join sends every row of a key to one task.  Adaptive execution looks at the sizes of the
shuffled partitions before it joins them and splits one that is far above the median by the tasks that
wrote it; the matching part of the other side is read once per split.  Rows without a key are split like
any other.  No key is counted beforehand and composing a join runs nothing.

It can only do so where both sides of the join come straight from a shuffle of its own.  A side that is
already partitioned by the key, such as totals per key, does not.  ``lookup_join`` therefore joins on
the key and a bit of its hash: a partitioning by the key alone does not do for that, so both sides are
shuffled.  A bit is enough and, unlike a whole hash, costs next to nothing in a compressed shuffle.
The looked-up side has one row per key, or few, which makes that cheap; a small one is broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: What the joins of this library count on.  The sizes are Spark's own defaults, stated here because
#: they decide when a key is hot: a partition is split from 256 MB and five times the median on, into
#: parts of the advisory size.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256MB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5.0",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64MB",
    # split even where a later step on the same key then has to shuffle again
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

_TAG = "__key_hash"


def prepare(spark: SparkSession) -> SparkSession:
    """Sets ``SETTINGS`` where the session has none of its own."""
    for name, value in SETTINGS.items():
        if not spark.conf.isModifiable(name):
            raise ValueError(f"{name} cannot be set here")
        if name not in _own(spark):
            spark.conf.set(name, value)
    return spark


def _own(spark: SparkSession) -> set[str]:
    return {name for name in SETTINGS if spark.sparkContext.getConf().contains(name)}


def lookup_join(left: DataFrame, right: DataFrame | Sequence[DataFrame], keys: str | Sequence[str]) -> DataFrame:
    """``left`` left-joined with one or several right sides on equally named columns."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    tag = F.pmod(F.xxhash64(*keys), F.lit(2)).cast("byte")
    out = left.withColumn(_TAG, tag)
    for side in [right] if isinstance(right, DataFrame) else right:
        out = out.join(side.withColumn(_TAG, tag), [*keys, _TAG], "left")
    return out.drop(_TAG)


def with_group_totals(df: DataFrame, key: str, totals: dict[str, Column]) -> DataFrame:
    """Each row with aggregates over all rows of its key (a window without order).

    A window would sort each whole group in one task, which nothing can split.  Here the group is
    reduced map-side first and the one-row-per-key result is joined back, where a hot key is split.
    Rows with a NULL key belong to no group: callers drop them first.
    """
    per_key = df.groupBy(key).agg(*[c.alias(name) for name, c in totals.items()])
    return lookup_join(df, per_key, key)
