"""Free text and numbers to categories, compiled from plain lists to CASE expressions."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column
from pyspark.sql import functions as F


def has_any(text: Column, words: Sequence[str]) -> Column:
    """Text (already lower-case) holds one of the words; NULL text gives NULL."""
    return reduce(or_, [F.contains(text, F.lit(w)) for w in words])


def has_all(text: Column, words: Sequence[str]) -> Column:
    return reduce(and_, [F.contains(text, F.lit(w)) for w in words])


def first_true(cases: Iterable[tuple[Column, object]], default: object) -> Column:
    """Value of the first case whose condition holds."""
    chain = None
    for condition, value in cases:
        value = value if isinstance(value, Column) else F.lit(value)
        chain = F.when(condition, value) if chain is None else chain.when(condition, value)
    default = default if isinstance(default, Column) else F.lit(default)
    return default if chain is None else chain.otherwise(default)


def keyword_category(
    text: Column, table: Iterable[tuple[str, Sequence[str]]], default: str = "other"
) -> Column:
    return first_true([(has_any(text, words), name) for name, words in table], default)


def band_from(c: Column, lower_bounds: Iterable[tuple[float, str]], default: str) -> Column:
    """Name of the first bound the value reaches (>=); bounds run downwards."""
    return first_true([(c >= F.lit(b), name) for b, name in lower_bounds], default)


def band_below(c: Column, upper_bounds: Iterable[tuple[float, str]], default: str) -> Column:
    """Name of the first bound the value stays under (<); bounds run upwards."""
    return first_true([(c < F.lit(b), name) for b, name in upper_bounds], default)


def mapped(c: Column, table: Mapping[object, object], default: object) -> Column:
    return first_true([(c == F.lit(k), v) for k, v in table.items()], default)
