"""Bounded training samples and models fitted inside one task."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sampled(rows: DataFrame, id_column: str, at_most: int) -> DataFrame:
    """At most ``at_most`` different rows of ids and labels, in the order of a hash of the id."""
    return rows.distinct().orderBy(F.xxhash64(id_column, F.lit(17)), *rows.columns).limit(at_most)


def with_texts(docs: DataFrame, sample: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """The sample with its whole texts; its ids, bounded by the sample size, are broadcast.

    An id on many rows gives one text, that of the smallest digest, so there are no more rows than
    in the sample.
    """
    texts = docs.select(id_column, F.col(text_column).alias("__text"))
    digest = F.coalesce(F.sha2(F.col("__text").cast("binary"), 256), F.lit(""))
    found = texts.join(F.broadcast(sample), id_column).groupBy(*sample.columns)
    return found.agg(F.min(F.struct(digest.alias("digest"), "__text"))["__text"].alias("__text"))


def fit_in_task(sample: DataFrame, fit: Callable[[pa.Table], object]) -> object:
    """What ``fit`` makes of a bounded sample, sorted by all narrow columns, in one task."""
    schema = sample.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)
        if held:
            model = fit(pa.Table.from_batches(held).combine_chunks())
            yield pa.RecordBatch.from_arrays([pa.array([cloudpickle.dumps(model)], pa.binary())], ["model"])

    order = [f.name for f in schema.fields if f.name != "__text"]
    one = sample.repartition(1).sortWithinPartitions(*order, "__text")
    found = one.mapInArrow(run, "model binary").collect()  # one row at most
    return cloudpickle.loads(found[0]["model"]) if found else None


def fold_of(id_column: str, folds: int) -> Column:
    return F.pmod(F.xxhash64(id_column, F.lit(23)), F.lit(folds)).cast("int")
