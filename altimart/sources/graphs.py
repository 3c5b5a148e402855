"""Graphs as tables: by predicate for star patterns, by subject for single entities."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from altimart.operators.triples import COLUMNS
from altimart.sources.sinks import write_model


def write_by_predicate(graph: DataFrame, path: str) -> DataFrame:
    """The graph in one folder a predicate; patterns that name predicates read only those folders.

    Rows are dealt by predicate and subject first, so a folder gets files of even size and a subject's
    rows of one predicate are close together.  As many folders as the schema has predicates.
    """
    write_model(graph.select(*COLUMNS), path, partition_by=("p",), files_by=("p", "s"))
    return read_by_predicate(graph.sparkSession, path)


def read_by_predicate(spark: SparkSession, path: str) -> DataFrame:
    schema = "s string, o string, dtype string, is_iri boolean, p string"
    return spark.read.schema(schema).parquet(path).select(*COLUMNS)


@dataclass(frozen=True)
class SubjectIndex:
    """A graph in ranges of subjects, a folder each, and the table of their first and last subjects."""

    graph: DataFrame
    ranges: DataFrame

    def about(self, subject: str) -> DataFrame:
        """All facts on one subject, from the folders whose range holds it.

        Ranges do not overlap, so that is one folder, or none; their numbers come to the driver.
        Inside, row groups are passed over by the bloom filter and the order of the subjects.
        """
        holds = (F.col("first") <= subject) & (F.col("last") >= subject)
        folders = [r["range"] for r in self.ranges.where(holds).select("range").collect()]
        return self.graph.where(F.col("range").isin(*folders) & (F.col("s") == subject)).select(*COLUMNS)


def write_subject_index(graph: DataFrame, path: str, ranges: int | None = None) -> SubjectIndex:
    """The graph range-partitioned and sorted by subject, with Parquet bloom filters on it.

    ``ranges`` is how many folders; by default as many as there are shuffle partitions.
    """
    spark = graph.sparkSession
    wanted = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = graph.select(*COLUMNS).repartitionByRange(wanted, "s").withColumn("range", F.spark_partition_id())
    sorted_ = dealt.sortWithinPartitions("range", "s", "p")
    options = {
        "parquet.bloom.filter.enabled#s": "true",
        "parquet.bloom.filter.adaptive.enabled#s": "true",
        "parquet.block.size": str(16 << 20),
    }
    write_model(sorted_, f"{path}/facts", partition_by=("range",), options=options)
    facts = _facts(spark, path)
    bounds = facts.groupBy("range").agg(F.min("s").alias("first"), F.max("s").alias("last"))
    write_model(bounds, f"{path}/ranges")
    return read_subject_index(spark, path)


def _facts(spark: SparkSession, path: str) -> DataFrame:
    schema = "s string, p string, o string, dtype string, is_iri boolean, range int"
    return spark.read.schema(schema).parquet(f"{path}/facts")


def read_subject_index(spark: SparkSession, path: str) -> SubjectIndex:
    ranges = spark.read.schema("range int, first string, last string").parquet(f"{path}/ranges")
    return SubjectIndex(_facts(spark, path), ranges)
