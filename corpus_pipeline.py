"""A corpus pipeline: five stages, each an operator of ``altimart.llm``.

A stage takes (spark, docs, sf_dir) and returns a DataFrame.  It works on all rows its predecessor
kept; ``run`` and whoever else applies STAGES write its result as Parquet and read it as the next
stage's docs.  All but the last return the columns of ``documents``.  Copies and contaminated texts are
told apart row by row, by a digest of the row, so rows without an id or with a repeated one are judged
like others.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from altimart.llm import bpe, decontaminate, exact_dedup, langid, ngram_join
from altimart.llm.common import cut, let_go, table
from altimart.sources.sinks import scratch

#: A document whose language is surer than this stays.
SURE = 0.5
#: The column of a row's digest.
ROW = "__row"


def unused(name: str, columns: list[str]) -> str:
    """The name, with underscores in front until no column has it."""
    while name in columns:
        name = f"_{name}"
    return name


def digest(columns: list[str]) -> Column:
    """SHA-256 of a whole row: rows share it only if they are equal in every column."""
    parts = []
    for name in columns:
        value = F.col(f"`{name}`").cast("string").cast("binary")
        size = F.concat(F.octet_length(value).cast("string"), F.lit(":")).cast("binary")
        parts.append(F.coalesce(F.concat(size, value), F.lit("-").cast("binary")))
    return F.unhex(F.sha2(F.concat(*parts), 256))


def only(docs: DataFrame, contents: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose digest is ``kept``, one of each set of equal rows.

    ``contents`` has one row (ROW, n, kept) per digest; n counts the rows that have it.  Equal rows
    are combined before they are shuffled.
    """
    row = unused(ROW, docs.columns)
    rows, contents = docs.withColumn(row, digest(docs.columns)), contents.withColumnRenamed(ROW, row)
    single = rows.join(contents.where("not kept or n > 1").select(row), row, "left_anti")
    several = rows.join(contents.where("kept and n > 1").select(row), row, "left_semi")
    return single.select(*docs.columns).unionByName(several.select(*docs.columns).distinct())


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts without a letter and those in which no language has half of the score."""
    model = langid.train(docs, F.lit(True))
    names = {"lang_name": unused("lang_pred", docs.columns), "score_name": unused("score", docs.columns)}
    found = langid.identify(docs, model, **names)
    kept = found.where((F.col(names["lang_name"]) != langid.UNKNOWN) & (F.col(names["score_name"]) >= SURE))
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the longest original of texts equal but for white space, then the smallest id."""
    # of rows with that id and length any, but the same one on every run
    rows = docs.select("doc_id", "text", F.length("text").alias("length"), digest(docs.columns).alias(ROW))
    found = exact_dedup.exact_duplicates(rows, carried=["length", ROW])
    wins = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    rank = F.when(wins, F.struct(F.coalesce("length", F.lit(0)).alias("length"), ROW)).alias("rank")
    contents = cut(found.groupBy("text_sha256", rank, ROW).agg(F.count(F.lit(1)).alias("n")))
    let_go(spark)
    best = contents.groupBy("text_sha256").agg(F.max("rank")[ROW].alias(ROW)).select(ROW, F.lit(True).alias("kept"))
    return only(docs, contents.join(best, ROW, "left").select(ROW, "n", F.coalesce("kept", F.lit(False)).alias("kept")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest id of each component at a Jaccard similarity of 0.8 of five-word shingles.

    A row without an id stays only where no row of its component has one.
    """
    rows = docs.select("doc_id", "text", digest(docs.columns).alias(ROW))
    found = ngram_join.alike(rows, width=5, percent=80, carried=ROW)
    rank = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", ROW).alias("rank")
    contents = cut(found.groupBy("component", rank, ROW).agg(F.count(F.lit(1)).alias("n")))
    let_go(spark)
    best = contents.where("component is not null").groupBy("component").agg(F.min("rank")[ROW].alias(ROW))
    judged = contents.join(best.select(ROW, F.lit(True).alias("best")), ROW, "left")
    # texts without words are alike to none, so all of them stay
    n = F.when(F.col("component").isNull(), 1).otherwise(F.col("n")).alias("n")
    kept = (F.col("component").isNull() | F.col("best").isNotNull()).alias("kept")
    return only(docs, judged.select(ROW, n, kept))


def decontaminate_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold at least 80 % of the five-word shingles of a benchmark item."""
    row = unused(ROW, docs.columns)
    rows = docs.withColumn(row, digest(docs.columns))
    found = decontaminate.contained_items(rows.select(row, "text"), table(spark, sf_dir, "benchmark"), id_column=row)
    return rows.join(found.select(row).distinct(), row, "left_anti").select(*docs.columns)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text, and whether their bytes are the text's again."""
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    text = F.coalesce("text", F.lit("")).cast("binary")
    done = bpe.round_trip(docs.select("doc_id", "lang", "source", "text"), ranks, public_tokenizers.PATTERN)
    return done.select(
        "doc_id", "lang", "source", "ids",
        F.size("ids").cast("long").alias("n_tokens"),
        (F.col("decoded") == text).alias("round_trip"),
    )


STAGES = [
    ("language", identify_language),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("decontamination", decontaminate_benchmark),
    ("encoding", encode_tokens),
]

#: SQL cannot express the first stage's learnt model nor the last stage's merges.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STAGES applied to the documents in turn, each written to the shared folder and read again.

    The folder is the application's own and goes when its driver ends.
    """
    docs = table(spark, sf_dir, "documents")
    folder = scratch(spark, "pipeline")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
