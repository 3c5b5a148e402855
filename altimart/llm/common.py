"""What several operators of this package share: checkpoints, even joins on hot keys, folds."""

from __future__ import annotations

import gc
import tempfile

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A key with more than this share of all rows is spread; fewer keys than this can have it.
SHARES = 2048


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share, named by the cluster in ``spark.checkpoint.dir``.

    Only a local session without that setting, as in tests, gets a temporary folder: its executors
    are this process.
    """
    named = spark.conf.get("spark.checkpoint.dir", "")
    if named:
        return named
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="altimart-llm-"))
    return context.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """The same rows from a checkpoint in the shared folder.

    Spark computes a frame once to look at it and again to write its checkpoint.  It is held on the
    executors' disks in between, so the second time reads what the first one made; should an executor
    be lost, that part is computed again.  The checkpoint then knows its real size, where it would
    otherwise have the product of the sizes of all that was ever joined into it.
    """
    folder, context = shared_folder(df.sparkSession), df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    held = df.persist(StorageLevel.DISK_ONLY)
    try:
        return held.select("*").checkpoint(eager=True)
    finally:
        held.unpersist()


def let_go(spark: SparkSession) -> None:
    """Shuffle files of frames that nothing refers to any more go now.

    Spark removes them once the driver's JVM has collected such frames, which on a driver with memory
    to spare is long after, while they take disk on every executor.
    """
    gc.collect()
    spark._jvm.System.gc()


def total_of(df: DataFrame, value: Column) -> int:
    """One number over all rows; 0 for an empty table."""
    return df.agg(F.coalesce(value, F.lit(0)).alias("total")).first()["total"]


def remainder(id_column: str, modulus: int) -> Column:
    """crc32 of the id's decimal text, modulo; a NULL id counts as the empty text."""
    text = F.coalesce(F.col(id_column).cast("string"), F.lit(""))
    return (F.crc32(text.cast("binary")) % modulus).cast("int")


def spread_join(
    left: DataFrame, right: DataFrame, keys: list[str], dice: Column, how: str = "left"
) -> DataFrame:
    """``left`` joined with ``right``, which has one row (or few) per key.

    Keys with more than 1/2048 of the left rows, fewer than 2048 whatever the data, are found by a
    count that is combined before it is shuffled.  Their left rows are dealt over salts by ``dice``
    and their right rows repeated once per salt, so no task gets more than a few such shares.  The
    list of those keys is the only broadcast and is bounded by the share.
    """
    total = left.agg(F.count(F.lit(1))).scalar()
    share = F.col("__n") * F.lit(SHARES)
    hot = F.broadcast(
        left.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("__n"))
        .where((share > total) & (F.col("__n") > 1))
        .select(*keys, F.ceil(share / total).cast("int").alias("__salts"))
    )
    salts = F.coalesce(F.col("__salts"), F.lit(1))
    dealt = left.join(hot, keys, "left").withColumn("__salt", F.pmod(F.xxhash64(dice), salts).cast("int"))
    repeated = right.join(hot, keys, "left").withColumn("__salt", F.explode(F.sequence(F.lit(0), salts - 1)))
    return dealt.drop("__salts").join(repeated.drop("__salts"), [*keys, "__salt"], how).drop("__salt")


def split_join(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """The inner join of two frames that may both have many rows of a key.

    It is on the keys and their hash, so that both sides are shuffled for it, whatever they are
    partitioned by; adaptive execution then splits a hot key, which it does for no other join.
    """
    tag = F.xxhash64(*keys)
    return left.withColumn("__tag", tag).join(right.withColumn("__tag", tag), [*keys, "__tag"]).drop("__tag")
