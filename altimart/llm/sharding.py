"""Contiguous shards of nearly equal bytes, cut from one global prefix sum."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from altimart.llm.common import cut


def byte_shards(
    docs: DataFrame, shards: int = 16, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Id, size, text_crc32, shard and slot of every row, shards contiguous in id order.

    1. Ids, sizes and checksums (no texts) are range-partitioned by id and written to the
       checkpoint folder, which fixes the partition of every row.
    2. Each partition adds up its bytes; a running sum over these totals, one row per partition,
       gives the bytes before each partition.
    3. Inside a partition a running sum gives the bytes before each row.  A row goes to the shard
       in which its first byte falls when all bytes are cut at ``shards`` equal targets, so a
       shard misses its target by less than one row.
    4. ``slot`` numbers the rows of a shard from 0 without gaps, by the same two steps on counts.

    The size is the bytes of the text plus 1; a NULL text has size 1 and the checksum of the empty
    text.  Rows with equal ids are ordered by checksum and size; a NULL id comes first.  Rows that
    repeat all three are interchangeable.  An empty table gives no rows.
    """
    text = F.coalesce(F.col(text_column), F.lit("")).cast("binary")
    narrow = docs.select(
        F.col(id_column).alias("__id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
    )
    order = [F.col("__id").asc_nulls_first(), "text_crc32", "size"]
    placed = cut(narrow.repartitionByRange(*order).withColumn("__part", F.spark_partition_id()))
    before = W.orderBy("__part").rowsBetween(W.unboundedPreceding, -1)
    parts = (  # one row per partition, from here to the join
        placed.groupBy("__part")
        .agg(F.sum("size").alias("__bytes"))
        .withColumn("__start", F.coalesce(F.sum("__bytes").over(before), F.lit(0)))
        .withColumn("__all", F.sum("__bytes").over(W.orderBy("__part").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)))
        .drop("__bytes")
    )
    inside = W.partitionBy("__part").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    start = F.col("__start") + F.coalesce(F.sum("size").over(inside), F.lit(0))
    # whole and rest apart: shards * bytes of a huge table would not fit a long
    target, rest = F.floor(F.col("__all") / shards), F.pmod(F.col("__all"), F.lit(shards))
    targets = F.transform(
        F.sequence(F.lit(1), F.lit(shards - 1)) if shards > 1 else F.array().cast("array<int>"),
        lambda k: k * target + F.ceil(k * rest / shards),
    )
    cuts = F.size(F.filter(targets, lambda t: t <= F.col("__first")))
    sharded = (
        placed.join(parts, "__part")
        .withColumn("__first", start)
        .withColumn("shard", cuts.cast("int"))
        .drop("__start", "__all")
    )
    # a shard covers whole partitions and at most two parts of one, so counts combine the same way
    pieces = sharded.groupBy("shard", "__part").agg(F.count(F.lit(1)).alias("__rows"))
    earlier = W.partitionBy("shard").orderBy("__part").rowsBetween(W.unboundedPreceding, -1)
    pieces = pieces.withColumn("__before", F.coalesce(F.sum("__rows").over(earlier), F.lit(0)))
    within = W.partitionBy("__part", "shard").orderBy(*order)
    slot = F.col("__before") + F.row_number().over(within) - 1
    return sharded.join(pieces.drop("__rows"), ["__part", "shard"]).select(
        F.col("__id").alias(id_column), "size", "text_crc32", "shard", slot.cast("long").alias("slot")
    )
