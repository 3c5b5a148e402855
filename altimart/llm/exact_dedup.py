"""Exact duplicates by an extendible-hash index; DataFrame expressions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from altimart.llm.common import SHARES, cut, spread_join, total_of

#: Deleted before texts are compared: space and the characters from tab to carriage return.
BLANKS = (" ", "\t", "\n", "\x0b", "\x0c", "\r")
#: Distinct hash keys a bucket of the index holds before it is split.
CAPACITY = 1 << 16
#: Leading key bits the directory can use, hence at most 2**20 slots.
BITS = 20
_ID = "decimal(38,0)"
_LAST, _STEP = str((1 << 63) - 1), str(1 << 65)  # the largest id; above all ranks of ids


def without_blanks(text: Column) -> Column:
    out = F.coalesce(text, F.lit(""))
    for blank in BLANKS:
        out = F.replace(out, F.lit(blank), F.lit(""))
    return out


def directory(keys: DataFrame, capacity: int = CAPACITY, bits: int = BITS) -> DataFrame:
    """The extendible-hash directory over distinct ``key``s: (slot, depth).

    A slot is the leading ``bits`` of a key; slots that agree in their leading ``depth`` bits share
    a bucket.  All slots start in one bucket of depth 0.  While buckets hold more than ``capacity``
    keys, each of them splits by one more bit, as when the directory doubles; the others stay.
    Works on one count per slot, so a round is small whatever the data.  A bucket that is overfull
    at the last bit stays so and is scanned as a longer chain.
    """
    slots = keys.groupBy(_slot(bits).alias("slot")).agg(F.count(F.lit(1)).alias("keys"))
    slots = cut(slots.withColumn("depth", F.lit(0)))
    prefix = F.expr(f"shiftright(slot, {bits} - depth)")
    while True:
        sizes = slots.groupBy(prefix.alias("prefix"), "depth").agg(F.sum("keys").alias("held"))
        full = sizes.where((F.col("held") > capacity) & (F.col("depth") < bits)).drop("held")
        if full.isEmpty():
            return slots.select("slot", "depth")
        deeper = full.withColumn("full", F.lit(1))
        split = slots.withColumn("prefix", prefix).join(deeper, ["prefix", "depth"], "left")
        slots = cut(
            split.select("slot", "keys", (F.col("depth") + F.coalesce("full", F.lit(0))).alias("depth"))
        )


def _slot(bits: int) -> Column:
    return F.shiftrightunsigned("key", 64 - bits)


def _choice(length: Column, row_id: Column) -> Column:
    """One number that is largest for the longest text, then the smallest id; NULL ids rank last."""
    rank = F.lit(_LAST).cast(_ID) - row_id.cast("decimal(20,0)") + 1
    return (length.cast("decimal(10,0)") * F.lit(_STEP).cast("decimal(20,0)")).cast(_ID) + F.coalesce(rank, F.lit(0)).cast(_ID)


def _chosen(choice: Column) -> Column:
    rank = F.pmod(choice, F.lit(_STEP).cast(_ID))
    return F.when(rank > 0, (F.lit(_LAST).cast(_ID) - rank + 1).cast("long"))


def bucket_of(rows: DataFrame, slots: DataFrame) -> DataFrame:
    """``rows`` with the bucket that the directory names for their key: its first slot.

    The directory has at most 2**20 slots, whatever the data, and is broadcast.  A key without a slot
    has no bucket and its row is lost.
    """
    first = F.expr(f"shiftleft(shiftright(slot, {BITS} - depth), {BITS} - depth)")
    named = slots.select("slot", first.alias("bucket"))
    return rows.withColumn("slot", _slot(BITS)).join(F.broadcast(named), "slot").drop("slot")


def build_index(keyed: DataFrame, capacity: int = CAPACITY) -> tuple[DataFrame, DataFrame]:
    """The index (bucket, key, chain, text_sha256, group_size, choice) and its directory.

    Rows of ``keyed`` are (key, bare, choice).  The directory is built from the distinct keys.  Each
    bucket goes to the task that owns it, which walks its rows in the order of key and text: a row
    whose bytes are those of the row before is a copy, another one is the next entry of the key's chain.
    A key with more than 1/2048 of all rows, and there are fewer than 2048 of these, is combined in each
    input partition first, so its owner gets a row for each text of it.
    """
    counts = cut(keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")))
    slots = directory(counts, capacity)
    total = total_of(counts, F.sum("n"))
    hot = F.broadcast(counts.where((F.col("n") * SHARES > total) & (F.col("n") > 1)).select("key"))
    one = keyed.join(hot, "key", "left_anti").select("key", "bare", F.lit(1).cast("long").alias("n"), "choice")
    many = keyed.join(hot, "key", "left_semi").groupBy("key", "bare").agg(
        F.count(F.lit(1)).alias("n"), F.max("choice").alias("choice")
    )
    digest = F.sha2(F.col("bare").cast("binary"), 256).alias("text_sha256")
    owned = bucket_of(one.unionByName(many.select("key", "bare", "n", "choice")), slots).repartition("bucket")
    walk = W.partitionBy("bucket", "key").orderBy("bare")
    other = ~F.col("bare").eqNullSafe(F.lag("bare").over(walk))
    placed = owned.withColumn("other", other.cast("int")).withColumn("chain", F.sum("other").over(walk.rowsBetween(W.unboundedPreceding, 0)))
    index = placed.groupBy("bucket", "key", "chain", digest).agg(
        F.sum("n").alias("group_size"), F.max("choice").alias("choice")
    )
    return cut(index), slots


def exact_duplicates(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    capacity: int = CAPACITY,
    carried: Sequence[str] = (),
) -> DataFrame:
    """One row per document: id, keep_id, group_size, kept, text_sha256, bucket, chain.

    Columns named in ``carried`` follow, as each row has them.

    1. Texts without blanks get a 64-bit hash key.  The distinct keys make the directory of an
       extendible-hash index (see ``directory``).
    2. Texts go to the owners of the buckets that the directory names.  An owner compares bytes along
       the chain of each key; the entries, one for each different text with its size and the row that
       stays, go to the shared checkpoint folder (see ``build_index``).
    3. Ids, keys and digests of all documents, no texts, ask the directory for their bucket and find
       their entry along the chain there; hot keys are spread.

    The longest original text (code points), then the smallest id, stays.  NULL counts as empty;
    texts of blanks only equal the empty text.  A NULL id never wins over an id.  Of rows with equal
    ids and texts one is kept.  Texts of any length are compared whole.  An empty table gives no rows.
    """
    bare = without_blanks(F.col(text_column))
    length = F.length(F.coalesce(F.col(text_column), F.lit("")))
    along = [F.col(c).alias(f"__with_{c}") for c in carried]
    rows = docs.select(F.col(id_column).cast("long").alias("__id"), length.alias("length"), bare.alias("bare"), *along)
    keyed = rows.withColumn("key", F.xxhash64("bare")).withColumn("choice", _choice(F.col("length"), F.col("__id")))
    index, slots = build_index(keyed.select("key", "bare", "choice"), capacity)

    narrow = keyed.select(
        "__id", "choice", "key", F.sha2(F.col("bare").cast("binary"), 256).alias("digest"),
        *[f"__with_{c}" for c in carried],
    )
    narrow = cut(bucket_of(narrow, slots).withColumn("row", F.monotonically_increasing_id()))
    entries = index.withColumnRenamed("choice", "best")
    found = spread_join(narrow, entries, ["bucket", "key"], F.col("row"), "inner").where("digest = text_sha256")
    # rows may repeat in id and text: the first of those that could stay does
    winners = found.where("choice = best").groupBy("bucket", "key", "chain").agg(F.min("row").alias("row"))
    judged = found.join(winners.select("row", F.lit(True).alias("wins")), "row", "left")
    return judged.select(
        F.col("__id").alias(id_column),
        _chosen(F.col("best")).alias("keep_id"),
        "group_size",
        F.coalesce("wins", F.lit(False)).alias("kept"),
        "text_sha256",
        "bucket",
        "chain",
        *[F.col(f"__with_{c}").alias(c) for c in carried],
    )
