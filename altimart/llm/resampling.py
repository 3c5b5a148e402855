"""Importance resampling towards a target distribution, on n-gram buckets from prefix CRCs."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from altimart.llm.common import cut, total_of
from altimart.llm.text import raw_texts, small

BUCKETS = 10_000
#: Characters of a word: digits, letters and everything beyond ASCII.  Other bytes become a space.
_WORD = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)
_POLYNOMIAL = np.uint32(0xEDB88320)


def normalised(text: bytes) -> list[bytes]:
    """Words of a text, A-Z in lower case; joined by one space they are the normalised document."""
    return text.translate(_WORD).split()


def _times(matrix: np.ndarray, value: np.ndarray) -> np.ndarray:
    """A 32 x 32 matrix over GF(2), a number per column, applied to each value."""
    out = np.zeros_like(value)
    for bit in range(32):
        out ^= np.where(value >> np.uint32(bit) & np.uint32(1), matrix[bit], np.uint32(0))
    return out


@cache
def _shift_tables(power: int) -> np.ndarray:
    """What 2**power zero bytes make of a CRC: four tables, one for each of its bytes."""
    bits = np.uint32(1) << np.arange(32, dtype=np.uint32)
    one = np.concatenate([[_POLYNOMIAL], bits[:-1]])  # a zero bit
    matrix = one
    for _ in range(3 + power):
        matrix = _times(matrix, matrix)
    values = np.arange(256, dtype=np.uint32)
    return np.stack([_times(matrix, values << np.uint32(8 * k)) for k in range(4)])


def shifted(crc: np.ndarray, by: np.ndarray) -> np.ndarray:
    """Each CRC moved over ``by`` bytes of zeros."""
    out = crc.astype(np.uint32)
    for power in range(int(by.max(initial=0)).bit_length()):
        at = np.flatnonzero(by >> power & 1)
        part, tables = out[at], _shift_tables(power)
        moved = tables[0][part & np.uint32(255)]
        for k in range(1, 4):
            moved = moved ^ tables[k][part >> np.uint32(8 * k) & np.uint32(255)]
        out[at] = moved
    return out


def grams(docs: list[list[bytes]], longest: int) -> tuple[np.ndarray, np.ndarray]:
    """CRC-32 of every run of 1 to ``longest`` words of every document, and whose each is.

    A document, its words joined by one space, is scanned once and the CRC up to the end of each
    word and up to the start of each word is stored.  The CRC of the bytes between two places is the
    CRC at the later one, from which the CRC at the earlier one, moved by the bytes between them, is
    cancelled.
    """
    counts = np.array([len(words) for words in docs], np.int64)
    pieces = [p for words in docs for p in words]
    sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
    owner = np.repeat(np.arange(len(docs)), counts)
    at_start, at_end = np.zeros(len(pieces), np.uint32), np.zeros(len(pieces), np.uint32)
    place = 0
    for words in docs:
        if words:
            run = list(accumulate([p for w in words for p in (w, b" ")], lambda c, p: zlib.crc32(p, c), initial=0))
            at_start[place : place + len(words)] = run[0:-1:2]
            at_end[place : place + len(words)] = run[1::2]
            place += len(words)
    ends = np.cumsum(sizes + 1) - 1
    starts = ends - sizes
    found, whose = [], []
    for n in range(1, longest + 1):
        last = len(pieces) - n + 1
        if last <= 0:
            break
        inside = owner[:last] == owner[n - 1 :]
        a, b = np.flatnonzero(inside), np.flatnonzero(inside) + n - 1
        found.append(at_end[b] ^ shifted(at_start[a], ends[b] - starts[a]))
        whose.append(owner[a])
    if not found:
        return np.zeros(0, np.uint32), np.zeros(0, np.int64)
    return np.concatenate(found), np.concatenate(whose)


def bucket_counts(docs: DataFrame, text_column: str, longest: int, buckets: int) -> DataFrame:
    """(bucket, n) over all features of all texts; a task sends at most a row per bucket and batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in small(batches, "text"):
            crcs, _ = grams([normalised(t) for t in raw_texts(batch.column("text"))], longest)
            total += np.bincount(crcs % np.uint32(buckets), minlength=buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int64()), pa.array(total[held])], ["bucket", "n"])

    each = docs.select(F.col(text_column).alias("text")).mapInArrow(run, "bucket long, n long")
    return each.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame, text_column: str, target_column: str, longest: int, buckets: int) -> np.ndarray:
    """Per bucket floor(1000 * ln of how much likelier it is in the target), add-one smoothed.

    As many numbers as there are buckets come to the driver, whatever the data.
    """
    s = bucket_counts(docs, text_column, longest, buckets).withColumnRenamed("n", "s")
    t = bucket_counts(target, target_column, longest, buckets).withColumnRenamed("n", "t")
    every = docs.sparkSession.range(buckets).withColumnRenamed("id", "bucket")
    both = cut(every.join(s, "bucket", "left").join(t, "bucket", "left").na.fill(0, ["s", "t"]))
    all_s, all_t = (float(total_of(both, F.sum(c)) + buckets) for c in "st")
    more = lambda c: F.col(c).cast("double") + 1
    ratio = more("t") * F.lit(all_s) / (more("s") * F.lit(all_t))
    rows = both.select("bucket", F.floor(1000 * F.log(ratio)).alias("gain")).toArrow()
    out = np.zeros(buckets, np.int64)
    out[rows.column("bucket").to_numpy()] = rows.column("gain").to_numpy()
    return out


def _weighed(docs: DataFrame, gain: np.ndarray, longest: int) -> DataFrame:
    """(id, n_words, n_features, weight) of every row; the gains, a number per bucket, are broadcast."""
    shipped = docs.sparkSession.sparkContext.broadcast(gain)
    schema = T.StructType([docs.schema["id"], *T.StructType.fromDDL("n_words long, n_features long, weight long").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = shipped.value
        for batch in small(batches, "text"):
            words = [normalised(t) for t in raw_texts(batch.column("text"))]
            crcs, whose = grams(words, longest)
            n = np.bincount(whose, minlength=len(words))
            # sums of whole numbers far below 2**53 are exact
            weight = np.bincount(whose, of[crcs % np.uint32(len(of))], len(words)).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array([len(w) for w in words], pa.int64()), pa.array(n, pa.int64()), pa.array(weight)],
                ["id", "n_words", "n_features", "weight"],
            )

    return docs.select("id", "text").mapInArrow(run, schema)


def noise(id_: Column, seed: int) -> Column:
    """Gumbel noise times 1000, rounded down, from SHA-256 of ``<seed>:<id>``; a NULL id is empty."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(id_.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name.cast("binary"), 256), 1, 8), 16, 10).cast("long")
    uniform = (h.cast("double") + 0.5) / F.lit(4294967296.0)
    return F.floor(-1000 * F.log(-F.log(uniform)))


def resampled(
    docs: DataFrame,
    target: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    target_column: str = "text",
    longest: int = 1,
    buckets: int = BUCKETS,
    percent: int = 10,
    least_words: int = 20,
    seed: int = 2024,
) -> DataFrame:
    """Per row: id, n_features, weight, score, rank; drawn rows are like the target, without replacement.

    Features are all runs of 1 to ``longest`` words; a feature's bucket is its CRC-32 modulo
    ``buckets``.  The weight adds up the gains of a row's features, the score adds Gumbel noise.  Of
    the N rows with at least ``least_words`` words, floor(percent * N / 100) with the highest scores
    are drawn, ties to the smaller id (NULL last), and numbered from 1; ``rank`` of the others is NULL.

    1. One pass counts buckets of docs and target, a row per bucket and task.
    2. A second pass weighs each row; ids and numbers go to the checkpoint folder, no texts.
    3. These are range-partitioned by score and id.  A running sum over the partitions' row counts
       gives the rank of the first row of each, so nothing is sorted or numbered in one task.

    NULL and empty texts have no features and weight 0.  Rows with equal ids and texts have equal
    scores and ranks next to each other; the order of reading tells them apart, so a hot id is
    spread over partitions.  An empty table gives no rows; an empty target leaves only noise and
    smoothing.  Texts are read whole; other columns are not looked at.
    """
    gain = gains(docs, target, text_column, target_column, longest, buckets)
    rows = _weighed(docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text")), gain, longest)
    scored = cut(
        rows.withColumn("score", (F.col("weight") + noise(F.col("id"), seed)).cast("long"))
        .withColumn("dice", F.monotonically_increasing_id())
    )
    able = scored.where(F.col("n_words") >= least_words)
    order = [F.desc("score"), F.col("id").asc_nulls_last(), F.col("dice")]
    # numbers of a sorted frame grow by one inside a partition
    place = F.monotonically_increasing_id()
    sorted_ = cut(able.orderBy(*order).withColumn("part", F.spark_partition_id()).withColumn("place", place))
    firsts = sorted_.groupBy("part").agg(F.count(F.lit(1)).alias("rows"))
    starts, total = {}, 0
    for part in firsts.orderBy("part").collect():  # a row per partition
        starts[part["part"]] = total
        total += part["rows"]
    before = docs.sparkSession.createDataFrame(list(starts.items()), "part int, before long")
    rank = F.col("before") + F.col("place").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    drawn = percent * total // 100
    ranked = sorted_.join(F.broadcast(before), "part").withColumn("rank", F.when(rank <= drawn, rank))
    rest = scored.where(F.col("n_words") < least_words).withColumn("rank", F.lit(None).cast("long"))
    columns = [F.col("id").alias(id_column), "n_features", "weight", "score", "rank"]
    return ranked.select(*columns).unionByName(rest.select(*columns))
