"""Spelling variants of words, found by permuterm rotations."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from altimart.llm.common import cut
from altimart.llm.secret_scan import LOWER, UPPER

#: Letters of a word; with the 90 of them in lower case a rotation has at most as many neighbours.
LETTERS = "A-Za-z\\u00C0-\\u00FF"
#: Words above this many code points have rotations that are named by hashes: all rotations of one
#: word take the square of its length.
LITERAL = 48
END = "$"
_PRIMES = (2147483647, 2147483629, 2147483587, 2147483579)
_BASES = (1103515245, 1664525, 22695477, 134775813)


def words(docs: DataFrame, least_length: int, id_column: str, text_column: str, every: int | None) -> DataFrame:
    """(word): each occurrence of a run of letters with A-Z in lower case.

    With ``every``, a run loses one letter where ``every`` divides h, the CRC-32 of ``<id>:<run>``:
    the one at h modulo its length.  A NULL id counts as an empty one.  Shorter runs cannot give a
    word of ``least_length`` code points and are not looked at.
    """
    runs = F.regexp_extract_all(F.col(text_column), F.lit(f"[{LETTERS}]{{{least_length},}}"), F.lit(0))
    run = docs.select(
        F.coalesce(F.col(id_column).cast("string"), F.lit("")).alias("id"), F.explode(runs).alias("run")
    ).withColumn("run", F.translate("run", UPPER, LOWER))
    if every is None:
        return run.select(F.col("run").alias("word"))
    h = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
    at = F.pmod(F.col("h"), F.length("run")).cast("int")
    shorter = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    word = F.when(F.col("h") % every == 0, shorter).otherwise(F.col("run"))
    return run.withColumn("h", h).select(word.alias("word")).where(F.length("word") >= least_length)


def vocabulary(occurrences: DataFrame, least_count: int) -> DataFrame:
    """(word, n, rank) of the words that occur often enough; a smaller rank is a larger n, then word.

    The words are range-partitioned in that order, so numbers that grow from partition to partition
    and inside each are the ranks; nothing is gathered.  They are fixed by a checkpoint.
    """
    counts = occurrences.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_count)
    ordered = cut(counts).orderBy(F.desc("n"), "word")
    return cut(ordered.withColumn("rank", F.monotonically_increasing_id()))


def _literal(words_: DataFrame) -> DataFrame:
    """(rank, key, shorter, first) of the rotations of short words, spelt out."""
    size, w = F.length("word"), F.col("word")

    def rotation(p: Column, skipped: int) -> Column:
        return F.concat(F.substring(w, p + 1 + skipped, size), F.lit(END), F.substring(w, F.lit(1), p))

    # the letter before the first one is the empty string, which no letter equals
    same = lambda p: F.substring(w, p, F.lit(1)) == F.substring(w, p + 1, F.lit(1))
    first = lambda p: (p == 0) | ~same(p)
    skips = F.transform(
        F.sequence(F.lit(0), size - 1),
        lambda p: F.struct(rotation(p, 1).alias("key"), F.lit(False).alias("shorter"), first(p).alias("first")),
    )
    wholes = F.transform(
        F.sequence(F.lit(0), size),
        lambda p: F.struct(rotation(p, 0).alias("key"), F.lit(True).alias("shorter"), F.lit(True).alias("first")),
    )
    return words_.select("rank", F.explode(F.concat(skips, wholes)).alias("r")).select("rank", "r.*")


def _powers(base: int, n: int, prime: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    have, step = 1, base % prime
    while have < n:
        more = min(have, n - have)
        out[have : have + more] = out[:more] * np.uint64(step) % np.uint64(prime)
        have, step = have + more, step * step % prime
    return out


def rotation_hashes(word: str) -> tuple[list[bytes], list[bytes], np.ndarray]:
    """Names of the rotations with one letter skipped, of the whole rotations, and ``first``.

    A name is four polynomial hashes of the rotation.  They come from one pass of running sums: the
    sum of a rotation is that of its two pieces, moved by powers of the base.
    """
    codes = np.array([ord(c) for c in word], np.uint64)
    n = len(codes)
    skipped, whole = [], []
    p = np.arange(n)
    for prime, base in zip(_PRIMES, _BASES):
        m, inverse = np.uint64(prime), pow(base, prime - 2, prime)
        up, down = _powers(base, n + 2, prime), _powers(inverse, n + 2, prime)
        sums = np.concatenate([[np.uint64(0)], np.cumsum(codes * up[:n] % m) % m])
        end = np.uint64(ord(END))
        after = (sums[n] + m - sums[p + 1]) % m * down[p + 1] % m
        skipped.append((after + end * up[n - 1 - p] % m + sums[p] * up[n - p] % m) % m)
        q = np.arange(n + 1)
        after = (sums[n] + m - sums[q]) % m * down[q] % m
        whole.append((after + end * up[n - q] % m + sums[q] * up[n + 1 - q] % m) % m)
    names = [[row.tobytes() for row in np.stack(kind, 1).astype("<u4")] for kind in (skipped, whole)]
    return names[0], names[1], np.concatenate([[True], codes[1:] != codes[:-1]])


def _hashed(words_: DataFrame) -> DataFrame:
    """(rank, key, shorter, first) of the rotations of long words; the time is that of their length.

    Only keys that are longer than those that are spelt out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rank, word in zip(batch.column("rank").to_pylist(), batch.column("word").to_pylist()):
                skipped, whole, first = rotation_hashes(word)
                if len(word) == LITERAL + 1:
                    skipped, first = [], first[:0]
                keys = [f"#{k.hex()}" for k in skipped + whole]
                shorter = [False] * len(skipped) + [True] * len(whole)
                firsts = [*first.tolist(), *[True] * len(whole)]
                for at in range(0, len(keys), 1 << 16):
                    part = slice(at, at + (1 << 16))
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([rank] * len(keys[part]), pa.int64()),
                            pa.array(keys[part], pa.string()),
                            pa.array(shorter[part], pa.bool_()),
                            pa.array(firsts[part], pa.bool_()),
                        ],
                        ["rank", "key", "shorter", "first"],
                    )

    return words_.select("rank", "word").mapInArrow(run, "rank long, key string, shorter boolean, first boolean")


def rotations(words_: DataFrame) -> DataFrame:
    """(rank, key, shorter, first): each rotation of a word with its end marked, in two roles.

    Rotated so that its letter at p comes last, a word is ``word[p+1:] $ word[:p] word[p]``.  All
    but that letter is the ``key``: words that share it differ by a replacement at p.  A rotation as
    a whole (``shorter``) is the key of the words that have one more letter there.  In a run of equal
    letters any one may be taken out for the same word; only the ``first`` of them counts.
    Keys of up to ``LITERAL`` letters are spelt out and longer ones hashed; both roles of a key are
    in the same form.
    """
    spelt = _literal(words_.where(F.length("word") <= LITERAL + 1)).where(F.length("key") <= LITERAL + 1)
    return spelt.unionByName(_hashed(words_.where(F.length("word") > LITERAL)))


def near_words(words_: DataFrame) -> DataFrame:
    """(rank, n_near, best): how many words are one edit away and the smallest of their ranks.

    Rotations are sorted by key, and each key's rows are scanned.  They differ in one letter, so
    they are at most as many as there are letters, and one whole word.  Each row gives a count and
    the best of the others, so no pairs are listed.
    """
    rows = rotations(words_)
    others = W.partitionBy("key").orderBy("shorter", "rank").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    skip = F.when(~F.col("shorter"), F.col("rank"))
    seen = rows.select(
        "*",
        F.count(F.lit(1)).over(others).alias("rows"),
        F.count(skip).over(others).alias("replaced"),
        F.count(F.when(~F.col("shorter") & F.col("first"), 1)).over(others).alias("longer"),
        F.min(F.when(~F.col("shorter") & F.col("first"), F.col("rank"))).over(others).alias("best_longer"),
        F.min(F.when(F.col("shorter"), F.col("rank"))).over(others).alias("whole"),
        # rows with a letter skipped come first, by rank
        F.nth_value("rank", 1).over(others).alias("one"),
        F.nth_value(skip, 2).over(others).alias("two"),
    )
    of_skip = F.when(F.col("first"), F.col("whole"))
    best_other = F.when(F.col("one") == F.col("rank"), F.col("two")).otherwise(F.col("one"))
    met = seen.where("rows > 1").select(
        "rank",
        F.when(F.col("shorter"), F.col("longer"))
        .otherwise(F.col("replaced") - 1 + of_skip.isNotNull().cast("int")).alias("n_near"),
        F.when(F.col("shorter"), F.col("best_longer")).otherwise(F.least(best_other, of_skip)).alias("best"),
    )
    return met.groupBy("rank").agg(F.sum("n_near").alias("n_near"), F.min("best").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """(rank, root) from (rank, form): the last form, by doubling steps.

    A form is several times as frequent as its word, so chains are short, and a form has no more
    words than one edit allows.
    """
    now = cut(forms.select("rank", F.col("form").alias("root")))
    while True:
        further = now.select(F.col("rank").alias("root"), F.col("root").alias("next"))
        moved = cut(now.join(further, "root", "left").select("rank", F.coalesce("next", "root").alias("root"), "next"))
        now = moved.select("rank", "root")
        if moved.where("next is not null").isEmpty():
            return now


def variants(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    least_length: int = 7,
    least_count: int = 2,
    times: int = 10,
    every: int | None = None,
) -> DataFrame:
    """Per word: word, n, n_near, form, form_n, root.

    Words are maximal runs of letters (A-Z, a-z, U+00C0 to U+00FF) of at least ``least_length`` code
    points that occur at least ``least_count`` times in all texts, A-Z in lower case; see ``words``
    for ``every``.  Two words are near if one inserted, deleted or replaced code point makes one of the other.
    ``form`` is the most frequent near word, ties to the smaller in code-point order, if it occurs
    at least ``times`` times as often; else NULL.  ``root`` is where forms lead to in the end, or the
    word itself.  NULL and empty texts have no words; repeated rows count each time; an empty table
    gives no rows; words may have any length; other columns are not looked at.
    """
    words_ = vocabulary(words(docs, least_length, id_column, text_column, every), least_count)
    near = words_.join(near_words(words_), "rank", "left")
    best = words_.select(F.col("rank").alias("best"), F.col("word").alias("form"), F.col("n").alias("form_n"))
    found = near.join(best, "best", "left")
    wins = F.col("form_n") >= times * F.col("n")
    judged = cut(
        found.select(
            "rank", "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(wins, F.col("best")).alias("best"), F.when(wins, F.col("form")).alias("form"),
            F.when(wins, F.col("form_n")).alias("form_n"),
        )
    )
    last = roots(judged.where("best is not null").select("rank", F.col("best").alias("form")))
    named = last.join(words_.select(F.col("rank").alias("root"), F.col("word").alias("root_word")), "root")
    return judged.join(named.select("rank", "root_word"), "rank", "left").select(
        "word", "form", F.coalesce("root_word", "word").alias("root"), "n", "n_near", "form_n"
    )
