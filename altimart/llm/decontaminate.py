"""Benchmark items inside documents, by size-partitioned MinHash containment search.

DataFrame expressions only.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from altimart.llm.common import cut, spread_join

WIDTH, PERCENT = 5, 80
#: Documents above 2**24 shingles share one size class.
LAST_CLASS = 24
#: Hash buckets of the sketch values: at most so many rows are broadcast, whatever the benchmark.
BUCKETS = 1 << 20
_SALTS = 16


def words(text: Column) -> Column:
    """Lower-cased runs of letters and digits."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), "")


def _once(value: Column, make) -> Column:
    """``make(value)`` with the value computed once a row.

    A lambda that names a computed column would get its whole expression inlined, and run it for
    every element, where the optimizer pushes a filter below the projection.
    """
    return F.element_at(F.transform(F.array(value), make), 1)


def _per_shingle(of: Column, width: int, make) -> Column:
    """``make`` of the words of every shingle; none where there are fewer words than a shingle has."""
    each = F.transform(of, lambda w, i: make(w, *[F.get(of, i + k) for k in range(1, width)]))
    return F.slice(each, 1, F.greatest(F.size(of) - (width - 1), F.lit(0)))


def _hashes(text: Column, width: int) -> Column:
    return _once(words(text), lambda w: F.array_distinct(_per_shingle(w, width, F.xxhash64)))


def _strings(text: Column, width: int) -> Column:
    join = lambda *w: F.concat_ws(" ", *w)
    return _once(words(text), lambda w: F.array_distinct(_per_shingle(w, width, join)))


def _size_class(size: Column) -> Column:
    """The bits of the size."""
    return F.least(F.length(F.bin(size.cast("long"))), F.lit(LAST_CLASS))


def contained_items(
    docs: DataFrame,
    items: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
    width: int = WIDTH,
    percent: int = PERCENT,
) -> DataFrame:
    """Pairs (id, item, n_item_shingles, n_shared, containment) with containment of at least 80 %.

    A text's shingles are its distinct runs of five words.  An item of fewer words has one shingle, its
    whole sequence, and is looked for among the runs of that many words.  An item of q shingles is in a
    document that has at least 80 % of them, so one misses at most q - ceil(0.8 q).

    1. An item's sketch is its q - ceil(0.8 q) + 1 smallest shingle hashes (bottom-k MinHash): every
       document that contains the item has at least one of them, so nothing is missed.
    2. Items are partitioned by the number of shingles they need, documents by the number they have.
       Per size class, the largest sketch value of the items that fit is a ceiling: of a document
       only hashes up to it are looked at.  The classes are at most 25 rows.
    3. These hashes are checked against the hash buckets of all sketches, at most 2**20 numbers, in
       the same pass as the scan; the few left meet the sketches in a join on the full hash, salted
       because a popular item may be in a third of all documents.
    4. Candidates are verified on the shingles themselves, as text.

    Each length of run that items ask for is one such search; where all items have five words or more
    that is one.  Of repeated ids and items the largest overlap is returned once.  Rows with a NULL id,
    items without words and documents with fewer words than an item take part in no pair with it.
    Empty tables give no rows.  Texts are read whole.
    """
    named_items = items.where(F.col(item_column).isNotNull()).select(
        F.col(item_column).alias("__item"), F.col(item_text_column).alias("__wanted")
    )
    sized = named_items.withColumn("width", F.least(F.size(words(F.col("__wanted"))), F.lit(width))).where("width > 0")
    need = F.ceil(F.col("q") * percent / 100).cast("int")
    tests = cut(  # read by each step below
        sized.withColumn("hashes", _by_width("width", width, lambda k: _hashes(F.col("__wanted"), k)))
        .withColumn("q", F.size("hashes"))
        .withColumn("need", need)
        .withColumn("sketch", F.slice(F.array_sort("hashes"), 1, F.col("q") - F.col("need") + 1))
        .select("__item", "width", "need", "sketch", _by_width("width", width, lambda k: _strings(F.col("__wanted"), k)).alias("wanted"))
    )
    named = docs.where(F.col(id_column).isNotNull()).select(F.col(id_column).alias("__doc"), F.col(text_column).alias("__text"))
    # numbers from 1 to the width
    widths = [r["width"] for r in tests.select("width").distinct().collect()] or [width]
    candidates = cut(reduce(DataFrame.unionByName, [_candidates(named, tests.where(F.col("width") == k), k) for k in sorted(widths)]))

    full = tests.select("__item", "width", "wanted")
    asked = spread_join(candidates, full, ["__item", "width"], F.col("__doc"), "inner")
    held = _by_width("width", width, lambda k: _strings(F.col("__text"), k), widths)
    shared = (
        asked.join(named, "__doc")
        .withColumn("shared", F.size(F.array_intersect("wanted", held)))
        .withColumn("q", F.size("wanted"))
        .where(F.col("shared") * 100 >= F.col("q") * percent)
    )
    return shared.groupBy("__doc", "__item").agg(
        F.max(F.struct(F.col("shared") / F.col("q"), "shared", "q")).alias("best")
    ).select(
        F.col("__doc").alias(id_column),
        F.col("__item").alias(item_column),
        F.col("best.q").cast("long").alias("n_item_shingles"),
        F.col("best.shared").cast("long").alias("n_shared"),
        F.col("best.col1").alias("containment"),
    )


def _by_width(column: str, most: int, make, widths: Sequence[int] | None = None) -> Column:
    """``make`` of the width that a row names; only that branch is computed."""
    chain = F
    for k in sorted(widths or range(1, most + 1)):
        chain = chain.when(F.col(column) == k, make(k))
    return chain


def _candidates(named: DataFrame, tests: DataFrame, width: int) -> DataFrame:
    """(__doc, __item, width): documents that hold a sketch value of an item of this width."""
    ceilings = (
        tests.select(F.element_at("sketch", -1).alias("top"), F.explode(F.sequence(_size_class(F.col("need")), F.lit(LAST_CLASS))).alias("class"))
        .groupBy("class")
        .agg(F.max("top").alias("ceiling"))
    )
    sketches = tests.select("__item", F.explode("sketch").alias("hash"))
    bucket = F.pmod(F.col("hash"), F.lit(BUCKETS)).cast("int")
    buckets = sketches.select(bucket.alias("bucket")).distinct()
    hashed = named.select("__doc", _hashes(F.col("__text"), width).alias("hashes")).withColumn("class", _size_class(F.size("hashes")))
    probes = (
        hashed.join(F.broadcast(ceilings), "class")
        .select("__doc", F.explode_outer(F.filter("hashes", lambda h: h <= F.col("ceiling"))).alias("hash"))
        .withColumn("bucket", bucket)
        .join(F.broadcast(buckets), "bucket", "left_semi")
        .withColumn("salt", F.pmod(F.xxhash64("__doc"), F.lit(_SALTS)).cast("int"))
    )
    salted = sketches.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))))
    met = probes.join(salted, ["hash", "salt"]).select("__doc", "__item").distinct()
    return met.withColumn("width", F.lit(width))
