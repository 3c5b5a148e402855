"""Documents alike in their word n-grams: a Jaccard join on token-combination prefixes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from altimart.llm.common import cut, let_go, split_join, spread_join
from altimart.llm.components import components
from altimart.llm.routing import grouped, groups_for, joined, owners_for, owners_of, table_of
from altimart.llm.text import Remembered, distinct, hash_memory, shingle_set, small
from altimart.sources.sinks import materialised

#: A token in more sets than this is frequent and is indexed in combinations of two.
FREQUENT = 24
#: Sets below this size have too few tokens for combinations.
SINGLES_BELOW = 32
#: Tokens of a frequent class that a prefix holds, about: sets the number of classes by set size.
PER_CLASS = 3
#: Bits of the parity sketch of a set.
SKETCH = 512
_WORDS = SKETCH // 64
#: Every signature names some of its nodes: the first ones after flipping these bits of all.  A node is
#: compared with at most so many of those that its signatures name.
FLIPS = (0,)
#: Words of the sketch by which nodes are sorted to compare neighbours.
SORTED_WORDS = (0, 1, 3, 4, 6, 7)
#: Nodes of one signature that meet in one task, at most.
BLOCK = 1024
#: Signatures before one that are looked at to tell whether a pair was met already.
EARLIER = 8
_MIX, _SHIFT = np.uint64(0x9E3779B97F4A7C15), np.uint64(31)
_BITS = np.uint64(24)
_SENT = pa.schema([("owner", pa.int32()), ("grp", pa.int32()), ("low", pa.binary()), ("n", pa.binary())])
_KNOWN = pa.schema([("grp", pa.int32()), ("owner", pa.int32()), ("low", pa.binary()), ("frequent", pa.binary())])
_INDEX = pa.schema([("node", pa.int64()), ("n", pa.int64()), ("sigs", pa.list_(pa.int64())), ("sketch", pa.list_(pa.int64())), ("tokens", pa.binary())])


def allowance(n: int, percent: int) -> int:
    """Tokens of a set of n that a set alike to it can lack: n - ceil(n * percent / 100)."""
    return n - (percent * n + 99) // 100


def _names(tokens: np.ndarray, owners: int) -> np.ndarray:
    """Owner and 24 further bits of each token, sorted and distinct: what is sent and counted.

    Two tokens with one name only make a name look more frequent; results are verified.
    """
    low = tokens & np.uint64((1 << 24) - 1)
    return distinct(owners_of(tokens, owners).astype(np.uint64) << _BITS | low)


def _three_bytes(names: np.ndarray) -> bytes:
    return (names & np.uint64((1 << 24) - 1)).astype("<u4").view(np.uint8).reshape(-1, 4)[:, :3].tobytes()


def _from_three(data: bytes) -> np.ndarray:
    wide = np.zeros((len(data) // 3, 4), np.uint8)
    wide[:, :3] = np.frombuffer(data, np.uint8).reshape(-1, 3)
    return wide.reshape(-1).view("<u4").astype(np.uint64)


def _mixed(*parts) -> np.ndarray:
    out = np.uint64(len(parts))
    for p in parts:
        out = (out ^ p) * _MIX
        out = out ^ (out >> _SHIFT)
    return out


def signatures(names: np.ndarray, kinds: np.ndarray, n: int, percent: int) -> np.ndarray | None:
    """What a set of n tokens is indexed under; None if it can be alike to no other.

    Tokens are ordered by kind (0: in this set only, 1: rare, 2: frequent), then by name.  A set
    alike to this one lacks at most ``allowance`` of its tokens, so of a prefix from which more than
    that must be lost, something is shared: a rare token, or two frequent tokens of one class.  A
    class with p tokens in the prefix counts p - 1, as one token may be shared without a pair; the
    prefix is extended until the counts exceed the allowance.  Kinds and names mean the same in all
    sets, and of two prefixes the one that ends later holds what the other shares.
    The number of classes follows the power of two of the set's size; both sizes that the larger set
    of a pair can have are indexed.
    """
    need = allowance(n, percent) + 1 - int((kinds == 0).sum())
    if need <= 0:
        return None
    rare, frequent = names[kinds == 1][:need], names[kinds == 2]
    out = [_mixed(rare)]
    need -= len(rare)
    if need > 0 and len(frequent):
        for band in {n.bit_length(), (n * 100 // percent).bit_length()}:
            if (1 << band) <= SINGLES_BELOW:
                out.append(_mixed(frequent[:need], np.uint64(band)))
                continue
            classes = max(1, allowance(1 << (band - 1), percent) // PER_CLASS)
            of = _mixed(frequent) % np.uint64(classes)
            firsts = np.zeros(len(frequent), bool)
            firsts[np.unique(of, return_index=True)[1]] = True
            end = int(np.searchsorted(np.cumsum(~firsts), need)) + 1
            for c in range(classes):
                tokens = frequent[:end][of[:end] == c]
                i, j = np.triu_indices(len(tokens), 1)
                out.append(_mixed(tokens[i], tokens[j], np.uint64(band)))
    return distinct(np.concatenate(out))


def parity(tokens: np.ndarray) -> np.ndarray:
    """Per bit, whether an odd number of tokens falls on it.

    Tokens that two sets share cancel out, so the sketches of two sets differ in no more bits than
    the sets in tokens.
    """
    odd = np.bincount((tokens >> np.uint64(20)).astype(np.int64) % SKETCH, minlength=SKETCH) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _lowered(text: bytes | None) -> list[bytes]:
    return (text or b"").lower().split()


def _sets(docs: DataFrame, width: int) -> DataFrame:
    """(grp, id, n, sig): the size of each document's set and a 128-bit digest of it; no shuffle.

    Other columns than id, text and grp stay.
    """
    more = [f for f in docs.schema.fields if f.name not in ("grp", "id", "text")]
    schema = T.StructType([*T.StructType.fromDDL("grp int, id long, n long, sig binary").fields, *more])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = hash_memory()
        for batch in small(batches, "text"):
            sizes, digests = [], []
            for text in batch.column("text").cast(pa.binary()).to_pylist():
                tokens = shingle_set(_lowered(text), width, memory)
                sizes.append(len(tokens))
                digests.append(xxhash.xxh3_128_digest(tokens.tobytes()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("grp"), batch.column("id"), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), *[batch.column(f.name) for f in more]],
                ["grp", "id", "n", "sig", *[f.name for f in more]],
            )

    return docs.mapInArrow(run, schema)


def _indexed(texts: DataFrame, nodes: DataFrame, owners: int, width: int, percent: int) -> DataFrame:
    """(node, n, sigs, tokens) of the sets that may be alike to another."""
    home = nodes.select("grp", "sig", "node")

    def own(table: pa.Table, named: dict[bytes, int]) -> Iterator[tuple[int, np.ndarray]]:
        memory, left = hash_memory(), dict(named)
        for chunk in table.to_batches():
            for text in chunk.column("text").cast(pa.binary()):
                tokens = shingle_set(_lowered(text.as_py()), width, memory)
                node = left.pop(xxhash.xxh3_128_digest(tokens.tobytes()), None) if left else None
                if node is not None and len(tokens):
                    yield node, tokens

    def named(table: pa.Table) -> dict[bytes, int]:
        found = zip(table.column("sig").to_pylist(), table.column("node").to_pylist())
        return {sig: node for sig, node in found if sig is not None}

    def send(key: tuple, table: pa.Table, known: pa.Table) -> pa.Table:
        all_ = [_names(tokens, owners) for _, tokens in own(table, named(known))]
        if not all_:
            return table_of([], _SENT)
        names, n = np.unique(np.concatenate(all_), return_counts=True)
        owner = (names >> _BITS).astype(np.int64)
        n = np.minimum(n, 255).astype(np.uint8)  # only whether it passes FREQUENT matters
        at, grp = np.flatnonzero(np.diff(owner, prepend=-1)), key[0].as_py()
        return table_of(
            [(int(owner[a]), grp, _three_bytes(names[a:b]), n[a:b].tobytes()) for a, b in zip(at, [*at[1:], len(owner)])],
            _SENT,
        )

    def count(key: tuple, table: pa.Table) -> pa.Table:
        parts = [_from_three(b) for b in table.column("low").to_pylist()]
        low, row = np.concatenate(parts), np.repeat(np.arange(len(parts)), [len(p) for p in parts])
        n, _ = joined(table.column("n"), np.uint8)
        order = np.argsort(low, kind="stable")
        at = np.flatnonzero(np.diff(low[order], prepend=~low[order][:1]))
        total = np.repeat(np.add.reduceat(n[order].astype(np.int64), at), np.diff(np.append(at, len(low))))
        held = np.zeros(len(low), np.int64)
        held[order] = total
        shared = held > 1
        low, row, frequent = low[shared], row[shared], (held[shared] > FREQUENT).astype(np.uint8)
        groups_, owner = table.column("grp").to_pylist(), key[0].as_py()
        at = np.flatnonzero(np.diff(row, prepend=-1))
        return table_of(
            [(groups_[row[a]], owner, _three_bytes(low[a:b]), frequent[a:b].tobytes()) for a, b in zip(at, [*at[1:], len(row)])],
            _KNOWN,
        )

    def index(key: tuple, table: pa.Table, known: pa.Table) -> pa.Table:
        mine = named(known)
        answers = [(o, low, f) for o, low, f in zip(*[known.column(c).to_pylist() for c in ("owner", "low", "frequent")]) if low]
        found = np.concatenate([np.zeros(0, np.uint64), *[np.uint64(o) << _BITS | _from_three(low) for o, low, _ in answers]])
        often = np.concatenate([np.zeros(0, np.uint8), *[np.frombuffer(f, np.uint8) for *_, f in answers]])
        order = np.argsort(found, kind="stable")
        found, often, rows = found[order], often[order], []
        for node, tokens in own(table, mine) if len(found) else ():
            names = _names(tokens, owners)
            place = np.minimum(np.searchsorted(found, names), len(found) - 1)
            kinds = np.where(found[place] == names, 1 + often[place], 0)
            sigs = signatures(names, kinds, len(tokens), percent)
            if sigs is not None:
                rows.append((node, len(tokens), sigs.view(np.int64), parity(tokens), tokens.tobytes()))
        return table_of(rows, _INDEX)

    by_group = texts.groupBy("grp")
    sent = by_group.cogroup(home.groupBy("grp")).applyInArrow(send, "owner int, grp int, low binary, n binary")
    known = sent.groupBy("owner").applyInArrow(count, "grp int, owner int, low binary, frequent binary")
    answers = known.unionByName(home, allowMissingColumns=True)
    return by_group.cogroup(answers.groupBy("grp")).applyInArrow(index, "node long, n long, sigs array<long>, sketch array<long>, tokens binary")


def _verified(pairs: DataFrame, index: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets are alike, by the sets themselves."""
    sets = index.select("node", "tokens")
    both = (
        pairs.join(sets.withColumnsRenamed({"node": "b", "tokens": "right"}), "b")
        .join(sets.withColumnsRenamed({"node": "a", "tokens": "left"}), "a")
        .select("a", "b", "left", "right")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches, "left", 8 << 20):
            keep = []
            for left, right in zip(batch.column("left"), batch.column("right")):
                x, y = (np.frombuffer(s.as_py(), np.uint64) for s in (left, right))
                shared = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * shared >= percent * (len(x) + len(y) - shared))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return both.mapInArrow(run, "a long, b long")


def _differ() -> Column:
    """Bits in which the sketches s and t of a row differ."""
    return sum((F.bit_count(F.col(f"s{i}").bitwiseXOR(F.col(f"t{i}"))) for i in range(_WORDS)), F.lit(0))


def _closest(signed: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b), a < b: each node with the closest, by sketch, of the nodes that its signatures name.

    The named nodes are dealt by hash to as many sides as a signature names, and the closest of each
    side is taken, so a node gives a few pairs at most.  Pairs that the sketches rule out are left out.
    Minima are combined before they are shuffled.
    """
    flipped = [F.min(F.col("node").bitwiseXOR(F.lit(f))).bitwiseXOR(F.lit(f)) for f in FLIPS]
    some = signed.groupBy("sig").agg(F.array_distinct(F.array(*flipped)).alias("some"), F.count(F.lit(1)).alias("held"))
    named = some.where("held > 1").select("sig", F.explode("some").alias("one"))
    met = split_join(signed.select("sig", "node"), named, ["sig"])
    met = met.where("node <> one").select("node", "one").distinct()
    names = {"node": "one", "size": "other_size"} | {f"s{i}": f"t{i}" for i in range(_WORDS)}
    both = met.join(sketches, "node").join(sketches.withColumnsRenamed(names), "one")
    near = both.select("node", "one", "size", "other_size", _differ().alias("differ")).where(
        F.col("differ") * (100 + percent) <= (F.col("size") + F.col("other_size")) * (100 - percent)
    )
    side = F.pmod(F.xxhash64("one"), F.lit(len(FLIPS)))
    best = near.groupBy("node", side.alias("side")).agg(F.min(F.struct("differ", "one"))["one"].alias("one"))
    return best.select(F.least("node", "one").alias("a"), F.greatest("node", "one").alias("b")).distinct()


def _neighbours(sketches: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b), a < b, of nodes next to each other when all are sorted by a word of their sketch.

    Sets that differ in few tokens often agree in a whole word.  Each of a few words gives every node
    one pair at most; pairs that the sketches rule out are left out.  All words are sorted in one go, by
    ranges, and nodes at the two sides of a range's end are not paired: other words, and the comparison
    across components, are there for them.
    """
    names = ["node", "size", *[f"s{i}" for i in range(_WORDS)]]
    befores = ["one", "other_size", *[f"t{i}" for i in range(_WORDS)]]
    words = F.array(*[F.struct(F.lit(w).alias("word"), F.col(f"s{w}").alias("value")) for w in SORTED_WORDS])
    placed = sketches.select(*names, F.inline(words)).repartitionByRange("word", "value", "node")
    inside = W.partitionBy("part", "word").orderBy("value", "node")
    both = placed.withColumn("part", F.spark_partition_id()).select(
        *names, *[F.lag(n).over(inside).alias(b) for n, b in zip(names, befores)]
    )
    near = both.where(_differ() * (100 + percent) <= (F.col("size") + F.col("other_size")) * (100 - percent))
    return near.select(F.least("node", "one").alias("a"), F.greatest("node", "one").alias("b")).distinct()


def alike(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    width: int = 4,
    percent: int = 85,
    carried: str | None = None,
) -> DataFrame:
    """Per document: id, n_shingles, component_id, the smallest id reachable by links.

    With ``carried``, that column follows as each row has it, and ``component``, a number of the
    component that does not depend on ids; it is NULL for an empty set.

    A document's set holds its distinct ``width``-word shingles, of lower-cased (A-Z) words between
    ASCII white space; with fewer words, the whole sequence is the one element.  Two documents link
    when 100 * intersection >= percent * union.  Without words, NULL or empty, the set is empty and
    links with nothing.  Rows with equal ids and different texts are linked as different documents;
    NULL ids are passed over when the smallest id is sought.  An empty table gives no rows.

    1. Equal sets become one node; copies cost nothing from here on.
    2. Groups of documents send their nodes' distinct tokens, three bytes each, to owners of hash
       ranges, which count them and report those held more than once.  A node with more tokens of
       its own than a similar set may lack is done: it links with nothing.
    3. The others get ``signatures``: rare tokens one by one, frequent ones in pairs, and go to the
       checkpoint folder with their sets.
    4. Every signature names a few of its nodes, and a node is compared with the closest of those
       that its signatures name, by parity sketch, and with its neighbours in the order of some words
       of the sketch; this forms most of the components.  Where a
       signature still has nodes of different components, every pair across components is compared:
       those whose parity sketches differ in more bits than alike sets may differ in tokens are out,
       the others are compared in full.  The nodes of a signature are split into blocks, and pairs of
       blocks meet in different tasks.  So no two nodes are left apart that link; links inside a
       component are not listed one by one.
    """
    groups = groups_for(docs, text_column)
    texts = grouped(docs, id_column, text_column, groups)
    along = [F.col(carried).alias("carried")] if carried else []
    sets = cut(_sets(grouped(docs, id_column, text_column, groups, *along), width))
    nodes = cut(
        sets.where("n > 0").groupBy("sig").agg(F.min("grp").alias("grp"), F.min("id").alias("least"))
        .withColumn("node", F.monotonically_increasing_id())
    )
    let_go(docs.sparkSession)  # texts are about to be shuffled
    # the largest frame by far: written once, where a checkpoint would lie beside the held rows it is made of
    index = materialised(_indexed(texts, nodes, owners_for(docs), width, percent), "sets")
    let_go(docs.sparkSession)  # and have been
    signed = cut(index.select("node", "n", F.posexplode("sigs").alias("pos", "sig")))
    sketches = index.select("node", F.col("n").alias("size"), *[F.col("sketch")[i].alias(f"s{i}") for i in range(_WORDS)])
    tried = cut(_closest(signed, sketches, percent).unionByName(_neighbours(sketches, percent)).distinct())
    links = cut(_verified(tried, index, percent))
    let_go(docs.sparkSession)

    placed = signed.join(components(links), "node", "left").withColumn("label", F.coalesce("label", "node"))
    open_ = placed.groupBy("sig").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count(F.lit(1)).alias("held")).where("low < high")
    blocks = F.ceil(F.col("held") / BLOCK)
    left = split_join(placed, open_.select("sig", blocks.alias("blocks")), ["sig"])
    left = left.join(sketches.drop("size"), "node").join(index.select("node", "sigs"), "node")
    # a pair is passed over where both nodes have one of their last few signatures before this one in
    # common: it is met there, or at a still earlier one, and never passed over at its first
    before = F.slice("sigs", F.greatest(F.col("pos") + 1 - EARLIER, F.lit(1)), F.least("pos", F.lit(EARLIER)))
    left = left.withColumn("before", before).drop("sigs", "pos")
    names = {"node": "b", "n": "m", "label": "other", "before": "earlier"} | {f"s{i}": f"t{i}" for i in range(_WORDS)}
    right = left.withColumnsRenamed(names).withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).drop("blocks")
    left = left.withColumn("block", F.pmod(F.xxhash64("node"), "blocks")).drop("blocks")
    near = _differ() * (100 + percent) <= (F.col("n") + F.col("m")) * (100 - percent)
    new = ~F.arrays_overlap("before", "earlier")
    across = left.join(right, ["sig", "block"]).where((F.col("node") < F.col("b")) & (F.col("label") != F.col("other")) & near & new)
    rest = across.select(F.col("node").alias("a"), "b").distinct().join(tried, ["a", "b"], "left_anti")
    labels = components(links.unionByName(_verified(rest, index, percent)))

    labelled = nodes.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    smallest = labelled.groupBy("label").agg(F.min("least").alias("component_id"))
    ids = spread_join(labelled.select("sig", "label"), smallest, ["label"], F.col("sig"), "inner")
    done = spread_join(sets, ids.select("sig", "component_id", "label"), ["sig"], F.struct("id", "grp", *["carried"] * bool(carried)), "left")
    return done.select(
        F.col("id").alias(id_column),
        F.col("n").alias("n_shingles"),
        F.coalesce("component_id", "id").alias("component_id"),
        *([F.col("carried").alias(carried), F.col("label").alias("component")] if carried else []),
    )
