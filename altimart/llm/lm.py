"""Log-likelihood of texts under a byte model of logistically mixed context predictors."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from altimart.llm.routing import groups_for, joined, owners_for, packed, table_of

#: Bytes of context of each predictor; the longest comes first in a gram of six bytes.
ORDERS = (2, 3, 4, 5)
_START = {2: 0.1, 3: 0.2, 4: 0.35, 5: 0.45}  # first weights: longer contexts count for more
GROUP_BYTES = 8 << 20
#: Parts that share out the table of grams by the last two context bytes.
PARTS = 256
_GATES = 8 * (len(ORDERS) + 1)  # bit of the byte, and how many contexts are known
_STEPS, _REACH = 33, 8.0  # refinement: cells over the mixed log odds
_BLOCK, _RATE, _TRUST = 2048, 0.4, 20.0
_SIZE = _GATES * (len(ORDERS) + 1 + 2 * _STEPS)
_GRAM, _WORD = 0, 1
_SENT = pa.schema([("owner", pa.int32()), ("grp", pa.int32()), ("kind", pa.int32()), ("keys", pa.binary()), ("n", pa.binary())])
_TOTAL = pa.schema([("part", pa.int32()), ("keys", pa.binary()), ("n", pa.binary())])
_SCORED = pa.schema([("owner", pa.int32()), ("keys", pa.binary()), ("logs", pa.binary())])
_ANSWER = pa.schema([("grp", pa.int32()), ("owner", pa.int32()), ("kind", pa.int32()), ("logs", pa.binary())])
_TRAINED = pa.schema([("sums", pa.list_(pa.float64()))])
_MIX, _SHIFT = np.uint64(0x9E3779B97F4A7C15), np.uint64(29)
_MASK = np.uint64(0xFF)
_BLANK = np.isin(np.arange(256), list(b" \t\n\v\f\r"))
_FIRST = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)  # the first n of eight bytes
_LONG = 64
_SPREAD = (np.uint64(0xD6E8FEB86659FD93), np.uint64(0x9E3779B97F4A7C15))


def _mixed(*parts) -> np.ndarray:
    out = np.uint64(len(parts))
    for p in parts:
        out = (out ^ p) * _MIX
        out = out ^ (out >> _SHIFT)
    return out


def grams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Six-byte grams that end at each byte and at the end mark of each text, and grams per text.

    A text is followed by one zero byte, its end, and preceded by five, its empty context.
    """
    lengths = np.array([len(t) + 1 for t in texts], np.int64)
    data = b"\0\0\0\0\0" + b"\0\0\0\0\0\0".join(texts) + b"\0\0\0"
    # eight bytes from each place on, the first one highest; the last two are dropped again
    keys = np.ndarray(len(data) - 7, ">u8", data, strides=1).astype(np.uint64) >> np.uint64(16)
    inside = np.ones(len(keys), bool)
    ends = np.cumsum(lengths + 5)
    for i in range(1, 6):
        inside[(ends - i)[:-1]] = False  # these grams would run into the next text
    return keys[inside], lengths


def word_keys(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lower-cased (A-Z) words of each text, each text's followed by 0, its end, and how many.

    Words are between ASCII white space.  They are hashed eight bytes at a time, all words at once; the
    few long ones one by one.
    """
    data = b"\n" + b"\n".join(texts).lower() + b"\n" * 9
    blank = _BLANK[np.frombuffer(data, np.uint8)]
    starts = np.flatnonzero(blank[:-1] & ~blank[1:]) + 1
    sizes = np.flatnonzero(~blank[:-1] & blank[1:]) + 1 - starts
    wide = np.ndarray(len(data) - 7, "<u8", data, strides=1).astype(np.uint64)
    keys = _mixed(sizes.astype(np.uint64))
    short = np.flatnonzero(sizes <= _LONG)
    for at in range(0, _LONG, 8):
        short = short[sizes[short] > at]
        part = wide[starts[short] + at] & _FIRST[np.minimum(sizes[short] - at, 8)]
        keys[short] = _mixed(keys[short], part)
    for i in np.flatnonzero(sizes > _LONG).tolist():
        keys[i] = xxhash.xxh3_64_intdigest(data[starts[i] : starts[i] + sizes[i]])
    of = np.searchsorted(starts, np.cumsum([1, *[len(t) + 1 for t in texts]]))  # words before each text
    return np.insert(keys, of[1:], np.uint64(0)), np.diff(of) + 1


def tallied(keys: np.ndarray, use: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct grams, and of each how many have ``use``."""
    both = keys << np.uint64(1) | use.astype(np.uint64)  # a gram has 48 bits
    both.sort()
    keys = both >> np.uint64(1)
    firsts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[firsts], np.add.reduceat(both & np.uint64(1), firsts).astype(np.float64)


class Known:
    """The value of each of some distinct keys, for asking about these keys only.

    A slot of a table that one key alone falls on needs no comparison: whoever comes to it is that key.
    Keys that share a slot go to a second table by another hash, and what shares one there is searched for.
    """

    def __init__(self, keys: np.ndarray, values: np.ndarray, tables: int = 2):
        """``keys`` are sorted; ``values`` are not NaN."""
        self.keys, self.values, self.tables = keys, values, tables
        if tables and len(keys):
            self.shift = np.uint64(64 - (4 * len(keys)).bit_length())
            slot, rows = self._slots(keys), np.arange(len(keys), dtype=np.int32)
            last = np.zeros(1 << (64 - int(self.shift)), np.int32)
            last[slot] = rows
            self.table = np.full(len(last), np.nan, values.dtype)
            self.table[slot] = values
            self.table[slot[last[slot] != rows]] = np.nan
            shared = np.isnan(self.table[slot])
            self.others = Known(keys[shared], values[shared], tables - 1)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return (keys * _SPREAD[self.tables - 1] >> self.shift).astype(np.int64)

    def of(self, keys: np.ndarray) -> np.ndarray:
        if not self.tables or not len(self.keys):
            return self.values[np.searchsorted(self.keys, keys)]
        out = self.table[self._slots(keys)]
        open_ = np.flatnonzero(np.isnan(out))
        if len(open_):
            out[open_] = self.others.of(keys[open_])
        return out


class Predictors:
    """Log odds of each bit of the last byte of grams, per context order."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray):
        self.byte = (keys & _MASK).astype(np.int64)
        self.bits = (self.byte[:, None] >> np.arange(7, -1, -1)) & 1
        self.counts = counts.astype(np.float64)
        self.totals, self.ones = [], []
        prefix = (1 << np.arange(8)) | (self.byte[:, None] >> np.arange(8, 0, -1))
        for order in ORDERS:
            context = (keys >> np.uint64(8)) & np.uint64((1 << (8 * order)) - 1)
            node = _mixed(np.repeat(context, 8), prefix.reshape(-1).astype(np.uint64))  # a hashed slot
            slot, _ = pd.factorize(node)
            each = np.repeat(self.counts, 8)
            shape = self.bits.shape
            self.totals.append(np.bincount(slot, each)[slot].reshape(shape))
            self.ones.append(np.bincount(slot, each * self.bits.reshape(-1))[slot].reshape(shape))

    def inputs(self, rows: np.ndarray, without: int) -> tuple[np.ndarray, np.ndarray]:
        """(row, bit, order) log odds, 0 where nothing is known, and (row, bit) gates.

        ``without`` occurrences of the row's own gram are taken out of the counts: 1 in training, so
        that a context is trusted for what it says of other places.
        """
        own = np.minimum(self.counts[rows], without)[:, None]
        odds = np.zeros((len(rows), 8, len(ORDERS)))
        known = np.zeros((len(rows), 8), np.int64)
        for k in range(len(ORDERS)):
            total = self.totals[k][rows] - own
            one = self.ones[k][rows] - own * self.bits[rows]
            odds[:, :, k] = np.where(total > 0, np.log((one + 0.2) / (total - one + 0.2)), 0.0)
            known += total > 0
        return np.clip(odds, -_REACH, _REACH), np.arange(8) * (len(ORDERS) + 1) + known


def _cells(mixed: np.ndarray) -> np.ndarray:
    return np.rint((np.clip(mixed, -_REACH, _REACH) + _REACH) * (_STEPS - 1) / (2 * _REACH)).astype(np.int64)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -15, 15)))


def learn(keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """One online pass over grams, in an order by hash: what to add up over all parts.

    Per gate: occurrences times weights, occurrences, and the ones and all bits per cell of the
    mixed log odds.  Weights move after each block along the gradient of the coding cost.
    """
    known = Predictors(keys, counts)
    seen = np.flatnonzero(counts > 0)
    seen = seen[np.argsort(_mixed(keys[seen]), kind="stable")]
    weights = np.tile([_START[o] for o in ORDERS], (_GATES, 1))
    held, ones, all_ = np.zeros(_GATES), np.zeros(_GATES * _STEPS), np.zeros(_GATES * _STEPS)
    squares = np.full(weights.shape, 1e-3)
    for at in range(0, len(seen), _BLOCK):
        rows = seen[at : at + _BLOCK]
        odds, gates = known.inputs(rows, 1)
        n, bits = np.repeat(known.counts[rows], 8), known.bits[rows].reshape(-1)
        odds, gates = odds.reshape(-1, len(ORDERS)), gates.reshape(-1)
        mixed = (odds * weights[gates]).sum(1)
        cell = gates * _STEPS + _cells(mixed)
        ones += np.bincount(cell, n * bits, len(ones))
        all_ += np.bincount(cell, n, len(all_))
        wrong = n * (bits - _sigmoid(mixed))
        mass = np.bincount(gates, n, _GATES)
        held += mass
        for k in range(len(ORDERS)):
            grad = np.bincount(gates, wrong * odds[:, k], _GATES) / np.maximum(mass, 1)
            squares[:, k] += grad * grad
            weights[:, k] += _RATE * grad / np.sqrt(squares[:, k])
    return np.concatenate([(weights * held[:, None]).reshape(-1), held, ones, all_])


class Mixer:
    """Mean weights of all parts and the refinement table."""

    def __init__(self, sums: np.ndarray):
        n = _GATES * len(ORDERS)
        weights, held = sums[:n].reshape(_GATES, -1), sums[n : n + _GATES, None]
        start = np.tile([_START[o] for o in ORDERS], (_GATES, 1))
        self.weights = np.round(np.where(held > 0, weights / np.maximum(held, 1), start), 6)
        self.ones = sums[n + _GATES : n + _GATES + _GATES * _STEPS]
        self.all = sums[n + _GATES + _GATES * _STEPS :]

    def log10(self, keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """log10 of each gram's last byte given the bytes before it."""
        known, out = Predictors(keys, counts), np.zeros(len(keys))
        for at in range(0, len(keys), _BLOCK):
            rows = np.arange(at, min(at + _BLOCK, len(keys)))
            odds, gates = known.inputs(rows, 0)
            mixed = (odds * self.weights[gates]).sum(2)
            plain, cell = _sigmoid(mixed), gates * _STEPS + _cells(mixed)
            refined = (self.ones[cell] + _TRUST * plain) / (self.all[cell] + _TRUST)
            one = np.clip((plain + refined) / 2, 1e-6, 1 - 1e-6)
            out[rows] = np.log10(np.where(known.bits[rows] == 1, one, 1 - one)).sum(1)
        return out


def _parts(keys: np.ndarray) -> np.ndarray:
    return (_mixed((keys >> np.uint64(8)) & np.uint64(0xFFFF)) >> np.uint64(20)).astype(np.int64) % PARTS


def _split(at: np.ndarray, *columns: np.ndarray):
    """The columns' slices for each value of ``at``."""
    order = np.argsort(at, kind="stable")
    at, columns = at[order], [c[order] for c in columns]
    starts = np.flatnonzero(np.diff(at, prepend=-1))
    for a, b in zip(starts, [*starts[1:], len(at)]):
        yield int(at[a]), [c[a:b] for c in columns]


def _documents(table: pa.Table):
    for chunk in table.to_batches():
        for i, learnt, text in zip(chunk.column("id").to_pylist(), chunk.column("learnt").to_pylist(), chunk.column("text").cast(pa.binary())):
            yield i, learnt, text.as_py() or b""


def _slices(table: pa.Table, most: int = 1 << 20):
    """Documents in lists of about ``most`` bytes."""
    held, size = [], 0
    for doc in _documents(table):
        held.append(doc)
        size += len(doc[2])
        if size >= most:
            yield held
            held, size = [], 0
    if held:
        yield held


def _counted(pieces: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys of several lists, with their counts added up."""
    keys = np.concatenate([np.zeros(0, np.uint64), *[p[0] for p in pieces]])
    if not len(keys):
        return keys, np.zeros(0)
    order = np.argsort(keys, kind="stable")  # merges lists that are sorted already
    keys = keys[order]
    firsts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[firsts], np.add.reduceat(np.concatenate([p[1] for p in pieces])[order].astype(np.float64), firsts)


def text_scores(
    docs: DataFrame,
    learnt: Column,
    id_column: str = "doc_id",
    text_column: str = "text",
    group_bytes: int = GROUP_BYTES,
) -> DataFrame:
    """Per document: id, learnt, n_bytes, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte.

    ``score`` is the log10 probability of the text under a byte model learnt from the rows for which
    ``learnt`` holds.  Each bit is predicted from its place in the byte in hashed contexts of 2 to 5
    bytes; a predictor's log odds come from the counts of its slot.  They are added with weights of
    a gate (bit of the byte, number of known contexts), the sum is refined by a table of what
    happened at that gate and sum, and the two are averaged.  Weights and table adapt in an online
    pass over all learnt occurrences, each seen without itself.  A text has one end after its bytes.

    ``base_score`` is an add-half unigram score over lower-cased words and an end per text.

    1. Documents are dealt into groups of about 8 MB, which send their distinct grams of six bytes
       and distinct words with learnt counts to owners of hash ranges.
    2. Owners add up grams and pass them on by the last two context bytes, so that a part has all
       counts of its contexts.  Parts learn; their sums, of fixed size, are added up and given to
       all parts, which score each gram.
    3. Owners answer each group with one number per gram and word it sent; groups add up by text.

    Everything gathered grows with the corpus and no step holds more than a group, an owner's range
    or a part.  NULL counts as empty: only its end is scored, and bits_per_byte is NULL.  Without
    learnt rows nothing is known: every bit costs one bit.  Rows that repeat give a row each; an
    empty table gives none.
    """
    owners = owners_for(docs) // 2  # a group sends each two rows
    groups = groups_for(docs, text_column, group_bytes)
    dice = F.xxhash64(F.col(id_column), F.octet_length(text_column))
    texts = docs.select(
        F.pmod(dice, F.lit(groups)).cast("int").alias("grp"),
        F.col(id_column).cast("long").alias("id"),
        F.coalesce(learnt, F.lit(False)).alias("learnt"),
        F.col(text_column).alias("text"),
    )

    def read(table: pa.Table) -> tuple[list, list[tuple[np.ndarray, np.ndarray]]]:
        """A group's words by slice, and its distinct grams and words with their learnt counts.

        Words of a slice: how many each text has, the place of each among the slice's distinct ones,
        and these.
        """
        words, found = [], ([], [])
        for held in _slices(table):
            use, texts_ = np.array([d[1] for d in held], bool), [d[2] for d in held]
            keys, sizes = grams(texts_)
            found[_GRAM].append(tallied(keys, np.repeat(use, sizes)))
            keys, sizes = word_keys(texts_)
            slot, some = pd.factorize(keys)
            found[_WORD].append((some, np.bincount(slot, np.repeat(use, sizes), len(some))))
            words.append((sizes, slot.astype(np.int32), some))
        return words, [_counted(f) for f in found]

    def send(key: tuple, table: pa.Table) -> pa.Table:
        rows, grp = [], key[0].as_py()
        for kind, (keys, n) in enumerate(read(table)[1]):
            for owner, _, own, counts in packed(grp, _mixed(keys), owners, np.arange(len(keys))):
                at = np.frombuffer(counts, np.int64)
                rows.append((owner, grp, kind, keys[at].tobytes(), n[at].astype(np.uint32).tobytes()))
        return table_of(rows, _SENT)

    def sums(table: pa.Table, kind: int) -> tuple[np.ndarray, np.ndarray]:
        table = table.filter(pc.equal(table.column("kind"), kind))
        keys, _ = joined(table.column("keys"), np.uint64)
        return _counted([(keys, joined(table.column("n"), np.uint32)[0])])

    def total(key: tuple, table: pa.Table) -> pa.Table:
        keys, n = sums(table, _GRAM)
        return table_of([(p, k.tobytes(), c.tobytes()) for p, (k, c) in _split(_parts(keys), keys, n)], _TOTAL)

    def of_part(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        keys, n = joined(table.column("keys"), np.uint64)[0], joined(table.column("n"), np.float64)[0]
        order = np.argsort(keys)
        return keys[order], n[order]

    def train(key: tuple, table: pa.Table) -> pa.Table:
        return table_of([(learn(*of_part(table)),)], _TRAINED)

    def score(key: tuple, table: pa.Table, trained: pa.Table) -> pa.Table:
        keys, n = of_part(table)
        if not len(keys):
            return table_of([], _SCORED)
        mixer = Mixer(np.array(trained.column("model").to_pylist()[0]))
        logs = mixer.log10(keys, n).astype(np.float32)
        owner = ((_mixed(keys) >> np.uint64(33)) % np.uint64(owners)).astype(np.int64)
        return table_of([(o, k.tobytes(), v.tobytes()) for o, (k, v) in _split(owner, keys, logs)], _SCORED)

    def answer(key: tuple, table: pa.Table, scored: pa.Table) -> pa.Table:
        known, logs = joined(scored.column("keys"), np.uint64)[0], joined(scored.column("logs"), np.float32)[0]
        order = np.argsort(known)
        known, logs, owner = known[order], logs[order], key[0].as_py()
        words, n = sums(table, _WORD)
        rows = []
        for grp, kind, asked in zip(*[table.column(c).to_pylist() for c in ("grp", "kind", "keys")]):
            asked = np.frombuffer(asked, np.uint64)
            if kind == _GRAM:
                out = logs[np.searchsorted(known, asked)]
            else:
                out = n[np.searchsorted(words, asked)].astype(np.int64)
            rows.append((grp, owner, kind, out.tobytes()))
        return table_of(rows, _ANSWER)

    out = pa.schema(
        [("id", pa.int64()), ("learnt", pa.bool_()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64()),
         ("n_known", pa.int64()), ("known", pa.float64()), ("score", pa.float64())]
    )

    def add_up(key: tuple, table: pa.Table, answers: pa.Table) -> pa.Table:
        if not table.num_rows:
            return table_of([], out)
        given = {
            (kind, owner): values
            for owner, kind, values in zip(*[answers.column(c).to_pylist() for c in ("owner", "kind", "logs")])
        }
        by_slice, distinct = read(table)
        values = []
        for kind, (keys, _) in enumerate(distinct):
            held = np.zeros(len(keys), (np.float32, np.int64)[kind])
            for owner, _, _, at in packed(0, _mixed(keys), owners, np.arange(len(keys))):
                held[np.frombuffer(at, np.int64)] = np.frombuffer(given[kind, owner], held.dtype)
            values.append(held)
        logs, counts = Known(distinct[_GRAM][0], values[_GRAM]), values[_WORD]
        rows = []
        for held, (sizes, word, words) in zip(_slices(table), by_slice):
            gram, lengths = grams([d[2] for d in held])
            each = logs.of(gram).astype(np.float64)
            count = counts[np.searchsorted(distinct[_WORD][0], words)]
            starts, at = (np.concatenate([[0], np.cumsum(n)[:-1]]) for n in (lengths, sizes))
            columns = (
                sizes, np.add.reduceat((count > 0).astype(np.int64)[word], at),
                np.add.reduceat(np.log10(count + 0.5)[word], at), np.add.reduceat(each, starts),
            )
            texts_ = [(i, learnt_, len(text)) for i, learnt_, text in held]
            rows += [(*t, *values_) for t, values_ in zip(texts_, zip(*[c.tolist() for c in columns]))]
        return table_of(rows, out)

    by_group = texts.groupBy("grp")
    sent = by_group.applyInArrow(send, "owner int, grp int, kind int, keys binary, n binary")
    by_owner = sent.groupBy("owner")
    totals = by_owner.applyInArrow(total, "part int, keys binary, n binary")
    trained = totals.groupBy("part").applyInArrow(train, "sums array<double>")
    added = trained.select(F.posexplode("sums").alias("pos", "value")).groupBy("pos").agg(F.sum("value").alias("value"))
    model = added.agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "value"))), lambda s: s["value"]).alias("model"))
    given = model.select(F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))).alias("part"), "model")  # a row of fixed size
    scored = totals.groupBy("part").cogroup(given.groupBy("part")).applyInArrow(score, "owner int, keys binary, logs binary")
    answers = by_owner.cogroup(scored.groupBy("owner")).applyInArrow(answer, "grp int, owner int, kind int, logs binary")
    done = by_group.cogroup(answers.groupBy("grp")).applyInArrow(
        add_up, "id long, learnt boolean, n_bytes long, n_tokens long, n_known long, known double, score double"
    )

    def sizes(key: tuple, table: pa.Table) -> pa.Table:
        _, n = sums(table, _WORD)
        return pa.table({"kinds": pa.array([int((n > 0).sum())], pa.int64()), "tokens": pa.array([int(n.sum())], pa.int64())})

    both = by_owner.applyInArrow(sizes, "kinds long, tokens long").agg(
        F.struct(F.coalesce(F.sum("kinds"), F.lit(0)).alias("v"), F.coalesce(F.sum("tokens"), F.lit(0)).alias("n")).alias("b")
    )
    done = done.withColumn("__both", both.scalar())
    each = F.log10(F.col("__both.n") + 0.5 * (F.col("__both.v") + 1))
    return done.select(
        F.col("id").alias(id_column),
        "learnt",
        "n_bytes",
        "n_tokens",
        "n_known",
        F.col("__both.n").alias("train_tokens"),
        (F.col("known") - F.col("n_tokens") * each).alias("base_score"),
        "score",
        F.when(F.col("n_bytes") > 0, -F.col("score") * float(np.log2(10)) / F.col("n_bytes")).alias("bits_per_byte"),
    )
