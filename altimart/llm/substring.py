"""Exact repeats of word passages across documents, found from fixed-block anchors."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from altimart.llm.routing import grouped, groups_for, joined, owners_for, owners_of, packed, table_of
from altimart.llm.text import hashed_words, runs, runs_at

WINDOW = 13
_SENT = pa.schema([("owner", pa.int32()), ("grp", pa.int32()), ("low", pa.binary()), ("kind", pa.binary())])
_FOUND = pa.schema([("grp", pa.int32()), ("owner", pa.int32()), ("low", pa.binary())])
_RUNS = pa.schema([("owner", pa.int32()), ("grp", pa.int32()), ("run", pa.binary()), ("check", pa.binary()), ("first", pa.binary()), ("last", pa.binary())])
_FIRST = pa.schema([("grp", pa.int32()), ("run", pa.binary()), ("first", pa.binary())])
_NEVER, _ALWAYS = np.iinfo(np.int64).max, np.iinfo(np.int64).min
_LAST = np.uint64((1 << 22) - 1)
_BLOCK, _TWICE = 1, 2  # what a group says of a hash: it starts a block; several documents have it


def _texts(table: pa.Table):
    """(id, words) per document, one at a time."""
    for chunk in table.to_batches():
        for i, text in zip(chunk.column("id").to_pylist(), chunk.column("text").cast(pa.binary())):
            yield i, (text.as_py() or b"").split()


def _low(hashes: np.ndarray) -> np.ndarray:
    return (hashes & np.uint64(0xFFFFFFFF)).astype(np.uint32)


def _marks(hashes: np.ndarray) -> np.ndarray:
    """Which last bits some hash has: most others are told from these by one look, without a search."""
    marks = np.zeros(int(_LAST) + 1, bool)
    marks[hashes & _LAST] = True
    return marks


def repeated_passages(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    window: int = WINDOW,
) -> DataFrame:
    """Per document: id, n_words, spans (start, length) of words to remove, kept text.

    A run of ``window`` words is removed where the same run starts in a document with a smaller id.

    1. Anchors: every document is cut into blocks of (window + 1) / 2 words; any run of ``window``
       words holds one whole block of its document.  The blocks are indexed by hash range and
       probed with every rolling window of that length of all documents.  Groups of documents send
       distinct hashes (four bytes and a mark each); an owner of a range reports the hashes that
       were found in a block of another document, to both sides.
    2. Extension: only around reported anchors, groups send the hashes of the ``window``-word runs
       with the smallest id that has them.  Owners find the smallest id of all.  96 bits of hash
       stand for a run.
    3. The runs whose smallest id is below the document's own cover words; adjoining and overlapping
       ones join to maximal repeats, the spans.

    Words are separated by ASCII white space and compared as they are; kept words are joined by one
    space.  A NULL, empty or blank text has no words.  Documents with fewer than ``window`` words
    keep all.  Rows with equal ids do not count as smaller than each other; a NULL id is neither
    smaller nor larger than another.  Repeated rows each give a row; an empty table gives none.
    """
    block = (window + 1) // 2
    owners = owners_for(docs)
    texts = grouped(docs, id_column, text_column, groups_for(docs, text_column))

    def send(key: tuple, table: pa.Table) -> pa.Table:
        all_, starts, doc_of = [], [], []
        for n, (_, words) in enumerate(_texts(table)):
            if len(words) >= window:
                rolling = runs(hashed_words(words), block)
                mark = np.zeros(len(rolling), np.uint8)
                mark[::block] = _BLOCK
                all_.append(rolling), starts.append(mark), doc_of.append(np.full(len(rolling), n, np.int32))
        if not all_:
            return table_of([], _SENT)
        hashes, mark, doc = np.concatenate(all_), np.concatenate(starts), np.concatenate(doc_of)
        order = np.argsort(hashes)
        hashes, mark, doc = hashes[order], mark[order], doc[order]
        at = np.flatnonzero(np.diff(hashes, prepend=~hashes[:1]))
        mark = np.bitwise_or.reduceat(mark, at)
        mark[np.minimum.reduceat(doc, at) != np.maximum.reduceat(doc, at)] |= _TWICE
        own = hashes[at]
        rows = packed(key[0].as_py(), own, owners, _low(own), mark)
        return table_of([(o, g, low, m) for o, g, _, low, m in rows], _SENT)

    def find(key: tuple, table: pa.Table) -> pa.Table:
        low, row = joined(table.column("low"), np.uint32)
        mark, _ = joined(table.column("kind"), np.uint8)
        order = np.argsort(low)
        low, row, mark = low[order], row[order], mark[order]
        if not len(low):
            return table_of([], _FOUND)
        at = np.flatnonzero(np.diff(low, prepend=~low[:1]))
        sizes = np.diff(np.append(at, len(low)))
        blocks = np.repeat(np.add.reduceat((mark & _BLOCK).astype(np.int64), at), sizes)
        many = np.repeat(sizes, sizes) > 1
        hit = (blocks > 0) & (many | (mark & _TWICE > 0))
        low, row = low[hit], row[hit]
        order = np.argsort(row, kind="stable")
        low, row = low[order], row[order]
        names, owner = table.column("grp").to_pylist(), key[0].as_py()
        at = np.flatnonzero(np.diff(row, prepend=-1))
        return table_of(
            [(names[row[a]], owner, low[a:b].tobytes()) for a, b in zip(at, [*at[1:], len(row)])], _FOUND
        )

    def anchors(table: pa.Table) -> np.ndarray:
        low, row = joined(table.column("low"), np.uint32)
        owner = np.array(table.column("owner").to_pylist(), np.uint64)
        return np.unique(owner[row] << np.uint64(32) | low.astype(np.uint64))

    def candidates(hashes: np.ndarray, found: np.ndarray, marks: np.ndarray) -> np.ndarray:
        """Starts of the runs that hold an anchor."""
        rolling = runs(hashes, block)
        look = np.flatnonzero(marks[rolling & _LAST])
        some = rolling[look]
        names = owners_of(some, owners).astype(np.uint64) << np.uint64(32) | _low(some).astype(np.uint64)
        place = np.minimum(np.searchsorted(found, names), len(found) - 1)
        anchored = np.zeros(len(rolling), bool)
        anchored[look[found[place] == names]] = True
        sums = np.concatenate([[0], np.cumsum(anchored)])
        span = window - block + 1
        return np.flatnonzero(sums[span:] > sums[:-span])

    def extend(key: tuple, table: pa.Table, replies: pa.Table) -> pa.Table:
        found = anchors(replies)
        marks = _marks(found)
        run_, check_, id_ = [], [], []
        for i, words in _texts(table) if len(found) else ():
            if len(words) >= window and i is not None:
                hashes = hashed_words(words)
                starts = candidates(hashes, found, marks)
                run_.append(runs_at(hashes, window, starts))
                check_.append(_low(runs_at(hashes, window, starts, backwards=True)))
                id_.append(np.full(len(starts), i, np.int64))
        if not run_:
            return table_of([], _RUNS)
        run, check, id_ = np.concatenate(run_), np.concatenate(check_), np.concatenate(id_)
        if not len(run):
            return table_of([], _RUNS)
        order = np.lexsort((id_, check, run))
        run, check, id_ = run[order], check[order], id_[order]
        new = np.flatnonzero((np.diff(run, prepend=~run[:1]) != 0) | (np.diff(check, prepend=~check[:1]) != 0))
        last = id_[np.append(new[1:], len(run)) - 1]
        return table_of(list(packed(key[0].as_py(), run[new], owners, check[new], id_[new], last)), _RUNS)

    def first(key: tuple, table: pa.Table) -> pa.Table:
        run, row = joined(table.column("run"), np.uint64)
        check, _ = joined(table.column("check"), np.uint32)
        low, _ = joined(table.column("first"), np.int64)
        high, _ = joined(table.column("last"), np.int64)
        if not len(run):
            return table_of([], _FIRST)
        order = np.lexsort((check, run))
        run, check, low, high, row = run[order], check[order], low[order], high[order], row[order]
        new = np.flatnonzero((np.diff(run, prepend=~run[:1]) != 0) | (np.diff(check, prepend=~check[:1]) != 0))
        least = np.repeat(np.minimum.reduceat(low, new), np.diff(np.append(new, len(run))))
        hit = high > least
        run, least, row = run[hit], least[hit], row[hit]
        order = np.argsort(row, kind="stable")
        run, least, row = run[order], least[order], row[order]
        names, at = table.column("grp").to_pylist(), np.flatnonzero(np.diff(row, prepend=-1))
        return table_of(
            [(names[row[a]], run[a:b].tobytes(), least[a:b].tobytes()) for a, b in zip(at, [*at[1:], len(row)])],
            _FIRST,
        )

    out = pa.schema(
        [
            (id_column, pa.int64()), ("n_words", pa.int64()),
            ("spans", pa.list_(pa.struct([("start", pa.int32()), ("length", pa.int32())]))), ("kept", pa.string()),
        ]
    )

    def remove(key: tuple, table: pa.Table, replies: pa.Table) -> pa.Table:
        run, _ = joined(replies.column("run"), np.uint64)
        least, _ = joined(replies.column("first"), np.int64)
        order = np.argsort(run, kind="stable")
        run, least, rows = run[order], least[order], []
        marks = _marks(run)
        for i, words in _texts(table):
            spans, kept = [], words
            if len(run) and len(words) >= window and i is not None:
                own = runs(hashed_words(words), window)
                look = np.flatnonzero(marks[own & _LAST])
                place = np.minimum(np.searchsorted(run, own[look]), len(run) - 1)
                starts = look[(run[place] == own[look]) & (least[place] < i)]
                change = np.zeros(len(words) + 1, np.int32)
                np.add.at(change, starts, 1)
                np.add.at(change, starts + window, -1)
                covered = np.cumsum(change[:-1]) > 0
                edges = np.flatnonzero(np.diff(covered.astype(np.int8), prepend=0, append=0))
                spans = [{"start": int(a), "length": int(b - a)} for a, b in zip(edges[::2], edges[1::2])]
                kept = [w for w, gone in zip(words, covered.tolist()) if not gone] if spans else words
            rows.append((i, len(words), spans, b" ".join(kept).decode("utf-8", "replace")))
        return table_of(rows, out)

    def ddl(schema: pa.Schema) -> str:
        kinds = {pa.int32(): "int", pa.int64(): "long", pa.binary(): "binary"}
        return ", ".join(f"{f.name} {kinds[f.type]}" for f in schema)

    by_group = texts.groupBy("grp")
    sent = by_group.applyInArrow(send, ddl(_SENT))
    found = sent.groupBy("owner").applyInArrow(find, ddl(_FOUND))
    runs_ = by_group.cogroup(found.groupBy("grp")).applyInArrow(extend, ddl(_RUNS))
    least = runs_.groupBy("owner").applyInArrow(first, ddl(_FIRST))
    return by_group.cogroup(least.groupBy("grp")).applyInArrow(
        remove,
        f"{id_column} long, n_words long, spans array<struct<start:int,length:int>>, kept string",
    )
