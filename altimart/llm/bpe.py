"""Byte-level BPE with the tiktoken library and a local rank file."""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from altimart.llm.text import small

_IDS = T.ArrayType(T.IntegerType())
#: Texts above this many characters are cut into pieces of at least this length before encoding.
PIECE = 1 << 16
#: Blank runs from this length on are taken apart here: the library's engine steps back over a run one
#: character at a time and gives up at a million.
RUN = 1 << 12
# The white space of the splitting pattern (Unicode White_Space).
BLANK = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_EDGE = re.compile(f"(?<=[^{BLANK}])(?=[{BLANK}])")
_RUN = re.compile(f"[{BLANK}]{{{RUN},}}")


def pieces(text: str, length: int = PIECE) -> list[str]:
    """The text in pieces, cut only between a non-space and a white-space character.

    The splitting pattern never matches across such a place and looks neither behind nor, at a
    non-space, ahead, so the pieces' matches are the text's matches.  A run without such a place
    stays whole.
    """
    out, start = [], 0
    while len(text) - start > length:
        edge = _EDGE.search(text, start + length)
        if edge is None:
            break
        out.append(text[start : edge.start()])
        start = edge.start()
    return [*out, text[start:]]


def parts(text: str, last: bool) -> Iterator[tuple[str, bool]]:
    """A piece in order as (part, whether it is one match of the pattern).

    The pattern takes a blank run as one match where it ends the text (``last``); before a
    non-space it leaves the run's last blank, which begins what follows.  Long runs are cut there.
    """
    start = 0
    for run in _RUN.finditer(text):
        end = run.end() if run.end() == len(text) and last else run.end() - 1
        if run.start() > start:
            yield text[start : run.start()], False
        yield text[run.start() : end], True
        start = end
    if start < len(text):
        yield text[start:], False


def token_ids(tokenizer: tiktoken.Encoding, text: str) -> list[np.ndarray]:
    """The ids of a text of any length, in some arrays."""
    out, cut = [], pieces(text)
    for n, piece in enumerate(cut):
        # a piece that is not the last is followed by a blank, so a run cannot end it
        for part, one in parts(piece, n == len(cut) - 1):
            ids = tokenizer._encode_single_piece(part) if one else tokenizer.encode_ordinary(part)
            out.append(np.array(ids, np.int32))
    return out


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def encoding(ranks: dict[bytes, int], pattern: str) -> tiktoken.Encoding:
    return tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def _with(batch: pa.RecordBatch, name: str, values: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*batch.columns, values], [*batch.schema.names, name])


def encode(
    docs: DataFrame, ranks_path: str, pattern: str, text_column: str = "text", ids_column: str = "ids"
) -> DataFrame:
    """All columns and the token ids of the text, ``array<int>``; NULL or empty text: no ids.

    ``pattern`` is one that takes white space apart as described in ``pieces`` and ``parts``.  No special
    tokens: their strings are ordinary text.  Texts of any length, long runs of one character included.
    Repeated rows get equal ids; an empty table gives no rows.  A column named like the result is an
    error.  The rank file is read on the driver and broadcast; its size is that of one vocabulary.  One
    narrow pass, nothing is shuffled.
    """
    ranks = docs.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))
    run = _encoder(ranks, pattern, text_column, ids_column)
    return docs.mapInArrow(run, _plus(docs.schema, ids_column, _IDS))


def _encoder(ranks: Broadcast, pattern: str, text_column: str, ids_column: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = encoding(ranks.value, pattern)
        for batch in small(batches, text_column):
            ids, sizes = [np.zeros(0, np.int32)], [0]
            for text in batch.column(text_column).to_pylist():
                own = token_ids(tokenizer, text or "")
                ids += own
                sizes.append(sum(map(len, own)))
            ends = np.cumsum(sizes, dtype=np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids)))
            yield _with(batch, ids_column, lists)

    return run


def decode(
    docs: DataFrame, ranks_path: str, ids_column: str = "ids", bytes_column: str = "decoded"
) -> DataFrame:
    """All columns and the raw bytes of the ids; any id sequence has bytes, valid text or not.

    NULL ids give no bytes; an id outside the vocabulary is an error.  Repeated rows give equal
    bytes, an empty table no rows; a column named like the result is an error.
    """
    ranks = docs.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))
    return docs.mapInArrow(_decoder(ranks, ids_column, bytes_column), _plus(docs.schema, bytes_column, T.BinaryType()))


def round_trip(
    docs: DataFrame, ranks_path: str, pattern: str, text_column: str = "text", ids_column: str = "ids",
    bytes_column: str = "decoded",
) -> DataFrame:
    """``decode(encode(docs))`` in one pass by one Python worker a task, with one copy of the ranks."""
    ranks = docs.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))
    encode_, decode_ = _encoder(ranks, pattern, text_column, ids_column), _decoder(ranks, ids_column, bytes_column)
    schema = _plus(_plus(docs.schema, ids_column, _IDS), bytes_column, T.BinaryType())
    return docs.mapInArrow(lambda batches: decode_(encode_(batches)), schema)


def _decoder(ranks: Broadcast, ids_column: str, bytes_column: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = {rank: token for token, rank in ranks.value.items()}.__getitem__
        for batch in small(batches, ids_column, 1 << 20):
            lists = batch.column(ids_column)
            out = [b"".join(map(tokens, ids or ())) for ids in lists.to_pylist()]
            yield _with(batch, bytes_column, pa.array(out, pa.binary()))

    return run


def _plus(schema: T.StructType, name: str, kind: T.DataType) -> T.StructType:
    if name in schema.names:
        raise ValueError(f"column {name!r} exists; give the result another name")
    return T.StructType([*schema.fields, T.StructField(name, kind)])
