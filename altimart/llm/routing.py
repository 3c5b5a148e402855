"""Packed exchanges between groups of documents and owners of hash ranges.

Documents are dealt into groups of a few megabytes of text.  A group sends each owner one row of
packed hashes; an owner answers each group with one row.  Per hash this takes a few bytes instead of
a row, and equal hashes of a group are sent once, so a passage in a third of all documents costs its
owner one entry per group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from altimart.llm.common import total_of

GROUP_BYTES = 4 << 20


def owners_for(docs: DataFrame) -> int:
    """How many hash ranges: two per shuffle partition.

    A group sends a row to each, so rows grow with the number of groups, not with its square.
    """
    return 2 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def groups_for(docs: DataFrame, text_column: str, group_bytes: int = GROUP_BYTES) -> int:
    """How many groups: texts of ``group_bytes`` each, but two per shuffle partition at least."""
    return max(owners_for(docs), total_of(docs, F.sum(F.octet_length(text_column))) // group_bytes)


def grouped(docs: DataFrame, id_column: str, text_column: str, groups: int, *more: Column) -> DataFrame:
    """(grp, id, text) and ``more``; rows with equal ids may fall into different groups."""
    dice = F.xxhash64(F.col(id_column), F.octet_length(text_column))
    return docs.select(
        F.pmod(dice, F.lit(groups)).cast("int").alias("grp"),
        F.col(id_column).cast("long").alias("id"),
        F.col(text_column).alias("text"),
        *more,
    )


def owners_of(hashes: np.ndarray, owners: int) -> np.ndarray:
    return ((hashes >> np.uint64(33)) % np.uint64(owners)).astype(np.int64)


def packed(group: int, hashes: np.ndarray, owners: int, *more: np.ndarray) -> Iterator[tuple]:
    """(owner, group, bytes of the owner's hashes, bytes of each further array)."""
    at = owners_of(hashes, owners)
    order = np.argsort(at, kind="stable")
    at, columns = at[order], [c[order] for c in (hashes, *more)]
    starts = np.flatnonzero(np.diff(at, prepend=-1))
    for start, end in zip(starts, [*starts[1:], len(at)]):
        yield (int(at[start]), group, *[c[start:end].tobytes() for c in columns])


def table_of(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    columns = list(zip(*rows)) if rows else [[] for _ in schema]
    return pa.table([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def joined(column: pa.ChunkedArray, dtype) -> tuple[np.ndarray, np.ndarray]:
    """All values of packed rows, and the row of each value."""
    parts = [np.frombuffer(b, dtype) for b in column.to_pylist()]
    sizes = [len(p) for p in parts]
    return np.concatenate([np.zeros(0, dtype), *parts]), np.repeat(np.arange(len(parts)), sizes)
