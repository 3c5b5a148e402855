"""Words and their hashes, for code that runs inside tasks on Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

_MIX = np.uint64(0x9E3779B97F4A7C15)
_SHIFT = np.uint64(29)


def small(batches: Iterator[pa.RecordBatch], column: str, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``most`` bytes of text (or list values), or of one row.

    Python objects take many times the room of Arrow's, so few texts are unpacked at a time.
    """
    for batch in batches:
        values = batch.column(column)
        count = pc.list_value_length if pa.types.is_list(values.type) else pc.binary_length
        ends = np.cumsum(count(values).fill_null(0).to_numpy(zero_copy_only=False))
        start = 0
        while start < len(ends):
            before = ends[start - 1] if start else 0
            end = max(int(np.searchsorted(ends, before + most, "right")), start + 1)
            yield batch.slice(start, end - start)
            start = end


def raw_texts(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of every text; NULL is empty."""
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


class Remembered(dict):
    """Results of a function of one key, kept up to a number of keys and then begun anew."""

    def __init__(self, make, most: int = 300_000):
        super().__init__()
        self.make, self.most = make, most

    def __missing__(self, key):
        if len(self) >= self.most:
            self.clear()
        self[key] = value = self.make(key)
        return value


def word_hashes(words: list[bytes], remembered: Remembered) -> np.ndarray:
    return np.fromiter(map(remembered.__getitem__, words), np.uint64, len(words))


def hashed_words(words: list[bytes]) -> np.ndarray:
    """The same hashes without a memory: cheaper where many words are met once or twice."""
    return np.frombuffer(b"".join(map(xxhash.xxh3_64_digest, words)), ">u8").astype(np.uint64)


def hash_memory() -> Remembered:
    return Remembered(xxhash.xxh3_64_intdigest)


def runs(hashes: np.ndarray, width: int) -> np.ndarray:
    """A 64-bit hash of every ``width`` consecutive entries, in order."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(n, width, np.uint64)
    for i in range(width):
        out = (out ^ hashes[i : i + n]) * _MIX
        out ^= out >> _SHIFT
    return out


def runs_at(hashes: np.ndarray, width: int, starts: np.ndarray, backwards: bool = False) -> np.ndarray:
    """``runs`` at some places only, or those of the entries read ``backwards``."""
    out = np.full(len(starts), width, np.uint64)
    for i in reversed(range(width)) if backwards else range(width):
        out = (out ^ hashes[starts + i]) * _MIX
        out ^= out >> _SHIFT
    return out


def distinct(values: np.ndarray) -> np.ndarray:
    """``np.unique`` of numbers by sorting them, which takes a tenth of the time of its hashing."""
    if len(values) < 2:
        return values.copy()
    ordered = np.sort(values)
    first = np.ones(len(ordered), bool)
    np.not_equal(ordered[1:], ordered[:-1], out=first[1:])
    return ordered[first]


def shingle_set(words: list[bytes], width: int, remembered: Remembered) -> np.ndarray:
    """Sorted hashes of the distinct ``width``-word shingles; of fewer words, of all as one."""
    if not words:
        return np.zeros(0, np.uint64)
    return distinct(runs(word_hashes(words, remembered), min(width, len(words))))
