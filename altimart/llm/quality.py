"""A text-quality classifier on averaged hashed word and character n-gram vectors."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from altimart.llm.fitting import fit_in_task, sampled, with_texts
from altimart.llm.text import raw_texts, small

#: Labelled documents learnt from at most.
SAMPLE = 3000
BUCKETS, DIMENSIONS = 1 << 17, 8
SHORTEST, LONGEST = 3, 5
EPOCHS, BATCH, RATE = 4, 32, 0.3
#: Words whose odds a task remembers.
REMEMBERED = 300_000
_MIX, _SHIFT = np.uint64(0x9E3779B97F4A7C15), np.uint64(29)


#: Stands in a text's words once for each word that repeats the one before it.
AGAIN = b"\x00"


def tokens(text: bytes) -> list[bytes]:
    words = text.split()
    return words + [AGAIN] * sum(map(bytes.__eq__, words, words[1:]))


def features(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of words and of their character n-grams, marked at both ends, and whose each is."""
    marked = [b"<" + w + b">" for w in words]
    sizes = np.array([len(m) for m in marked], np.int64)
    data = np.frombuffer(b"".join(marked), np.uint8).astype(np.uint64)
    owner, ends = np.repeat(np.arange(len(words)), sizes), np.cumsum(sizes)
    ids = [np.array([xxhash.xxh32_intdigest(m) for m in marked], np.int64) % BUCKETS]
    of = [np.arange(len(words))]
    for n in range(SHORTEST, LONGEST + 1):
        last = len(data) - n + 1
        if last <= 0:
            continue
        value = np.full(last, n, np.uint64)
        for i in range(n):
            value = (value ^ data[i : last + i]) * _MIX
            value ^= value >> _SHIFT
        inside = np.arange(n, n + last) <= ends[owner[:last]]
        ids.append((value[inside] % np.uint64(BUCKETS)).astype(np.int64))
        of.append(owner[:last][inside])
    return np.concatenate(ids), np.concatenate(of)


def word_odds(words: list[bytes], odds: np.ndarray) -> list[float]:
    """The mean over each word's buckets."""
    ids, of = features(words)
    return (np.bincount(of, odds[ids], len(words)) / np.bincount(of, minlength=len(words))).tolist()


def fit(sample: pa.Table) -> tuple[np.ndarray, float]:
    """A number per bucket and a bias: the softmax of two classes folded into one log odds.

    Word vectors are means of bucket vectors and documents are means of word vectors.  Mini-batch
    stochastic gradient descent with per-value step sizes, seeded, over rows in a fixed order.
    """
    labels = np.array(sample.column("label").to_pylist(), int)
    index: dict[bytes, int] = {}
    docs = []
    for text in raw_texts(sample.column("__text").combine_chunks()):
        ids = np.array([index.setdefault(w, len(index)) for w in tokens(text)], np.int64)
        docs.append(np.unique(ids, return_counts=True))
    ids, of = features(list(index))
    order = np.argsort(of, kind="stable")
    ids, sizes_ = ids[order], np.bincount(of, minlength=len(index))
    of_word = np.split(ids, np.cumsum(sizes_)[:-1]) if len(index) else []
    rng = np.random.default_rng(5)
    vectors = rng.uniform(-0.5, 0.5, (BUCKETS, DIMENSIONS)) / DIMENSIONS
    out, bias = np.zeros((DIMENSIONS, 2)), np.zeros(2)
    seen = np.full((BUCKETS, DIMENSIONS), 1e-6), np.full(out.shape, 1e-6), np.full(2, 1e-6)

    def step(values, grad, squares):
        squares += grad * grad
        values -= RATE * grad / np.sqrt(squares)

    for _ in range(EPOCHS):
        order = rng.permutation(len(docs))
        for at in range(0, len(order), BATCH):
            chosen = order[at : at + BATCH]
            used = np.unique(np.concatenate([docs[d][0] for d in chosen]))
            if not len(used):
                continue
            parts = [of_word[w] for w in used]
            sizes = np.array([len(p) for p in parts])
            flat = np.concatenate(parts)
            starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            means = np.add.reduceat(vectors[flat], starts) / sizes[:, None]
            weights = np.zeros((len(chosen), len(used)))
            for row, d in enumerate(chosen):
                ids, n = docs[d]
                weights[row, np.searchsorted(used, ids)] = n / max(n.sum(), 1)
            hidden = weights @ means
            logits = hidden @ out + bias
            share = np.exp(logits - logits.max(1, keepdims=True))
            share /= share.sum(1, keepdims=True)
            share[np.arange(len(chosen)), labels[chosen]] -= 1
            share /= len(chosen)
            back = np.repeat((weights.T @ (share @ out.T)) / sizes[:, None], sizes, axis=0)
            touched, place = np.unique(flat, return_inverse=True)
            grad = np.stack([np.bincount(place, back[:, k]) for k in range(DIMENSIONS)], 1)
            squares = seen[0][touched] + grad * grad
            seen[0][touched] = squares
            vectors[touched] -= RATE * grad / np.sqrt(squares)
            step(out, hidden.T @ share, seen[1])
            step(bias, share.sum(0), seen[2])
    odds = out[:, 1] - out[:, 0]
    return (vectors @ odds).astype(np.float32), float(bias[1] - bias[0])


def train(
    docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    label_column: str = "quality",
) -> tuple[np.ndarray, float]:
    """The model of at most ``SAMPLE`` labelled rows, fitted in one task; neutral without labels."""
    rows = labels.where(F.col(label_column).isin(0, 1)).select(id_column, F.col(label_column).cast("int").alias("label"))
    sample = with_texts(docs, sampled(rows, id_column, SAMPLE), id_column, text_column)
    return fit_in_task(sample, fit) or (np.zeros(BUCKETS, np.float32), 0.0)


def score(docs: DataFrame, model: tuple[np.ndarray, float], text_column: str = "text") -> DataFrame:
    """All columns and ``score``, the likelihood of label 1.

    Whole texts; a NULL or empty text, or one of white space, gets the bias alone.  The model of
    fixed size is broadcast.  One narrow pass.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        odds, bias = shipped.value
        memory: dict[bytes, float] = {}
        for batch in small(batches, text_column):
            texts, out = [tokens(t) for t in raw_texts(batch.column(text_column))], []
            fresh = list(set().union(*texts) - memory.keys())
            if fresh:
                if len(memory) + len(fresh) > REMEMBERED:
                    memory.clear()
                    fresh = list(set().union(*texts))
                memory.update(zip(fresh, word_odds(fresh, odds)))
            for words in texts:
                mean = sum(map(memory.__getitem__, words)) / len(words) if words else 0.0
                out.append(1 / (1 + math.exp(-min(max(mean + bias, -30.0), 30.0))))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.float64())], [*batch.schema.names, "score"])

    if "score" in docs.columns:
        raise ValueError("column 'score' exists; rename it")
    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField("score", T.DoubleType())]))
