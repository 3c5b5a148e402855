"""Toxicity categories by a chain of linear classifiers."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from altimart.llm.fitting import fit_in_task, sampled, with_texts
from altimart.llm.text import Remembered, small

#: Labelled rows learnt from at most, with and without the last category of the chain.
POSITIVE, NEGATIVE = 1500, 2500
BUCKETS = 1 << 22
SHORTEST, LONGEST = 3, 6
#: A feature counts for a category if at least so many documents have it and its log odds stand
#: this many standard errors from zero.
SUPPORT, SURE = 3, 2.5
FOLDS, STEPS, RATE, PENALTY = 3, 150, 0.3, 1e-3
_WORD = re.compile(r"[^\W_]+")


def features(word: str) -> list[int]:
    """Buckets of a word and of its beginnings; a word's other parts say little and are many."""
    marked = f"<{word}>"
    parts = {marked, *(marked[: n + 1] for n in range(SHORTEST, LONGEST + 1))}
    return [xxhash.xxh32_intdigest(p) % BUCKETS for p in parts]


def words(text: str | None) -> set[str]:
    return set(_WORD.findall((text or "").lower()))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _select(docs: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
    """Features whose share differs between the classes beyond chance, sorted."""
    flat = np.concatenate([np.zeros(0, np.int64), *docs])
    of = np.repeat(labels, [len(d) for d in docs])
    ids, place = np.unique(flat, return_inverse=True)
    with_, all_ = np.bincount(place, of, len(ids)), np.bincount(place, minlength=len(ids))
    without, n1 = all_ - with_, max(labels.sum(), 1)
    n0 = max(len(labels) - labels.sum(), 1)
    odds = np.log((with_ + 0.5) / (n1 - with_ + 0.5)) - np.log((without + 0.5) / (n0 - without + 0.5))
    error = np.sqrt(1 / (with_ + 0.5) + 1 / (n1 - with_ + 0.5) + 1 / (without + 0.5) + 1 / (n0 - without + 0.5))
    return ids[(all_ >= SUPPORT) & (np.abs(odds) > SURE * error)]


class Linear:
    """Logistic regression on selected binary features and a few dense columns."""

    def __init__(self, docs: list[np.ndarray], dense: np.ndarray, labels: np.ndarray):
        self.ids = _select(docs, labels)
        rows, columns = self._matrix(docs)
        share = np.clip(labels.mean() if len(labels) else 0.5, 0.01, 0.99)
        self.weights, self.dense = np.zeros(len(self.ids)), np.zeros(dense.shape[1])
        self.bias = float(np.log(share / (1 - share)))
        squares = [np.full(len(self.ids), 1e-6), np.full(dense.shape[1], 1e-6), 1e-6]
        for _ in range(STEPS):
            wrong = (_sigmoid(self._sum(rows, columns, len(docs), dense)) - labels) / max(len(docs), 1)
            grad = np.bincount(columns, wrong[rows], len(self.ids)) + PENALTY * self.weights / 10
            grads = [grad, dense.T @ wrong + PENALTY * self.dense, wrong.sum()]
            squares = [s + g * g for s, g in zip(squares, grads)]
            moves = [RATE * g / np.sqrt(s) for s, g in zip(squares, grads)]
            self.weights, self.dense = self.weights - moves[0], self.dense - moves[1]
            self.bias -= float(moves[2])

    def _matrix(self, docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        flat = np.concatenate([np.zeros(0, np.int64), *docs])
        rows = np.repeat(np.arange(len(docs)), [len(d) for d in docs])
        if not len(self.ids):
            return rows[:0], rows[:0]
        place = np.minimum(np.searchsorted(self.ids, flat), len(self.ids) - 1)
        known = self.ids[place] == flat
        return rows[known], place[known]

    def _sum(self, rows, columns, n, dense) -> np.ndarray:
        return np.bincount(rows, self.weights[columns], n) + dense @ self.dense + self.bias

    def probability(self, docs: list[np.ndarray], dense: np.ndarray) -> np.ndarray:
        return _sigmoid(self._sum(*self._matrix(docs), len(docs), dense))


def fit_chain(docs: list[np.ndarray], labels: np.ndarray, folds: np.ndarray) -> list[Linear]:
    """One model per column of ``labels``, in order.

    A later model sees the earlier categories as probabilities that were predicted for each row by
    models fitted without that row's fold, as it will see them in use: from a model that has not
    seen the text.
    """
    chain, fed = [], np.zeros((len(docs), 0))
    for k in range(labels.shape[1]):
        target = labels[:, k].astype(float)
        chain.append(Linear(docs, fed, target))
        held = np.zeros(len(docs))
        for f in range(FOLDS):
            inside, outside = np.flatnonzero(folds != f), np.flatnonzero(folds == f)
            part = Linear([docs[i] for i in inside], fed[inside], target[inside])
            held[outside] = part.probability([docs[i] for i in outside], fed[outside])
        fed = np.column_stack([fed, held])
    return chain


def run_chain(chain: list[Linear], docs: list[np.ndarray]) -> np.ndarray:
    fed = np.zeros((len(docs), 0))
    for model in chain:
        fed = np.column_stack([fed, model.probability(docs, fed)])
    return fed


def _ids(text: str | None, memory: Remembered) -> np.ndarray:
    found: set[int] = set()
    for word in words(text):
        found.update(memory[word])
    return np.array(sorted(found), np.int64)


def train(
    docs: DataFrame,
    labels: DataFrame,
    categories: Sequence[str],
    id_column: str = "doc_id",
    text_column: str = "text",
    derived: dict[str, Column] | None = None,
) -> list[Linear]:
    """A chain over ``categories`` from at most ``POSITIVE + NEGATIVE`` labelled rows.

    Categories are 0/1 columns of ``labels``, or expressions in ``derived`` over these and the text
    (``__text``), e.g. one kind of toxicity told by its words.  Rows with a NULL category are left
    out.  The sample takes rows with and without the last category apart, each by a hash of the id.
    """
    derived = derived or {}
    given = [c for c in categories if c not in derived]
    rows = labels.select(id_column, *[F.col(c).cast("int").alias(c) for c in given]).dropna(subset=given)
    last = F.col(given[-1]) == 1
    chosen = sampled(rows.where(last), id_column, POSITIVE).unionByName(sampled(rows.where(~last), id_column, NEGATIVE))
    sample = with_texts(docs, chosen, id_column, text_column)
    sample = sample.withColumns({name: F.coalesce(c.cast("int"), F.lit(0)) for name, c in derived.items()})
    sample = sample.withColumn("fold", F.pmod(F.xxhash64(id_column, F.lit(23)), F.lit(FOLDS)).cast("int"))

    def fit(table: pa.Table) -> list[Linear]:
        memory = Remembered(features)
        texts = [_ids(t, memory) for t in table.column("__text").to_pylist()]
        targets = np.column_stack([table.column(c).to_numpy() for c in categories])
        return fit_chain(texts, targets, table.column("fold").to_numpy())

    return fit_in_task(sample, fit) or []


def score(
    docs: DataFrame, chain: list[Linear], categories: Sequence[str], text_column: str = "text"
) -> DataFrame:
    """All columns and ``p_<category>`` for each category, along the chain.

    Whole texts; a NULL or empty text has no features and gets the biases.  Without a model, where
    nothing was labelled, every probability is 0.  The models hold selected features only and are
    broadcast; their size is bounded by the training sample.  One narrow pass.
    """
    names = [f"p_{c}" for c in categories]
    if set(names) & set(docs.columns):
        raise ValueError(f"columns {names} exist; rename them")
    shipped = docs.sparkSession.sparkContext.broadcast(chain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models = shipped.value
        useful = {int(i) for m in models for i in m.ids}
        memory = Remembered(lambda word: [i for i in features(word) if i in useful])
        for batch in small(batches, text_column):
            ids = [_ids(t, memory) for t in batch.column(text_column).to_pylist()]
            found = run_chain(models, ids) if models else np.zeros((len(ids), len(names)))
            added = [pa.array(found[:, k], pa.float64()) for k in range(len(names))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], [*batch.schema.names, *names])

    extra = [T.StructField(n, T.DoubleType()) for n in names]
    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, *extra]))
