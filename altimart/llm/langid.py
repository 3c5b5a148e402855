"""Language identification by known words first, shorter and shorter character n-grams after."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from altimart.llm.common import cut
from altimart.llm.fitting import with_texts
from altimart.llm.text import runs, small

UNKNOWN = "und"
#: Labelled documents learnt from per language, about: the bound of the broadcast model, which holds
#: every word and n-gram of these.
SAMPLE = 2000
LONGEST = 5
#: Added to each count.  A word met once must say more than how much was learnt of each language.
SMOOTH = 0.05
#: Words whose log frequencies a task remembers.
REMEMBERED = 200_000
_WORD = re.compile(r"[^\W\d_]+")


def words(text: str | None) -> list[str]:
    """Lower-cased runs of letters."""
    found = _WORD.findall((text or "").lower())
    if all(map(str.isalpha, found)):
        return found
    # numbers that are neither digits nor letters, such as fractions, separate words
    return "".join(c if c.isalpha() else " " for c in " ".join(found)).split()


def grams(word: str, n: int) -> list[str]:
    marked = f"<{word}>"
    return [marked[i : i + n] for i in range(len(marked) - n + 1)]


def _code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)


def gram_keys(items: list[str]) -> np.ndarray:
    """The key of each n-gram: a hash of its code points."""
    sizes, out = np.array([len(i) for i in items], np.int64), np.zeros(len(items), np.uint64)
    codes, starts = _code_points("".join(items)), np.cumsum(sizes) - sizes
    for n in set(sizes.tolist()):
        of = sizes == n
        out[of] = runs(codes, n)[starts[of]]
    return out


def word_keys(items: list[str]) -> np.ndarray:
    return np.array([xxhash.xxh3_64_intdigest(i) for i in items], np.uint64)


def _counts(docs: DataFrame, of_text: bool) -> DataFrame:
    """(lang, item, n): words of texts, or n-grams of counted words; combined before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches, "__text" if of_text else "item"):
            found: Counter = Counter()
            langs, items = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            if of_text:
                for lang, text in zip(langs, items):
                    for word, n in Counter(words(text)).items():
                        found[lang, word] += n
            else:
                for lang, word, n in zip(langs, items, batch.column(2).to_pylist()):
                    for size in range(1, LONGEST + 1):
                        for gram in grams(word, size):
                            found[lang, gram] += n
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([k[0] for k in found], pa.string()),
                    pa.array([k[1] for k in found], pa.string()),
                    pa.array(list(found.values()), pa.int64()),
                ],
                ["lang", "item", "n"],
            )

    each = docs.mapInArrow(run, "lang string, item string, n long")
    return each.groupBy("lang", "item").agg(F.sum("n").alias("n"))


def _found(sorted_keys: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each key, whether it is known, and its place if so."""
    if not len(sorted_keys):
        return np.zeros(len(keys), bool), np.zeros(len(keys), int)
    place = np.minimum(np.searchsorted(sorted_keys, keys), len(sorted_keys) - 1)
    return sorted_keys[place] == keys, place


class Model:
    """Per-language log frequencies of words and n-grams, in arrays sorted by the items' hashes."""

    def __init__(self, words: pa.Table, grams: pa.Table):
        self.langs = sorted(set(words.column("lang").unique().to_pylist()))
        self.words, self.word_logs = self._logs(words, word_keys, False)
        self.grams, self.gram_logs = self._logs(grams, gram_keys, True)

    def _logs(self, rows: pa.Table, keys_of, by_length: bool) -> tuple[np.ndarray, np.ndarray]:
        coded = rows.column("item").combine_chunks().dictionary_encode()
        items = coded.dictionary.to_pylist()
        column = pc.index_in(rows.column("lang"), pa.array(self.langs, pa.string())).to_numpy()
        counts = np.zeros((len(items), len(self.langs)))
        np.add.at(counts, (coded.indices.to_numpy(), column), rows.column("n").to_numpy())
        kinds = np.array([len(item) if by_length else 0 for item in items], int)
        logs = np.zeros(counts.shape, np.float32)
        for k in set(kinds.tolist()):  # n-grams compete with those of their length
            of = counts[kinds == k]
            logs[kinds == k] = np.log((of + SMOOTH) / (of.sum(0) + SMOOTH * len(of)))
        keys = keys_of(items)
        order = np.argsort(keys)
        return keys[order], logs[order]

    def of_words(self, items: list[str]) -> np.ndarray:
        """Log frequencies, (word, language); of unseen words, means over their longest known n-grams.

        An unseen word of which no n-gram is known says nothing: 0 for each language.
        """
        known, place = _found(self.words, word_keys(items))
        out = np.zeros((len(items), len(self.langs)))
        out[known] = self.word_logs[place[known]]
        open_ = np.flatnonzero(~known)
        for n in range(LONGEST, 0, -1):
            if not len(open_):
                break
            marked = [f"<{items[i]}>" for i in open_]
            sizes = np.array([len(m) for m in marked], np.int64)
            owner = np.repeat(np.arange(len(open_)), sizes)
            ends = np.repeat(np.cumsum(sizes), sizes)
            keys = runs(_code_points("".join(marked)), n)
            inside = np.arange(n, n + len(keys)) <= ends[: len(keys)]
            seen, at = _found(self.grams, keys[inside])
            of = owner[: len(keys)][inside][seen]
            hits = np.bincount(of, minlength=len(open_))
            logs = self.gram_logs[at[seen]]
            sums = np.stack([np.bincount(of, logs[:, k], len(open_)) for k in range(len(self.langs))], 1)
            done = hits > 0
            out[open_[done]] = sums[done] / hits[done, None]
            open_ = open_[~done]
        return out


class Scorer:
    """Predictions of batches of texts; remembers the log frequencies of words it has met."""

    def __init__(self, model: Model, most: int = REMEMBERED):
        self.model, self.most = model, most
        self.rows: dict[str, int] = {}
        self.logs = np.zeros((0, len(model.langs)))

    def _learn(self, texts: list[list[str]]) -> None:
        fresh = sorted(set().union(*texts) - self.rows.keys())
        if len(self.rows) + len(fresh) > self.most:
            self.rows, self.logs = {}, self.logs[:0]
            fresh = sorted(set().union(*texts))
        self.rows.update(zip(fresh, range(len(self.rows), len(self.rows) + len(fresh))))
        if fresh:
            self.logs = np.concatenate([self.logs, self.model.of_words(fresh)])

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        langs, found = self.model.langs, [words(t) for t in texts]
        sizes = np.array([len(f) for f in found], np.int64)
        names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
        full = np.flatnonzero(sizes)
        if not langs or not len(full):
            return names, scores
        self._learn(found)
        at = np.fromiter((self.rows[w] for f in found for w in f), np.int64, int(sizes.sum()))
        total = np.add.reduceat(self.logs[at], (np.cumsum(sizes) - sizes)[full])
        share = np.exp(total - total.max(1, keepdims=True))
        best = share.argmax(1)
        scores[full] = share[np.arange(len(full)), best] / share.sum(1)
        for i, b in zip(full.tolist(), best.tolist()):
            names[i] = langs[b]
        return names, scores


def train(
    docs: DataFrame, trusted: Column, text_column: str = "text", lang_column: str = "lang",
    id_column: str = "doc_id",
) -> Model:
    """A model of the labelled rows for which ``trusted`` holds, from a bounded sample of each language.

    All words and n-grams of the sample are kept.  A sampled id that is on many rows gives one text
    per language.
    """
    labelled = docs.where(trusted & F.col(lang_column).isNotNull())
    rows = _sampled(labelled.select(id_column, F.col(lang_column).alias("lang")).distinct(), id_column)
    texts = with_texts(docs, rows, id_column, text_column).select("lang", "__text")
    words_ = cut(_counts(texts.repartition(24), True))
    # two lists, as long as the sample has items
    return Model(words_.toArrow(), _counts(words_.repartition(24), False).toArrow())


def _sampled(rows: DataFrame, id_column: str) -> DataFrame:
    """(id, lang): about ``SAMPLE`` rows of each language by a hash of the id, all where it has fewer."""
    sizes = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("__of"))  # a row per language
    die = F.pmod(F.xxhash64(id_column, F.lit(17)), F.lit(1 << 30)) / F.lit(1 << 30)
    return rows.join(sizes, "lang").where(die * F.col("__of") < SAMPLE).select(id_column, "lang")


def identify(
    docs: DataFrame, model: Model, text_column: str = "text", lang_name: str = "lang_pred", score_name: str = "score"
) -> DataFrame:
    """All columns, ``lang_pred`` and ``score``, the share of the winner among the languages.

    A text's log likelihood in a language is the sum over its words; shares are those of the
    likelihoods.  ``und`` with score 0 where the text is NULL, empty or has no letter, or where nothing
    was learnt.  Equal scores go to the first language in alphabetical order.  Whole texts of any
    length; repeated rows get equal results; an empty table gives no rows.  Names of the new columns
    that docs has already are an error.  One narrow pass.
    """
    clash = {lang_name, score_name} & set(docs.columns)
    if clash:
        raise ValueError(f"columns {sorted(clash)} exist; give the results other names")
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shipped.value)
        for batch in small(batches, text_column, 1 << 20):
            langs, scores = scorer.predict(batch.column(text_column).to_pylist())
            added = [pa.array(langs, pa.string()), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], [*batch.schema.names, lang_name, score_name])

    extra = [T.StructField(lang_name, T.StringType()), T.StructField(score_name, T.DoubleType())]
    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, *extra]))
