"""Scores over fitted models against plain loops, one document and one feature at a time."""

import math
import random
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from altimart.llm import lm, quality, toxicity

TEXTS = [
    "good words in a fine text", "bad bad spam spam spam", "mixed good spam text", "", None, " \n\t", "é日本 ünïcode ß", "a",
    "word " * 3000, "xyz!xyz?xyz", "Good GOOD good",
]


def sigmoid(x):
    return 1 / (1 + math.exp(-min(max(x, -30.0), 30.0)))


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(9)
    nice, poor = ["good", "fine", "text", "words", "useful"], ["spam", "bad", "xyz", "junk", "click"]
    rows = [(i, " ".join(rng.choices(nice if i % 2 else poor, k=12)), i % 2, 1 - i % 2) for i in range(120)]
    docs = spark.createDataFrame([(1000 + i, t) for i, t in enumerate(TEXTS)] + [r[:2] for r in rows], "doc_id long, text string")
    return docs, spark.createDataFrame([(r[0], r[2], r[3]) for r in rows], "doc_id long, quality int, toxic int")


def mixed64(value, part):
    value = ((value ^ part) * 0x9E3779B97F4A7C15) % (1 << 64)
    return value ^ (value >> 29)


def test_quality_scores(labelled):
    docs, labels = labelled
    odds, bias = quality.train(docs, labels)

    def of_word(word):
        marked = b"<" + word + b">"
        ids = [xxhash.xxh32_intdigest(marked) % quality.BUCKETS]
        for n in range(quality.SHORTEST, quality.LONGEST + 1):
            for i in range(len(marked) - n + 1):
                value = n
                for byte in marked[i : i + n]:
                    value = mixed64(value, byte)
                ids.append(value % quality.BUCKETS)
        return sum(float(odds[i]) for i in ids) / len(ids)

    for r in quality.score(docs, (odds, bias)).collect():
        words = (r.text or "").encode().split()
        words += [quality.AGAIN] * sum(a == b for a, b in zip(words, words[1:]))
        memory = {w: of_word(w) for w in set(words)}
        mean = sum(memory[w] for w in words) / len(words) if words else 0.0
        assert r.score == pytest.approx(sigmoid(mean + bias), rel=1e-6)


def test_toxicity_scores(labelled):
    docs, labels = labelled
    categories = ["poor", "toxic"]
    chain = toxicity.train(docs, labels.withColumn("poor", 1 - F.col("quality")), categories)
    assert len(chain) == 2 and len(chain[0].ids)
    for r in toxicity.score(docs, chain, categories).collect():
        found = {b for word in toxicity.words(r.text) for b in toxicity.features(word)}
        fed = []
        for model, name in zip(chain, categories):
            weights = dict(zip(model.ids.tolist(), model.weights.tolist()))
            total = model.bias + sum(weights.get(b, 0.0) for b in found) + sum(w * p for w, p in zip(model.dense, fed))
            fed.append(sigmoid(total))
            assert r[f"p_{name}"] == pytest.approx(fed[-1], rel=1e-6)


def test_byte_scores():
    """Counting contexts in dictionaries and mixing bit by bit gives the score of each gram."""
    texts = [b"the cat sat on the mat", b"", b"the dog sat", b"\x00\xff the", b"the cat sat on the mat"]
    keys, n = np.unique(lm.grams(texts)[0], return_counts=True)
    mixer = lm.Mixer(lm.learn(keys, n))
    asked = np.unique(np.concatenate([keys, lm.grams([b"the rat sat up"])[0]]))
    counts = np.array([dict(zip(keys.tolist(), n.tolist())).get(k, 0) for k in asked.tolist()])
    got = mixer.log10(asked, counts)
    total, ones = Counter(), Counter()
    for key, times in zip(keys.tolist(), n.tolist()):
        byte = key & 255
        for order in lm.ORDERS:
            context = (key >> 8) & ((1 << 8 * order) - 1)
            for bit in range(8):
                slot = order, context, (1 << bit) | (byte >> (8 - bit))
                total[slot] += times
                ones[slot] += times * (byte >> (7 - bit) & 1)
    steps, reach = lm._STEPS, lm._REACH
    for key, log in zip(asked.tolist(), got):
        byte, want = key & 255, 0.0
        for bit in range(8):
            odds = []
            for order in lm.ORDERS:
                slot = order, (key >> 8) & ((1 << 8 * order) - 1), (1 << bit) | (byte >> (8 - bit))
                odds.append(min(max(math.log((ones[slot] + 0.2) / (total[slot] - ones[slot] + 0.2)), -reach), reach) if total[slot] else None)
            gate = bit * (len(lm.ORDERS) + 1) + sum(o is not None for o in odds)
            mixed = sum(w * (o or 0.0) for w, o in zip(mixer.weights[gate], odds))
            cell = gate * steps + int(np.rint((min(max(mixed, -reach), reach) + reach) * (steps - 1) / (2 * reach)))
            plain = 1 / (1 + math.exp(-min(max(mixed, -15), 15)))
            refined = (mixer.ones[cell] + lm._TRUST * plain) / (mixer.all[cell] + lm._TRUST)
            one = min(max((plain + refined) / 2, 1e-6), 1 - 1e-6)
            want += math.log10(one if byte >> (7 - bit) & 1 else 1 - one)
        assert log == pytest.approx(want, rel=1e-6)


def test_classifiers_on_empty_tables_and_repeated_rows(labelled):
    docs, labels = labelled
    none = docs.where("false")
    assert quality.score(none, quality.train(none, labels)).isEmpty()
    assert toxicity.score(none, toxicity.train(none, labels, ["toxic"]), ["toxic"]).isEmpty()
    hot = docs.unionByName(docs.where("doc_id = 3").withColumn("k", F.explode(F.sequence(F.lit(1), F.lit(5000)))).drop("k"))
    odds, bias = quality.train(hot, labels.unionByName(labels))
    again, same = quality.train(docs, labels)
    assert bias == same and (odds == again).all()  # a repeated id is one text
