import numpy as np

from altimart.llm import ngram_join, text


def test_distinct_numbers_are_those_of_unique():
    rng = np.random.default_rng(2)
    for n in (0, 1, 2, 50, 3000):
        values = rng.integers(0, 1 + n // 2, n).astype(np.uint64) << np.uint64(40)
        assert text.distinct(values).tolist() == np.unique(values).tolist()


def test_sets_are_written_once_and_not_checkpointed(spark, monkeypatch):
    cuts, written = [], []
    cut, write = ngram_join.cut, ngram_join.materialised
    monkeypatch.setattr(ngram_join, "cut", lambda df: cuts.append(df.columns) or cut(df))
    monkeypatch.setattr(ngram_join, "materialised", lambda df, name: written.append(df.columns) or write(df, name))
    words = " ".join(f"w{i}" for i in range(60))
    docs = spark.createDataFrame([(1, words), (2, words + " more"), (3, "else")], "doc_id long, text string")
    found = {r.doc_id: r.component_id for r in ngram_join.alike(docs).collect()}
    assert found == {1: 1, 2: 1, 3: 3}
    assert [c for c in written if "tokens" in c] and not [c for c in cuts if "tokens" in c]
