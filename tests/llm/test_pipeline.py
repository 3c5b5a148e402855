"""The pipeline on the smallest tables, stage by stage, against brute force."""

import corpus_pipeline
import pytest
from conftest import TINY
from test_operators import brute_components


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    folder, docs, out = tmp_path_factory.mktemp("pipeline"), spark.read.parquet(f"{TINY}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, TINY).write.parquet(f"{folder}/{name}")
        kept = spark.read.parquet(f"{folder}/{name}")
        out.append((name, docs.columns, docs.collect(), kept.columns, kept.collect()))
        docs = kept
    return out


def test_columns_stay_until_the_last_stage(stages):
    assert all(after == before for _, before, _, after, _ in stages[:-1])


def test_clean_documents_stay_in_their_language(stages):
    name, _, before, _, after = stages[0]
    assert name == "language" and {r.doc_id for r in after} == {r.doc_id for r in before}


def test_exact_copies(stages):
    _, _, before, _, after = stages[1]
    best = {}
    for r in before:
        key = "".join(r.text.split())
        best[key] = min(best.get(key, (1, 0)), (-len(r.text), r.doc_id))
    assert {r.doc_id for r in after} == {i for _, i in best.values()}


def test_near_copies(stages):
    _, _, before, _, after = stages[2]
    found = brute_components([(r.doc_id, r.text) for r in before], 5, 80)
    assert {r.doc_id for r in after} == {i for i, _, c in found if i == c}


def test_contaminated(stages, tables):
    def runs(text):
        w = "".join(c if c.isalnum() else " " for c in text.lower()).split()
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}

    items = [runs(t) for (t,) in tables.execute("select text from benchmark").fetchall()]
    _, _, before, _, after = stages[3]
    want = {r.doc_id for r in before if not any(len(q & runs(r.text)) * 100 >= 80 * len(q) for q in items)}
    assert {r.doc_id for r in after} == want


def test_tokens(stages):
    _, _, before, _, after = stages[4]
    assert len(after) == len(before) and all(r.round_trip and r.n_tokens == len(r.ids) for r in after)


def test_run(spark, stages):
    assert {r.doc_id for r in corpus_pipeline.run(spark, TINY).collect()} == {r.doc_id for r in stages[-1][-1]}


def documents(spark, rows):
    made = [(i, t, "en", "web", None if t is None else len(t)) for i, t in rows]
    return spark.createDataFrame(made, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)


def test_exact_copies_go_row_by_row(spark):
    rows = [(5, "x y"), (5, "x y"), (5, "x y")]  # a repeated row
    rows += [(7, "one copy"), (8, "one copy"), (7, "one copy"), (9, "onecopy")]  # the kept id repeated
    rows += [(2, "shared text"), (3, "shared text"), (3, "a text of its own")]  # one id, two texts
    rows += [(4, "a b"), (4, "a  b"), (None, "no id"), (None, "no id"), (None, None), (11, None), (12, "")]
    kept = corpus_pipeline.drop_exact_copies(spark, documents(spark, rows), TINY)
    want = [(5, "x y"), (7, "one copy"), (2, "shared text"), (3, "a text of its own"), (4, "a  b"), (None, "no id"), (11, None)]
    assert sorted([(r.doc_id, r.text) for r in kept.collect()], key=str) == sorted(want, key=str)


def test_rows_without_an_id_are_judged_like_others(spark, tables):
    item = tables.execute("select text from benchmark order by item_id limit 1").fetchone()[0]
    base, other, third = ([f"{c}{i}" for i in range(60)] for c in "abc")
    near = [(None, " ".join(base)), (None, " ".join([*base, "end"])), (None, " ".join([*base, "end"]))]
    near += [(None, " ".join(other)), (6, " ".join([*other, "end"])), (6, " ".join(third)), (None, "?"), (None, "!")]
    kept = [(r.doc_id, r.text) for r in corpus_pipeline.drop_near_copies(spark, documents(spark, near), TINY).collect()]
    assert len(kept) == 4 + 1 and {near[4], near[5], near[6], near[7]} < set(kept)
    clean = [(None, " ".join(third)), (8, " ".join(other))]
    held = [(None, f"before {item} after"), (8, f"{item} at the start"), *clean]
    left = corpus_pipeline.decontaminate_benchmark(spark, documents(spark, held), TINY).collect()
    assert sorted([(r.doc_id, r.text) for r in left], key=str) == sorted(clean, key=str)


def test_columns_of_any_name_stay(spark):
    """Columns named like what the stages add come through, with all rows of different texts."""
    texts = ["the cat sat on the mat " + f"and number{k} words of its own here " * 3 for k in range(6)] + ["½"]
    rows = [(k, t, "en", "web", len(t), 1, 2.0, "r", "w") for k, t in enumerate(texts)]
    schema = "doc_id long, text string, lang string, source string, n_chars int, lang_pred int, score double, __row string, word string"
    docs = spark.createDataFrame(rows, schema)
    for name, stage in corpus_pipeline.STAGES[:4]:
        if name != "near_dedup":
            done = stage(spark, docs, TINY)
            assert done.columns == docs.columns
            assert {r.doc_id for r in done.collect()} == set(range(7)) - ({6} if name == "language" else set())
