"""Registered queries of the package against their SQL or a brute-force version."""

import hashlib
import math
import zlib
from collections import Counter

import public_tokenizers
import pytest
import tiktoken
from compare import differences
from conftest import TINY

from altimart.llm import bpe
from altimart.llm.queries import QUERIES, SQL


@pytest.fixture(scope="module")
def texts(tables):
    return dict(tables.execute("select doc_id, text from documents").fetchall())


@pytest.mark.parametrize("name", list(SQL))
def test_against_sql(spark, tables, name):
    assert differences(QUERIES[name](spark, TINY), tables, SQL[name]) == []


def test_every_operator_has_a_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_bpe_matches_the_library(spark, texts):
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    whole = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = set()
    for i, text in texts.items():
        ids = whole.encode_ordinary(text or "")
        digest = hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        want.add((i, len(ids), digest, hashlib.sha256((text or "").encode()).hexdigest()))
    assert {tuple(r) for r in QUERIES["op8_bpe"](spark, TINY).collect()} == want


def test_unigram_scores(spark, texts):
    lower = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
    tokens = {i: [*(t or "").encode().translate(lower).split(), None] for i, t in texts.items()}
    held = {i: zlib.crc32(str(i).encode()) % 5 == 1 for i in texts}
    learnt = Counter(w for i, ws in tokens.items() if not held[i] for w in ws)
    n, v = sum(learnt.values()), len(learnt)
    rows = QUERIES["op3_lm_scoring"](spark, TINY).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ws = tokens[r.doc_id]
        base = sum(math.log10((learnt[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws)
        known = sum(learnt[w] > 0 for w in ws)
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[r.doc_id], len(ws), known, n)
        assert r.base_score == pytest.approx(base)
        assert r.score < 0


def test_language_and_quality_on_held_out_rows(spark, tables):
    langs = dict(tables.execute("select doc_id, lang from documents").fetchall())
    rows = [r for r in QUERIES["op10_language_id"](spark, TINY).collect() if r.held_out]
    assert rows and all(0 <= r.score <= 1 for r in rows)
    assert sum(r.lang_pred == langs[r.doc_id] for r in rows) >= 0.95 * len(rows)
    quality = dict(tables.execute("select doc_id, quality from labels").fetchall())
    rows = QUERIES["op4_quality"](spark, TINY).collect()
    assert len(rows) == len(langs) and all(0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id in quality]
    assert sum(r.predicted == quality[r.doc_id] for r in held) >= 0.85 * len(held)


def test_toxicity_finds_what_it_has_learnt(spark, tables):
    toxic = dict(tables.execute("select doc_id, toxic from labels").fetchall())
    rows = [r for r in QUERIES["op9_toxicity"](spark, "/root/testdata/sf0.01").collect()]
    import duckdb

    toxic = dict(duckdb.sql("select doc_id, toxic from '/root/testdata/sf0.01/labels.parquet'").fetchall())
    rows = [r for r in rows if r.doc_id in toxic]
    clean = [r for r in rows if toxic[r.doc_id] == 0]
    bad = [r for r in rows if toxic[r.doc_id] == 1]
    assert sum(r.predicted for r in clean) <= 0.01 * len(clean)
    assert sum(r.predicted for r in bad) >= 0.7 * len(bad)
